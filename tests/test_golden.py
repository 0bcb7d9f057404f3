"""Truth tables of single operators."""

import datetime

import pytest
from pyspark.sql import functions as F

from tielens.functions import cells, dates, names, pii, text
from tielens.operators import cadence, merge, scoring, tasks, threads, writes
from tielens.plans.ports import complete, retry_delay, stub


def one(spark, column, **values):
    schema = ", ".join(f"{k} {'string' if v is None or isinstance(v, str) else 'date' if isinstance(v, datetime.date) else 'double' if isinstance(v, float) else 'int'}" for k, v in values.items()) or "x int"
    return spark.createDataFrame([tuple(values.values()) or (1,)], schema).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(("cell", "want"), [(None, None), ("", None), ("45812", "2025-06-04"), ("45812.5", "2025-06-04"), ("2026-07-01T00:30:00Z", "2026-07-01"), ("2026-7-1", None), ("soon", None), (" 2025-01-31 ", "2025-01-31")])
def test_flexible_date(spark, cell, want):
    got = one(spark, dates.flexible_date(F.col("c").cast("string")), c=cell)
    assert (got and str(got)) == want


@pytest.mark.parametrize(("cell", "want"), [("12abc", 12), (" -3", -3), ("abc", None), ("", None), ("+7", 7)])
def test_leading_int(spark, cell, want):
    assert one(spark, cells.leading_int(F.col("c")), c=cell) == want


@pytest.mark.parametrize(("a", "b", "want"), [("Ana Cole", "cole, ANA", "MATCH"), ("Ana Cole", "Zed Other", "MISMATCH"), ("van Moor", "van Berg", "MISMATCH"), ("", "Ana", "UNVERIFIABLE"), ("...", "Ana", "UNVERIFIABLE"), ("de van", "de van", "UNVERIFIABLE")])
def test_verify(spark, a, b, want):
    assert one(spark, names.verify(F.col("a"), F.col("b")), a=a, b=b) == want


@pytest.mark.parametrize(("a", "b", "want"), [("José", "Jose", True), ("Søren", "Soren", False), ("Ana", "ana", False), ("José B", "Jose", False), ("", "", False), ("José", "José", False)])
def test_diacritic_variant(spark, a, b, want):
    assert one(spark, names.diacritic_variant(F.col("a"), F.col("b")), a=a, b=b) is want


def _cadence(spark, tnb=None, fte=None, fractional=None, tier="Strategic", native=None, manual=None):
    rows = spark.createDataFrame([(tnb, fte, fractional, tier, native, manual)], "tnb_stage string, fte_stage string, fractional_stage string, tier string, native_touch date, manual_touch date")
    return cadence.cadence(rows, "2026-01-31").first()


@pytest.mark.parametrize(("stage", "days", "mode"), [(1, 4, "Context"), (2, 6, "Context"), (3, 8, "Activation"), (4, 4, "Activation"), (5, 90, "Social")])
def test_stage_cadence(spark, stage, days, mode):
    got = _cadence(spark, tnb=f"Stage {stage}")
    assert (got.cadence_days, got.touch_mode, got.unknown_stage) == (days, mode, False)


@pytest.mark.parametrize(("tier", "days", "mode"), [("Core", 45, "Context"), ("Strategic", 90, "Social"), ("Peripheral", 180, "Social")])
def test_tier_cadence(spark, tier, days, mode):
    got = _cadence(spark, tier=tier)
    assert (got.cadence_days, got.touch_mode) == (days, mode)
    assert got.follow_up_reason == f"Tier {tier} — no active stage — last touch date unknown"


def test_unknown_stage_falls_back(spark):
    got = _cadence(spark, tnb="Stage 9", tier="Core")
    assert got.unknown_stage and got.cadence_days == 45


def test_stage_ties_and_catch_up(spark):
    got = _cadence(spark, tnb="Stage 2", fte="stage 2", fractional="Stage 1", manual=datetime.date(2026, 1, 1))
    assert (got.track, got.stage, got.touch_source, got.overdue_catch_up, got.stalled) == ("TNB", 2, "manual", True, True)
    assert str(got.next_check_in) == "2026-02-03"
    assert got.follow_up_reason.endswith("(expected every 6d) [manual]")


@pytest.mark.parametrize(("raw", "want"), [("  strategic ", "Strategic"), ("PERIPHERAL", "Peripheral"), ("VIP", "Strategic"), ("", "Strategic")])
def test_tier(spark, raw, want):
    assert one(spark, text.tier(F.col("t")), t=raw) == want


def test_placeholder_match(spark):
    held = spark.createDataFrame([("a", "2024-01-10 00:00:00", "Ana Cole", "T1"), ("b", "2024-01-10 00:00:00", "Ana Cole", ""), ("c", "2024-01-10 00:00:00", "Bo Ito", ""), ("d", "bad", "Ana Cole", ""), ("e", "2024-01-10 00:00:00", "Ana Cole", "T9"), ("f", "2024-01-10 00:00:00", " ", "")], "activity_id string, ts_text string, contact_name string, thread_from_note string")
    out = spark.createDataFrame([("T1", 1, "Xu Ito", "2024-01-12 23:59:00"), ("T2", 2, "Cole", "2024-01-13 00:00:00"), ("T3", 3, "Ito", "2024-01-08 00:00:00"), ("T4", 4, "Cole", "2024-01-13 00:00:01")], "thread_id string, sheet_row int, contact_name string, last_email_date string")
    got = {r.activity_id: (r.verdict, r.thread_id) for r in tasks.match_placeholders(held, out).collect()}
    assert got == {"a": ("EXACT", "T1"), "b": ("INFERRED", "T2"), "c": ("AMBIGUOUS", None), "d": ("NO_MATCH", None), "e": ("INFERRED", "T2"), "f": ("NO_MATCH", None)}


@pytest.mark.parametrize(("value", "want"), [("card 4111 1111 1111 1111 b", "card [REDACTED_CARD]b"), ("4111-1111-1111-1112", "4111-1111-1111-1112"), ("n 123-45-6789.", "n [REDACTED_SSN]."), ("Password: x1 y", "[REDACTED_PASSWORD] y")])
def test_redact(spark, value, want):
    assert one(spark, pii.redact(F.col("t")), t=value) == want


@pytest.mark.parametrize(("value", "want"), [("123-45-6789 password: x", "ssn"), ("pwd=1", "credential"), ("routing number: 021000021", "bank_account"), ("4111111111111111", "credit_card"), ("nothing", None), ("", None)])
def test_first_category(spark, value, want):
    assert one(spark, pii.first_category(F.col("t")), t=value) == want


@pytest.mark.parametrize(("score", "llm", "want"), [(50, 95, 80), (50, 10, 20), (50, 60, 60), (90, 100, 100), (10, 0, 0)])
def test_clamp(spark, score, llm, want):
    assert one(spark, scoring.clamped(F.col("s"), F.col("l")), s=score, l=llm) == want


def test_strength_band(spark):
    assert one(spark, scoring.strength_band(F.col("v"), F.col("l")), v=14.9, l="Strong") == "Weak"


@pytest.mark.parametrize(("answer", "ok"), [('```json\n{"score": 3, "reason": "a"}\n```', True), ('{"score": 3}', False), ('{"score": "3", "reason": "a"}', False), ('{"score": 300, "reason": "a"}', False), ("nope", False), ('{"score": 1, "reason": " "}', False)])
def test_verdict(spark, answer, ok):
    assert one(spark, threads.verdict_of(F.col("a")), a=answer).ok is ok


def test_completer_failures_are_rows(spark):
    def failing(prompt):
        raise RuntimeError("no network")

    rows = spark.createDataFrame([("r1", "p")], "id string, prompt string")
    assert complete(rows, "id", "prompt", stub).first().ok
    assert not complete(rows, "id", "prompt", failing).first().ok
    assert retry_delay(1, 429) == 5.0 and retry_delay(2, 503) == 2.0 and retry_delay(1, 0) == 1.0 and retry_delay(1, 404) is None


def test_queue_actions(spark):
    scored = spark.createDataFrame([("a", 80, "keepers", "2026-01-20"), ("b", 50, "unclear", None), ("c", 20, "junk", "2026-01-01"), ("d", 60, "unclear", None)], "record_id string, score int, band string, last_interaction string").withColumn("last_interaction", F.col("last_interaction").cast("date"))
    old = spark.createDataFrame([("a", "skipped", "", "2026-01-10", "10", ""), ("b", "skipped", "2026-01-31", "", "20", ""), ("c", "Queued_keep", "", "", "90", ""), ("x", "pending", "", "", "1", ""), ("y", "pending", "", "", "1", ""), ("z", "odd", "", "", "bad", "Keepers")], "record_id string, status string, skip_until string, last_scored string, probability string, band string")
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "record_id string")
    got = {r.record_id: (r.action, r.band) for r in merge.merge_queue(scored, old, ids("x"), ids("y"), "2026-01-31").collect()}
    assert got == {"a": ("reactivated-new-evidence", "keepers"), "b": ("reactivated-skip-expired", "unclear"), "c": ("preserved-decision", "keepers"), "d": ("new", "unclear"), "x": ("dropped-bridged", "junk"), "y": ("dropped-excluded", "junk"), "z": ("kept-unseen", "keepers")}


def test_diff(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, "q"), (4, "w")], "k int, v string")
    assert {r.k: (r.outcome, r.fields) for r in writes.diff(a, b, "k", ["v"]).collect()} == {1: ("verified", ""), 2: ("mismatch", "v"), 3: ("missing", ""), 4: ("unexpected", "")}


def test_column_letters():
    assert [cells.column_letter(i) for i in (0, 25, 26, 701, 702)] == ["A", "Z", "AA", "ZZ", "AAA"]
