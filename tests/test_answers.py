"""Model answers, guards on them, closing writes, ports; golden cases written by hand."""

import json

import pytest
from pyspark.sql import functions as F

from tielens.functions import emails, pii
from tielens.operators import closing, enrichment, feeds
from tielens.plans import ports

GOOD = {
    "running_summary": "s", "key_commitments": "k", "personal_details_flag": True, "company_intel": "", "pipeline_signals": "", "brain_notes": "", "action_required": "REPLY_NEEDED", "outcome": "Positive", "response_draft": "d",
    "tasks": [{"description": "a", "due_date": "", "priority": "High"}], "ready_to_archive": False, "personal_notes_extract": "", "topics_of_interest_extract": "", "conversation_trigger_extract": "",
}


@pytest.fixture(scope="module")
def errors(spark):
    def of(*answers):
        rows = spark.createDataFrame([(str(i), "Inbound", a) for i, a in enumerate(answers)], "thread_id string, direction string, answer string")
        return [r.error for r in enrichment.parse(rows).orderBy(F.col("thread_id").cast("int")).collect()]

    return of


def test_answer_schema(errors):
    wrong = lambda **k: json.dumps(GOOD | k)
    got = errors(
        json.dumps(GOOD), f"```json\n{json.dumps(GOOD)}\n```", f" \n```\n{json.dumps(GOOD)}```  ", "nonsense", "[]", "null", None, json.dumps({k: v for k, v in GOOD.items() if k != "outcome"}),
        wrong(key_commitments={"ana": "call"}), wrong(personal_details_flag="true"), wrong(action_required="reply_needed"), wrong(tasks={}), wrong(tasks=[{"description": "a", "due_date": None, "priority": "x"}, 5]), wrong(running_summary=None, outcome=3), wrong(extra=1),
    )
    assert got == [
        None, None, None, "not valid JSON", "expected object", "expected object", "not valid JSON", "outcome: not one of the choices",
        "key_commitments: expected string", "personal_details_flag: expected boolean", "action_required: not one of the choices", "tasks: expected array", "tasks.0.due_date: expected string; tasks.1: expected object", "running_summary: expected string; outcome: not one of the choices", None,
    ]


def test_evidence_across_fields(spark):
    base = {"has_evidence": True, "evidence_activity_id": "ACT-1", "evidence_quote": "q", "confidence": "high", "brain_reasoning": "r"}
    cases = [base, base | {"confidence": ""}, base | {"confidence": "", "evidence_activity_id": ""}, base | {"has_evidence": False, "confidence": ""}, base | {"confidence": "low"}]
    rows = spark.createDataFrame([(i, json.dumps(c)) for i, c in enumerate(cases)], "n int, answer string")
    assert [r.error for r in enrichment.evidence(rows).orderBy("n").collect()] == [
        None, "confidence: must be set when has_evidence is true", "confidence: must be set when has_evidence is true; evidence_activity_id: must be set when has_evidence is true", None, "confidence: not one of the choices",
    ]


def test_guards_on_answers(spark):
    said = GOOD | {"brain_notes": "card 4111 1111 1111 1111 here", "company_intel": "password: x"}
    rows = spark.createDataFrame([("a", "Outbound", json.dumps(said)), ("b", "Inbound", json.dumps(said))], "thread_id string, direction string, answer string")
    a, b = enrichment.guarded(enrichment.parse(rows)).orderBy("thread_id").collect()
    assert (a.action_required, a.response_draft) == ("FYI_ONLY", "") and (b.action_required, b.response_draft) == ("REPLY_NEEDED", "d")
    assert a.brain_notes == "card [REDACTED_CARD]here" and a.company_intel == "[REDACTED_PASSWORD]"  # the pattern takes the separator
    assert a.warnings == "outbound ceiling: REPLY_NEEDED became FYI_ONLY; redacted: company_intel; redacted: brain_notes" and b.warnings == "redacted: company_intel; redacted: brain_notes"


def test_cards_are_redacted_where_they_stand(spark):
    cases = {"A4111111111111111 4111111111111111": "A4111111111111111 [REDACTED_CARD]", "4111-1111-1111-1111,4111-1111-1111-1112": "[REDACTED_CARD],4111-1111-1111-1112", "": "", "x": "x"}
    rows = spark.createDataFrame([(k,) for k in cases], "t string")
    assert {r.t: r.r for r in rows.select("t", pii.redact(F.col("t")).alias("r")).collect()} == cases


def test_subjects_as_the_patterns_stand(spark):
    cases = {"Order confirmations": True, "order #12": True, "reorder confirmed": False, "invoices": False, "Invoice": True, "e-ticket": True, "welcome to x": True, "welcome to": False, " ": False}
    rows = spark.createDataFrame([(k,) for k in cases], "t string")
    assert {r.t: r.r for r in rows.select("t", emails.is_transactional(F.col("t")).alias("r")).collect()} == cases


def test_administrative_entries_do_not_count(spark):
    rows = spark.createDataFrame([("a", "Snoozed until May", "x" * 900), ("a", "Hello", "y"), ("b", "not Archived", "z"), ("b", None, "z"), ("c", "Dismissed", "z")], "contact_id string, subject string, body string")
    assert {r.contact_id: (r.entries, r.chars, r.richness) for r in feeds.richness(rows).collect()} == {"a": (1, 1, "thin"), "b": (2, 2, "rich"), "c": (0, 0, "empty")}


def test_read_back(spark):
    rows = [("a", "x", True, "1", "1", "1"), ("a", "y", True, "1", "2", "1"), ("b", "x", True, "1", None, "2"), ("b", "n", False, "1", "2", "2"), ("c", "n", False, "1", "2", "2")]
    got = closing.read_back(spark.createDataFrame(rows, "thread_id string, field string, load_bearing boolean, expected string, first string, second string"))
    assert sorted(map(tuple, got.collect())) == [("a", True, 1, "corrected once: y"), ("b", False, 0, "note (non-blocking): n; mismatch: x"), ("c", True, 0, "note (non-blocking): n")]


def test_written_in_order(spark):
    table = lambda *ids: spark.createDataFrame(list(enumerate(ids)), "position int, id string")
    verdict = lambda a, b: tuple(closing.written_in_order(table(*a), table(*b)).first())
    assert verdict("ab", "ab") == ("verified", 2, 2, None)
    assert verdict("ab", "ba") == ("mismatch", 2, 2, 0)
    assert verdict("ab", ["a", ""]) == ("mismatch", 2, 1, 1)
    assert verdict("ab", ["", ""]) == ("inconclusive", 2, 0, 0)


def test_retries_and_posts():
    left, waits = [ports.Refused(503), ports.Refused(429), "ok"], []

    def call():
        x = left.pop(0)
        if isinstance(x, Exception):
            raise x
        return x

    assert ports.retried(call, pause=waits.append) == "ok" and waits == [1.0, 5.0]
    for first, tries in ((ports.Refused(404), 1), (ports.Refused(500), 3)):
        seen = []

        def fails(first=first, seen=seen):
            seen.append(1)
            raise first

        with pytest.raises(ports.Refused):
            ports.retried(fails, pause=lambda s: None)
        assert len(seen) == tries
    sent = []
    ports.poster(lambda body: sent.append(json.loads(body)) or "ok")("hi")
    assert sent == [{"text": "hi", "username": "engine", "icon": ""}]


def test_digest_is_posted_once(spark):
    seen = []
    rows = spark.createDataFrame([(2, "two"), (1, "one"), (3, "")], "position int, notice string")
    assert ports.post_digest(rows, "run", ports.silent(seen.append)) == 2 and ports.post_digest(rows.limit(0), "run", ports.silent(seen.append)) == 0
    assert seen == ["run\n\none\n\ntwo", "run\n\nNothing needs your attention tonight."]


def test_failed_calls_fit_no_schema(spark):
    def dead(prompt):
        raise ports.Refused(401)

    rows = spark.createDataFrame([("t", "p")], "thread_id string, prompt string")
    answer = ports.answered(rows, "thread_id", "prompt", dead).withColumn("direction", F.lit("Inbound"))
    assert enrichment.parse(answer).first().error == "not valid JSON"
    assert enrichment.parse(ports.answered(rows, "thread_id", "prompt", ports.stub_answer)).first().error is None
