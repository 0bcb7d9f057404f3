"""Passes, sources, sinks and streams."""

import pytest
from pyspark.sql import functions as F

from tielens.operators import scoring
from tielens.plans import reports
from tielens.plans.passes import NIGHTLY, PASSES, nightly
from tielens.sources import sheets, sinks
from tielens.sources.views import Tables
from tielens.streaming import live

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    return Tables(spark, SF)


@pytest.mark.parametrize("name", sorted(PASSES))
def test_pass_runs_dry(tables, name):
    out = PASSES[name](tables)
    assert out
    for df in out.values():
        df.limit(3).collect()


def test_nightly_keeps_order(tables):
    assert tuple(nightly(tables)) == NIGHTLY


def test_header_rules():
    assert sheets.resolve(["A ", "Full Name", "a"], {"x": ["Name", "full name"], "y": ["a"], "z": ["q"]}) == ({"x": "Full Name", "y": "A "}, ["z"])
    assert sheets.check_header(["a", "b", "c"], ["a", "b"]) == "ok"
    assert sheets.check_header(["a"], ["a", "b"]) == "extend"
    assert sheets.check_header(["b"], ["a"]) == "mismatch"


def test_guards(spark, tables):
    with pytest.raises(ValueError, match="no rows"):
        sheets.must_have_rows(tables.region.limit(0), "region")
    with pytest.raises(ValueError, match="no column"):
        sheets.by_title(tables.region, {"x": ["none"]})
    with pytest.raises(ValueError, match="are not"):
        sinks.checked(tables.region, ["r_name"])


def test_sinks(spark, tables, tmp_path):
    df = tables.region.select("r_regionkey", "r_name")
    columns = ["r_regionkey", "r_name"]
    assert sinks.rewrite(df, f"file://{tmp_path}/t", columns) is None and not list(tmp_path.iterdir())
    version = sinks.rewrite(df, f"file://{tmp_path}/t", columns, live=True)
    assert spark.read.parquet(version).count() == df.count()
    assert sinks.append(df, f"file://{tmp_path}/a", "r_regionkey", columns).filter("landed").count() == 0
    assert sinks.append(df, f"file://{tmp_path}/a", "r_regionkey", columns, live=True).filter("landed").count() == df.count()
    assert {r.outcome for r in sinks.verify(df, spark, f"{tmp_path}/a", "r_regionkey", ["r_name"]).collect()} == {"verified"}
    day = spark.createDataFrame([("2026-01-01", "x" * 45001)], "run_date string, payload string")
    with pytest.raises(Exception, match="45000"):
        sinks.daily(day, day.limit(0)).collect()


def test_reports(tables):
    text = reports.table(tables.region.select("r_regionkey", "r_name").orderBy("r_regionkey"))
    assert text.splitlines()[0].startswith("r_regionkey | r_name") and len(text.splitlines()) == 7
    assert reports.histogram({0: 2, 10: 4}).splitlines()[10].endswith("█ 4")
    assert reports.exit_code(0, 0) == 0 and reports.exit_code(1, 0) == 1 and reports.exit_code(0, 2) == 2


def test_streams(spark, tables, tmp_path):
    events = tables.events
    events.unionByName(events.limit(50)).repartition(2).write.parquet(f"file://{tmp_path}/events")
    stream = spark.readStream.schema(events.schema).parquet(f"file://{tmp_path}/events")
    unique = live.unique_events(stream, "40 days").writeStream.format("memory").queryName("uniq").outputMode("append").start()
    counts = live.activity_counts(stream, "1 hour").writeStream.format("memory").queryName("counts").outputMode("complete").start()
    for query in (unique, counts):
        query.processAllAvailable()
        query.stop()
    assert spark.table("uniq").count() == events.count()
    assert spark.table("counts").agg(F.sum("n")).first()[0] == events.count() + 50


def test_queue_batches(spark, tables):
    kept = {}
    people = tables.v_people
    run = live.merge_batches(lambda: tables.v_queue, lambda df, n: kept.update({n: df.count()}), people.limit(0).select("record_id"), people.limit(0).select("record_id"), "2001-08-15")
    run(scoring.scored(people), 0)
    run(scoring.scored(people), 0)  # a replay writes the same batch
    assert list(kept) == [0] and kept[0] > 0
