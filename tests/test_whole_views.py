"""The views keep all of what their tables hold."""

import pytest
from pyspark.sql import functions as F

from tielens.functions import cells
from tielens.plans.catalog import QUERIES
from tielens.sources.views import Tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def long_texts(spark, tmp_path_factory):
    """A card number behind character 3000 and a test word behind character 200."""
    to = f"file://{tmp_path_factory.mktemp('long')}"
    spark.createDataFrame([(8, "word " * 900 + "4111 1111 1111 1111 end", "en", "s", 4523)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{to}/documents.parquet")
    spark.createDataFrame([(2, 0, "user", "word " * 60 + "behind")], "conv_id long, turn int, role string, text string").write.parquet(f"{to}/conversations.parquet")
    return to


def test_texts_are_whole(spark, long_texts):
    assert QUERIES["pii_matches"](spark, long_texts).first().matches
    assert "1111" not in QUERIES["pii_redact"](spark, long_texts).first().redacted
    assert QUERIES["pii_first_category"](spark, long_texts).first().category is not None
    body = Tables(spark, long_texts).v_messages.first().body
    assert body.endswith("behind")
    assert QUERIES["email_messages"](spark, long_texts).first().body_md5 == spark.range(1).select(F.md5(F.lit(body))).first()[0]


def test_all_clicks_and_tasks_take_part(spark):
    t = Tables(spark, SF)
    assert t.v_outbound.count() == t.events.filter("event_type = 'click'").count() > 0
    assert t.v_outbound.filter("thread_id like '%b'").count() > 0
    assert t.v_recon.count() == t.v_tasks.count() > 0


def test_split_list_keeps_digits(spark):
    """F.trim as a function of item and index took the index off the item's ends."""
    rows = spark.createDataFrame([("TASK-220, 1TASK-x1 ,,12",)], "s string")
    assert rows.select(cells.split_list(F.col("s"))).first()[0] == ["TASK-220", "1TASK-x1", "12"]
