"""Imports from segment feeds: URL dedup, sync policies, serial ids, data richness, recent rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import cells, text
from ..sources.shared import landed
from .keys import first_wins


def unique_feed(segments: DataFrame) -> DataFrame:
    """The first row of each URL, by tab and row; rows without a URL are out."""
    rows = segments.withColumn("url", text.normal_url(F.col("url"))).filter("url <> ''")
    return first_wins(rows, ["url"], ["tab", "sheet_row"])


def sync_plan(segments: DataFrame, people: DataFrame) -> DataFrame:
    """Feed against people by URL: insert or update, and which fields the policies change (e-mail only where blank)."""
    feed = unique_feed(segments)
    held = first_wins(people.select(text.normal_url(F.col("linkedin")).alias("url"), "record_id", "name", "primary_email").filter("url <> ''"), ["url"], ["record_id"])
    met = feed.select("url", F.col("name").alias("new_name"), F.col("email").alias("new_email"), "segment").join(held, "url", "left")
    name = F.when((F.trim("new_name") != "") & (F.col("new_name") != F.col("name")), "name")
    mail = F.when((F.trim("new_email") != "") & (F.trim("primary_email") == ""), "email")
    fields = F.array_join(F.array_compact(F.array(name, mail)), ",")
    action = F.when(F.col("record_id").isNull(), "insert").when(fields != "", "update").otherwise("none")
    return met.select("url", "record_id", action.alias("action"), F.when(action == "update", fields).otherwise("").alias("fields"))


def mint(rows: DataFrame, order: list[str], existing: DataFrame, id_col: str) -> DataFrame:
    """Serial ids ``REF-%05d`` after the largest valid one.

    Rows are written by ranges of the order, each with its range's number; numbers come from counts per range, so no
    task ranks all rows, and a lost executor changes no number.
    """
    serial = F.regexp_extract(id_col, r"^REF-([0-9]{5,})$", 1).try_cast("long")
    last = existing.agg(F.coalesce(F.max(serial), F.lit(0)).alias("last")).first()["last"]
    ranged = landed(rows.repartitionByRange(*order).withColumn("_p", F.spark_partition_id()), "ranges")
    sizes = ranged.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    starts = sizes.select("_p", (F.sum("_n").over(Window.orderBy("_p")) - F.col("_n")).alias("_start"))  # a row for each partition
    nth = F.row_number().over(Window.partitionBy("_p").orderBy(*order))
    out = ranged.withColumn("_nth", nth).join(F.broadcast(starts), "_p")
    n = F.col("_start") + F.col("_nth") + F.lit(last)
    return out.withColumn("minted_id", F.concat(F.lit("REF-"), F.when(n < 100000, F.lpad(n.cast("string"), 5, "0")).otherwise(n.cast("string")))).drop("_p", "_n", "_start", "_nth")


#: Beginnings of the subjects of administrative entries.
ADMINISTRATIVE = ["Closed from queue", "Dismissed", "Snoozed", "Archived", "Pipeline stage"]


def richness(activity: DataFrame) -> DataFrame:
    """How much is known of a contact: rich, thin or empty; administrative entries don't count."""
    subject, administrative = F.coalesce("subject", F.lit("")), F.lit(False)
    for beginning in ADMINISTRATIVE:
        administrative = administrative | subject.startswith(beginning)
    rows = activity.withColumn("counts", ~administrative)
    out = rows.groupBy("contact_id").agg(F.count_if("counts").alias("entries"), F.sum(F.when(F.col("counts"), F.length("body")).otherwise(0)).alias("chars"))
    kind = F.when((F.col("entries") >= 2) | (F.col("chars") >= 600), "rich").when((F.col("entries") >= 1) | (F.col("chars") >= 200), "thin").otherwise("empty")
    return out.select("contact_id", "entries", "chars", kind.alias("richness"))


def pointers(master: DataFrame) -> DataFrame:
    return master.select("master_row", cells.positive_int(F.col("google_row")).alias("positive"), cells.nonzero_int(F.col("google_row")).alias("nonzero"), cells.leading_int(F.col("google_row")).alias("any_int"))
