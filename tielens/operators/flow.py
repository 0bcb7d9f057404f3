"""Working sets, resumption, status machines, caps, and field policies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import cells, pii, text

#: The meeting status machine.
NEXT = {"NEW": "PROCESS", "PROCESS": "REVIEW", "REVIEW": "WRITE", "WRITE": "DONE"}


def split_resolved(brain: DataFrame) -> tuple[DataFrame, DataFrame]:
    done = cells.truth(F.col("resolved"))
    return brain.filter(done), brain.filter(~done)


def working_set(rows: DataFrame, status: str) -> DataFrame:
    return rows.filter(F.trim(status) != "PROCESSED")


def resume(work: DataFrame, progress: DataFrame, key: str, most: int = 60) -> DataFrame:
    """Rows not yet finished, the first ``most`` by key: a batch of the run."""
    done = progress.filter("status in ('DONE', 'SKIPPED')").select(key)
    return work.join(done, key, "left_anti").orderBy(key).limit(most)


def advance(status: Column, failed: Column) -> Column:
    out = status
    for a, b in NEXT.items():
        out = F.when(status == a, b).otherwise(out)
    return F.when(failed, "ERROR").otherwise(out)


def capped(rows: DataFrame, eligible: Column, order: list[str], most: int) -> DataFrame:
    """``selected`` for the first ``most`` eligible rows in order; the rest are reported, not lost.

    The cap is found from the first ``most`` keys, which fit a task; all rows are then compared with the last of them.
    """
    key = F.struct(*order)
    head = rows.filter(eligible).select(key.alias("k")).orderBy("k").limit(most).agg(F.max("k").alias("last"))
    return rows.join(F.broadcast(head), F.lit(True)).withColumn("selected", F.coalesce(eligible & (key <= F.col("last")), F.lit(False))).drop("last")


def guard_fields(rows: DataFrame, fields: list[str]) -> DataFrame:
    """Free text redacted field by field, with the names of those changed."""
    changed = F.array_join(F.array_compact(F.array(*(F.when(pii.redact(F.col(f)) != F.col(f), f) for f in fields))), ",")
    return rows.withColumn("redacted_fields", changed).withColumns({f: pii.redact(F.col(f)) for f in fields})


def set_if_blank(old: Column, new: Column) -> Column:
    return F.coalesce(text.filled(old), new)


def set_if_newer(old: Column, new: Column) -> Column:
    return F.greatest(old, new)


def overwrite_if_filled(old: Column, new: Column) -> Column:
    return F.coalesce(text.filled(new), old)


def new_meetings(meetings: DataFrame, known: DataFrame, hours: int = 9) -> DataFrame:
    """Meetings whose id isn't known, nor their URL within the hours before: two anti joins, the second on hour buckets."""
    rest = meetings.join(known.select("meeting_id"), "meeting_id", "left_anti")
    seconds = hours * 3600
    at = F.unix_timestamp("started")
    left = rest.withColumns({"_s": at, "_b": F.explode(F.array(F.floor(at / seconds) - 1, F.floor(at / seconds)))})
    right = known.select("url", F.unix_timestamp("started").alias("_k"), F.floor(F.unix_timestamp("started") / seconds).alias("_b"))
    seen = left.join(right, ["url", "_b"]).filter((F.col("_k") <= F.col("_s")) & (F.col("_s") - F.col("_k") <= seconds)).select("meeting_id").distinct()
    return rest.join(seen, "meeting_id", "left_anti")


def judged(responses: DataFrame, candidates: DataFrame) -> DataFrame:
    """Model verdicts whose evidence is among the cluster's candidates; an invented evidence id is an error row."""
    met = responses.join(candidates.select("cluster_key", F.col("activity_id").alias("evidence_id"), F.lit(True).alias("known")), ["cluster_key", "evidence_id"], "left")
    bad = (F.coalesce("evidence_id", F.lit("")) != "") & F.col("known").isNull()
    return met.select("cluster_key", "evidence_id", F.when(bad, "ERROR").otherwise(F.col("verdict")).alias("verdict"), F.when(bad, "evidence id is not a candidate").alias("error"))


def ranked_within(rows: DataFrame, keys: list[str], order: list[str], name: str = "position") -> DataFrame:
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
