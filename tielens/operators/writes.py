"""Plans of writes, guards on them, and verification by reading back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import pii, text
from ..params import Params


def activity_plan(rows: DataFrame, index: DataFrame, p: Params) -> DataFrame:
    """Activity rows to append for resolved threads, the ids deterministic, sensitive fields emptied with a warning."""
    value, warning = pii.sanitize(F.col("running_summary"), "summary")
    met = rows.join(index.select("ref_id", "location", "google_row", "attio_record_id"), "ref_id", "left")
    return met.select(
        text.run_id_of("ACT", p.run_ms, F.col("sheet_row")).alias("activity_id"),
        "ref_id",
        "contact_name",
        "subject",
        value.alias("body"),
        F.coalesce(F.col("location").isin("GOOGLE", "BOTH") & F.col("google_row").isNotNull(), F.lit(False)).alias("to_google"),
        F.coalesce(F.col("location").isin("ATTIO", "BOTH") & (F.col("attio_record_id") != ""), F.lit(False)).alias("to_attio"),
        F.coalesce(warning, F.lit("")).alias("warning"),
    )


def hollow(to_google: Column, to_attio: Column) -> Column:
    """No side can be written."""
    return ~to_google & ~to_attio


def partial(to_google: Column, to_attio: Column) -> Column:
    return to_google != to_attio


def diff(expected: DataFrame, actual: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, outcome, fields): verified, missing, unexpected or mismatch with the columns that differ."""
    e = expected.select(key, F.lit(True).alias("_e"), *(F.col(c).alias(f"e_{c}") for c in columns))
    a = actual.select(key, F.lit(True).alias("_a"), *(F.col(c).alias(f"a_{c}") for c in columns))
    met = e.join(a, key, "full_outer")
    fields = F.array_compact(F.array(*(F.when(~F.col(f"e_{c}").eqNullSafe(F.col(f"a_{c}")), c) for c in columns)))
    outcome = F.when(F.col("_a").isNull(), "missing").when(F.col("_e").isNull(), "unexpected").when(F.size(fields) > 0, "mismatch").otherwise("verified")
    return met.select(key, outcome.alias("outcome"), F.when(outcome == "mismatch", F.array_join(fields, ",")).otherwise("").alias("fields"))


def appended(existing: Column, entry: Column) -> Column:
    """Entry on a new line, once."""
    e = F.coalesce(existing, F.lit(""))
    return F.when(e == "", entry).when(F.contains(e, entry), e).otherwise(F.concat(e, F.lit("\n"), entry))


def chunk_of(ordinal: Column, size: int = 100) -> Column:
    return F.floor((ordinal - 1) / size).cast("int")


def plan_rows(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """CRM patches as (key, attribute, value), one row an attribute."""
    pairs = F.array(*(F.struct(F.lit(c).alias("attribute"), F.col(c).cast("string").alias("value")) for c in columns))
    return rows.select(key, F.explode(pairs).alias("p")).select(key, "p.*").filter("value is not null")
