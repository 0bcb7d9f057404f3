"""Writing: every sink takes a plan, is dry by default, and verifies by reading back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.writes import diff

MOST_CHARS = 45_000


def checked(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` in the declared order; a sink takes neither fewer nor more columns, nor another order."""
    if df.columns != columns:
        raise ValueError(f"columns {df.columns} are not {columns}")
    return df


def rewrite(df: DataFrame, path: str, columns: list[str], live: bool = False) -> str | None:
    """A whole new version beside the old one; its path, for the reader to switch to. Nothing of the old one is touched."""
    checked(df, columns)
    if not live:
        return None
    version = f"{path}/v-{uuid.uuid4().hex}"
    df.write.parquet(version)
    return version


def append(df: DataFrame, path: str, key: str, columns: list[str], live: bool = False) -> DataFrame:
    """Appends and accounts for what landed: (key, landed)."""
    checked(df, columns)
    if live:
        df.write.mode("append").parquet(path)
        held = df.sparkSession.read.parquet(path).select(key).distinct().withColumn("landed", F.lit(True))
        return df.select(key).join(held, key, "left").select(key, F.coalesce("landed", F.lit(False)).alias("landed"))
    return df.select(key, F.lit(False).alias("landed"))


def upsert(new: DataFrame, old: DataFrame, key: str) -> DataFrame:
    """``old`` with the rows of ``new`` in place of those of the same key."""
    return old.join(new.select(key), key, "left_anti").select(*new.columns).unionByName(new)


def daily(new: DataFrame, old: DataFrame) -> DataFrame:
    """One row a day; a payload beyond the cell's size is refused."""
    fits = F.when(F.length("payload") <= MOST_CHARS, F.col("payload")).otherwise(F.raise_error(F.lit("payload beyond 45000 characters")))
    return upsert(new.withColumn("payload", fits), old, "run_date")


def guarded(plan: DataFrame, before: DataFrame, after: DataFrame, key: str, column: str) -> DataFrame:
    """Outcome of single-cell writes: the key must hold before and after, and the value must read back."""
    was = before.select(key, F.lit(True).alias("was"))
    now = after.select(key, F.lit(True).alias("now"), F.col(column).alias("value_now"))
    met = plan.join(was, key, "left").join(now, key, "left")
    outcome = F.when(F.col("was").isNull() | F.col("now").isNull(), "key_changed").when(F.col("value_now").eqNullSafe(F.col("new_value")), "written").otherwise("readback_mismatch")
    return met.select(key, outcome.alias("outcome"))


def verify(expected: DataFrame, spark: SparkSession, path: str, key: str, columns: list[str]) -> DataFrame:
    return diff(expected, spark.read.parquet(path), key, columns)
