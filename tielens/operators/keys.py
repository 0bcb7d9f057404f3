"""Duplicate policies of lookup sides, and ranked selections.

Policies are aggregations (max_by and the like), not windows: they fold within each task before the shuffle, so a key
that holds a third of the rows is no hot spot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _one(df: DataFrame, keys: list[str], order: list[Column | str], pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    out = df.groupBy(*keys).agg(pick(F.struct(*rest), F.struct(*order)).alias("_row"))
    return out.select(*keys, "_row.*").select(*df.columns)


def last_wins(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    return _one(df, keys, order, F.max_by)


def first_wins(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    return _one(df, keys, order, F.min_by)


def unambiguous(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key occurs once; a duplicated key isn't resolved at all."""
    rest = [c for c in df.columns if c not in keys]
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.any_value(F.struct(*rest)).alias("_row")).filter("_n = 1")
    return out.select(*keys, "_row.*").select(*df.columns)


def shared_groups(df: DataFrame, key: str) -> DataFrame:
    """(key, members) of populated keys with two rows or more. Blank is never a shared value."""
    return df.filter(F.trim(key) != "").groupBy(F.trim(key).alias(key)).agg(F.count(F.lit(1)).alias("members")).filter("members >= 2")


def top_k(df: DataFrame, keys: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first ``k`` rows of each key; Spark keeps at most k per task before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)


def limited(df: DataFrame, order: list[Column | str], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)
