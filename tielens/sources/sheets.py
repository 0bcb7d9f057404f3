"""Reading tables: guards, header resolution, contract checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, path: str, kind: str = "parquet", schema: str | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.csv(path, header=True) if kind == "csv" else reader.format(kind).load(path)


def must_have_rows(df: DataFrame, name: str) -> DataFrame:
    """``df``; fails at run time where a table that is never empty gives no rows. One row is read."""
    if df.isEmpty():
        raise ValueError(f"{name}: no rows were read; an empty read isn't an empty table")
    return df


def resolve(columns: list[str], wanted: dict[str, list[str]], case_sensitive: bool = False) -> tuple[dict[str, str], list[str]]:
    """(name -> column title, missing names): the first candidate that is there; of equal titles the first column."""
    index: dict[str, str] = {}
    for c in columns:
        index.setdefault(c.strip() if case_sensitive else c.strip().lower(), c)
    found = {}
    for name, titles in wanted.items():
        for t in titles:
            key = t if case_sensitive else t.lower()
            if key in index:
                found[name] = index[key]
                break
    return found, [n for n in wanted if n not in found]


def by_title(df: DataFrame, wanted: dict[str, list[str]], case_sensitive: bool = False) -> DataFrame:
    found, missing = resolve(df.columns, wanted, case_sensitive)
    if missing:
        raise ValueError(f"no column for {', '.join(missing)}")
    return df.select(*(F.col(f"`{c}`").alias(n) for n, c in found.items()))


def check_header(columns: list[str], contract: list[str]) -> str:
    """``ok``, ``extend`` (a short header that may be lengthened) or ``mismatch``. Extra columns at the end are fine."""
    for have, want in zip(columns, contract, strict=False):
        if have.strip() != want:
            return "mismatch"
    return "ok" if len(columns) >= len(contract) else "extend"


def describe(df: DataFrame, rows: int = 5) -> str:
    head = df.limit(rows).toPandas().to_string(index=False)
    return f"{df.schema.treeString()}\n{head}"
