"""CRM scans: lists, people, look-ups, dimensions. Each look-up of many records is one join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.keys import first_wins


def entries(rows: DataFrame) -> DataFrame:
    """List entries that have a parent record."""
    return rows.filter(F.coalesce(F.col("record_id"), F.lit("")) != "")


def walk(people: DataFrame, order: str) -> tuple[DataFrame, DataFrame]:
    """(people by id, the first copy of each; ids that came more than once)."""
    repeated = people.groupBy("record_id").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    return first_wins(people, ["record_id"], [order]), repeated


def where(people: DataFrame, condition: Column) -> DataFrame:
    """A filtered scan: the condition reaches the file reader."""
    return people.filter(condition).dropDuplicates(["record_id"])


def fetch(ids: DataFrame, people: DataFrame) -> DataFrame:
    """Each id with its record and a status, ok or not_found; no failure stops the others."""
    met = ids.select("record_id").join(people.withColumn("_there", F.lit(True)), "record_id", "left")
    return met.withColumn("status", F.when(F.col("_there"), "ok").otherwise("not_found")).drop("_there")


def by_email(addresses: DataFrame, people: DataFrame, emails: str) -> DataFrame:
    held = people.select(F.explode(emails).alias("email"), "record_id").distinct()
    return addresses.select(F.lower("email").alias("email")).join(held, "email")


def names(companies: DataFrame) -> DataFrame:
    return companies.filter(F.trim("name") != "").select("record_id", "name")


def count_where(people: DataFrame, condition: Column) -> DataFrame:
    return people.filter(condition).agg(F.countDistinct("record_id").alias("n"))
