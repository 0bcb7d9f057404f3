"""Plans for the audit's repairs. Nothing is written; a row says what would be, or why a person must decide."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import names
from . import audit


def repair_s1(master: DataFrame) -> DataFrame:
    """Orphans of a duplicated id are flagged with a note that names the canonical row."""
    rows = audit.canonical(master)
    best = rows.filter("role = 'canonical'").select("ref_id", F.col("master_row").alias("canonical_row"))
    out = rows.filter("role = 'orphan'").join(best, "ref_id")
    return out.select("master_row", "ref_id", "canonical_row", F.concat(F.lit("Duplicate of row "), F.col("canonical_row").cast("string")).alias("note"))


def repair_a1(findings: DataFrame, master: DataFrame, people: DataFrame) -> DataFrame:
    """The CRM's contact id is set to master's where the names agree."""
    rows = findings.filter("code = 'A1'").join(master.select("master_row", "full_name", "attio_record_id"), "master_row")
    met = rows.join(people.select(F.col("record_id").alias("attio_record_id"), "name"), "attio_record_id")
    return met.select("master_row", "attio_record_id", F.col("ref_id").alias("new_id"), names.gate(F.col("name"), F.col("full_name")).alias("action"))


def repair_a3(findings: DataFrame, master: DataFrame, people: DataFrame) -> DataFrame:
    """A pointer to no record: none elsewhere makes the row sheet-only, one is the new pointer, more need a person."""
    rows = findings.filter("code = 'A3'").select("master_row", "ref_id")
    held = people.filter("crm_ref_id <> ''").groupBy(F.col("crm_ref_id").alias("ref_id")).agg(F.count(F.lit(1)).alias("n"), F.min("record_id").alias("record_id"))
    met = rows.join(held, "ref_id", "left")
    action = F.when(F.col("n").isNull(), "google_only").when(F.col("n") == 1, "repoint").otherwise("manual")
    return met.select("master_row", "ref_id", action.alias("action"), F.when(action == "repoint", F.col("record_id")).alias("new_pointer"))


def repair_s4(master: DataFrame, people: DataFrame) -> DataFrame:
    """Of rows that share a pointer: the one whose id the CRM holds, else the only one whose name agrees, else a person."""
    rows = audit.audit_rows(master).filter("attio_record_id <> ''")
    groups = rows.groupBy("attio_record_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("attio_record_id")
    met = rows.join(groups, "attio_record_id").join(people.select(F.col("record_id").alias("attio_record_id"), "name", "crm_ref_id"), "attio_record_id", "left")
    met = met.select("attio_record_id", "master_row", F.coalesce(F.col("crm_ref_id") == F.col("ref_id"), F.lit(False)).alias("by_id"), (names.verify(F.col("name"), F.col("full_name")) == "MATCH").alias("by_name"))
    best = met.groupBy("attio_record_id").agg(F.count_if("by_id").alias("ids"), F.count_if("by_name").alias("names"), F.min(F.when(F.col("by_id"), F.col("master_row"))).alias("id_row"), F.min(F.when(F.col("by_name"), F.col("master_row"))).alias("name_row"))
    pick = F.when(F.col("ids") == 1, F.col("id_row")).when((F.col("ids") == 0) & (F.col("names") == 1), F.col("name_row"))
    return best.select("attio_record_id", pick.alias("canonical_row"), F.when(pick.isNull(), "manual").otherwise("keep_canonical").alias("action"))


def repair_i1(findings: DataFrame, master: DataFrame, people: DataFrame) -> DataFrame:
    """Drifted fields to patch, where both the id and the name agree; an address that another record holds is withheld."""
    rows = findings.filter("code = 'I1'").join(master.select("master_row", "full_name", "attio_record_id"), "master_row")
    met = rows.join(people.select(F.col("record_id").alias("attio_record_id"), "name", "crm_ref_id"), "attio_record_id")
    owner = people.select(F.lower("primary_email").alias("expected_key"), F.col("record_id").alias("holder")).groupBy("expected_key").agg(F.min("holder").alias("low"), F.max("holder").alias("high"))
    met = met.withColumn("expected_key", F.lower("expected")).join(owner, "expected_key", "left")
    taken = (F.col("notes") == "Email") & F.coalesce((F.col("low") != F.col("attio_record_id")) | (F.col("high") != F.col("attio_record_id")), F.lit(False))
    ok = (F.col("crm_ref_id") == F.col("ref_id")) & (names.gate(F.col("name"), F.col("full_name")) == "PROCEED")
    action = F.when(~ok, "NEEDS_MANUAL").when(taken, "EMAIL_CONFLICT").otherwise("PATCH")
    return met.select("master_row", "attio_record_id", F.col("notes").alias("field"), F.col("expected").alias("value"), action.alias("action"))
