"""Stateful merges and lookups: queue merge, opportunity scan, contact resolution, drift and ownership checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import cells, dates, emails, names, text
from . import scoring
from .keys import first_wins

BANDS = ("keepers", "unclear", "junk")


def merge_queue(scored: DataFrame, existing: DataFrame, bridged: DataFrame, excluded: DataFrame, today: str) -> DataFrame:
    """(record_id, action, status, band, probability, dropped) of scored and existing rows.

    Human decisions are kept; a skipped row comes back with new evidence or once its date has passed; a row is dropped
    only on positive evidence. Unknown statuses count as decisions.
    """
    col = F.col
    old_band = F.lower(F.trim("band"))
    number = cells.number(col("probability"), 0.0)
    old = existing.select("record_id", F.lit(True).alias("old"), col("status").alias("old_status"), F.lower(F.trim("status")).alias("state"), "skip_until", "last_scored", F.when(old_band.isin(*BANDS), old_band).otherwise(scoring.band(number)).alias("old_band"), number.alias("old_probability"))
    new = scored.select("record_id", F.lit(True).alias("new"), col("score"), "band", "last_interaction")
    both = new.join(old, "record_id", "full_outer")
    both = both.join(bridged.select("record_id").distinct().withColumn("is_bridged", F.lit(True)), "record_id", "left").join(excluded.select("record_id").distinct().withColumn("is_excluded", F.lit(True)), "record_id", "left")
    day = F.lit(today).cast("date")
    fresh = F.coalesce(col("last_interaction") > dates.civil(col("last_scored")), F.lit(False))
    expired = F.coalesce(dates.civil(col("skip_until")) <= day, F.lit(False))
    action = (
        F.when(col("new").isNull() & col("is_bridged"), "dropped-bridged")
        .when(col("new").isNull() & col("is_excluded"), "dropped-excluded")
        .when(col("new").isNull(), "kept-unseen")
        .when(col("old").isNull(), "new")
        .when(col("state").isin("", "pending"), "rescored")
        .when((col("state") == "skipped") & fresh, "reactivated-new-evidence")
        .when((col("state") == "skipped") & expired, "reactivated-skip-expired")
        .when(col("state") == "skipped", "preserved-skip")
        .otherwise("preserved-decision")
    )
    both = both.withColumn("action", action)
    taken = col("action").isin("new", "rescored", "reactivated-new-evidence", "reactivated-skip-expired")
    return both.select(
        "record_id",
        "action",
        F.when(taken, "pending").otherwise(col("old_status")).alias("status"),
        F.when(taken, col("band")).otherwise(col("old_band")).alias("band"),
        F.when(taken, col("score").cast("double")).otherwise(col("old_probability")).alias("probability"),
        col("action").startswith("dropped").alias("dropped"),
    )


def queue_order(merged: DataFrame) -> list[Column]:
    """Bands in turn, best first but junk worst first, dropped rows last."""
    col = F.col
    rank = F.when(col("dropped"), 3).when(col("band") == "keepers", 0).when(col("band") == "unclear", 1).otherwise(2)
    within = F.when(col("band") == "junk", col("probability")).otherwise(-col("probability"))
    return [rank, F.when(col("dropped"), 0.0).otherwise(within), col("record_id")]


def scan_opportunities(people: DataFrame, pipeline: DataFrame, master: DataFrame, proposals: DataFrame) -> DataFrame:
    """People with a signal, and the first rule that excludes them (null: proposed)."""
    col = F.col
    rows = people.join(pipeline.select("record_id").distinct().withColumn("on_pipeline", F.lit(True)), "record_id", "left")
    rows = rows.join(master.select(col("ref_id").alias("crm_ref_id"), col("full_name").alias("master_name"), F.lit(True).alias("in_master")), "crm_ref_id", "left")
    rows = rows.join(proposals.select("record_id").distinct().withColumn("proposed", F.lit(True)), "record_id", "left")
    call = F.regexp_extract("last_url", r"/calls/([0-9]+)", 1)
    rule = F.when(col("on_pipeline"), "already_on_pipeline").when(col("in_master").isNull(), "no_master_id_row").when(call.rlike(r"^(\d)\1{5,}$"), "synthetic_test_record").when(col("proposed"), "already_proposed")
    return rows.withColumns({"rule": rule, "evidence": evidence(col("last_outcome"), col("last_subject"), col("last_summary"))})


def evidence(outcome: Column, subject: Column, summary: Column) -> Column:
    o, s, m = (F.trim(F.coalesce(c, F.lit(""))) for c in (outcome, subject, summary))
    return F.concat_ws(" — ", F.when(o != "", o), F.when(s != "", F.concat(F.lit("re: "), s)), F.when(m != "", text.clip(m, 400)))


def email_map(contacts: DataFrame) -> DataFrame:
    """E-mail to contact, lower case; the first row of an address wins."""
    rows = contacts.select(F.lower(F.trim("primary_email")).alias("email"), "contact_id", "sheet_row").filter("email <> '' and trim(contact_id) <> ''")
    return first_wins(rows, ["email"], ["sheet_row"])


def resolve(addresses: DataFrame, contacts: DataFrame, people: DataFrame) -> DataFrame:
    """Address -> contact: the sheet, else exactly one CRM record with an id, else a new candidate, else unresolved."""
    crm = people.select(F.explode(cells.split_list(F.lower("all_emails"))).alias("email"), "record_id", "crm_ref_id").distinct()
    crm = crm.groupBy("email").agg(F.count(F.lit(1)).alias("hits"), F.max("crm_ref_id").alias("crm_id"))
    met = addresses.join(email_map(contacts).select("email", F.col("contact_id").alias("sheet_id")), "email", "left").join(crm, "email", "left")
    how = F.when(F.col("sheet_id").isNotNull(), "contacts").when(F.col("hits").isNull(), "new_candidate").when((F.col("hits") == 1) & (F.col("crm_id") != ""), "crm").otherwise("unresolved")
    return met.select("email", how.alias("how"), F.when(how == "contacts", F.col("sheet_id")).when(how == "crm", F.col("crm_id")).alias("ref_id"))


def check_drift(index: DataFrame, contacts: DataFrame, people: DataFrame) -> DataFrame:
    """(ref_id, tags): sides that the location claims but that hold another id."""
    sheet = contacts.select(F.col("sheet_row").alias("google_row"), "contact_id")
    crm = people.select(F.col("record_id").alias("attio_record_id"), "crm_ref_id")
    met = index.join(sheet, "google_row", "left").join(crm, "attio_record_id", "left")
    claims = lambda side: F.col("location").isin(side, "BOTH")
    google = claims("GOOGLE") & F.col("google_row").isNotNull() & (F.coalesce("contact_id", F.lit("")) != F.col("ref_id"))
    attio = claims("ATTIO") & (F.col("attio_record_id") != "") & (F.coalesce("crm_ref_id", F.lit("")) != F.col("ref_id"))
    tags = F.array_compact(F.array(F.when(google, "google"), F.when(attio, "attio")))
    return met.select("ref_id", F.array_join(tags, ",").alias("tags"))


def ownership(claims: DataFrame, index: DataFrame) -> DataFrame:
    """Claims ``(ref_id, claimed_row, claimed_record)`` that master still agrees with, per side."""
    met = claims.join(index.select("ref_id", "google_row", "attio_record_id"), "ref_id", "left")
    row = F.coalesce(F.col("claimed_row") == F.col("google_row"), F.lit(False))
    record = F.coalesce((F.col("claimed_record") != "") & (F.col("claimed_record") == F.col("attio_record_id")), F.lit(False))
    return met.select("ref_id", "claimed_row", "claimed_record", row.alias("owns_row"), record.alias("owns_record"))


def cache(index: DataFrame, contacts: DataFrame, people: DataFrame, pipeline: DataFrame, today: str) -> DataFrame:
    """The pipeline cache: CRM-linked master rows with the side their location makes authoritative."""
    col = F.col
    rows = index.filter(col("location").isin("ATTIO", "BOTH") & (F.trim("attio_record_id") != ""))
    rows = rows.join(people.select(col("record_id").alias("attio_record_id"), "name", "job_title", col("company").alias("crm_company"), col("primary_email").alias("crm_email"), F.lit(True).alias("found")), "attio_record_id", "left")
    sheet = contacts.select(col("sheet_row").alias("google_row"), "contact_id", "first_name", "last_name", "title", "company", "primary_email")
    rows = rows.join(sheet, "google_row", "left").join(pipeline.select(col("record_id").alias("attio_record_id"), "tnb_stage", "fte_stage", "native_touch"), "attio_record_id", "left")
    both = (col("location") == "BOTH") & col("contact_id").isNotNull()
    side = lambda a, b: F.coalesce(F.when(both, a).otherwise(b), F.lit(""))
    withheld = F.when(col("found").isNull(), "not_found").when(both & (col("contact_id") != col("ref_id")), "row_drift")
    due = F.date_add("native_touch", 30)
    return rows.select(
        "ref_id",
        col("attio_record_id").alias("record_id"),
        side(F.concat_ws(" ", "first_name", "last_name"), col("name")).alias("name"),
        side(col("title"), col("job_title")).alias("title"),
        side(col("company"), col("crm_company")).alias("company"),
        side(col("primary_email"), col("crm_email")).alias("email"),
        text.stage_number(col("tnb_stage")).alias("tnb"),
        F.coalesce(due < F.lit(today).cast("date"), F.lit(False)).alias("stale"),
        withheld.alias("withheld"),
        names.drift(col("name"), F.concat_ws(" ", "first_name", "last_name")).alias("name_drift"),
    )


def repair_candidates(findings: DataFrame, master: DataFrame) -> DataFrame:
    """Repairs by code, sets kept apart: A1 without rows whose CRM pointer S4 contests, I1 without ids that S1 disputes."""
    rows = master.select("master_row", "attio_record_id")
    held = findings.filter(F.col("code").isin("S1", "A1", "A3", "S4", "I1")).join(rows, "master_row")
    contested = held.filter("code = 'S4'").select("attio_record_id").distinct()
    disputed = held.filter("code = 'S1'").select("ref_id").distinct()
    a1 = held.filter("code = 'A1'").join(contested, "attio_record_id", "left_anti")
    i1 = held.filter("code = 'I1'").join(disputed, "ref_id", "left_anti")
    out = held.filter(F.col("code").isin("S1", "A3", "S4")).unionByName(a1).unionByName(i1)
    return out.select("master_row", "ref_id", "code", "found")


def email_conflicts(people: DataFrame) -> DataFrame:
    """(email, record_id, other): addresses that more than one record holds, each holder but the smallest."""
    rows = people.select(F.explode(F.array_distinct(cells.split_list(F.lower("all_emails")))).alias("email"), "record_id")
    first = rows.groupBy("email").agg(F.min("record_id").alias("other"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    return rows.join(first, "email").filter("record_id <> other").select("email", "record_id", "other")


def email_list(primary: Column, others: Column) -> Column:
    """Primary first, then the others without it, case aside."""
    return F.concat(F.array(primary), F.filter(others, lambda e: F.lower(e) != F.lower(primary)))
