"""Data-integrity audit: structural, sheet-side and CRM-side rules, and plans for repair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import cells, names

#: Severities.
SEVERITY = {"S1": "HIGH", "S2": "HIGH", "S3": "MEDIUM", "S4": "HIGH", "S5": "MEDIUM", "G1": "HIGH", "G2": "LOW", "G3": "MEDIUM", "A1": "HIGH", "A2": "LOW", "A3": "HIGH", "A4": "INFO", "A5": "HIGH", "I1": "MEDIUM"}
FIRST_ROW = 3
HEAD = ["master_row", "ref_id", "code", "expected", "found", "notes"]


def audit_rows(master: DataFrame) -> DataFrame:
    """Rows to audit: gaps and retired rows out, the pointer as any integer."""
    rows = master.withColumns({"location": F.upper(F.trim("location")), "google_row": cells.leading_int(F.col("google_row"))})
    gap = (F.trim("ref_id") == "") & (F.trim("full_name") == "") & (F.trim("attio_record_id") == "")
    return rows.filter(~gap & (F.col("location") != "SUPERSEDED"))


def _finding(when: Column, code: str, expected, found, notes) -> Column:
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.when(when, F.struct(F.lit(code).alias("code"), lit(expected).alias("expected"), lit(found).alias("found"), lit(notes).alias("notes")))


def _exploded(rows: DataFrame, findings: list[Column]) -> DataFrame:
    out = rows.select("master_row", "ref_id", F.explode(F.array_compact(F.array(*findings))).alias("f"))
    return out.select("master_row", "ref_id", "f.*")


def duplicates(rows: DataFrame, key: str, code: str, said: str) -> DataFrame:
    """Every copy of a populated key, with the rows that share it."""
    held = rows.filter(F.col(key) != "")
    groups = held.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list("master_row")), lambda x: x.cast("string")), ", ").alias("list")).filter("n > 1")
    out = held.join(groups, F.col(key) == F.col("_key"))
    notes = F.concat(F.col("n").cast("string"), F.lit(f" rows share {said}"), F.col(key))
    return out.select("master_row", "ref_id", F.lit(code).alias("code"), F.lit("unique").alias("expected"), F.concat(F.lit("rows "), "list").alias("found"), notes.alias("notes"))


def structural(master: DataFrame) -> DataFrame:
    rows = audit_rows(master)
    loc, g, a = F.col("location"), F.col("google_row"), F.col("attio_record_id")
    single = _exploded(
        rows,
        [
            _finding(F.col("ref_id") == "", "S2", "an id", "(blank)", "row has no identity anchor"),
            _finding(loc.isin("GOOGLE", "BOTH") & g.isNull(), "S3", "Google_Row populated", "(blank)", F.concat(F.lit("Location="), loc, F.lit(" but Google_Row is blank"))),
            _finding(loc.isin("ATTIO", "BOTH") & (a == ""), "S3", "Attio_Record_ID populated", "(blank)", F.concat(F.lit("Location="), loc, F.lit(" but Attio_Record_ID is blank"))),
            _finding((loc == "GOOGLE") & (a != ""), "S3", "no Attio_Record_ID", a, "Location=GOOGLE but an Attio pointer is present"),
            _finding((loc == "ATTIO") & g.isNotNull(), "S3", "no Google_Row", g.cast("string"), "Location=ATTIO but a Google_Row is present"),
            _finding(g < FIRST_ROW, "S5", ">= 3", g.cast("string"), "rows 1-2 are header/formula"),
        ],
    )
    return single.unionByName(duplicates(rows, "ref_id", "S1", "")).unionByName(duplicates(rows, "attio_record_id", "S4", "Attio record "))


def sheet_side(master: DataFrame, contacts: DataFrame, blank_ids: bool = True) -> DataFrame:
    """G1-G3. ``blank_ids``: G2 also for rows without an id of their own, which S2 reports too; the SQL twins leave these out."""
    rows = audit_rows(master).filter(F.col("google_row") >= FIRST_ROW)
    last = contacts.filter(F.col("contact_id") != "").agg(F.coalesce(F.max("sheet_row"), F.lit(FIRST_ROW - 1)).alias("last_row"))  # one row
    met = rows.join(contacts.select(F.col("sheet_row").alias("google_row"), "contact_id"), "google_row", "left").join(F.broadcast(last), F.lit(True))
    held = F.coalesce("contact_id", F.lit(""))
    g = F.col("google_row").cast("string")
    beyond = F.col("google_row") > F.col("last_row")
    empty = held == "" if blank_ids else (held == "") & (F.col("ref_id") != "")
    return _exploded(
        met,
        [
            _finding(beyond, "G3", F.concat(F.lit("<= "), F.col("last_row").cast("string")), g, F.concat(F.lit("Google_Row exceeds the last stamped Contacts row ("), F.col("last_row").cast("string"), F.lit(")"))),
            _finding(~beyond & empty, "G2", F.col("ref_id"), "(blank)", F.concat(F.lit("Contacts row "), g, F.lit(" has no Contact_ID"))),
            _finding(~beyond & (held != "") & (held != F.col("ref_id")), "G1", F.col("ref_id"), held, F.concat(F.lit("Contacts row "), g, F.lit(" holds "), held)),
        ],
    )


def _met_crm(master: DataFrame, people: DataFrame, contacts: DataFrame) -> DataFrame:
    rows = audit_rows(master).filter(F.col("attio_record_id") != "")
    look = people.select(F.col("record_id").alias("attio_record_id"), F.lit(True).alias("ok"), "name", "crm_ref_id", "job_title", F.col("company").alias("crm_company"), "all_emails")
    sheet = contacts.select(F.col("sheet_row").alias("google_row"), "first_name", "last_name", "title", "company", "primary_email", F.lit(True).alias("on_sheet"))
    out = rows.join(look, "attio_record_id", "left").join(sheet, "google_row", "left")
    out = out.withColumn("outcome", names.outcome(F.col("name"), F.col("full_name")))
    a1 = (F.col("crm_ref_id") == F.col("ref_id")) & (F.col("crm_ref_id") != "")
    ready = (F.col("location") == "BOTH") & a1 & F.col("outcome").isin("exact", "shares_word") & F.col("on_sheet").isNotNull()
    return out.withColumn("ready", F.coalesce(F.col("ok") & ready, F.lit(False)))


def crm_side(master: DataFrame, people: DataFrame, contacts: DataFrame) -> DataFrame:
    """A2-A5 and A1; a record that isn't found ends its row's checks. See ``crm_failed`` for look-ups that fail."""
    rows, ok = _met_crm(master, people, contacts), F.col("ok").isNotNull()
    crm = F.col("crm_ref_id")
    return _exploded(
        rows,
        [
            _finding(~ok, "A3", F.concat(F.lit("record "), "attio_record_id"), "(not found)", "stale pointer - record deleted or merged in Attio"),
            _finding(ok & (crm == ""), "A2", F.col("ref_id"), "(blank)", "Attio record has no crm_ref_id"),
            _finding(ok & (crm != "") & (crm != F.col("ref_id")), "A1", F.col("ref_id"), crm, "identity bridge has drifted"),
            _finding(ok & (F.col("outcome") == "zero_words"), "A5", F.col("full_name"), F.col("name"), F.concat(F.lit("zero significant words in common (crm_ref_id="), crm, F.lit(")"))),
        ],
    )


def crm_failed(master: DataFrame, lookups: DataFrame) -> DataFrame:
    """A4: rows whose record couldn't be looked up, by ``lookups(attio_record_id, lookup, error)``; the other checks don't apply to them."""
    rows = audit_rows(master).filter("attio_record_id <> ''").join(lookups, "attio_record_id")
    return _exploded(rows, [_finding(F.col("lookup") == "failed", "A4", "a successful lookup", F.col("error"), "lookup failed after retries")])


def identity_drift(master: DataFrame, people: DataFrame, contacts: DataFrame) -> DataFrame:
    rows = _met_crm(master, people, contacts).filter("ready")
    emails = cells.split_list(F.col("all_emails"))
    or_blank = lambda c: F.when(c == "", "(blank)").otherwise(c)
    absent = ~F.exists(emails, lambda e: names.norm(e) == names.norm(F.col("primary_email")))
    return _exploded(
        rows,
        [
            _finding((F.col("title") != "") & ~names.field_equal(F.col("title"), F.col("job_title")), "I1", F.col("title"), or_blank(F.col("job_title")), "Title"),
            _finding((F.col("company") != "") & ~names.field_equal(F.col("company"), F.col("crm_company")), "I1", F.col("company"), or_blank(F.col("crm_company")), "Company"),
            _finding((F.col("primary_email") != "") & absent, "I1", F.col("primary_email"), or_blank(F.array_join(emails, ", ")), "Email"),
        ],
    )


def name_candidates(master: DataFrame, people: DataFrame, contacts: DataFrame) -> DataFrame:
    rows = _met_crm(master, people, contacts).filter("ready and outcome = 'shares_word'")
    sheet = F.trim(F.concat_ws(" ", "first_name", "last_name"))
    return rows.filter(~names.field_equal(F.col("name"), sheet)).select("ref_id", F.col("name").alias("old_name"), sheet.alias("new_name"), "master_row")


def all_findings(master: DataFrame, people: DataFrame, contacts: DataFrame, blank_ids: bool = True) -> DataFrame:
    out = structural(master)
    for part in (sheet_side(master, contacts, blank_ids), crm_side(master, people, contacts), identity_drift(master, people, contacts)):
        out = out.unionByName(part)
    return out


def severity(code: Column) -> Column:
    out = F.lit(None).cast("string")
    for k, v in SEVERITY.items():
        out = F.when(code == k, v).otherwise(out)
    return out


def canonical(master: DataFrame) -> DataFrame:
    """Rows of duplicated ids: retired ones aside, the canonical row has most pointers, then the first row; others are orphans."""
    rows = master.select("master_row", F.trim("ref_id").alias("ref_id"), F.upper(F.trim("location")).alias("location"), cells.positive_int(F.col("google_row")).alias("google_row"), "attio_record_id").filter("ref_id <> ''")
    groups = rows.groupBy("ref_id").agg(F.count(F.lit(1)).alias("members")).filter("members >= 2")
    rows = rows.join(groups, "ref_id").withColumn("score", F.when(F.col("google_row") > 0, 2).otherwise(0) + F.when(F.trim("attio_record_id") != "", 2).otherwise(0))
    best = rows.filter("location <> 'SUPERSEDED'").groupBy("ref_id").agg(F.min(F.struct(-F.col("score"), F.col("master_row"))).getField("master_row").alias("best_row"))
    role = F.when(F.col("location") == "SUPERSEDED", "excluded").when(F.col("master_row") == F.col("best_row"), "canonical").otherwise("orphan")
    return rows.join(best, "ref_id", "left").select("master_row", "ref_id", "members", F.when(F.col("location") != "SUPERSEDED", F.col("score")).alias("score"), role.alias("role"))


def resync(master: DataFrame, contacts: DataFrame) -> DataFrame:
    """What each live master row's pointer should be: ok, correct, missing or ambiguous."""
    rows = audit_rows(master).filter(F.trim("ref_id") != "").select("master_row", "ref_id", "google_row")
    index = contacts.filter(F.trim("contact_id") != "").groupBy(F.col("contact_id").alias("ref_id")).agg(F.min("sheet_row").alias("sheet_row"), F.count(F.lit(1)).alias("copies"))
    met = rows.join(index, "ref_id", "left")
    action = F.when(F.col("copies").isNull(), "unresolvable_missing").when(F.col("copies") > 1, "unresolvable_duplicate").when(F.col("google_row").eqNullSafe(F.col("sheet_row")), "ok").otherwise("correct")
    return met.select("master_row", "ref_id", F.col("google_row").alias("old_row"), F.when(F.col("copies") == 1, F.col("sheet_row")).alias("new_row"), action.alias("action"))


def suppress_a(candidates: DataFrame, existing: DataFrame) -> DataFrame:
    """Conflict queue, cache policy: RESOLVED_OLD or an open row suppresses; anything else enqueues."""
    keys = ["ref_id", "old_name", "new_name"]
    held = existing.groupBy(*keys).agg(F.bool_or(F.upper(F.trim("status")) == "RESOLVED_OLD").alias("old"), F.bool_or(F.trim("status") == "").alias("open"))
    act = F.when(F.col("old"), "drop_resolved_old").when(F.col("open"), "drop_awaiting").otherwise("enqueue")
    return candidates.join(held, keys, "left").select(*keys, act.alias("action"))


def suppress_b(candidates: DataFrame, existing: DataFrame) -> DataFrame:
    """Conflict queue, audit policy: RESOLVED_NEW raises again, any other row that is there skips."""
    keys = ["ref_id", "old_name", "new_name"]
    status = F.upper(F.trim("status"))
    held = existing.select(*(F.trim(k).alias(k) for k in keys), status.alias("s")).groupBy(*keys)
    held = held.agg(F.bool_or(F.col("s") == "RESOLVED_OLD").alias("old"), F.bool_or(F.col("s") == "RESOLVED_NEW").alias("new"), F.count(F.lit(1)).alias("n"))
    act = F.when(F.col("old"), "drop_resolved_old").when(F.col("new"), "raise_again").when(F.col("n").isNotNull(), "skip_existing").otherwise("enqueue")
    trimmed = candidates.select(*(F.trim(k).alias(k) for k in keys))
    return trimmed.join(held, keys, "left").select(*keys, act.alias("action"))
