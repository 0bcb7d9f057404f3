"""Closing a thread: what is written for it, where, and whether it reads back.

Everything is a plan; a deployment's sinks carry it out. Ids are made of the run and the row, so a rerun makes the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, pii, text
from ..params import Params

_ALL = [chr(65 + i) for i in range(26)]


def decided(threads: DataFrame, index: DataFrame, p: Params) -> DataFrame:
    """What may be written for each of ``threads``: per side whether its claimed pointer is the id's own now, free text that
    the guard lets pass, the interaction's day, the earliest task, and warnings.

    ``threads(sheet_row, ref_id, contact_name, direction, subject, running_summary, outcome, tasks, last_email_date,
    google_row, attio_record_id)``; a null pointer claims nothing.
    """
    col = F.col
    now = index.select("ref_id", col("google_row").alias("_row"), col("attio_record_id").alias("_record"))
    met = threads.join(now, "ref_id", "left")
    met = met.withColumns({
        "activity_id": text.run_id_of("ACT", p.run_ms, col("sheet_row")),
        "google_ok": F.coalesce(col("google_row") == col("_row"), F.lit(False)),
        "attio_ok": F.coalesce((col("attio_record_id") != "") & (col("attio_record_id") == col("_record")), F.lit(False)),
        "day": dates.as_text(dates.flexible_date(col("last_email_date"))),
    })
    summary, summary_note = pii.sanitize(col("running_summary"), "summary")
    subject, subject_note = pii.sanitize(col("subject"), "subject")
    due = F.transform("tasks", lambda t: F.struct(dates.flexible_date(t.due_date).alias("due"), t.description.alias("what")))
    first = F.get(F.array_sort(F.filter(due, lambda t: t.due.isNotNull()), lambda a, b: F.when(a.due < b.due, -1).when(a.due > b.due, 1).otherwise(0)), F.lit(0))
    notes = [
        F.when(col("google_row").isNotNull() & ~col("google_ok"), "google row isn't this contact's"),
        F.when((F.coalesce("attio_record_id", F.lit("")) != "") & ~col("attio_ok"), "record isn't this contact's"),
        F.when((F.trim("last_email_date") != "") & (col("day") == ""), "date of the last mail can't be read"),
        subject_note,
        summary_note,
    ]
    return met.withColumns({
        "warnings": F.array_join(F.array_compact(F.array(*notes)), "; "),
        "running_summary": summary,
        "subject": subject,
        "next_day": F.coalesce(F.date_format(first.due, "yyyy-MM-dd"), F.lit("")),
        "next_note": F.coalesce(first.what, F.lit("")),
        "side": F.when(col("google_ok") & col("attio_ok"), "BOTH").when(col("google_ok"), "GOOGLE").when(col("attio_ok"), "ATTIO").otherwise(""),
    }).drop("_row", "_record")


def _cells(*cells) -> Column:
    return F.array(*(F.lit(c) if isinstance(c, str) else c.cast("string") for c in cells))


def _c(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def activity_rows(rows: DataFrame, now: str) -> DataFrame:
    """(activity_id, cells A to V) of the log: outcome from the sheet side where that is written, the task number left blank."""
    outcome = F.when(F.col("google_ok"), F.coalesce(F.nullif("outcome", F.lit("")), F.lit("Neutral"))).otherwise("Neutral")
    cells = _cells(_c("activity_id"), now, _c("ref_id"), "", _c("contact_name"), "Email", "Email", _c("direction"), _c("subject"), _c("running_summary"), "", "", "", outcome, _c("next_day"), _c("next_note"), "late_edition", "resolve handler", _c("side"), "", "", _c("day"))
    return rows.select("activity_id", cells.alias("cells"))


def contact_blocks(rows: DataFrame, today: str) -> DataFrame:
    """(google_row, cells BZ to CG) of contacts whose row is theirs; without a readable day the run's day stands."""
    cells = _cells(F.when(F.col("day") != "", F.col("day")).otherwise(today), "Email", _c("direction"), "", _c("subject"), _c("running_summary"), "", _c("outcome"))
    return rows.filter("google_ok").select("activity_id", "google_row", cells.alias("cells"))


def history_rows(rows: DataFrame, now: str) -> DataFrame:
    """(activity_id, cells A to Q)."""
    cells = _cells("", _c("ref_id"), _c("contact_name"), now, "Email", "Email", _c("direction"), _c("subject"), _c("running_summary"), "", "", "", "", "", "", "Late_Edition", _c("activity_id"))
    return rows.select("activity_id", cells.alias("cells"))


def _tasks(rows: DataFrame) -> DataFrame:
    some = rows.select("activity_id", "sheet_row", "ref_id", "contact_name", "attio_ok", "attio_record_id", F.posexplode("tasks").alias("at", "t"))
    said, _ = pii.sanitize(F.col("t.description"), "task")
    return some.withColumns({"said": said, "task_id": F.concat(F.col("activity_id"), F.lit("-"), (F.col("at") + 1).cast("string"))})


def task_rows(rows: DataFrame, now: str, owner: str = "owner") -> DataFrame:
    """(task_id, cells A to M): an open task for each that the thread brought."""
    priority = F.when(F.coalesce("t.priority", F.lit("")) == "", "Medium").otherwise(F.col("t.priority"))
    cells = _cells(_c("task_id"), now, _c("ref_id"), "", _c("contact_name"), "Follow-up", _c("said"), F.coalesce("t.due_date", F.lit("")), "Open", priority, owner, "", _c("activity_id"))
    return _tasks(rows).select("task_id", cells.alias("cells"))


def task_payloads(rows: DataFrame, assignee: str = "owner") -> DataFrame:
    """(task_id, payload): the CRM's task creations, for records that are the contact's; no deadline is null."""
    item = F.struct(
        F.col("said").alias("content"), F.lit("plaintext").alias("format"), F.nullif("t.due_date", F.lit("")).alias("deadline_at"), F.lit(False).alias("is_completed"),
        F.array(F.struct(F.lit("people").alias("target_object"), F.col("attio_record_id").alias("target_record_id"))).alias("linked_records"),
        F.array(F.struct(F.lit("workspace-member").alias("referenced_actor_type"), F.lit(assignee).alias("referenced_actor_id"))).alias("assignees"),
    )
    return _tasks(rows).filter("attio_ok").select("task_id", F.to_json(F.struct(item.alias("data")), {"ignoreNullFields": "false"}).alias("payload"))


def dated_note(existing: Column, extract: Column, today: str) -> Column:
    """Notes with the extract on a line of its own behind the day."""
    entry = F.concat(F.lit(f"[{today} LE] "), extract)
    return F.when(F.coalesce(existing, F.lit("")) == "", entry).otherwise(F.concat(existing, F.lit("\n"), entry))


def withheld_marker(note: Column, reasons: Column) -> Column:
    """A result's note behind a marker: PARTIAL if one side could be written, WITHHELD if none; unchanged otherwise."""
    side = F.col("side")
    claims = F.col("google_row").isNotNull().cast("int") + (F.coalesce("attio_record_id", F.lit("")) != "").cast("int")
    kind = F.when((side == "") & (claims > 0), "WITHHELD").when((side != "BOTH") & (claims == 2), "PARTIAL")
    return F.when(kind.isNull(), note).otherwise(F.concat(F.lit("["), kind, F.lit(": "), reasons, F.lit("] "), note))


def failed_append(block: Column, has_count: Column, landed: Column) -> Column:
    """Why an append counts as not landed; null if it did. Three layers can fail, and each says so."""
    return F.when(~block, "response without an updates block: unverifiable").when(~has_count, "updates block without a count: unverifiable").when(landed <= 0, "0 rows written")


# ---- reading back ----


def read_back(checks: DataFrame) -> DataFrame:
    """Of ``checks(thread_id, field, load_bearing, expected, first, second)`` whether each thread closes.

    ``first`` is what was read, ``second`` what was read after one correction. A thread closes if all its load-bearing
    fields agree by then; others only leave a note.
    """
    same = lambda c: F.col("expected").eqNullSafe(F.col(c))
    rows = checks.withColumns({"ok": same("first") | same("second"), "corrected": ~same("first")})
    kind = F.when(~F.col("load_bearing") & ~F.col("ok"), "note (non-blocking): ").when(~F.col("ok"), "mismatch: ").when(F.col("corrected") & F.col("load_bearing"), "corrected once: ")
    said = F.when(kind.isNotNull(), F.struct("field", F.concat(kind, F.col("field")).alias("w")))
    out = rows.groupBy("thread_id").agg((F.count_if(F.expr("load_bearing and not ok")) == 0).alias("closed"), F.count_if(F.expr("ok and corrected and load_bearing")).alias("corrections"), F.array_sort(F.collect_list(said)).alias("w"))
    return out.select("thread_id", "closed", "corrections", F.array_join(F.transform("w", lambda x: x.w), "; ").alias("warnings"))


def written_in_order(written: DataFrame, live: DataFrame) -> DataFrame:
    """Whether a table reads back in the order written: one row (outcome, written, read, first_row).

    ``written`` and ``live`` have ``(position, id)``; rows without an id don't count. Outcomes: verified, mismatch (with
    the first place that differs), and inconclusive where nothing could be read.
    """
    there = live.filter(F.coalesce("id", F.lit("")) != "")
    met = written.select("position", F.col("id").alias("want")).join(there.select("position", F.col("id").alias("got")), "position", "full_outer")
    sums = met.agg(F.count("want").alias("written"), F.count("got").alias("read"), F.min(F.when(~F.col("want").eqNullSafe(F.col("got")), F.col("position"))).alias("first_row"))
    outcome = F.when((F.col("read") == 0) & (F.col("written") > 0), "inconclusive").when(F.col("first_row").isNull(), "verified").otherwise("mismatch")
    return sums.select(outcome.alias("outcome"), "written", "read", "first_row")


# ---- look-ups that may fail ----


def looked_up(wanted: DataFrame, answers: DataFrame, key: str) -> DataFrame:
    """Each wanted key with what became of its look-up: found, not_found or failed (an error, or no answer at all).

    ``answers(key, status, error)`` hold the last try of each look-up; 404 is an answer.
    """
    met = wanted.join(answers.select(key, "status", "error"), key, "left")
    kind = F.when(F.col("status").isNull(), "failed").when(F.col("status") == 404, "not_found").when(F.col("status") >= 400, "failed").otherwise("found")
    return met.withColumns({"lookup": kind, "error": F.when(kind == "failed", F.coalesce("error", F.lit("no result")))})


def batches(wanted: DataFrame, key: str, size: int, pause_ms: int) -> DataFrame:
    """(key, batch, start_ms): paced batches; a batch's number comes from the key's hash, so no task ranks all keys."""
    n = F.greatest(F.ceil(F.col("_n") / size), F.lit(1))
    total = wanted.agg(F.count(F.lit(1)).alias("_n"))
    batch = F.pmod(F.xxhash64(key), n).cast("long")
    return wanted.join(F.broadcast(total), F.lit(True)).select(key, batch.alias("batch")).withColumn("start_ms", F.col("batch") * pause_ms)


# ---- rows of sheets ----

#: Cells of the pipeline cache and of the review queue, in sheet order.
CACHE_ROW = ("ref_id", "record_id", "name", "title", "company", "email", "linkedin", "tier", "linkedin_segment", "segment", "track", "stage", "next_check_in", "touch_mode", "follow_up_reason", "stale", "run_id", "generated_at")
REVIEW_ROW = ("recon_id", "run_id", "item_type", "source_task_ids", "contact_id", "contact_name", "description", "verdict", "evidence_quote", "evidence_source", "proposed_completion_date", "confidence", "reasoning", "status", "placeholder_id")


def sheet_row(rows: DataFrame, columns: tuple[str, ...]) -> Column:
    """Cells in a sheet's order; a null or a column that isn't there is a blank, booleans are TRUE and FALSE."""
    kinds = dict(rows.dtypes)
    return F.array(*(F.lit("") if c not in kinds else F.coalesce(F.upper(F.col(c).cast("string")) if kinds[c] == "boolean" else F.col(c).cast("string"), F.lit("")) for c in columns))
