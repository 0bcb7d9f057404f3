"""What a model returns for a thread: the schema of its answer, guards on it, and the rows made from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import pii
from ..params import Params

#: Fields and choices of an answer, in the order of the schema.
STRING, BOOLEAN, TASKS = "string", "boolean", "tasks"
ACTIONS = ("REPLY_NEEDED", "ACTION_ITEM", "FYI_ONLY", "NO_ACTION")
OUTCOMES = ("Positive", "Neutral", "No Response", "Negative", "Declined", "Opportunity Emerging", "Meeting Booked", "Advocate Signal", "Needs Nurture")
CONFIDENCES = ("high", "medium", "")
ANSWER = {
    "running_summary": STRING, "key_commitments": STRING, "personal_details_flag": BOOLEAN, "company_intel": STRING, "pipeline_signals": STRING, "brain_notes": STRING, "action_required": ACTIONS,
    "outcome": OUTCOMES, "response_draft": STRING, "tasks": TASKS, "ready_to_archive": BOOLEAN, "personal_notes_extract": STRING, "topics_of_interest_extract": STRING, "conversation_trigger_extract": STRING,
}
TASK = ("description", "due_date", "priority")
EVIDENCE = {"has_evidence": BOOLEAN, "evidence_activity_id": STRING, "evidence_quote": STRING, "confidence": CONFIDENCES, "brain_reasoning": STRING}
#: Free text that is redacted before it goes anywhere.
GUARDED = ("running_summary", "key_commitments", "company_intel", "pipeline_signals", "brain_notes", "response_draft", "personal_notes_extract", "topics_of_interest_extract", "conversation_trigger_extract")


def unfenced(answer: Column) -> Column:
    """A model's answer without the fence that models like to put around JSON."""
    bare = F.regexp_replace(answer, r"^\s+|\s+$", "")
    return F.regexp_replace(F.regexp_replace(bare, r"(?i)^```(?:json)?\s*", ""), r"\s*```$", "")


def _kind(v: Column, path: str) -> Column:
    """JSON type of what stands there: STRING, BOOLEAN, ARRAY<...>, OBJECT<...>, VOID for null; null where nothing stands."""
    return F.schema_of_variant(F.try_variant_get(v, path, "variant"))


def _issue(v: Column, field: str, kind) -> Column:
    """What is wrong with a field, or null."""
    found = _kind(v, f"$.{field}")
    if kind == TASKS:
        return F.when(~F.coalesce(found.startswith("ARRAY"), F.lit(False)), f"{field}: expected array")
    if kind == BOOLEAN:
        return F.when(~F.coalesce(found == "BOOLEAN", F.lit(False)), f"{field}: expected boolean")
    wrong = ~F.coalesce(found == "STRING", F.lit(False))
    if kind == STRING:
        return F.when(wrong, f"{field}: expected string")
    return F.when(wrong | ~F.coalesce(F.try_variant_get(v, f"$.{field}", "string").isin(*kind), F.lit(False)), f"{field}: not one of the choices")


def _task_issues(v: Column) -> Column:
    items = F.coalesce(F.when(_kind(v, "$.tasks").startswith("ARRAY"), F.try_variant_get(v, "$.tasks", "array<variant>")), F.array().cast("array<variant>"))

    def of(item: Column, i: Column) -> Column:
        at = F.concat(F.lit("tasks."), i.cast("string"))
        is_object = F.coalesce(F.schema_of_variant(item).startswith("OBJECT"), F.lit(False))
        fields = [F.when(~F.coalesce(_kind(item, f"$.{f}") == "STRING", F.lit(False)), F.concat(at, F.lit(f".{f}: expected string"))) for f in TASK]
        return F.when(~is_object, F.array(F.concat(at, F.lit(": expected object")))).otherwise(F.array_compact(F.array(*fields)))

    return F.flatten(F.transform(items, of))


def checked(answer: Column, schema: dict) -> tuple[Column, Column]:
    """(value, error): the answer as a variant, and all that is wrong with it, '; ' between; null if nothing is."""
    v = F.try_parse_json(unfenced(answer))
    issues = F.array_compact(F.array(*(_issue(v, f, kind) for f, kind in schema.items())))
    if TASKS in schema.values():
        issues = F.concat(issues, _task_issues(v))
    is_object = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    error = F.when(v.isNull(), "not valid JSON").when(~is_object, "expected object").when(F.size(issues) > 0, F.array_join(issues, "; "))
    return v, error


def parse(answers: DataFrame) -> DataFrame:
    """``answers(thread_id, answer, ...)`` with the schema's fields, null where ``error`` says why."""
    v, error = checked(F.col("answer"), ANSWER)
    rows = answers.withColumns({"_v": v, "error": error})
    kinds = {BOOLEAN: "boolean", TASKS: "array<struct<description string, due_date string, priority string>>"}
    fields = {f: F.when(F.col("error").isNull(), F.try_variant_get("_v", f"$.{f}", kinds.get(kind, "string"))) for f, kind in ANSWER.items()}
    return rows.withColumns(fields).drop("_v", "answer")


def evidence(answers: DataFrame) -> DataFrame:
    """A model's word on whether a request was handled; whoever says so must name the evidence and its confidence."""
    v, error = checked(F.col("answer"), EVIDENCE)
    said = {f: F.try_variant_get(v, f"$.{f}", "boolean" if kind == BOOLEAN else "string") for f, kind in EVIDENCE.items()}
    across = F.array_compact(F.array(*(F.when(said["has_evidence"] & (said[f] == ""), f"{f}: must be set when has_evidence is true") for f in ("confidence", "evidence_activity_id"))))
    whole = F.coalesce(error, F.when(F.size(across) > 0, F.array_join(across, "; ")))
    rows = answers.withColumn("error", whole)
    return rows.withColumns({f: F.when(F.col("error").isNull(), c) for f, c in said.items()}).drop("answer")


def guarded(rows: DataFrame) -> DataFrame:
    """Parsed answers after the outbound ceiling (no reply is due on one's own last word, so the draft goes too) and redaction.

    ``warnings`` names what was changed, in order; rows with an error pass unchanged.
    """
    over = F.coalesce((F.col("direction") == "Outbound") & (F.col("action_required") == "REPLY_NEEDED"), F.lit(False))
    rows = rows.withColumn("_over", over)
    rows = rows.withColumns({"action_required": F.when(F.col("_over"), "FYI_ONLY").otherwise(F.col("action_required")), "response_draft": F.when(F.col("_over"), "").otherwise(F.col("response_draft"))})
    rows = rows.withColumns({f"_{f}": pii.redact(F.col(f)) for f in GUARDED})
    notes = [F.when(F.col("_over"), "outbound ceiling: REPLY_NEEDED became FYI_ONLY"), *(F.when(F.col(f"_{f}") != F.col(f), f"redacted: {f}") for f in GUARDED)]
    rows = rows.withColumn("warnings", F.array_join(F.array_compact(F.array(*notes)), "; "))
    return rows.withColumns({f: F.col(f"_{f}") for f in GUARDED}).drop("_over", *(f"_{f}" for f in GUARDED))


# ---- where a result goes ----


def _has(side: str, pointer: str) -> Column:
    return F.coalesce(F.col("location").isin(side.upper(), "BOTH") & F.col(pointer).isNotNull() & (F.col(pointer).cast("string") != ""), F.lit(False)) & (F.instr(F.coalesce("tags", F.lit("")), side) == 0)


def targets(rows: DataFrame) -> DataFrame:
    """JSON of where a thread's result goes: its primary contact with either side's fields, and the others with a role note.

    ``rows``: one for each contact of a thread (``rank`` 0: primary) with its pointers, drift tags and the parsed answer.
    A side is left out where the location doesn't claim it or it has drifted; a contact without id is left out; a thread
    whose primary has none gets no targets. Contacts of a thread are few.
    """
    google = F.struct(
        F.col("google_row"),
        F.struct(F.col("day").alias("BZ"), F.lit("Email").alias("CA"), F.col("direction").alias("CB"), F.col("subject").alias("CD"), F.col("running_summary").alias("CE"), F.col("outcome").alias("CG")).alias("fields"),
    )
    attio = F.struct(F.col("attio_record_id").alias("record_id"), F.struct(F.col("running_summary").alias("last_meeting_summary"), F.col("key_commitments")).alias("fields"))
    extracts = ("personal_notes_extract", "topics_of_interest_extract", "conversation_trigger_extract")
    personal = F.when(F.col("personal_details_flag") & (F.concat(*extracts) != ""), F.struct(*extracts))
    primary = F.struct("ref_id", F.when(_has("google", "google_row"), google).alias("google"), F.when(_has("attio", "attio_record_id"), attio).alias("attio"), personal.alias("personal_context"))
    note = F.struct(F.col("attio_record_id").alias("record_id"), F.struct(F.concat(F.lit("Also on the thread: "), F.col("subject")).alias("last_meeting_summary")).alias("fields"))
    secondary = F.struct("rank", F.struct("ref_id", F.when(_has("attio", "attio_record_id"), note).alias("attio")).alias("s"))
    known = F.coalesce(F.col("ref_id"), F.lit("")) != ""
    out = rows.groupBy("thread_id").agg(F.max(F.when((F.col("rank") == 0) & known, primary)).alias("primary"), F.array_sort(F.collect_list(F.when((F.col("rank") > 0) & known, secondary))).alias("s"))
    return out.filter("primary is not null").select("thread_id", F.to_json(F.struct("primary", F.transform("s", lambda x: x.s).alias("secondary"))).alias("write_targets"))


# ---- texts ----


def prompt(messages: DataFrame) -> DataFrame:
    """(thread_id, prompt): direction, contact and the thread's messages in order, as the model reads them. Messages of a thread are few."""
    line = lambda label, c: F.when(c != "", F.concat(F.lit(label), c))
    one = F.concat_ws("\n", line("From: ", F.col("sender_email")), line("To: ", F.col("recipient_email")), F.when(F.size("cc") > 0, F.concat(F.lit("Cc: "), F.array_join("cc", ", "))), F.concat(F.lit("Subject: "), F.col("subject")), F.lit(""), F.col("body"))
    rows = messages.groupBy("thread_id").agg(F.array_sort(F.collect_list(F.struct("pos", one.alias("m")))).alias("ms"), F.max_by("direction", "pos").alias("direction"), F.first("contact_name").alias("contact_name"))
    contact = F.when(F.coalesce("contact_name", F.lit("")) == "", "No prior contact context available (new or unresolved contact).").otherwise(F.concat(F.lit("Contact: "), F.col("contact_name")))
    text = F.concat_ws("\n", F.concat(F.lit("Thread direction: "), F.col("direction")), F.lit(""), contact, F.lit(""), F.lit("Thread messages, chronological:"), F.array_join(F.transform("ms", lambda x: x.m), "\n"))
    return rows.select("thread_id", text.alias("prompt"))


def request_prompt(clusters: DataFrame, candidates: DataFrame) -> DataFrame:
    """(cluster_key, prompt): a request and the interactions that may have met it, by their ids."""
    block = F.concat_ws("\n", F.concat(F.lit("Activity_ID: "), F.col("activity_id")), F.when(F.coalesce("subject", F.lit("")) != "", F.concat(F.lit("Subject: "), F.col("subject"))), F.concat(F.lit("Body: "), F.col("body")))
    listed = candidates.groupBy("cluster_key").agg(F.array_sort(F.collect_list(F.struct("activity_id", block.alias("b")))).alias("cs"))
    rows = clusters.join(listed, "cluster_key", "left")
    times = F.when(F.col("n_tasks") > 1, F.concat(F.lit("(This request was logged "), F.col("n_tasks").cast("string"), F.lit(" times across channels — treated as one request.)")))
    shown = F.when(F.col("cs").isNull(), "No candidate interactions to review.").otherwise(F.concat(F.lit("Candidate interactions since the task was created:\n"), F.array_join(F.transform("cs", lambda x: x.b), "\n\n")))
    text = F.concat_ws("\n", F.concat(F.lit("Task request: "), F.col("description")), F.concat(F.lit("Contact: "), F.col("contact_name")), F.concat(F.lit("Task created: "), F.col("created")), times, F.lit(""), shown)
    return rows.select("cluster_key", text.alias("prompt"))


def notice(position: Column) -> Column:
    """A thread's block in the digest; null where nothing is to be done. An unresolved contact is marked."""
    name = F.when(F.coalesce("contact_name", F.lit("")) == "", "⚠ unresolved").otherwise(F.col("contact_name"))
    draft = F.when((F.col("action_required") == "REPLY_NEEDED") & (F.col("response_draft") != ""), F.concat(F.lit('Draft: "'), F.col("response_draft"), F.lit('"')))
    text = F.concat_ws("\n", F.concat(F.lit("["), position.cast("string"), F.lit("] "), name, F.lit(" — "), F.col("subject")), F.concat_ws(" | ", "action_required", "running_summary"), draft)
    return F.when(F.coalesce(F.col("action_required") != "NO_ACTION", F.lit(False)), text)


#: The 30 cells of a result row, in sheet order; blanks are written by later passes.
RESULT = (
    "thread_id", "ref_id", "contact_name", "source_mailbox", "direction", "subject", "first_email_date", "last_email_date", "email_count", "raw_emails_json", "running_summary", "key_commitments", "personal_details_flag", "company_intel", "thread_status",
    "ready_to_archive", "parent_thread_id", "contact_history_row_id", "crm_last_synced", "pipeline_signals", "brain_notes", "closed", "action_required", "response_draft", "tasks_json", "write_targets", "notice", "run_id", "reply_recipients", "reply_mode",
)


def result_rows(threads: DataFrame, p: Params) -> DataFrame:
    """A result row for each thread: its own cells, the guarded answer (or what a noise ``tag`` stands for), targets, notice, recipients.

    ``threads`` brings the thread's cells, the parsed answer's fields, ``tag``, ``write_targets``, ``primary_email``,
    ``secondaries`` and ``position``. A blank id falls back to the one that the targets were resolved to.
    """
    noise = F.col("tag").isNotNull()
    texts = {f: F.when(noise, "").otherwise(F.col(f)) for f in ("running_summary", "key_commitments", "company_intel", "pipeline_signals", "response_draft")}
    flags = {f: F.when(noise, F.lit(False)).otherwise(F.col(f)) for f in ("personal_details_flag", "ready_to_archive")}
    rows = threads.withColumns({**texts, **flags, "brain_notes": F.when(noise, F.concat(F.lit("filtered: "), F.col("tag"))).otherwise(F.col("brain_notes")), "action_required": F.when(noise, "NO_ACTION").otherwise(F.col("action_required"))})
    reply = (F.col("action_required") == "REPLY_NEEDED") & F.col("primary_email").isNotNull()
    recipients = F.to_json(F.struct(F.array("primary_email").alias("to"), F.col("secondaries").alias("cc")))
    rows = rows.withColumns({
        "ref_id": F.coalesce(F.nullif("ref_id", F.lit("")), F.get_json_object("write_targets", "$.primary.ref_id"), F.lit("")),
        "tasks_json": F.when(noise, "[]").otherwise(F.to_json("tasks")),
        "write_targets": F.coalesce("write_targets", F.lit("")),
        "closed": F.lit(""),
        "notice": F.coalesce(notice(F.col("position")), F.lit("")),
        "run_id": F.lit(p.run_id),
        "reply_recipients": F.when(reply, recipients).otherwise(""),
        "reply_mode": F.when(reply, F.when(F.size("secondaries") == 0, "individual").otherwise("group")).otherwise(""),
    })
    return rows.select(*RESULT)

