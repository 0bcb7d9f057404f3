"""Queries of model answers, closing writes and read-back; the SQL twins are written out on their own."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import audit, cadence, closing, enrichment, scoring, tasks, threads
from ..params import PARAMS as P
from . import oracle as o
from .catalog import _CACHE, C, _cache, _messages, query

NOW = "2001-08-15T03:00:00Z"

# ---- answers ----


def _parsed(view: str) -> str:
    bare = r"regexp_replace(regexp_replace(regexp_replace(answer, '^\s+|\s+$', '', 'g'), '^```(?:json)?\s*', '', 'i'), '\s*```$', '')"
    return f"SELECT *, TRY_CAST({bare} AS JSON) AS j FROM {view}"


def _typed(field: str, kind: str, word: str) -> str:
    return f"CASE WHEN coalesce(json_type(j, '$.{field}'), '') <> '{kind}' THEN '{field}: expected {word}' END"


def _chosen(field: str, choices: str) -> str:
    return f"CASE WHEN coalesce(json_type(j, '$.{field}'), '') <> 'VARCHAR' OR json_extract_string(j, '$.{field}') NOT IN ({choices}) THEN '{field}: not one of the choices' END"


_STRINGS = ["running_summary", "key_commitments", "company_intel", "pipeline_signals", "brain_notes", "response_draft", "personal_notes_extract", "topics_of_interest_extract", "conversation_trigger_extract"]
_S = {f: _typed(f, "VARCHAR", "string") for f in _STRINGS}
_ISSUES = [
    _S["running_summary"], _S["key_commitments"], _typed("personal_details_flag", "BOOLEAN", "boolean"), _S["company_intel"], _S["pipeline_signals"], _S["brain_notes"],
    _chosen("action_required", "'REPLY_NEEDED', 'ACTION_ITEM', 'FYI_ONLY', 'NO_ACTION'"),
    _chosen("outcome", "'Positive', 'Neutral', 'No Response', 'Negative', 'Declined', 'Opportunity Emerging', 'Meeting Booked', 'Advocate Signal', 'Needs Nurture'"),
    _S["response_draft"], _typed("tasks", "ARRAY", "array"), _typed("ready_to_archive", "BOOLEAN", "boolean"), _S["personal_notes_extract"], _S["topics_of_interest_extract"], _S["conversation_trigger_extract"],
]
_BOOLEAN = ("personal_details_flag", "ready_to_archive")
_ITEM = ", ".join(f"CASE WHEN coalesce(json_type(x, '$.{f}'), '') <> 'VARCHAR' THEN 'tasks.' || (i - 1) || '.{f}: expected string' END" for f in ("description", "due_date", "priority"))
_ITEMS = f"flatten(list_transform(CASE WHEN json_type(j, '$.tasks') = 'ARRAY' THEN from_json(json_extract(j, '$.tasks'), '[\"JSON\"]') ELSE [] END, lambda x, i: CASE WHEN json_type(x) <> 'OBJECT' THEN ['tasks.' || (i - 1) || ': expected object'] ELSE [{_ITEM}] END))"


def _error(issues: str) -> str:
    return f"CASE WHEN j IS NULL THEN 'not valid JSON' WHEN json_type(j) <> 'OBJECT' THEN 'expected object' ELSE nullif(array_to_string(list_filter({issues}, lambda e: e IS NOT NULL), '; '), '') END"


_ANSWER_ERROR = _error(f"list_concat([{', '.join(_ISSUES)}], {_ITEMS})")
_EVIDENCE_ISSUES = [_typed("has_evidence", "BOOLEAN", "boolean"), _typed("evidence_activity_id", "VARCHAR", "string"), _typed("evidence_quote", "VARCHAR", "string"), _chosen("confidence", "'high', 'medium', ''"), _typed("brain_reasoning", "VARCHAR", "string")]
_ACROSS = "nullif(concat_ws('; ', " + ", ".join(f"CASE WHEN json_extract_string(j, '$.has_evidence') = 'true' AND json_extract_string(j, '$.{f}') = '' THEN '{f}: must be set when has_evidence is true' END" for f in ("confidence", "evidence_activity_id")) + "), '')"
o.RELATIONS["o_answers"] = (
    f"SELECT thread_id, direction, error, {', '.join(f'''CASE WHEN error IS NULL THEN json_extract_string(j, '$.{f}') END AS {f}''' for f in [*_STRINGS, 'action_required', 'outcome'])}, "
    f"{', '.join(f'''CASE WHEN error IS NULL THEN json_extract_string(j, '$.{f}') = 'true' END AS {f}''' for f in _BOOLEAN)}, CASE WHEN error IS NULL THEN json_extract(j, '$.tasks') END AS tasks_json FROM (SELECT *, {_ANSWER_ERROR} AS error FROM ({_parsed('v_answers')}))"
)
_OVER = "(direction = 'Outbound' AND action_required = 'REPLY_NEEDED')"
_CLEAN = {f: o.redacted(f) if f != "response_draft" else f"CASE WHEN {_OVER} THEN '' ELSE {o.redacted(f)} END" for f in _STRINGS}
_CHANGED = {f: f"{o.redacted(f)} <> {f}" if f != "response_draft" else f"NOT {_OVER} AND {o.redacted(f)} <> {f}" for f in _STRINGS}
o.RELATIONS["o_guarded"] = (
    f"SELECT * REPLACE (CASE WHEN {_OVER} THEN 'FYI_ONLY' ELSE action_required END AS action_required, {', '.join(f'{sql} AS {f}' for f, sql in _CLEAN.items())}), "
    f"concat_ws('; ', CASE WHEN {_OVER} THEN 'outbound ceiling: REPLY_NEEDED became FYI_ONLY' END, {', '.join(f'''CASE WHEN {sql} THEN 'redacted: {f}' END''' for f, sql in _CHANGED.items())}) AS warnings FROM o_answers"
)


@query("SELECT thread_id, error FROM o_answers")
def answer_errors(t):
    return enrichment.parse(t.v_answers).select("thread_id", "error")


@query("SELECT thread_id, action_required, outcome, personal_details_flag, ready_to_archive, running_summary, key_commitments, json_array_length(tasks_json) AS n_tasks, json_extract_string(tasks_json, '$[0].description') AS first_task FROM o_answers WHERE error IS NULL")
def answers_parsed(t):
    rows = enrichment.parse(t.v_answers).filter("error is null")
    return rows.select("thread_id", "action_required", "outcome", "personal_details_flag", "ready_to_archive", "running_summary", "key_commitments", F.size("tasks").alias("n_tasks"), F.get("tasks", F.lit(0)).description.alias("first_task"))


@query(f"SELECT task_id, CASE WHEN error IS NULL THEN json_extract_string(j, '$.has_evidence') = 'true' END AS has_evidence, CASE WHEN error IS NULL THEN json_extract_string(j, '$.confidence') END AS confidence, error FROM (SELECT *, coalesce({_error('[' + ', '.join(_EVIDENCE_ISSUES) + ']')}, {_ACROSS}) AS error FROM ({_parsed('v_judgements')}))")
def evidence_errors(t):
    return enrichment.evidence(t.v_judgements).select("task_id", "has_evidence", "confidence", "error")


def _guarded(t):
    return enrichment.guarded(enrichment.parse(t.v_answers))


@query("SELECT thread_id, action_required, response_draft, running_summary, pipeline_signals, warnings FROM o_guarded WHERE error IS NULL")
def answers_guarded(t):
    return _guarded(t).filter("error is null").select("thread_id", "action_required", "response_draft", "running_summary", "pipeline_signals", "warnings")


# ---- targets and result rows ----


def _contacts(t):
    """Contacts of each thread with the parsed answer: the primary and one or two others."""
    rows = t.v_resolved.join(_guarded(t).filter("error is null"), "thread_id").withColumn("day", F.lit("2001-08-14"))
    others = rows.withColumn("rank", F.explode(F.sequence(F.lit(0), F.col("others"))))
    return others.withColumns({"ref_id": F.when(C("rank") == 0, C("ref_id")).otherwise(F.concat(F.lit("REF-9000"), C("rank").cast("string"))), "tags": F.when(C("rank") == 1, "attio").otherwise(C("tags"))})


_GOOGLE = "location IN ('GOOGLE', 'BOTH') AND google_row IS NOT NULL AND NOT contains(tags, 'google')"
_CRM = "location IN ('ATTIO', 'BOTH') AND attio_record_id <> '' AND NOT contains(tags, 'attio')"
_Q = lambda x: f"to_json({x})"
_PRIMARY = (
    f"'{{\"ref_id\":' || {_Q('ref_id')} || CASE WHEN {_GOOGLE} THEN ',\"google\":{{\"google_row\":' || google_row || ',\"fields\":{{\"BZ\":\"2001-08-14\",\"CA\":\"Email\",\"CB\":' || {_Q('direction')} || ',\"CD\":' || {_Q('subject')} || ',\"CE\":' || {_Q('running_summary')} || ',\"CG\":' || {_Q('outcome')} || '}}}}' ELSE '' END"
    f" || CASE WHEN {_CRM} THEN ',\"attio\":{{\"record_id\":' || {_Q('attio_record_id')} || ',\"fields\":{{\"last_meeting_summary\":' || {_Q('running_summary')} || ',\"key_commitments\":' || {_Q('key_commitments')} || '}}}}' ELSE '' END"
    f" || CASE WHEN personal_details_flag AND personal_notes_extract || topics_of_interest_extract || conversation_trigger_extract <> '' THEN ',\"personal_context\":{{\"personal_notes_extract\":' || {_Q('personal_notes_extract')} || ',\"topics_of_interest_extract\":' || {_Q('topics_of_interest_extract')} || ',\"conversation_trigger_extract\":' || {_Q('conversation_trigger_extract')} || '}}' ELSE '' END || '}}'"
)
_NOTE = f"CASE WHEN r = 1 THEN '' WHEN {_CRM} THEN ',\"attio\":{{\"record_id\":' || {_Q('attio_record_id')} || ',\"fields\":{{\"last_meeting_summary\":' || {_Q(chr(39) + 'Also on the thread: ' + chr(39) + ' || subject')} || '}}}}' ELSE '' END"
_SECOND = "list_transform(range(1, others + 1), lambda r: '{\"ref_id\":\"REF-9000' || r || '\"' || " + _NOTE + " || '}')"
o.RELATIONS["o_targets"] = f"SELECT thread_id, '{{\"primary\":' || {_PRIMARY} || ',\"secondary\":[' || array_to_string({_SECOND}, ',') || ']}}' AS write_targets FROM v_resolved JOIN o_guarded USING (thread_id) WHERE error IS NULL AND ref_id <> ''"


@query("SELECT * FROM o_targets")
def thread_targets(t):
    return enrichment.targets(_contacts(t))


_EXTRA = "CASE WHEN TRY_CAST(thread_id AS INTEGER) % 9 = 2 THEN 'noise:cold' END"


def _stamped(t):
    """Threads with all that a result row needs; one in nine is noise."""
    n = C("thread_id").cast("int")
    rows = t.v_resolved.join(_guarded(t).filter("error is null"), "thread_id").join(enrichment.targets(_contacts(t)), "thread_id", "left")
    rows = rows.withColumns({"tag": F.when(n % 9 == 2, "noise:cold"), "primary_email": F.when(n % 7 != 3, F.concat(F.lit("guest"), C("thread_id"), F.lit("@acme.example"))), "secondaries": F.when(n % 2 == 0, F.array(F.lit("cc@dune.example"))).otherwise(F.array().cast("array<string>")), "position": n})
    blank = ("source_mailbox", "first_email_date", "email_count", "raw_emails_json", "thread_status", "parent_thread_id", "contact_history_row_id", "crm_last_synced")
    return rows.withColumns({c: F.lit("") for c in blank})


_STAMP = f"""SELECT g.thread_id, coalesce(nullif(r.ref_id, ''), '') AS ref_id, CASE WHEN {_EXTRA.replace('thread_id', 'g.thread_id')} IS NULL THEN action_required ELSE 'NO_ACTION' END AS action, CASE WHEN {_EXTRA.replace('thread_id', 'g.thread_id')} IS NULL THEN running_summary ELSE '' END AS summary,
    CASE WHEN {_EXTRA.replace('thread_id', 'g.thread_id')} IS NULL THEN brain_notes ELSE 'filtered: noise:cold' END AS brain_notes, CASE WHEN {_EXTRA.replace('thread_id', 'g.thread_id')} IS NULL THEN CAST(tasks_json AS VARCHAR) ELSE '[]' END AS tasks_json,
    CASE WHEN {_EXTRA.replace('thread_id', 'g.thread_id')} IS NULL THEN response_draft ELSE '' END AS draft, coalesce(w.write_targets, '') AS write_targets, r.contact_name, r.subject, TRY_CAST(g.thread_id AS INTEGER) AS n FROM o_guarded g JOIN v_resolved r USING (thread_id) LEFT JOIN o_targets w USING (thread_id) WHERE error IS NULL"""


@query(
    f"""SELECT thread_id, ref_id, action AS action_required, summary AS running_summary, brain_notes, tasks_json, write_targets, draft AS response_draft,
    CASE WHEN action = 'NO_ACTION' THEN '' ELSE '[' || n || '] ' || contact_name || ' — ' || subject || chr(10) || action || ' | ' || summary || CASE WHEN action = 'REPLY_NEEDED' AND draft <> '' THEN chr(10) || 'Draft: "' || draft || '"' ELSE '' END END AS notice,
    CASE WHEN action = 'REPLY_NEEDED' AND n % 7 <> 3 THEN '{{"to":["guest' || thread_id || '@acme.example"],"cc":[' || CASE WHEN n % 2 = 0 THEN '"cc@dune.example"' ELSE '' END || ']}}' ELSE '' END AS reply_recipients,
    CASE WHEN action = 'REPLY_NEEDED' AND n % 7 <> 3 THEN CASE WHEN n % 2 = 0 THEN 'group' ELSE 'individual' END ELSE '' END AS reply_mode, 30 AS cells FROM ({_STAMP})"""
)
def result_rows(t):
    rows = enrichment.result_rows(_stamped(t), P)
    cells = F.size(closing.sheet_row(rows, enrichment.RESULT))
    return rows.select("thread_id", "ref_id", "action_required", "running_summary", "brain_notes", "tasks_json", "write_targets", "response_draft", "notice", "reply_recipients", "reply_mode", cells.alias("cells"))


@query(
    """SELECT thread_id, md5('Thread direction: ' || arg_max(direction, pos) || chr(10) || chr(10) || 'Contact: Contact ' || thread_id || chr(10) || chr(10) || 'Thread messages, chronological:' || chr(10) || string_agg(
    CASE WHEN sender_email <> '' THEN 'From: ' || sender_email || chr(10) ELSE '' END || CASE WHEN recipient_email <> '' THEN 'To: ' || recipient_email || chr(10) ELSE '' END || CASE WHEN len(cc_ordered) > 0 THEN 'Cc: ' || array_to_string(cc_ordered, ', ') || chr(10) ELSE '' END
    || 'Subject: ' || subject || chr(10) || chr(10) || body, chr(10) ORDER BY pos)) AS prompt_md5 FROM o_msgs GROUP BY thread_id"""
)
def thread_prompts(t):
    rows = _messages(t).withColumn("contact_name", F.concat(F.lit("Contact "), C("thread_id")))
    return enrichment.prompt(rows).select("thread_id", F.md5("prompt").alias("prompt_md5"))


@query(
    """SELECT k.cluster_key, 'Task request: ' || k.description || chr(10) || 'Contact: ' || k.contact_name || chr(10) || 'Task created: ' || k.earliest_created_at || chr(10) ||
    CASE WHEN len(k.task_ids) > 1 THEN '(This request was logged ' || len(k.task_ids) || ' times across channels — treated as one request.)' || chr(10) ELSE '' END || chr(10) ||
    coalesce('Candidate interactions since the task was created:' || chr(10) || c.shown, 'No candidate interactions to review.') AS prompt
    FROM o_clusters k LEFT JOIN (SELECT contact_id AS key, string_agg('Activity_ID: ' || activity_id || chr(10) || CASE WHEN subject <> '' THEN 'Subject: ' || subject || chr(10) ELSE '' END || 'Body: ' || body, chr(10) || chr(10) ORDER BY activity_id) AS shown FROM v_activity WHERE channel = 'purchase' GROUP BY 1) c ON c.key = k.contact_id"""
)
def request_prompts(t):
    groups = tasks.clusters(t.v_tasks).select("cluster_key", "contact_id", "contact_name", "description", C("earliest_created_at").alias("created"), F.size("task_ids").alias("n_tasks"))
    seen = t.v_activity.filter("channel = 'purchase'").select("contact_id", "activity_id", "subject", "body").join(groups.select("cluster_key", "contact_id"), "contact_id")
    return enrichment.request_prompt(groups, seen)


# ---- verdicts ----


def _judged(t):
    """Clusters, their candidates, and answers: those sure of themselves name a candidate, the others an id of their own."""
    groups = tasks.clusters(t.v_tasks)
    seen = t.v_activity.filter("channel = 'purchase'").select("contact_id", "activity_id", "ts_text").join(groups.select("cluster_key", "contact_id"), "contact_id").select("cluster_key", "activity_id", "ts_text")
    said = enrichment.evidence(t.v_judgements).join(groups.select("cluster_key", F.get("task_ids", F.lit(0)).alias("task_id")), "task_id")
    first = seen.groupBy("cluster_key").agg(F.min("activity_id").alias("first"))
    said = said.join(first, "cluster_key", "left").withColumn("evidence_activity_id", F.when(C("confidence") == "high", C("first")).otherwise(C("evidence_activity_id")))
    return tasks.reconciled(groups, seen, said.drop("task_id", "first"), P.today)


_SAID = f"""SELECT k.cluster_key, k.latest_due, s.n > 0 AS asked, s.first, a.task_id IS NOT NULL AS told, a.error, a.has_evidence, a.quote, a.confidence, CASE WHEN a.confidence = 'high' THEN s.first ELSE a.id END AS id, s.n FROM o_clusters k
LEFT JOIN (SELECT k.cluster_key, min(activity_id) AS first, count(*) AS n FROM o_clusters k JOIN v_activity v ON v.contact_id = k.contact_id AND v.channel = 'purchase' GROUP BY 1) s ON s.cluster_key = k.cluster_key
LEFT JOIN (SELECT task_id, error, CASE WHEN error IS NULL THEN json_extract_string(j, '$.has_evidence') = 'true' END AS has_evidence, CASE WHEN error IS NULL THEN json_extract_string(j, '$.evidence_quote') END AS quote, CASE WHEN error IS NULL THEN json_extract_string(j, '$.confidence') END AS confidence,
    CASE WHEN error IS NULL THEN json_extract_string(j, '$.evidence_activity_id') END AS id FROM (SELECT *, coalesce({_error('[' + ', '.join(_EVIDENCE_ISSUES) + ']')}, {_ACROSS}) AS error FROM ({_parsed('v_judgements')}))) a ON a.task_id = k.task_ids[1]"""
o.RELATIONS["o_judged"] = f"""SELECT p.*, v.seen_at FROM ({_SAID}) p LEFT JOIN (SELECT k.cluster_key, v.activity_id, min(v.ts_text) AS seen_at FROM o_clusters k JOIN v_activity v ON v.contact_id = k.contact_id AND v.channel = 'purchase' GROUP BY 1, 2) v ON v.cluster_key = p.cluster_key AND v.activity_id = p.id"""
_PROBLEM = "CASE WHEN asked AND error IS NOT NULL THEN error WHEN asked AND has_evidence IS NULL THEN 'no answer' WHEN asked AND has_evidence AND seen_at IS NULL THEN 'evidence isn''t a candidate: ' || id END"
_LATE = f"coalesce({o.TODAY} - latest_due > 7, false)"
_PICK = lambda a, b, c: f"CASE WHEN problem IS NOT NULL THEN '' WHEN asked AND has_evidence THEN {a} WHEN {_LATE} THEN {b} ELSE {c} END"
o.RELATIONS["o_reconciled"] = (
    f"SELECT cluster_key, CASE WHEN problem IS NULL THEN {_PICK(chr(39) + 'LIKELY_HANDLED_EVIDENCE' + chr(39), chr(39) + 'LIKELY_STALE_NO_EVIDENCE' + chr(39), chr(39) + 'GENUINELY_OPEN' + chr(39))} END AS verdict, {_PICK('quote', chr(39) * 2, chr(39) * 2)} AS evidence_quote, {_PICK('id', chr(39) * 2, chr(39) * 2)} AS evidence_source, "
    f"{_PICK('substr(seen_at, 1, 10)', 'strftime(latest_due, ' + chr(39) + '%Y-%m-%d' + chr(39) + ')', chr(39) * 2)} AS proposed_completion_date, {_PICK('CASE WHEN confidence = ' + chr(39) * 2 + ' THEN ' + chr(39) + 'medium' + chr(39) + ' ELSE confidence END', chr(39) + 'low' + chr(39), chr(39) * 2)} AS confidence, problem AS error FROM (SELECT *, {_PROBLEM} AS problem FROM o_judged)"
)


@query("SELECT * FROM o_reconciled")
def reconciled_verdicts(t):
    return _judged(t)


@query(
    "SELECT cluster_key, recon_id, old_verdict <> coalesce(verdict, '') OR '' <> evidence_quote OR '' <> confidence OR '' <> proposed_completion_date AS material FROM (SELECT k.cluster_key, q.recon_id, q.verdict AS old_verdict, row_number() OVER (PARTITION BY k.cluster_key ORDER BY q.sheet_row) AS rn "
    f"FROM o_clusters k, unnest(k.task_ids) AS u(task_id) JOIN (SELECT *, unnest({o.split_list('source_task_ids')}) AS tid FROM v_recon WHERE status = '') q ON q.tid = u.task_id) JOIN o_reconciled USING (cluster_key) WHERE rn = 1"
)
def material_changes(t):
    blank = [F.lit("").alias(c) for c in tasks.MATERIAL[1:]]
    held = tasks.supersede_targets(tasks.clusters(t.v_tasks), t.v_recon).select("cluster_key", "recon_id", F.struct(C("old_verdict").alias("verdict"), *blank).alias("old"))
    new = _judged(t).select("cluster_key", F.struct(F.coalesce("verdict", F.lit("")).alias("verdict"), *tasks.MATERIAL[1:]).alias("new"))
    return held.join(new, "cluster_key").select("cluster_key", "recon_id", tasks.material("old", "new").alias("material"))


@query("SELECT crm_ref_id, total, CASE WHEN crm_ref_id = '' THEN 'inconclusive' WHEN total % 2 = 0 THEN 'agrees' ELSE 'mismatch' END AS state FROM (SELECT crm_ref_id, count(*) AS total FROM v_people GROUP BY 1)")
def enumeration_states(t):
    rows = t.v_people.groupBy("crm_ref_id").agg(F.count(F.lit(1)).alias("total"))
    served = F.when(C("crm_ref_id") != "", C("total") - F.when(C("total") % 2 == 0, 1).otherwise(0))
    return rows.select("crm_ref_id", "total", scoring.cross_check(C("total"), served, F.lit(1)).alias("state"))


# ---- closing ----


def _decided(t):
    rows = t.v_resolved.join(_guarded(t).filter("error is null").withColumnRenamed("warnings", "_w"), "thread_id")
    return closing.decided(rows, cadence.master_index(t.v_master), P)


_SAFE = lambda x: f"CASE WHEN {o.category(x)} IS NULL THEN {x} ELSE '' END"
_TASKS = "from_json(tasks_json, '[{\"description\":\"VARCHAR\",\"due_date\":\"VARCHAR\",\"priority\":\"VARCHAR\"}]')"
_DUE = f"list_sort(list_filter(list_transform({_TASKS}, lambda t: {{'due': {o.flex('t.due_date')}, 'what': t.description}}), lambda t: t.due IS NOT NULL))[1]"
_HIT = lambda x, f: f"'Sensitive data (' || {o.category(x)} || ') detected in {f} — field skipped, not written. Review and correct the source content.'"
o.RELATIONS["o_decided"] = f"""
SELECT * REPLACE ({_SAFE("running_summary")} AS running_summary), CASE WHEN google_ok AND attio_ok THEN 'BOTH' WHEN google_ok THEN 'GOOGLE' WHEN attio_ok THEN 'ATTIO' ELSE '' END AS side,
    concat_ws('; ', CASE WHEN google_row IS NOT NULL AND NOT google_ok THEN 'google row isn''t this contact''s' END, CASE WHEN attio_record_id <> '' AND NOT attio_ok THEN 'record isn''t this contact''s' END,
        CASE WHEN trim(last_email_date) <> '' AND day = '' THEN 'date of the last mail can''t be read' END, {_HIT("subject", "subject")}, {_HIT("running_summary", "summary")}) AS said,
    coalesce(strftime(first.due, '%Y-%m-%d'), '') AS next_day, coalesce(first.what, '') AS next_note
FROM (SELECT r.*, g.running_summary, g.outcome, g.direction, g.tasks_json, 'ACT-{P.run_ms}-' || r.sheet_row AS activity_id, coalesce(r.google_row = i.google_row, false) AS google_ok, coalesce(r.attio_record_id <> '' AND r.attio_record_id = i.attio_record_id, false) AS attio_ok,
    {o.day_text(o.flex("r.last_email_date"))} AS day, {_DUE} AS first FROM v_resolved r JOIN o_guarded g USING (thread_id) LEFT JOIN o_index i ON i.ref_id = r.ref_id WHERE g.error IS NULL)"""


@query(
    f"SELECT activity_id, [activity_id, '{NOW}', ref_id, '', contact_name, 'Email', 'Email', direction, subject, running_summary, '', '', '', CASE WHEN google_ok AND outcome <> '' THEN outcome ELSE 'Neutral' END, next_day, next_note, 'late_edition', 'resolve handler', side, '', '', day] AS cells, said AS warnings FROM o_decided"
)
def closing_activity_rows(t):
    rows = _decided(t)
    return closing.activity_rows(rows, NOW).join(rows.select("activity_id", "warnings"), "activity_id")


@query(
    f"SELECT activity_id, 'contact' AS sheet, [CASE WHEN day <> '' THEN day ELSE '{P.today}' END, 'Email', direction, '', subject, running_summary, '', outcome] AS cells FROM o_decided WHERE google_ok "
    f"UNION ALL SELECT activity_id, 'history', ['', ref_id, contact_name, '{NOW}', 'Email', 'Email', direction, subject, running_summary, '', '', '', '', '', '', 'Late_Edition', activity_id] FROM o_decided"
)
def closing_blocks(t):
    rows = _decided(t)
    contact = closing.contact_blocks(rows, P.today).select("activity_id", F.lit("contact").alias("sheet"), "cells")
    return contact.unionByName(closing.history_rows(rows, NOW).select("activity_id", F.lit("history").alias("sheet"), "cells"))


_EACH = f"(SELECT d.*, i, {_TASKS}[i] AS task, activity_id || '-' || i AS task_id FROM o_decided d, unnest(range(1, CAST(json_array_length(tasks_json) AS BIGINT) + 1)) AS u(i))"


@query(f"SELECT task_id, [task_id, '{NOW}', ref_id, '', contact_name, 'Follow-up', task.description, task.due_date, 'Open', CASE WHEN task.priority = '' THEN 'Medium' ELSE task.priority END, 'owner', '', activity_id] AS cells FROM {_EACH}")
def closing_tasks(t):
    return closing.task_rows(_decided(t), NOW)


@query(
    f"""SELECT task_id, '{{"data":{{"content":' || to_json(task.description) || ',"format":"plaintext","deadline_at":' || CASE WHEN task.due_date = '' THEN 'null' ELSE to_json(task.due_date) END || ',"is_completed":false,"linked_records":[{{"target_object":"people","target_record_id":' || to_json(attio_record_id) ||
    '}}],"assignees":[{{"referenced_actor_type":"workspace-member","referenced_actor_id":"owner"}}]}}}}' AS payload FROM {_EACH} WHERE attio_ok"""
)
def task_creation_plan(t):
    return closing.task_payloads(_decided(t))


@query("SELECT thread_id, CASE WHEN side = '' AND (google_row IS NOT NULL OR attio_record_id <> '') THEN '[WITHHELD: ' || said || '] note' WHEN side <> 'BOTH' AND google_row IS NOT NULL AND attio_record_id <> '' THEN '[PARTIAL: ' || said || '] note' ELSE 'note' END AS note, CASE WHEN subject LIKE '%3' THEN '[2001-08-15 LE] ' || next_note ELSE subject || chr(10) || '[2001-08-15 LE] ' || next_note END AS dated FROM o_decided")
def withheld_notes(t):
    rows = _decided(t)
    before = F.when(C("subject").endswith("3"), "").otherwise(C("subject"))
    return rows.select("thread_id", closing.withheld_marker(F.lit("note"), C("warnings")).alias("note"), closing.dated_note(before, C("next_note"), P.today).alias("dated"))


def _checks(t):
    """What was to be written and what two reads gave: fields differ by thread."""
    n = C("thread_id").cast("int")
    rows = t.v_resolved.select("thread_id", "subject", n.alias("n"))
    fields = F.array(*(F.struct(F.lit(f).alias("field"), F.lit(bearing).alias("load_bearing"), F.lit(k).alias("k")) for f, bearing, k in (("activity", True, 4), ("contact", True, 6), ("history", True, 9), ("notes", False, 5))))
    rows = rows.withColumn("f", F.explode(fields)).select("thread_id", "subject", "n", "f.*")
    first = F.when(C("n") % C("k") == 0, F.lit(None).cast("string")).otherwise(C("subject"))
    second = F.when((C("n") % C("k") == 0) & (C("n") % 3 == 0), "other").otherwise(C("subject"))
    return rows.select("thread_id", "field", "load_bearing", C("subject").alias("expected"), first.alias("first"), second.alias("second"))


_BAD = lambda k: f"(n % {k} = 0)"
_CHECK = lambda f, k: f"CASE WHEN {_BAD(k)} THEN CASE WHEN n % 3 = 0 THEN 'mismatch: {f}' ELSE 'corrected once: {f}' END END"


@query(
    f"""SELECT thread_id, NOT (n % 3 = 0 AND ({_BAD(4)} OR {_BAD(6)} OR {_BAD(9)})) AS closed, CASE WHEN n % 3 = 0 THEN 0 ELSE CAST({_BAD(4)} AS INT) + CAST({_BAD(6)} AS INT) + CAST({_BAD(9)} AS INT) END AS corrections,
    concat_ws('; ', {_CHECK('activity', 4)}, {_CHECK('contact', 6)}, {_CHECK('history', 9)}, CASE WHEN n % 5 = 0 AND n % 3 = 0 THEN 'note (non-blocking): notes' END) AS warnings FROM (SELECT thread_id, CAST(thread_id AS INT) AS n FROM v_resolved)"""
)
def read_back_verdicts(t):
    return closing.read_back(_checks(t))


@query("SELECT 'mismatch' AS outcome, count(*) AS written, count(*) FILTER (WHERE status <> 'Done') AS read, min(CASE WHEN status = 'Done' THEN sheet_row END) AS first_row FROM v_tasks")
def write_verdict(t):
    rows = t.v_tasks.select(C("sheet_row").alias("position"), C("task_id").alias("id"), "status")
    return closing.written_in_order(rows.select("position", "id"), rows.select("position", F.when(C("status") == "Done", "").otherwise(C("id")).alias("id")))


_LOOK = "CASE WHEN attio_record_id = '' THEN NULL WHEN master_row % 11 = 3 THEN 500 WHEN master_row % 13 = 5 THEN 404 WHEN master_row % 17 = 2 THEN NULL ELSE 200 END"


o.RELATIONS["o_lookups"] = f"SELECT attio_record_id, CASE WHEN status IS NULL THEN 'failed' WHEN status = 404 THEN 'not_found' WHEN status >= 400 THEN 'failed' ELSE 'found' END AS lookup, CASE WHEN status IS NULL THEN 'no result' WHEN status >= 400 AND status <> 404 THEN 'server said 500' END AS error FROM (SELECT attio_record_id, {_LOOK} AS status FROM (SELECT attio_record_id, min(master_row) AS master_row FROM v_master WHERE attio_record_id <> '' GROUP BY 1))"


@query("SELECT * FROM o_lookups")
def failed_lookups(t):
    wanted = t.v_master.filter("attio_record_id <> ''").groupBy("attio_record_id").agg(F.min("master_row").alias("n"))
    status = F.when(C("n") % 11 == 3, 500).when(C("n") % 13 == 5, 404).when(C("n") % 17 == 2, F.lit(None).cast("int")).otherwise(200)
    answers = wanted.select("attio_record_id", status.alias("status"), F.when(status == 500, "server said 500").alias("error")).filter("status is not null")
    return closing.looked_up(wanted.select("attio_record_id"), answers, "attio_record_id").select("attio_record_id", "lookup", "error")


@query(o.finding("o_audit a JOIN o_lookups l USING (attio_record_id)", "A4", "lookup = 'failed'", "'a successful lookup'", "error", "'lookup failed after retries'"))
def audit_failed_lookups(t):
    return audit.crm_failed(t.v_master, failed_lookups(t))


@query("SELECT count(*) AS keys, count(*) FILTER (WHERE status IS NULL) AS silent FROM (SELECT attio_record_id, 1 AS status FROM v_master WHERE attio_record_id <> '' GROUP BY 1)")
def paced_batches(t):
    wanted = t.v_master.filter("attio_record_id <> ''").select("attio_record_id").distinct()
    return closing.batches(wanted, "attio_record_id", 40, 1000).agg(F.count(F.lit(1)).alias("keys"), F.count_if(F.expr("start_ms <> batch * 1000 or batch < 0")).alias("silent"))


@query("SELECT n, CASE WHEN n % 4 = 1 THEN 'response without an updates block: unverifiable' WHEN n % 4 = 2 THEN 'updates block without a count: unverifiable' WHEN n % 4 = 3 THEN '0 rows written' END AS why FROM (SELECT CAST(c_custkey AS BIGINT) AS n FROM customer)")
def append_failures(t):
    n = C("c_custkey").cast("bigint")
    return t.customer.select(n.alias("n"), closing.failed_append(n % 4 != 1, n % 4 != 2, F.when(n % 4 == 3, 0).otherwise(1)).alias("why"))


@query("SELECT master_row, split_part(trim(full_name), ' ', 1) AS first, CASE WHEN contains(trim(full_name), ' ') THEN substr(trim(full_name), strpos(trim(full_name), ' ') + 1) ELSE '' END AS last, concat_ws(', ', nullif(trim(location), ''), nullif(trim(notes), ''), nullif(trim(ref_id), '')) AS place, CASE WHEN location IN ('Social', 'Context', 'Activation') THEN location END AS mode FROM v_master")
def names_and_places(t):
    first, last = text.full_name(C("full_name"))
    return t.v_master.select("master_row", first.alias("first"), last.alias("last"), text.location(C("location"), C("notes"), C("ref_id")).alias("place"), text.touch_mode(C("location")).alias("mode"))


@query(f"SELECT ref_id, [ref_id, record_id, name, title, company, email, '', '', '', '', '', '', '', '', '', upper(CAST(stale AS VARCHAR)), '', ''] AS cells FROM ({_CACHE})")
def cache_rows(t):
    rows = _cache(t).select("ref_id", "record_id", "name", "title", "company", "email", "stale")
    return rows.select("ref_id", closing.sheet_row(rows, closing.CACHE_ROW).alias("cells"))


@query("SELECT task_id, ['', '', '', '', contact_id, contact_name, description, '', '', '', '', '', '', status, ''] AS cells FROM v_tasks")
def review_rows(t):
    rows = t.v_tasks.select("task_id", "contact_id", "contact_name", "description", "status")
    return rows.select("task_id", closing.sheet_row(rows, closing.REVIEW_ROW).alias("cells"))


@query("SELECT thread_id, CASE WHEN n % 7 = 3 THEN '' WHEN n % 2 = 0 THEN 'group' ELSE 'individual' END AS mode, CASE WHEN n % 7 <> 3 THEN 'guest@acme.example' END AS recipient FROM (SELECT thread_id, CAST(thread_id AS INT) AS n FROM v_resolved)")
def reply_modes(t):
    n = C("thread_id").cast("int")
    others = F.when(n % 2 == 0, F.array(F.lit("cc@dune.example"))).otherwise(F.array().cast("array<string>"))
    rows = t.v_resolved.select("thread_id", threads.reply_recipients(F.when(n % 7 != 3, "guest@acme.example"), others).alias("r"))
    return rows.select("thread_id", "r.mode", C("r.to").alias("recipient"))
