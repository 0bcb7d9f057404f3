"""CRM-shaped views over the driver tables: one SQL text each, which Spark SQL and DuckDB both read.

Dirt (blank ids, duplicate pointers, drifted rows, odd dates) comes from key residues, so both engines see the same.
``{name}`` stands for a table or another view.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

BASE = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
FIRST = ("Ana", "José", "Li", "Maria", "Noël", "Omar", "Priya", "Quinn", "Søren", "Tess", "Uma", "Viktor")
LAST = ("Abe", "Björk", "Cole", "de la Cruz", "Evans", "Fischer", "García", "Hall", "Ito", "Jones", "Khan", "López", "van Moor", "Núñez", "Olsen")


def pick(key: str, values) -> str:
    return f"CASE {key} " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " END"


def padded(prefix: str, key: str) -> str:
    """The id format: five digits, more for larger numbers."""
    text = f"CAST({key} AS STRING)"
    return f"'{prefix}' || lpad({text}, CAST(greatest(5, length({text})) AS INT), '0')"


def every(n: int, at: int = 0) -> str:
    return f"c_custkey > 0 AND c_custkey % {n} = {at}"


def json_text(sql: str) -> str:
    """Braces within SQL literals spelled as characters: in a view's text they stand for tables."""
    parts = re.split(r"(\{[a-z_]+\})", sql)
    return "".join(p if i % 2 else p.replace("{", "' || chr(123) || '").replace("}", "' || chr(125) || '") for i, p in enumerate(parts))


_FIRST, _LAST = pick("c_custkey % 12", FIRST), pick("CAST(floor(c_custkey / 12) AS INT) % 15", LAST)
_DOMAIN = pick("c_custkey % 9", ("acme.example", "gmail.com", "example.com", "mail.bolt.example", "crest.example", "yahoo.com", "dune.example", "acme.example", "example.org"))
_LOCAL = (
    "CASE WHEN c_custkey % 10 = 3 THEN 'info' WHEN c_custkey % 10 = 4 THEN 'no-reply' WHEN c_custkey % 10 = 5 THEN 'billing-noreply' WHEN c_custkey % 10 = 6 THEN CAST(c_custkey AS STRING) "
    "WHEN c_custkey % 10 = 7 THEN 'Jo.Ann_' || CAST(c_custkey AS STRING) WHEN c_custkey % 10 = 8 THEN 'a1b2c3d4e5f60718' WHEN c_custkey % 10 = 9 THEN 'owner' ELSE 'pat.lee' || CAST(c_custkey AS STRING) END"
)
_EMAIL = f"CASE WHEN c_custkey % 29 = 7 THEN '' ELSE {_LOCAL} || '@' || {_DOMAIN} END"
_DAY = "CAST(o_orderdate AS DATE)"

VIEWS: dict[str, str] = {
    "v_master": f"""
SELECT CAST(c_custkey AS INT) + 2 AS master_row,
    CASE WHEN {every(89)} THEN '' WHEN {every(97)} THEN {padded("REF-", "c_custkey - 1")} ELSE {padded("REF-", "c_custkey")} END AS ref_id,
    CASE WHEN {every(83)} THEN '' ELSE {_FIRST} || ' ' || {_LAST} END AS full_name,
    CASE WHEN {every(53)} THEN 'SUPERSEDED' WHEN c_custkey % 4 = 0 THEN 'GOOGLE' WHEN c_custkey % 4 = 1 THEN 'attio' ELSE 'BOTH' END AS location,
    CASE WHEN {every(41)} THEN '' WHEN {every(43)} THEN '2' WHEN {every(47)} THEN CAST(c_custkey + 3 AS STRING) || 'abc' WHEN {every(59)} THEN '-1'
        WHEN {every(67)} THEN CAST(c_custkey + 4 AS STRING) WHEN {every(73)} THEN '9999999' ELSE CAST(c_custkey + 3 AS STRING) END AS google_row,
    CASE WHEN c_custkey % 7 = 0 THEN '' WHEN {every(61)} THEN {padded("rec-", "c_custkey - 1")} ELSE {padded("rec-", "c_custkey")} END AS attio_record_id,
    '' AS notes
FROM {{customer}}""",
    "v_contacts": f"""
SELECT CAST(c_custkey AS INT) + 3 AS sheet_row,
    CASE WHEN {every(71)} THEN '' WHEN c_custkey % 31 = 5 THEN {padded("REF-", "c_custkey + 1")} ELSE {padded("REF-", "c_custkey")} END AS contact_id,
    {_FIRST} AS first_name, {_LAST} AS last_name,
    CASE WHEN c_custkey % 6 = 0 THEN '' ELSE c_mktsegment || ' lead' END AS title, n_name AS company, {_EMAIL} AS primary_email,
    {pick("c_custkey % 7", ("Core", " strategic ", "PERIPHERAL", "VIP", "", "Peripheral", "core"))} AS relationship_tier
FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey""",
    "v_people": f"""
SELECT {padded("rec-", "c_custkey")} AS record_id,
    CASE c_custkey % 5 WHEN 0 THEN {_FIRST} || ' ' || {_LAST} WHEN 1 THEN lower({_FIRST} || ' ' || {_LAST}) WHEN 2 THEN replace(replace(replace({_FIRST}, 'é', 'e'), 'ë', 'e'), 'ø', 'o') || ' ' || replace(replace({_LAST}, 'ö', 'o'), 'í', 'i')
        WHEN 3 THEN 'Dr. ' || {_FIRST} || ', ' || {_LAST} ELSE CASE WHEN c_custkey % 3 = 0 THEN '' ELSE 'Zed Other' END END AS name,
    CASE WHEN {every(13)} THEN '' WHEN {every(17)} THEN {padded("REF-", "c_custkey + 2")} ELSE {padded("REF-", "c_custkey")} END AS crm_ref_id,
    {_EMAIL} AS primary_email,
    {_EMAIL} || CASE WHEN c_custkey % 8 = 1 THEN ',second' || CAST(c_custkey AS STRING) || '@dune.example' WHEN c_custkey % 8 = 2 THEN ',alerts@mail.bolt.example' ELSE '' END AS all_emails,
    CASE WHEN c_custkey % 6 = 0 THEN 'Director' ELSE c_mktsegment || CASE WHEN c_custkey % 4 = 0 THEN ' Lead' ELSE ' lead' END END AS job_title,
    CASE WHEN c_custkey % 10 = 1 THEN '' ELSE n_name END AS company,
    CASE WHEN c_custkey % 3 = 0 THEN 'https://people.example/in/' || CAST(c_custkey AS STRING) ELSE '' END AS linkedin,
    CASE WHEN c_custkey % 37 = 1 THEN '2026-07-22 14:01:00' WHEN c_custkey % 37 = 2 THEN '2026-07-22 14:02:00' WHEN c_custkey % 37 = 3 THEN 'unknown' ELSE '2025-01-01 00:00:00' END AS created_at,
    CASE WHEN c_custkey % 6 = 5 THEN NULL ELSE c_acctbal / 150.0 END AS strength_legacy,
    {pick("c_custkey % 6", ("Very weak", "Weak", "Good", "Strong", "Very strong"))} AS strength_label,
    CASE WHEN c_custkey % 9 = 8 THEN NULL ELSE first_day END AS first_interaction, last_day AS last_interaction,
    {pick("c_custkey % 4", ("Inbound", "outbound ", "internal", "sideways"))} AS last_direction,
    {pick("c_custkey % 12", ("Re: Fwd: Automatic reply: away", "Your order has shipped", "Lunch next week?", "", "Receipt for you", "Intro to the team", "Fw: Out of office", "Payment received", "  Plan  for\tQ3 ", "Welcome to Acme", "auto: gone", "Notes"))} AS last_subject,
    CASE WHEN c_custkey % 5 = 2 THEN 'Talked about ' || repeat('long plans and ', 30) ELSE '' END AS last_summary,
    CASE WHEN c_custkey % 8 = 3 THEN 'Met at a fair' ELSE '' END AS description,
    CASE WHEN c_custkey % 4 = 1 THEN 'Positive' ELSE '' END AS last_outcome,
    CASE WHEN c_custkey % 23 = 4 THEN 'https://calls.example/calls/1111111' WHEN c_custkey % 23 = 5 THEN 'https://calls.example/calls/1234567' ELSE '' END AS last_url
FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey
LEFT JOIN (SELECT o_custkey, min({_DAY}) AS first_day, max({_DAY}) AS last_day FROM {{orders}} GROUP BY o_custkey) AS seen ON seen.o_custkey = c_custkey
WHERE c_custkey % 19 <> 18""",
    "v_crm": json_text("""
SELECT record_id, '{"name":[' || CASE WHEN record_id LIKE '%0' THEN '{"first_name":"' || coalesce(name, '') || '","last_name":"X"}' WHEN record_id LIKE '%1' THEN '{"value":" ' || coalesce(name, '') || '"}' WHEN record_id LIKE '%2' THEN '' ELSE '{"full_name":"' || coalesce(name, '') || '"}' END || '],"stage":[' ||
    CASE WHEN record_id LIKE '%3' THEN '{"option":{"title":"Stage 2"}}' WHEN record_id LIKE '%4' THEN '{"value":"Stage 3"}' WHEN record_id LIKE '%5' THEN '{"value":7}' ELSE '' END || '],"touched":[' || CASE WHEN record_id LIKE '%6' THEN '{"interacted_at":"2024-01-05T10:00:00Z"}' WHEN record_id LIKE '%7' THEN '{"date":"2024-02-01"}' ELSE '{"value":"45812"}' END ||
    '],"emails":[{"email_address":"' || upper(primary_email) || '"},{"email_address":"x' || record_id || '@acme.example"},{"email_address":"x' || record_id || '@acme.example"},{"email_address":"bad"}],"company":[' || CASE WHEN record_id LIKE '%8' THEN '{"target_record":{"record_id":"co-8"}}' WHEN record_id LIKE '%9' THEN '' ELSE '{"target_record_id":"co-' || substr(record_id, 9, 1) || '"}' END ||
    ']' || CASE WHEN record_id LIKE '%1' THEN '' ELSE ',"created_at":[{"value":"2024-03-0' || substr(record_id, 9, 1) || '"}]' END || '}' AS doc, CASE WHEN record_id LIKE '%2' THEN '2020-01-01' ELSE NULL END AS created_at
FROM {v_people} WHERE record_id NOT LIKE '%33'"""),
    "v_pipeline": f"""
SELECT 'ent-' || CAST(o_orderkey AS STRING) AS entry_id, {padded("rec-", "o_custkey")} AS record_id,
    CASE WHEN o_orderstatus = 'F' THEN 'Stage ' || CAST(o_orderkey % 8 AS STRING) ELSE 'Lost' END AS tnb_stage,
    CASE WHEN o_orderstatus = 'P' OR o_orderkey % 5 = 0 THEN 'stage' || CAST(o_orderkey % 6 AS STRING) ELSE NULL END AS fractional_stage,
    CASE WHEN o_orderstatus = 'O' THEN 'STAGE  ' || CAST(o_orderkey % 7 AS STRING) || ' - talks' ELSE '' END AS fte_stage,
    CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS native_touch,
    CASE WHEN o_orderkey % 3 = 0 THEN CAST('2001-07-20' AS DATE) WHEN o_orderkey % 3 = 1 THEN CAST('1999-01-05' AS DATE) ELSE NULL END AS manual_touch
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn FROM {{orders}}) AS ranked WHERE rn = 1 AND o_custkey % 6 <> 5""",
    "v_tasks": f"""
SELECT CAST(o_orderkey AS BIGINT) + 1 AS sheet_row, 'TASK-' || CAST(o_orderkey AS STRING) AS task_id, CAST({_DAY} AS STRING) AS created_at,
    CASE WHEN o_orderkey % 9 = 0 THEN '' ELSE {padded("REF-", "o_custkey")} END AS contact_id, 'Contact ' || CAST(o_custkey AS STRING) AS contact_name,
    {pick("o_orderkey % 4", ("Send the deck!", "send  the DECK", "Call back (soon)", "Café follow-up"))} AS description,
    CASE o_orderkey % 6 WHEN 0 THEN '' WHEN 1 THEN '37100' WHEN 2 THEN '37100.75' WHEN 3 THEN 'soon' ELSE CAST({_DAY} AS STRING) END AS due_date,
    CASE o_orderstatus WHEN 'O' THEN 'Open' WHEN 'F' THEN 'Done' ELSE 'open' END AS status,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'Urgent' WHEN '2-HIGH' THEN 'High' WHEN '3-MEDIUM' THEN 'Medium' ELSE 'Low' END AS priority,
    CASE WHEN o_orderkey % 5 = 0 THEN 'ACT-' || CAST(o_orderkey % 97 AS STRING) ELSE '' END AS related_activity_id
FROM {{orders}}""",
    "v_activity": f"""
SELECT CAST(event_id AS INT) + 2 AS sheet_row, 'ACT-' || CAST(event_id AS STRING) AS activity_id,
    CASE WHEN event_id % 50 = 7 THEN 'n/a' WHEN event_id % 50 = 8 THEN '' ELSE CAST(date_trunc('second', ts) AS STRING) END AS ts_text,
    {padded("REF-", "user_id")} AS contact_id, CASE WHEN event_id % 13 = 0 THEN 'Contact ' || CAST(user_id + 1 AS STRING) ELSE 'Contact ' || CAST(user_id AS STRING) END AS contact_name,
    event_type AS channel, CASE WHEN event_type = 'click' THEN 'Outbound' ELSE 'Inbound' END AS direction,
    CASE event_id % 40 WHEN 0 THEN 'Closed from queue today' WHEN 1 THEN 'Snoozed' WHEN 2 THEN 'Pipeline stage 3' ELSE 'Subject ' || CAST(event_id % 40 AS STRING) END AS subject,
    CASE WHEN event_type = 'signup' AND event_id % 3 = 0 THEN '[PENDING_CAPTURE] later' ELSE 'body ' || props END AS body,
    CASE WHEN event_type = 'signup' AND event_id % 3 = 1 THEN 'pending_capture thread:T-' || CAST(event_id % 500 AS STRING) || ' x' ELSE '' END AS note,
    {pick("event_id % 5", ("manual", "mark_sent bot", "Outreach tool", "daily beat", "heartbeat"))} AS source, value
FROM {{events}}""",
    "v_outbound": """
SELECT 'T-' || CAST(event_id % 700 AS STRING) || CASE WHEN event_id % 2 = 0 THEN '' ELSE 'b' END AS thread_id, CAST(event_id AS INT) AS sheet_row,
    CASE WHEN event_id % 17 = 0 THEN 'de la' ELSE 'Mx Contact' || CAST(user_id AS STRING) || ', Person' || CAST(user_id AS STRING) END AS contact_name,
    CASE WHEN event_id % 45 = 2 THEN '' ELSE CAST(date_trunc('second', ts) AS STRING) END AS last_email_date, 'Subject ' || CAST(event_id % 40 AS STRING) AS subject
FROM {events} WHERE event_type = 'click'""",
    "v_placeholders": """
SELECT activity_id, sheet_row, ts_text, CASE WHEN sheet_row % 19 = 0 THEN ' - ' ELSE replace(contact_name, 'Contact ', 'Contact') END AS contact_name, body, note
FROM {v_activity} WHERE channel = 'signup'""",
    "v_text": """
SELECT doc_id, text || CASE doc_id % 9 WHEN 0 THEN ' ssn 123-45-6789 end' WHEN 1 THEN ' Password: hunter2 ok' WHEN 2 THEN ' api_key=abcdEFGH12345678 z' WHEN 3 THEN ' routing number: 021000021'
    WHEN 4 THEN ' card 4111 1111 1111 1111 b' WHEN 5 THEN ' account no. 12345678 c' WHEN 6 THEN ' card 4111-1111-1111-1112 d' ELSE '' END AS text
FROM {documents}""",
    "v_messages": """
SELECT CAST(conv_id AS STRING) AS thread_id, CAST(turn AS INT) AS pos, 'M' || CAST(CASE WHEN turn % 4 = 3 THEN turn - 1 ELSE turn END AS STRING) AS message_id,
    CASE role WHEN 'assistant' THEN 'Outbound' ELSE 'Inbound' END AS direction,
    CASE WHEN role = 'assistant' THEN 'Owner@example.com' WHEN role = 'system' THEN 'noreply@sys.example' WHEN conv_id % 7 = 0 THEN 'sales@vendor.example' ELSE 'Guest' || CAST(conv_id % 20 AS STRING) || '@acme.example' END AS sender_email,
    CASE WHEN role = 'assistant' THEN CASE WHEN conv_id % 5 = 0 THEN 'owner@example.org' ELSE 'guest' || CAST(conv_id % 20 AS STRING) || '@acme.example' END ELSE 'owner@example.com' END AS recipient_email,
    CASE WHEN conv_id % 3 = 0 THEN 'cc1@dune.example,owner@example.org,cc2@dune.example' ELSE '' END AS cc,
    CASE WHEN conv_id % 6 = 1 THEN 'Quick question' WHEN conv_id % 6 = 2 THEN 'Your invoice' ELSE 'Hello' END AS subject,
    CASE WHEN conv_id % 10 = 3 THEN 'my diagnosis ' WHEN conv_id % 10 = 4 THEN 'this is a test ' ELSE '' END || text AS body
FROM {conversations}""",
    "v_brain": f"""
SELECT CAST(conv_id AS BIGINT) + 2 AS sheet_row, 'LATE-EDITION-' || CAST(1000 + conv_id % 3 AS STRING) AS run_id, CAST(conv_id AS STRING) AS thread_id,
    CASE WHEN conv_id % 8 = 0 THEN '' ELSE {padded("REF-", "conv_id % 60")} END AS ref_id, 'Contact ' || CAST(conv_id % 60 AS STRING) AS contact_name, 'Subject ' || CAST(conv_id AS STRING) AS subject,
    CASE conv_id % 5 WHEN 0 THEN 'REPLY_NEEDED' WHEN 1 THEN 'ACTION_ITEM' WHEN 2 THEN 'FYI_ONLY' ELSE 'ARCHIVE' END AS action_required,
    CASE WHEN conv_id % 4 = 0 THEN 'TRUE' WHEN conv_id % 4 = 1 THEN ' true' ELSE '' END AS resolved,
    CASE WHEN conv_id % 2 = 0 THEN '' ELSE 'Note ' || repeat('n', 120) END AS brain_notes, 'Summary ' || CAST(conv_id AS STRING) || repeat(' and so on', 12) AS running_summary
FROM (SELECT DISTINCT conv_id FROM {{conversations}}) AS threads""",
    "v_answers": json_text("""
SELECT CAST(conv_id AS STRING) AS thread_id, CASE WHEN conv_id % 3 = 0 THEN 'Outbound' ELSE 'Inbound' END AS direction,
    CASE WHEN conv_id % 23 = 5 THEN 'I cannot say' WHEN conv_id % 23 = 6 THEN '[1, 2]' ELSE CASE WHEN conv_id % 2 = 0 THEN ' ```json' || chr(10) ELSE '' END || '{"running_summary":"Summary ' || CAST(conv_id AS STRING) ||
    CASE conv_id % 13 WHEN 4 THEN ' card 4111 1111 1111 1111 and A4111111111111111' WHEN 5 THEN ' ssn 123-45-6789' ELSE '' END || '","key_commitments":' || CASE WHEN conv_id % 11 = 3 THEN '{"ana":"call"}' ELSE '"call back"' END ||
    ',"personal_details_flag":' || CASE conv_id % 17 WHEN 2 THEN '"yes"' WHEN 3 THEN 'null' WHEN 4 THEN 'false' ELSE 'true' END || ',"company_intel":"","pipeline_signals":"' || CASE WHEN conv_id % 29 = 1 THEN 'password: hunter2' ELSE 'warm' END || '","brain_notes":"note",' ||
    '"action_required":"' || CASE conv_id % 5 WHEN 0 THEN 'REPLY_NEEDED' WHEN 1 THEN 'ACTION_ITEM' WHEN 2 THEN 'FYI_ONLY' WHEN 3 THEN 'REPLY_NEEDED' ELSE 'NO_ACTION' END || CASE WHEN conv_id % 31 = 8 THEN '!' ELSE '' END || '","outcome":"' || CASE conv_id % 4 WHEN 0 THEN 'Positive' WHEN 1 THEN 'No Response' ELSE 'Neutral' END ||
    '","response_draft":"' || CASE WHEN conv_id % 5 IN (0, 3) THEN 'Thanks, talk soon' ELSE '' END || '","tasks":' || CASE conv_id % 7 WHEN 0 THEN '[]' WHEN 1 THEN '[{"description":"Send deck","due_date":"2001-09-05","priority":"High"},{"description":"Call","due_date":"37100","priority":""}]'
    WHEN 2 THEN CASE WHEN conv_id % 2 = 0 THEN '"none"' ELSE '[]' END WHEN 3 THEN '[{"description":"x","due_date":5,"priority":"Low"},"call",{"due_date":""}]' ELSE '[{"description":"Follow up","due_date":"","priority":"Medium"}]' END || CASE WHEN conv_id % 19 = 7 THEN '' ELSE ',"ready_to_archive":false' END ||
    ',"personal_notes_extract":"' || CASE WHEN conv_id % 6 = 1 THEN 'likes jazz' ELSE '' END || '","topics_of_interest_extract":"","conversation_trigger_extract":""}' || CASE WHEN conv_id % 2 = 0 THEN chr(10) || '```' ELSE '' END END AS answer
FROM (SELECT DISTINCT conv_id FROM {conversations}) AS threads"""),
    "v_judgements": json_text("""
SELECT task_id, CASE WHEN sheet_row % 17 = 3 THEN 'no' ELSE '{"has_evidence":' || CASE sheet_row % 5 WHEN 0 THEN '"true"' WHEN 1 THEN 'false' ELSE 'true' END || ',"evidence_activity_id":"' || CASE WHEN sheet_row % 7 = 2 THEN '' ELSE 'ACT-1' END ||
    '","evidence_quote":"done","confidence":"' || CASE sheet_row % 4 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' WHEN 2 THEN '' ELSE 'low' END || '","brain_reasoning":' || CASE WHEN sheet_row % 13 = 1 THEN '7' ELSE '"it says so"' END || '}' END AS answer
FROM {v_tasks}"""),
    "v_resolved": f"""
SELECT CAST(conv_id AS STRING) AS thread_id, CAST(conv_id AS BIGINT) + 2 AS sheet_row, CASE WHEN conv_id % 8 = 0 THEN '' ELSE {padded("REF-", "1 + conv_id % 97")} END AS ref_id, 'Contact ' || CAST(conv_id % 97 AS STRING) AS contact_name,
    'Subject ' || CAST(conv_id AS STRING) AS subject, CASE conv_id % 4 WHEN 0 THEN 'GOOGLE' WHEN 1 THEN 'ATTIO' ELSE 'BOTH' END AS location, CAST(CASE WHEN conv_id % 9 = 4 THEN NULL ELSE 4 + conv_id % 97 + CASE WHEN conv_id % 10 = 7 THEN 1 ELSE 0 END END AS INT) AS google_row,
    CASE WHEN conv_id % 11 = 5 THEN '' ELSE {padded("rec-", "1 + conv_id % 97")} END AS attio_record_id, CASE conv_id % 12 WHEN 3 THEN 'google' WHEN 7 THEN 'attio' ELSE '' END AS tags,
    CASE conv_id % 6 WHEN 0 THEN '2001-08-10T09:30:00Z' WHEN 1 THEN '37110' WHEN 2 THEN 'Friday' WHEN 3 THEN '' ELSE '2001-08-12' END AS last_email_date, CAST(conv_id % 3 AS INT) AS others
FROM (SELECT DISTINCT conv_id FROM {{conversations}}) AS threads""",
    "v_proposals": """
SELECT 'PROP-' || substr(record_id, 1, 8) AS proposal_id, record_id, crm_ref_id AS ref_id, name AS contact_name, 'evidence of ' || name || repeat(' more', 30) AS evidence,
    CASE WHEN length(last_subject) % 3 = 0 THEN 'PENDING' WHEN length(last_subject) % 3 = 1 THEN ' pending ' ELSE 'REJECTED' END AS status
FROM {v_people} WHERE record_id LIKE '%3' OR record_id LIKE '%07'""",
    "v_conflicts": """
SELECT crm_ref_id AS ref_id, name AS old_name, name || ' Jr' AS new_name, CASE WHEN record_id LIKE '%1' THEN 'RESOLVED_OLD' WHEN record_id LIKE '%2' THEN '' WHEN record_id LIKE '%3' THEN 'resolved_new' ELSE 'OTHER' END AS status
FROM {v_people} WHERE record_id LIKE '%1' OR record_id LIKE '%2' OR record_id LIKE '%3' OR record_id LIKE '%14'
UNION ALL SELECT crm_ref_id, name, name || ' Jr', 'RESOLVED_NEW' FROM {v_people} WHERE record_id LIKE '%11'""",
    "v_exclusions": """
SELECT record_id, '' AS email, 'manual' AS reason FROM {v_people} WHERE record_id LIKE '%5'
UNION ALL SELECT '' AS record_id, upper(primary_email) AS email, 'address' AS reason FROM {v_people} WHERE record_id LIKE '%22' AND primary_email <> ''""",
    "v_queue": """
SELECT record_id, CASE CAST(substr(record_id, 5) AS INT) % 7 WHEN 0 THEN '' WHEN 1 THEN 'pending' WHEN 2 THEN 'Skipped' WHEN 3 THEN 'queued_keep' WHEN 4 THEN 'queued_archive' WHEN 5 THEN 'processed' ELSE 'odd' END AS status,
    CASE WHEN CAST(substr(record_id, 5) AS INT) % 14 = 2 THEN '2001-08-01' WHEN CAST(substr(record_id, 5) AS INT) % 14 = 9 THEN '2002-01-01' ELSE '' END AS skip_until,
    CASE WHEN CAST(substr(record_id, 5) AS INT) % 3 = 0 THEN '2001-01-01' ELSE '' END AS last_scored, CAST(CAST(substr(record_id, 5) AS INT) % 101 AS STRING) AS probability,
    CASE WHEN CAST(substr(record_id, 5) AS INT) % 4 = 0 THEN 'Keepers' WHEN CAST(substr(record_id, 5) AS INT) % 4 = 1 THEN 'junk' ELSE '' END AS band
FROM {v_people} WHERE record_id NOT LIKE '%8'
UNION ALL SELECT 'gone-' || CAST(c_custkey AS STRING), 'pending', '', '', '50', '' FROM {customer} WHERE c_custkey % 30 = 1""",
    "v_recon": """
SELECT sheet_row, 'RECON-' || task_id AS recon_id, task_id || ', TASK-x' || CASE WHEN sheet_row % 2 = 0 THEN ',' || 'TASK-1' ELSE '' END AS source_task_ids,
    CASE WHEN sheet_row % 3 = 0 THEN 'STALE' ELSE 'STILL_OPEN' END AS verdict, CASE WHEN sheet_row % 4 = 0 THEN 'DONE' ELSE '' END AS status
FROM {v_tasks}""",
    "v_segments": """
SELECT 'S' || CAST(1 + p_partkey % 5 AS STRING) AS tab, CAST(p_partkey AS INT) AS sheet_row, CASE WHEN p_partkey % 13 = 0 THEN '' ELSE 'https://People.example/in/' || CAST(p_partkey % 90 AS STRING) || CASE WHEN p_partkey % 2 = 0 THEN '/' ELSE '' END END AS url,
    p_name AS name, p_brand AS segment, CASE WHEN p_partkey % 4 = 0 THEN '' ELSE 'new' || CAST(p_partkey % 90 AS STRING) || '@acme.example' END AS email
FROM {part}""",
}


def uses(sql: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", sql)))


class Tables:
    """Tables and views of a directory as DataFrames, by name."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._made: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in VIEWS and name not in BASE:
            raise AttributeError(name)
        if name not in self._made:
            if name in BASE:
                self._made[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            else:
                self._made[name] = self.spark.sql(VIEWS[name], **{u: getattr(self, u) for u in uses(VIEWS[name])})
        return self._made[name]


@lru_cache
def _needed(name: str) -> tuple[str, ...]:
    out: list[str] = []
    for u in uses(VIEWS[name]):
        if u in VIEWS:
            out += [x for x in (*_needed(u), u) if x not in out]
    return tuple(out)


def with_views(sql: str) -> str:
    """DuckDB SQL with the views that it names as common table expressions."""
    order: list[str] = []
    for name in dict.fromkeys(re.findall(r"\bv_[a-z_]+\b", sql)):
        if name in VIEWS:
            order += [x for x in (*_needed(name), name) if x not in order]
    parts = [f"{n} AS ({re.sub(r'[{](\w+)[}]', r'\1', VIEWS[n])})" for n in order]
    sql = sql.strip()
    if not parts:
        return sql
    if sql.upper().startswith("WITH "):
        return f"WITH {', '.join(parts)}, {sql[5:]}"
    return f"WITH {', '.join(parts)} {sql}"
