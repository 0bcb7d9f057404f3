"""DuckDB fragments and derived relations that the queries' SQL twins share."""

from __future__ import annotations

import re

from ..functions import emails, names, pii
from ..operators import scoring
from ..params import PARAMS as P
from ..sources.views import with_views

TODAY = f"DATE '{P.today}'"


def flex(x: str) -> str:
    return (
        rf"CASE WHEN regexp_matches(trim({x}), '^\d+(\.\d+)?$') THEN DATE '1899-12-30' + CAST(floor(TRY_CAST(trim({x}) AS DOUBLE)) AS INTEGER) "
        rf"WHEN regexp_matches(trim({x}), '^\d{{4}}-\d{{2}}-\d{{2}}$') THEN TRY_CAST(trim({x}) AS DATE) WHEN regexp_matches(trim({x}), '^\d{{4}}-\d{{2}}-\d{{2}}[T ]\d{{2}}:\d{{2}}') THEN CAST(TRY_CAST(trim({x}) AS TIMESTAMP) AS DATE) END"
    )


def moment(x: str) -> str:
    return rf"CASE WHEN regexp_matches(trim({x}), '^\d{{4}}-\d{{2}}-\d{{2}}') THEN TRY_CAST(trim({x}) AS TIMESTAMP) WHEN regexp_matches(trim({x}), '^\d{{1,2}}/\d{{1,2}}/\d{{4}} ') THEN try_strptime(trim({x}), '%m/%d/%Y %H:%M:%S') END"


def civil(x: str) -> str:
    return rf"CASE WHEN regexp_matches({x}, '^\d{{4}}-\d{{2}}-\d{{2}}$') THEN TRY_CAST({x} AS DATE) END"


def day_text(x: str) -> str:
    return f"coalesce(strftime({x}, '%Y-%m-%d'), '')"


def norm(x: str) -> str:
    return rf"trim(regexp_replace(regexp_replace(lower({x}), '[\p{{P}}\p{{S}}]', ' ', 'g'), '[\s\p{{Z}}]+', ' ', 'g'))"


def words(x: str) -> str:
    return f"list_filter(string_split({norm(x)}, ' '), lambda w: w <> '' AND w NOT IN ({', '.join(map(repr, names.PARTICLES))}))"


def share(a: str, b: str) -> str:
    return f"coalesce(list_has_any({words(a)}, {words(b)}), false)"


def verify(a: str, b: str) -> str:
    return f"CASE WHEN coalesce(len({words(a)}), 0) < 1 OR coalesce(len({words(b)}), 0) < 1 THEN 'UNVERIFIABLE' WHEN {share(a, b)} THEN 'MATCH' ELSE 'MISMATCH' END"


def outcome(a: str, b: str) -> str:
    return f"CASE WHEN trim(coalesce({a}, '')) = '' OR trim(coalesce({b}, '')) = '' THEN 'unavailable' WHEN trim({a}) = trim({b}) THEN 'exact' WHEN {share(a, b)} THEN 'shares_word' ELSE 'zero_words' END"


def stage(x: str) -> str:
    return rf"coalesce(TRY_CAST(regexp_extract({x}, '(?i)stage\s*([0-9]{{1,9}})', 1) AS INTEGER), 0)"


def leading(x: str) -> str:
    return rf"TRY_CAST(regexp_extract({x}, '^\s*([+-]?\d{{1,9}})', 1) AS INTEGER)"


def tier(x: str) -> str:
    return f"CASE lower(trim(coalesce({x}, ''))) WHEN 'core' THEN 'Core' WHEN 'peripheral' THEN 'Peripheral' ELSE 'Strategic' END"


def local(x: str) -> str:
    return f"lower(CASE WHEN contains({x}, '@') THEN regexp_extract({x}, '(?s)^(.*)@', 1) ELSE {x} END)"


def domain(x: str) -> str:
    return f"lower(CASE WHEN contains({x}, '@') THEN regexp_extract({x}, '@([^@]*)$', 1) ELSE '' END)"


def among(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def is_role(x: str) -> str:
    labels = f"list_filter(string_split({domain(x)}, '.'), lambda l: l <> '')"
    tests = [f"{local(x)} IN {among(emails.ROLES)}", *(f"starts_with({local(x)}, '{p}')" for p in emails.ROLE_PREFIXES), *(f"ends_with({local(x)}, '{s}')" for s in emails.ROLE_SUFFIXES)]
    return f"({' OR '.join(tests)} OR (len({labels}) >= 3 AND {labels}[1] IN {among(emails.SENDING_LABELS)}))"


def local_class(x: str) -> str:
    parts = f"list_filter(regexp_split_to_array(regexp_replace({local(x)}, '[0-9]+$', ''), '[._+-]'), lambda s: s <> '')"
    size = f"length(array_to_string({parts}, ''))"
    return (
        f"CASE WHEN coalesce({local(x)}, '') = '' THEN 'unknown' WHEN {local(x)} IN {among(emails.GENERIC)} THEN 'generic-role' WHEN regexp_matches({local(x)}, '^[0-9a-f]{{16,}}$') OR regexp_matches({local(x)}, '^[0-9]+$') THEN 'opaque' "
        f"WHEN len({parts}) NOT BETWEEN 1 AND 3 THEN 'opaque' WHEN len(list_filter({parts}, lambda s: NOT regexp_matches(s, '^[a-z]+$'))) > 0 THEN 'opaque' WHEN {size} NOT BETWEEN 3 AND 24 THEN 'opaque' ELSE 'personal' END"
    )


def domain_class(x: str) -> str:
    return f"CASE WHEN {domain(x)} = '' THEN 'unknown' WHEN {domain(x)} IN {among(emails.FREEMAIL)} THEN 'freemail' ELSE 'company' END"


def auto_reply(x: str) -> str:
    s = rf"regexp_replace(lower(trim({x})), '^(?:(?:re|fw|fwd)\s*:\s*)+', '')"
    return "(" + " OR ".join(f"starts_with({s}, '{p}')" for p in emails.AUTO_REPLIES) + ")"


def re2(pattern: str) -> str:
    """A Java pattern with ASCII look-arounds as RE2, whose word border is ASCII."""
    return pattern.replace(emails.BORDER, r"\b").replace(emails.BEFORE, r"\b").replace(emails.AFTER, r"\b").replace("'", "''")


def transactional(x: str) -> str:
    return f"(trim({x}) <> '' AND regexp_matches({x}, '(?i){'|'.join(emails.TRANSACTIONAL)}'))"


def direction(x: str) -> str:
    d = f"lower(trim(coalesce({x}, '')))"
    return f"CASE WHEN {d} IN ('inbound', 'outbound', 'internal') THEN {d} ELSE 'unknown' END"


def split_list(x: str) -> str:
    return f"list_filter(list_transform(string_split({x}, ','), lambda e: trim(e)), lambda e: e <> '')"


def squeeze(x: str) -> str:
    return rf"trim(regexp_replace(coalesce({x}, ''), '\s+', ' ', 'g'))"


def clip(x: str, n: int) -> str:
    return f"CASE WHEN length({x}) > {n} THEN left({x}, {n - 1}) || '…' ELSE {x} END"


def description(x: str) -> str:
    return rf"trim(regexp_replace(regexp_replace(lower({x}), '[^A-Za-z0-9_\s]', ' ', 'g'), '\s+', ' ', 'g'))"


def luhn(d: str) -> str:
    return f"(list_sum(list_transform(generate_series(1, length({d})), lambda i: CASE WHEN i % 2 = 1 THEN CAST(reverse({d})[i] AS INTEGER) ELSE CASE WHEN 2 * CAST(reverse({d})[i] AS INTEGER) > 9 THEN 2 * CAST(reverse({d})[i] AS INTEGER) - 9 ELSE 2 * CAST(reverse({d})[i] AS INTEGER) END END)) % 10 = 0)"


def digits(x: str) -> str:
    return f"regexp_replace({x}, '[ -]', '', 'g')"


def cards(x: str) -> str:
    return f"list_filter(list_transform(regexp_extract_all({x}, '{re2(pii.CARD)}'), lambda m: {digits('m')}), lambda d: length(d) BETWEEN 13 AND 19 AND {luhn('d')})"


#: Written out for RE2, not made from the engine's patterns.
_CARD = r"\b(?:\d[ -]?){13,19}\b"
_MARKS = [
    (r"\b\d{3}-\d{2}-\d{4}\b", "[REDACTED_SSN]"),
    (r"(?i)\b(?:sk|pk|api[_-]?key|token)[_-]?[:=]\s*[''\"]?[A-Za-z0-9_\-]{16,}[''\"]?", "[REDACTED_API_KEY]"),
    (r"(?i)\bpassword\s*[:=]\s*\S+", "[REDACTED_PASSWORD]"),
]


def redacted(x: str) -> str:
    between, found = f"string_split_regex({x}, '{_CARD}')", f"regexp_extract_all({x}, '{_CARD}')"
    marked = f"list_transform({found}, lambda m: CASE WHEN {luhn(digits('m'))} THEN '[REDACTED_CARD]' ELSE m END)"
    out = f"array_to_string(list_transform(list_zip({between}, {marked}), lambda z: z[1] || coalesce(z[2], '')), '')"
    for pattern, mark in _MARKS:
        out = f"regexp_replace({out}, '{pattern}', '{mark}', 'g')"
    return out


def middle(s: str) -> str:
    return f"CASE WHEN length({s}) <= 4 THEN repeat('*', length({s})) ELSE left({s}, 2) || repeat('*', length({s}) - 4) || right({s}, 2) END"


def category(x: str) -> str:
    m = lambda p: f"regexp_matches({x}, '{re2(p)}')"
    return f"CASE WHEN {m(pii.SSN)} THEN 'ssn' WHEN {m(pii.CREDENTIAL)} THEN 'credential' WHEN {m(pii.ROUTING)} OR {m(pii.ACCOUNT)} THEN 'bank_account' WHEN len({cards(x)}) > 0 THEN 'credit_card' END"


def strength(value: str, label: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN {label} " + " ".join(f"WHEN {value} >= {n} THEN '{s}'" for n, s in scoring.BOUNDS) + f" ELSE {label} END"


def band(x: str) -> str:
    return f"CASE WHEN {x} >= {scoring.KEEPER} THEN 'keepers' WHEN {x} <= {scoring.JUNK} THEN 'junk' ELSE 'unclear' END"


def evidence(o: str, s: str, m: str) -> str:
    t = lambda x: f"trim(coalesce({x}, ''))"
    return f"concat_ws(' — ', nullif({t(o)}, ''), CASE WHEN {t(s)} <> '' THEN 're: ' || {t(s)} END, nullif({clip(t(m), 400)}, ''))"


_case = lambda table, i: " ".join(f"WHEN {k if isinstance(k, int) else repr(k)} THEN {v[i] if isinstance(v[i], int) else repr(v[i])}" for k, v in table.items())


def _cadence() -> str:
    from ..operators.cadence import STAGES, TIERS

    return f"""
SELECT *, CASE WHEN stalled THEN base || ' ⚠ STALLED — ' || days_since || 'd since last touch (expected every ' || cadence_days || 'd)' ELSE base END || CASE WHEN days_since IS NULL THEN ' — last touch date unknown' ELSE '' END || CASE WHEN touch_source = 'manual' THEN ' [manual]' ELSE '' END AS follow_up_reason,
    CASE WHEN stage > 5 THEN 'unknown_stage' WHEN fetched IS NULL THEN 'fetch_failed' WHEN pointers > 1 THEN 'duplicate_pointer' WHEN pointers IS NULL THEN NULL WHEN person_ref <> '' AND person_ref <> ref_id THEN 'id_mismatch'
        WHEN verdict = 'MISMATCH' THEN 'name_mismatch' WHEN verdict = 'UNVERIFIABLE' THEN 'name_unverifiable' END AS withheld
FROM (SELECT *, CASE WHEN last_touch IS NULL THEN {TODAY} + cadence_days WHEN last_touch + cadence_days < {TODAY} THEN {TODAY} + CAST(floor(cadence_days / 2) AS INTEGER) ELSE last_touch + cadence_days END AS next_check_in,
        {TODAY} - last_touch AS days_since, coalesce(last_touch + cadence_days < {TODAY}, false) AS overdue_catch_up, coalesce({TODAY} - last_touch > 2 * cadence_days, false) AS stalled,
        CASE WHEN stage BETWEEN 1 AND 5 THEN track || ' Stage ' || stage ELSE 'Tier ' || tier || ' — no active stage' END AS base
    FROM (SELECT *, CASE WHEN stage BETWEEN 1 AND 5 THEN CASE stage {_case(STAGES, 0)} END ELSE CASE tier {_case(TIERS, 0)} END END AS cadence_days,
            CASE WHEN stage BETWEEN 1 AND 5 THEN CASE stage {_case(STAGES, 1)} END ELSE CASE tier {_case(TIERS, 1)} END END AS touch_mode,
            CASE WHEN stage < 1 THEN NULL WHEN t1 = stage THEN 'TNB' WHEN t2 = stage THEN 'FTE' ELSE 'Fractional' END AS track
        FROM (SELECT e.*, greatest({stage("tnb_stage")}, {stage("fte_stage")}, {stage("fractional_stage")}) AS stage, {stage("tnb_stage")} AS t1, {stage("fte_stage")} AS t2,
                greatest(native_touch, manual_touch) AS last_touch, CASE WHEN native_touch IS NULL AND manual_touch IS NULL THEN 'none' WHEN manual_touch IS NULL OR native_touch >= manual_touch THEN 'native' ELSE 'manual' END AS touch_source,
                pe.record_id AS fetched, pe.name AS person_name, pe.crm_ref_id AS person_ref, pt.pointers, pt.ref_id, pt.master_name, {tier("ti.relationship_tier")} AS tier, {verify("pe.name", "pt.master_name")} AS verdict
            FROM v_pipeline e LEFT JOIN v_people pe ON pe.record_id = e.record_id
            LEFT JOIN (SELECT attio_record_id, count(*) AS pointers, min(ref_id) AS ref_id, min(full_name) AS master_name FROM v_master WHERE trim(ref_id) <> '' AND trim(attio_record_id) <> '' GROUP BY 1) pt ON pt.attio_record_id = e.record_id
            LEFT JOIN o_tier ti ON ti.ref_id = pt.ref_id)))"""


def finding(table: str, code: str, when: str, expected: str, found: str, notes: str) -> str:
    return f"SELECT master_row, ref_id, '{code}' AS code, {expected} AS expected, {found} AS found, {notes} AS notes FROM {table} WHERE {when}"


def _dupes(key: str, code: str, said: str) -> str:
    return (
        f"SELECT master_row, ref_id, '{code}' AS code, 'unique' AS expected, 'rows ' || list AS found, n || ' rows share {said}' || {key} AS notes FROM "
        f"(SELECT *, count(*) OVER (PARTITION BY {key}) AS n, string_agg(CAST(master_row AS VARCHAR), ', ' ORDER BY master_row) OVER (PARTITION BY {key}) AS list FROM o_audit WHERE {key} <> '') WHERE n > 1"
    )


READY = "location = 'BOTH' AND ok AND crm_ref_id = ref_id AND crm_ref_id <> '' AND outcome IN ('exact', 'shares_word') AND on_sheet"

RELATIONS: dict[str, str] = {
    "o_index": f"SELECT ref_id, full_name, upper(trim(location)) AS location, CASE WHEN {leading('google_row')} > 0 THEN {leading('google_row')} END AS google_row, attio_record_id, master_row FROM v_master WHERE trim(ref_id) <> '' QUALIFY row_number() OVER (PARTITION BY ref_id ORDER BY master_row DESC) = 1",
    "o_tier": "SELECT contact_id AS ref_id, relationship_tier FROM v_contacts WHERE trim(contact_id) <> '' AND trim(relationship_tier) <> '' QUALIFY row_number() OVER (PARTITION BY contact_id ORDER BY sheet_row DESC) = 1",
    "o_cadence": _cadence(),
    "o_audit": f"SELECT * REPLACE (upper(trim(location)) AS location, {leading('google_row')} AS google_row) FROM v_master WHERE NOT (trim(ref_id) = '' AND trim(full_name) = '' AND trim(attio_record_id) = '') AND upper(trim(location)) <> 'SUPERSEDED'",
    "o_structural": " UNION ALL ".join(
        [
            finding("o_audit", "S2", "ref_id = ''", "'an id'", "'(blank)'", "'row has no identity anchor'"),
            finding("o_audit", "S3", "location IN ('GOOGLE', 'BOTH') AND google_row IS NULL", "'Google_Row populated'", "'(blank)'", "'Location=' || location || ' but Google_Row is blank'"),
            finding("o_audit", "S3", "location IN ('ATTIO', 'BOTH') AND attio_record_id = ''", "'Attio_Record_ID populated'", "'(blank)'", "'Location=' || location || ' but Attio_Record_ID is blank'"),
            finding("o_audit", "S3", "location = 'GOOGLE' AND attio_record_id <> ''", "'no Attio_Record_ID'", "attio_record_id", "'Location=GOOGLE but an Attio pointer is present'"),
            finding("o_audit", "S3", "location = 'ATTIO' AND google_row IS NOT NULL", "'no Google_Row'", "CAST(google_row AS VARCHAR)", "'Location=ATTIO but a Google_Row is present'"),
            finding("o_audit", "S5", "google_row < 3", "'>= 3'", "CAST(google_row AS VARCHAR)", "'rows 1-2 are header/formula'"),
            _dupes("ref_id", "S1", ""),
            _dupes("attio_record_id", "S4", "Attio record "),
        ]
    ),
    "o_sheet": """SELECT master_row, ref_id, CASE WHEN google_row > last_row THEN 'G3' WHEN held = '' THEN 'G2' ELSE 'G1' END AS code, CASE WHEN google_row > last_row THEN '<= ' || last_row ELSE ref_id END AS expected,
    CASE WHEN google_row > last_row THEN CAST(google_row AS VARCHAR) WHEN held = '' THEN '(blank)' ELSE held END AS found,
    CASE WHEN google_row > last_row THEN 'Google_Row exceeds the last stamped Contacts row (' || last_row || ')' WHEN held = '' THEN 'Contacts row ' || google_row || ' has no Contact_ID' ELSE 'Contacts row ' || google_row || ' holds ' || held END AS notes
FROM (SELECT a.*, coalesce(c.contact_id, '') AS held, (SELECT coalesce(max(sheet_row), 2) FROM v_contacts WHERE contact_id <> '') AS last_row FROM o_audit a LEFT JOIN v_contacts c ON c.sheet_row = a.google_row WHERE a.google_row >= 3) WHERE google_row > last_row OR held <> ref_id""",
    "o_met": f"SELECT a.*, p.record_id IS NOT NULL AS ok, p.name, p.crm_ref_id, p.job_title, p.company AS crm_company, p.all_emails, c.first_name, c.last_name, c.title, c.company, c.primary_email, c.sheet_row IS NOT NULL AS on_sheet, {outcome('p.name', 'a.full_name')} AS outcome FROM o_audit a LEFT JOIN v_people p ON p.record_id = a.attio_record_id LEFT JOIN v_contacts c ON c.sheet_row = a.google_row WHERE a.attio_record_id <> ''",
    "o_crm": " UNION ALL ".join(
        [
            finding("o_met", "A3", "NOT ok", "'record ' || attio_record_id", "'(not found)'", "'stale pointer - record deleted or merged in Attio'"),
            finding("o_met", "A2", "ok AND crm_ref_id = ''", "ref_id", "'(blank)'", "'Attio record has no crm_ref_id'"),
            finding("o_met", "A1", "ok AND crm_ref_id <> '' AND crm_ref_id <> ref_id", "ref_id", "crm_ref_id", "'identity bridge has drifted'"),
            finding("o_met", "A5", "ok AND outcome = 'zero_words'", "full_name", "name", "'zero significant words in common (crm_ref_id=' || crm_ref_id || ')'"),
        ]
    ),
    "o_drift": " UNION ALL ".join(
        [
            finding("o_met", "I1", f"{READY} AND title <> '' AND {norm('title')} <> {norm('job_title')}", "title", "CASE WHEN job_title = '' THEN '(blank)' ELSE job_title END", "'Title'"),
            finding("o_met", "I1", f"{READY} AND company <> '' AND {norm('company')} <> {norm('crm_company')}", "company", "CASE WHEN crm_company = '' THEN '(blank)' ELSE crm_company END", "'Company'"),
            finding("o_met", "I1", f"{READY} AND primary_email <> '' AND len(list_filter({split_list('all_emails')}, lambda e: {norm('e')} = {norm('primary_email')})) = 0", "primary_email", f"CASE WHEN len({split_list('all_emails')}) = 0 THEN '(blank)' ELSE array_to_string({split_list('all_emails')}, ', ') END", "'Email'"),
        ]
    ),
    "o_findings": "SELECT * FROM o_structural UNION ALL SELECT * FROM o_sheet UNION ALL SELECT * FROM o_crm UNION ALL SELECT * FROM o_drift",
    "o_domains": f"SELECT domain, count(*) AS n FROM (SELECT {domain('primary_email')} AS domain FROM v_people) WHERE domain <> '' AND domain NOT IN {among(emails.FREEMAIL)} GROUP BY 1",
    "o_signals": f"""SELECT p.record_id, {strength("strength_legacy", "strength_label")} AS strength, strength_legacy, {direction("last_direction")} AS last_direction, first_interaction IS NOT NULL AND last_interaction IS NOT NULL AS span_known,
    CASE WHEN first_interaction IS NOT NULL AND last_interaction IS NOT NULL THEN greatest(0, last_interaction - first_interaction) ELSE 0 END AS span_days, trim(coalesce(name, '')) <> '' AS has_name, trim(coalesce(linkedin, '')) <> '' AS has_linkedin,
    trim(coalesce(company, '')) <> '' AS has_company, trim(coalesce(last_subject, '')) <> '' OR trim(coalesce(last_summary, '')) <> '' OR trim(coalesce(description, '')) <> '' AS readable, {local_class("primary_email")} AS local_part, {domain_class("primary_email")} AS domain_kind,
    coalesce(d.n, 0) AS same_domain, {domain("primary_email")} AS domain, NOT {auto_reply("last_subject")} AND {transactional("last_subject")} AS transactional, last_interaction, coalesce(d.n, 0) >= 2 AS client_team
FROM v_people p LEFT JOIN o_domains d ON d.domain = {domain("primary_email")}""",
    "o_parts": """SELECT *, list_filter([
    {'label': 'base', 'delta': 10},
    CASE WHEN strength IS NULL THEN {'label': 'no connection strength computed by Attio', 'delta': 0} ELSE {'label': 'connection strength ' || strength || CASE WHEN strength_legacy IS NULL THEN '' ELSE ' (' || printf('%.1f', strength_legacy) || ')' END,
        'delta': CASE strength WHEN 'Very strong' THEN 45 WHEN 'Strong' THEN 35 WHEN 'Good' THEN 22 WHEN 'Weak' THEN 5 ELSE -12 END} END,
    CASE WHEN NOT span_known THEN {'label': 'no interaction dates on record — span unknown', 'delta': 0} WHEN span_days >= 365 THEN {'label': span_days || 'd span (years)', 'delta': 18} WHEN span_days >= 90 THEN {'label': span_days || 'd span (months)', 'delta': 14}
        WHEN span_days >= 30 THEN {'label': span_days || 'd span', 'delta': 10} WHEN span_days >= 7 THEN {'label': span_days || 'd span', 'delta': 6} WHEN span_days >= 1 THEN {'label': span_days || 'd span', 'delta': 2} ELSE {'label': 'single day only, no span', 'delta': -6} END,
    CASE WHEN client_team THEN {'label': 'client-team coherence (' || same_domain || ' candidates @' || domain || ')', 'delta': 12} END,
    CASE WHEN transactional THEN {'label': 'transactional subject line', 'delta': -15} END,
    CASE WHEN domain_kind = 'freemail' AND NOT has_company AND coalesce(strength IN ('Good', 'Strong', 'Very strong'), false) THEN {'label': 'high contact volume on a personal address with no company (' || strength || ')', 'delta': -18} END,
    CASE WHEN last_direction = 'inbound' THEN {'label': 'last interaction was inbound', 'delta': 3} END,
    CASE WHEN has_name THEN {'label': 'real name on record', 'delta': 8} ELSE {'label': 'no name on record (unmintable until added)', 'delta': -10} END,
    CASE WHEN local_part = 'personal' THEN {'label': 'personal address', 'delta': 6} WHEN local_part = 'generic-role' THEN {'label': 'generic company inbox', 'delta': -8} END,
    CASE WHEN domain_kind = 'company' THEN {'label': 'company domain', 'delta': 3} END,
    CASE WHEN has_linkedin THEN {'label': 'LinkedIn URL present', 'delta': 6} END], lambda x: x IS NOT NULL) AS parts FROM o_signals""",
    "o_scored": f"SELECT *, {band('score')} AS band FROM (SELECT *, CAST(greatest(0, least(100, list_sum(list_transform(parts, lambda x: x.delta)))) AS INTEGER) AS score FROM o_parts)",
    "o_open": "SELECT * FROM v_tasks WHERE task_id <> '' AND status = 'Open'",
    "o_clusters": f"SELECT cluster_key, first(contact_id ORDER BY created_at, sheet_row) AS contact_id, first(contact_name ORDER BY created_at, sheet_row) AS contact_name, first(description ORDER BY created_at, sheet_row) AS description, min(created_at) AS earliest_created_at, max({flex('due_date')}) AS latest_due, list(task_id ORDER BY created_at, sheet_row) AS task_ids, list_filter(list(related_activity_id), lambda r: r <> '') AS origins FROM (SELECT *, CASE WHEN trim(contact_id) <> '' THEN contact_id ELSE contact_name END || '::' || {description('description')} AS cluster_key FROM o_open) GROUP BY cluster_key",
    "o_items": f"""SELECT *, CASE WHEN ref_id <> '' THEN ref_id ELSE type || ':' || contact END AS key FROM (
    SELECT 0 AS bucket, 'task' AS type, contact_name AS contact, contact_id AS ref_id, 'Overdue since ' || {day_text(flex("due_date"))} || ' — ' || priority || ' priority' AS reason, -({TODAY} - {flex("due_date")}) AS o1, 0 AS o2, lpad(CAST(sheet_row AS VARCHAR), 9, '0') AS o3 FROM o_open WHERE priority IN ('High', 'Urgent') AND {TODAY} - {flex("due_date")} > 0
    UNION ALL SELECT 1, 'reply', contact_name, ref_id, left(CASE WHEN trim(brain_notes) <> '' THEN brain_notes ELSE running_summary END, 100), 0, 0, lpad(CAST(sheet_row AS VARCHAR), 9, '0') FROM v_brain WHERE action_required = 'REPLY_NEEDED'
    UNION ALL SELECT 2, 'opportunity', contact_name, ref_id, left(evidence, 100), 0, 0, contact_name || '|' || record_id FROM v_proposals WHERE upper(trim(status)) = 'PENDING'
    UNION ALL SELECT 3, 'outreach', coalesce(person_name, master_name, ref_id, record_id), coalesce(ref_id, ''), follow_up_reason, CASE WHEN stalled THEN 0 ELSE 1 END, -coalesce(days_since, -1), record_id FROM o_cadence WHERE next_check_in <= {TODAY} OR stalled
    UNION ALL SELECT 4, 'action', contact_name, ref_id, left(running_summary, 100), 0, 0, lpad(CAST(sheet_row AS VARCHAR), 9, '0') FROM v_brain WHERE action_required = 'ACTION_ITEM')""",
    "o_plan": "SELECT * FROM (SELECT *, row_number() OVER (ORDER BY bucket, pos) AS priority FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY bucket, pos) AS nth FROM (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY o1, o2, o3) AS pos FROM o_items) WHERE pos <= CASE bucket WHEN 0 THEN 3 WHEN 1 THEN 4 WHEN 2 THEN 3 WHEN 3 THEN 4 ELSE 3 END) WHERE nth = 1) WHERE priority <= 10",
    "o_counts": f"SELECT (SELECT count(*) FROM v_brain WHERE action_required = 'REPLY_NEEDED') AS emails_pending, (SELECT count(*) FROM o_open WHERE {flex('due_date')} < {TODAY}) AS tasks_overdue, (SELECT count(*) FROM o_cadence WHERE next_check_in <= {TODAY}) AS pipeline_touches, (SELECT count(*) FROM o_cadence WHERE stalled) AS stale_relationships",
    "o_excluded": f"SELECT DISTINCT record_id FROM v_exclusions WHERE record_id <> '' UNION SELECT DISTINCT p.record_id FROM v_people p, unnest({split_list('lower(all_emails)')}) AS u(email) WHERE u.email IN (SELECT lower(trim(email)) FROM v_exclusions WHERE email <> '')",
    "o_merged": f"""SELECT record_id, action, CASE WHEN taken THEN 'pending' ELSE old_status END AS status, CASE WHEN taken THEN band ELSE old_band END AS band, CASE WHEN taken THEN CAST(score AS DOUBLE) ELSE old_probability END AS probability, starts_with(action, 'dropped') AS dropped FROM (
    SELECT *, action IN ('new', 'rescored', 'reactivated-new-evidence', 'reactivated-skip-expired') AS taken FROM (SELECT *, CASE WHEN score IS NULL AND bridged THEN 'dropped-bridged' WHEN score IS NULL AND excluded THEN 'dropped-excluded' WHEN score IS NULL THEN 'kept-unseen' WHEN state IS NULL THEN 'new' WHEN state IN ('', 'pending') THEN 'rescored'
        WHEN state = 'skipped' AND coalesce(last_interaction > {civil("last_scored")}, false) THEN 'reactivated-new-evidence' WHEN state = 'skipped' AND coalesce({civil("skip_until")} <= {TODAY}, false) THEN 'reactivated-skip-expired' WHEN state = 'skipped' THEN 'preserved-skip' ELSE 'preserved-decision' END AS action
    FROM (SELECT coalesce(s.record_id, q.record_id) AS record_id, s.score, s.band, s.last_interaction, q.status AS old_status, lower(trim(q.status)) AS state, q.skip_until, q.last_scored, coalesce(TRY_CAST(trim(q.probability) AS DOUBLE), 0.0) AS old_probability,
            CASE WHEN lower(trim(q.band)) IN ('keepers', 'unclear', 'junk') THEN lower(trim(q.band)) ELSE {band("coalesce(TRY_CAST(trim(q.probability) AS DOUBLE), 0.0)")} END AS old_band,
            coalesce(s.record_id, q.record_id) IN (SELECT record_id FROM v_people WHERE crm_ref_id <> '') AS bridged, coalesce(s.record_id, q.record_id) IN (SELECT record_id FROM o_excluded) AS excluded
        FROM (SELECT * FROM o_scored WHERE record_id IN (SELECT record_id FROM v_people WHERE crm_ref_id = '') AND record_id NOT IN (SELECT record_id FROM o_excluded)) s FULL JOIN v_queue q ON q.record_id = s.record_id)))""",
    "o_scan": f"""SELECT p.*, CASE WHEN e.record_id IS NOT NULL THEN 'already_on_pipeline' WHEN m.ref_id IS NULL THEN 'no_master_id_row' WHEN regexp_matches(regexp_extract(last_url, '/calls/([0-9]+)', 1), '^({"|".join(f"{d}{{6,}}" for d in range(10))})$') THEN 'synthetic_test_record' WHEN x.record_id IS NOT NULL THEN 'already_proposed' END AS rule, {evidence("last_outcome", "last_subject", "last_summary")} AS evidence
FROM v_people p LEFT JOIN (SELECT DISTINCT record_id FROM v_pipeline) e ON e.record_id = p.record_id LEFT JOIN o_index m ON m.ref_id = p.crm_ref_id LEFT JOIN (SELECT DISTINCT record_id FROM v_proposals) x ON x.record_id = p.record_id""",
    "o_msgs": f"SELECT thread_id, message_id, pos, direction, lower(sender_email) AS sender_email, lower(recipient_email) AS recipient_email, list_distinct(list_filter({split_list('lower(cc)')}, lambda e: contains(e, '@'))) AS cc, {split_list('lower(cc)')} AS cc_ordered, subject, body FROM v_messages QUALIFY row_number() OVER (PARTITION BY thread_id, message_id ORDER BY pos) = 1",
    "o_runset": "SELECT *, CASE WHEN act THEN row_number() OVER (PARTITION BY run_id, act ORDER BY sheet_row) END AS position FROM (SELECT *, action_required IN ('REPLY_NEEDED', 'ACTION_ITEM') AS act FROM v_brain WHERE upper(trim(resolved)) <> 'TRUE')",
    "o_feed": "SELECT * FROM (SELECT tab, sheet_row, lower(rtrim(trim(url), '/')) AS url, name, segment, email FROM v_segments) WHERE url <> '' QUALIFY row_number() OVER (PARTITION BY url ORDER BY tab, sheet_row) = 1",
    "o_emailmap": "SELECT lower(trim(primary_email)) AS email, contact_id, sheet_row FROM v_contacts WHERE lower(trim(primary_email)) <> '' AND trim(contact_id) <> '' QUALIFY row_number() OVER (PARTITION BY lower(trim(primary_email)) ORDER BY sheet_row) = 1",
}


def expand(sql: str) -> str:
    """SQL with the derived relations and views that it names put before it."""
    order: list[str] = []

    def need(text: str) -> None:
        for name in dict.fromkeys(re.findall(r"\bo_[a-z]+\b", text)):
            if name in RELATIONS and name not in order:
                need(RELATIONS[name])
                if name not in order:
                    order.append(name)

    need(sql)
    if order:
        rest = sql.strip()
        more, rest = (", ", rest[5:]) if rest.upper().startswith("WITH ") else (" ", rest)
        sql = f"WITH {', '.join(f'{n} AS ({RELATIONS[n].strip()})' for n in order)}{more}{rest}"
    return with_views(sql)
