"""The passes: named compositions of operators, each a dict of DataFrames (plans, audits, metrics). Nothing runs until a sink asks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import audit, cadence, closing, commands, enrichment as answers, flow, merge, planning, repairs, scoring, tasks, threads, writes
from ..params import PARAMS, Params
from ..sources.views import Tables
from .ports import Completer, answered, stub_answer

Outputs = dict[str, DataFrame]


def placeholders(t: Tables, p: Params = PARAMS) -> Outputs:
    held = tasks.placeholders(t.v_activity)
    return {"matches": tasks.match_placeholders(held, t.v_outbound), "stale": held.filter(tasks.stale(F.col("ts_text"), f"{p.event_day} 00:00:00")).select("activity_id", "ts_text")}


def housekeeping(t: Tables, p: Params = PARAMS) -> Outputs:
    done, left = flow.split_resolved(t.v_brain)
    return {"resolved": done, "survivors": left}


def enrichment(t: Tables, p: Params = PARAMS, completer: Completer = stub_answer) -> Outputs:
    """Noise and resolved threads, the model's answers guarded, where they go, and the result rows."""
    from .catalog import _messages

    msgs = _messages(t)
    who, tags = threads.participants(msgs, p), threads.noise(msgs)
    work = who.join(tags, "thread_id").filter("tag is null and not is_test and primary_email is not null")
    found = merge.resolve(work.select(F.col("primary_email").alias("email")).distinct(), t.v_contacts, t.v_people)
    resolved = work.join(found.withColumnRenamed("email", "primary_email"), "primary_email")
    asked = msgs.join(resolved.select("thread_id", F.col("ref_id").alias("contact_name")), "thread_id")
    last = msgs.groupBy("thread_id").agg(F.max_by("direction", "pos").alias("direction"), F.max_by("subject", "pos").alias("subject"))
    parsed = answers.guarded(answers.parse(answered(answers.prompt(asked), "thread_id", "prompt", completer).join(last, "thread_id")))
    index = cadence.master_index(t.v_master)
    drift = merge.check_drift(index, t.v_contacts, t.v_people).select("ref_id", "tags")
    pointers = index.select("ref_id", "location", "google_row", "attio_record_id", F.col("full_name").alias("contact_name")).join(drift, "ref_id", "left")
    rows = parsed.filter("error is null").join(resolved.select("thread_id", "ref_id", "primary_email", "secondaries"), "thread_id").join(pointers, "ref_id", "left")
    goes = answers.targets(rows.withColumns({"rank": F.lit(0), "day": F.lit(p.today)}))
    blank = {c: F.lit("") for c in answers.RESULT if c not in rows.columns}
    stamped = rows.withColumns(blank).drop("write_targets").join(goes, "thread_id", "left").withColumns({"tag": F.lit(None).cast("string"), "position": F.lit(1)})
    return {"noise": tags.filter("tag is not null"), "resolved": resolved, "failed": parsed.filter("error is not null").select("thread_id", "error"), "warnings": parsed.filter("warnings <> ''").select("thread_id", "warnings"), "targets": goes, "rows": answers.result_rows(stamped, p)}


def reconciliation(t: Tables, p: Params = PARAMS) -> Outputs:
    groups = tasks.clusters(t.v_tasks)
    return {"clusters": groups, "candidates": tasks.candidates(groups, t.v_activity), "supersede": tasks.supersede_targets(groups, t.v_recon), "verdicts": groups.select("cluster_key", tasks.verdict(F.col("latest_due"), p.today).alias("verdict"))}


def digest(t: Tables, p: Params = PARAMS) -> Outputs:
    return {"positions": commands.run_set(t.v_brain)}


def cadences(t: Tables, p: Params = PARAMS) -> Outputs:
    rows = cadence.evaluate(t.v_pipeline, t.v_people, t.v_master, t.v_contacts, p.today)
    scan = merge.scan_opportunities(t.v_people, t.v_pipeline, cadence.master_index(t.v_master), t.v_proposals)
    return {"cadence": rows, "plan": writes.plan_rows(rows.filter("withheld is null"), "record_id", ["next_check_in", "touch_mode", "follow_up_reason"]), "proposals": scan.filter("rule is null"), "exclusions": scan.filter("rule is not null").select("record_id", "rule")}


def cache(t: Tables, p: Params = PARAMS) -> Outputs:
    rows = merge.cache(cadence.master_index(t.v_master), t.v_contacts, t.v_people, t.v_pipeline, p.today)
    return {"cache": rows.filter("withheld is null"), "withheld": rows.filter("withheld is not null")}


def game_plan(t: Tables, p: Params = PARAMS) -> Outputs:
    rows = cadences(t, p)["cadence"]
    items = planning.bucket_items(t.v_tasks, t.v_brain, rows, t.v_proposals, p.today)
    plan = planning.plan(items)
    totals = planning.counts(t.v_tasks, t.v_brain, rows, p.today)
    return {"plan": plan, "overflow": planning.overflow(items, plan), "mission": planning.mission(t.v_pipeline, rows, p.today), "counts": totals, "brief": planning.brief_text(totals, plan)}


def triage(t: Tables, p: Params = PARAMS) -> Outputs:
    out = scoring.hard_exclude(t.v_people, p).filter("reason is not null")
    listed = scoring.exclusion_match(t.v_people, t.v_exclusions)
    gone = out.select("record_id").union(listed.select("record_id")).distinct()
    free = t.v_people.filter("crm_ref_id = ''").join(gone, "record_id", "left_anti")
    scored = scoring.scored(free)
    queue = merge.merge_queue(scored, t.v_queue, t.v_people.filter("crm_ref_id <> ''").select("record_id"), gone, p.today)
    return {"excluded": out, "scored": scored, "queue": queue, "histogram": scoring.histogram(scored)}


def resync(t: Tables, p: Params = PARAMS) -> Outputs:
    rows = audit.resync(t.v_master, t.v_contacts)
    return {"corrections": rows.filter("action = 'correct'"), "unresolvable": rows.filter(F.col("action").startswith("unresolvable"))}


def reconcile(t: Tables, p: Params = PARAMS) -> Outputs:
    findings = audit.all_findings(t.v_master, t.v_people, t.v_contacts).withColumn("severity", audit.severity(F.col("code")))
    names = audit.name_candidates(t.v_master, t.v_people, t.v_contacts)
    return {"findings": findings, "conflicts": audit.suppress_b(names, t.v_conflicts)}


def repair(t: Tables, p: Params = PARAMS) -> Outputs:
    findings = audit.all_findings(t.v_master, t.v_people, t.v_contacts)
    return {
        "candidates": merge.repair_candidates(findings, t.v_master),
        "s1": repairs.repair_s1(t.v_master),
        "a1": repairs.repair_a1(findings, t.v_master, t.v_people),
        "a3": repairs.repair_a3(findings, t.v_master, t.v_people),
        "s4": repairs.repair_s4(t.v_master, t.v_people),
        "i1": repairs.repair_i1(findings, t.v_master, t.v_people),
    }


def command(t: Tables, p: Params = PARAMS, text: str = "PROCEED LATE-EDITION-1000") -> Outputs:
    parsed = commands.parse(t.spark.createDataFrame([(0, text)], "command_id int, text string"))
    done = commands.apply(parsed, t.v_brain)
    rows = t.v_brain.join(done.filter("outcome = 'resolved'").select("sheet_row"), "sheet_row", "left_semi")
    index = cadence.master_index(t.v_master)
    claims = index.select("ref_id", "google_row", "attio_record_id")
    staged = rows.join(claims, "ref_id", "left").withColumns({"direction": F.lit("Inbound"), "outcome": F.lit(""), "tasks": F.array().cast("array<struct<description string, due_date string, priority string>>"), "last_email_date": F.lit("")})
    closed = closing.decided(staged, index, p)
    now = f"{p.today}T00:00:00Z"
    written = {"activity_rows": closing.activity_rows(closed, now), "contact_blocks": closing.contact_blocks(closed, p.today), "history": closing.history_rows(closed, now), "tasks": closing.task_rows(closed, now), "task_creations": closing.task_payloads(closed)}
    return {"outcomes": done, "activity": writes.activity_plan(rows, index, p), "warnings": closed.filter("warnings <> ''").select("thread_id", "warnings"), **written}


PASSES: dict[str, Callable[..., Outputs]] = {
    "pass0": placeholders, "pass1": housekeeping, "pass2": enrichment, "pass2_5": reconciliation, "pass3": digest, "pass4": cadences, "pass4_5": cache, "pass5": game_plan, "contacts-triage": triage, "resync-ids": resync, "reconciler": reconcile, "reconciler-fix": repair, "part-d": command,
}
NIGHTLY = ("pass0", "pass1", "pass2", "pass2_5", "pass3", "pass4", "pass4_5", "pass5")


def nightly(t: Tables, p: Params = PARAMS) -> dict[str, Outputs]:
    """All nightly passes with one run id and one day. A pass that can't be planned is reported and doesn't stop the others."""
    out: dict[str, Outputs] = {}
    for name in NIGHTLY:
        try:
            out[name] = PASSES[name](t, p)
        except Exception as e:  # of any kind: planning reads schemas, files and counts
            out[name] = {"aborted": t.spark.createDataFrame([(name, str(e))], "pass string, reason string")}
    return out
