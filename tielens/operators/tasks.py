"""Open tasks against interaction history: clusters, evidence candidates, verdicts, superseding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import cells, dates, emails, names, text

#: Automated sources.
AUTOMATED = "(?i)mark_sent|outreach|" + emails.ascii_borders(r"\bbeat\b")
WINDOW_HOURS, STALE_DAYS = 72, 7


def open_tasks(tasks: DataFrame) -> DataFrame:
    return tasks.filter((F.col("task_id") != "") & (F.col("status") == "Open"))


def clusters(tasks: DataFrame) -> DataFrame:
    """Open tasks by contact and normalised description; members in order of creation."""
    rows = open_tasks(tasks).withColumn("cluster_key", F.concat(F.coalesce(text.filled(F.col("contact_id")), F.col("contact_name")), F.lit("::"), text.description_key(F.col("description"))))
    order = F.struct("created_at", "sheet_row")
    first = F.min_by(F.struct("contact_id", "contact_name", "description"), order)
    out = rows.groupBy("cluster_key").agg(
        first.alias("first"),
        F.min("created_at").alias("earliest_created_at"),
        F.max(dates.flexible_date(F.col("due_date"))).alias("latest_due"),
        F.transform(F.array_sort(F.collect_list(F.struct("created_at", "sheet_row", "task_id", "related_activity_id"))), lambda x: F.struct(x.task_id.alias("task_id"), x.related_activity_id.alias("related"))).alias("members"),
    )
    return out.select("cluster_key", "first.*", "earliest_created_at", dates.as_text(F.col("latest_due")).alias("latest_due_date"), "latest_due", F.transform("members", lambda m: m.task_id).alias("task_ids"), F.filter(F.transform("members", lambda m: m.related), lambda r: r != "").alias("origins"))


def candidates(groups: DataFrame, activity: DataFrame) -> DataFrame:
    """(cluster_key, activity_id): same id or same name, by two equi-joins; not automated, not originating, not earlier."""
    acts = activity.filter((F.col("activity_id") != "") & ~F.col("source").rlike(AUTOMATED)).select("activity_id", F.col("contact_id").alias("cid"), F.col("contact_name").alias("cname"), dates.moment(F.col("ts_text")).alias("at"))
    base = groups.select("cluster_key", "contact_id", "contact_name", "origins", dates.moment(F.col("earliest_created_at")).alias("since"))
    by_id = base.filter("contact_id <> ''").join(acts, F.col("contact_id") == F.col("cid"))
    by_name = base.filter("contact_name <> ''").join(acts, F.col("contact_name") == F.col("cname"))
    met = by_id.unionByName(by_name)
    kept = met.filter(~F.array_contains("origins", F.col("activity_id")) & (F.col("since").isNull() | F.coalesce(F.col("at") >= F.col("since"), F.lit(False))))
    return kept.select("cluster_key", "activity_id").distinct()


def verdict(due: Column, today: str) -> Column:
    """Without evidence: stale once due more than a week ago."""
    return F.when(F.datediff(F.lit(today).cast("date"), due) > STALE_DAYS, "STALE").otherwise("STILL_OPEN")


def supersede_targets(groups: DataFrame, queue: DataFrame) -> DataFrame:
    """(cluster_key, recon_id, verdict): the first open queue row that shares a task with the cluster."""
    left = groups.select("cluster_key", F.explode("task_ids").alias("task_id"))
    right = queue.filter("status = ''").select("sheet_row", "recon_id", F.col("verdict").alias("old_verdict"), F.explode(cells.split_list(F.col("source_task_ids"))).alias("task_id"))
    met = left.join(right, "task_id").groupBy("cluster_key").agg(F.min(F.struct("sheet_row", "recon_id", "old_verdict")).alias("r"))
    return met.select("cluster_key", "r.recon_id", "r.old_verdict")


def reconciled(groups: DataFrame, candidates: DataFrame, answers: DataFrame, today: str) -> DataFrame:
    """Verdicts of clusters from ``answers(cluster_key, has_evidence, evidence_activity_id, evidence_quote, confidence, brain_reasoning, error)``.

    A cluster without ``candidates(cluster_key, activity_id, ts_text)`` needs no answer. Evidence must be one of them; an
    invented id, like an answer that can't be read, gives an error and no verdict.
    """
    some = candidates.groupBy("cluster_key").agg(F.lit(True).alias("asked"))
    named = candidates.groupBy("cluster_key", F.col("activity_id").alias("evidence_activity_id")).agg(F.min("ts_text").alias("at"))
    rows = groups.select("cluster_key", "latest_due", "latest_due_date").join(some, "cluster_key", "left").join(answers, "cluster_key", "left").join(named, ["cluster_key", "evidence_activity_id"], "left")
    asked, handled = F.coalesce("asked", F.lit(False)), F.coalesce(F.col("asked") & F.col("has_evidence"), F.lit(False))
    error = F.when(asked & F.col("error").isNotNull(), F.col("error")).when(asked & F.col("has_evidence").isNull(), "no answer").when(handled & F.col("at").isNull(), F.concat(F.lit("evidence isn't a candidate: "), F.col("evidence_activity_id")))
    stale = F.coalesce(F.datediff(F.lit(today).cast("date"), F.col("latest_due")) > STALE_DAYS, F.lit(False))
    pick = lambda a, b, c: F.when(F.col("problem").isNotNull(), "").when(handled, a).when(stale, b).otherwise(c)
    return rows.withColumn("problem", error).select(
        "cluster_key",
        F.when(F.col("problem").isNull(), pick(F.lit("LIKELY_HANDLED_EVIDENCE"), F.lit("LIKELY_STALE_NO_EVIDENCE"), F.lit("GENUINELY_OPEN"))).alias("verdict"),
        pick(F.col("evidence_quote"), F.lit(""), F.lit("")).alias("evidence_quote"),
        pick(F.col("evidence_activity_id"), F.lit(""), F.lit("")).alias("evidence_source"),
        pick(F.left("at", F.lit(10)), F.col("latest_due_date"), F.lit("")).alias("proposed_completion_date"),
        pick(F.when(F.col("confidence") == "", "medium").otherwise(F.col("confidence")), F.lit("low"), F.lit("")).alias("confidence"),
        F.col("problem").alias("error"),
    )


#: A verdict is written again only if one of these changed.
MATERIAL = ("verdict", "evidence_quote", "confidence", "proposed_completion_date")


def material(old: str, new: str) -> Column:
    """Whether two structs of the material columns differ."""
    out = F.lit(False)
    for c in MATERIAL:
        out = out | ~F.col(f"{old}.{c}").eqNullSafe(F.col(f"{new}.{c}"))
    return out


# ---- placeholders ----


def placeholders(activity: DataFrame) -> DataFrame:
    thread = F.regexp_extract("note", r"(?i)PENDING_CAPTURE\s+thread:(\S+)", 1)
    rows = activity.withColumn("thread_from_note", thread)
    return rows.filter((F.col("activity_id") != "") & (F.col("body").startswith("[PENDING_CAPTURE]") | (thread != "")))


def match_placeholders(held: DataFrame, outbound: DataFrame) -> DataFrame:
    """(activity_id, verdict, thread_id): exact thread, else one name word in common within 72 hours.

    The time window is an equi-join: both sides carry their 72-hour bucket, the outbound side the two beside it too.
    """
    first = outbound.groupBy("thread_id").agg(F.min("sheet_row").alias("sheet_row"))
    exact = held.join(first.select(F.col("thread_id").alias("thread_from_note")), "thread_from_note", "left_semi").select("activity_id", F.lit("EXACT").alias("verdict"), F.col("thread_from_note").alias("thread_id"))
    rest = held.join(exact, "activity_id", "left_anti").select("activity_id", dates.moment(F.col("ts_text")).alias("at"), names.words(F.col("contact_name")).alias("words"))
    seconds = WINDOW_HOURS * 3600
    bucket = lambda c: F.floor(F.unix_timestamp(c) / seconds)
    left = rest.filter("at is not null").select("activity_id", "at", F.explode("words").alias("word"), bucket(F.col("at")).alias("b"))
    right = outbound.select("thread_id", "sheet_row", dates.moment(F.col("last_email_date")).alias("sent"), names.words(F.col("contact_name")).alias("words")).filter("sent is not null")
    right = right.select("thread_id", "sheet_row", "sent", F.explode("words").alias("word"), bucket(F.col("sent")).alias("b0"))
    right = right.withColumn("b", F.explode(F.array(F.col("b0") - 1, F.col("b0"), F.col("b0") + 1)))
    met = left.join(right, ["word", "b"]).filter(F.abs(F.unix_timestamp("sent") - F.unix_timestamp("at")) <= seconds)
    found = met.select("activity_id", "sheet_row", "thread_id").distinct().groupBy("activity_id").agg(F.count(F.lit(1)).alias("n"), F.min("thread_id").alias("thread_id"))
    other = rest.select("activity_id").join(found, "activity_id", "left")
    said = F.when(F.col("n").isNull(), "NO_MATCH").when(F.col("n") == 1, "INFERRED").otherwise("AMBIGUOUS")
    return exact.unionByName(other.select("activity_id", said.alias("verdict"), F.when(F.col("n") == 1, F.col("thread_id")).alias("thread_id")))


def stale(ts_text: Column, now: str) -> Column:
    """Older than a week; an unknown age isn't stale."""
    age = F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp(dates.moment(ts_text))
    return F.coalesce(age > STALE_DAYS * 86400, F.lit(False))
