"""The daily plan: five capped buckets, overflow, mission status, counts and the brief's text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import dates, text
from .tasks import open_tasks

#: Bucket caps in order, plan and overflow caps.
CAPS = {"task": 3, "reply": 4, "opportunity": 3, "outreach": 4, "action": 3}
PLAN, OVERFLOW, REASON = 10, 40, 100
COLUMNS = ["type", "contact", "ref_id", "reason", "o1", "o2", "o3"]


def bucket_items(tasks: DataFrame, brain: DataFrame, cadence: DataFrame, proposals: DataFrame, today: str) -> DataFrame:
    """All candidates with their bucket and sort keys (o1, o2, o3 ascending)."""
    day, col = F.lit(today).cast("date"), F.col
    due = dates.flexible_date(col("due_date"))
    late = open_tasks(tasks).withColumn("due", due).filter(col("priority").isin("High", "Urgent") & (F.datediff(day, "due") > 0))
    zero = F.lit(0)
    task = late.select(F.lit("task").alias("type"), col("contact_name").alias("contact"), col("contact_id").alias("ref_id"), F.concat(F.lit("Overdue since "), dates.as_text(col("due")), F.lit(" — "), "priority", F.lit(" priority")).alias("reason"), (-F.datediff(day, "due")).alias("o1"), zero.alias("o2"), col("sheet_row").cast("string").alias("o3"))
    order = F.lpad(col("sheet_row").cast("string"), 9, "0")
    task = task.withColumn("o3", F.lpad("o3", 9, "0"))
    said = F.coalesce(text.filled(col("brain_notes")), col("running_summary"))
    reply = brain.filter("action_required = 'REPLY_NEEDED'").select(F.lit("reply").alias("type"), col("contact_name").alias("contact"), "ref_id", F.left(said, F.lit(REASON)).alias("reason"), zero.alias("o1"), zero.alias("o2"), order.alias("o3"))
    action = brain.filter("action_required = 'ACTION_ITEM'").select(F.lit("action").alias("type"), col("contact_name").alias("contact"), "ref_id", F.left("running_summary", F.lit(REASON)).alias("reason"), zero.alias("o1"), zero.alias("o2"), order.alias("o3"))
    chance = proposals.filter(F.upper(F.trim("status")) == "PENDING").select(F.lit("opportunity").alias("type"), col("contact_name").alias("contact"), "ref_id", F.left("evidence", F.lit(REASON)).alias("reason"), zero.alias("o1"), zero.alias("o2"), F.concat("contact_name", F.lit("|"), "record_id").alias("o3"))
    due_rows = cadence.filter((col("next_check_in") <= day) | col("stalled"))
    name = F.coalesce("person_name", "master_name", "ref_id", "record_id")
    reach = due_rows.select(F.lit("outreach").alias("type"), name.alias("contact"), F.coalesce("ref_id", F.lit("")).alias("ref_id"), col("follow_up_reason").alias("reason"), F.when(col("stalled"), 0).otherwise(1).alias("o1"), (-F.coalesce("days_since", F.lit(-1))).alias("o2"), col("record_id").alias("o3"))
    out = task
    for part in (reply, chance, reach, action):
        out = out.unionByName(part)
    rank = F.lit(None).cast("int")
    for i, t in enumerate(CAPS):
        rank = F.when(col("type") == t, i).otherwise(rank)
    return out.withColumns({"bucket": rank, "key": F.when(col("ref_id") != "", col("ref_id")).otherwise(F.concat("type", F.lit(":"), "contact"))})


def _bucket_top(items: DataFrame, most: int) -> DataFrame:
    """The first ``most`` rows of each bucket: Spark keeps that many per task before the shuffle."""
    w = Window.partitionBy("bucket").orderBy("o1", "o2", "o3")
    return items.withColumn("pos", F.row_number().over(w)).filter(F.col("pos") <= most)


def plan(items: DataFrame) -> DataFrame:
    """Caps first, then one item a key, then the global cap. At most 17 rows are ranked globally."""
    cap = F.lit(None).cast("int")
    for i, n in enumerate(CAPS.values()):
        cap = F.when(F.col("bucket") == i, n).otherwise(cap)
    held = _bucket_top(items, max(CAPS.values())).filter(F.col("pos") <= cap)
    held = held.withColumn("nth", F.row_number().over(Window.partitionBy("key").orderBy("bucket", "pos"))).filter("nth = 1")
    out = held.withColumn("priority", F.row_number().over(Window.orderBy("bucket", "pos")))
    return out.filter(F.col("priority") <= PLAN).select("priority", "type", "contact", "ref_id", "reason", "key")


def overflow(items: DataFrame, planned: DataFrame) -> DataFrame:
    """What the plan left out, one item a (type, key), from priority 11, at most 40."""
    rest = items.join(F.broadcast(planned.select("type", "key")), ["type", "key"], "left_anti")
    columns = [c for c in rest.columns if c not in ("type", "key")]
    first = rest.groupBy("type", "key").agg(F.min_by(F.struct(*columns), F.struct("o1", "o2", "o3")).alias("r")).select("type", "key", "r.*")
    head = first.orderBy("bucket", "o1", "o2", "o3").limit(OVERFLOW)
    out = head.withColumn("priority", F.row_number().over(Window.orderBy("bucket", "o1", "o2", "o3")) + PLAN)
    return out.select("priority", "type", "contact", "ref_id", "reason", "key")


def mission(pipeline: DataFrame, cadence: DataFrame, today: str) -> DataFrame:
    """Per track: active records, stalled, next touch (overdue first), and for FTE the longest silence."""
    day = F.lit(today).cast("date")
    tracks = pipeline.select("record_id", F.explode(F.array(*(F.struct(F.lit(t).alias("track"), text.stage_number(F.col(c)).alias("stage")) for t, c in (("tnb", "tnb_stage"), ("fte", "fte_stage"), ("fractional", "fractional_stage"))))).alias("t"))
    active = tracks.filter("t.stage >= 1").select("record_id", "t.track").distinct()
    rows = active.join(cadence.select("record_id", "stalled", "next_check_in", "days_since", F.coalesce("person_name", "master_name", "ref_id", "record_id").alias("who")), "record_id")
    order = F.struct(F.when(F.col("next_check_in") <= day, 0).otherwise(1), F.col("next_check_in"), F.col("record_id"))
    out = rows.groupBy("track").agg(F.countDistinct("record_id").alias("active"), F.count_if("stalled").alias("stalled"), F.min_by("who", order).alias("next_touch"), F.max("days_since").alias("days"))
    return out.select("track", "active", "stalled", "next_touch", F.when(F.col("track") == "fte", F.col("days")).alias("days_since_touch"))


def counts(tasks: DataFrame, brain: DataFrame, cadence: DataFrame, today: str) -> DataFrame:
    day = F.lit(today).cast("date")
    a = brain.agg(F.count_if(F.col("action_required") == "REPLY_NEEDED").alias("emails_pending"))
    b = open_tasks(tasks).agg(F.count_if(dates.flexible_date(F.col("due_date")) < day).alias("tasks_overdue"))
    c = cadence.agg(F.count_if(F.col("next_check_in") <= day).alias("pipeline_touches"), F.count_if("stalled").alias("stale_relationships"))
    return a.join(F.broadcast(b), F.lit(True)).join(F.broadcast(c), F.lit(True))  # one row each


def brief_text(totals: DataFrame, planned: DataFrame) -> DataFrame:
    def some(n: str, one: str):
        return F.concat(F.col(n).cast("string"), F.lit(f" {one}"), F.when(F.col(n) == 1, "").otherwise("s"))

    head = F.concat_ws(", ", some("emails_pending", "email"), some("tasks_overdue", "overdue task"), some("pipeline_touches", "pipeline touch"), some("stale_relationships", "stale contact"))
    lines = planned.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("priority", "type", "contact"))), lambda x: F.concat(x.priority.cast("string"), F.lit(". "), x.type, F.lit(": "), x.contact)), "\n").alias("lines"))
    return totals.join(F.broadcast(lines), F.lit(True)).select(F.concat(head, F.lit("\n"), "lines").alias("brief"))
