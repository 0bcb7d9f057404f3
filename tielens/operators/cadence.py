"""Contact cadence: active stage, rule, next check-in, stall, and the gate before a write."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import cells, dates, names, text
from .keys import last_wins, unambiguous

#: Cadence rules (days, touch mode).
STAGES = {1: (4, "Context"), 2: (6, "Context"), 3: (8, "Activation"), 4: (4, "Activation"), 5: (90, "Social")}
TIERS = {"Core": (45, "Context"), "Strategic": (90, "Social"), "Peripheral": (180, "Social")}
REASON_CHARS, MANUAL = 500, " [manual]"


def master_index(master: DataFrame) -> DataFrame:
    """Master rows by contact id: blank ids are gaps, the last row of an id wins."""
    rows = master.filter(F.trim("ref_id") != "").withColumn("location", F.upper(F.trim("location"))).withColumn("google_row", cells.positive_int(F.col("google_row")))
    return last_wins(rows, ["ref_id"], ["master_row"])


def pointer_index(master: DataFrame) -> DataFrame:
    """Master rows by CRM pointer; a pointer that several rows share is removed."""
    rows = master.filter((F.trim("ref_id") != "") & (F.trim("attio_record_id") != ""))
    return unambiguous(rows.select("attio_record_id", "ref_id", "full_name", "master_row"), ["attio_record_id"])


def tier_index(contacts: DataFrame) -> DataFrame:
    rows = contacts.filter((F.trim("contact_id") != "") & (F.trim("relationship_tier") != ""))
    return last_wins(rows.select(F.col("contact_id").alias("ref_id"), "relationship_tier", "sheet_row"), ["ref_id"], ["sheet_row"]).drop("sheet_row")


def _rule(table: dict, key: Column, part: int) -> Column:
    out = F.lit(None)
    for k, v in table.items():
        out = F.when(key == k, F.lit(v[part])).otherwise(out)
    return out


def active_stage(tnb: Column, fte: Column, fractional: Column) -> dict[str, Column]:
    """The highest stage; ties go to TNB, then FTE, then Fractional."""
    a, b, c = (text.stage_number(x) for x in (tnb, fte, fractional))
    most = F.greatest(a, b, c)
    track = F.when(most < 1, F.lit(None)).when(a == most, "TNB").when(b == most, "FTE").otherwise("Fractional")
    return {"stage": most, "track": track}


def cadence(rows: DataFrame, today: str) -> DataFrame:
    """Adds the cadence to rows with ``tnb_stage, fte_stage, fractional_stage, tier, native_touch, manual_touch``."""
    day = F.lit(today).cast("date")
    col = F.col
    out = rows.withColumns(active_stage(col("tnb_stage"), col("fte_stage"), col("fractional_stage")))
    out = out.withColumns({"last_touch": dates.newer(col("native_touch"), col("manual_touch")), "touch_source": dates.touch_source(col("native_touch"), col("manual_touch"))})
    known = col("stage").isin(*STAGES)
    out = out.withColumns(
        {
            "cadence_days": F.when(known, _rule(STAGES, col("stage"), 0)).otherwise(_rule(TIERS, col("tier"), 0)).cast("int"),
            "touch_mode": F.when(known, _rule(STAGES, col("stage"), 1)).otherwise(_rule(TIERS, col("tier"), 1)),
            "reason_base": F.when(known, F.concat("track", F.lit(" Stage "), col("stage").cast("string"))).otherwise(F.concat(F.lit("Tier "), "tier", F.lit(" — no active stage"))),
            "unknown_stage": (col("stage") >= 1) & ~known,
        }
    )
    planned = F.date_add("last_touch", col("cadence_days"))
    late = planned < day
    out = out.withColumns(
        {
            "next_check_in": F.when(col("last_touch").isNull(), F.date_add(day, col("cadence_days"))).when(late, F.date_add(day, F.floor(col("cadence_days") / 2).cast("int"))).otherwise(planned),
            "days_since": F.datediff(day, "last_touch"),
            "overdue_catch_up": F.coalesce(late, F.lit(False)),
        }
    )
    out = out.withColumn("stalled", F.coalesce(col("days_since") > 2 * col("cadence_days"), F.lit(False)))
    stall = F.concat(F.lit(" ⚠ STALLED — "), col("days_since").cast("string"), F.lit("d since last touch (expected every "), col("cadence_days").cast("string"), F.lit("d)"))
    reason = F.concat("reason_base", F.when(col("stalled"), stall).otherwise(""), F.when(col("days_since").isNull(), " — last touch date unknown").otherwise(""))
    reason = F.left(reason, F.lit(REASON_CHARS))
    manual = F.concat(F.left(reason, F.lit(REASON_CHARS - len(MANUAL))), F.lit(MANUAL))
    return out.withColumn("follow_up_reason", F.when(col("touch_source") == "manual", manual).otherwise(reason))


def evaluate(pipeline: DataFrame, people: DataFrame, master: DataFrame, contacts: DataFrame, today: str) -> DataFrame:
    """Pipeline entry -> person -> master -> tier, with cadence and the reason for withholding a write, if any."""
    rows = pipeline.join(people.select("record_id", F.col("name").alias("person_name"), F.col("crm_ref_id").alias("person_ref")).withColumn("fetched", F.lit(True)), "record_id", "left")
    pointer = master.filter((F.trim("ref_id") != "") & (F.trim("attio_record_id") != "")).groupBy(F.col("attio_record_id").alias("record_id"))
    pointer = pointer.agg(F.count(F.lit(1)).alias("pointers"), F.min("ref_id").alias("ref_id"), F.min("full_name").alias("master_name"))
    rows = rows.join(pointer, "record_id", "left")
    rows = rows.join(tier_index(contacts), "ref_id", "left").withColumn("tier", text.tier(F.col("relationship_tier")))
    return cadence(rows, today).withColumn("withheld", gate())


def gate() -> Column:
    """The first reason that holds; null where a write may proceed. An unmapped record proceeds."""
    col = F.col
    verdict = names.verify(col("person_name"), col("master_name"))
    return (
        F.when(col("stage") > max(STAGES), "unknown_stage")
        .when(col("fetched").isNull(), "fetch_failed")
        .when(col("pointers") > 1, "duplicate_pointer")
        .when(col("pointers").isNull(), F.lit(None))
        .when((col("person_ref") != "") & (col("person_ref") != col("ref_id")), "id_mismatch")
        .when(verdict == "MISMATCH", "name_mismatch")
        .when(verdict == "UNVERIFIABLE", "name_unverifiable")
    )
