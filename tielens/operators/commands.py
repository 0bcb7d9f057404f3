"""Human commands on a run: parsing, and what they do to the run's rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

COMMANDS = ("RESOLVE", "PROCEED", "CORRECTIONS", "MIXED")


def parse(commands: DataFrame) -> DataFrame:
    """Of ``commands(command_id, text)``: kind and run id."""
    head = F.trim(F.get(F.split("text", "\n"), F.lit(0)))
    run = F.regexp_extract(head, r"LATE-EDITION-[0-9]+", 0)
    token = F.upper(F.get(F.split(head, r"\s+"), F.lit(0)))
    kind = F.when(run == "", "NO_RUN_ID").when(token.isin(*COMMANDS), token).otherwise("UNRECOGNIZED")
    return commands.select("command_id", "text", kind.alias("kind"), F.when(kind.isin(*COMMANDS), run).alias("run_id"))


def item_lines(parsed: DataFrame) -> DataFrame:
    """(command_id, line_no, n, action, note): items of CORRECTIONS and MIXED; a malformed MIXED line is SKIPPED."""
    rows = parsed.filter(F.col("kind").isin("CORRECTIONS", "MIXED")).select("command_id", "run_id", "kind", F.posexplode(F.split("text", "\n")).alias("line_no", "line")).filter("line_no > 0")
    t = F.trim("line")
    simple, note = F.regexp_extract(t, r"(?i)^[0-9]+\s*:\s*(ACCEPT|DISMISS)$", 1), F.trim(F.regexp_extract(t, r"(?i)^[0-9]+\s*:\s*CORRECT\s*:\s*(.+)$", 1))
    loose = F.trim(F.regexp_extract(t, r"^[0-9]+\s*:\s*(.+)$", 1))
    n = F.regexp_extract(t, r"^([0-9]{1,9})\s*:", 1).try_cast("int")
    mixed = F.when(simple != "", F.upper(simple)).when(note != "", "CORRECT").otherwise("SKIPPED")
    action = F.when(F.col("kind") == "CORRECTIONS", F.when(loose != "", "CORRECT")).otherwise(mixed)
    said = F.when(F.col("kind") == "CORRECTIONS", loose).when(action == "CORRECT", note).when(action == "SKIPPED", t)
    rows = rows.filter(t != "").select("command_id", "run_id", F.col("line_no").cast("int").alias("line_no"), F.when(action != "SKIPPED", n).alias("n"), action.alias("action"), said.alias("note"))
    return rows.filter("action is not null")


def run_set(brain: DataFrame) -> DataFrame:
    """Rows of each run that aren't resolved, with the position of actionable ones in sheet order."""
    rows = brain.filter(F.upper(F.trim("resolved")) != "TRUE")
    act = F.col("action_required").isin("REPLY_NEEDED", "ACTION_ITEM")
    held = rows.filter(act).withColumn("position", F.row_number().over(Window.partitionBy("run_id").orderBy("sheet_row")))
    return held.unionByName(rows.filter(~act).withColumn("position", F.lit(None).cast("int")))


def apply(parsed: DataFrame, brain: DataFrame) -> DataFrame:
    """(command_id, sheet_row, outcome, note): PROCEED resolves all, RESOLVE closes, others act on positions in order."""
    rows = run_set(brain).select("run_id", "sheet_row", "position")
    whole = parsed.filter(F.col("kind").isin("PROCEED", "RESOLVE")).join(rows, "run_id")
    whole = whole.select("command_id", "sheet_row", F.when(F.col("kind") == "PROCEED", "resolved").otherwise("closed").alias("outcome"), F.lit(None).cast("string").alias("note"))
    items = item_lines(parsed).filter("action <> 'SKIPPED'").join(rows.filter("position is not null"), ["run_id"]).filter("n = position")
    done = F.when(F.col("action") == "ACCEPT", "resolved").when(F.col("action") == "DISMISS", "dismissed").otherwise("corrected")
    return whole.unionByName(items.select("command_id", "sheet_row", done.alias("outcome"), "note"))


def digest_kind(total: Column, actionable: Column) -> Column:
    return F.when(total == 0, "failure").when(actionable == 0, "all_clear").otherwise("valid")
