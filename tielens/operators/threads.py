"""E-mail threads: messages, copies, participants, noise, write targets, and the validation of model output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import cells, emails
from ..params import Params

MESSAGE = "array<struct<email_msg_id string, direction string, sender_email string, recipient_email string, cc_list string, subject string, body string>>"


def _any(patterns: list[str]) -> str:
    return "(?i)" + emails.ascii_borders("|".join(patterns))


#: Noise patterns.
SENSITIVE = _any([r"\bmedical\b", r"\bdiagnosis\b", r"\bprescription\b", r"\bssn\b", r"\bsocial security\b"])
AUTOMATED_SENDER = _any(["^no-?reply@", "^do-?not-?reply@", "^notifications?@", "^alerts?@", "^automated@", "^system@"])
AUTOMATED_SUBJECT = _any([r"\breceipt\b", r"\byour (order|invoice|payment)\b", r"\bpassword reset\b", r"\bverify your (email|account)\b", r"\bunsubscribe\b", r"\baccount statement\b"])
VENDOR_SENDER = _any(["support@", "billing@", "sales@", "orders?@"])
COLD_SUBJECT = _any([r"\bquick question\b", r"\bpartnership opportunity\b", r"\bgrow your (business|audience|list)\b", r"\blimited time offer\b"])
TEST = _any(["lorem ipsum", r"\btest test test\b", r"\bthis is a test\b", r"\basdf+\b"])


def messages(threads: DataFrame) -> DataFrame:
    """One row a message of ``threads(thread_id, raw_emails_json)``: bad JSON gives none, the first of a message id stays."""
    rows = threads.select("thread_id", F.posexplode(F.from_json("raw_emails_json", MESSAGE)).alias("pos", "m")).filter("m is not null")
    low = lambda c: F.lower(F.trim(F.coalesce(c, F.lit(""))))
    rows = rows.select("thread_id", "pos", F.coalesce("m.email_msg_id", F.lit("")).alias("message_id"), F.coalesce("m.direction", F.lit("")).alias("direction"), low(F.col("m.sender_email")).alias("sender_email"), low(F.col("m.recipient_email")).alias("recipient_email"), cc_list(F.col("m.cc_list")).alias("cc"), F.coalesce("m.subject", F.lit("")).alias("subject"), F.coalesce("m.body", F.lit("")).alias("body"))
    keep = rows.groupBy("thread_id", "message_id").agg(F.min("pos").alias("pos"))
    return rows.join(keep, ["thread_id", "message_id", "pos"])


def cc_list(cell: Column) -> Column:
    """Addresses of a JSON array of objects or strings, else of text with ``'address': '...'``."""
    objects = F.from_json(cell, "array<struct<address string>>")
    plain = F.from_json(cell, "array<string>")
    loose = F.regexp_extract_all(cell, F.lit(r"['\"]address['\"]\s*:\s*['\"]([^'\"]+)['\"]"), F.lit(1))
    found = F.when(cell.rlike(r"^\s*\[\s*\{\s*\""), F.transform(objects, lambda o: o.address)).when(cell.rlike(r"^\s*\[\s*\""), plain).otherwise(loose)
    return F.array_distinct(F.filter(F.transform(F.coalesce(found, F.array().cast("array<string>")), lambda e: F.lower(F.trim(e))), lambda e: F.instr(e, "@") > 0))


def participants(msgs: DataFrame, p: Params) -> DataFrame:
    """(thread_id, primary_email, secondaries): who the thread is with. Messages of a thread are few and ordered by pos."""
    m = F.struct("pos", "direction", "sender_email", "recipient_email", "cc")
    rows = msgs.groupBy("thread_id").agg(F.array_sort(F.collect_list(m)).alias("ms"))
    ours = lambda e: emails.owned(e, p.owned_emails, p.owned_domains)
    everyone = F.flatten(F.transform("ms", lambda x: F.concat(F.array(x.sender_email, x.recipient_email), x.cc)))
    external = F.filter(everyone, lambda e: (e != "") & ~ours(e))
    out = F.filter("ms", lambda x: x.direction == "Outbound")
    last_out, last = F.try_element_at(out, F.lit(-1)), F.try_element_at("ms", F.lit(-1))
    copied = F.filter(last_out.cc, lambda e: ~ours(e))
    ranked = F.transform(F.array_distinct(external), lambda e: F.struct((-F.size(F.filter(external, lambda x: x == e))).alias("n"), F.array_position(external, e).alias("at"), e.alias("e")))
    frequent = F.get(F.array_sort(ranked), F.lit(0)).e
    outbound = F.when((last_out.recipient_email != "") & ~ours(last_out.recipient_email), last_out.recipient_email).when(F.size(copied) > 0, F.get(copied, F.lit(0))).otherwise(frequent)
    inbound = F.when((last.sender_email != "") & ~ours(last.sender_email), last.sender_email)
    first = F.get("ms", F.lit(0))
    primary = F.when(first.direction == "Outbound", outbound).otherwise(inbound)
    rows = rows.select("thread_id", primary.alias("primary_email"), F.array_distinct(external).alias("external"))
    return rows.select("thread_id", "primary_email", F.filter("external", lambda e: ~e.eqNullSafe(F.col("primary_email"))).alias("secondaries"))


def noise(msgs: DataFrame) -> DataFrame:
    """(thread_id, tag): the first class any of whose patterns any message has; null defers to enrichment."""
    hit = lambda c, p: F.bool_or(F.col(c).rlike(p))
    rows = msgs.groupBy("thread_id").agg(
        (hit("body", SENSITIVE) | hit("subject", SENSITIVE)).alias("s"), (hit("sender_email", AUTOMATED_SENDER) | hit("subject", AUTOMATED_SUBJECT)).alias("a"), hit("sender_email", VENDOR_SENDER).alias("v"), hit("subject", COLD_SUBJECT).alias("c"), (hit("body", TEST) | hit("subject", TEST)).alias("is_test")
    )
    tag = F.when(F.col("s"), "noise:sensitive").when(F.col("a"), "noise:automated").when(F.col("v"), "vendor").when(F.col("c"), "noise:cold")
    return rows.select("thread_id", tag.alias("tag"), "is_test")


def reply_recipients(primary: Column, secondaries: Column) -> Column:
    """(mode, to, cc) of a reply: group where others took part."""
    mode = F.when(primary.isNull(), "").when(F.size(secondaries) == 0, "individual").otherwise("group")
    return F.struct(mode.alias("mode"), primary.alias("to"), secondaries.alias("cc"))


def write_targets(rows: DataFrame) -> DataFrame:
    """JSON of where a thread's result goes; a side is left out where the location doesn't claim it or it has drifted."""
    has = lambda side: F.col("location").isin(side.upper(), "BOTH") & (F.instr("tags", side) == 0)
    google = F.when(has("google") & F.col("google_row").isNotNull(), F.struct(F.col("google_row").alias("google_row")))
    attio = F.when(has("attio") & (F.col("attio_record_id") != ""), F.struct(F.col("attio_record_id").alias("record_id")))
    primary = F.struct("ref_id", google.alias("google"), attio.alias("attio"))
    return rows.select("ref_id", F.to_json(F.struct(primary.alias("primary"))).alias("write_targets"))


def parse_write_targets(cell: Column) -> Column:
    """The struct, null unless it names a primary contact."""
    parsed = F.from_json(cell, "primary struct<ref_id string, google struct<google_row int>, attio struct<record_id string>>")
    return F.when(F.coalesce(parsed.primary.ref_id, F.lit("")) != "", parsed)


def parse_tasks(cell: Column) -> Column:
    """Task items with a description."""
    items = F.from_json(cell, "array<struct<description string, due_date string, priority string>>")
    return F.filter(F.coalesce(items, F.array().cast("array<struct<description string, due_date string, priority string>>")), lambda t: F.trim(t.description) != "")


def verdict_of(answer: Column) -> Column:
    """A model's ``{score, reason}``, fences aside: (ok, score, reason, error). Types must be right, the score 0 to 100."""
    bare = F.regexp_replace(F.trim(answer), r"^```(?:json)?\s*|\s*```$", "")
    v = F.try_parse_json(bare)
    score, kind = F.try_variant_get(v, "$.score", "double"), F.schema_of_variant(F.try_variant_get(v, "$.score", "variant"))
    said = F.try_variant_get(v, "$.reason", "string")
    text = F.schema_of_variant(F.try_variant_get(v, "$.reason", "variant")) == "STRING"
    numeric = kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT|INT)")
    error = F.when(v.isNull(), "not JSON").when(~F.coalesce(numeric, F.lit(False)), "score is not a number").when((score < 0) | (score > 100), "score out of range").when(~F.coalesce(text, F.lit(False)) | (F.trim(said) == ""), "reason is missing")
    return F.struct(error.isNull().alias("ok"), F.when(error.isNull(), score).alias("score"), F.when(error.isNull(), said).alias("reason"), error.alias("error"))


def outbound_ceiling(direction: Column, action: Column) -> Column:
    return F.when((direction == "Outbound") & (action == "REPLY_NEEDED"), "FYI_ONLY").otherwise(action)
