"""Triage of unbridged contacts: hard excludes, signals, itemised score, bands, LLM gate."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import cells, dates, emails, names, text
from ..params import Params

#: Score weights.
STRENGTH = {"Very strong": 45, "Strong": 35, "Good": 22, "Weak": 5, "Very weak": -12}
SPANS = [(365, 18, "d span (years)"), (90, 14, "d span (months)"), (30, 10, "d span"), (7, 6, "d span"), (1, 2, "d span")]
BASE, SINGLE_DAY, TEAM, SUBJECT, TRAP, INBOUND, NAME, NO_NAME, PERSONAL, GENERIC, COMPANY, LINKEDIN = 10, -6, 12, -15, -18, 3, 8, -10, 6, -8, 3, 6
KEEPER, JUNK, TEAM_SIZE = 75, 25, 2
LLM_MIN, LLM_MAX, CLAMP = 15, 90, 30
CLIP = 240
#: Lower bounds of strength bands.
BOUNDS = [(45, "Very strong"), (30, "Strong"), (15, "Good"), (5, "Weak"), (0, "Very weak")]


def strength_band(value: Column, label: Column) -> Column:
    out = F.when(value.isNull(), label)
    for least, name in BOUNDS:
        out = out.when(value >= least, name)
    return out.otherwise(label)


def hard_exclude(people: DataFrame, p: Params) -> DataFrame:
    """(record_id, reason, recoverable): the first rule that holds, null where none does."""
    stamp = dates.moment(F.col("created_at"))
    listed = cells.split_list(F.coalesce("all_emails", F.lit("")))
    listed = F.when(F.size(listed) > 0, listed).otherwise(F.filter(F.array("primary_email"), lambda e: e != ""))
    low, high = (F.lit(x).cast("timestamp") for x in p.cohort)
    cohort = F.coalesce((stamp >= low) & (stamp < high), F.lit(False))
    surname = names.surname(F.col("name"))
    family = reduce(lambda a, b: a | b, [(surname != "") & (F.instr(surname, s) > 0) for s in p.family_surnames])
    reason = (
        F.when(cohort, "compromise cohort")
        .when(F.exists(listed, lambda e: emails.owned(e, p.owned_emails)), "own address")
        .when(family, "family")
        .when(F.exists(listed, lambda e: emails.domain(e).isin(*p.owned_domains)), "internal")
        .when((F.size(listed) > 0) & F.forall(listed, emails.is_role), "unattended role/no-reply address")
    )
    return people.select("record_id", reason.alias("reason"), cohort.alias("recoverable"))


def exclusion_match(people: DataFrame, exclusions: DataFrame) -> DataFrame:
    """(record_id, kind) of people on the list, by record id or any of their addresses; the id is named first."""
    by_id = people.join(exclusions.filter("record_id <> ''").select("record_id").distinct(), "record_id", "left_semi").select("record_id", F.lit(0).alias("k"))
    address = people.select("record_id", F.explode(cells.split_list(F.lower("all_emails"))).alias("email"))
    listed = exclusions.filter("email <> ''").select(F.lower(F.trim("email")).alias("email")).distinct()
    by_mail = address.join(listed, "email", "left_semi").select("record_id", F.lit(1).alias("k"))
    both = by_id.unionByName(by_mail).groupBy("record_id").agg(F.min("k").alias("k"))
    return both.select("record_id", F.when(F.col("k") == 0, "record_id").otherwise("email").alias("kind"))


def domain_counts(people: DataFrame) -> DataFrame:
    rows = people.select(emails.domain(F.col("primary_email")).alias("domain")).filter((F.col("domain") != "") & ~F.col("domain").isin(*emails.FREEMAIL))
    return rows.groupBy("domain").agg(F.count(F.lit(1)).alias("n"))


def provenance(subject: Column, summary: Column, description: Column, role: Column, company: Column, last: Column) -> Column:
    s, m, d, r, c = (text.clip(text.squeeze(x), CLIP) for x in (subject, summary, description, role, company))
    item = lambda t, day, source: F.struct(t.alias("text"), day.alias("date"), F.lit(source).alias("source"))
    none = F.lit(None).cast("date")
    return (
        F.when((s != "") & ~emails.is_auto_reply(s), item(s, last, "last-interaction-subject"))
        .when(m != "", item(m, last, "last-meeting-summary"))
        .when(d != "", item(d, none, "description"))
        .when((r != "") & (c != ""), item(F.concat(r, F.lit(" at "), c), none, "role-and-company"))
        .when(r != "", item(r, none, "role-and-company"))
        .when(c != "", item(c, none, "role-and-company"))
    )


def signals(people: DataFrame) -> DataFrame:
    """What the score is made of. Domain counts are a small aggregate joined back, not a window over a hot domain."""
    col = F.col
    rows = people.withColumn("domain", emails.domain(col("primary_email")))
    rows = rows.join(domain_counts(people).withColumnRenamed("n", "domain_n"), "domain", "left")
    auto = emails.is_auto_reply(col("last_subject"))
    filled = lambda c: F.trim(F.coalesce(c, F.lit(""))) != ""
    return rows.select(
        "record_id",
        strength_band(col("strength_legacy"), col("strength_label")).alias("strength"),
        col("strength_legacy"),
        emails.direction(col("last_direction")).alias("last_direction"),
        F.greatest(F.lit(0), F.datediff("last_interaction", "first_interaction")).alias("_span"),
        (col("first_interaction").isNotNull() & col("last_interaction").isNotNull()).alias("span_known"),
        filled(col("name")).alias("has_name"),
        filled(col("linkedin")).alias("has_linkedin"),
        filled(col("company")).alias("has_company"),
        (filled(col("last_subject")) | filled(col("last_summary")) | filled(col("description"))).alias("readable"),
        emails.local_class(col("primary_email")).alias("local_part"),
        emails.domain_class(col("primary_email")).alias("domain_kind"),
        F.coalesce("domain_n", F.lit(0)).alias("same_domain"),
        "domain",
        (~auto & emails.is_transactional(col("last_subject"))).alias("transactional"),
        "last_interaction",
    ).withColumns({"span_days": F.when(col("span_known"), col("_span")).otherwise(0), "client_team": col("same_domain") >= TEAM_SIZE}).drop("_span")


def contributions() -> Column:
    """Array of (label, delta), in order; notes have delta 0."""
    col = F.col

    def item(label, delta, when=None):
        label, delta = (x if isinstance(x, Column) else F.lit(x) for x in (label, delta))
        s = F.struct(label.alias("label"), delta.cast("int").alias("delta"))
        return s if when is None else F.when(when, s)

    weight, detail = F.lit(0), F.when(col("strength_legacy").isNotNull(), F.concat(F.lit(" ("), F.format_string("%.1f", "strength_legacy"), F.lit(")"))).otherwise("")
    for k, v in STRENGTH.items():
        weight = F.when(col("strength") == k, v).otherwise(weight)
    days = col("span_days").cast("string")
    span = F.when(~col("span_known"), item("no interaction dates on record — span unknown", 0))
    for least, delta, said in SPANS:
        span = span.when(col("span_days") >= least, item(F.concat(days, F.lit(said)), delta))
    trap = (col("domain_kind") == "freemail") & ~col("has_company") & F.coalesce(col("strength").isin("Good", "Strong", "Very strong"), F.lit(False))
    return F.array_compact(
        F.array(
            item("base", BASE),
            F.when(col("strength").isNull(), item("no connection strength computed by Attio", 0)).otherwise(item(F.concat(F.lit("connection strength "), "strength", detail), weight)),
            span.otherwise(item("single day only, no span", SINGLE_DAY)),
            item(F.concat(F.lit("client-team coherence ("), col("same_domain").cast("string"), F.lit(" candidates @"), "domain", F.lit(")")), TEAM, col("client_team")),
            item("transactional subject line", SUBJECT, col("transactional")),
            item(F.concat(F.lit("high contact volume on a personal address with no company ("), "strength", F.lit(")")), TRAP, trap),
            item("last interaction was inbound", INBOUND, col("last_direction") == "inbound"),
            F.when(col("has_name"), item("real name on record", NAME)).otherwise(item("no name on record (unmintable until added)", NO_NAME)),
            F.when(col("local_part") == "personal", item("personal address", PERSONAL)).when(col("local_part") == "generic-role", item("generic company inbox", GENERIC)),
            item("company domain", COMPANY, col("domain_kind") == "company"),
            item("LinkedIn URL present", LINKEDIN, col("has_linkedin")),
        )
    )


def band(score: Column) -> Column:
    return F.when(score >= KEEPER, "keepers").when(score <= JUNK, "junk").otherwise("unclear")


def reason(parts: Column, score: Column) -> Column:
    """Notes first, then the four largest deltas, the earlier first where they tie."""
    notes = F.transform(F.filter(parts, lambda x: x.delta == 0), lambda x: x.label)
    ranked = F.transform(parts, lambda x, i: F.struct((-F.abs(x.delta)).alias("w"), i.alias("i"), x.label.alias("label"), x.delta.alias("delta")))
    ranked = F.slice(F.array_sort(F.filter(ranked, lambda x: (x.delta != 0) & (x.label != "base"))), 1, 4)
    said = F.transform(ranked, lambda x: F.concat(x.label, F.lit(" ("), F.when(x.delta > 0, "+").otherwise(""), x.delta.cast("string"), F.lit(")")))
    both = F.concat(notes, said)
    tail = F.when(F.size(both) == 0, "no distinguishing signals").otherwise(F.array_join(both, "; "))
    return F.concat(F.lit("score "), score.cast("string"), F.lit(": "), tail)


def scored(people: DataFrame) -> DataFrame:
    rows = signals(people).withColumn("parts", contributions())
    raw = F.aggregate("parts", F.lit(0), lambda a, x: a + x.delta)
    rows = rows.withColumn("score", F.greatest(F.lit(0), F.least(F.lit(100), raw)))
    return rows.withColumns({"band": band(F.col("score")), "reason": reason(F.col("parts"), F.col("score"))})


def histogram(scores: DataFrame) -> DataFrame:
    bucket = F.least(F.lit(10), F.greatest(F.lit(0), F.floor(F.col("score") / 10).cast("int")))
    return scores.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def may_call(readable: Column, score: Column) -> Column:
    return readable & score.between(LLM_MIN, LLM_MAX)


def clamped(score: Column, llm: Column) -> Column:
    return F.greatest(F.greatest(F.lit(0), score - CLAMP), F.least(F.least(F.lit(100), score + CLAMP), llm))


def cross_check(total: Column, bridged: Column, unbridged: Column) -> Column:
    """Of an enumeration and a server's own count: agrees, mismatch, or inconclusive where the server gave none."""
    return F.when(bridged.isNull(), "inconclusive").when(total - bridged == unbridged, "agrees").otherwise("mismatch")
