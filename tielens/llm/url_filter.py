"""URL filter, native: a blocked Bloom filter of listed URLs passes possible hits to an exact hash join.

The listed canonical URLs are folded into a table of 64-bit blocks: one hash picks the block, four more bits of it are
set. A page's URL whose bits are all set in its block is a possible hit and joins the list itself, which removes false
positives. Host rules come first: a rule fits its host and all subdomains if the path starts with the rule's path; the
longest rule string wins. Everything is DataFrame expressions.

Defined results: a null URL or one without ``://`` has empty host and path, fits no rule and is never listed. Repeated
rows are judged one by one. An empty list blocks nothing. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import landed
from .common import BROADCAST_ROWS, grouped_join

#: (verdict, rule): host, then the path's beginning.
RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Keys in a 64-bit block, on average: 16 bits a key.
KEYS_PER_BLOCK = 4


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """Host without ``www.`` or ``m.``, path without ending slashes or ``.html``; null without a host."""
    bare = F.regexp_replace(host, r"^(?:www|m)\.", "")
    return F.when(host != "", F.concat(bare, F.regexp_replace(path, r"(?:\.html|/)+$", "")))


def _place(key: str, blocks: int) -> tuple[Column, Column, Column]:
    """The block, a second hash as column ``g``, and the bits of a key."""
    h = F.xxhash64(key)
    g = F.xxhash64(key, F.lit(1))
    mask = F.lit(0).cast("long")
    for i in range(4):
        mask = mask.bitwiseOR(F.expr("shiftleft(1L, cast(shiftrightunsigned(g, %d) & 63 as int))" % (6 * i)))
    return F.pmod(h, F.lit(blocks)), g, mask


def bloom_blocks(listed: DataFrame, key: str, blocks: int) -> DataFrame:
    """(block, word): the filter, one row per used block."""
    block, g, mask = _place(key, blocks)
    return listed.withColumn("g", g).groupBy(block.alias("block")).agg(F.bit_or(mask).alias("word"))


def possible(rows: DataFrame, key: str, filter_rows: DataFrame, blocks: int) -> DataFrame:
    """``rows`` with ``possible``: whether all bits of the key are set; true for every listed key."""
    block, g, mask = _place(key, blocks)
    probe = rows.withColumn("g", g).withColumn("block", F.coalesce(block, F.lit(-1).cast("long"))).withColumn("mask", mask)
    build = F.broadcast(filter_rows) if blocks <= BROADCAST_ROWS else filter_rows
    asked = probe.join(build, "block", "left")
    set_all = F.coalesce(F.col("word").bitwiseAND(F.col("mask")) == F.col("mask"), F.lit(False)) & F.col(key).isNotNull()
    return asked.withColumn("possible", set_all).drop("g", "block", "mask", "word")


def judge(pages: DataFrame, listed: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, other: str = "allow") -> DataFrame:
    """(id, host, path, rule, verdict, listed) for each page; ``listed(canonical)`` is the list of blocked URLs.

    Without a rule the verdict is ``block`` for a listed URL, else ``other``.
    """
    host, path = host_of(F.col(url_col)), path_of(F.col(url_col))
    rows = pages.select(F.col(id_col), host.alias("host"), path.alias("path")).withColumn("canonical", canonical(F.col("host"), F.col("path")))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, text in sorted(rules, key=lambda r: len(r[1])):  # the longest is asked first
        name, slash, rest = text.partition("/")
        fits = ((F.col("host") == name) | F.col("host").endswith("." + name)) & F.col("path").startswith(slash + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(said)).otherwise(verdict)
    rows = rows.withColumn("rule", rule).withColumn("said", verdict)

    unique = landed(listed.select("canonical").filter(F.col("canonical").isNotNull()).distinct(), "listed")
    blocks = 1 << max(4, (unique.count() // KEYS_PER_BLOCK).bit_length())
    marked = landed(possible(rows, "canonical", bloom_blocks(unique, "canonical", blocks), blocks), "marked")  # pages are read once
    hits = marked.filter("possible")
    asked = hits.groupBy("canonical").agg(F.count(F.lit(1)).alias("n"))
    confirmed = asked.join(unique, "canonical", "left_semi").withColumn("hit", F.lit(True))
    exact = grouped_join(hits, confirmed, ["canonical"], "n", hits.count())
    passed = marked.filter(~F.col("possible")).withColumns({"n": F.lit(None).cast("long"), "hit": F.lit(False)})
    found = F.coalesce("hit", F.lit(False))
    verdict = F.coalesce("said", F.when(found, F.lit("block")).otherwise(F.lit(other)))
    return exact.unionByName(passed).select(id_col, "host", "path", "rule", verdict.alias("verdict"), found.alias("listed"))
