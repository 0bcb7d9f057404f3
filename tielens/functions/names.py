"""Comparing names: words, diacritics, verdicts. A blank name is never a match."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Name particles.
PARTICLES = ("the", "of", "a", "an", "and", "de", "van", "von")
SPACE = r"[\s ﻿\p{Z}]+"


def norm(text: Column) -> Column:
    """Lower case, punctuation and symbols as spaces, single spaces."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(text), r"[\p{P}\p{S}]", " "), SPACE, " "))


def words(text: Column) -> Column:
    return F.array_distinct(F.filter(F.split(norm(text), " "), lambda w: (w != "") & ~w.isin(*PARTICLES)))


def exact(a: Column, b: Column) -> Column:
    return F.trim(a) == F.trim(b)


def share_word(a: Column, b: Column) -> Column:
    return F.coalesce(F.arrays_overlap(words(a), words(b)), F.lit(False))


def field_equal(a: Column, b: Column) -> Column:
    return norm(a) == norm(b)


def verify(a: Column, b: Column) -> Column:
    """MATCH, MISMATCH, or UNVERIFIABLE where a name is blank or only particles."""
    x, y = F.coalesce(F.size(words(a)), F.lit(0)), F.coalesce(F.size(words(b)), F.lit(0))
    return F.when((x < 1) | (y < 1), "UNVERIFIABLE").when(share_word(a, b), "MATCH").otherwise("MISMATCH")


@lru_cache
def diacritic_map() -> tuple[str, str]:
    """Precomposed Latin letters and their bases, by Unicode decomposition; letters without one stay."""
    pairs = []
    for code in range(0xC0, 0x250):
        parts = unicodedata.normalize("NFD", chr(code))
        if len(parts) > 1 and len(base := "".join(c for c in parts if not 0x300 <= ord(c) <= 0x36F)) == 1:
            pairs.append((chr(code), base))
    return "".join(p[0] for p in pairs), "".join(p[1] for p in pairs)


def strip_diacritics(text: Column) -> Column:
    return F.regexp_replace(F.translate(text, *diacritic_map()), r"[̀-ͯ]", "")


def diacritic_variant(a: Column, b: Column) -> Column:
    """Differ, but only in diacritics."""
    x, y = F.trim(F.coalesce(a, F.lit(""))), F.trim(F.coalesce(b, F.lit("")))
    return (x != "") & (y != "") & (x != y) & (strip_diacritics(x) == strip_diacritics(y))


def drift(a: Column, b: Column) -> Column:
    return F.when(exact(a, b), "EXACT").when(share_word(a, b), "CANDIDATE").otherwise("LEAVE")


def conflict_type(a: Column, b: Column) -> Column:
    return F.when(diacritic_variant(a, b), "DIACRITIC_ONLY").otherwise("STRUCTURAL")


def outcome(a: Column, b: Column) -> Column:
    blank = (F.trim(F.coalesce(a, F.lit(""))) == "") | (F.trim(F.coalesce(b, F.lit(""))) == "")
    return F.when(blank, "unavailable").when(exact(a, b), "exact").when(share_word(a, b), "shares_word").otherwise("zero_words")


def gate(a: Column, b: Column) -> Column:
    return F.when(verify(a, b) == "MATCH", "PROCEED").otherwise("NEEDS_MANUAL")


def surname(name: Column) -> Column:
    """What stands before a comma, else the last word; lower case."""
    n = F.trim(F.coalesce(name, F.lit("")))
    parts = F.split(n, r"\s+")
    return F.lower(F.when(F.instr(n, ",") > 0, F.trim(F.split_part(n, F.lit(","), F.lit(1)))).otherwise(F.element_at(parts, -1)))
