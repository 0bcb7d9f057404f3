"""Short texts: clipping, descriptions, ids, URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def description_key(text: Column) -> Column:
    """Lower case, all but ASCII word characters as spaces, single spaces. Accented letters are dropped, unlike in names."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(text), r"[^A-Za-z0-9_\s]", " "), r"\s+", " "))


def squeeze(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " "))


def clip(text: Column, most: int) -> Column:
    """At most ``most`` characters, the last an ellipsis where text was cut."""
    return F.when(F.length(text) > most, F.concat(F.left(text, F.lit(most - 1)), F.lit("…"))).otherwise(text)


def truncate(text: Column, most: int) -> Column:
    return F.left(text, F.lit(most))


def filled(text: Column) -> Column:
    """Null for blank text."""
    return F.when(F.trim(text) != "", text)


def proposal_id(record: Column) -> Column:
    return F.concat(F.lit("PROP-"), F.left(record, F.lit(8)))


def run_id_of(prefix: str, run_ms: int, ordinal: Column) -> Column:
    """Deterministic ids: prefix, the run's time, an ordinal."""
    return F.concat(F.lit(f"{prefix}-{run_ms}-"), ordinal.cast("string"))


def normal_url(url: Column) -> Column:
    return F.lower(F.rtrim(F.trim(F.coalesce(url, F.lit(""))), F.lit("/")))


def stage_number(text: Column) -> Column:
    return F.coalesce(F.regexp_extract(text, r"(?i)stage\s*([0-9]{1,9})", 1).try_cast("int"), F.lit(0))


def tier(text: Column) -> Column:
    t = F.lower(F.trim(F.coalesce(text, F.lit(""))))
    return F.when(t == "core", "Core").when(t == "peripheral", "Peripheral").otherwise("Strategic")


#: Planned kinds of touch.
TOUCH_MODES = ("Social", "Context", "Activation")


def touch_mode(text: Column) -> Column:
    """One of the known modes, spelled so; else null."""
    return F.when(text.isin(*TOUCH_MODES), text)


def full_name(text: Column) -> tuple[Column, Column]:
    """(first, last): up to the first space, and the rest."""
    parts = F.split(F.trim(F.coalesce(text, F.lit(""))), " ", 2)
    return F.get(parts, F.lit(0)), F.coalesce(F.get(parts, F.lit(1)), F.lit(""))


def location(*parts: Column) -> Column:
    return F.concat_ws(", ", *(filled(F.trim(p)) for p in parts))
