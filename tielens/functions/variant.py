"""Tolerant getters of CRM records: every attribute is a list of value objects whose shape varies; the first counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .dates import flexible_date


def parsed(json: Column) -> Column:
    return F.try_parse_json(json)


def _at(v: Column, slug: str, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(v, f"$.{slug}[0]{path}", kind)


def text_of(v: Column, slug: str) -> Column:
    return _at(v, slug, ".value")


def select_title_of(v: Column, slug: str) -> Column:
    """The option's title, else a value that is a string."""
    is_text = F.schema_of_variant(F.try_variant_get(v, f"$.{slug}[0].value", "variant")) == "STRING"
    return F.coalesce(_at(v, slug, ".option.title"), F.when(is_text, text_of(v, slug)))


def date_of(v: Column, slug: str) -> Column:
    return flexible_date(F.coalesce(text_of(v, slug), _at(v, slug, ".interacted_at"), _at(v, slug, ".date")))


def name_of(v: Column, slug: str = "name") -> Column:
    both = F.trim(F.concat_ws(" ", _at(v, slug, ".first_name"), _at(v, slug, ".last_name")))
    return F.coalesce(_at(v, slug, ".full_name"), text_of(v, slug), F.when(both != "", both))


def emails_of(v: Column, slug: str = "emails") -> Column:
    """All addresses, lower case, with an ``@``, the first of each."""
    items = F.coalesce(F.try_variant_get(v, f"$.{slug}", "array<struct<email_address string>>"), F.array().cast("array<struct<email_address string>>"))
    low = F.transform(items, lambda x: F.lower(F.trim(F.coalesce(x.email_address, F.lit("")))))
    return F.array_distinct(F.filter(low, lambda e: F.instr(e, "@") > 0))


def email_of(v: Column, slug: str = "emails") -> Column:
    return F.get(emails_of(v, slug), F.lit(0))


def reference_of(v: Column, slug: str) -> Column:
    return F.coalesce(_at(v, slug, ".target_record_id"), _at(v, slug, ".target_record.record_id"))


def created_at(top: Column, v: Column) -> Column:
    return F.coalesce(top, text_of(v, "created_at"))
