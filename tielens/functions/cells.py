"""Cells of untyped rows and integer pointers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cell(cells: Column, index: int) -> Column:
    """The trimmed cell; missing cells and nulls are ''."""
    return F.coalesce(F.trim(F.try_element_at(cells, F.lit(index + 1))), F.lit(""))


def leading_int(text: Column) -> Column:
    """The integer that a text begins with (``12abc`` is 12), any sign; else null."""
    return F.regexp_extract(text, r"^\s*([+-]?\d{1,9})", 1).try_cast("int")


def positive_int(text: Column) -> Column:
    n = leading_int(text)
    return F.when(n > 0, n)


def nonzero_int(text: Column) -> Column:
    n = leading_int(text)
    return F.when(n != 0, n)


def truth(value: Column) -> Column:
    return F.upper(F.trim(value.cast("string"))) == "TRUE"


def number(text: Column, default: float | None = None) -> Column:
    """A finite number; else ``default``."""
    n = F.trim(text).try_cast("double")
    finite = F.when(F.isnan(n) | (F.abs(n) == float("inf")), F.lit(None)).otherwise(n)
    return finite if default is None else F.coalesce(finite, F.lit(default))


def column_letter(index: int) -> str:
    """0-based index to spreadsheet letters."""
    out = ""
    index += 1
    while index:
        index, r = divmod(index - 1, 26)
        out = chr(65 + r) + out
    return out


def split_list(text: Column) -> Column:
    """Trimmed, non-blank items of a comma list."""
    return F.filter(F.transform(F.split(text, ","), lambda x: F.trim(x)), lambda x: x != "")
