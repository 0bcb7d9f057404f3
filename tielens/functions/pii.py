"""Sensitive data: two detectors with their own patterns, kept apart on purpose."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .emails import AFTER, BEFORE, BORDER

#: Patterns of the redactor.
CARD = BEFORE + r"(?:[0-9][ -]?){13,19}" + BORDER  # may take a separator before a word with it
SSN = BEFORE + r"[0-9]{3}-[0-9]{2}-[0-9]{4}" + AFTER
API_KEY = "(?i)" + BEFORE + r"(?:sk|pk|api[_-]?key|token)[_-]?[:=]\s*['\"]?[A-Za-z0-9_\-]{16,}['\"]?"
PASSWORD = "(?i)" + BEFORE + r"password\s*[:=]\s*\S+"
#: Patterns of the write guard.
CREDENTIAL = "(?i)" + BEFORE + r"(?:password|pwd|passcode|api[ _-]?key|secret[ _-]?key|access[ _-]?token|auth[ _-]?token)\s*[:=]\s*\S+"
ROUTING = "(?i)" + BEFORE + r"routing\s*(?:number|no\.?|#)?\s*[:=]?\s*[0-9]{9}" + AFTER
ACCOUNT = "(?i)" + BEFORE + r"account\s*(?:number|no\.?|#)?\s*[:=]?\s*[0-9]{6,17}" + AFTER


def every(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[ -]", "")


def luhn(text: Column) -> Column:
    return F.call_function("luhn_check", text)


def cards(text: Column) -> Column:
    """The digits of every card-like run that passes the Luhn check."""
    return F.filter(F.transform(every(text, CARD), digits), lambda d: F.length(d).between(13, 19) & luhn(d))


def redact_middle(s: Column) -> Column:
    stars = F.repeat(F.lit("*"), F.greatest(F.lit(0), F.length(s) - 4))
    return F.when(F.length(s) <= 4, F.repeat(F.lit("*"), F.length(s))).otherwise(F.concat(F.left(s, F.lit(2)), stars, F.right(s, F.lit(2))))


def matches(text: Column) -> Column:
    """All matches in order of category: array of (category, redacted)."""

    def of(category: str, found: Column) -> Column:
        return F.transform(found, lambda m: F.struct(F.lit(category).alias("category"), redact_middle(m).alias("redacted")))

    ssn = F.transform(every(text, SSN), lambda m: F.regexp_replace(m, "-", ""))
    return F.concat(of("CREDIT_CARD", cards(text)), of("SSN", ssn), of("API_KEY", every(text, API_KEY)), of("PASSWORD_LABEL", every(text, PASSWORD)))


def redact(text: Column) -> Column:
    """Each match replaced where it stands; a card-like run that fails the check stays."""
    between = F.split(text, CARD, -1)
    marked = F.transform(every(text, CARD), lambda m: F.when(luhn(digits(m)), "[REDACTED_CARD]").otherwise(m))
    out = F.array_join(F.zip_with(between, marked, lambda a, m: F.concat(a, F.coalesce(m, F.lit("")))), "")
    for pattern, mark in ((SSN, "[REDACTED_SSN]"), (API_KEY, "[REDACTED_API_KEY]"), (PASSWORD, "[REDACTED_PASSWORD]")):
        out = F.regexp_replace(out, pattern, mark)
    return out


def first_category(text: Column) -> Column:
    return (
        F.when(text.rlike(SSN), "ssn")
        .when(text.rlike(CREDENTIAL), "credential")
        .when(text.rlike(ROUTING) | text.rlike(ACCOUNT), "bank_account")
        .when(F.size(cards(text)) > 0, "credit_card")
    )


def sanitize(text: Column, field: str) -> tuple[Column, Column]:
    """(value, warning): a hit empties the value; the warning names field and category, never the value."""
    hit = first_category(text)
    warning = F.concat(F.lit("Sensitive data ("), hit, F.lit(f") detected in {field} — field skipped, not written. Review and correct the source content."))
    return F.when(hit.isNull(), text).otherwise(""), warning
