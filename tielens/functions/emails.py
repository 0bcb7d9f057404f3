"""E-mail addresses, subjects and direction."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Address classes.
ROLES = "no-reply noreply donotreply do-not-reply orders support billing notifications alerts newsletter tickets claims".split()
ROLE_PREFIXES = ["invitation-"]
ROLE_SUFFIXES = ["-noreply", "-no-reply"]
SENDING_LABELS = ["email", "mail", "notifications"]
GENERIC = "info hello hi team contact admin office hr careers jobs recruiting staffing talent sales marketing events press media feedback service services help accounts accounting invoices payments inbox mail email webmaster postmaster".split()
FREEMAIL = "gmail.com googlemail.com yahoo.com ymail.com hotmail.com outlook.com live.com msn.com icloud.com me.com mac.com aol.com proton.me protonmail.com gmx.com mail.com zoho.com comcast.net sbcglobal.net verizon.net att.net".split()
AUTO_REPLIES = ["automatic reply", "out of office", "auto:"]
#: Subjects of transactional mail.
TRANSACTIONAL = [
    r"\border\s+(confirmation|confirmed|received|#\d+)",
    r"\byour\s+order\b",
    r"\breceipt\b",
    r"\binvoice\b",
    r"\bstatement\s+(is\s+)?(ready|available)\b",
    r"\bhas\s+shipped\b",
    r"\bshipping\s+(confirmation|update)\b",
    r"\btracking\s+(number|info|information)\b",
    r"\bout\s+for\s+delivery\b",
    r"\bdelivery\s+(confirmation|update|notification)\b",
    r"\bappointment\s+(reminder|confirmed|confirmation)\b",
    r"\breminder:",
    r"\b(take|complete)\s+(our|this|a)\s+survey\b",
    r"\bhow\s+did\s+we\s+do\b",
    r"\brate\s+your\s+(experience|order|visit)\b",
    r"\bverify\s+your\s+(email|account|address)\b",
    r"\bconfirm\s+your\s+(email|subscription)\b",
    r"\bpassword\s+reset\b",
    r"\breset\s+your\s+password\b",
    r"\bsecurity\s+(code|alert)\b",
    r"\byour\s+(subscription|membership|plan)\s+(will|has|is)\b",
    r"\brenewal\s+(notice|reminder)\b",
    r"\bpayment\s+(received|due|failed|confirmation)\b",
    r"\bbooking\s+(confirmation|confirmed)\b",
    r"\bitinerary\b",
    r"\be-?ticket\b",
    r"\bwelcome\s+to\s+\w+",
    r"\bunsubscribe\b",
]
BEFORE, AFTER = r"(?<![A-Za-z0-9_])", r"(?![A-Za-z0-9_])"
#: An ASCII word border, whichever side the word is on.
BORDER = r"(?:(?<=[A-Za-z0-9_])(?![A-Za-z0-9_])|(?<![A-Za-z0-9_])(?=[A-Za-z0-9_]))"


def ascii_borders(pattern: str) -> str:
    """A pattern whose word borders are ASCII in any Java version."""
    return pattern.replace(r"\b", BORDER)


def local_part(email: Column) -> Column:
    """Before the last ``@``, lower case; the whole text without one."""
    return F.lower(F.when(F.instr(email, "@") > 0, F.regexp_extract(email, r"(?s)^(.*)@", 1)).otherwise(email))


def domain(email: Column) -> Column:
    return F.lower(F.when(F.instr(email, "@") > 0, F.substring_index(email, "@", -1)).otherwise(""))


def is_role(email: Column) -> Column:
    local, labels = local_part(email), F.filter(F.split(domain(email), r"\."), lambda x: x != "")
    hit = local.isin(*ROLES)
    for p in ROLE_PREFIXES:
        hit = hit | local.startswith(p)
    for s in ROLE_SUFFIXES:
        hit = hit | local.endswith(s)
    return hit | ((F.size(labels) >= 3) & F.coalesce(F.get(labels, F.lit(0)).isin(*SENDING_LABELS), F.lit(False)))


def local_class(email: Column) -> Column:
    local = local_part(email)
    parts = F.filter(F.split(F.regexp_replace(local, r"[0-9]+$", ""), r"[._+-]"), lambda x: x != "")
    letters = F.length(F.array_join(parts, ""))
    return (
        F.when(F.coalesce(local, F.lit("")) == "", "unknown")
        .when(local.isin(*GENERIC), "generic-role")
        .when(local.rlike("^[0-9a-f]{16,}$") | local.rlike("^[0-9]+$"), "opaque")
        .when((F.size(parts) < 1) | (F.size(parts) > 3), "opaque")
        .when(F.exists(parts, lambda x: ~x.rlike("^[a-z]+$")), "opaque")
        .when((letters < 3) | (letters > 24), "opaque")
        .otherwise("personal")
    )


def domain_class(email: Column) -> Column:
    d = domain(F.coalesce(email, F.lit("")))
    return F.when(d == "", "unknown").when(d.isin(*FREEMAIL), "freemail").otherwise("company")


def is_auto_reply(subject: Column) -> Column:
    s = F.regexp_replace(F.lower(F.trim(subject)), r"^(?:(?:re|fw|fwd)\s*:\s*)+", "")
    hit = F.lit(False)
    for p in AUTO_REPLIES:
        hit = hit | s.startswith(p)
    return hit


def is_transactional(subject: Column) -> Column:
    return (F.trim(subject) != "") & subject.rlike("(?i)" + ascii_borders("|".join(TRANSACTIONAL)))


def direction(text: Column) -> Column:
    d = F.lower(F.trim(F.coalesce(text, F.lit(""))))
    return F.when(d.isin("inbound", "outbound", "internal"), d).otherwise("unknown")


def owned(email: Column, emails: tuple[str, ...], domains: tuple[str, ...] = ()) -> Column:
    e = F.lower(F.trim(email))
    return e.isin(*emails) | domain(e).isin(*domains) if domains else e.isin(*emails)
