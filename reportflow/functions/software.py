"""Software-version rules (X5 merge, X6 tag stripping)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reportflow.functions.regex import DIGIT, WORD

UNKNOWN = "UNKNOWN"

# Model tags deleted by the tag-stripping merge, in the order the
# rule applies them ("SP"/"SPC" handling sits between the blank and the
# BTS3900 entries; see ``software_tags``).
REMOVED_TAGS_BEFORE_SP = ["Micro", "Pico", "BTS3902E", "BTS5900", "BTS3202E", "BTS3000", " "]
REMOVED_TAGS_AFTER_SP = ["BTS3900_5900", "BTS3900"]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def version_token(text) -> Column:
    """First run of a ``v``/``V`` followed by word characters, '' if none."""
    return F.regexp_extract(_c(text), f"([vV]{WORD}*)", 1)


def spc_form(token) -> Column:
    """``V...SP<digits>`` -> ``V...SPC<digits>`` (case-sensitive, uppercase V)."""
    return F.regexp_replace(_c(token), f"(V{WORD}+)SP({DIGIT}+)", "$1SPC$2")


def software_merge(hotpatch, software, product, unknown: str = UNKNOWN) -> Column:
    """Version from the first known field of (hotpatch, software, product).

    A field equal to ``unknown`` (or null) is absent.  Only the first known field
    is searched: if it holds no version token the result is ``unknown`` even when
    a later field would have one.
    """
    fields = [F.coalesce(_c(x), F.lit(unknown)) for x in (hotpatch, software, product)]
    chosen = (F.when(fields[0] != unknown, fields[0])
              .when(fields[1] != unknown, fields[1])
              .when(fields[2] != unknown, fields[2]))
    token = version_token(chosen)
    return (F.when(chosen.isNull() | (token == ""), F.lit(unknown))
            .otherwise(spc_form(token)))


def strip_tags(c) -> Column:
    """Delete model tags and blanks, write ``SP``/``SPC`` as ``SPC``."""
    out = _c(c)
    for tag in REMOVED_TAGS_BEFORE_SP:
        out = F.replace(out, F.lit(tag), F.lit(""))
    out = F.regexp_replace(out, "SPC?", "SPC")
    for tag in REMOVED_TAGS_AFTER_SP:
        out = F.replace(out, F.lit(tag), F.lit(""))
    return out


def software_tags(columns: list, unknown: str = UNKNOWN) -> Column:
    """Coalesce software columns left to right, cleaning after each step.

    With a single column the cleaned column is returned with its nulls kept;
    from the second column on the running value is filled with ``unknown``.
    """
    cols = [_c(c) for c in columns]
    out = strip_tags(cols[0])
    for nxt in cols[1:]:
        out = F.coalesce(strip_tags(F.coalesce(out, nxt)), F.lit(unknown))
    return out
