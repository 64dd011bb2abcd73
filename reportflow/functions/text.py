"""Text rules as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reportflow.functions.regex import NOT_DIGIT, SPACE


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def digits_only(c) -> Column:
    """Keep the decimal digits of a text (site number from a name)."""
    return F.regexp_replace(_c(c), NOT_DIGIT, "")


def strip_leading_zeros(c) -> Column:
    """``'00120'`` -> ``'120'``; ``'000'`` -> ``''``."""
    return F.regexp_replace(_c(c), "^0+", "")


def last_chars(c, n: int = 5) -> Column:
    """The last ``n`` characters; shorter texts are returned whole."""
    return F.right(_c(c), F.lit(n))


def site_number(c, n: int | None = None) -> Column:
    """Digits (or the last ``n`` characters) without leading zeros."""
    base = digits_only(c) if n is None else last_chars(c, n)
    return strip_leading_zeros(base)


def fill_default(c, value: str = "UNKNOWN") -> Column:
    return F.coalesce(_c(c), F.lit(value))


def sentinel_coalesce(primary, fallback, sentinel: str = "UMTS",
                      default: str = "UNKNOWN") -> Column:
    """``primary`` unless it is null or the sentinel, then ``fallback``, then default."""
    p = _c(primary)
    return F.coalesce(F.when(p != F.lit(sentinel), p), _c(fallback), F.lit(default))


def choose_name(preferred, fallback) -> Column:
    """``fallback`` when ``preferred`` is the empty text, else ``preferred``."""
    p = _c(preferred)
    return F.when(p == F.lit(""), _c(fallback)).otherwise(p)


def trim_unicode(c) -> Column:
    """Strip leading and trailing whitespace as Python's ``str.strip()`` does."""
    return F.regexp_replace(_c(c), rf"^{SPACE}+|{SPACE}+\z", "")


def canonical_upper(c) -> Column:
    return F.upper(_c(c))


def table_name(c) -> Column:
    """Generic report name -> table name: lower, strip, blanks to ``_``, no dots."""
    return F.replace(F.replace(trim_unicode(F.lower(_c(c))), F.lit(" "), F.lit("_")),
                     F.lit("."), F.lit(""))


def normalise_header(name: str) -> str:
    """Header text -> column name: lower, strip, blank to ``_``, dots removed."""
    return name.lower().strip().replace(" ", "_").replace(".", "")


def dedupe_headers(names: list[str]) -> list[str]:
    """Make duplicate raw headers unique the way pandas does: ``x``, ``x.1``, ..."""
    uses: dict[str, int] = {}
    out: list[str] = []
    for name in names:
        # a name already handed out gets ".<k>" appended, repeatedly, until free
        while uses.get(name, 0):
            k = uses[name]
            uses[name] = k + 1
            name = f"{name}.{k}"
        uses[name] = 1
        out.append(name)
    return out


def normalise_headers(raw: list[str]) -> list[str]:
    return [normalise_header(h) for h in dedupe_headers(raw)]
