"""Report dates and subjects (X11 two-format date, X12 subject parse)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# The two accepted date layouts (four-digit year, one- or two-digit
# month and day), as shapes checked before parsing.
ISO_SHAPE = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"
DAY_FIRST_SHAPE = r"^[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}$"


def try_report_date(text) -> Column:
    """ISO ``yyyy-M-d`` first, then day-first ``d-M-yyyy``; null if neither.

    A shape test guards each parse: text of the wrong shape never reaches the
    date parser, whose failures are expensive, and the year has exactly four
    digits as in the reference's formats.
    """
    t = _c(text)
    return F.coalesce(F.when(t.rlike(ISO_SHAPE), F.try_to_date(t, "yyyy-M-d")),
                      F.when(t.rlike(DAY_FIRST_SHAPE), F.try_to_date(t, "d-M-yyyy")))


def report_date(text) -> Column:
    """As ``try_report_date`` but a non-null text in neither format is an error."""
    t = _c(text)
    parsed = try_report_date(t)
    return F.when(t.isNotNull() & parsed.isNull(),
                  F.raise_error(F.concat(F.lit("unparseable report date: "), t))
                  .cast("date")).otherwise(parsed)


def subject_parts(subject) -> Column:
    """Non-empty parts of a subject split on ``[`` and ``]``.

    Written without a lambda (strip bracket runs at both ends, split on runs),
    so it stays in generated code and is computed once per row.
    """
    inner = F.regexp_replace(_c(subject), r"^[\[\]]+|[\[\]]+$", "")
    return F.when(inner == F.lit(""), F.array().cast("array<string>")).otherwise(
        F.split(inner, r"[\[\]]+"))


def _subject_struct(subject: Column, parts: Column, regions: list[str]) -> Column:
    n = F.size(parts)
    first = F.element_at(parts, 1)
    second = F.when(n >= 2, F.element_at(parts, 2))
    regional = second.isin(*regions) if regions else F.lit(False)
    need = F.when(regional, F.lit(4)).otherwise(F.lit(3))

    def part(i: int) -> Column:
        return F.when(n >= i, F.element_at(parts, i))

    status = (F.when(subject.isNull(), F.lit("no_subject"))
              .when(n < 2, F.lit("too_few_parts"))
              .when(first != F.lit("Report"), F.lit("not_a_report"))
              .when(n < need, F.lit("too_few_parts"))
              .otherwise(F.lit("ok")))
    ok = status == F.lit("ok")
    return F.struct(
        first.alias("report_id"),
        F.when(ok, F.when(regional, second).otherwise(F.lit(""))).alias("oss"),
        F.when(ok, F.when(regional, part(3)).otherwise(second)).alias("report_name"),
        F.when(ok, F.when(regional, part(4)).otherwise(part(3))).alias("report_date_text"),
        status.alias("status"),
    )


def parse_subject(subject, regions: list[str]) -> Column:
    """Struct (report_id, oss, report_name, report_date_text, status).

    ``[Report][REGION][NAME][DATE]`` when the second part is a known region,
    else ``[Report][NAME][DATE]`` with region ``''``.  Subjects that are not
    reports or have too few parts get a status other than ``ok`` (quarantine)
    instead of failing the run.  For large inputs use ``with_subject``, which
    splits each subject once.
    """
    return _subject_struct(_c(subject), subject_parts(subject), regions)


def with_subject(df: DataFrame, subject: str, regions: list[str]) -> DataFrame:
    """``df`` plus the parsed subject fields (see ``parse_subject``).

    The split parts are computed once into a column before the fields are
    derived from it; Catalyst keeps that projection because the split is
    referenced many times.
    """
    parts = df.withColumn("__parts", subject_parts(subject))
    parsed = parts.withColumn("__subject", _subject_struct(F.col(subject), F.col("__parts"),
                                                           regions))
    return parsed.select(*[F.col(f"`{c}`") for c in df.columns], "__subject.*")