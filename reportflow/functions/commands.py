"""Command-log rules (X8 command text, X9 command class, X10 operator code)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reportflow.functions.regex import ANY, DIGIT, NOT_WORD, SPACE, WORD

# The patterns of the command-log rules, in Python meaning.
COMMENT = rf"/\*{ANY}*\*/"                      # from the first /* to the last */ of a line
OPERATOR_CODE = rf"/\*({DIGIT}*){ANY}*\*/"       # digits right after /*
LEADING_WORD = rf"^({WORD}+){SPACE}"             # leading word followed by a blank
FILE_TRANSFER = rf"^{NOT_WORD}[a-zA-Z]{ANY}+{NOT_WORD}\["
CONFIG_ECHO = rf"^CmdCode={ANY}*, CmdName={ANY}*, CmdContent={ANY}*"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def command_text(org_cmd) -> Column:
    """The command without its ``/* ... */`` operator comment."""
    return F.regexp_replace(_c(org_cmd), COMMENT, "")


def command_class(cmd) -> Column:
    """Class of a command, first rule that applies wins.

    BulkCM marker -> ``BulkCM``; task marker -> ``CmdTask``; leading word and a
    blank -> the word in upper case (``EMS`` and ``LOGIN`` -> ``LOGIN``); a
    bracketed file-transfer line -> ``FTP``; the whole text ``login`` in any
    case -> ``LOGIN``; otherwise ``UNKNOWN``.
    """
    c = _c(cmd)
    word = F.upper(F.regexp_extract(c, LEADING_WORD, 1))
    return (F.when(c.isNull(), F.lit(None).cast("string"))
            .when(c.contains("BulkCM"), F.lit("BulkCM"))
            .when(c.contains("TaskNo.="), F.lit("CmdTask"))
            .when(word.isin("EMS", "LOGIN"), F.lit("LOGIN"))
            .when(word != "", word)
            .when(c.rlike(FILE_TRANSFER), F.lit("FTP"))
            .when(F.upper(c) == "LOGIN", F.lit("LOGIN"))
            .otherwise(F.lit("UNKNOWN")))


def operator_code(org_cmd) -> Column:
    """Digits right after ``/*`` when a ``*/`` follows on the line, else ``OTHER``."""
    code = F.regexp_extract(_c(org_cmd), OPERATOR_CODE, 1)
    return (F.when(_c(org_cmd).isNull(), F.lit(None).cast("string"))
            .when(code == "", F.lit("OTHER")).otherwise(code))


def is_config_echo(org_cmd) -> Column:
    """True for configuration echo lines that are not commands; null is False."""
    return F.coalesce(_c(org_cmd).rlike(CONFIG_ECHO), F.lit(False))
