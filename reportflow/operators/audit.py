"""Text leak audit (F6): private IPv4, non-example e-mail, internal markers.

One finding per document for a private IPv4 address and for an internal
host/path marker, and one finding per e-mail match whose text does not end in
``.invalid``.  The rules were written as .NET regular expressions; ``\\b`` and
``\\d`` are therefore spelled with the .NET word and digit classes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportflow.functions.regex import NET_BOUNDARY, NET_WORD

D = r"\p{Nd}"
# The three audit rules.
# An address starts and ends with a digit (a word character), so the .NET \b
# around it is a single look-behind / look-ahead; "(?=1)" rejects most start
# positions with one character compare.  An e-mail ends with a letter, so its
# closing \b is a look-ahead too.
PRIVATE_IPV4 = (rf"(?=1)(?<!{NET_WORD})(?:10\.(?:{D}{{1,3}}\.){{2}}{D}{{1,3}}"
                rf"|192\.168\.{D}{{1,3}}\.{D}{{1,3}}"
                rf"|172\.(?:1[6-9]|2{D}|3[01])\.{D}{{1,3}}\.{D}{{1,3}})(?!{NET_WORD})")
EMAIL = (NET_BOUNDARY + r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
         + rf"(?!{NET_WORD})")
INTERNAL_MARKER = r"(?i)/app/users/|outlook-[a-z]+\.|webmail-[a-z]+\."
EXAMPLE_SUFFIX = ".invalid"

RULE_IP, RULE_EMAIL, RULE_MARKER = "private_ipv4", "email", "internal_marker"


def leak_findings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  keep: list[str] | None = None) -> DataFrame:
    """Findings ``(*keep, id_col, rule, match)`` over whole texts.

    The three rules are evaluated in one pass over the input (a single scan,
    no shuffle): each row produces an array of findings that is exploded.
    """
    t = F.col(text_col)
    # cheap substring tests guard each regex: every match contains one of these
    # literals, so texts without them skip the (look-around heavy) patterns
    may_ip = t.contains("10.") | t.contains("192.168.") | t.contains("172.")
    may_mail = t.contains("@")
    low = F.lower(t)
    may_marker = low.contains("/app/users/") | low.contains("outlook-") | low.contains("webmail-")
    # one regex pass per rule: a rule's match is never empty, so '' means "no finding"
    ip_m = F.when(may_ip, F.regexp_extract(t, PRIVATE_IPV4, 0))
    mark_m = F.when(may_marker, F.regexp_extract(t, INTERNAL_MARKER, 0))
    ip = F.when(ip_m != "", F.array(F.struct(F.lit(RULE_IP).alias("rule"), ip_m.alias("match"))))
    marker = F.when(mark_m != "", F.array(F.struct(F.lit(RULE_MARKER).alias("rule"),
                                                   mark_m.alias("match"))))
    mails = F.when(may_mail, F.transform(
        F.filter(F.regexp_extract_all(t, F.lit(EMAIL), 0),
                 lambda m: ~F.lower(m).endswith(EXAMPLE_SUFFIX)),
        lambda m: F.struct(F.lit(RULE_EMAIL).alias("rule"), m.alias("match"))))
    empty = F.array().cast("array<struct<rule:string,match:string>>")
    findings = F.concat(F.coalesce(ip, empty), F.coalesce(mails, empty),
                        F.coalesce(marker, empty))
    extra = [F.col(c) for c in (keep or [])]
    return (docs.select(*extra, F.col(id_col), F.explode(findings).alias("f"))
            .select(*extra, F.col(id_col), "f.rule", "f.match"))
