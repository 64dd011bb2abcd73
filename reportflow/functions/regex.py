"""Regex character classes with Python ``re`` meaning, usable in Java and RE2.

Spark's Java regex treats ``\\w \\d \\s`` as ASCII and ``.`` as "not a line
terminator" (which also excludes ``\\r``).  The report rules were written for
Python, where these classes are Unicode and ``.`` only excludes ``\\n``.  The
classes below spell the Python meaning out explicitly so the same pattern text
means the same thing in Spark (Java) and in DuckDB (RE2).
"""

# Python-equivalent classes.
WORD = r"[\p{L}\p{N}_]"            # Python \w
NOT_WORD = r"[^\p{L}\p{N}_]"       # Python \W
DIGIT = r"\p{Nd}"                  # Python \d
NOT_DIGIT = r"\P{Nd}"              # Python \D
SPACE = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"   # Python \s and str.strip()/isspace()
ANY = r"[^\n]"                     # Python .

# Word class of .NET regular expressions, used by the leak audit
# whose rules were written for PowerShell (letters, non-spacing marks, decimal
# digits and connector punctuation).
NET_WORD = r"[\p{L}\p{Mn}\p{Nd}\p{Pc}]"
# .NET \b spelled with look-arounds (Java only; RE2 has no look-around).
NET_BOUNDARY = (r"(?:(?<=" + NET_WORD + r")(?!" + NET_WORD + r")|(?<!" + NET_WORD
                + r")(?=" + NET_WORD + r"))")
