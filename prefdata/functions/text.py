"""Text cleanup in Spark expressions (T1-T5; T1 by a list of rules).

Python's ``re`` treats ``\\s`` as Unicode whitespace; Java's ``\\s`` is ASCII
only and ``(?U)\\s`` misses U+001C..U+001F.  The explicit class from
:mod:`prefdata.functions.tokens` matches Python exactly in Spark and DuckDB.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from prefdata.functions.tokens import WHITESPACE_CLASS

WS = "[" + WHITESPACE_CLASS + "]"
BLANK_LINES_PATTERN = r"\n" + WS + r"*\n"
STRIP_PATTERN = r"\A" + WS + r"+|" + WS + r"+\z"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def collapse_blank_lines(text) -> Column:
    """``re.sub(r"\\n\\s*\\n", "\\n\\n", text)``."""
    return F.regexp_replace(_col(text), BLANK_LINES_PATTERN, "\n\n")


def strip_text(text) -> Column:
    """T4: ``text.strip()`` (Spark's ``trim`` removes only spaces)."""
    return F.regexp_replace(_col(text), STRIP_PATTERN, "")


def repair_utf8(text) -> Column:
    """T5: replace invalid UTF-8 with U+FFFD (Python's encoder would write ``?`` for a lone surrogate)."""
    return F.make_valid_utf8(_col(text))


def clean_markdown(text) -> Column:
    """The post-processing of every converted document: T3, then T4, then T5."""
    return repair_utf8(strip_text(collapse_blank_lines(text)))


def first_class(class_attr) -> Column:
    """First CSS class of a ``class`` attribute value, null when there is none."""
    c = F.regexp_extract(_col(class_attr), "[^" + WHITESPACE_CLASS + "]+", 0)
    return F.when(c == "", F.lit(None).cast("string")).otherwise(c)


def code_language(class_attr) -> Column:
    """Text after the last ``-`` of the first class (``lang-py`` -> ``py``, ``a-b c`` -> ``b``)."""
    return F.element_at(F.split(first_class(class_attr), "-"), -1)


# The native Markdown subset (T1, SQL-checkable form), applied in this order.
# Each rule is (pattern, replacement); "{1}" marks a group reference, written $1 for Java and \1 for RE2.
MARKDOWN_RULES = [
    (r"(?s)<!--.*?-->", ""),
    (r"(?is)<script\b[^>]*>.*?</script>", ""),
    (r"(?is)<style\b[^>]*>.*?</style>", ""),
    (r"(?i)<pre\b[^>]*?class=\"(?:[^\" ]*-)?([^\" -]*)[^\"]*\"[^>]*>[ \t\r\n]*(?:<code\b[^>]*>)?", "\n\n```{1}\n"),
    (r"(?i)<pre\b[^>]*>[ \t\r\n]*(?:<code\b[^>]*>)?", "\n\n```\n"),
    (r"(?i)(?:</code>[ \t\r\n]*)?</pre>", "\n```\n\n"),
    (r"(?i)</?code\b[^>]*>", "`"),
    (r"(?i)<hr\b[^>]*>", "\n\n---\n\n"),
    (r"(?i)<h1\b[^>]*>", "\n\n# "),
    (r"(?i)<h2\b[^>]*>", "\n\n## "),
    (r"(?i)<h3\b[^>]*>", "\n\n### "),
    (r"(?i)<h4\b[^>]*>", "\n\n#### "),
    (r"(?i)<h5\b[^>]*>", "\n\n##### "),
    (r"(?i)<h6\b[^>]*>", "\n\n###### "),
    (r"(?i)</h[1-6]>", "\n\n"),
    (r"(?i)</?(b|strong)\b[^>]*>", "**"),
    (r"(?i)</?(i|em)\b[^>]*>", "*"),
    (r"(?i)<br\b[^>]*>", "  \n"),
    (r"(?i)<li\b[^>]*>", "\n* "),
    (r"(?i)</?p\b[^>]*>", "\n\n"),
    (r"(?is)<a\b[^>]*?href=\"([^\"]*)\"[^>]*>(.*?)</a>", "[{2}]({1})"),
    (r"(?s)<[^>]+>", ""),
    (r"&quot;", "\""),
    (r"&middot;", "·"),
    (r"&copy;", "©"),
    (r"&lt;", "<"),
    (r"&gt;", ">"),
    (r"&nbsp;", " "),
    (r"&#39;", "'"),
    (r"&amp;", "&"),
]


def _java_replacement(rep: str) -> str:
    out = rep.replace("\\", "\\\\").replace("$", "\\$")
    for i in range(1, 10):
        out = out.replace("{%d}" % i, "$%d" % i)
    return out


def markdown_native(html) -> Column:
    """Tags and entities the rule list covers, then T3 and T4.

    A ``pre`` block is fenced with the language of its class (T2).  Tables and
    the levels of nested lists are not rendered; their text stays.
    """
    c = _col(html)
    for pat, rep in MARKDOWN_RULES:
        c = F.regexp_replace(c, pat, _java_replacement(rep))
    return strip_text(collapse_blank_lines(c))


def sql_literal(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_markdown_native(html_sql: str) -> str:
    """DuckDB text of :func:`markdown_native` generated from the same rule list."""
    expr = html_sql
    for pat, rep in MARKDOWN_RULES:
        r = rep.replace("\\", "\\\\")
        for i in range(1, 10):
            r = r.replace("{%d}" % i, "\\%d" % i)
        expr = f"regexp_replace({expr}, {sql_literal(pat)}, {sql_literal(r)}, 'g')"
    expr = f"regexp_replace({expr}, {sql_literal(BLANK_LINES_PATTERN)}, {sql_literal(chr(10) * 2)}, 'g')"
    return f"regexp_replace({expr}, {sql_literal(STRIP_PATTERN)}, '', 'g')"
