"""Whitespace tokens, attention masks and padding (T6 whitespace form, T8, T16-T20).

Tokens are maximal runs of non-whitespace, where whitespace is exactly the set
Python's ``str.split()`` splits on.  The class is written once and used by
Spark (Java regex), by DuckDB (RE2) and, as ``str.split()``, by Python UDFs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.isspace() accepts, as a regex class body.
WHITESPACE_CLASS = (
    r"\t\n\x0B\f\r\x1C-\x1F \x85\xA0\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
TOKEN_PATTERN = "[^" + WHITESPACE_CLASS + "]+"

# Special tokens and their ids.
PAD_TOKEN, EOS_TOKEN, UNK_TOKEN = "<pad>", "<eos>", "<unk>"
PAD_ID, EOS_ID, UNK_ID = 0, 1, 2
SPECIAL_TOKENS = (PAD_TOKEN, EOS_TOKEN, UNK_TOKEN)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens(text) -> Column:
    """T6 (whitespace form): ``text.split()`` as ``array<string>``.

    Splitting on whitespace runs and dropping the empty strings at the ends is
    the same as extracting the non-whitespace runs, and several times faster.
    """
    return F.array_remove(F.split(_col(text), "[" + WHITESPACE_CLASS + "]+"), "")


def token_count(text) -> Column:
    """Number of whitespace tokens, computed without materializing the array where Spark can."""
    return F.size(tokens(text))


def first_tokens(text, n: int) -> Column:
    """The first ``n`` tokens joined by one space; a text of no more than ``n`` stays as it is."""
    toks = tokens(text)
    return F.when(F.size(toks) > n, F.array_join(F.slice(toks, 1, n), " ")).otherwise(_col(text))


def append_token(ids, token) -> Column:
    """``ids + [token]``."""
    return F.concat(_col(ids), F.array(F.lit(token) if not isinstance(token, Column) else token))


def attention_mask(ids) -> Column:
    """One 1 per real token."""
    return F.array_repeat(F.lit(1), F.size(_col(ids)))


def round_up(width, multiple: int | None) -> Column:
    """``ceil(width / m) * m`` (unchanged when ``m`` is None)."""
    w = _col(width) if not isinstance(width, int) else F.lit(width)
    if not multiple:
        return w
    return ((w + (multiple - 1)) / multiple).cast("long") * multiple


def pad(ids, width, value, side: str = "right") -> Column:
    """Pad ``ids`` with ``value`` up to ``width``; longer sequences are left as they are."""
    arr = _col(ids)
    w = F.lit(width) if isinstance(width, int) else _col(width)
    fill = F.array_repeat(F.lit(value) if not isinstance(value, Column) else value,
                          F.greatest(w - F.size(arr), F.lit(0)).cast("int"))
    return F.concat(fill, arr) if side == "left" else F.concat(arr, fill)


def padded_mask(ids, width, side: str = "right") -> Column:
    """Attention mask of a padded sequence: 1 per real token, 0 per pad."""
    return pad(attention_mask(ids), width, 0, side)


def truncate(ids, max_length: int) -> Column:
    """keep the first ``max_length`` ids (``truncation=True``)."""
    return F.slice(_col(ids), 1, max_length)
