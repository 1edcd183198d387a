"""Helpers shared by the training-data operators: scans, word patterns, scratch tables, salted joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prefdata.session import materialize
from prefdata.sources.tables import table

__all__ = ["SALTS", "cased_hit_words", "hit_words", "lower_ascii", "materialize", "null_safe", "params_by_key", "row_key", "shuffle_partitions", "table", "text_words"]

#: Ways in which the rows of one key are spread in :func:`params_by_key`.
SALTS = 16

#: Separators of plain words: the six ASCII white-space characters.
SPACE = r"[\x20\x09-\x0D]+"
#: Separators of normalised words (after lower-casing): every ASCII character but digits and letters.
PUNCT = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same before lower-casing.
CASED_PUNCT = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


#: Characters of SPACE and of PUNCT, to trim ends with.
SPACE_CHARS = " \t\n\x0b\x0c\r"
PUNCT_CHARS = "".join(chr(c) for c in range(128) if not (48 <= c <= 57 or 97 <= c <= 122))


def _split(text: Column, chars: str, pattern: str) -> Column:
    inner = F.btrim(text, F.lit(chars))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, pattern))


def text_words(text: Column) -> Column:
    """Array of the words ``[^\\x20\\x09-\\x0D]+``; empty for null."""
    return _split(F.coalesce(text, F.lit("")), SPACE_CHARS, SPACE)


def hit_words(text: Column) -> Column:
    """Array of the words of the text with A-Z lower-cased, split at ASCII punctuation; empty for null."""
    return _split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), PUNCT_CHARS, PUNCT)


def cased_hit_words(text: Column) -> Column:
    """The words of :func:`hit_words` as they are written: ``lower_ascii`` of each is the word."""
    return _split(F.coalesce(text, F.lit("")), PUNCT_CHARS.translate({ord(c): None for c in UPPER}), CASED_PUNCT)


def lower_ascii(text: Column) -> Column:
    """The text with A-Z lower-cased; ``translate`` looks up every character, so only what is not all ASCII goes through it."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """Key of a row by its id and text; rows that agree on both share it."""
    return F.xxhash64(F.col(doc_id), F.xxhash64(text))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def null_safe(a: DataFrame, b: DataFrame, *keys: str) -> Column:
    """Equality of the named columns on both sides, null equal to null."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & a[k].eqNullSafe(b[k])
    return cond


def params_by_key(rows: DataFrame, params: DataFrame, key: str, spread: Column, how: str = "left") -> DataFrame:
    """Join ``params`` (one row per key) to ``rows``; the rows of a hot key go to ``SALTS`` tasks.

    ``spread`` is any column of ``rows`` that varies within a key.  The few rows
    of ``params`` are repeated once per salt; no row of ``rows`` is.
    """
    salted = rows.withColumn("__llm_salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int"))
    copies = params.withColumn("__llm_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(copies, [key, "__llm_salt"], how).drop("__llm_salt")
