"""Prompt rendering and length filters.

All of these are plain column expressions: they stay inside whole-stage
codegen and run where the data is.  Filters that only need a length use the
token count, so Catalyst can prune the token array away.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefdata.functions.tokens import token_count, truncate

# The prompt template of the reference.
QUESTION_PREFIX = "Question: "
ANSWER_PREFIX = "\n\nAnswer: "


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def question_prompt(question) -> Column:
    """``"Question: " + q + "\\n\\nAnswer: "``."""
    return F.concat(F.lit(QUESTION_PREFIX), _col(question), F.lit(ANSWER_PREFIX))


def qa_text(question, answer) -> Column:
    """``f"Question: {q}\\n\\nAnswer: {a}"``."""
    return F.concat(F.lit(QUESTION_PREFIX), _col(question), F.lit(ANSWER_PREFIX), _col(answer))


def add_prefixes(prompt, prefixes) -> Column:
    """P5: ``prefixes[0] + prefixes[1] + ... + prompt`` (first = outermost); texts come from the caller."""
    return F.concat(*[F.lit(p) for p in prefixes if p], _col(prompt))


def query_response(query, response) -> Column:
    """The text a scorer sees, ``query + response``."""
    return F.concat(_col(query), _col(response))


def keep_only(df: DataFrame, *columns) -> DataFrame:
    """Drop every input column after a map; keep only the new ones."""
    return df.select(*columns)


def with_labels(df: DataFrame, ids: str = "input_ids", out: str = "labels") -> DataFrame:
    """Labels are a copy of the inputs."""
    return df.withColumn(out, F.col(ids))


def with_return_loss(df: DataFrame) -> DataFrame:
    """The constant ``return_loss = True`` of a reward batch."""
    return df.withColumn("return_loss", F.lit(True))


def filter_shorter(df: DataFrame, text: str, max_tokens: int = 512, out: str | None = None) -> DataFrame:
    """keep rows whose token count is ``< max_tokens`` (strict, as the SFT and RL stages do)."""
    n = token_count(text)
    kept = df.filter(n < max_tokens)
    return kept.withColumn(out, token_count(text)) if out else kept


def filter_both_within(df: DataFrame, text_j: str, text_k: str, max_length: int = 512) -> DataFrame:
    """keep pairs whose two sides both have ``<= max_length`` tokens (the reward stage's rule)."""
    return df.filter((token_count(text_j) <= max_length) & (token_count(text_k) <= max_length))


def truncate_ids(ids, max_length: int) -> Column:
    """``truncation=True, max_length=n``."""
    return truncate(ids, max_length)
