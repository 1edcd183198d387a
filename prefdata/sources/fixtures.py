"""Fixture views: the driver tables mapped onto the shapes the reference reads.

Each view has a Spark definition and the same derivation as DuckDB SQL (used
as a CTE by the oracles), so both engines start from identical rows.

* ``qa_questions(qid, question)`` - the ``benchmark`` items, numbered from 0.
* ``qa_answers(qid, aid, text, pm_score)`` - labelled documents are answers to
  item ``doc_id % (number of items)``; the score is ``quality``.
* ``qa_turns(conv_id, turn, question, answer)`` - a user turn and the assistant
  turn right after it (turns are consecutive per conversation).
* ``user_turns(conv_id, turn, question)`` - every user turn, answered or not.
* ``order_lines`` / ``supplier_lines`` - ``lineitem`` as answers grouped by order
  (many small questions) or by supplier (few large questions), score = quantity.
* ``scores(pair_id, r_j, r_k)`` - deterministic reward pairs from ``documents``.
* ``doc_tokens(doc_id, toks)`` - whitespace tokens of each document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prefdata.functions.tokens import TOKEN_PATTERN, tokens
from prefdata.sources.tables import table


def qa_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("qid"), F.col("text").alias("question"))


SQL_QA_QUESTIONS = "qa_questions AS (SELECT item_id AS qid, text AS question FROM benchmark)"


def qa_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The question is a function of the answer's id, so no join moves a text to its question."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality")
    n = max(1, table(spark, sf_dir, "benchmark").count())
    return d.join(lab, "doc_id").select((F.col("doc_id") % n).alias("qid"), F.col("doc_id").alias("aid"), "text",
                                        F.col("quality").alias("pm_score"))


SQL_QA_ANSWERS = """qa_answers AS (
  SELECT d.doc_id % (SELECT count(*) FROM benchmark) AS qid, d.doc_id AS aid, d.text AS text, l.quality AS pm_score
  FROM documents d JOIN labels l ON l.doc_id = d.doc_id)"""


def page_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested threads: a page's title is the question, the pieces between paragraph ends are its answers (in HTML)."""
    answers = F.transform(F.split("html", "</p>", -1), lambda x: F.struct((F.length(x) % 7).alias("pm_score"), x.alias("text")))
    return table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("qid"), F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("question"), answers.alias("answers"))


SQL_PAGE_THREADS = """page_questions AS (SELECT page_id AS qid, regexp_extract(html, '<title>([^<]*)</title>', 1) AS question FROM pages),
page_answers AS (SELECT qid, CAST(unnest(range(len(a))) AS INTEGER) AS aid, unnest(a) AS text
  FROM (SELECT page_id AS qid, string_split(html, '</p>') AS a FROM pages)),
qa_src AS (SELECT qid, aid, length(text) % 7 AS score FROM page_answers)"""


def qa_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    u = c.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("question"))
    a = c.filter(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    # Equi-join on (conv_id, turn): a long conversation spreads over many hash partitions.
    return u.join(a, ["conv_id", "turn"])


SQL_QA_TURNS = """qa_turns AS (
  SELECT u.conv_id, u.turn, u.text AS question, a.text AS answer
  FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant')"""


def user_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    return c.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("question"))


SQL_USER_TURNS = "user_turns AS (SELECT conv_id, turn, text AS question FROM conversations WHERE role = 'user')"


def _lines(spark: SparkSession, sf_dir: str, group: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col(group).alias("qid"),
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("aid"),
        F.col("l_quantity").alias("score"),
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir, "l_orderkey")


def supplier_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir, "l_suppkey")


def sql_lines(name: str, group: str) -> str:
    return f"""{name} AS (
  SELECT {group} AS qid, concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS aid, l_quantity AS score
  FROM lineitem)"""


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").alias("pair_id"),
        ((F.col("n_chars") % 1000).cast("double") / 100.0).alias("r_j"),
        (((F.col("doc_id") * 37) % 1000).cast("double") / 100.0).alias("r_k"),
    )


SQL_SCORES = """scores AS (
  SELECT doc_id AS pair_id, CAST(n_chars % 1000 AS DOUBLE) / 100.0 AS r_j,
         CAST((doc_id * 37) % 1000 AS DOUBLE) / 100.0 AS r_k
  FROM documents)"""


def doc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", tokens("text").alias("toks"))


SQL_DOC_TOKENS = f"""doc_tokens AS (
  SELECT doc_id, regexp_extract_all(text, '{TOKEN_PATTERN}') AS toks FROM documents)"""
