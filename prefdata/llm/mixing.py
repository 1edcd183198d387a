"""Operator 9: mix sources to target weights by iterative proportional fitting, DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefdata.functions.keys import h, hnum, sql_h, sql_hnum
from prefdata.llm.common import UPPER, materialize, params_by_key, text_words

DIMS = ("source", "lang", "topic")
#: Rounds over all marginals; exponent of a value's token share in the default targets; seed of the draw.
ROUNDS, TEMPER, SEED = 6, 0.9, 42
SYMBOLS = "#*$%&|<>"


def topic_of(text: Column) -> Column:
    """Topic by rule: ``markup`` (1 character in 20 is a symbol), ``shouting`` (half are capitals), ``contacts`` (has an at sign), ``prose``; null is ``prose``."""
    t = F.coalesce(text, F.lit(""))
    taken = lambda chars: F.length(t) - F.length(F.translate(t, chars, ""))
    return (F.when(20 * taken(SYMBOLS) > F.length(t), "markup").when(2 * taken(UPPER) > F.length(t), "shouting")
            .when(F.contains(t, F.lit("@")), "contacts").otherwise("prose"))


def _named(c: str) -> Column:
    """A value as text that tells null from any string."""
    return F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))


def rake(cells: DataFrame, targets: dict[str, DataFrame], rounds: int = ROUNDS) -> DataFrame:
    """``cells`` with ``w``, scaled in turn so that its sums over each dimension meet ``targets[dim]`` (value, share).

    Sums are partial aggregates, so a value that all cells share costs a row per task.
    Values without a target keep no weight; cells of weight 0 stay at 0.
    """
    for i in range(rounds):
        for dim, target in targets.items():
            now = cells.groupBy(dim).agg(F.sum("w").alias("__llm_sum")).join(target.withColumnRenamed("value", dim), dim, "left")
            factor = now.select(dim, F.when(F.col("__llm_sum") > 0, F.coalesce("share", F.lit(0.0)) / F.col("__llm_sum")).otherwise(0.0).alias("__llm_factor"))
            cells = cells.join(factor, dim).withColumn("w", F.col("w") * F.col("__llm_factor")).drop("__llm_factor")
        cells = materialize(cells, "rake")
    return cells


def tempered(cells: DataFrame, dim: str, temper: float = TEMPER) -> DataFrame:
    """Default target of a dimension: (value, share) with shares in proportion to tokens ** temper."""
    by = cells.groupBy(dim).agg(F.sum("tokens").alias("t")).select(F.col(dim).alias("value"), F.pow(F.col("t").cast("double"), F.lit(temper)).alias("x"))
    total = by.agg(F.sum("x").alias("all"))
    return by.join(F.broadcast(total)).select("value", F.when(F.col("all") > 0, F.col("x") / F.col("all")).otherwise(0.0).alias("share"))  # one row


def calibrated(docs: DataFrame, targets: dict[str, dict] | None = None, topic: Column | None = None, rounds: int = ROUNDS, seed=SEED) -> DataFrame:
    """doc_id, topic, n_tokens, probability and sampled for every row of ``docs``.

    Tokens are white-space words.  Cells of (source, lang, topic) are raked to
    the target shares (``targets[dim][value]``; by default tempered token
    shares); a cell's probability is its raked weight over its token share,
    divided by the largest such ratio, so that expected tokens of the sample
    meet the targets.  Null values are a value of their own.  Rows without
    tokens weigh nothing and have probability 0.  Repeated rows are drawn
    together (the draw is a hash of the id).  Extra columns are not looked at.
    """
    return _calibrated(docs, targets, topic, rounds, seed).drop("key")


def _calibrated(docs: DataFrame, targets, topic, rounds, seed) -> DataFrame:
    """:func:`calibrated` with the ``key`` of the row's id, text, source and language."""
    spark = docs.sparkSession
    topic = topic_of(F.col("text")) if topic is None else topic
    rows = docs.select("doc_id", _key().alias("key"), "source", "lang", topic.alias("topic"), F.size(text_words(F.col("text"))).cast("long").alias("n_tokens"))
    rows = rows.withColumns({d: _named(d) for d in DIMS})
    rows = materialize(rows.withColumn("cell", F.concat_ws("\x1f", *DIMS)), "mix-rows")
    cells = rows.filter("n_tokens > 0").groupBy("cell", *DIMS).agg(F.sum("n_tokens").alias("tokens"))
    cells = materialize(cells, "mix-cells")
    total = cells.agg(F.sum("tokens").alias("all"))
    cells = materialize(cells.join(F.broadcast(total)).withColumn("w", F.col("tokens") / F.col("all")).withColumn("share0", F.col("w")).drop("all"), "mix-shares")  # one row
    goals = {}
    for d in DIMS:
        given = (targets or {}).get(d)
        goals[d] = materialize(tempered(cells, d) if given is None else spark.createDataFrame(
            [("" if k is None else f"={k}", float(v) / sum(given.values())) for k, v in given.items()], "value string, share double"), "mix-target")
    raked = rake(cells, goals, rounds).withColumn("ratio", F.col("w") / F.col("share0"))
    most = raked.agg(F.max("ratio").alias("most"))
    chance = raked.join(F.broadcast(most)).select("cell", F.when(F.col("most") > 0, F.col("ratio") / F.col("most")).otherwise(0.0).alias("probability"))  # one row
    drawn = params_by_key(rows, materialize(chance, "mix-chance"), "cell", F.col("doc_id"))
    u = hnum(h(seed, F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))).cast("double") / float(1 << 60)
    probability = F.when(F.col("n_tokens") > 0, F.coalesce("probability", F.lit(0.0))).otherwise(0.0)
    return drawn.select("key", "doc_id", F.substring("topic", 2, 1 << 20).alias("topic"), "n_tokens", probability.alias("probability"),
                        (u < probability).alias("sampled"))


def _key():
    return F.xxhash64("doc_id", F.xxhash64("text"), "source", "lang")


def mix(docs: DataFrame, targets: dict[str, dict] | None = None, topic: Column | None = None, rounds: int = ROUNDS, seed=SEED) -> DataFrame:
    """The sampled rows of ``docs``, all columns; rows that share an id only are drawn by their own cell's probability."""
    ids = _calibrated(docs, targets, topic, rounds, seed).filter("sampled").select(F.col("key").alias("__llm_key"), F.col("doc_id").alias("__llm_id")).distinct()
    keyed = docs.withColumn("__llm_row", _key())
    return keyed.join(ids, (keyed["__llm_row"] == ids["__llm_key"]) & keyed["doc_id"].eqNullSafe(ids["__llm_id"]), "left_semi").drop("__llm_row")


def calibrated_sql(source: str = "documents", rounds: int = ROUNDS, temper: float = TEMPER, seed=SEED) -> str:
    """DuckDB text of :func:`calibrated` with default targets over a relation; probabilities rounded to 6 places."""
    taken = lambda chars: f"(length(t) - length(translate(t, '{chars}', '')))"
    ctes = [f"""t AS (SELECT doc_id, coalesce('=' || source, '') AS source, coalesce('=' || lang, '') AS lang, coalesce(text, '') AS t FROM {source})""",
            f"""r AS (SELECT doc_id, source, lang, CASE WHEN 20 * {taken(SYMBOLS)} > length(t) THEN 'markup' WHEN 2 * {taken(UPPER)} > length(t) THEN 'shouting'
                WHEN contains(t, '@') THEN 'contacts' ELSE 'prose' END AS topic, CAST(len(regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS n_tokens FROM t)""",
            "c AS (SELECT source, lang, topic, CAST(sum(n_tokens) AS DOUBLE) AS tokens FROM r WHERE n_tokens > 0 GROUP BY ALL)",
            "w0 AS (SELECT *, tokens / sum(tokens) OVER () AS share0, tokens / sum(tokens) OVER () AS w FROM c)"]
    for d in DIMS:
        ctes.append(f"g_{d} AS (SELECT {d}, pow(sum(tokens), {temper}) / sum(pow(sum(tokens), {temper})) OVER () AS share FROM c GROUP BY {d})")
    n = 0
    for _ in range(rounds):
        for d in DIMS:
            ctes.append(f"w{n + 1} AS (SELECT w.* REPLACE (w.w * g.share / sum(w.w) OVER (PARTITION BY w.{d}) AS w) FROM w{n} w JOIN g_{d} g ON w.{d} = g.{d})")
            n += 1
    ctes.append(f"p AS (SELECT source, lang, topic, (w / share0) / max(w / share0) OVER () AS probability FROM w{n})")
    return "WITH " + ",\n".join(ctes) + f"""
SELECT doc_id, topic, n_tokens, round(coalesce(probability, 0), 6) AS probability,
       CAST({sql_hnum(sql_h(seed, 'doc_id'))} AS DOUBLE) / 1152921504606846976.0 < coalesce(probability, 0) AS sampled
FROM r LEFT JOIN p USING (source, lang, topic)"""
