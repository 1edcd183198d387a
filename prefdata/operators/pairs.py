"""Better/worse answer pairs with a per-question cap.

Reference semantics: for every question, each unordered pair of answers with
different scores is one (better, worse) pair; tied pairs are dropped; when a
question has more than ``k`` (10) pairs, ``k`` of them are drawn without
replacement; every other column of the question is repeated on each pair.

The pair set of a question with n answers has up to n^2/2 members, so it is
never enumerated.  It is indexed instead:

* answers are grouped into score classes, best first; an answer in class ``s``
  is the worse side of ``above_s`` pairs (one per strictly better answer);
* the pairs of class ``s`` occupy indices ``[block_s, block_s + n_s*above_s)``,
  so index ``idx`` names worse member ``(idx-block_s) div above_s`` of class
  ``s`` and better answer number ``(idx-block_s) mod above_s`` in
  (score desc, member) order;
* ``k = min(10, NP)`` indices are drawn by Floyd's subset method with the keyed
  hash ``h(seed, qid, i)``: every subset of ``k`` pairs is equally likely, as
  in a draw without replacement (all pairs when ``NP <= 10``);
* members of a class are numbered by ``(h(seed, qid, aid), aid)``.

A question of up to ``SMALL_QUESTION`` answers is drawn in one group.  Of larger
ones only the per-class table (one row per question and score) and ``k`` draws per
question are joined; answers are touched once to number members of the
classes that were drawn.  Numbering inside a class is salted by hash prefix
(:func:`rank_in_class`), so a question or class holding a third of all rows is
spread over many tasks.  Texts are attached after the cap, so a long answer is
copied at most ``2k`` times, never ``n`` times.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prefdata.functions.keys import h, hnum
from prefdata.session import materialize

MAX_PAIRS = 10
# Largest number of rows one task numbers inside a class; bigger classes are salted.
RANK_TARGET = 500_000
# Most answers of a question that are drawn in one group, and most ids of larger questions that are broadcast.
SMALL_QUESTION, BROADCAST_QUESTIONS = 1000, 1_000_000


def drop_null_scores(answers: DataFrame, score: str = "score") -> DataFrame:
    """Answers without a score cannot be compared (the reference would raise); they are dropped."""
    return answers.filter(F.col(score).isNotNull())


def explode_threads(threads: DataFrame, answers: str = "answers", score: str = "pm_score") -> DataFrame:
    """Nested input -> one row per answer (P1: the nested column is dropped).

    ``answers`` is ``array<struct<pm_score, text, ...>>``; ``aid`` is the
    position in the array.  Other thread columns are kept.
    """
    rest = [c for c in threads.columns if c != answers]
    x = threads.select(*rest, F.posexplode(answers).alias("aid", "_a"))
    fields = [f.name for f in x.schema["_a"].dataType.fields]
    return x.select(*rest, "aid", *[F.col("_a")[f].alias(f) for f in fields])


# Largest number of score classes of one question handled by a single window task.
MAX_WINDOW_CLASSES = 200_000


def _class_sums(c: DataFrame, qid: str, score: str) -> DataFrame:
    """``above``, ``block`` and ``np`` with one window per question (few distinct scores per question)."""
    w = Window.partitionBy(qid).orderBy(F.col(score).desc()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(qid).orderBy(F.col(score).desc()).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    c = c.withColumn("above", F.coalesce(F.sum("n").over(w), F.lit(0)).cast("long"))
    c = c.withColumn("pairs", F.col("n") * F.col("above"))
    return c.withColumn("block", F.coalesce(F.sum("pairs").over(w), F.lit(0)).cast("long")).withColumn(
        "np", F.sum("pairs").over(whole).cast("long"))


def _class_sums_scan(c: DataFrame, qid: str, score: str, partitions: int) -> DataFrame:
    """The same sums as a distributed prefix scan, for questions with very many distinct scores.

    The class table is range-partitioned on (qid, score desc), so one question
    may span many partitions; running sums are taken inside each (partition,
    question) segment, and a per-segment table (at most one row per partition
    and question) carries the offsets across partitions.
    """
    r = materialize(c.repartitionByRange(partitions, F.col(qid), F.col(score).desc())
                    .withColumn("_p", F.spark_partition_id()), "class-ranges")
    prev = Window.partitionBy("_p", qid).orderBy(F.col(score).desc()).rowsBetween(Window.unboundedPreceding, -1)
    seg_all = Window.partitionBy("_p", qid)
    x = r.withColumn("_al", F.coalesce(F.sum("n").over(prev), F.lit(0)).cast("long"))
    x = x.withColumn("_bl", F.coalesce(F.sum(F.col("n") * F.col("_al")).over(prev), F.lit(0)).cast("long"))
    x = x.withColumn("_tn", F.sum("n").over(seg_all).cast("long")).withColumn(
        "_tb", F.sum(F.col("n") * F.col("_al")).over(seg_all).cast("long"))
    seg = x.select("_p", qid, "_tn", "_tb").dropDuplicates(["_p", qid])
    before = Window.partitionBy(qid).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(qid).orderBy("_p").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    seg = seg.withColumn("_on", F.coalesce(F.sum("_tn").over(before), F.lit(0)).cast("long"))
    seg = seg.withColumn("_contrib", F.col("_tb") + F.col("_tn") * F.col("_on"))
    seg = seg.withColumn("_ob", F.coalesce(F.sum("_contrib").over(before), F.lit(0)).cast("long")).withColumn(
        "np", F.sum("_contrib").over(whole).cast("long"))
    y = x.join(seg.select("_p", qid, "_on", "_ob", "np"), ["_p", qid])
    y = y.withColumn("above", F.col("_on") + F.col("_al"))
    y = y.withColumn("pairs", F.col("n") * F.col("above"))
    y = y.withColumn("block", F.col("_ob") + F.col("_on") * F.col("_al") + F.col("_bl"))
    return y.select(qid, score, "n", "above", "pairs", "block", "np")


def _class_stats(counts: DataFrame, qid: str) -> tuple[int, int]:
    """(most classes in one question, most answers in one class), one small job over the class counts."""
    r = counts.groupBy(qid).agg(F.count(F.lit(1)).alias("_k"), F.max("n").alias("_m")).agg(
        F.max("_k").alias("k"), F.max("_m").alias("m")).first()
    return int(r["k"] or 0), int(r["m"] or 0)


def _classes(answers: DataFrame, qid: str, score: str, scan_partitions: int | None, max_window_classes: int | None):
    c = answers.groupBy(qid, score).agg(F.count(F.lit(1)).alias("n"))
    limit = MAX_WINDOW_CLASSES if max_window_classes is None else max_window_classes
    if scan_partitions is not None:
        return _class_sums_scan(c, qid, score, scan_partitions), None
    c = materialize(c, "class-counts")
    widest, largest = _class_stats(c, qid)
    if widest <= limit:
        return _class_sums(c, qid, score), largest
    parts = max(2, int(c.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return _class_sums_scan(c, qid, score, parts), largest


def score_classes(answers: DataFrame, qid: str = "qid", score: str = "score", scan_partitions: int | None = None,
                  max_window_classes: int | None = None) -> DataFrame:
    """Per (question, score): ``n`` answers, ``above`` strictly better answers, first pair index ``block``,
    and the question's pair count ``np``.

    The class counts are a partial aggregate.  When no question has more than
    ``max_window_classes`` distinct scores (integer votes: always), one window
    per question computes the sums; otherwise a range-partitioned prefix scan
    does, so a hot question with continuous scores is spread over many tasks.
    """
    return _classes(answers, qid, score, scan_partitions, max_window_classes)[0]


def pair_space(answers: DataFrame, qid: str = "qid", score: str = "score") -> DataFrame:
    """J1 without enumeration: per question, answers, unequal (kept) pairs and tied (dropped) pairs."""
    c = score_classes(drop_null_scores(answers, score), qid, score)
    return c.groupBy(qid).agg(
        F.sum("n").alias("n_answers"),
        F.sum("pairs").alias("n_pairs"),
        F.sum(F.expr("n * (n - 1) div 2")).alias("n_tied"),
    )


def _taken(qid: str, seed) -> Column:
    """Floyd's k-subset of ``np`` pairs: the i-th draw is uniform over [0, np - k + i]; an index already taken gives way to the top one."""
    def draw(taken, i):
        top = F.col("np") - F.col("k") + i
        t = hnum(h(seed, F.lit("draw"), qid, i)) % (top + 1)
        return F.concat(taken, F.array(F.when(F.array_contains(taken, t), top).otherwise(t)))

    steps = F.sequence(F.lit(0).cast("long"), F.col("k") - 1)
    return F.aggregate(steps, F.array().cast("array<bigint>"), draw)


def _draws(classes: DataFrame, qid: str, k: int, seed) -> DataFrame:
    # The best class of each question (above = 0) carries the question's pair count: no aggregate needed.
    q = classes.filter((F.col("above") == 0) & (F.col("np") > 0)).select(qid, "np")
    q = q.withColumn("k", F.least(F.col("np"), F.lit(k)))
    return q.select(qid, F.posexplode(_taken(qid, seed)).alias("i", "idx")).select(qid, F.col("i").cast("long").alias("i"), "idx")


def unrank(draws: DataFrame, classes: DataFrame, qid: str, score: str) -> DataFrame:
    """Pair index -> (worse class, member) and (better class, member)."""
    w = classes.filter(F.col("pairs") > 0).select(qid, F.col(score).alias("score_w"), F.col("above").alias("above_w"),
                       F.col("pairs").alias("pairs_w"), F.col("block").alias("block_w"))
    x = draws.join(w, [qid]).filter((F.col("idx") >= F.col("block_w")) &
                                   (F.col("idx") < F.col("block_w") + F.col("pairs_w")))
    local = F.col("idx") - F.col("block_w")
    x = x.withColumn("_local", local).select(qid, "i", "score_w", F.expr("_local div above_w").alias("m_w"),
                                             F.expr("_local % above_w").alias("bp"))
    b = classes.select(qid, F.col(score).alias("score_b"), F.col("above").alias("above_b"), F.col("n").alias("n_b"))
    x = x.join(b, [qid]).filter((F.col("bp") >= F.col("above_b")) & (F.col("bp") < F.col("above_b") + F.col("n_b")))
    return x.select(qid, "i", "score_w", "m_w", "score_b", (F.col("bp") - F.col("above_b")).alias("m_b"))


def _salt_digits(n: Column, target: int) -> Column:
    """Hex digits of member hash used to cut a class of ``n`` members into buckets of about ``target``."""
    return F.when(n <= target, F.lit(0)).otherwise(
        F.least(F.ceil(F.log(16.0, n / F.lit(float(target)))), F.lit(12))).cast("int")


def rank_in_class(answers: DataFrame, classes: DataFrame, qid: str, aid: str, score: str, seed,
                  target: int | None = None, salted: bool = True) -> DataFrame:
    """Number the members of each class in ``classes`` by ``(h(seed, qid, aid), aid)`` -> ``m`` (0-based).

    Classes of at most ``target`` members are ranked by one window each.  A
    larger class is cut into ``16**d`` buckets by the first ``d`` hex digits of
    the member hash; the hash order is the bucket order, so ``m`` = members in
    earlier buckets + rank inside the bucket, and no window holds much more than
    ``target`` rows however large the class is.
    """
    target = RANK_TARGET if target is None else target
    cls = classes.select(qid, score, _salt_digits(F.col("n"), target).alias("_d"))
    x = answers.join(cls, [qid, score]).withColumn("_h", h(seed, qid, aid))
    small = x.filter(F.col("_d") == 0)
    small = small.withColumn("m", F.row_number().over(Window.partitionBy(qid, score).orderBy("_h", aid)) - 1)
    if not salted:
        return small.drop("_d", "_h")
    big = x.filter(F.col("_d") > 0).withColumn("_b", F.expr("substring(_h, 1, _d)"))
    bc = big.groupBy(qid, score, "_b").agg(F.count(F.lit(1)).alias("_c"))
    wb = Window.partitionBy(qid, score).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    bc = bc.select(qid, score, "_b", F.coalesce(F.sum("_c").over(wb), F.lit(0)).alias("_base"))
    big = big.join(bc, [qid, score, "_b"])
    wr = Window.partitionBy(qid, score, "_b").orderBy("_h", aid)
    big = big.withColumn("m", F.col("_base") + F.row_number().over(wr) - 1).drop("_b", "_base")
    return small.unionByName(big).drop("_d", "_h")


def _sample_small(a: DataFrame, k: int, seed, qid: str, aid: str, score: str) -> DataFrame:
    """:func:`sample_pairs` of questions with up to ``SMALL_QUESTION`` answers: one shuffle of the answers, all else inside it.

    In the order (score desc, member) the answer at place ``p`` is the worse
    side of ``above`` pairs, one with each of the places before its class, so
    it occupies the pair indices ``[first, first + above)`` and index ``idx``
    names the better answer at place ``idx - first``.
    """
    w = Window.partitionBy(qid).orderBy(F.col(score).desc(), "_h", aid)
    x = a.repartition(qid).withColumn("_h", h(seed, qid, aid)).withColumn("_p", F.row_number().over(w) - 1).drop("_h")
    x = x.withColumn("_above", (F.rank().over(Window.partitionBy(qid).orderBy(F.col(score).desc())) - 1).cast("long"))
    one = F.struct("_p", "_above", F.col(score).alias("score"), F.col(aid).alias("aid"))
    q = x.groupBy(qid).agg(F.sum("_above").alias("np"), F.sort_array(F.collect_list(one)).alias("_a")).filter("np > 0")
    q = q.withColumn("k", F.least(F.col("np"), F.lit(k)))
    q = q.select(qid, "_a", F.posexplode(_taken(qid, seed)).alias("_i", "idx"))
    # The last place whose pairs begin at or before idx and are some.
    start = F.struct(F.lit(0).cast("long").alias("first"), F.lit(None).cast("int").alias("p"), F.lit(None).cast("long").alias("from"))

    def walk(s, e):
        mine = (s["first"] <= F.col("idx")) & (F.col("idx") < s["first"] + e["_above"])
        return F.struct((s["first"] + e["_above"]).alias("first"), F.when(mine, e["_p"]).otherwise(s["p"]).alias("p"),
                        F.when(mine, s["first"]).otherwise(s["from"]).alias("from"))
    q = q.withColumn("_w", F.aggregate("_a", start, walk))
    q = q.select(qid, F.col("_i").cast("long").alias("pair_no"), F.get("_a", (F.col("idx") - F.col("_w.from")).cast("int")).alias("_j"),
                 F.get("_a", F.col("_w.p")).alias("_k"))
    return q.select(qid, "pair_no", F.col("_j.aid").alias("aid_j"), F.col("_j.score").alias("score_j"),
                    F.col("_k.aid").alias("aid_k"), F.col("_k.score").alias("score_k"))


def sample_pairs(answers: DataFrame, k: int = MAX_PAIRS, seed=42, qid: str = "qid", aid: str = "aid",
                 score: str = "score") -> DataFrame:
    """J1 + O6: up to ``k`` distinct (better, worse) pairs per question, ids only.

    Output: ``qid, pair_no, aid_j, score_j, aid_k, score_k`` (``j`` better).
    Questions of up to ``SMALL_QUESTION`` answers are drawn where their answers
    meet (:func:`_sample_small`); larger ones by their class table.
    """
    a = drop_null_scores(answers.select(qid, aid, score), score).filter(F.col(qid).isNotNull())
    large = materialize(a.groupBy(qid).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > SMALL_QUESTION).select(qid), "large-questions")
    n = large.count()
    if not n:
        return _sample_small(a, k, seed, qid, aid, score)
    large = F.broadcast(large) if n <= BROADCAST_QUESTIONS else large
    small = _sample_small(a.join(large, qid, "left_anti"), k, seed, qid, aid, score)
    return small.unionByName(_sample_large(a.join(large, qid, "left_semi"), k, seed, qid, aid, score))


def _sample_large(a: DataFrame, k: int, seed, qid: str, aid: str, score: str) -> DataFrame:
    """:func:`sample_pairs` of questions of any size, by classes.

    The class table and the draws (one row per question and score, ``k`` rows
    per question) are written once to the shared checkpoint folder, which cuts
    their lineage and keeps them from being recomputed in every branch.
    """
    sums, largest = _classes(a, qid, score, None, None)
    classes = materialize(sums, "pair-classes")
    picks = materialize(unrank(_draws(classes, qid, k, seed), classes, qid, score), "pair-picks")
    ends = picks.select(qid, "i", F.lit(0).alias("side"), F.col("score_b").alias(score), F.col("m_b").alias("m")).union(
        picks.select(qid, "i", F.lit(1).alias("side"), F.col("score_w").alias(score), F.col("m_w").alias("m")))
    wanted = classes.join(ends.select(qid, score).distinct(), [qid, score])
    salted = largest > RANK_TARGET
    ranked = rank_in_class(a, wanted, qid, aid, score, seed, salted=salted)
    if salted:
        # hot classes: the member number is part of the key, so one class spreads over many partitions
        members = ranked.join(ends, [qid, score, "m"])
    else:
        # the ranked answers are already hash-partitioned by (qid, score) from the class window; match the
        # member number as a residual so the answers are not shuffled again
        e = ends.withColumnRenamed("m", "_m")
        members = ranked.join(e, [qid, score]).filter((F.col("m") - F.col("_m")) == 0).drop("_m")
    out = members.groupBy(qid, "i").agg(
        F.max(F.when(F.col("side") == 0, F.col(aid))).alias("aid_j"),
        F.max(F.when(F.col("side") == 0, F.col(score))).alias("score_j"),
        F.max(F.when(F.col("side") == 1, F.col(aid))).alias("aid_k"),
        F.max(F.when(F.col("side") == 1, F.col(score))).alias("score_k"),
    )
    return out.select(qid, F.col("i").alias("pair_no"), "aid_j", "score_j", "aid_k", "score_k")


def attach_texts(pairs: DataFrame, answers: DataFrame, questions: DataFrame, qid: str = "qid", aid: str = "aid",
                 text: str = "text", clean=None) -> DataFrame:
    """Repeat the question's columns on each pair and add ``response_j`` / ``response_k``.

    Answers are matched on (question, answer id): an answer id need only be
    unique inside its question (a position in a nested thread is).  Only the
    drawn answers are fetched; ``clean`` (a Column function) runs once on each.
    """
    drawn = pairs.select(qid, F.col("aid_j").alias(aid)).unionByName(pairs.select(qid, F.col("aid_k").alias(aid))).distinct()
    t = answers.select(qid, aid, F.col(text).alias("_t")).join(drawn, [qid, aid])
    if clean:
        t = materialize(t.select(qid, aid, clean(F.col("_t")).alias("_t")), "pair-texts")
    p = pairs.join(t.select(qid, F.col(aid).alias("aid_j"), F.col("_t").alias("response_j")), [qid, "aid_j"])
    p = p.join(t.select(qid, F.col(aid).alias("aid_k"), F.col("_t").alias("response_k")), [qid, "aid_k"])
    return p.join(questions, qid)


def capped_pairs(answers: DataFrame, questions: DataFrame, k: int = MAX_PAIRS, seed=42, qid: str = "qid",
                 aid: str = "aid", score: str = "score", text: str = "text", clean=None) -> DataFrame:
    """Sampled pairs with texts; questions without a pair vanish (inner semantics)."""
    ids = sample_pairs(answers, k, seed, qid, aid, score)
    return attach_texts(ids, answers, questions, qid, aid, text, clean)
