"""Registered queries of the training-data operators: ``QUERIES`` and, where SQL can say it, ``SQL``."""

from __future__ import annotations

from pyspark.sql import functions as F

from prefdata.llm.common import table

QUERIES: dict = {}
SQL: dict = {}


def register(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


@register("op10_simhash_near_dedup")
def op10(spark, sf):
    from prefdata.llm.simhash import fingerprint_hex, simhash_groups

    groups = simhash_groups(table(spark, sf, "documents"))
    return groups.select("doc_id", fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id")


@register("op1_quality_outliers")
def op1(spark, sf):
    from prefdata.llm.outliers import quality_outliers

    return quality_outliers(table(spark, sf, "documents"))


def _op3_sql():
    from prefdata.llm.decontam import contamination_sql

    return contamination_sql()


@register("op3_benchmark_decontamination", _op3_sql())
def op3(spark, sf):
    from prefdata.llm.decontam import contamination

    return contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark")).drop("key", "hit_words")


@register("op5_personal_data")
def op5(spark, sf):
    from prefdata.llm.pii import personal_data

    return personal_data(table(spark, sf, "documents"))


@register("op6_quality_classifier")
def op6(spark, sf):
    from prefdata.llm.quality import quality_scores

    return quality_scores(table(spark, sf, "documents"), table(spark, sf, "labels"))


@register("op7_language_id")
def op7(spark, sf):
    from prefdata.llm.langid import languages

    return languages(table(spark, sf, "documents"))


def _op8_sql():
    from prefdata.llm.warc import round_trip_sql

    return round_trip_sql()


@register("op8_warc_writer", _op8_sql())
def op8(spark, sf):
    from prefdata.llm.warc import round_trip

    return round_trip(table(spark, sf, "pages")).drop("url")


def _op9_sql():
    from prefdata.llm.mixing import calibrated_sql

    return calibrated_sql()


@register("op9_mix_to_targets", _op9_sql())
def op9(spark, sf):
    from prefdata.llm.mixing import calibrated

    return calibrated(table(spark, sf, "documents")).withColumn("probability", F.round("probability", 6))


@register("op2_fuzzy_line_dedup")
def op2(spark, sf):
    from prefdata.llm.lines import dedup_lines

    return dedup_lines(table(spark, sf, "documents")).select("doc_id", "text", "n_chars")


@register("op4_secret_scan")
def op4(spark, sf):
    from prefdata.llm.secret_scan import secrets

    return secrets(table(spark, sf, "documents"))


def _op13_sql():
    from prefdata.llm.trie import prefix_trie_sql

    return prefix_trie_sql()


@register("op13_prefix_trie", _op13_sql())
def op13(spark, sf):
    from prefdata.llm.trie import prefix_trie

    return prefix_trie(table(spark, sf, "conversations"))


def _op12_sql():
    from prefdata.llm.search import ranked_sql

    return ranked_sql()


@register("op12_ranked_search", _op12_sql())
def op12(spark, sf):
    from prefdata.llm.search import ranked

    return ranked(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@register("op11_toxicity")
def op11(spark, sf):
    from prefdata.llm.toxicity import toxicity

    return toxicity(table(spark, sf, "documents"), table(spark, sf, "labels"))
