"""Plan C: reward split -> subset -> Q+A texts -> tokens -> two-sided length filter -> padded batches; and metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame

from prefdata.functions.tokens import PAD_ID
from prefdata.operators import batches as B
from prefdata.operators import metrics as M
from prefdata.operators import split as S
from prefdata.operators import vocab as V
from prefdata.operators.prompts import filter_both_within, qa_text, with_return_loss


def reward_dataset(pairs: DataFrame, key: str, vocab: DataFrame, subset: int = 20000, max_length: int = 512,
                   batch_size: int = 2, pad_multiple: int | None = None, seed=42) -> DataFrame:
    """Rows of ``input_ids_j/k`` and ``attention_mask_j/k`` padded per batch, with ``return_loss``."""
    df = S.first_n(pairs, key, subset, seed)
    df = df.withColumn("text_j", qa_text("question", "response_j")).withColumn("text_k", qa_text("question", "response_k"))
    df = filter_both_within(df, "text_j", "text_k", max_length)
    enc = V.encoder(vocab)
    df = df.withColumn("ids_j", enc("text_j")).withColumn("ids_k", enc("text_k"))
    df = B.assign_batches(df, [key], batch_size, B.shard_count(df), seed)
    df = B.pad_batch(df, "ids_j", PAD_ID, pad_multiple, prefix="j_")
    df = B.pad_batch(df, "ids_k", PAD_ID, pad_multiple, prefix="k_")
    out = df.select(key, "shard", "batch_id", "pos", df["j_input_ids"].alias("input_ids_j"),
                    df["j_attention_mask"].alias("attention_mask_j"), df["k_input_ids"].alias("input_ids_k"),
                    df["k_attention_mask"].alias("attention_mask_k"))
    return with_return_loss(out)


def reward_metrics(scores: DataFrame, step: str | None = None) -> DataFrame:
    """M1, M2 (per evaluation step when ``step`` is given, M5)."""
    return M.pair_metrics(scores, [step] if step else None)
