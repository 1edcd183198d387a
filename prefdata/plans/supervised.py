"""Plan B: a split of pairs -> hold-out -> chars-per-token -> packed fixed-length blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefdata.functions.tokens import EOS_ID
from prefdata.operators import packing as PK
from prefdata.operators import split as S
from prefdata.operators import vocab as V
from prefdata.operators.prompts import qa_text


def sample_text(df: DataFrame) -> DataFrame:
    """The formatting hook (T14): ``Question: q\\n\\nAnswer: response_j``."""
    return df.withColumn("sample_text", qa_text("question", "response_j"))


def supervised_blocks(pairs: DataFrame, key: str, vocab: DataFrame | None = None, seq_length: int = PK.SEQ_LENGTH,
                      num_of_sequences: int = PK.NUM_OF_SEQUENCES, test_size: float = 0.005, n_epochs: int = 1,
                      seed=42, ratio_rows: int = 400):
    """Return ``(train_blocks, valid_blocks, chars_per_token)``.

    Train blocks repeat ``n_epochs`` times (a finite stand-in for the infinite
    iterator); both sides get ``labels`` = ``input_ids``.
    """
    df = sample_text(pairs)
    parts = S.holdout(df, key, test_size, seed)
    train, valid = parts.filter(F.col("part") == "train"), parts.filter(F.col("part") == "test")
    ratio_row = V.chars_per_token(S.first_n(train, key, ratio_rows, seed), "sample_text").first()
    cpt = ratio_row["ratio"] or PK.CHARS_PER_TOKEN
    vocab = vocab if vocab is not None else V.build_vocab(train, "sample_text")
    enc = V.encoder(vocab)

    def blocks(d: DataFrame, epochs: int) -> DataFrame:
        ids = d.select(key, V.with_eos(enc("sample_text"), EOS_ID).alias("ids"))
        keys = [key]
        if epochs > 1:
            ids, keys = PK.repeat_epochs(ids, epochs), ["epoch", key]
        n = PK.buffer_count(epochs * PK.total_chars(d, "sample_text"), seq_length, cpt, num_of_sequences)
        return PK.with_labels(PK.pack(ids, keys, "ids", seq_length, n, seed))

    return blocks(train, n_epochs), blocks(valid, 1), cpt
