"""Subword ids by a public byte-level vocabulary.

Tokenizers are not trained here: the caller names a file of a public one, a
line with a piece in base64 and its rank for each entry.  Spark reads the file
(any file system that Spark reads will do), its size is checked, and the ranks
are broadcast.  Encoding is map-only and Arrow-batched.  Byte-level pieces
cover every byte, so decoding gives the very text back.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prefdata.operators.vocab import cuts_of, sizes_of

#: Fixed value: how byte-level vocabularies of this family cut a text into words before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Entries of a vocabulary that is broadcast, at most (some 20 MB).
MAX_ENTRIES = 1_000_000


def read_ranks(spark: SparkSession, path: str, max_entries: int = MAX_ENTRIES) -> dict[bytes, int]:
    """Piece -> id of a vocabulary file; more than ``max_entries`` raise."""
    part = F.split("value", " ")
    lines = spark.read.text(path).filter("value <> ''")
    rows = lines.select(F.unbase64(part[0]).alias("piece"), part[1].cast("int").alias("rank")).limit(max_entries + 1).collect()
    if len(rows) > max_entries:
        raise ValueError(f"{path} has more than {max_entries} entries; refusing to broadcast it")
    return {bytes(r["piece"]): r["rank"] for r in rows}


class Subwords:
    """A vocabulary shipped to the tasks: :meth:`encode` and :meth:`decode` are Column functions."""

    def __init__(self, spark: SparkSession, path: str, pattern: str = PATTERN):
        ranks = read_ranks(spark, path)
        self.size = max(ranks.values(), default=-1) + 1
        self.eos_id = self.size  # the first id that no piece has
        self._shipped = spark.sparkContext.broadcast((pattern, ranks))

    def encode(self, text: str | Column, eos: bool = False) -> Column:
        """Text -> ``array<int>``; null stays null, an empty text has no ids; ``eos`` ends every list with :attr:`eos_id`."""
        shipped, eos_id = self._shipped, self.eos_id

        @F.arrow_udf(T.ArrayType(T.IntegerType()))
        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            own = tiktoken.Encoding("own", pat_str=shipped.value[0], mergeable_ranks=shipped.value[1], special_tokens={})
            end = [eos_id] if eos else []

            def part(texts):
                ids = [np.array(own.encode_ordinary(t) + end, np.int32) if t is not None else np.empty(0, np.int32) for t in (x.as_py() for x in texts)]
                offsets = pa.array(np.cumsum([0, *map(len, ids)]), pa.int32())
                return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(ids) if ids else np.empty(0, np.int32)), mask=texts.is_null())
            for texts in batches:
                size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                yield pa.concat_arrays([part(texts.slice(i, j - i)) for i, j in cuts_of(size)])

        return run(F.col(text) if isinstance(text, str) else text)

    def decode(self, ids: str | Column) -> Column:
        """``array<int>`` -> text; the eos id and unknown ids give nothing, bytes that a cut took apart become U+FFFD."""
        shipped, size = self._shipped, self.size

        @F.arrow_udf(T.BinaryType())
        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            pieces = [b""] * size
            for piece, rank in shipped.value[1].items():
                pieces[rank] = piece
            values = pa.array([*pieces, b""], pa.binary())

            def part(lists, n):
                at = pc.fill_null(lists.flatten(), size).to_numpy(zero_copy_only=False)
                flat = values.take(pa.array(np.where((at >= 0) & (at < size), at, size)))
                offsets = pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32())
                return pc.binary_join(pa.ListArray.from_arrays(offsets, flat, mask=lists.is_null()), b"")
            for lists in batches:
                n = sizes_of(lists)
                yield pa.concat_arrays([part(lists.slice(i, j - i), n[i:j]) for i, j in cuts_of(n)])

        return F.make_valid_utf8(run(F.col(ids) if isinstance(ids, str) else ids).cast("string"))


def truncated(sub: Subwords, text: str | Column, max_length: int) -> Column:
    """The first ``max_length`` ids of a text."""
    return F.slice(sub.encode(text), 1, max_length)
