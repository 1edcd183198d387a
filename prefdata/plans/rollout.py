"""Plan D: prompts with responses -> batches -> length draws -> query+response -> score -> reward -> per-batch log.

Generation is not built: the responses come from a table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefdata.operators import batches as B
from prefdata.operators import metrics as M
from prefdata.operators.prompts import query_response


def rollout_rewards(df: DataFrame, keys: list[str], query: str = "query", response: str = "response",
                    score_fn=None, baseline: float = 0.0, batch_size: int = B.BATCH_SIZE, n_batches: int | None = None,
                    seed=42):
    """Return ``(rows, log)``: per-row rewards and per-batch reward statistics."""
    n_shards = B.shard_count(df)
    b = B.assign_batches(df, keys, batch_size, n_shards, seed)
    if n_batches is not None:
        b = B.first_batches(b, n_batches, n_shards)
    b = b.withColumn("gen_len", B.length_draw(keys, seed))
    score = (score_fn or M.scorer())(query_response(query, response))
    b = b.withColumn("reward", M.baseline_shift(score, baseline))
    log = M.reward_stats(b, "reward", ["shard", "batch_id"])
    return b.select(*keys, "shard", "batch_id", "gen_len", F.col("reward")), log
