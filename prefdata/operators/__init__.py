"""DataFrame -> DataFrame operators (split, pairs, prompts, tokens, packing, batches, metrics, shards)."""
