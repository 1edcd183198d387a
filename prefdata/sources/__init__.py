"""Sources (Parquet topic and split scans, fixture views) and sinks (sharded Parquet writers)."""
