"""Keyed hashes: the only source of randomness in the library.

``h(seed, k1, k2, ...) = md5(seed || '-' || k1 || '-' || k2 ...)`` as lowercase hex.
The same string is produced by DuckDB's ``md5(concat_ws('-', ...))``, so every
sampled, shuffled or split result has an exact SQL oracle.  Hash only integers
and strings: doubles print differently in different engines.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Number of hex digits turned into an integer by ``hnum`` (60 bits, fits a signed long).
HNUM_DIGITS = 15


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def h(seed, *keys) -> Column:
    """md5 hex of ``seed-key1-key2...``; keys are column names or Columns."""
    parts = [F.lit(str(seed))] + [_col(k).cast("string") for k in keys]
    return F.md5(F.concat_ws("-", *parts))


def hnum(hex_col) -> Column:
    """Non-negative 60-bit integer from the first 15 hex digits of a hash column."""
    return F.conv(F.substring(_col(hex_col), 1, HNUM_DIGITS), 16, 10).cast("long")


def sql_h(seed, *keys: str) -> str:
    """DuckDB text of :func:`h` (for oracles and docs)."""
    return "md5(concat_ws('-', '%s', %s))" % (seed, ", ".join(f"CAST({k} AS VARCHAR)" for k in keys))


def sql_hnum(hex_sql: str) -> str:
    """DuckDB text of :func:`hnum`."""
    return f"('0x' || substr({hex_sql}, 1, {HNUM_DIGITS}))::BIGINT"
