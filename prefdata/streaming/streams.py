"""Streaming operators (S4, O2, L2 stream form, X1, X2, X3).

The reference's only streaming is a lazy iterator over a dataset: take/skip a
validation prefix, shuffle through a buffer, feed the packer.  On a stream
there is no total order, so:

* the hold-out / split is a keyed-hash threshold (stateless, the same on every
  micro-batch and on a replay);
* the buffered shuffle orders each micro-batch by the keyed hash inside
  ``foreachBatch``;
* prompt preparation (X2) is a stateless projection and filter;
* the reward metric (X3) is an event-time windowed average with a watermark,
  append mode.

The keyed shuffle buffer and the packer are in :mod:`prefdata.streaming.stateful`.

Every query writes to a Parquet sink with a checkpoint.  Where the caller names
their folder (``root``), a later run on it goes on where the last one stopped,
and the sink's log keeps each micro-batch exactly once; without a name they lie
in a new folder under ``spark.checkpoint.dir`` and the run is for itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from prefdata.functions.keys import h, hnum
from prefdata.functions.tokens import token_count
from prefdata.operators.prompts import question_prompt
from prefdata.operators.split import SPLIT_NAMES, SPLIT_TENTHS
from prefdata.session import scratch_path


def read_stream(spark: SparkSession, path: str, schema: StructType | None = None,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """A Parquet file stream (``path`` may be a folder or a glob)."""
    if schema is None:
        schema = spark.read.parquet(path).schema
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def ntz_to_utc(ts) -> Column:
    """A ``TIMESTAMP_NTZ`` wall clock read as UTC, whatever the session time zone is."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.make_timestamp(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), F.minute(c),
                            F.date_part(F.lit("SECOND"), c), F.lit("UTC"))


def hash_bucket(key, seed=42, buckets: int = 10) -> Column:
    return F.pmod(hnum(h(seed, key)), F.lit(buckets))


def hash_split(key, seed=42, tenths=SPLIT_TENTHS, names=SPLIT_NAMES) -> Column:
    """The 30/30/30/10 split as thresholds on a keyed hash (expected, not exact, fractions)."""
    b = hash_bucket(key, seed, 10)
    expr = F.when(b < tenths[0], F.lit(names[0]))
    for t, name in zip(tenths[1:], names[1:]):
        expr = expr.when(b < t, F.lit(name))
    return expr.otherwise(F.lit(names[-1]))


def hash_holdout(key, fraction: float, seed=42, resolution: int = 1_000_000) -> Column:
    """L2 / O5 on a stream: ``valid`` for a keyed-hash fraction of rows, ``train`` for the rest."""
    b = F.pmod(hnum(h(seed, key)), F.lit(resolution))
    return F.when(b < int(round(fraction * resolution)), F.lit("valid")).otherwise(F.lit("train"))


def prompts(conversations: DataFrame, max_tokens: int = 512) -> DataFrame:
    """User turns -> question prompt -> strict length filter."""
    u = conversations.filter(F.col("role") == "user").select("conv_id", "turn", question_prompt("text").alias("query"))
    return u.filter(token_count("query") < max_tokens)


def windowed_rewards(events: DataFrame, ts: str = "ts", value: str = "value", group: str = "event_type",
                     window: str = "1 day", watermark: str = "1 hour", digits: int = 6) -> DataFrame:
    """Per event-time window and group, count and mean of the reward value (append mode)."""
    e = events.withColumn("_t", ntz_to_utc(ts)).withWatermark("_t", watermark)
    agg = e.groupBy(F.window("_t", window).alias("w"), group).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg(value), digits).alias("mean_value"))
    return agg.select(F.unix_seconds(F.col("w.start")).alias("window_start"), group, "n", "mean_value")


def open_windows(spark: SparkSession, checkpoint: str, group: str = "event_type", digits: int = 6) -> DataFrame:
    """X3, closing pass: the windows that :func:`windowed_rewards` still holds, as rows of its result.

    For the end of a stream: append mode emits a window only once the watermark
    has passed it.  The state is read, not changed, so a later run goes on.
    """
    state = spark.read.format("statestore").load(checkpoint)
    # Spark names both counters ``count`` (all rows, and rows with a value): by place, then.
    held = state.select("key.window", f"key.{group}", F.col("value").cast("struct<n: long, total: double, valued: long>").alias("v"))
    return held.select(F.unix_seconds("window.start").alias("window_start"), group, F.col("v.n").alias("n"),
                       F.round(F.try_divide("v.total", "v.valued"), digits).alias("mean_value"))


def run_to_table(spark: SparkSession, df: DataFrame, name: str, output_mode: str = "append",
                 partition_by: list[str] | None = None, root: str | None = None) -> DataFrame:
    """Run a stream over everything available (``availableNow``) into a Parquet sink; read it back.

    ``root`` holds ``data`` and ``checkpoint``; a run on a ``root`` that has them
    takes only what arrived since and adds to the data, also after a driver was lost.
    """
    root = root or scratch_path(spark, name)
    w = (df.writeStream.format("parquet").outputMode(output_mode)
         .option("checkpointLocation", f"{root}/checkpoint").option("path", f"{root}/data")
         .trigger(availableNow=True))
    if partition_by:
        w = w.partitionBy(*partition_by)
    q = w.start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return spark.read.schema(_sink_schema(df, partition_by)).parquet(f"{root}/data")


def _sink_schema(df: DataFrame, partition_by):
    fields = [f for f in df.schema.fields if not partition_by or f.name not in partition_by]
    fields += [f for f in df.schema.fields if partition_by and f.name in partition_by]
    return StructType(fields)


def shuffle_each_batch(df: DataFrame, key: str, path: str, checkpoint: str, seed=42):
    """O2: a buffered shuffle - each micro-batch is written in keyed-hash order (``foreachBatch``).

    A batch has a folder of its own (``batch=<id>``) that a replay overwrites,
    so a restart from ``checkpoint`` neither loses nor repeats rows.
    """

    def write(batch: DataFrame, epoch_id: int):
        # each output partition is a random subset in random order; no task holds the whole batch
        (batch.withColumn("_o", h(seed, F.lit(epoch_id), key)).repartition("_o").sortWithinPartitions("_o")
         .drop("_o").write.mode("overwrite").parquet(f"{path}/batch={epoch_id}"))

    return (df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
