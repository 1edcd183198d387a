"""Parquet sources.

The reference reads one ``train-00000-of-00001.parquet`` per topic and can
read no other layout (it names a single part).  Here a topic is a glob over
all parts, several topics are one scan, and the topic becomes a column.
Split folders are read as one table partitioned by ``split`` so a filter on
the split prunes directories instead of listing them by hand.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin a scan that arrives in fewer partitions than the cluster has cores.

    A single Parquet file with one row group is read by one task, and every
    map-side expression after it (regex tokens, hashes, UDFs) would run there.
    On a cluster the input has at least as many splits as cores and this is a
    no-op, so it never re-shuffles a large input.
    """
    try:
        target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001 - no SparkContext (remote session): leave the scan as it is
        return df
    return df if df.rdd.getNumPartitions() >= target else df.repartition(target)


# Tables whose rows carry long texts: the per-row work after the scan (regex, tokens, UDFs) is heavy.
TEXT_TABLES = frozenset({"documents", "pages", "conversations"})


def table(spark: SparkSession, sf_dir: str, name: str, spread_scan: bool | None = None) -> DataFrame:
    """One driver table, ``{sf_dir}/{name}.parquet``.

    Text tables are spread over the cores when they arrive in too few splits
    (:func:`spread`); pass ``spread_scan`` to override.
    """
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    do_spread = name in TEXT_TABLES if spread_scan is None else spread_scan
    return spread(df) if do_spread else df


def topic_paths(root: str, *topics: str, site_suffix: str = ".stackexchange.com") -> list[str]:
    """One glob per topic covering every part file of its ``train`` shards."""
    return [f"{root.rstrip('/')}/{t}{site_suffix}/train-*.parquet" for t in topics]


def read_topics(spark: SparkSession, root: str, *topics: str, site_suffix: str = ".stackexchange.com") -> DataFrame:
    """All topics as one table with a ``topic`` column taken from the file path."""
    df = spark.read.parquet(*topic_paths(root, *topics, site_suffix=site_suffix))
    topic = F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]+)" + site_suffix.replace(".", r"\.") + "/", 1)
    return df.withColumn("topic", topic)


#: Numbers from narrow to wide; two of them meet in the wider one.
NUMBERS = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType())


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds the values of both: wider numbers, all fields of structs (first ``a``'s), and so on inside arrays.

    An integer of more than 16 bits and a float meet in a double.  Types that only a conversion to text could join raise.
    """
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(common_type(a.elementType, b.elementType), True)
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        other = {f.name: f.dataType for f in b.fields}
        fields = [T.StructField(f.name, common_type(f.dataType, other.pop(f.name, T.NullType())), True) for f in a.fields]
        return T.StructType(fields + [T.StructField(n, t, True) for n, t in other.items()])
    if a in NUMBERS and b in NUMBERS:
        low, high = sorted((NUMBERS.index(a), NUMBERS.index(b)))
        return T.DoubleType() if low in (2, 3) and high == 4 or low == 3 and high == 5 else NUMBERS[high]
    raise TypeError(f"no common type of {a.simpleString()} and {b.simpleString()}")


def conform(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """``value`` as the wider type: missing fields are null, null structs and arrays stay null."""
    if have == want:
        return value
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):
        return F.transform(value, lambda x: conform(x, have.elementType, want.elementType))
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        fields = {f.name: f.dataType for f in have.fields}
        out = F.struct(*[(conform(value.getField(f.name), fields[f.name], f.dataType) if f.name in fields
                          else F.lit(None).cast(f.dataType)).alias(f.name) for f in want.fields])
        return F.when(value.isNull(), F.lit(None)).otherwise(out)
    return value.cast(want)


def read_topics_reconciled(spark: SparkSession, root: str, *topics: str, site_suffix: str = ".stackexchange.com") -> DataFrame:
    """S1/S2 for topics whose files differ: one table of the common schema with a ``topic`` column.

    The parts of one topic share their schema, which a footer gives; topics may
    add, lack or widen columns and fields at any depth, inside arrays too.  Each
    topic stays a scan of its own columns, so filters and pruning reach its files.
    """
    scans = [spark.read.parquet(*topic_paths(root, t, site_suffix=site_suffix)) for t in topics]
    want = scans[0].schema
    for scan in scans[1:]:
        want = common_type(want, scan.schema)
    out = None
    for topic, scan in zip(topics, scans):
        have = {f.name: f.dataType for f in scan.schema.fields}
        row = scan.select(*[(conform(F.col(f"`{f.name}`"), have[f.name], f.dataType) if f.name in have
                             else F.lit(None).cast(f.dataType)).alias(f.name) for f in want.fields], F.lit(topic).alias("topic"))
        out = row if out is None else out.unionByName(row)
    return out


def read_topic_folders(spark: SparkSession, root: str, *topics: str, column: str = "topic") -> DataFrame:
    """S2 for folders ``topic=<name>``: one table; the filter prunes the folders of other topics."""
    return spark.read.parquet(root).filter(F.col(column).isin(*topics))


def read_split(spark: SparkSession, root: str, split: str) -> DataFrame:
    """S3: one split of a dataset written by :func:`prefdata.sources.sinks.write_sharded`.

    The dataset is partitioned by ``split``; the filter prunes the other folders.
    """
    return spark.read.parquet(root).filter(F.col("split") == split)
