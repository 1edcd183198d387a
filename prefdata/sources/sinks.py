"""Sharded Parquet sinks (K3, K4, K5).

The reference writes ``data/<split>/train-{i:05d}-of-{n:05d}.parquet`` with a
16-process pool and refuses to write into an existing split folder.  Here the
tasks are the pool: rows are repartitioned by (split, shard) and written with
``partitionBy("split", "shard")``, so each shard is its own folder and one task
writes it; ``errorifexists`` refuses an existing target.  Spark names the part
files itself, so a manifest (split, shard, name, rows, bytes) is written next
to the data under ``_manifest`` (folders starting with ``_`` are ignored when
the dataset is read back).  Its statistics are read from the written files, so
what comes before the sink is computed once.  The files are listed once and
read once for it.  Tasks move their files to the shards' folders themselves:
were the driver to move them when the job is committed, its time would grow
with the number of shards.  So files may be there before all are; the manifest
comes last, and a path without one is not complete.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prefdata.operators.shards import row_bytes
from prefdata.session import materialize

MANIFEST = "_manifest"
STAGING, PLAN, PUBLISHED = "_staging", "_plan", "_published"


def shard_name(shard, n_shards) -> F.Column:
    """K3: ``train-{i:05d}-of-{n:05d}``."""
    return F.format_string("train-%05d-of-%05d", shard, n_shards)


def write_sharded(df: DataFrame, path: str, split: str = "split", shard: str = "shard", mode: str = "errorifexists",
                  max_records_per_file: int | None = None, order_by: str | None = None) -> DataFrame:
    """K4/K5: write every (split, shard) to its own folder; return the manifest DataFrame.

    ``order_by`` sorts the rows inside each shard (K2) and is not written itself.
    """
    return write_and_read_sharded(df, path, split, shard, mode, max_records_per_file, order_by)[0]


def write_and_read_sharded(df: DataFrame, path: str, split: str = "split", shard: str = "shard", mode: str = "errorifexists",
                           max_records_per_file: int | None = None, order_by: str | None = None) -> tuple[DataFrame, DataFrame]:
    """:func:`write_sharded`, and the rows as read back from the files (listed once for both)."""
    rows = df.repartition(split, shard)
    if order_by:
        rows, df = rows.sortWithinPartitions(split, shard, order_by).drop(order_by), df.drop(order_by)
    w = rows.write.mode(mode).partitionBy(split, shard).option("mapreduce.fileoutputcommitter.algorithm.version", "2")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    stats = materialize(back.groupBy(split, shard).agg(F.count(F.lit(1)).alias("rows"),
                                                       F.sum(row_bytes(back, exclude=(split, shard))).alias("bytes")), "shard-stats")
    n = stats.groupBy(split).agg(F.max(shard).alias("_max"))
    manifest = stats.join(n, split).withColumn("name", shard_name(F.col(shard), F.col("_max") + 1)).drop("_max")
    target = f"{path.rstrip('/')}/{MANIFEST}"
    manifest.write.mode(mode).parquet(target)
    return read_manifest(df.sparkSession, path), back


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path.rstrip('/')}/{MANIFEST}")


def _file_system(spark: SparkSession, path: str):
    to_path = spark._jvm.org.apache.hadoop.fs.Path
    return to_path(path).getFileSystem(spark._jsc.hadoopConfiguration()), to_path


def arrival_times(spark: SparkSession, folders: list[str]) -> None:
    """Give the files of every folder a time a second after those of the folder before; a file system that keeps no such times raises."""
    fs, to_path = _file_system(spark, folders[0])
    now = spark._jvm.java.lang.System.currentTimeMillis() // 1000 * 1000
    for i, folder in enumerate(folders):
        for f in fs.listStatus(to_path(folder)) if fs.exists(to_path(folder)) else []:
            at = now + (i - len(folders)) * 1000
            fs.setTimes(f.getPath(), at, -1)
            if fs.getFileStatus(f.getPath()).getModificationTime() != at:
                raise RuntimeError(f"{folder}: the file system does not keep the order of arrival")


def stage_shards(df: DataFrame, path: str, split: str = "split", shard: str = "shard", order_by: str | None = None) -> None:
    """First phase of :func:`publish_shards`: tasks write one file per shard under a staging folder, then the plan of names is committed.

    A plan that is there is kept: the phase was done before.  A path that holds published data is refused (K5).
    """
    spark, root = df.sparkSession, path.rstrip("/")
    fs, to_path = _file_system(spark, root)
    if fs.exists(to_path(f"{root}/{PUBLISHED}")):
        raise FileExistsError(f"{root} holds published shards")
    if fs.exists(to_path(f"{root}/{PLAN}/_SUCCESS")):
        return
    if fs.exists(to_path(f"{root}/data")):
        raise FileExistsError(f"{root}/data exists")
    rows = df.repartition(split, shard)
    if order_by:
        rows = rows.sortWithinPartitions(split, shard, order_by).drop(order_by)
    # One task holds a shard, so a shard is one file; an unfinished staging of a lost driver is written again.
    rows.write.mode("overwrite").option("maxRecordsPerFile", 0).partitionBy(split, shard).parquet(f"{root}/{STAGING}")
    staged = spark.read.parquet(f"{root}/{STAGING}")
    files = staged.groupBy(split, shard).agg(F.count(F.lit(1)).alias("rows"), F.min("_metadata.file_path").alias("staged"),
                                             F.count_distinct("_metadata.file_path").alias("files"))
    n = files.groupBy(split).agg((F.max(shard) + 1).alias("n_shards"))
    plan = files.join(n, split).withColumn("name", F.concat(shard_name(F.col(shard), F.col("n_shards")), F.lit(".parquet")))
    plan.select(split, shard, "rows", "staged", "files", "name").write.mode("overwrite").parquet(f"{root}/{PLAN}")


def rename_shards(spark: SparkSession, path: str, split: str = "split", threads: int = 16) -> None:
    """Second phase: move every staged file to ``data/<split>/<name>``.

    Safe to repeat: a file that is at its name already is done.  The plan has one row per shard.
    """
    root = path.rstrip("/")
    fs, to_path = _file_system(spark, root)
    plan = read_plan(spark, root).collect()
    for r in plan:
        if r["files"] != 1:
            raise RuntimeError(f"{r['name']} of {r[split]} was staged as {r['files']} files")
    for name in {r[split] for r in plan}:
        fs.mkdirs(to_path(f"{root}/data/{name}"))

    def move(r):
        staged, target = to_path(spark._jvm.java.net.URI(r["staged"])), to_path(f"{root}/data/{r[split]}/{r['name']}")
        if fs.exists(target):
            return
        if not fs.rename(staged, target) and not fs.exists(target):
            raise RuntimeError(f"could not move {r['staged']} to {target.toString()}")
    with ThreadPoolExecutor(threads) as pool:
        list(pool.map(move, plan))
    fs.create(to_path(f"{root}/{PUBLISHED}"), True).close()


def publish_shards(df: DataFrame, path: str, split: str = "split", shard: str = "shard", order_by: str | None = None) -> DataFrame:
    """K3/K4/K5: every shard as ``data/<split>/train-iiiii-of-nnnnn.parquet``; returns the plan of names and row counts.

    Two phases: tasks write under temporary names, the driver renames by the
    committed plan.  After a crash at any point the same call finishes the work.
    """
    stage_shards(df, path, split, shard, order_by)
    rename_shards(df.sparkSession, path, split)
    return read_plan(df.sparkSession, path)


def read_plan(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path.rstrip('/')}/{PLAN}")


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """Rows of all published files with ``split``, ``name`` and ``place`` (row of the file), taken from the files themselves."""
    where = F.split("_metadata.file_path", "/")
    return spark.read.parquet(f"{path.rstrip('/')}/data/*/*.parquet").select(
        "*", F.element_at(where, -2).alias("split"), F.element_at(where, -1).alias("name"), F.col("_metadata.row_index").alias("place"))
