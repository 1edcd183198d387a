"""Session helpers: a local session for tests and benches, and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "prefdata") -> SparkSession:
    """A local session configured the way the tests and ``bench.py`` expect.

    On a cluster, build the session yourself; only ``spark.sql.session.timeZone=UTC``
    and a shared ``spark.checkpoint.dir`` are assumed by the library.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # Broadcast only on measured sizes: no static broadcast from file-size estimates (compressed
        # Parquet under-states memory, explode/filter estimates are guesses); AQE still turns a join
        # into a broadcast join at run time when the shuffled side really is small.
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "32m")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("PREFDATA_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    It is read from the session.  Only a local session (tests) may leave it
    unset: then a fresh folder under the system temp directory is registered.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a remote (Connect) session has no SparkContext
        sc = None
    root = spark.conf.get(CHECKPOINT_CONF, None) or (sc.getConf().get(CHECKPOINT_CONF, None) if sc else None)
    if not root:
        master = sc.master if sc is not None else ""
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="prefdata-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, root)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared checkpoint folder (for sinks and stream state)."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df, name: str = "stage", **options):
    """Cut lineage: write ``df`` as Parquet under the shared checkpoint folder and read it back.

    One pass over the input (``Dataset.checkpoint`` computes an unpersisted
    input twice: once for the action, once for the checkpoint write), and the
    files sit in reliable shared storage, so a lost executor does not force a
    recompute of everything upstream.  ``options`` are those of the Parquet writer.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path, **options)
    return spark.read.parquet(path)
