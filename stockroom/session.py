"""SparkSession construction and lineage helpers."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def build_session(
    master: str | None = None,
    app_name: str = "stockroom",
    shuffle_partitions: int | None = None,
    driver_memory: str = "8g",
) -> SparkSession:
    """A session tuned for the engine.

    AQE re-plans joins (broadcast only when the runtime size is under the
    threshold), coalesces small shuffle partitions to the advisory size and
    splits skewed join partitions. In local mode the shuffle width follows
    the local cores; on a cluster the cluster's setting is kept, or a wide
    default that AQE coalesces, so partitions stay near 128 MB and fit
    executor memory at any scale. The UI stays off; timestamps are UTC so
    results match the DuckDB oracle.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    local = (master or "local").startswith("local")
    cores = os.cpu_count() or 8
    builder = (
        builder.config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(128 * 1024 * 1024))
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.files.maxPartitionBytes", str(128 * 1024 * 1024))
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    elif local:
        builder = builder.config("spark.sql.shuffle.partitions", str(max(8, 2 * cores)))
    if local:
        builder = builder.config("spark.driver.memory", driver_memory)
    spark = builder.getOrCreate()
    if not local and not shuffle_partitions and spark.conf.get("spark.sql.shuffle.partitions") == "200":
        # Spark's default is far too narrow for 100 TB; AQE merges what is small
        spark.conf.set("spark.sql.shuffle.partitions", "4000")
    if not local:
        # coalesce towards the advisory size, not towards 1 MB pieces that
        # keep the default parallelism (Spark's recommendation for clusters)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory of the session.

    On a cluster ``spark.checkpoint.dir`` must name a shared folder and is
    only read here. Only a local-mode session (tests, the bench) without a
    setting gets a fresh scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder "
                "(HDFS/S3/ABFS) so iterative jobs can cut lineage reliably"
            )
        configured = tempfile.mkdtemp(prefix="stockroom-ckpt-", dir="/tmp")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for derived files."""
    base = ensure_checkpoint_dir(spark)
    return base.rstrip("/") + "/" + name


def cut_lineage(df: DataFrame, name: str = "stage", outlives: bool = False, options: dict[str, str] | None = None) -> DataFrame:
    """Materialise ``df`` as a Parquet table in the shared checkpoint folder
    and read it back. ``outlives``: the table belongs to the scope around the
    innermost ``lineage_scope`` and stays when that one completes.
    ``options`` are the Parquet writer's.

    The plan runs once (``Dataset.checkpoint`` computes it twice unless it
    is also cached), the files survive executor loss (unlike
    ``localCheckpoint``), and iterative plans stop growing.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"lineage/{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").options(**(options or {})).parquet(path)
    scopes = _SCOPES[:-1] if outlives else _SCOPES
    if scopes:
        scopes[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def joined_in_place(spark: SparkSession) -> Iterator[None]:
    """Actions inside may join two sides by several keys where both are spread
    by the same one of them; otherwise Spark spreads both anew by all keys."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextlib.contextmanager
def small_batches(spark: SparkSession, size: str = "8m") -> Iterator[None]:
    """Actions inside hand rows to Python in batches of about this size, for rows that are large themselves."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, size)
    try:
        yield
    finally:
        spark.conf.set(name, before)


# lineage tables written inside each open ``lineage_scope`` (driver side)
_SCOPES: list[list[str]] = []


@contextlib.contextmanager
def lineage_scope(spark: SparkSession) -> Iterator[list[str]]:
    """Record the lineage tables written inside the block and delete them
    when it completes.

    A batch job runs in one scope and writes its marker last, so its
    intermediate tables (staged requests, allocation rounds, ...) go only
    once every output is durable. A failed block keeps them for inspection;
    a rerun writes new ones. Frames read from them must not be used after
    the block.
    """
    paths: list[str] = []
    _SCOPES.append(paths)
    done = False
    try:
        yield paths
        done = True
    finally:
        _SCOPES.remove(paths)
    if done:
        drop_tables(spark, paths)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder exists in the store that the path names."""
    sc = spark.sparkContext
    hp = sc._jvm.org.apache.hadoop.fs.Path(path)
    return hp.getFileSystem(sc._jsc.hadoopConfiguration()).exists(hp)


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder of the store that the path names (none: empty)."""
    sc = spark.sparkContext
    hp = sc._jvm.org.apache.hadoop.fs.Path(path)
    store = hp.getFileSystem(sc._jsc.hadoopConfiguration())
    return sorted(f.getPath().getName() for f in store.listStatus(hp)) if store.exists(hp) else []


def drop_tables(spark: SparkSession, paths: list[str]) -> None:
    """Delete folders through the Hadoop file system of each path (works for
    any shared store the cluster mounts)."""
    sc = spark.sparkContext
    conf = sc._jsc.hadoopConfiguration()
    for p in paths:
        hp = sc._jvm.org.apache.hadoop.fs.Path(p)
        hp.getFileSystem(conf).delete(hp, True)
