"""Session helpers: a local builder for tests/bench, checkpoint location and
size-checked broadcast."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Broadcast only below this many bytes of *estimated* plan size.
DEFAULT_BROADCAST_LIMIT = 64 * 1024 * 1024


def local_session(cpus: int | str = "*", app: str = "citymotion", extra: dict | None = None) -> SparkSession:
    """A local session with the settings the package expects (tests, bench)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    On a cluster this setting names a shared filesystem; it is only filled in
    here when unset (local tests), with a fresh scratch folder.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        master = spark.conf.get("spark.master", "")
        if not re.match(r"local(\[|$)", master):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors share")
        current = tempfile.mkdtemp(prefix="citymotion-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    spark.sparkContext.setCheckpointDir(current)
    return current


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def table_bytes(df: DataFrame) -> tuple[int, int]:
    """Exact rows and value bytes of ``df`` (strings by length, other columns 16 bytes)."""
    text = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    width = F.lit(16 * len(df.columns)).cast("long")
    for c in text:
        width = width + F.coalesce(F.octet_length(c), F.lit(0))
    r = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("b")).first()
    return int(r["n"]), int(r["b"])


def measured_side(df: DataFrame, name: str, limit_bytes: int = DEFAULT_BROADCAST_LIMIT) -> DataFrame:
    """A dimension to join: written once to the shared folder and read back, and broadcast
    when its measured bytes prove it small.  Beyond the limit the join is a shuffle join."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/side-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    side = spark.read.schema(df.schema).parquet(path)
    return F.broadcast(side) if table_bytes(side)[1] <= limit_bytes else side


def broadcast_if_bounded(df: DataFrame, max_rows: int | None, row_bytes: int, limit_bytes: int = DEFAULT_BROADCAST_LIMIT) -> DataFrame:
    """Broadcast when a proven upper bound on the row count (computed by the caller,
    e.g. from the rows before an explode and its maximal fan-out) keeps the table
    under the limit; the planner's estimate does not include explode fan-out."""
    if max_rows is not None and max_rows * row_bytes <= limit_bytes:
        return F.broadcast(df)
    return df


WRITERS = 16


@contextmanager
def unsorted_partitions(spark: SparkSession) -> Iterator[None]:
    """Partitioned writes inside keep a file open per folder rather than sort a task's rows by
    folder; a task with more than ``WRITERS`` folders sorts the rest."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    old = spark.conf.get(key, None)
    spark.conf.set(key, str(WRITERS))
    try:
        yield
    finally:
        spark.conf.unset(key) if old is None else spark.conf.set(key, old)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Each query that ends inside removes its shuffle files at once; else they stay on disk until
    the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    old = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if old is None else spark.conf.set(key, old)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Filesystem-agnostic existence check (works for local, HDFS, object stores)."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(jpath))
