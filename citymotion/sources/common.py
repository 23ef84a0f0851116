"""Shared source helpers: file listing with pruning, stable ordinals, file opening
inside tasks."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def list_files(spark: SparkSession, folder: str, glob: str = "*", recursive: bool = False) -> DataFrame:
    """``path, length, modificationTime`` of matching files, sorted by path.

    Uses the ``binaryFile`` source without selecting ``content``, so no file
    body is read; this is a distributed listing.
    """
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.load(folder).select("path", "length", "modificationTime")


def with_ordinal(df: DataFrame, col: str = "ordinal", unit: list[str] | None = None) -> DataFrame:
    """0-based position of each row in scan order (file order for a single file).

    The generated id holds the partition above its low 33 bits and the place in it below;
    per-partition counts (one row per partition) give each partition its offset.  No
    step moves or sorts the data.  ``unit`` names columns (file, then block start) whose rows
    one task reads together and whose order is the order wanted, however Spark packs
    files into partitions; counts and offsets are then per unit.
    """
    d = df.withColumn("_mid", F.monotonically_increasing_id())
    if unit is None:
        d, unit, drop = d.withColumn("_pid", F.shiftrightunsigned("_mid", 33)), ["_pid"], ["_pid"]
    else:
        drop = []
    counts = d.groupBy(*unit).agg(F.count(F.lit(1)).alias("_cnt"), F.min("_mid").alias("_first"))
    before = Window.orderBy(*unit).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*unit, "_first", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"))
    placed = d.join(F.broadcast(offsets), unit).withColumn(col, (F.col("_off") + F.col("_mid") - F.col("_first")).cast("long"))
    return placed.drop(*drop, "_mid", "_first", "_off")


def paths_of(files: DataFrame) -> list[str]:
    """The paths of a file listing, in order: one string per input file."""
    return sorted(r["path"] for r in files.select("path").collect())


def _filesystem(path: str):
    import pyarrow.fs as pafs

    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[len("file:"):].lstrip("/")
    if "://" not in path:
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(path)


def open_input(path: str):
    """Seekable binary handle for a local / HDFS / object-store path (inside tasks)."""
    fs, inner = _filesystem(path)
    return fs.open_input_file(inner)


def open_output(path: str):
    """Binary sink at such a path; an earlier file is replaced."""
    fs, inner = _filesystem(path)
    fs.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    return fs.open_output_stream(inner)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's sources to the Python workers, as ``--py-files`` would."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="citymotion-src-"), "citymotion_src.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)
