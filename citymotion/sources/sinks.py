"""Sinks: Parquet tables (K1) and one-row QA JSON beside them (K2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from citymotion.session import table_bytes

RANGE_BYTES = 256 * 1024 * 1024  # of values, as a task sorts them


def write_table(df: DataFrame, path: str, *, partition_by: Sequence[str] | None = None, sort_within: Sequence[str] | None = None, order_by: Sequence[str] | None = None) -> str:
    """Overwrite a Parquet table directory; optional partition columns and an
    in-partition sort.  ``order_by`` deals the rows into ranges first, so the files in name
    order are sorted as a whole (O1, O2) and no task writes alone.  Ranges are merged by their
    compressed bytes, which says little where long texts repeat, so a table whose values are
    measured to need more than one range gets their number fixed."""
    if order_by:
        ranges = -(-table_bytes(df)[1] // RANGE_BYTES)
        df, sort_within = df.repartitionByRange(*([ranges] if ranges > 1 else []), *order_by), order_by
    out = df.sortWithinPartitions(*sort_within) if sort_within else df
    writer = out.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def write_qa(qa: DataFrame, path: str) -> str:
    """A one-row QA aggregate as a JSON file (one partition: the frame has one row)."""
    qa.coalesce(1).write.mode("overwrite").json(path)
    return path
