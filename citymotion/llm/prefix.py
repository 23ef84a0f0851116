"""Global prefix sums over an ordered table: per-partition totals, then offsets.

The rows are dealt into ranges of their sort keys and sorted inside each; one pass numbers
the rows of a range and sums their sizes, and writes them.  The totals of the ranges (one
row a partition) give each range's offsets.  Rows with equal keys are told apart by their
place in the input, so a key with a third of all rows is spread over many ranges.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from citymotion.llm.common import ship_package, written

RANGE, ROW, BEFORE = "__range", "__row", "__before"


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, rows, total = TaskContext.get().partitionId(), 0, 0
    for b in batches:
        sizes = b.column("__size").to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(sizes) + total
        more = [np.full(len(sizes), part, np.int64), np.arange(rows, rows + len(sizes)), ends - sizes]
        yield pa.RecordBatch.from_arrays(b.columns + [pa.array(x) for x in more], names=[*b.schema.names, RANGE, ROW, BEFORE])
        if len(sizes):
            rows, total = rows + len(sizes), int(ends[-1])


def with_prefix(rows: DataFrame, keys: list[Column], size: Column) -> tuple[DataFrame, int, int]:
    """``rows`` with ``__size``, ``__row`` (0-based place in the order of ``keys``) and ``__before``
    (sum of the sizes before), the number of rows and the sum of all sizes.

    ``rows`` is read twice (range boundaries are sampled), so it should be a written table."""
    spark = rows.sparkSession
    ship_package(spark)
    tied = rows.withColumns({"__size": size.cast("long"), "__tie": F.monotonically_increasing_id()})
    order = [*keys, F.col("__tie")]
    ranged = tied.repartitionByRange(*order).sortWithinPartitions(*order).drop("__tie")
    schema = StructType(ranged.schema.fields + [StructField(c, LongType()) for c in (RANGE, ROW, BEFORE)])
    summed = written(ranged.mapInArrow(_summed, schema), "prefix")
    totals = summed.groupBy(RANGE).agg(F.count("*").alias("n"), F.sum("__size").alias("s")).collect()  # a row per range
    offsets, n, total = [], 0, 0
    for r in sorted(totals, key=lambda r: r[RANGE]):
        offsets.append((r[RANGE], n, total))
        n, total = n + r["n"], total + r["s"]
    offset = spark.createDataFrame(offsets, f"{RANGE} long, __rows_to long, __sum_to long")
    placed = summed.join(F.broadcast(offset), RANGE).withColumns({ROW: F.col(ROW) + F.col("__rows_to"), BEFORE: F.col(BEFORE) + F.col("__sum_to")})
    return placed.drop(RANGE, "__rows_to", "__sum_to"), n, total
