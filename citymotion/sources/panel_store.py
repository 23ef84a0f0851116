"""A stored panel clustered by date, and reads of a period from one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citymotion.operators.frames import as_day
from citymotion.sources.sinks import write_table

CLUSTER_ORDER = ("date", "ts_utc", "route_id")
MONTH = "panel_month"  # yyyymm of ``date``; a panel's ``year`` can come from a file name instead


def _month_source(types: dict[str, T.DataType]) -> str | None:
    """The column whose day a row is filed under: a ``date`` of that type, else ``ts_local``
    where there is no ``date``."""
    if "date" in types:
        return "date" if isinstance(types["date"], T.DateType) else None
    return "ts_local" if isinstance(types.get("ts_local"), T.TimestampNTZType) else None


def _types(df: DataFrame) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in df.schema.fields}


def write_panel(panel: DataFrame, path: str) -> str:
    """Write ``panel`` partitioned by the month of its local day, its rows dealt into ranges of (date,
    instant, corridor) and sorted in each file, so that a file and a row group hold few days and
    their statistics name them.  A day or corridor with a third of all rows is many ranges.
    Where the day is text or a timestamp there are no months, only the order."""
    keys = [c for c in CLUSTER_ORDER if c in panel.columns]
    day = _month_source(_types(panel))
    if day is None:
        return write_table(panel, path, order_by=keys)
    month = (F.year(day) * 100 + F.month(day)).cast("int")
    return write_table(panel.withColumn(MONTH, month), path, partition_by=[MONTH], order_by=[MONTH, *keys])


def read_period(spark: SparkSession, path: str, columns: Sequence[str], start=None, end=None, schema: T.StructType | None = None) -> DataFrame:
    """``columns`` of the rows of a stored panel whose local date lies in [start, end] (None: open).

    On a ``date`` of that type the bounds reach the scan, which skips row groups by them; a ``date``
    kept as text or as a timestamp is read as its day, and without ``date`` the day is that of
    ``ts_local``: the scan has no statistics for these.  Months of ``write_panel`` outside the
    bounds are not opened.  Rows without a
    date are in no bounded period.  Columns that the panel lacks raise KeyError, an end before the start
    ValueError; a period without rows gives none.  A folder written from no rows names no columns, so
    it needs ``schema`` (that of the panel as written).
    """
    lo, hi = (as_day(v) if v is not None else None for v in (start, end))
    if lo is not None and hi is not None and hi < lo:
        raise ValueError(f"end date {hi} is before start date {lo}")
    stored = (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)
    types = _types(stored)
    derived = "date" not in types and "ts_local" in types
    missing = [c for c in columns if c not in types and not (c == "date" and derived)]
    if missing or not ({"date", "ts_local"} & set(types)):
        raise KeyError(f"the stored panel lacks {missing or ['date', 'ts_local']}")
    if derived:
        day = F.to_date("ts_local")
    elif isinstance(types["date"], T.DateType):
        day = F.col("date")
    else:
        day = F.try_to_timestamp(F.col("date").cast("string")).cast("date")
    kept, by_month = stored, MONTH in types and _month_source(types) is not None
    for bound, keeps in ((lo, Column.__ge__), (hi, Column.__le__)):
        if bound is not None:
            kept = kept.where(keeps(day, F.lit(bound)))
            if by_month:
                kept = kept.where(keeps(F.col(MONTH), F.lit(bound.year * 100 + bound.month)))
    return kept.select(*[day.alias("date") if c == "date" else F.col(c) for c in columns])
