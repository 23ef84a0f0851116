"""Civic calendar: interval -> day features (S8 checks, J6, A11, A12).

Calendar entries are rows ``(id, name, kind, start_date, end_date, pos)``;
``pos`` is config order and fixes the order of the name lists.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citymotion.operators.intervals import day_number
from citymotion.session import cut_lineage
from citymotion.sources.common import ship_package

# fixed values: calendar kinds and the groups the day features use
HOLIDAY_KINDS = ("public_holiday", "civic_holiday")
MEGA_KINDS = ("mega_event", "parade", "shopping_peak", "school_break")
FLAG_KINDS = {
    "is_public_holiday": ("public_holiday",),
    "is_civic_holiday": ("civic_holiday",),
    "is_holiday": HOLIDAY_KINDS,
    "is_school_break": ("school_break",),
    "is_mega_event": ("mega_event",),
    "is_parade": ("parade",),
    "is_shopping_peak": ("shopping_peak",),
}

CIVIC_DAY_COLUMNS = [
    "date",
    *FLAG_KINDS,
    "n_civic_events",
    "holiday_names",
    "mega_event_names",
    "event_ids",
    "event_kinds",
]


def prepare_calendar(entries: DataFrame) -> DataFrame:
    """Apply the entry defaults: end defaults to start, scope to citywide.

    Rows with ``end_date < start_date`` are invalid; see :func:`invalid_entries`.
    """
    out = entries.withColumn("end_date", F.coalesce(F.col("end_date"), F.col("start_date")))
    if "scope" in entries.columns:
        out = out.withColumn("scope", F.coalesce(F.col("scope"), F.lit("citywide")))
    else:
        out = out.withColumn("scope", F.lit("citywide"))
    return out


def invalid_entries(entries: DataFrame) -> DataFrame:
    """Entries whose range is reversed; a calendar with any is refused."""
    return prepare_calendar(entries).where(F.col("end_date") < F.col("start_date"))


def assert_valid(entries: DataFrame) -> None:
    bad = invalid_entries(entries).select("id").limit(5).collect()
    if bad:
        raise ValueError(f"calendar entries with end_date before start_date: {[r.id for r in bad]}")


# Entries of one block of the config order, whose day texts one task builds at a time.
BLOCK_ENTRIES = 8192
DAYS_PER_TASK = 128  # whose blocks' texts are put together
PAIRS = 1 << 20  # (entry, day) pairs that a task holds at a time, beside one day's


def _block(entries: DataFrame, per_block: int) -> F.Column:
    """The block of an entry: ranges of ``pos`` with about ``per_block`` entries each.  Their
    bounds are quantiles of ``pos``; entries of one ``pos`` are in one block.  An entry is compared
    with all bounds, so this is for short calendars; :func:`day_features` counts blocks off."""
    n = entries.count()
    blocks = -(-n // per_block)
    if blocks <= 1:
        return F.lit(0)
    cuts = entries.agg(F.percentile_approx("pos", [k / blocks for k in range(1, blocks)], max(10_000, 10 * blocks))).first()[0]
    bounds = F.array(*[F.lit(c) for c in sorted(set(cuts or []))])
    return F.size(F.filter(bounds, lambda c: c < F.col("pos")))


def in_order(entries: DataFrame) -> DataFrame:
    """``entries`` in the config order with their place ``_at``.  They are dealt into ranges, sorted
    there and counted off, so an entry's cost does not grow with their number."""
    order = ["pos", "name", "id", "kind"]
    dealt = entries.repartitionByRange(*order).sortWithinPartitions(*order)
    return cut_lineage(dealt.withColumn("_at", F.monotonically_increasing_id()))  # range in the upper bits


BLOCK_DAYS = "day int, _at long, n long, kinds array<string>, holiday_names string, mega_event_names string, event_ids string"


def _block_days(block: pa.RecordBatch, days: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row per day of ``days`` (ascending) on which an entry of ``block`` is active: the texts
    of its entries in order; NULL where there are none, so that they add no separator."""
    c = {name: block.column(name) for name in block.schema.names}
    first, last = (np.searchsorted(days, c[k].to_numpy(zero_copy_only=False), side) for k, side in (("d0", "left"), ("d1", "right")))
    change = np.zeros(len(days) + 1, np.int64)
    np.add.at(change, first, 1)
    np.add.at(change, last, -1)
    upto = np.cumsum(np.cumsum(change[:-1]))  # pairs up to each day
    names, ids, kinds = (np.array(c[k].to_pylist(), object) for k in ("name", "id", "kind"))
    codes = {k: i for i, k in enumerate(sorted({k for k in kinds if k is not None}))}
    code, labels = np.array([codes.get(k, -1) for k in kinds]), list(codes)
    wanted = [(texts, np.array([t is not None and (of is None or k in of) for t, k in zip(texts, kinds)], bool)) for texts, of in ((names, HOLIDAY_KINDS), (names, MEGA_KINDS), (ids, None))]
    cuts = np.unique(np.searchsorted(upto, np.arange(0, int(upto[-1]) if len(upto) else 0, PAIRS), "right"))
    for lo, hi in zip(cuts, [*cuts[1:], len(days)]):
        a, z = np.maximum(first, lo), np.minimum(last, hi)
        n = np.maximum(z - a, 0)
        entry = np.repeat(np.arange(len(n)), n)
        day = np.arange(len(entry)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(a, n)
        by_day = np.argsort(day, kind="stable")
        entry, day = entry[by_day], day[by_day]
        active, starts, counts = np.unique(day, return_index=True, return_counts=True)
        columns = []
        for texts, chosen in wanted:
            kept = chosen[entry]
            listed, at = texts[entry[kept]].tolist(), np.concatenate([[0], np.cumsum(kept)])
            columns.append(["|".join(listed[i:j]) if j > i else None for i, j in zip(at[starts].tolist(), at[starts + counts].tolist())])
        pairs = np.unique(day[code[entry] >= 0] * max(1, len(labels)) + code[entry[code[entry] >= 0]])
        ends = np.searchsorted(pairs, np.stack([active, active + 1]) * max(1, len(labels)))
        held = [[labels[k % len(labels)] for k in pairs[i:j].tolist()] for i, j in zip(*ends.tolist())]
        at = pa.array(np.full(len(active), c["_at"][0].as_py()), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(days[active], pa.int32()), at, pa.array(counts, pa.int64()), pa.array(held, pa.list_(pa.string())), *[pa.array(t, pa.string()) for t in columns]],
            ["day", "_at", "n", "kinds", "holiday_names", "mega_event_names", "event_ids"],
        )


def day_features(entries: DataFrame, days: DataFrame | None = None, *, per_block: int = BLOCK_ENTRIES) -> DataFrame:
    """Features for each day that has at least one active entry.

    Ordered lists are built in two levels: inside blocks of the config order, where entries
    meet their days (J6) and a day's texts are joined as they come, and then over the blocks of a
    day, whose texts are joined in order; so what is shuffled and sorted is texts of blocks, not
    (entry, day) pairs.  A day with a third of all entries is as many pieces as there are
    blocks, and a task holds a bounded number of pairs, whatever the intervals' lengths.
    ``days`` (``date``) limits the days, by default all from the first start to the last end; as
    calendar days they are sent to the tasks as an array.
    """
    e = prepare_calendar(entries).where(F.col("start_date").isNotNull() & (F.col("end_date") >= F.col("start_date")))
    if days is None:
        days = e.agg(F.min("start_date").alias("lo"), F.max("end_date").alias("hi")).where("lo IS NOT NULL").select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("date"))
    listed = days.where(F.col("date").isNotNull()).select(F.datediff("date", F.lit("1970-01-01")).alias("d")).distinct().collect()
    numbers = np.array(sorted(r.d for r in listed), np.int64)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, per_block):
                yield from _block_days(batch.slice(i, per_block), numbers)

    ship_package(entries.sparkSession)
    number = [day_number(F.col(c)).alias(n) for c, n in (("start_date", "d0"), ("end_date", "d1"))]
    parts = in_order(e.select("pos", "name", "id", "kind", *number)).select("name", "id", "kind", "d0", "d1", "_at").mapInArrow(blocks, BLOCK_DAYS)
    lists = ("holiday_names", "mega_event_names", "event_ids")
    # their number is fixed: equal texts compress so well that merging by bytes would make few, large tasks
    out = parts.repartition(max(1, -(-len(numbers) // DAYS_PER_TASK)), "day").groupBy("day").agg(
        F.sum("n").alias("n_civic_events"), F.array_distinct(F.flatten(F.collect_list("kinds"))).alias("_kinds"), F.array_sort(F.collect_list(F.struct("_at", *lists))).alias("_texts")
    )
    flags = [F.when(F.size("_kinds") > 0, F.arrays_overlap("_kinds", F.array(*[F.lit(k) for k in kinds]))).alias(name) for name, kinds in FLAG_KINDS.items()]
    return out.select(
        F.date_add(F.lit("1970-01-01").cast("date"), F.col("day")).alias("date"),
        *flags,
        "n_civic_events",
        *[F.array_join(F.col("_texts")[name], "|").alias(name) for name in lists],  # NULL texts are left out
        F.array_join(F.array_sort("_kinds"), "|").alias("event_kinds"),
    )


def civic_days(
    entries: DataFrame,
    *,
    start_date: date | None = None,
    end_date: date | None = None,
) -> DataFrame:
    """Dense day table: one row per day of the range, empty days False / "" / 0.

    Default range: 1 Jan of the first entry's year to 31 Dec of the last entry's year.
    The spine has one row per calendar day, so its size is bounded by the range.
    """
    e = prepare_calendar(entries)
    bounds = e.agg(
        F.make_date(F.min(F.year("start_date")), F.lit(1), F.lit(1)).alias("lo"),
        F.make_date(F.max(F.year("end_date")), F.lit(12), F.lit(31)).alias("hi"),
    )
    if start_date is not None:
        bounds = bounds.withColumn("lo", F.lit(start_date))
    if end_date is not None:
        bounds = bounds.withColumn("hi", F.lit(end_date))
    spine = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("date"))
    feats = day_features(e, spine)
    out = spine.join(feats, "date", "left")
    fills = {name: F.coalesce(F.col(name), F.lit(False)) for name in FLAG_KINDS}
    fills["n_civic_events"] = F.coalesce(F.col("n_civic_events"), F.lit(0)).cast("long")
    for name in ("holiday_names", "mega_event_names", "event_ids", "event_kinds"):
        fills[name] = F.coalesce(F.col(name), F.lit(""))
    return out.withColumns(fills).select(*CIVIC_DAY_COLUMNS)


def features_for_dates(entries: DataFrame, dates: DataFrame, date_col: str = "date") -> DataFrame:
    """Day features for arbitrary dates / timestamps (P29): uses the calendar date as given."""
    d = dates.withColumn("_day", F.to_date(F.col(date_col)))
    feats = day_features(entries, d.select(F.col("_day").alias("date")).distinct())
    out = d.join(feats.withColumnRenamed("date", "_day"), "_day", "left").drop("_day")
    fills = {name: F.coalesce(F.col(name), F.lit(False)) for name in FLAG_KINDS}
    fills["n_civic_events"] = F.coalesce(F.col("n_civic_events"), F.lit(0)).cast("long")
    for name in ("holiday_names", "mega_event_names", "event_ids", "event_kinds"):
        fills[name] = F.coalesce(F.col(name), F.lit(""))
    return out.withColumns(fills)
