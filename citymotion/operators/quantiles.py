"""Exact grouped quantiles without gathering a group.

The result is that of linear interpolation between the order statistics at ``q * (n - 1)``
(as pandas or Spark's ``percentile``), in two aggregation passes:

1. per group: ``n`` and a ``percentile_approx`` sketch (rank error ``n / accuracy``), which
   brackets every wanted rank with ``[lo, hi]``; the bracket is widened by a power of two
   of at least ``1 / n``, the step between neighbouring ranks;
2. per group and quantile: counts of the distinct values inside the bracket and one count
   of all rows below it.  Equal values are one row after map-side aggregation, so ties
   cost nothing; the wanted order statistics are read from running totals over the
   sorted distinct values (at most ``6 n / accuracy`` of a group, streamed, never an array).

Without keys there is one group, so nothing may be ordered or joined on its key: the bracket
is a literal, and each wanted order statistic is found by range histograms over the
distinct values inside it.  A pass counts 1,024 equal ranges per rank and goes on in the one that
holds the rank, until that has one value; two or three passes do, and no row count of a
task depends on how many values there are.

The sketch's bound holds for every input; a bracket that missed would fail the job.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citymotion.operators.normalize import join_null_safe
from citymotion.session import cut_lineage

DEFAULT_ACCURACY = 100_000
STEPS = 18  # 2^-17 is below the sketch's own error
BAND_MARGIN = 3.0  # in units of the sketch's rank error


RANGES = 1024  # of a histogram


def _name(q: float) -> str:
    return f"q{str(q).replace('.', '_')}"


def _in_pass(counts: DataFrame, wanted: dict[tuple[int, int], tuple[int, float, float]]) -> dict[tuple[int, int], tuple[int, float, float]]:
    """One histogram for each (quantile, rank) with its (rows below, least, greatest value): the
    same of the range that holds the rank."""

    def target(k: int, rank: int, lo: float, hi: float) -> F.Column:
        ends = math.isinf(lo) or math.isinf(hi)  # then finite values are one range
        scale = 0.5 if math.isinf(hi - lo) else 1.0  # keeps the width finite
        width = 1.0 if ends else hi * scale - lo * scale
        named = {"k": k, "lo": lo, "hi": hi, "ends": ends, "scale": scale, "width": width}
        return F.struct(F.lit(rank).cast("long").alias("rank"), *[F.lit(v).alias(n) for n, v in named.items()])

    targets = F.array(*[target(k, rank, lo, hi) for (k, rank), (_, lo, hi) in wanted.items()])
    t, x = F.col("t"), F.col("_x")
    part = F.floor((x * t["scale"] - t["lo"] * t["scale"]) / t["width"] * RANGES)
    part = F.when(t["ends"], F.when(x == float("-inf"), -1).when(x == float("inf"), 1).otherwise(0)).otherwise(F.least(part, F.lit(RANGES - 1)))
    rows = counts.withColumn("t", F.explode(targets)).where((F.col("_k") == t["k"]) & x.between(t["lo"], t["hi"]))
    ranges = rows.groupBy(t["k"].alias("k"), t["rank"].alias("rank"), part.alias("part")).agg(F.sum("_c").alias("n"), F.min("_x").alias("lo"), F.max("_x").alias("hi"))
    below = {at: w[0] for at, w in wanted.items()}
    found: dict[tuple[int, int], tuple[int, float, float]] = {}
    for r in sorted(ranges.collect(), key=lambda r: r.part):  # RANGES rows a rank at most
        at = (r.k, r.rank)
        if at not in found:
            if below[at] <= r.rank < below[at] + r.n:
                found[at] = (below[at], r.lo, r.hi)
            below[at] += r.n
    if len(found) < len(wanted):
        raise RuntimeError("a quantile bracket missed its rank")
    return found


def _order_statistics(near: DataFrame, ranks: Sequence[set[int]]) -> dict[tuple[int, int], float]:
    """The values at ``ranks`` of each quantile; ``near`` has ``_k`` and ``_x``, NULL below the bracket."""
    counts = cut_lineage(near.groupBy("_k", "_x").agg(F.count(F.lit(1)).alias("_c")))
    spans = counts.groupBy("_k").agg(F.coalesce(F.sum(F.when(F.col("_x").isNull(), F.col("_c"))), F.lit(0)).alias("n"), F.min("_x").alias("lo"), F.max("_x").alias("hi"))
    open_ = {(r["_k"], rank): (r.n, r.lo, r.hi) for r in spans.collect() for rank in ranks[r["_k"]]}
    if len(open_) < sum(map(len, ranks)) or any(lo is None for _, lo, _ in open_.values()):
        raise RuntimeError("a quantile bracket missed its rank")
    values: dict[tuple[int, int], float] = {}
    while True:
        values |= {at: lo for at, (_, lo, hi) in open_.items() if lo == hi}
        open_ = {at: w for at, w in open_.items() if at not in values}
        if not open_:
            return values
        open_ = _in_pass(counts, open_)


def _global_quantiles(values: DataFrame, n: int, edges: Sequence[tuple[float, float]], qs: Sequence[float]) -> list[float | None]:
    """The quantiles of ``_v`` over all ``n`` rows, given a bracket for each."""
    if not n:
        return [None] * len(qs)
    at = [(math.floor(q * (n - 1)), q * (n - 1) - math.floor(q * (n - 1))) for q in qs]
    pairs = [(i, min(i + 1, n - 1)) for i, _ in at]
    brackets = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(lo).alias("lo"), F.lit(hi).alias("hi")) for k, (lo, hi) in enumerate(edges)])
    near = values.select("_v", F.explode(brackets).alias("_q")).where(F.col("_v") <= F.col("_q.hi"))
    found = _order_statistics(near.select(F.col("_q.k").alias("_k"), F.when(F.col("_v") >= F.col("_q.lo"), F.col("_v")).alias("_x")), [set(p) for p in pairs])
    out = []
    for k, ((i, j), (_, f)) in enumerate(zip(pairs, at)):
        a, z = found[k, i], found[k, j]
        out.append(a if f == 0 or a == z else a + f * (z - a))
    return out


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    qs: Sequence[float],
    *,
    accuracy: int = DEFAULT_ACCURACY,
    names: Sequence[str] | None = None,
    count_name: str | None = None,
    extra_aggs: dict[str, F.Column] | None = None,
) -> DataFrame:
    """``keys`` + one column per quantile; NULL / NaN values are skipped and a
    group without values gets NULL.  ``keys`` may be empty (global quantiles).
    ``count_name`` adds the number of values used; ``extra_aggs`` (name -> aggregate over
    the input rows) are computed in the first pass and carried to the output."""
    user_keys = list(keys)
    keys = user_keys
    names = list(names) if names is not None else [_name(q) for q in qs]
    extra = dict(extra_aggs or {})
    eps = BAND_MARGIN / accuracy

    def clip(p: float) -> float:
        return min(1.0, max(0.0, p))

    steps = [2.0**-j for j in range(STEPS)]
    probs = sorted({clip(q + s * (eps + d)) for q in qs for s in (-1, 1) for d in steps})
    idx = {p: i for i, p in enumerate(probs)}
    raw = F.col(value).cast("double")
    rows = df.withColumn("_v", F.when(~F.isnan(raw), raw))
    sketch = rows.groupBy(*keys).agg(
        F.count("_v").alias("_n"), F.percentile_approx("_v", probs, accuracy).alias("_b"), *[a.alias(n) for n, a in extra.items()]
    )
    # each value with its quantiles' brackets: inside ones keep the value, all below count as one
    j = F.least(F.floor(F.log2(F.greatest(F.col("_n"), F.lit(1)))), F.lit(STEPS - 1)).cast("int")

    def edge(q: float, sign: int) -> F.Column:
        places = F.array(*[F.lit(idx[clip(q + sign * (eps + d))]) for d in steps])
        return F.get(F.col("_b"), F.get(places, j))

    brackets = F.array(*[F.struct(F.lit(k).alias("k"), edge(q, -1).alias("lo"), edge(q, 1).alias("hi")) for k, q in enumerate(qs)])
    sketch = cut_lineage(sketch.withColumn("_q", brackets).drop("_b"))  # one row per group
    values = rows.where(F.col("_v").isNotNull()).select(*keys, "_v")
    if not user_keys:
        one = sketch.select("_n", "_q").first()  # None only for an empty table
        found = _global_quantiles(values, one["_n"] if one else 0, [(b["lo"], b["hi"]) for b in one["_q"]] if one else [], qs)
        out = sketch.select("_n", *[F.lit(v).cast("double").alias(c) for c, v in zip(names, found)], *extra)
        return out.withColumnRenamed("_n", count_name) if count_name else out.drop("_n")
    near = join_null_safe(values, sketch.select(*keys, "_q"), keys, "inner").select(*keys, "_v", F.explode("_q").alias("_q"))
    near = near.where(F.col("_v") <= F.col("_q.hi")).select(*keys, F.col("_q.k").alias("_k"), F.when(F.col("_v") >= F.col("_q.lo"), F.col("_v")).alias("_x"))
    counts = near.groupBy(*keys, "_k", "_x").agg(F.count(F.lit(1)).alias("_c"))
    order = Window.partitionBy(*keys, "_k").orderBy(F.col("_x").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = counts.withColumn("_to", F.sum("_c").over(order))

    # the values at ranks i and i + 1
    rank = F.element_at(F.array(*[F.lit(float(q)) for q in qs]), F.col("_k") + 1) * (F.col("_n") - 1)
    i = F.floor(rank).cast("long")
    sized = join_null_safe(running, sketch.select(*keys, "_n"), keys, "inner").withColumns({"_i": i, "_f": rank - i})
    at = sized.groupBy(*keys, "_k").agg(
        F.min(F.when(F.col("_to") > F.col("_i"), F.col("_x"))).alias("_a"),
        F.min(F.when(F.col("_to") > F.least(F.col("_i") + 1, F.col("_n") - 1), F.col("_x"))).alias("_z"),
        F.max(F.when(F.col("_x").isNull(), F.col("_to") > F.col("_i")).otherwise(False)).alias("_low"),
        F.first("_f").alias("_f"),
    )
    missed = F.col("_low") | F.col("_a").isNull() | F.col("_z").isNull()
    found = F.when(missed, F.raise_error(F.lit("a quantile bracket missed its rank")).cast("double"))
    # exact at whole ranks also for infinite values
    found = found.when((F.col("_f") == 0) | (F.col("_a") == F.col("_z")), F.col("_a")).otherwise(F.col("_a") + F.col("_f") * (F.col("_z") - F.col("_a")))
    per = at.select(*keys, "_k", found.alias("_value")).groupBy(*keys).agg(*[F.max(F.when(F.col("_k") == k, F.col("_value"))).alias(n) for k, n in enumerate(names)])
    out = join_null_safe(sketch.drop("_q"), per, keys, "left").select(*keys, "_n", *names, *extra)
    return out.withColumnRenamed("_n", count_name) if count_name else out.drop("_n")
