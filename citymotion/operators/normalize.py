"""Generic normalisation helpers: keep-last dedup (W1, W2), NaN -> NULL, NA strings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: text treated as missing when raw CSV text is read (pandas' default set)
NA_STRINGS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def keep_last(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key: the row that is last by ``order`` (ties: last order column decides).

    Runs as a hash aggregate with ``max_by`` — partial aggregation happens
    before the shuffle, so a key holding a large share of rows costs one row
    per map task, never a whole group in one task.  NULL keys form one group.
    """
    values = [c for c in (values if values is not None else df.columns) if c not in keys]
    picked = F.max_by(F.struct(*[F.col(c) for c in values]), F.struct(*[F.col(c) for c in order]))
    return df.groupBy(*keys).agg(picked.alias("_last")).select(*keys, *[F.col(f"_last.{c}").alias(c) for c in values])


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on ``keys`` with NULL matching NULL (group keys may be NULL)."""
    r = right.select(*[F.col(k).alias(f"_rk{i}") for i, k in enumerate(keys)], *[c for c in right.columns if c not in keys])
    cond = None
    for i, k in enumerate(keys):
        c = left[k].eqNullSafe(r[f"_rk{i}"])
        cond = c if cond is None else cond & c
    out = left.join(r, cond, how)
    return out if how in ("left_semi", "left_anti") else out.drop(*[f"_rk{i}" for i in range(len(keys))])


def keep_last_sparse(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    key_bytes: int = 64,
) -> DataFrame:
    """Keep-last for wide rows where duplicates are rare.

    Only the key columns are aggregated to find keys that occur more than once;
    that (usually small) key set is written to the checkpoint folder and, when
    its exact row count proves it small, broadcast.  Rows of unique keys then
    pass through without any shuffle of the wide rows, and :func:`keep_last`
    runs only on the rows of duplicated keys.  Without the size proof the key
    set is joined with a shuffle join instead.
    """
    from citymotion.session import broadcast_if_bounded, cut_lineage

    keys = list(keys)
    dup = cut_lineage(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c")).where(F.col("_c") > 1).select(*keys))
    n_dup = dup.count()
    if n_dup == 0:
        return df
    dup_b = broadcast_if_bounded(dup, n_dup, key_bytes)
    unique_rows = join_null_safe(df, dup_b, keys, "left_anti")
    repeated = keep_last(join_null_safe(df, dup_b, keys, "left_semi"), keys, order)
    return unique_rows.unionByName(repeated.select(*df.columns))


def nan_to_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Spark treats NaN as a value (avg -> NaN, NaN > 0); the source treats it as missing."""
    cols = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast("double")) for c in cols})


def na_to_null(col: str | F.Column) -> F.Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.when(F.trim(c).isin(*NA_STRINGS), F.lit(None)).otherwise(c)


def to_double(col: str | F.Column) -> F.Column:
    """Lenient numeric coercion: bad text -> NULL, NaN/Inf text -> NULL."""
    v = na_to_null(col).try_cast("double")
    return F.when(F.isnan(v) | (F.abs(v) == float("inf")), F.lit(None)).otherwise(v)
