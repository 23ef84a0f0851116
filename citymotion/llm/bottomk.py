"""Bottom-k sketches of shingle hashes as document fingerprints (operator 10).

A text's sketch is the k smallest distinct XXH64 hashes of its word shingles (A-Z
lower-cased, five words; a shorter text is one shingle, a text without words has none).
Sketches merge by taking the k smallest of their union, so parts of a text or corpus can be
sketched apart.  They estimate resemblance (share of the k smallest of the union that both
hold), containment and the number of distinct shingles.

As a string a sketch is the base64 of its hashes in rising order, 8 bytes each.

``edited_pairs`` compares each text with an edited one whose second half comes from the
next document by id.  Ids are dealt into ranges (boundaries by approximate quantiles,
membership exact); each range is sorted and read in order with one row of lookahead.
The first document of each range also goes to the range before it (of the last: the
first document of all), so no task sees more than its range and a shuffle moves each text
once.  The driver sees boundaries and first ids: one number per range.

Defined results: null text is empty; equal ids are ordered by text; rows with a null id
have an empty next document and are nobody's next; one document is its own next; two empty
sketches resemble each other with 1; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from citymotion.llm.common import small_batches, strings
from citymotion.llm.simhash import shingle_hashes

K = 128
SHINGLE_WORDS = 5
SEED = 42
RANGES_PER_PARTITION = 3
SALTS = 64


def sketch(text: str | None, k: int = K, words: int = SHINGLE_WORDS, seed: int = SEED) -> np.ndarray:
    return smallest(shingle_hashes((text or "").encode("utf-8"), words, seed), k)


def smallest(hashes: np.ndarray, k: int) -> np.ndarray:
    """The k smallest distinct of ``hashes``, rising."""
    if len(hashes) > 8 * k:  # usually enough distinct ones are among the 4 k smallest
        part = np.unique(np.partition(hashes, 4 * k)[: 4 * k])
        if len(part) >= k:
            return part[:k]
    return np.unique(hashes)[:k]


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    return np.union1d(a, b)[:k]


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    union = merge(a, b, k)
    if not len(union):
        return 1.0
    return len(np.intersect1d(union, np.intersect1d(a, b, assume_unique=True), assume_unique=True)) / len(union)


def distinct_count(a: np.ndarray, k: int = K) -> float:
    """Exact below k hashes, else (k - 1) over the k-th hash as a share of the range."""
    return float(len(a)) if len(a) < k else (k - 1) / (float(a[k - 1]) / 2.0**64)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that b has."""
    if not len(a):
        return 1.0
    both = resemblance(a, b, k) * distinct_count(merge(a, b, k), k)
    return min(1.0, both / distinct_count(a, k))


def to_string(a: np.ndarray) -> str:
    return base64.b64encode(a.astype(">u8").tobytes()).decode("ascii")


def from_string(s: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(s), dtype=">u8").astype(np.uint64)


def fingerprint(text: Column, k: int = K, words: int = SHINGLE_WORDS) -> Column:
    """The sketch of each text as a string."""

    @pandas_udf("string")
    def prints(texts: pd.Series) -> pd.Series:
        return pd.Series([to_string(sketch(t, k, words)) for t in texts], dtype=object)

    return prints(text)


def merged(prints: DataFrame, keys: list[str], col: str = "fingerprint", k: int = K) -> DataFrame:
    """One sketch per ``keys`` of all its rows: (keys, ``col``).  Hashes go to ``SALTS`` parts
    of each key first and only each part's k smallest meet, so a hot key is spread."""

    @pandas_udf("array<string>")
    def hashes(column: pd.Series) -> pd.Series:  # hex keeps the unsigned order
        return pd.Series([[f"{int(h):016x}" for h in from_string(s)] if s else [] for s in column], dtype=object)

    @pandas_udf("string")
    def joined(column: pd.Series) -> pd.Series:
        return pd.Series([to_string(np.array([int(h, 16) for h in x], dtype=np.uint64)) for x in column], dtype=object)

    small_batches(prints.sparkSession)
    each = prints.select(*keys, F.explode(hashes(F.col(col))).alias("__h")).distinct()
    each = each.withColumn("__salt", F.pmod(F.xxhash64("__h"), F.lit(SALTS)))
    part = Window.partitionBy(*keys, "__salt").orderBy("__h")
    each = each.withColumn("__n", F.row_number().over(part)).filter(F.col("__n") <= k)
    whole = Window.partitionBy(*keys).orderBy("__h")
    each = each.withColumn("__n", F.row_number().over(whole)).filter(F.col("__n") <= k)
    return each.groupBy(*keys).agg(joined(F.array_sort(F.collect_list("__h"))).alias(col))


EDITED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, contained_edited double, distinct_shingles double"
)


def edited(text: str, following: str) -> str:
    """The last half (rounded down) of ``text`` replaced by as much of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compare(i: int | None, text: str, own: np.ndarray, following: str, other: np.ndarray, k: int, words: int) -> tuple:
    new = edited(text, following)
    changed = sketch(new, k, words)
    return (
        i, len(text), hashlib.sha256(new.encode("utf-8")).hexdigest(), to_string(own), to_string(changed),
        resemblance(own, changed, k), resemblance(own, other, k), containment(changed, own, k), distinct_count(own, k),
    )


def _ranges(docs: DataFrame, id_col: str, n: int) -> tuple[list[int], dict[int, int]]:
    """Boundaries of the id ranges and, for each first id of a range, the range before it."""
    ids = docs.select(F.col(id_col).cast("long").alias("i")).filter("i IS NOT NULL")
    cuts = ids.agg(F.percentile_approx("i", [k / n for k in range(1, n)] or [0.5], 10_000)).first()[0] or []
    cuts = sorted(set(cuts))
    if not cuts:
        return [], {}

    first = ids.groupBy(_range_of(cuts)(F.col("i")).alias("r")).agg(F.min("i").alias("i")).collect()  # a row per range
    order = sorted((r["r"], r["i"]) for r in first)
    return cuts, {i: order[k - 1][0] for k, (_, i) in enumerate(order)}


def _range_of(cuts: list[int]):
    @pandas_udf("int")
    def of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(np.array(cuts, dtype=np.int64), ids.to_numpy(dtype=np.int64), side="right").astype(np.int32))

    return of


def edited_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, words: int = SHINGLE_WORDS) -> DataFrame:
    """``EDITED`` for each row of ``docs``; ids are whole numbers."""
    spark = docs.sparkSession
    small_batches(spark)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts, before = _ranges(docs, id_col, partitions * RANGES_PER_PARTITION)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    spread = (F.monotonically_increasing_id() % (partitions * RANGES_PER_PARTITION)).cast("int") * -1 - 1  # no neighbours: any task will do
    own = F.when(F.col("id").isNotNull(), _range_of(cuts)(F.coalesce("id", F.lit(0)))).otherwise(spread)

    @pandas_udf("int")
    def range_before(ids: pd.Series) -> pd.Series:  # null unless the id is the first of a range
        return ids.map(lambda i: before.get(i) if i == i else None).astype("Int32")

    to = rows.withColumn("__own", own).withColumn("__before", F.when(F.col("id").isNotNull(), range_before(F.coalesce("id", F.lit(0)))))
    sent = F.when(F.col("__before").isNull(), F.array("__own")).otherwise(F.array("__own", "__before"))
    dealt = to.select("id", "text", F.posexplode(sent).alias("extra", "range")).repartition(partitions, "range")
    ordered = dealt.sortWithinPartitions("range", "extra", "id", "text").select("range", "extra", "id", "text")
    names = [x.strip().split(" ")[0] for x in EDITED.split(",")]
    types = [{"long": pa.int64(), "string": pa.string(), "double": pa.float64()}[x.strip().split(" ")[1]] for x in EDITED.split(",")]
    schema = pa.schema(list(zip(names, types)))

    def batch(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*found), types)], schema=schema)

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = sketch("", k, words)
        last = None  # range, extra, id, text, sketch of the row before
        for b in batches:
            found = []
            for r, extra, i, text in zip(b["range"].to_pylist(), b["extra"].to_pylist(), b["id"].to_pylist(), strings(b["text"])):
                if last is not None and last[1] and extra and last[0] == r:
                    continue  # further ties of a first id
                own = sketch(text, k, words)
                if last is not None and not last[1]:
                    alone = last[0] != r or last[0] < 0
                    found.append(_compare(*last[2:], "" if alone else text, none if alone else own, k, words))
                last = (r, extra, i, text, own)
            if found:
                yield batch(found)
        if last is not None and not last[1]:
            yield batch([_compare(*last[2:], "", none, k, words)])

    return ordered.mapInArrow(compared, EDITED).withColumnRenamed("doc_id", id_col)
