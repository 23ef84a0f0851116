"""SimHash near-duplicates by multi-index hashing (operator 9).

Fingerprint: XXH64 (seed 42) of each shingle of ``shingle_words`` lower-cased words, repeats
included; a bit is 1 if it is set in over half the hashes.

Search: the 64 bits are cut into ``SEGMENTS`` segments.  If two fingerprints differ in at
most r bits, some segment i differs in at most r_i bits whenever sum(r_i + 1) > r, so
radii with sum(r_i) = r - SEGMENTS + 1 suffice.  Each distinct fingerprint enumerates the
Hamming ball of radius r_i around its i-th segment, fetches the fingerprints that the
segment's table holds under these values, and the complete distance is verified.

Crowded table entries (more than ``CROWDED`` fingerprints under one value, as families of
edited copies make) are not expanded into pairs.  Their fingerprints, and those that probe
them, are linked over midpoints instead: every fingerprint is put under each 64-bit value
within r/2 bits of it (r is even), and those under one value are linked to its smallest.
Two fingerprints within r bits share such a value; the links so made are verified like
all others, and two that are linked to the smallest are linked to each other through it,
so no link between groups is lost and the work stays linear.

Defined results: null and empty texts have fingerprint zero and are linked like any other;
rows with a null id keep a fingerprint and get a null component; each text of a repeated
id is in its own text's group (groups with one smallest id share its component_id, but
``keep_first`` tells them apart); an empty table gives an empty result.  Groups of equal
fingerprints are collapsed before the search, so a group of copies with a third of all
rows is one entry.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from citymotion.llm.common import small_batches, written
from citymotion.llm.components import components

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
SEGMENTS = 2
CROWDED = 64


def shingle_hashes(raw: bytes, k: int, seed: int = SEED) -> np.ndarray:
    """XXH64 of the k-word shingles of ``raw`` (UTF-8), A-Z lower-cased, as uint64."""
    from xxhash import xxh64_intdigest

    words = raw.lower().split()
    n = len(words)
    if not n:
        return np.empty(0, dtype=np.uint64)
    joined = b" ".join(words)
    if n <= k:
        return np.array([xxh64_intdigest(joined, seed)], dtype=np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=n) + 1) - 1
    starts = np.concatenate(([0], ends[: n - k] + 1)).tolist()
    return np.fromiter((xxh64_intdigest(joined[a:b], seed) for a, b in zip(starts, ends[k - 1 :].tolist())), dtype=np.uint64, count=n - k + 1)


def fingerprint(raw: bytes, k: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """The 64-bit SimHash of one text."""
    h = shingle_hashes(raw, k, seed)
    if not len(h):
        return 0
    ones = np.zeros(64, dtype=np.int64)
    for part in range(0, len(h), 1 << 14):  # bounded memory for very long texts
        bits = np.unpackbits(h[part : part + (1 << 14)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(h)).tobytes(), "big")


def simhash(text: Column, shingle_words: int = SHINGLE_WORDS, seed: int = SEED) -> Column:
    """The fingerprint as a signed long with the same 64 bits."""

    @pandas_udf("long")
    def prints(texts: pd.Series) -> pd.Series:
        values = [fingerprint((t or "").encode("utf-8"), shingle_words, seed) for t in texts]
        return pd.Series(np.array(values, dtype=np.uint64).view(np.int64))

    return prints(text)


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _ball(bits: list[int], radius: int) -> list[int]:
    """Masks with up to ``radius`` of ``bits`` set."""
    return [_signed(sum(1 << b for b in c)) for r in range(radius + 1) for c in combinations(bits, r)]


def _segments(max_bits: int, segments: int) -> list[tuple[int, list[int]]]:
    """(mask of the segment, masks of its ball) for each segment that has to be probed."""
    width = 64 // segments
    total = max_bits - segments + 1
    radii = [total // segments + (i < total % segments) for i in range(segments)] if total >= 0 else [0] * (max_bits + 1)
    out = []
    for i, r in enumerate(radii):
        bits = list(range(i * width, 64 if i == segments - 1 else (i + 1) * width))
        out.append((_signed(sum(1 << b for b in bits)), _ball(bits, r)))
    return out


def _xored(value: Column, masks: list[int]) -> Column:
    return F.transform(F.array(*[F.lit(m).cast("long") for m in masks]), lambda m: value.bitwiseXOR(m))


def near_links(prints: DataFrame, max_bits: int = MAX_BITS, segments: int = SEGMENTS, crowded: int = CROWDED) -> DataFrame:
    """Links (a, b), a < b, between the distinct longs in ``prints.fp`` that connect
    exactly the fingerprints within ``max_bits`` bits of one another."""
    if max_bits % 2:  # a shared midpoint would allow one bit too many
        raise ValueError("max_bits has to be even")
    tables, probes = None, None
    for i, (mask, ball) in enumerate(_segments(max_bits, segments)):
        seg = F.col("fp").bitwiseAND(F.lit(mask).cast("long"))
        t = prints.select(F.lit(i).alias("seg"), seg.alias("value"), F.col("fp"))
        p = prints.select(F.lit(i).alias("seg"), F.explode(_xored(seg, ball)).alias("value"), F.col("fp").alias("q"))
        tables = t if tables is None else tables.unionByName(t)
        probes = p if probes is None else probes.unionByName(p)
    # Entries of a crowded value are never listed; a value stands for them.
    entries = tables.groupBy("seg", "value").agg(F.count("*").alias("n"), F.min("fp").alias("only"))
    full = entries.filter(F.col("n") > crowded).select("seg", "value")
    single = entries.filter("n = 1").select("seg", "value", F.col("only").alias("fp"))
    some = entries.filter((F.col("n") > 1) & (F.col("n") <= crowded)).select("seg", "value")
    listed = single.unionByName(tables.join(some, ["seg", "value"]).select("seg", "value", "fp"))
    far = lambda a, b: F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= max_bits
    # The planner sizes a table as if explode gave one row: "merge" keeps it from broadcasting the balls.
    fetched = probes.hint("merge").join(listed, ["seg", "value"]).filter((F.col("q") != F.col("fp")) & far("q", "fp"))
    fetched = fetched.select(F.least("q", "fp").alias("a"), F.greatest("q", "fp").alias("b"))
    near = probes.join(full, ["seg", "value"], "left_semi").select(F.col("q").alias("fp")).distinct()
    half = _ball(list(range(64)), max_bits // 2)
    middle = near.select("fp", F.explode(_xored(F.col("fp"), half)).alias("value"))
    low = middle.groupBy("value").agg(F.min("fp").alias("m"), F.count("*").alias("n")).filter("n > 1")
    linked = middle.join(low.hint("merge"), "value").filter(F.col("fp") != F.col("m"))
    linked = linked.filter(far("fp", "m")).select(F.col("m").alias("a"), F.col("fp").alias("b"))
    return fetched.unionByName(linked).distinct()


def _grouped(docs: DataFrame, id_col: str, text_col: str, shingle_words: int, max_bits: int, **more: Column) -> DataFrame:
    """(``id_col``, fp, ``more``, root, component_id) per row; each group has its own root."""
    small_batches(docs.sparkSession)
    prints = written(docs.select(F.col(id_col), simhash(F.col(text_col), shingle_words).alias("fp"), *[c.alias(name) for name, c in more.items()]), "prints")
    firsts = prints.groupBy("fp").agg(F.min(id_col).alias("first_id"))
    roots = components(written(near_links(written(firsts.select("fp"), "distinct"), max_bits), "near"))
    classes = firsts.join(roots, firsts["fp"] == roots["node"], "left").select(firsts["fp"].alias("fp"), F.coalesce("root", firsts["fp"]).alias("root"), "first_id")
    groups = classes.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = classes.join(groups, "root").select("fp", "root", "component_id")
    return prints.join(named, "fp").select(id_col, "fp", *more, "root", F.when(F.col(id_col).isNotNull(), F.col("component_id")).alias("component_id"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """(``id_col``, fp, component_id) per row: the smallest id in the group of rows whose
    fingerprints are connected by links of ``max_bits`` or fewer differing bits."""
    return _grouped(docs, id_col, text_col, shingle_words, max_bits).select(id_col, "fp", "component_id")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each group of near-duplicates, the one with the smallest id, then
    fingerprint, then text hash, with the columns of ``docs``.  An id whose texts are in
    several groups can stay once for each; of rows with equal id and text the one whose other
    columns come first as JSON stays; rows with a null id all stay."""
    text_hash = F.xxhash64(F.col(text_col))
    rows = _grouped(docs, id_col, text_col, shingle_words, max_bits, __hash=text_hash).filter(F.col(id_col) == F.col("component_id"))
    first = rows.groupBy("root").agg(F.min(F.struct(F.col(id_col), F.col("fp"), F.col("__hash"))).alias("m")).select(F.col("m")[id_col].alias(id_col), F.col("m.__hash").alias("__hash"))
    named = docs.filter(F.col(id_col).isNotNull()).withColumn("__hash", text_hash).join(first, [id_col, "__hash"], "left_semi")
    rest = F.to_json(F.struct(*[F.col(c) for c in sorted(docs.columns) if c not in (id_col, text_col)] or [F.lit(0).alias("none")]))
    named = named.groupBy(id_col, "__hash").agg(F.min_by(F.struct(*docs.columns), rest).alias("__row")).select("__row.*")
    return named.select(*docs.columns).unionByName(docs.filter(F.col(id_col).isNull())).select(*docs.columns)
