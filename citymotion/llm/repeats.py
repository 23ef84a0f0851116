"""Suffix-array de-duplication of repeated byte strings (operator 7).

A byte goes if a string of ``length`` bytes that covers it also starts elsewhere (in any text,
its own included; matches never cross texts).  ``keep="none"`` removes all copies,
``keep="first"`` the later ones: strings with an earlier match, judged by the longest previous
factor, cut at ``length``.

1. Anchors.  Each string of ``length`` bytes is owned by the least hash among its k-grams (last
   of equal ones), which depends on its content alone, so equal strings have anchors with
   equal k-grams at equal places.  An anchor owns a run of consecutive strings (about 85),
   and its context is the bytes of that run.  Runs of one context within a text (short
   periods) are one row.  Hashes of k-grams and contexts only route.
2. Only anchors whose k-gram occurs twice go on (written once).  Of each context around it the first
   occurrence is fetched, and the last one too if there are several.
3. These fragments are sorted by k-gram; groups of them are put into a suffix array (ranks of
   8, 24 and 72 bytes by prefix tripling, then of the full length at the starts of owned
   strings; equal strings by position) with the common prefixes of neighbours.  For each string
   the previous and the next entry of smaller position give the longest previous factor, the
   larger of the least common prefixes on the way, cut at ``length``; where it reaches it,
   that entry is an earlier match.  The string goes, and with ``keep="none"`` the match too.
   The last occurrence of a context, equal to the first byte by byte, has it as its match.
4. Occurrences between the first and the last of a context go like the last one.
   A k-gram with over ``CROWDED`` different contexts is not gathered: its strings are counted
   one by one, by 128-bit hashes, with map-side aggregation.
5. The removed runs meet their text again.

What is shuffled: hashes and positions of anchors (about 30 bytes for 85 of text), one or two
fragments of each repeated context, and the texts twice (compressed).  A step's shuffle files
go when its result is written.  No task gathers an unbounded group: counts are aggregated
map-side, joins can be split by Spark, and groups of fragments have at most 2 x ``CROWDED``
members (fewer for long strings, so that ranks keep to their 21 bits).

Defined results: null text is empty; texts shorter than ``length`` keep everything; repeated rows
are copies like any others, and null ids are ordinary rows (rows are told apart by a row
number, not their id; the input has to be re-readable in the same order, as files are);
further columns of the input, whatever their names, are not read; an empty table gives an
empty result; a ``length`` under 8 raises.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from citymotion.llm.common import small_batches, utf8, written
from citymotion.session import shuffles_freed

LENGTH = 200
GRAM = 32  # bytes of a k-gram, a power of two; less for strings under twice as long
CROWDED = 2048
RANKS = 1 << 21  # ranks have 21 bits
CHUNK = 1 << 20  # bytes of fragments that are sorted together, unless one group has more
SEGMENT = 1 << 19  # strings whose anchors are found at once
LOW = (1 << 20) - 1
ANCHORS = "rid long, gram long, context long, lo int, hi int, hi1 int, off int, n int"


def _array(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


# ---------------------------------------------------------------- anchors


def gram_of(length: int) -> int:
    """Bytes of the k-grams for strings of ``length`` bytes."""
    if length < 8:
        raise ValueError("strings have at least 8 bytes")
    return min(GRAM, 1 << (length // 2).bit_length() - 1)


def gram_hashes(b: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A 64-bit hash of the ``gram`` bytes from each position."""
    h = b.astype(np.uint64) + np.uint64(1)
    mult, step = 0x9E3779B97F4A7C15, 1
    while step < gram:
        h = h[:-step] * np.uint64(mult) + h[step:]
        mult, step = mult * mult & (1 << 64) - 1, 2 * step
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def owners(h: np.ndarray, length: int) -> np.ndarray:
    """For each string of ``length`` bytes the place of its anchor."""
    w = length - gram_of(length) + 1
    found = []
    for s in range(0, len(h) - w + 1, SEGMENT):
        part = h[s : s + SEGMENT + w - 1]
        n = len(part)
        key = (part & ~np.uint64(LOW)) | (np.uint64(LOW) - np.arange(n, dtype=np.uint64))
        blocks = np.concatenate((key, np.full(-n % w, ~np.uint64(0)))).reshape(-1, w)
        left = np.minimum.accumulate(blocks, axis=1).reshape(-1)
        right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
        least = np.minimum(right[: n - w + 1], left[w - 1 : n])
        found.append(s + (LOW - (least & np.uint64(LOW)).astype(np.int64)))
    return np.concatenate(found)


def anchors(data: bytes, length: int = LENGTH) -> list[tuple[int, int, int, int, int, int, int]]:
    """(gram, context, lo, hi, hi1, off, n): strings starting in [lo, hi] have the anchor at
    start + off - (start - lo); n equal runs follow one another, the first ends at hi1."""
    from xxhash import xxh3_64_intdigest

    if len(data) < length:
        return []
    h = gram_hashes(np.frombuffer(data, dtype=np.uint8), gram_of(length))
    own = owners(h, length)
    cut = np.flatnonzero(np.diff(own)) + 1
    lo = np.concatenate(([0], cut))
    hi = np.concatenate((cut - 1, [len(own) - 1]))
    grams = h[own[lo]].view(np.int64).tolist()
    offs = (own[lo] - lo).tolist()
    out: list[tuple] = []
    for gram, a, z, off in zip(grams, lo.tolist(), hi.tolist(), offs):
        context = xxh3_64_intdigest(data[a : z + length])
        context -= context >> 63 << 64
        if out and out[-1][0] == gram and out[-1][1] == context and out[-1][3] == a - 1:
            last = out[-1]
            out[-1] = (gram, context, last[2], z, last[4], last[5], last[6] + 1)
        else:
            out.append((gram, context, a, z, z, off, 1))
    return out


def _anchor_rows(docs: DataFrame, length: int) -> DataFrame:
    schema = pa.schema([("rid", pa.int64()), ("gram", pa.int64()), ("context", pa.int64()), *[(c, pa.int32()) for c in ("lo", "hi", "hi1", "off", "n")]])

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[tuple] = []
            for rid, data in zip(b["rid"].to_pylist(), utf8(b["text"])):
                rows += [(rid, *a) for a in anchors(data, length)]
                if len(rows) >= 1 << 16:
                    yield _array(rows, schema)
                    rows = []
            if rows:
                yield _array(rows, schema)

    return docs.select("rid", "text").mapInArrow(found, ANCHORS)


# ---------------------------------------------------------------- suffix order


def _ranks(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1].astype(np.uint64)


def _levels(data: np.ndarray, length: int) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """The padded bytes, and ranks of the 8, 24, 72, ... bytes from each position."""
    if len(data) + 2 * length >= RANKS:
        raise ValueError("too many bytes for ranks of 21 bits")
    width, n = 8, len(data)
    b = np.concatenate((data, np.zeros(3 * length + 8, dtype=np.uint8)))
    size = n + 2 * length
    key = np.zeros(size, dtype=np.uint64)
    for k in range(8):
        key = key << np.uint64(8) | b[k : size + k].astype(np.uint64)
    rank = _ranks(key)
    found = [(width, rank)]
    while 3 * width < length:
        limit = len(rank) - 2 * width
        rank = _ranks(rank[:limit] << np.uint64(42) | rank[width : limit + width] << np.uint64(21) | rank[2 * width : limit + 2 * width])
        width *= 3
        found.append((width, rank))
    return b, found


def _full_ranks(levels: list[tuple[int, np.ndarray]], starts: np.ndarray, length: int) -> np.ndarray:
    width, rank = levels[-1]
    second, third = min(width, length - width), max(0, length - width)
    return _ranks(rank[starts] << np.uint64(42) | rank[starts + second] << np.uint64(21) | rank[starts + third])


def suffix_ranks(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Ranks in suffix order of the first ``length`` bytes at ``starts``; equal strings have
    equal ranks."""
    return _full_ranks(_levels(data, length)[1], starts, length)


def suffix_array(data: np.ndarray, starts: np.ndarray, order: np.ndarray, length: int, least: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``starts`` in suffix order (equal strings by ``order``) and the common prefix
    of each entry with the one before, cut at ``length``; those under ``least`` may read 0."""
    b, levels = _levels(data, length)
    rank = _full_ranks(levels, starts, length)
    by = np.lexsort((order, rank))
    lcp = np.zeros(len(starts), dtype=np.int32)
    lcp[1:][np.diff(rank[by]) == 0] = length
    if least < length:
        rest = np.flatnonzero(lcp[1:] == 0) + 1
        one, two = starts[by[rest - 1]], starts[by[rest]]
        reached = np.zeros(len(rest), dtype=np.int64)
        for width, ranks in reversed(levels):
            for _ in range(2):
                fits = reached + width <= length
                x, y = np.where(fits, one + reached, 0), np.where(fits, two + reached, 0)
                reached += width * (fits & (ranks[x] == ranks[y]))
        for _ in range(7):
            fits = reached < length
            reached += fits & (b[one + reached] == b[two + reached])
        lcp[rest] = reached
    return by, lcp


def previous_smaller(position: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry of a suffix array the nearest entry before it of smaller position (-1: none)
    and the common prefix with it, which is the least ``lcp`` on the way (0 if there is none).

    Both come from tables of minima over 1, 2, 4, ... entries: from large to small blocks, a
    block whose positions are all greater is passed."""
    n = len(position)
    least, common = [position], [lcp]
    while 2 << len(least) - 1 <= n:
        half = 1 << len(least) - 1
        least.append(np.minimum(least[-1][:-half], least[-1][half:]))
        common.append(np.minimum(common[-1][:-half], common[-1][half:]))
    at = np.arange(n)  # entries at .. i - 1 are passed
    found = np.full(n, np.iinfo(np.int32).max, dtype=np.int32)
    for k in reversed(range(len(least))):
        block = 1 << k
        go = np.flatnonzero(at >= block)
        go = go[least[k][at[go] - block] > position[go]]
        found[go] = np.minimum(found[go], common[k][at[go] - block + 1])
        at[go] -= block
    return at - 1, np.where(at > 0, np.minimum(found, lcp[at]), 0)


def longest_previous(data: np.ndarray, starts: np.ndarray, order: np.ndarray, length: int, least: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """For each of ``starts`` the longest previous factor, cut at ``length``: the longest prefix
    shared with a string of smaller ``order``; and the place in ``starts`` of such a string (-1
    where the factor is 0).  Factors under ``least`` count as 0; the values of ``order`` differ."""
    by, lcp = suffix_array(data, starts, order, length, least)
    linked = lcp >= least
    some = np.flatnonzero(linked | np.append(linked[1:], False))  # the others share nothing with a neighbour
    factor, match = np.zeros(len(starts), dtype=np.int32), np.full(len(starts), -1)
    if not len(some):
        return factor, match
    entry = by[some]
    position, near = order[entry], np.where(linked, lcp, 0)[some]
    back = np.concatenate((near[:1] * 0, near[:0:-1]))  # the same read from the end
    before, shared = previous_smaller(position, near)
    after, beyond = previous_smaller(position[::-1], back)
    after, beyond = len(some) - 1 - after[::-1], beyond[::-1]
    factor[entry] = np.maximum(shared, beyond)
    nearest = np.where(shared >= beyond, before, after)
    match[entry] = np.where(factor[entry] > 0, entry[np.minimum(nearest, len(some) - 1)], -1)
    return factor, match


def previous_factors(data: bytes, length: int) -> np.ndarray:
    """The longest previous factors, cut at ``length``, of all strings of that length in one text."""
    n = len(data) - length + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int32)
    starts = np.arange(n)
    return longest_previous(np.frombuffer(data, dtype=np.uint8), starts, starts, length)[0]


FRAGMENT = pa.schema([("crowded", pa.bool_()), ("key", pa.binary()), ("rid", pa.int64()), ("lo", pa.int32()), ("strings", pa.int32()), ("bytes", pa.binary())])
FRAGMENT_SQL = "crowded boolean, key binary, rid long, lo int, strings int, bytes binary"
SPANS = pa.schema([("rid", pa.int64()), ("start", pa.int32()), ("stop", pa.int32())])
SPANS_SQL = "rid long, start int, stop int"


def _fragments(packed: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes of the wanted contexts; strings of crowded grams one by one, as hashes."""
    lists = wanted.groupBy("rid").agg(F.collect_list(F.struct("gram", "lo", "hi1", "crowded")).alias("places"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from xxhash import xxh3_128_digest

        unpack = zstandard.ZstdDecompressor()
        for b in batches:
            rows: list[tuple] = []
            for rid, z, places in zip(b["rid"].to_pylist(), b["packed"].to_pylist(), b["places"].to_pylist()):
                data = unpack.decompress(z)
                for p in places:
                    lo, hi = p["lo"], p["hi1"]
                    if p["crowded"]:
                        rows += [(True, xxh3_128_digest(data[s : s + length]), rid, s, 1, None) for s in range(lo, hi + 1)]
                    else:
                        rows.append((False, p["gram"].to_bytes(8, "big", signed=True), rid, lo, hi - lo + 1, data[lo : hi + length]))
                if len(rows) >= 1 << 14:
                    yield _array(rows, FRAGMENT)
                    rows = []
            if rows:
                yield _array(rows, FRAGMENT)

    return packed.select("rid", "packed").join(lists, "rid").mapInArrow(cut, FRAGMENT_SQL)


def _sorted_chunk(rows: list[tuple[int, int, int, bytes]], keep: str, length: int) -> pa.RecordBatch:
    """Removed spans of fragments (rid, lo, strings, bytes).

    Equal fragments are the first and the last occurrence of a context: their bytes are ranked
    once, at the first one's position, and the last one has the first as its earlier match."""
    first: dict[bytes, int] = {}
    ends: list[int] = []
    rows.sort(key=lambda r: r[:2])
    for k, r in enumerate(rows):
        if first.setdefault(r[3], k) != k:
            ends.append(k)
    rid, lo, strings = (np.array([r[c] for r in rows]) for c in range(3))
    kept = np.fromiter(first.values(), dtype=np.int64, count=len(first))
    repeated = np.isin(kept, [first[rows[k][3]] for k in ends])
    sizes = np.fromiter(map(len, first), dtype=np.int64, count=len(first))
    counts = strings[kept]
    before = np.cumsum(counts) - counts
    order = np.arange(counts.sum())  # rows are sorted by position
    inner = order - np.repeat(before, counts)
    starts = np.repeat(np.cumsum(sizes) - sizes, counts) + inner
    factor, match = longest_previous(np.frombuffer(b"".join(first), dtype=np.uint8), starts, order, length, least=length)
    hit = factor >= length
    if keep == "none":  # an earlier match goes as well
        hit[match[hit]] = True
        hit |= np.repeat(repeated, counts)
    opens, closes = hit.copy(), hit.copy()
    opens[1:] &= ~hit[:-1] | (inner[1:] == 0)
    closes[:-1] &= ~hit[1:] | (inner[1:] == 0)
    row = np.repeat(kept, counts)[opens]
    columns = (
        np.concatenate((rid[row], rid[ends])),
        np.concatenate((lo[row] + inner[opens], lo[ends])),
        np.concatenate((lo[row] + inner[closes] + length, lo[ends] + strings[ends] - 1 + length)),
    )
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, SPANS)], schema=SPANS)


def _matched(fragments: DataFrame, keep: str, length: int) -> DataFrame:
    """Removed spans among the fragments of grams that are gathered."""

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk: list[tuple] = []  # whole groups of one gram each, then the group that is read
        whole = size = group = 0  # rows and bytes of whole groups, bytes of the last one
        last_key = None
        for b in batches:
            for key, rid, lo, n, data in zip(*(b[c].to_pylist() for c in ("key", "rid", "lo", "strings", "bytes"))):
                if key != last_key:
                    last_key, whole, size, group = key, len(chunk), size + group, 0
                chunk.append((rid, lo, n, data))
                group += len(data)
                if whole and size + group > CHUNK:
                    yield _sorted_chunk(chunk[:whole], keep, length)
                    chunk, whole, size = chunk[whole:], 0, 0
        if chunk:
            yield _sorted_chunk(chunk, keep, length)

    ordered = fragments.select("key", "rid", "lo", "strings", "bytes").repartition("key").sortWithinPartitions("key", "rid", "lo")
    return ordered.mapInArrow(judged, SPANS_SQL)


def _matched_strings(strings: DataFrame, keep: str, length: int) -> DataFrame:
    """Removed spans among single strings (key, rid, lo) of crowded grams."""
    several = strings.groupBy("key").agg(F.count("*").alias("n"), F.min(F.struct("rid", "lo")).alias("first")).filter("n > 1")
    found = strings.join(several, "key")
    if keep == "first":
        found = found.filter((F.col("rid") != F.col("first.rid")) | (F.col("lo") != F.col("first.lo")))
    return found.select("rid", F.col("lo").alias("start"), (F.col("lo") + length).cast("int").alias("stop"))


# ---------------------------------------------------------------- whole corpus


def _packed(docs: DataFrame) -> DataFrame:
    """``docs`` with the text's UTF-8 bytes compressed, for the shuffle."""

    @pandas_udf("binary")
    def pack(texts: pd.Series) -> pd.Series:
        import zstandard

        z = zstandard.ZstdCompressor(level=1)
        return pd.Series([z.compress((t or "").encode("utf-8")) for t in texts], dtype=object)

    return docs.withColumn("packed", pack(F.col("text"))).drop("text")


def removed_spans(docs: DataFrame, length: int = LENGTH, keep: str = "none", crowded: int = CROWDED) -> DataFrame:
    """(rid, start, stop) byte spans to remove, which may overlap; ``docs`` has rid and text."""
    if keep not in ("none", "first"):
        raise ValueError("keep is 'none' or 'first'")
    found = written(_anchor_rows(docs, length), "anchors")
    shared = found.groupBy("gram").agg(F.sum("n").alias("t")).filter("t > 1").select("gram")
    near = written(found.drop("off").join(shared, "gram", "left_semi"), "near")
    crowded = min(crowded, RANKS // (4 * length) - 1)  # two fragments of under 2 x length bytes for each context
    contexts = near.groupBy("gram", "context").agg(F.sum("n").alias("copies"), F.min(F.struct("rid", "lo")).alias("rep"), F.max(F.struct("rid", "lo")).alias("end"))
    several = contexts.groupBy("gram").agg(F.count("*").alias("contexts"))
    judged = near.join(contexts, ["gram", "context"]).join(several, "gram")
    place = F.struct("rid", "lo")
    judged = judged.withColumns({"is_rep": place == F.col("rep"), "is_end": place == F.col("end"), "crowded": F.col("contexts") > crowded})
    judged = written(judged.drop("rep", "end", "context").filter("copies > 1 OR contexts > 1"), "judged")
    # what the suffix order doesn't judge by itself: the copies between, periods, crowded grams
    whole = judged.filter("copies > 1 AND (NOT (is_rep OR is_end) OR hi > hi1 OR crowded)")
    stop = (F.col("hi") + length).cast("int").alias("stop")
    if keep == "none":
        spans = whole.select("rid", F.col("lo").alias("start"), stop)
    else:  # the first of several equal runs in one text stays as far as the others don't cover it
        later = F.when(F.col("is_rep"), F.col("hi1") + 1).otherwise(F.col("lo")).cast("int")
        spans = whole.filter("NOT is_rep OR hi > hi1").select("rid", later.alias("start"), stop)
    wanted = judged.filter("is_rep AND (NOT crowded OR contexts > 1) OR is_end AND NOT crowded").select("rid", "gram", "lo", "hi1", "crowded")
    fragments = written(_fragments(_packed(docs), wanted, length), "fragments", "zstd")
    spans = spans.unionByName(_matched(fragments.filter("NOT crowded"), keep, length))
    return spans.unionByName(_matched_strings(fragments.filter("crowded").select("key", "rid", "lo"), keep, length))


KEPT = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def cut_out(data: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """What is left, the bytes removed and the number of maximal removed runs."""
    left, at, removed, runs = [], 0, 0, 0
    stop = -1
    for a, z in sorted(spans):
        if a > stop:
            left.append(data[at:a])
            runs += 1
            removed += z - a
            at = stop = z
        elif z > stop:
            removed += z - stop
            at = stop = z
    left.append(data[at:])
    return b"".join(left), removed, runs


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, keep: str = "none", crowded: int = CROWDED) -> DataFrame:
    """Per row: ``id_col``, ``KEPT`` and the remaining bytes in ``kept``."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    with shuffles_freed(docs.sparkSession):
        spans = written(removed_spans(rows, length, keep, crowded), "spans")
    lists = spans.groupBy("rid").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))

    @pandas_udf(f"{KEPT}, kept binary")
    def cut(packed: pd.Series, spans: pd.Series) -> pd.DataFrame:
        import zstandard

        unpack, out = zstandard.ZstdDecompressor(), []
        for z, found in zip(packed, spans):
            data = unpack.decompress(bytes(z))
            left, removed, runs = cut_out(data, [(s["start"], s["stop"]) for s in found] if found is not None else [])
            out.append((len(data), removed, runs, hashlib.sha256(left).hexdigest(), left))
        return pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    done = _packed(rows).join(lists, "rid", "left").withColumn("cut", cut(F.col("packed"), F.col("spans")))
    return done.select(F.col("id").alias(id_col), "cut.*")

