"""Target-distribution importance resampling with hashed n-grams (operator 13).

Features are all runs of 1 to ``n`` consecutive words (A-Z lower-cased, words cut at ASCII
characters that are no letters or digits), hashed to ``buckets`` by CRC-32.  A bucket's gain
is the smoothed log ratio of its share in the target texts to its share in the documents;
a document's weight is the sum of the gains of its features.  Weights plus Gumbel noise that
depends on the id alone are ranked, and the highest are drawn: sampling without replacement
in proportion to the importance weights.

Workers handle texts in pieces of ``PIECE`` bytes.  Byte classes find the words of a piece
at once; its n-grams are interned in an open-addressed NumPy table: XXH64 keys choose slots,
a hit counts only after its bytes have been compared, and a slot stores bucket and count.
For counts, the slots' counts are added up by bucket; for weights, the slot of each
occurrence gathers the gain.  So CRC-32 runs once per distinct n-gram of a piece, and no
text, n-gram or document is left out.

Counts are ``buckets`` rows at most on the driver.  Ranks come from ``prefix``: a range sort of
narrow rows with per-partition totals.

Defined results: null and empty texts have no features and weight 0; a null id hashes as
empty text and is ranked after equal scores with ids; rows with equal score and id are
ranked by n_features; repeated rows are drawn one by one; an empty target gives gains by the
documents alone; an empty table gives no rows.  Columns of ``docs`` named like a result
column are replaced; names starting with ``__`` are left out.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from citymotion.llm.common import ship_package, small_batches, utf8, written
from citymotion.llm.prefix import ROW, with_prefix
from citymotion.llm.sharding import crc_parts, crc_sql

N = 1
BUCKETS = 10_000
PERCENT = 10
LEAST_WORDS = 20
SEED = "2024"
SCALE = 1000
PIECE = 4 << 20
COMPARED = 16  # 8-byte steps of the vectorised comparison; longer n-grams are compared as bytes

_BLANK = 0x20
# A-Z to a-z; other ASCII characters that are no letter or digit to a blank
_CLASSES = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else _BLANK for c in range(256))
_WORD = re.compile(rb"[^ ]+")


class Interned:
    """The distinct byte runs [start, end) of ``data`` in an open-addressed table.

    ``slot`` is each run's slot; ``bucket`` and ``count`` are stored by slot."""

    def __init__(self, data: bytes, starts: np.ndarray, ends: np.ndarray, buckets: int):
        from xxhash import xxh64_intdigest

        n = len(starts)
        size = 1 << max(4, (2 * n).bit_length())
        a, b = starts.tolist(), ends.tolist()
        keys = np.fromiter((xxh64_intdigest(data[i:j]) for i, j in zip(a, b)), np.uint64, n)
        mask = np.uint64(size - 1)
        at = (keys & mask).astype(np.int64)
        padded = data + bytes(8)
        words = np.ndarray((len(data) + 1,), "<u8", padded, 0, (1,))  # 8 bytes from every position

        def equal(p: np.ndarray, q: np.ndarray) -> np.ndarray:
            """Whether the bytes of runs p and q agree."""
            same = (keys[p] == keys[q]) & (ends[p] - starts[p] == ends[q] - starts[q])
            live, step = np.flatnonzero(same & (p != q)), 0
            while len(live) and step < COMPARED:
                x, y = starts[p[live]] + 8 * step, starts[q[live]] + 8 * step
                left = ends[p[live]] - x
                drop = np.where(left < 8, (8 - np.maximum(left, 0)) * 8, 0).astype(np.uint64)
                off = (words[x] ^ words[y]) << np.minimum(drop, 63)
                wrong = (off != 0) & (left > 0)
                same[live[wrong]] = False
                live, step = live[~wrong & (left > 8)], step + 1
            for i in live.tolist():
                s, t = starts[p[i]], starts[q[i]]
                same[i] = data[s : ends[p[i]]] == data[t : ends[q[i]]]
            return same

        owner = np.full(size, -1, np.int64)
        slot, pending = np.empty(n, np.int64), np.arange(n)
        while len(pending):
            s = at[pending]
            free = owner[s] < 0
            owner[s[free][::-1]] = pending[free][::-1]  # the first run that asks owns the slot
            hit = equal(pending, owner[s])
            slot[pending[hit]] = s[hit]
            pending = pending[~hit]
            at[pending] = (at[pending] + 1) & (size - 1)
        self.slot = slot
        self.used = np.flatnonzero(owner >= 0)
        self.count = np.bincount(slot, minlength=size)
        self.bucket = np.zeros(size, np.int64)
        self.bucket[self.used] = [zlib.crc32(data[a[i] : b[i]]) % buckets for i in owner[self.used].tolist()]


def _cut(raw: bytes, n: int, size: int) -> Iterator[tuple[bytes, int]]:
    """Pieces of a text cut at blanks, each with the n - 1 words that follow it, and the number of these."""
    at = 0
    while len(raw) - at > size and (stop := raw.find(b" ", at + size)) >= 0:
        after, end = [], stop
        while len(after) < n - 1 and (m := _WORD.search(raw, end)):
            after.append(m.group())
            end = m.end()
        yield b" ".join([raw[at:stop], *after]), len(after)
        at = stop
    yield raw[at:], 0


def pieces(texts: list[bytes], n: int, size: int = PIECE) -> Iterator[list[tuple[int, bytes, int]]]:
    """Groups of (text's index, piece, words of context at its end) of ``size`` bytes or little more."""
    group, held = [], 0
    for i, raw in enumerate(texts):
        raw = raw.translate(_CLASSES)
        for piece, context in _cut(raw, n, size) if len(raw) > size else [(raw, 0)]:
            group.append((i, piece, context))
            held += len(piece)
            if held >= size:
                yield group
                group, held = [], 0
    if group:
        yield group


def runs(group: list[tuple[int, bytes, int]], n: int) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The group's words with one blank after each, its n-grams' starts, ends and text
    indices, and the text index of each word that is no context."""
    joined = b" ".join([piece for _, piece, _ in group]) + b" "
    raw = np.frombuffer(joined, np.uint8)
    word = raw != _BLANK
    before = np.concatenate(([False], word[:-1]))
    begins = np.flatnonzero(word & ~before)
    compact = raw[word | (before & ~word)]
    ends = np.flatnonzero(compact == _BLANK)
    starts = np.concatenate((np.zeros(min(len(ends), 1), np.int64), ends[:-1] + 1))
    offsets = np.cumsum([len(piece) + 1 for _, piece, _ in group])
    piece_of = np.searchsorted(offsets, begins, side="right")
    n_words = np.bincount(piece_of, minlength=len(group))
    last = np.cumsum(n_words) - np.array([context for _, _, context in group])  # first word of context
    own = np.arange(len(begins)) < last[piece_of]
    text_of = np.array([i for i, _, _ in group], np.int64)[piece_of]
    s, e, t = [], [], []
    for k in range(1, n + 1):
        m = max(len(begins) - k + 1, 0)
        whole = own[:m] & (piece_of[:m] == piece_of[k - 1 :][:m])
        s.append(starts[:m][whole])
        e.append(ends[k - 1 :][:m][whole])
        t.append(text_of[:m][whole])
    return compact.tobytes(), np.concatenate(s), np.concatenate(e), np.concatenate(t), text_of[own]


def bucket_counts(texts: list[bytes], n: int = N, buckets: int = BUCKETS, size: int = PIECE) -> np.ndarray:
    total = np.zeros(buckets, np.int64)
    for group in pieces(texts, n, size):
        data, starts, ends, _, _ = runs(group, n)
        table = Interned(data, starts, ends, buckets)
        np.add.at(total, table.bucket[table.used], table.count[table.used])
    return total


def weighted(texts: list[bytes], gains: np.ndarray, n: int = N, size: int = PIECE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, features and summed gains of each text."""
    out = np.zeros((3, len(texts)), np.int64)
    for group in pieces(texts, n, size):
        data, starts, ends, text_of, word_of = runs(group, n)
        table = Interned(data, starts, ends, len(gains))
        gain = gains[table.bucket]
        np.add.at(out[0], word_of, 1)
        np.add.at(out[1], text_of, 1)
        np.add.at(out[2], text_of, gain[table.slot])
    return out[0], out[1], out[2]


# ---------------------------------------------------------------- Spark jobs


def counted(df: DataFrame, text_col: str = "text", n: int = N, buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket's features occur in all texts of ``df``."""
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            total += bucket_counts(utf8(b.column(0)), n, buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    each = df.select(F.col(text_col).cast("string").alias("t")).mapInArrow(run, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for r in each.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # ``buckets`` rows at most
        out[r["bucket"]] = r["n"]
    return out


def gains_of(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(SCALE * ln(ratio of the smoothed shares)) of each bucket, in doubles."""
    b, s_all, t_all = len(documents), float(documents.sum()), float(target.sum())
    return np.array([math.floor(SCALE * math.log((float(t) + 1) * (s_all + b) / ((float(s) + 1) * (t_all + b)))) for s, t in zip(documents.tolist(), target.tolist())], np.int64)


def noise(id_col: Column, seed: str = SEED) -> Column:
    """floor(SCALE * Gumbel noise) from the first 32 bits of a SHA-256 of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    u = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / float(1 << 32)
    return F.floor(F.lit(float(-SCALE)) * F.log(-F.log(u)))


NEW = ("n_words", "n_features", "weight", "score", "rank")


def scored(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N, buckets: int = BUCKETS, seed: str = SEED) -> DataFrame:
    """``docs`` with n_words, n_features, weight and score."""
    gains = gains_of(counted(docs, text_col, n, buckets), counted(target, text_col, n, buckets))

    @pandas_udf("n_words long, n_features long, weight long")
    def weigh(texts: pd.Series) -> pd.DataFrame:
        words, features, weight = weighted([(t or "").encode("utf-8") for t in texts], gains, n)
        return pd.DataFrame({"n_words": words, "n_features": features, "weight": weight})

    kept = [c for c in docs.columns if c not in NEW and not c.startswith("__")]
    out = docs.select(*kept, weigh(F.col(text_col).cast("string")).alias("__w")).select(*kept, "__w.*")
    return out.withColumn("score", F.col("weight") + noise(F.col(id_col), seed))


def ranked(scores: DataFrame, id_col: str = "doc_id", percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """``scores`` with rank: 1, 2, ... for the drawn rows, null for the others.

    ``scores`` is read several times, so it should be a written table."""
    able = scores.filter(F.col("n_words") >= least_words)
    order = [F.col("score").desc(), F.col(id_col).asc_nulls_last(), F.col("n_features")]
    placed, rows, _ = with_prefix(able, order, F.lit(1))
    draw = percent * rows // 100
    drawn = F.when(F.col(ROW) < draw, F.col(ROW) + 1).alias("rank")
    rest = scores.filter((F.col("n_words") < least_words) | F.col("n_words").isNull())
    return placed.select(*scores.columns, drawn).unionByName(rest.withColumn("rank", F.lit(None).cast("long")))


def report(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(``id_col``, n_features, weight, score, rank) of each row."""
    scores = scored(docs.select(id_col, text_col), target, id_col, text_col, **options).drop(text_col)
    return ranked(written(scores, "scores"), id_col).select(id_col, "n_features", "weight", "score", "rank")


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, least_words: int = LEAST_WORDS, **options) -> DataFrame:
    """The drawn rows of ``docs``, with its columns and rank.  Whole rows are written once with
    their scores; only rows that can be drawn are sorted."""
    scores = written(scored(docs, target, id_col, text_col, **options), "scored")
    out = ranked(scores, id_col, percent, least_words).filter("rank IS NOT NULL")
    return out.select(*[c for c in docs.columns if c in out.columns and c not in NEW], "rank")


def oracle(source: str = "documents", target: str = "benchmark", buckets: int = BUCKETS, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: str = SEED) -> str:
    """DuckDB SQL of ``report`` with single words as features."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    words = rf"regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    parts = crc_parts() + [
        f"docs AS MATERIALIZED (SELECT row_number() OVER () AS place, doc_id, {words} AS words FROM {source})",
        f"own AS MATERIALIZED (SELECT place, word, count(*) AS n FROM (SELECT place, unnest(words) AS word FROM docs) GROUP BY ALL)",
        f"aim AS MATERIALIZED (SELECT word, count(*) AS n FROM (SELECT unnest({words}) AS word FROM {target}) GROUP BY ALL)",
        f"bucket_of AS MATERIALIZED (SELECT word, {crc_sql('word')} % {buckets} AS bucket FROM (SELECT word FROM own UNION SELECT word FROM aim), crc)",
        "s AS (SELECT bucket, CAST(sum(n) AS DOUBLE) AS s FROM own JOIN bucket_of USING (word) GROUP BY bucket)",
        "t AS (SELECT bucket, CAST(sum(n) AS DOUBLE) AS t FROM aim JOIN bucket_of USING (word) GROUP BY bucket)",
        f"""gains AS (SELECT s.bucket, CAST(floor({SCALE} * ln((coalesce(t, 0) + 1) * ((SELECT sum(s) FROM s) + {buckets})
  / ((s + 1) * (coalesce((SELECT sum(t) FROM t), 0) + {buckets})))) AS BIGINT) AS gain FROM s LEFT JOIN t USING (bucket))""",
        "weights AS (SELECT place, CAST(sum(n * gain) AS BIGINT) AS weight FROM own JOIN bucket_of USING (word) JOIN gains USING (bucket) GROUP BY place)",
        f"""scored AS (SELECT doc_id, CAST(len(words) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
  + CAST(floor(-{SCALE} * ln(-ln((CAST('0x' || substr(sha256('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score
  FROM docs LEFT JOIN weights USING (place))""",
        f"able AS (SELECT *, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features) AS place, {percent} * count(*) OVER () // 100 AS draw FROM scored WHERE n_features >= {least_words})",
    ]
    return "WITH RECURSIVE " + ",\n".join(parts) + f"""
SELECT doc_id, n_features, weight, score, CASE WHEN place <= draw THEN CAST(place AS BIGINT) END AS rank FROM able
UNION ALL SELECT doc_id, n_features, weight, score, NULL FROM scored WHERE n_features < {least_words}"""
