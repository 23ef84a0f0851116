"""Vector code compression by integer product quantisation (operator 12).

A vector's components become integers floor(``SCALE`` * x); it is cut into ``parts`` equal
parts, and each part's code is the nearest of ``entries`` codebook entries (squared Euclidean
distance, ties to the lower index).  The codebooks start as the parts of the vectors with
the smallest ids and are refined by ``rounds`` of exact integer k-means.

Distances are exact: |x|^2 - 2 x.c + |c|^2 in int64, with x.c from float64 BLAS products of
limbs.  Integers are broken into signed limbs so narrow that a product of a part's width
stays below 2^53; each pair of limbs is one matrix product without rounding, and the
products are shifted and added in int64.  The number of limbs follows the largest integer of
the batch and of the codebook.  The smallest distance with the first index is the code.

Integers are written once, packed, and each round reads them: a task sums its parts by
entry, Spark adds the sums, and the driver sees one row per part and entry.

Defined results: rows whose vector is null or empty, or has a null or non-finite component are
dropped; null ids come last when the codebooks start and keep their rows; of equal ids, the
vector with the smaller packed bytes comes first; fewer rows than ``entries`` give as many
entries; rows with a null label are one group; equal rows get equal codes; an empty table
gives no rows.  Vectors of different lengths, lengths that ``parts`` does not divide, and
integers beyond ``limit`` (whose squared distances could pass int64) raise ValueError rather
than give a wrong code.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citymotion.llm.common import ship_package, written
from citymotion.session import measured_side

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
EXACT_BITS = 53
BATCH = 4096  # vectors whose distances are held at once


# ---------------------------------------------------------------- exact products


def limit(d: int) -> int:
    """The largest integer for which squared distances of ``d`` components stay below 2^62."""
    return math.isqrt((1 << 62) // (4 * max(d, 1)))


def limb_bits(width: int) -> int:
    """Bits of a limb such that ``width`` products of two limbs stay below 2^53 in sum."""
    return (EXACT_BITS - max(width - 1, 0).bit_length()) // 2


def limbs(a: np.ndarray, bits: int) -> list[np.ndarray]:
    """Float64 arrays l_i with a = sum(l_i << (i * bits)); all but the last are in [0, 2^bits)."""
    most = int(max(abs(int(a.min(initial=0))), abs(int(a.max(initial=0)))))
    out = []
    while most >> bits:
        out.append((a & ((1 << bits) - 1)).astype(np.float64))
        a, most = a >> bits, (most >> bits) + 1
    return [*out, a.astype(np.float64)]


def dot(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact int64 ``x @ c.T`` of integer matrices."""
    bits = limb_bits(x.shape[1])
    total = np.zeros((len(x), len(c)), dtype=np.int64)
    right = limbs(c, bits)
    for i, a in enumerate(limbs(x, bits)):
        for j, b in enumerate(right):
            total += (a @ b.T).astype(np.int64) << np.int64((i + j) * bits)
    return total


def nearest(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest row of ``c`` (first of equals) and its squared distance."""
    d = np.einsum("ij,ij->i", c, c)[None, :] - 2 * dot(x, c)
    code = d.argmin(axis=1)
    return code, d[np.arange(len(x)), code] + np.einsum("ij,ij->i", x, x)


def codes(x: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes (rows, parts) and errors (rows) of integer vectors; books are (parts, entries, width)."""
    width, code, error = books.shape[2], np.empty((len(x), len(books)), np.int64), np.zeros(len(x), np.int64)
    for p, book in enumerate(books):
        code[:, p], d = nearest(x[:, p * width : (p + 1) * width], book)
        error += d
    return code, error


# ---------------------------------------------------------------- Spark jobs


def _integers(b: pa.RecordBatch) -> tuple[np.ndarray, pa.Array, int]:
    """Rows that are kept, their packed integers, and the length of the vectors."""
    column = b.column("__vec")
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten()
    values = flat.to_numpy(zero_copy_only=False).astype(np.float64)  # nulls as NaN
    bad = np.flatnonzero(~np.isfinite(values))
    ends = np.cumsum(lengths)
    keep = lengths > 0
    keep[np.searchsorted(ends, bad, side="right")] = False
    wide = np.unique(lengths[keep])
    if len(wide) > 1:
        raise ValueError(f"vectors of different lengths: {wide.tolist()}")
    d = int(wide[0]) if len(wide) else 0
    with np.errstate(over="ignore"):
        scaled = np.floor(values[np.repeat(keep, lengths)] * SCALE)
    if len(scaled) and np.abs(scaled).max() > limit(d):
        raise ValueError(f"a component is beyond {limit(d) / SCALE}: its squared distances could pass 64 bits")
    packed = scaled.astype("<i4").reshape(-1, d) if d else np.empty((0, 0), "<i4")
    return np.flatnonzero(keep), pa.array([r.tobytes() for r in packed], type=pa.binary()), d


def integers(df: DataFrame, id_col: str, vector_col: str, label_col: str | None) -> DataFrame:
    """(id, label, __ints, __d) of the rows that are kept, written."""
    ship_package(df.sparkSession)
    label = F.col(label_col) if label_col else F.lit(None).cast("int")
    rows = df.select(F.col(id_col).alias("__id"), label.alias("__label"), F.col(vector_col).cast("array<double>").alias("__vec"))
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:2]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep, packed, d = _integers(b)
            at = pa.array(keep)
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), packed, pa.array(np.full(len(keep), d, np.int32))], names=["__id", "__label", "__ints", "__d"])

    return written(rows.mapInArrow(run, ", ".join([*kinds, "__ints binary", "__d int"])), "vectors")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH):
            b = batch.slice(at, BATCH)
            yield b, np.frombuffer(b"".join(b.column("__ints").to_pylist()), "<i4").reshape(b.num_rows, -1).astype(np.int64)


def _sums(ints: DataFrame, books: np.ndarray) -> list:
    """(part, entry, n, total per component) of the rows assigned to each entry."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s = np.zeros((parts, entries), np.int64), np.zeros(books.shape, np.int64)
        for _, x in _blocks(batches):
            code, _ = codes(x, books)
            for p in range(parts):
                n[p] += np.bincount(code[:, p], minlength=entries)
                np.add.at(s[p], code[:, p], x[:, p * width : (p + 1) * width])
        at = np.indices(books.shape).reshape(3, -1)
        yield pa.RecordBatch.from_arrays([*map(pa.array, at), pa.array(np.repeat(n.ravel(), width)), pa.array(s.ravel())], names=["part", "entry", "place", "n", "total"])

    each = ints.select("__ints").mapInArrow(run, "part long, entry long, place long, n long, total long")
    return each.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()  # as many as the codebooks' integers


def train(ints: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray | None:
    """The codebooks (parts, entries, width) after ``rounds``; None without rows."""
    span = ints.agg(F.min("__d").alias("low"), F.max("__d").alias("high")).first()
    if span["low"] is None:
        return None
    d = span["high"]
    if span["low"] != d or d % parts:
        raise ValueError(f"vectors of {span['low']} to {d} components can't be cut into {parts} equal parts")
    first = ints.orderBy(F.col("__id").asc_nulls_last(), F.hex("__ints")).limit(entries).select("__ints").collect()
    start = np.stack([np.frombuffer(r["__ints"], "<i4") for r in first]).astype(np.int64)
    books = np.ascontiguousarray(start.reshape(len(start), parts, d // parts).transpose(1, 0, 2))
    for _ in range(rounds):
        new = books.copy()
        for r in _sums(ints, books):
            if r["n"]:
                new[r["part"], r["entry"], r["place"]] = r["total"] // r["n"]
        books = new
    return books


def books_sha256(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def encode(ints: DataFrame, books: np.ndarray) -> DataFrame:
    """(__id, __label, code, error) of each row."""
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in ints.schema.fields[:2]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, x in _blocks(batches):
            code, error = codes(x, books)
            texts = [r.tobytes().hex() for r in code.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays([b.column("__id"), b.column("__label"), pa.array(texts, type=pa.string()), pa.array(error)], names=["__id", "__label", "code", "error"])

    return ints.select("__id", "__label", "__ints").mapInArrow(run, ", ".join([*kinds, "code string", "error long"]))


def decode(codes_hex: list[str], books: np.ndarray) -> np.ndarray:
    """The approximate vectors (as floats) that codes stand for."""
    code = np.array([list(bytes.fromhex(c)) for c in codes_hex], np.int64).reshape(-1, len(books))
    return np.concatenate([books[p][code[:, p]] for p in range(len(books))], axis=1) / SCALE


def compress(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | None = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """(``id_col``, code, error, label_error, codebooks_sha256) of each kept row."""
    if not 1 <= entries <= 256:
        raise ValueError("a code is one byte: 1 to 256 entries")
    ints = integers(df, id_col, vector_col, label_col)
    books = train(ints, parts, entries, rounds)
    if books is None:
        nothing = F.lit(None)
        return ints.select(F.col("__id").alias(id_col), nothing.cast("string").alias("code"), nothing.cast("long").alias("error"), nothing.cast("long").alias("label_error"), nothing.cast("string").alias("codebooks_sha256"))
    coded = written(encode(ints, books), "codes")
    labels = coded.groupBy(F.col("__label").alias("__of")).agg(F.sum("error").alias("label_error"))
    labels = measured_side(labels, "label-errors")
    whole = coded.join(labels, F.col("__label").eqNullSafe(F.col("__of")), "left")
    return whole.select(F.col("__id").alias(id_col), "code", "error", "label_error", F.lit(books_sha256(books)).alias("codebooks_sha256"))


def oracle(source: str = "embeddings", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """DuckDB SQL of ``compress``: one row per component, each round a step of common tables."""
    steps = [
        f"""kept AS (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST) AS place, vec_id, label, embedding, len(embedding) // {parts} AS width FROM {source}
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""xs AS MATERIALIZED (SELECT place, (k - 1) // width AS part, (k - 1) % width AS pos, CAST(floor({SCALE} * CAST(embedding[k] AS DOUBLE)) AS BIGINT) AS x
  FROM (SELECT place, width, embedding, unnest(range(1, len(embedding) + 1)) AS k FROM kept))""",
        f"b0 AS (SELECT part, place - 1 AS entry, pos, x AS c FROM xs WHERE place <= {entries})",
    ]
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (SELECT place, part, entry, distance FROM (SELECT place, part, entry, sum((x - c) * (x - c)) AS distance
  FROM xs JOIN b{r} USING (part, pos) GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY place, part ORDER BY distance, entry) = 1)""")
        if r < rounds:
            mean = "CAST(sum(x) AS BIGINT)"
            steps.append(f"""m{r} AS (SELECT part, entry, pos, ({mean} - ((({mean} % count(*)) + count(*)) % count(*))) // count(*) AS c FROM xs JOIN a{r} USING (place, part) GROUP BY part, entry, pos)""")
            steps.append(f"b{r + 1} AS MATERIALIZED (SELECT b.part, b.entry, b.pos, coalesce(m.c, b.c) AS c FROM b{r} b LEFT JOIN m{r} m ON b.part = m.part AND b.entry = m.entry AND b.pos = m.pos)")
    steps.append(f"coded AS (SELECT place, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(distance) AS BIGINT) AS error FROM a{rounds} GROUP BY place)")
    steps.append(f"book AS (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY part, entry, pos)) AS h FROM b{rounds})")
    return "WITH " + ",\n".join(steps) + """
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256 FROM kept JOIN coded USING (place), book"""
