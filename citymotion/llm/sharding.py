"""Contiguous shards of balanced bytes by global prefix sums (operator 11).

Documents are ordered by id; a document's size is its UTF-8 bytes plus ``OVERHEAD``.  The sum
of the sizes before it comes from per-partition totals (``prefix``); the whole is cut at
equal targets i * total / shards, and a document belongs to the side of a cut on which its
middle lies.  So a shard is off its target by less than the longest document, whatever the
sizes are, and shards follow one another in id order.  A shard between two cuts that one
very long document spans is empty.

Shards of equal bytes split a group of equal texts where a cut falls into it: a group with
a third of all bytes can't be in one shard of a fortieth.

``assigned`` gives the places without moving texts; ``write_shards`` writes the documents
into one folder per shard, in slot order.

Defined results: null text has no bytes (CRC-32 of nothing: 0); null ids come first; rows
with equal ids are ordered by size, CRC-32 and text hash; rows equal in all are
interchangeable; an empty table gives no rows; columns of the input named like a result
column (or starting with ``__``) are left out of ``assigned`` and replaced in ``write_shards``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citymotion.llm.common import written
from citymotion.llm.prefix import BEFORE, ROW, with_prefix

SHARDS = 40
OVERHEAD = 16
LAW = "bytes"


def size_of(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long")


def crc_of(text: Column) -> Column:
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def shard_of(before: Column, size: Column, total: int, shards: int) -> Column:
    """The shard whose interval of [0, ``total``) holds the middle of [before, before + size)."""
    middle = (before * 2 + size).cast("decimal(20,0)") * F.lit(shards).cast("decimal(10,0)")
    return F.floor(middle / F.lit(2 * max(total, 1)).cast("decimal(20,0)")).cast("int")


def _placed(rows: DataFrame, id_col: str, shards: int) -> DataFrame:
    """``rows`` (with ``__size``, ``__crc``, ``__hash``) and their ``shard`` and ``slot``."""
    placed, _, total = with_prefix(rows, [F.col(id_col), F.col("__size"), F.col("__crc"), F.col("__hash")], F.col("__size"))
    placed = placed.withColumn("shard", shard_of(F.col(BEFORE), F.col("__size"), total, shards))
    first = placed.groupBy("shard").agg(F.min(ROW).alias("__first"))  # at most ``shards`` rows
    return placed.join(F.broadcast(first), "shard").withColumn("slot", F.col(ROW) - F.col("__first"))


def _measured(docs: DataFrame, text_col: str) -> dict[str, Column]:
    return {"__size": size_of(F.col(text_col)), "__crc": crc_of(F.col(text_col)), "__hash": F.xxhash64(text_col)}


def assigned(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, size, text_crc32, law, shard, slot, grown_shard) of each row."""
    rows = written(docs.select(F.col(id_col), *[c.alias(name) for name, c in _measured(docs, text_col).items()]), "sizes")
    return _placed(rows, id_col, shards).select(
        id_col, F.col("__size").alias("size"), F.col("__crc").alias("text_crc32"), F.lit(LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write ``docs`` with ``slot`` below ``path/shard=i``; texts are shuffled once."""
    kept = [c for c in docs.columns if c not in ("shard", "slot") and not c.startswith("__")]
    rows = docs.select(*kept).withColumns(_measured(docs, text_col))
    _placed(rows, id_col, shards).select(*kept, "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


# Fixed value: the reflected polynomial of CRC-32.
CRC_POLYNOMIAL = 0xEDB88320


def crc_parts() -> list[str]:
    """DuckDB: common tables that end in ``crc`` (one row, the list ``t`` of the steps of the 256 bytes)."""
    step = f"CASE WHEN c % 2 = 1 THEN xor(c >> 1, {CRC_POLYNOMIAL}) ELSE c >> 1 END"
    return [
        f"steps AS (SELECT i, 0 AS k, CAST(i AS BIGINT) AS c FROM range(256) r(i) UNION ALL SELECT i, k + 1, {step} FROM steps WHERE k < 8)",
        "crc AS MATERIALIZED (SELECT list(c ORDER BY i) AS t FROM steps WHERE k = 8)",
    ]


def crc_sql(text: str) -> str:
    """DuckDB: unsigned CRC-32 of a string's UTF-8 bytes, beside the table ``crc``."""
    octets = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: CAST('0x' || x AS BIGINT))"
    return f"xor(list_reduce({octets}, lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1]), 4294967295), 4294967295)"


def oracle(source: str = "documents", shards: int = SHARDS) -> str:
    """DuckDB SQL of ``assigned``."""
    parts = crc_parts() + [
        f"sizes AS (SELECT doc_id, CAST(octet_length(encode(coalesce(text, ''))) + {OVERHEAD} AS BIGINT) AS size, {crc_sql("coalesce(text, '')")} AS text_crc32 FROM {source}, crc)",
        """placed AS (SELECT *, sum(size) OVER w - size AS before, row_number() OVER w AS place, sum(size) OVER () AS total FROM sizes
  WINDOW w AS (ORDER BY doc_id NULLS FIRST, size, text_crc32 ROWS UNBOUNDED PRECEDING))""",
        f"cut AS (SELECT *, CAST(((2 * before + size) * {shards}) // (2 * total) AS INTEGER) AS shard FROM placed)",
    ]
    return "WITH RECURSIVE " + ",\n".join(parts) + f"""
SELECT doc_id, size, text_crc32, '{LAW}' AS law, shard, CAST(place - min(place) OVER (PARTITION BY shard) AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM cut"""
