"""Shards and global prefix sums against a plain loop."""

import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from citymotion.llm import sharding as S
from citymotion.llm.prefix import BEFORE, ROW, with_prefix


def plain(rows, shards):
    """{(id, size, crc, shard, slot): n} by one loop over the sorted rows."""
    measured = sorted(((i is not None, i or 0, i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows))
    total, at, slots, out = sum(m[3] for m in measured), 0, defaultdict(int), []
    for _, _, i, size, crc in measured:
        shard = (2 * at + size) * shards // (2 * total)
        out.append((i, size, crc, shard, slots[shard]))
        slots[shard] += 1
        at += size
    return sorted(out, key=str)


def got(df, shards):
    rows = S.assigned(df, shards).collect()
    assert all(r["law"] == "bytes" and r["grown_shard"] is None for r in rows)
    return sorted(((r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["slot"]) for r in rows), key=str)


ODD = [(None, "no id"), (None, None), (3, "x" * 50_000), (3, "y"), (3, "y"), (1, ""), (2, None), (9, "é" * 100), (-4, "\x00 nul"), (7, "a\nb")]


@pytest.mark.parametrize("shards", [1, 3, 40])
def test_odd_rows(spark, shards):
    df = spark.createDataFrame(ODD, "doc_id long, text string").withColumns({"shard": F.lit("mine"), "size": F.lit(-1), "__size": F.lit(5)})
    assert got(df, shards) == plain(ODD, shards)
    assert S.assigned(df.limit(0)).count() == 0
    assert S.assigned(df).columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]


def test_partitions_do_not_matter_and_shards_are_balanced(spark):
    rows = [(i * 7 % 1000, "w" * (i * i % 977)) for i in range(1000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = plain(rows, 40)
    assert got(df.repartition(1), 40) == want == got(df.repartition(13), 40)
    sums, ids = defaultdict(int), defaultdict(list)
    for i, size, _, shard, _ in want:
        sums[shard] += size
        ids[shard].append(i)
    assert max(sums.values()) - min(sums.values()) <= 2 * (977 + 16)
    assert all(max(ids[k]) < min(ids[k + 1]) for k in range(39))


def test_an_id_with_most_rows_is_spread_over_ranges(spark):
    df = spark.range(20_000).select(F.when(F.col("id") % 10 < 8, 5).otherwise(F.col("id")).alias("k"))
    placed, n, total = with_prefix(df, [F.col("k")], F.lit(3))
    assert (n, total) == (20_000, 60_000)
    rows = placed.orderBy(ROW).collect()
    assert [r[ROW] for r in rows] == list(range(20_000)) and [r[BEFORE] for r in rows] == list(range(0, 60_000, 3))
    assert [r["k"] for r in rows] == sorted(r["k"] for r in rows)
    tied = df.withColumn("__tie", F.monotonically_increasing_id()).repartitionByRange(8, "k", "__tie")
    assert max(r["count"] for r in tied.groupBy(F.spark_partition_id()).count().collect()) < 20_000 / 4


def test_written_shards_hold_the_documents_in_order(spark, tmp_path):
    rows = [(i, f"text {i} " * (i % 9)) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"lang": F.lit("en"), "slot": F.lit("old")})
    S.write_shards(df, str(tmp_path / "shards"), 7)
    back = spark.read.parquet(str(tmp_path / "shards"))
    places = {r["doc_id"]: (r["shard"], r["slot"]) for r in S.assigned(df, 7).collect()}
    read = back.collect()
    assert {r["doc_id"]: (r["shard"], r["slot"]) for r in read} == places
    assert {(r["doc_id"], r["text"], r["lang"]) for r in read} == {(i, t, "en") for i, t in rows}
    for k in range(7):
        slots = [r["slot"] for r in read if r["shard"] == k]
        assert sorted(slots) == list(range(len(slots)))


def test_totals_beyond_64_bits_of_products(spark):
    row = spark.range(1).select(S.shard_of(F.lit(10**17), F.lit(10**9), 2 * 10**17, 100_000).alias("s")).first()
    assert row["s"] == (2 * 10**17 + 10**9) * 100_000 // (4 * 10**17)
