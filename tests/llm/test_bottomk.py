"""Bottom-k fingerprints against exact resemblance and a plain loop over ordered documents."""

import hashlib

import numpy as np
from pyspark.sql import functions as F

from citymotion.llm import bottomk as B
from citymotion.llm.simhash import shingle_hashes


def test_edited_pairs_equal_plain_loop(spark, docs_rows):
    rows = [(i, t) for i, t, _ in docs_rows] + [(-5, None), (10**9, ""), (7, "tie a"), (7, "tie b"), (None, "null id text"), (None, None)]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, n_chars int").repartition(7)
    got = B.edited_pairs(df).collect()
    named = sorted((i, t or "") for i, t in rows if i is not None)
    want = [(i, t, named[(k + 1) % len(named)][1]) for k, (i, t) in enumerate(named)] + [(i, t or "", "") for i, t in rows if i is None]
    expected = []
    for i, t, nxt in want:
        h = len(t) // 2
        e = t[: len(t) - h] + nxt[:h]
        a, b, c = (B.sketch(x) for x in (t, e, nxt))
        expected.append((str(i), len(t), hashlib.sha256(e.encode()).hexdigest(), B.to_string(a), B.to_string(b), B.resemblance(a, b), B.resemblance(a, c)))
    seen = [(str(r["doc_id"]), r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"], r["near_edited"], r["near_next"]) for r in got]
    assert sorted(seen) == sorted(expected)


def test_one_document_and_none(spark):
    df = spark.createDataFrame([(3, "a b c d e f g h")], "doc_id long, text string")
    r = B.edited_pairs(df).collect()
    assert len(r) == 1 and r[0]["near_next"] == 1.0
    assert r[0]["edited_sha256"] == hashlib.sha256(b"a b c d a b c d").hexdigest()
    assert r[0]["n_chars"] == 15
    assert B.edited_pairs(df.limit(0)).count() == 0


def test_estimates(docs_rows):
    rng = np.random.default_rng(1)
    errors = []
    for _ in range(200):
        words = [f"w{x}" for x in rng.integers(0, 5000, 1500)]
        cut = int(rng.integers(200, 1300))
        a, b = " ".join(words), " ".join(words[:cut] + [f"v{x}" for x in rng.integers(0, 5000, 700)])
        x, y = (set(shingle_hashes(t.encode(), 5).tolist()) for t in (a, b))
        sa, sb = B.sketch(a), B.sketch(b)
        assert sa.tolist() == sorted(x)[: B.K]
        errors.append(B.resemblance(sa, sb) - len(x & y) / len(x | y))
        assert abs(B.distinct_count(sa) - len(x)) < 0.5 * len(x)
        assert abs(B.containment(sb, sa) - len(x & y) / len(y)) < 0.35
    assert abs(np.mean(errors)) < 0.02 and np.max(np.abs(errors)) < 0.2


def test_repeats_and_merge(spark):
    text = "a b c d e " * 4000 + " ".join(f"u{i}" for i in range(300))
    whole = np.unique(shingle_hashes(text.encode(), 5))
    assert B.sketch(text).tolist() == whole[: B.K].tolist()
    parts = [" ".join(f"u{i}" for i in range(s, s + 60)) for s in range(0, 600, 55)]
    df = spark.createDataFrame([("k", p, "x") for p in parts] + [("empty", "", "x")], "key string, text string, h string")
    B.small_batches(spark)
    got = {r["key"]: r["fingerprint"] for r in B.merged(df.select("key", B.fingerprint(df["text"]).alias("fingerprint")), ["key"]).collect()}
    want = np.unique(np.concatenate([shingle_hashes(p.encode(), 5) for p in parts]))[: B.K]
    assert B.from_string(got["k"]).tolist() == want.tolist()
    assert B.to_string(B.from_string(got["k"])) == got["k"]


def test_null_ids_are_dealt_over_tasks(spark):
    df = spark.createDataFrame([(None, f"text {k} of a row without id") for k in range(300)] + [(1, "a"), (2, "b")], "doc_id long, text string").coalesce(1)
    out = B.edited_pairs(df)
    rows = out.filter("doc_id IS NULL").groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in rows) == 300 and len(rows) > 1
    assert all(r["near_next"] == 0.0 for r in out.filter("doc_id IS NULL").collect())
