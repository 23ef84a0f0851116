"""Importance resampling against a plain loop over dictionaries."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from citymotion.llm import resample as R

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def features(text, n):
    w = words_of(text)
    return [" ".join(w[i : i + k]) for k in range(1, n + 1) for i in range(len(w) - k + 1)]


def plain(docs, target, n=1, buckets=R.BUCKETS):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = Counter(bucket(f) for _, x in docs for f in features(x, n)), Counter(bucket(f) for x in target for f in features(x, n))
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets))))
    rows = []
    for i, x in docs:
        f = features(x, n)
        weight = sum(gain(bucket(g)) for g in f)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words_of(x))))
    able = sorted((r for r in rows if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    out = [(*r[:4], k + 1 if k < len(able) * 10 // 100 else None) for k, r in enumerate(able)] + [(*r[:4], None) for r in rows if r[4] < 20]
    return sorted(out, key=str)


def corpus(seed, n):
    rnd = random.Random(seed)
    vocabulary = ["alpha", "Beta", "ΓΔ", "Ärger", "x1", "7", "lang" * 30, "q"] + [f"w{i}" for i in range(60)]
    text = lambda k: "".join(rnd.choice(vocabulary) + rnd.choice([" ", ", ", "\n", "-", " "]) for _ in range(k))
    docs = [(i, text(rnd.choice([3, 19, 20, 60, 200]))) for i in range(n)]
    docs += [(None, text(40)), (n + 1, None), (n + 2, ""), (n + 3, " !? ")] + [(5, docs[5][1])] * 40
    return docs, [text(30) for _ in range(6)] + [None, "alpha alpha alpha"]


@pytest.mark.parametrize("n", [1, 2])
def test_report_equals_plain_loop(spark, n):
    docs, target = corpus(3, 150)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    aim = spark.createDataFrame([(x,) for x in target], "text string")
    assert sorted((tuple(r) for r in R.report(df, aim, n=n).collect()), key=str) == plain(docs, target, n)


@pytest.mark.parametrize("n", [1, 2, 4])
def test_pieces_of_a_long_text_lose_no_feature(n):
    docs, _ = corpus(4, 20)
    long = " ".join(x or "" for _, x in docs)
    texts = [x.encode() for x in (long, "", "one", long[:500], "z" * 3000, "a " * 400)]
    gains = np.arange(R.BUCKETS, dtype=np.int64) % 17 - 8
    want = [features(x.decode(), n) for x in texts]
    for size in (1, 50, 997, 1 << 20):
        counts = R.bucket_counts(texts, n, size=size)
        assert counts.tolist() == np.bincount([zlib.crc32(f.encode()) % R.BUCKETS for fs in want for f in fs], minlength=R.BUCKETS).tolist()
        words, number, weight = R.weighted(texts, gains, n, size)
        assert words.tolist() == [len(words_of(x.decode())) for x in texts]
        assert number.tolist() == [len(fs) for fs in want]
        assert weight.tolist() == [sum(int(gains[zlib.crc32(f.encode()) % R.BUCKETS]) for f in fs) for fs in want]


def test_equal_keys_with_other_bytes_get_slots_of_their_own(monkeypatch):
    import xxhash

    data = b"same same other oth other " + b"k" * 200 + b" " + b"k" * 199 + b"j " + b"k" * 200 + b" "
    ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 32)
    starts = np.concatenate(([0], ends[:-1] + 1))
    plain_words = data.split()
    for key in (xxhash.xxh64_intdigest, lambda b: 7, lambda b: len(b)):
        monkeypatch.setattr(xxhash, "xxh64_intdigest", key)
        table = R.Interned(data, starts, ends, 100)
        assert len(table.used) == len(set(plain_words))
        for i, w in enumerate(plain_words):
            assert table.count[table.slot[i]] == plain_words.count(w) and table.bucket[table.slot[i]] == zlib.crc32(w) % 100


def test_empty_tables_and_clashing_columns(spark):
    docs, target = corpus(5, 60)
    df = spark.createDataFrame([(i, x, "r", 3) for i, x in docs], "doc_id long, text string, rank string, lang int")
    aim = spark.createDataFrame([(x,) for x in target], "text string")
    assert R.report(df.limit(0), aim).count() == 0
    drawn = R.resample(df, aim)
    assert drawn.columns == ["doc_id", "text", "lang", "rank"]
    want = sorted(r[4] for r in plain(docs, target) if r[4])
    assert sorted(r["rank"] for r in drawn.collect()) == want and want
    without = sorted((tuple(r) for r in R.report(df, aim.limit(0)).collect()), key=str)
    assert without == plain(docs, [])
