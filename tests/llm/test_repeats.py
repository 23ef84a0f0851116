"""Repeated strings against brute force over all strings of the length."""

import hashlib
import random
import time

import numpy as np
import pytest

from citymotion.llm import repeats as R


def plain(texts, length, keep):
    places = {}
    for k, t in enumerate(texts):
        for s in range(len(t) - length + 1):
            places.setdefault(t[s : s + length], []).append((k, s))
    gone = [np.zeros(len(t), bool) for t in texts]
    for found in places.values():
        for k, s in found[(0 if keep == "none" else 1) :] if len(found) > 1 else ():
            gone[k][s : s + length] = True
    out = []
    for t, g in zip(texts, gone):
        left = bytes(b for b, x in zip(t, g) if not x)
        out.append((len(t), int(g.sum()), int((np.diff(np.concatenate(([0], g.astype(int)))) == 1).sum()), hashlib.sha256(left).hexdigest()))
    return out


def corpus():
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randrange(2, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage, other = text(70), text(45)
    texts = [text(120) for _ in range(12)]
    texts += [text(30) + passage + text(25) for _ in range(14)] + [text(5) + other + passage[:260] + text(9) for _ in range(6)]
    texts += [texts[0], texts[0], texts[1][:300], texts[2][50:] + texts[3], passage, passage[:200], passage[:199], passage[7:207]]
    words = texts[4].split()
    texts += [" ".join(words[:60] + ["CHANGED"] + words[61:])]
    texts += ["x" * 199, "x" * 500, "ab" * 300, "x" * 700 + text(20), "line one two three\n" * 40, "", text(3), passage + passage, "q" * 200, "q" * 200]
    return texts


CASES = [("none", 2048, 200), ("none", 2, 200), ("first", 2048, 200), ("first", 2, 200), ("none", 2048, 24), ("first", 2048, 24), ("none", 2048, 400), ("first", 2048, 400)]


@pytest.mark.parametrize("keep,crowded,length", CASES)
def test_equals_brute_force(spark, keep, crowded, length):
    texts = corpus()
    rows = [(None if k == 3 else 7 if k in (8, 9) else k, t if t else None, "x") for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, rid string").coalesce(1)
    got = R.without_repeats(df, length=length, keep=keep, crowded=crowded).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept").collect()
    want = plain([t.encode() for t in texts], length, keep)
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == sorted((str(rows[k][0]), *w) for k, w in enumerate(want))
    assert all(hashlib.sha256(bytes(r["kept"])).hexdigest() == r["kept_sha256"] for r in got)


def test_driver_documents(spark, docs_rows):
    df = spark.createDataFrame([(i, t) for i, t, _ in docs_rows], "doc_id long, text string")
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in R.without_repeats(df).drop("kept").collect()}
    assert got == dict(zip([i for i, _, _ in docs_rows], plain([t.encode() for _, t, _ in docs_rows], 200, "none")))
    assert R.without_repeats(df.limit(0)).count() == 0


def test_suffix_ranks_and_previous_factors():
    rng = np.random.default_rng(2)
    data = rng.integers(97, 99, 3000).astype(np.uint8)
    raw = data.tobytes()
    for length in (24, 25, 60, 200):
        starts = np.arange(len(raw) - length + 1)
        rank = R.suffix_ranks(data, starts, length)
        text = [raw[s : s + length] for s in starts]
        order = {t: k for k, t in enumerate(sorted(set(text)))}
        assert rank.tolist() == [order[t] for t in text]


def common(a, b, length):
    n = 0
    while n < length and a[n] == b[n]:
        n += 1
    return n


def test_longest_previous_factors_equal_all_pairs():
    rng = np.random.default_rng(3)
    data = rng.integers(97, 99, 260).astype(np.uint8)
    data[150:220] = data[20:90]
    raw = data.tobytes()
    for length in (8, 24, 41, 60):
        n = len(raw) - length + 1
        starts, order = np.arange(n), rng.permutation(n) * 3
        previous, match = R.longest_previous(data, starts, order, length)
        pairs = np.array([[common(raw[i : i + length], raw[j : j + length], length) if i != j else 0 for j in range(n)] for i in range(n)])
        earlier = order[None, :] < order[:, None]
        assert previous.tolist() == np.where(earlier, pairs, 0).max(axis=1).tolist()
        assert all(m == -1 if p == 0 else earlier[i, m] and pairs[i, m] == p for i, (p, m) in enumerate(zip(previous, match)))
        cut, match = R.longest_previous(data, starts, order, length, least=length)
        assert cut.tolist() == np.where(previous == length, length, 0).tolist()
        assert all(m == -1 if p == 0 else earlier[i, m] and pairs[i, m] == p for i, (p, m) in enumerate(zip(cut, match)))
        assert R.previous_factors(raw, length).tolist() == [max((common(raw[i : i + length], raw[j : j + length], length) for j in range(i)), default=0) for i in range(n)]
    assert R.previous_factors(b"short", 8).tolist() == []


def test_ranks_keep_to_their_bits(monkeypatch):
    monkeypatch.setattr(R, "RANKS", 1000)
    with pytest.raises(ValueError):
        R.suffix_ranks(np.zeros(800, np.uint8), np.arange(10), 100)
    with pytest.raises(ValueError):
        R.gram_of(7)


def test_chunks_of_one_group(spark, monkeypatch):
    monkeypatch.setattr(R, "CHUNK", 1)
    texts = [t.encode() for t in corpus()]
    df = spark.createDataFrame([(k, t.decode()) for k, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in R.without_repeats(df, keep="first").collect()}
    assert got == dict(enumerate(plain(texts, 200, "first")))


def test_segments_of_very_long_texts(monkeypatch):
    rng = random.Random(4)
    data = "".join(rng.choice("ab ") for _ in range(5000)).encode() + b"z" * 900
    whole = R.owners(R.gram_hashes(np.frombuffer(data, np.uint8)), 200)
    monkeypatch.setattr(R, "SEGMENT", 137)
    assert R.owners(R.gram_hashes(np.frombuffer(data, np.uint8)), 200).tolist() == whole.tolist()


def test_steps_leave_no_shuffle_files(spark):
    """Before the result is read, nothing that an earlier step shuffled is on disk."""

    def files():
        return set(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n"))

    def left():
        return {f for f in files() - before if "/shuffle_" in f}

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    held = spark.conf.get(key, None)
    df = spark.createDataFrame([(k, t) for k, t in enumerate(corpus())], "doc_id long, text string").coalesce(1)
    before = files()
    result = R.without_repeats(df)
    for _ in range(50):  # they are removed in the background
        if not left():
            break
        time.sleep(0.1)
    assert not left()
    assert spark.conf.get(key, None) == held
    assert result.count() == len(corpus())
