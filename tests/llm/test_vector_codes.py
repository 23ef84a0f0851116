"""Integer product quantisation against exact Python integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from citymotion.llm import vector_codes as V


def plain(rows, parts, entries, rounds):
    """{place: (id, code, error, label_error)} and the books' digest, with Python integers."""
    kept = [(i, [math.floor(4096 * x) for x in v], g) for i, v, g in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, np.array(r[1], "<i4").tobytes().hex()))
    width = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(v, p) for _, v, _ in kept[:entries]] for p in range(parts)]
    distance = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    assign = lambda v, p: min(range(len(books[p])), key=lambda e: (distance(cut(v, p), books[p][e]), e))
    for _ in range(rounds):
        new = []
        for p in range(parts):
            members = {}
            for _, v, _ in kept:
                members.setdefault(assign(v, p), []).append(cut(v, p))
            new.append([[sum(c) // len(c) for c in zip(*members[e])] if e in members else books[p][e] for e in range(len(books[p]))])
        books = new
    out, by_label = [], {}
    for i, v, g in kept:
        code = [assign(v, p) for p in range(parts)]
        error = sum(distance(cut(v, p), books[p][c]) for p, c in enumerate(code))
        by_label[g] = by_label.get(g, 0) + error
        out.append((i, "".join(f"{c:02x}" for c in code), error, g))
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i, c, e, by_label[g], digest) for i, c, e, g in out), key=str)


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string").repartition(3)
    return sorted((tuple(r) for r in V.compress(df, **options).collect()), key=str)


@pytest.mark.parametrize("entries", [2, 16])
def test_codes_equal_exact_integers(spark, entries):
    rnd = random.Random(5)
    rows = [(i, [rnd.gauss(0, 1) for _ in range(16)], rnd.choice(["a", "b", None])) for i in range(120)]
    rows += [(200, None, "a"), (201, [1.0] * 15 + [None], "a"), (202, [float("nan")] + [0.0] * 15, None), (203, [float("inf")] * 16, "c"), (204, [], "c")]
    rows += [(None, [0.5] * 16, "b"), (7, rows[7][1], "a"), (7, [0.25] * 16, "hot")] + [(i, rows[0][1], "hot") for i in range(300, 360)]
    assert run(spark, rows, entries=entries) == plain(rows, 8, entries, 6)


def test_large_integers_take_several_limbs_and_stay_exact(spark):
    rnd = random.Random(6)
    rows = [(i, [rnd.uniform(-16000, 16000) for _ in range(8)], "x") for i in range(60)]
    assert run(spark, rows, parts=2, entries=5, rounds=3) == plain(rows, 2, 5, 3)


def test_products_are_exact_at_the_limit():
    rnd = np.random.default_rng(1)
    for width in (1, 8, 96, 768):
        most = V.limit(width)
        x, c = rnd.integers(-most, most + 1, (50, width)), rnd.integers(-most, most + 1, (9, width))
        x[0], c[0], x[1], c[1] = most, most, -most, -most
        want = [[sum(int(a) * int(b) for a, b in zip(p, q)) for q in c] for p in x]
        assert V.dot(x, c).tolist() == want
        assert 2 * V.limb_bits(width) + (width - 1).bit_length() <= 53
        code, d = V.nearest(x, c)
        exact = [[sum((int(a) - int(b)) ** 2 for a, b in zip(p, q)) for q in c] for p in x]
        assert d.tolist() == [min(e) for e in exact] and code.tolist() == [e.index(min(e)) for e in exact]


def test_ties_go_to_the_lower_index():
    code, d = V.nearest(np.array([[0, 0], [2, 0]]), np.array([[1, 0], [-1, 0], [1, 0], [3, 0]]))
    assert code.tolist() == [0, 0] and d.tolist() == [1, 1]


def test_refused_inputs_and_empty_table(spark):
    schema = "vec_id long, embedding array<double>, label string"
    assert V.compress(spark.createDataFrame([(1, None, "a")], schema)).count() == 0
    for bad in ([(1, [1.0] * 8, "a"), (2, [1.0] * 16, "a")], [(1, [1.0] * 9, "a")], [(1, [1e300] * 8, "a")]):
        with pytest.raises(Exception, match="vectors of|beyond"):
            V.compress(spark.createDataFrame(bad, schema)).count()


def test_decoded_vectors_are_as_far_as_the_error_says(spark):
    rnd = random.Random(8)
    rows = [(i, [rnd.choice([-1.0, 1.0]) + rnd.gauss(0, 0.05) for _ in range(16)], None) for i in range(200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    ints = V.integers(df, "vec_id", "embedding", None)
    books = V.train(ints)
    coded = V.encode(ints, books).collect()
    got = V.decode([r["code"] for r in coded], books)
    for r, v in zip(coded, got):
        x = np.floor(4096 * np.array(rows[r["__id"]][1]))
        assert round(float(((x - v * 4096) ** 2).sum())) == r["error"]
