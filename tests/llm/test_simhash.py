"""SimHash fingerprints, links and groups against brute force."""

import random
import re

import pytest
import xxhash

from citymotion.llm import simhash as S
from citymotion.llm.components import components


def plain_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not w:
        return 0
    sh = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(prints, bits=2):
    """Smallest id per group, by comparing all pairs."""
    ids = sorted(i for i, _ in prints)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a) in enumerate(prints):
        for j, b in prints[:k]:
            if (a ^ b).bit_count() <= bits:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_documents(spark, docs_rows):
    rows = [(i, t) for i, t, _ in docs_rows] + [(900, None), (901, ""), (902, " \n"), (903, "Ab"), (904, "aB"), (905, "É a\x1cb"), (906, "w " * 40_000)]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows] + [(None, "null id", "x")], "doc_id long, text string, fp string")
    got = S.near_duplicates(df).collect()
    prints = [(i, plain_fingerprint(t)) for i, t in rows]
    assert {r["doc_id"]: r["fp"] for r in got if r["doc_id"] is not None} == {i: signed(p) for i, p in prints}
    assert {r["doc_id"]: r["component_id"] for r in got if r["doc_id"] is not None} == groups(prints)
    assert [r["component_id"] for r in got if r["doc_id"] is None] == [None]
    first = S.keep_first(df)
    assert first.columns == df.columns
    assert sorted(r["doc_id"] for r in first.collect() if r["doc_id"] is not None) == sorted(set(groups(prints).values()))
    assert S.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("crowded", [0, 3, 64])
def test_links_connect_what_brute_force_connects(spark, crowded):
    rng = random.Random(7)
    seeds = [rng.getrandbits(64) for _ in range(40)]
    prints = {rng.getrandbits(64) for _ in range(150)} | set(seeds) | {0, (1 << 64) - 1}
    for s in seeds:
        for _ in range(12):
            x = s
            for b in rng.sample(range(64), rng.randrange(1, 5)):
                x ^= 1 << b
            prints.add(x)
    family = rng.getrandbits(64)  # many under one 32-bit value
    prints |= {family ^ (rng.getrandbits(12) << 20) for _ in range(200)}
    rows = sorted((signed(p), p) for p in prints)
    df = spark.createDataFrame([(i,) for i, _ in rows], "fp long")
    links = S.near_links(df, crowded=crowded)
    value = dict(rows)
    assert all((value[r["a"]] ^ value[r["b"]]).bit_count() <= 2 for r in links.collect())
    got = {r["node"]: r["root"] for r in components(links).collect()}
    assert {i: got.get(i, i) for i, _ in rows} == groups(rows)


def test_long_chain_and_star(spark):
    chain = [(i, i + 1) for i in range(300)] + [(1000, 1000 + k) for k in range(1, 400)] + [(5000, 5000), (7, 6)]
    df = spark.createDataFrame(chain, "a long, b long")
    got = {r["node"]: r["root"] for r in components(df).collect()}
    assert got == {**{i: 0 for i in range(1, 301)}, **{1000 + k: 1000 for k in range(1, 400)}}


def test_odd_radius_is_refused(spark):
    with pytest.raises(ValueError):
        S.near_links(spark.range(3).selectExpr("id AS fp"), max_bits=3)


def test_each_text_of_a_repeated_id_counts(spark):
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    near, far, other = (" ".join(random.Random(k).choices(words, k=60)) for k in (1, 2, 3))
    rows = [(3, near, "a"), (7, near, "b"), (7, far, "c"), (7, other, "d"), (7, other, "d"), (8, other, "e")]
    assert all((plain_fingerprint(a) ^ plain_fingerprint(b)).bit_count() > 2 for a, b in ((near, far), (near, other), (far, other)))
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "doc_id long, text string, source string").repartition(3)
        first = S.keep_first(df)
        assert first.columns == df.columns
        assert sorted(map(tuple, first.collect())) == sorted([(3, near, "a"), (7, far, "c"), (7, other, "d")])


def test_the_row_that_stays_does_not_depend_on_partitions(spark):
    words = "one two three four five six seven"
    rows = [(1, words, s, {"k": s}) for s in ("b", "a", "c")] + [(2, words, "z", None), (3, "other text of its own here", "y", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, tags map<string,string>")
    for n in (1, 3, 7):
        kept = sorted((r["doc_id"], r["source"]) for r in S.keep_first(df.repartition(n, "source")).collect())
        assert kept == [(1, "a"), (3, "y")]
    one = spark.createDataFrame([(1, "x"), (1, "x"), (None, None)], "doc_id long, text string")
    assert S.keep_first(one).count() == 2


def test_exploded_balls_are_not_broadcast(spark, tmp_path):
    """A table of prints under the broadcast limit is far over it once each print is 34 rows."""
    spark.createDataFrame([(i,) for i in range(100)], "fp long").write.parquet(str(tmp_path / "fp"))
    plan = S.near_links(spark.read.parquet(str(tmp_path / "fp")))._jdf.queryExecution().sparkPlan()
    built, todo = [], [plan]
    while todo:
        node = todo.pop()
        children = [node.children().apply(i) for i in range(node.children().size())]
        todo += children
        if node.nodeName() == "BroadcastHashJoin":
            built.append(children[0 if node.buildSide().toString() == "BuildLeft" else 1].toString())
    assert built and not [b for b in built if "Generate" in b]
