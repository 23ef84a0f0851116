"""Registered queries against their SQL, and the pipeline stage by stage."""

import duckdb

import corpus_pipeline as P
from citymotion.llm import bpe, mixing, quality, queries, secret_scan, simhash
from tools.check_oracle import TABLES, rows

SF = "/root/testdata/sf0.001"


def test_queries_match_sql(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    assert sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES) == list(range(1, 14))
    for name, sql in queries.ORACLE.items():
        assert rows(queries.QUERIES[name](spark, SF).toPandas()) == rows(con.execute(sql).df()), name


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in P.STAGES] == ["quality_rules", "simhash_near_dedup", "secret_scans", "source_mixing", "byte_level_bpe"]
    every = {r["doc_id"]: r for r in docs.collect()}
    kept = P.written(P.quality_rules(spark, docs, SF), "t")
    good = {r["doc_id"] for r in quality.with_quality(docs).filter("kept").collect()}
    assert {r["doc_id"] for r in kept.collect()} == good and kept.columns == docs.columns
    first = P.written(P.simhash_near_dedup(spark, kept, SF), "t")
    groups = simhash.near_duplicates(kept).collect()
    assert sorted(r["doc_id"] for r in first.collect()) == sorted({r["component_id"] for r in groups})
    clean = P.written(P.secret_scans(spark, first, SF), "t")
    spans = {r["doc_id"]: r["spans"] for r in secret_scan.report(first).collect()}
    for r in clean.collect():
        if not spans[r["doc_id"]]:
            assert r["text"] == every[r["doc_id"]]["text"]
        else:
            a, z = map(int, spans[r["doc_id"]].split(",")[0].split(":")[1:])
            assert every[r["doc_id"]]["text"][a:z] not in r["text"] and r["n_chars"] == len(r["text"])
    assert clean.count() == first.count() and clean.columns == docs.columns
    mixed = P.written(P.source_mixing(spark, clean, SF), "t")
    chosen = {r["doc_id"] for r in mixing.report(clean).filter("sampled").collect()}
    assert {r["doc_id"] for r in mixed.collect()} == chosen and mixed.columns == docs.columns
    last = P.byte_level_bpe(spark, mixed, SF)
    own = bpe.with_digests(mixed).select("doc_id", "ids_sha256").collect()
    assert sorted((r["doc_id"], r["ids_sha256"]) for r in last.collect()) == sorted(map(tuple, own))
    whole = P.run(spark, SF)
    assert sorted(r["doc_id"] for r in whole.collect()) == sorted(chosen)


def test_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in P.STAGES:
        docs = P.written(stage(spark, docs, SF), name)
        assert docs.count() == 0
