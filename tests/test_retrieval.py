import math

import pytest
from pyspark.sql import functions as F

from lamplight.models import embed, hashing_encoder
from lamplight.operators import retrieval as R

DOCS = [("d1", "rice soil rice"), ("d2", "soil water"), ("d3", "duck"), ("d4", None), ("d5", "")]


def docs(spark):
    return spark.createDataFrame(DOCS, "chunk_id string, text string")


def test_bm25_by_hand(spark):
    got = {r.chunk_id: r.score for r in R.bm25_top(docs(spark), "chunk_id", "text", ["rice", "soil", "rice"]).collect()}
    n, avg = 4, (3 + 2 + 1 + 0) / 4
    idf = lambda df: math.log(1 + (n - df + 0.5) / (df + 0.5))
    w = lambda tf, length: tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length / avg))
    assert got == {"d1": pytest.approx(idf(1) * w(2, 3) + idf(2) * w(1, 3), abs=1e-6), "d2": pytest.approx(idf(2) * w(1, 2), abs=1e-6)}
    assert R.bm25_top(docs(spark), "chunk_id", "text", []).count() == 0
    assert R.bm25_top(docs(spark).where("false"), "chunk_id", "text", ["rice"]).count() == 0


def test_postings(spark):
    got = {(r.term, r.chunk_id): (r.tf, r.len) for r in R.postings(docs(spark), "chunk_id", "text").collect()}
    assert got[("rice", "d1")] == (2, 3) and len(got) == 5


def test_cosine_of_odd_vectors(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [float("nan"), 1.0]), (5, [1.0]), (6, [3.0, 0.0]), (7, [])]
    df = spark.createDataFrame(rows, "id int, v array<float>")
    assert [(r.id, r.similarity) for r in R.dense_top(df, "id", "v", [1.0, 0.0], 5).collect()] == [(1, 1.0), (6, 1.0)]


def test_batches_in_blocks(spark):
    df = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(20)] + [(99, None)], "id int, v array<float>")
    asked = df.withColumnRenamed("id", "q")
    whole = {tuple(r) for r in R.dense_batch(df, "id", "v", asked, "q", 3).collect()}
    assert whole == {tuple(r) for r in R.dense_batch(df, "id", "v", asked, "q", 3, block=4).collect()}
    assert len(whole) == 60


def test_fusion_ties_and_fallback(spark):
    dense = spark.createDataFrame([("a", 0), ("b", 1)], "k string, pos int")
    lexical = spark.createDataFrame([("c", 0), ("b", 1)], "k string, pos int")
    assert [r.k for r in R.fuse(dense, lexical, "k").orderBy("fused_pos").collect()] == ["b", "a", "c"]
    assert [r.k for r in R.fuse(dense.repartition(2), lexical.where("false"), "k").orderBy("fused_pos").collect()] == ["a", "b"]


def test_search_modes(spark):
    encoder = hashing_encoder(32)
    index = embed(docs(spark), "text", encoder)
    assert [r.chunk_id for r in R.search(index, "rice", encoder, k=1).collect()] == ["d1"]
    assert [r.chunk_id for r in R.search(index, "rice", encoder, k=1, reranker=False).collect()] == ["d1"]

    def broken(_):
        raise RuntimeError

    assert [r.chunk_id for r in R.search(index, "rice", encoder, k=1, generator=broken).collect()] == ["d1"]
    assert R.search(index, "rice", encoder, k=1, generator=lambda q: "duck duck").count() == 1
    assert R.search(index, "rice", encoder, k=0).count() == 1


def test_metrics(spark):
    ranks = spark.createDataFrame([(1,), (5,), (6,), (None,)], "rank int")
    r = R.rank_metrics(ranks, []).first()
    assert (r.hit_1, r.hit_k, r.mrr) == (0.25, 0.5, pytest.approx((1 + 1 / 5 + 1 / 6) / 4, abs=1e-6))


def test_passages_and_answers(spark):
    rows = spark.createDataFrame([("s", " a \n b ", 0.12345), ("s", "  ", 1.0), ("s", None, 1.0)], "stem string, text string, score double")
    assert [(r.text, r.score) for r in R.passages(rows).collect()] == [("a b", 0.123)]
    hit = {"stem": "s", "page": 1, "score": 0.5, "text": "rice"}
    assert R.answer([hit], "q", lambda p: "yes", "NONE")["abstained"] is False
    assert R.answer([hit], "q", lambda p: "NONE of it", "NONE") == {"answer": "", "sources": [], "abstained": True}
    assert R.answer([{**hit, "text": " "}], "q", lambda p: 1 / 0, "NONE") == {"answer": "", "sources": [], "abstained": True}
    assert R.render([hit, hit], "q") == "Top 2 passage(s) for: q\n\n[1] s (p.1, score 0.50)\nrice\n\n[2] s (p.1, score 0.50)\nrice\n"
    array = spark.createDataFrame([([("s", 2, "t")],)], "p array<struct<stem: string, page: int, text: string>>")
    assert array.select(R.context(F.col("p")).alias("c")).first().c == "[1] (source: s, p.2)\nt"


def test_kept_index_equals_the_scan(spark, tmp_path):
    kept = R.TextIndex.build(docs(spark), "chunk_id", "text", str(tmp_path / "t"), buckets=4)
    for terms in (["rice", "soil", "rice"], ["water"], ["none"], []):
        assert kept.top(terms).collect() == R.bm25_top(docs(spark), "chunk_id", "text", terms).collect()
    assert {(r.term, r.df, r.cf) for r in kept.terms().collect()} == {("rice", 1, 2), ("soil", 2, 2), ("water", 1, 1), ("duck", 1, 1)}
    plan = kept.top(["rice"])._jdf.queryExecution().executedPlan().toString()
    assert "bucket" in plan.split("PartitionFilters")[1][:80]
    empty = R.TextIndex.build(docs(spark).where("false"), "chunk_id", "text", str(tmp_path / "e"), buckets=4)
    assert empty.top(["rice"]).count() == 0


def test_injected_reranker_and_kept_index(spark, tmp_path):
    encoder = hashing_encoder(32)
    index = embed(docs(spark), "text", encoder)
    kept = R.TextIndex.build(index, "chunk_id", "text", str(tmp_path / "t"), buckets=2)
    short = lambda query, texts: [1 / (1 + len(t)) for t in texts]
    assert [r.chunk_id for r in R.search(index, "rice soil", encoder, k=1, kept=kept).collect()] == ["d1"]
    assert [(r.chunk_id, r.score) for r in R.search(index, "rice soil", encoder, k=1, reranker=short, kept=kept).collect()] == [("d3", 0.2)]
    assert [r.chunk_id for r in R.search(index, "rice", encoder, k=1, reranker=lambda q, t: 0.5 if len(t) == 1 else [0.5] * len(t)).collect()] == ["d1"]
    gone = R.TextIndex(spark, str(tmp_path / "none"), "chunk_id")
    assert R.search(index, "rice", encoder, k=1, kept=gone).count() == 1  # the dense list stands


def test_search_messages_and_status(spark):
    encoder = hashing_encoder(32)
    index = embed(docs(spark), "text", encoder).selectExpr("*", "'s' as stem", "1 as page")
    assert R.search_message(None, "rice", encoder) == R.NO_INDEX and R.search_message(index, "rice", None) == R.NO_MODEL
    assert R.search_message(index.where("false"), "rice", encoder) == R.NO_HIT + "rice"
    assert R.search_message(index, "rice", encoder, k=1) == "Top 1 passage(s) for: rice\n\n[1] s (p.1, score 1.00)\nrice soil rice\n"
    assert R.status(index, encoder) == {"ok": True, "index_ready": True, "embedder_ready": True, "reranker_ready": False, "docs": 5}
    assert R.status(None)["ok"] is False


def test_snapshot_keeps_the_last_table_on_failure():
    now, tables = [0.0], iter(["a", "b"])
    snapshot = R.Snapshot(lambda: next(tables), 15, lambda: now[0])
    assert snapshot() == "a"
    now[0] = 14.0
    assert snapshot() == "a"
    now[0] = 15.0
    assert snapshot() == "b"
    now[0] = 40.0
    assert snapshot() == "b"  # reading fails


def test_dense_batch_of_odd_vectors(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [float("nan"), 1.0]), (5, [1.0]), (6, [3.0, 0.0]), (7, []), (8, [0.0, 2.0]), (None, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "id int, v array<float>")
    got = {(r.q, r.id, r.similarity, r.rank) for r in R.dense_batch(df, "id", "v", df.withColumnRenamed("id", "q"), "q", 2).collect()}
    assert got == {(1, 6, 1.0, 1), (1, 8, 0.0, 2), (6, 1, 1.0, 1), (6, 8, 0.0, 2), (8, 1, 0.0, 1), (8, 6, 0.0, 2)}
    assert R.dense_batch(df, "id", "v", df.where("false").withColumnRenamed("id", "q"), "q", 2).count() == 0
    named = df.selectExpr("concat('r', id) as id", "v")
    assert R.dense_batch(named, "id", "v", named.withColumnRenamed("id", "q"), "q", 1, block=2, block_bytes=8).count() == 3
