"""Hybrid retrieval: exact cosine search, BM25 over an inverted index, reciprocal rank fusion and reranking."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import numpy as np
import pandas as pd
import pyarrow as pa

from lamplight.functions import text as T
from lamplight.models import Encoder, Generator, Reranker, lexical_score
from lamplight.session import broadcast_if_small, shared_folder
from lamplight.sources.sinks import exists

#: Lengths of the two lists, of the fused one and of the result, and the constant of reciprocal rank fusion.
DENSE, LEXICAL, FUSED, TOP, RRF_K = 30, 30, 24, 5, 60
K1, B = 1.2, 0.75


def terms_of(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit("[a-z0-9]+"), F.lit(0))


def query_terms(query: str) -> list[str]:
    return re.findall("[a-z0-9]+", query.lower())


# --- dense ------------------------------------------------------------------


def dot(a: Column, b: Column) -> Column:
    """The dot product in double precision."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; null for null vectors, vectors of unequal size, and where one has no length or isn't finite."""
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    ok = (F.size(a) == F.size(b)) & (norm > 0) & ~F.isnan(norm)
    return F.when(ok, dot(a, b) / norm)


def dense_top(index: DataFrame, key: str, vector: str, query: list[float], n: int = DENSE) -> DataFrame:
    """(key, similarity, pos): the n rows nearest the query, exactly; ties by key. Planned as one scan and a take-ordered."""
    q = F.array(*(F.lit(float(x)) for x in query))
    hits = index.select(key, F.round(cosine(F.col(vector), q), 6).alias("similarity")).where("similarity is not null").orderBy(F.desc("similarity"), key).limit(n)
    return hits.withColumn("pos", F.row_number().over(Window.orderBy(F.desc("similarity"), key)) - 1)


def _best_of(near: np.ndarray, names: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of similarities (rows by queries) and the rows' names, sorted by name: each query's n highest, ties by name."""
    top = np.argsort(-near, axis=0, kind="stable")[:n]
    return names[top], np.take_along_axis(near, top, axis=0)


def _dense_block(shared, n: int, it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(query, key, similarity): of a task's rows the n most similar to each query, by one matrix product a batch."""
    names, vectors, schema = shared.value
    keys, best = None, None
    lengths = {}
    for i, v in enumerate(vectors):
        lengths.setdefault(len(v), []).append(i)
    units = {size: (np.array(at), _units(np.array([vectors[i] for i in at], np.float64))) for size, at in lengths.items()}
    for batch in it:
        column = batch.column(1)
        first = column.offsets.to_numpy()
        size, flat = np.where(np.asarray(column.is_valid()), np.diff(first), -1), column.values.to_numpy(zero_copy_only=False)
        for length, (at, q) in units.items():
            rows = np.flatnonzero(size == length)
            if not len(rows):
                continue
            u = _units(flat[first[:-1][rows][:, None] + np.arange(length)].astype(np.float64))
            for i in range(0, len(rows), 4096):
                part = rows[i : i + 4096]
                mine = np.array(batch.column(0).take(pa.array(part)).to_pylist(), object)
                order = np.argsort(mine, kind="stable")
                s = np.round(u[i : i + 4096][order] @ q.T, 6)
                s[np.isnan(s) | (mine[order][:, None] == names[at][None, :])] = -np.inf
                near = np.full((len(part), len(names)), -np.inf)
                near[:, at] = s
                k, b = _best_of(near, mine[order], n)
                if keys is not None:
                    k, b = np.concatenate([keys, k]), np.concatenate([best, b])
                    rank = np.argsort(k, axis=0, kind="stable")
                    k, b = np.take_along_axis(k, rank, axis=0), np.take_along_axis(b, rank, axis=0)
                    rank = np.argsort(-b, axis=0, kind="stable")[:n]
                    k, b = np.take_along_axis(k, rank, axis=0), np.take_along_axis(b, rank, axis=0)
                keys, best = k, b
    if keys is not None:
        ok = np.isfinite(best)
        query = np.tile(names, (len(best), 1))
        for i in range(0, int(ok.sum()), 100_000):
            part = slice(i, i + 100_000)
            yield pa.RecordBatch.from_arrays([pa.array(query[ok][part].tolist(), schema[0]), pa.array(keys[ok][part].tolist(), schema[1]), pa.array(best[ok][part])], ["_q", "_k", "similarity"])


def _units(m: np.ndarray) -> np.ndarray:
    """Rows at unit length; those without a finite length become NaN."""
    with np.errstate(invalid="ignore", over="ignore", divide="ignore"):
        norm = np.sqrt((m * m).sum(axis=1, keepdims=True))
        return m / np.where((norm > 0) & np.isfinite(norm), norm, np.nan)


def dense_batch(index: DataFrame, key: str, vector: str, queries: DataFrame, query_key: str, n: int, block: int = 2000, block_bytes: int = 64 << 20) -> DataFrame:
    """(query_key, key, similarity, rank): the n nearest rows of every query, exactly; a query doesn't find the row of its own key.

    The queries go through the index in blocks of at most `block` vectors and block_bytes, each broadcast, so what's broadcast doesn't grow with
    their number or size; vectors are normalised once and compared by matrix products, and of each block and partition at most n rows a
    query are shuffled. Similarities are to six places, ties go by key. Null vectors, and those of another length than a query's, without
    a length or not finite, aren't compared with it.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    spark = index.sparkSession
    rows = index.select(F.col(key).alias("_k"), F.col(vector).cast("array<double>").alias("_v")).where("_k is not null and _v is not null")
    asked = queries.select(F.col(query_key).alias("_q"), F.col(vector).cast("array<double>").alias("_v")).where("_q is not null and _v is not null")
    kinds = [(dict(x.dtypes)[c], to_arrow_type(x.schema[c].dataType)) for x, c in ((asked, "_q"), (rows, "_k"))]
    schema = f"_q {kinds[0][0]}, _k {kinds[1][0]}, similarity double"
    out, names, vectors, size = spark.createDataFrame([], schema), [], [], 0

    def scan() -> DataFrame:
        shared = spark.sparkContext.broadcast((np.array(names, object), vectors, [t for _, t in kinds]))
        return rows.mapInArrow(partial(_dense_block, shared, n), schema)

    for row in asked.toLocalIterator():
        names.append(row._q)
        vectors.append(np.asarray(row._v))
        size += 8 * len(row._v)
        if len(names) >= block or size >= block_bytes:
            out, names, vectors, size = out.unionByName(scan()), [], [], 0
    if names:
        out = out.unionByName(scan())
    best = F.row_number().over(Window.partitionBy("_q").orderBy(F.desc("similarity"), "_k"))
    return out.withColumn("rank", best).where(F.col("rank") <= n).select(F.col("_q").alias(query_key), F.col("_k").alias(key), "similarity", "rank")


# --- full text --------------------------------------------------------------


def postings(index: DataFrame, key: str, text: str) -> DataFrame:
    """(term, key, tf, len): the inverted index, to be kept bucketed by term."""
    words = index.where(F.col(text).isNotNull()).select(key, terms_of(F.col(text)).alias("w"))
    return words.select(key, F.size("w").alias("len"), F.explode("w").alias("term")).groupBy("term", key).agg(F.count("*").alias("tf"), F.first("len").alias("len"))


class TextIndex:
    """The full-text index as kept tables: postings by buckets of their term, term counts, and the number and mean length of the rows.

    build() writes them once (replacing what's at path); top() reads only the buckets of the query's terms, by partition pruning, and
    two small tables, however long the collection. Rows whose text is null don't count.
    """

    def __init__(self, spark: SparkSession, path: str, key: str):
        self.spark, self.path, self.key = spark, path, key

    @classmethod
    def build(cls, index: DataFrame, key: str, text: str, path: str | None = None, buckets: int = 64) -> TextIndex:
        spark = index.sparkSession
        path = path or f"{shared_folder(spark)}/lamplight-text-index-{uuid.uuid4().hex}"
        rows = postings(index, key, text).withColumn("bucket", F.pmod(F.hash("term"), F.lit(buckets)))
        rows.repartition("bucket").sortWithinPartitions("bucket", "term").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/postings")
        size = F.size(terms_of(F.col(text)))
        index.where(F.col(text).isNotNull()).agg(F.count("*").alias("n"), F.avg(size).alias("avg"), F.lit(buckets).alias("buckets"), F.lit(dict(index.dtypes)[key]).alias("kind")).write.mode("overwrite").parquet(f"{path}/totals")
        self = cls(spark, path, key)
        self.postings().groupBy("bucket", "term").agg(F.count("*").alias("df"), F.sum("tf").alias("cf")).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/terms")
        return self

    def postings(self) -> DataFrame:
        kind = self.totals().first().kind
        return self.spark.read.schema(f"term string, `{self.key}` {kind}, tf long, len int, bucket int").parquet(f"{self.path}/postings")

    def terms(self) -> DataFrame:
        return self.spark.read.schema("term string, df long, cf long, bucket int").parquet(f"{self.path}/terms")

    def totals(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/totals")

    def top(self, terms: list[str], n: int = LEXICAL) -> DataFrame:
        """(key, score, pos): the n best rows by BM25, score to six places, ties by key. A repeated term counts once; without terms there are none."""
        terms = list(dict.fromkeys(terms))
        if not terms:
            return self.postings().select(self.key, F.lit(0.0).alias("score"), F.lit(0).alias("pos")).limit(0)
        asked = self.totals().select("buckets", F.explode(F.array(*map(F.lit, terms))).alias("t"))
        buckets = sorted({r[0] for r in asked.select(F.pmod(F.hash("t"), F.col("buckets"))).collect()})
        here = F.col("bucket").isin(buckets) & F.col("term").isin(terms)
        hits = self.postings().where(here).drop("bucket").join(F.broadcast(self.terms().where(here).select("term", "df")), "term").join(F.broadcast(self.totals()))
        return _ranked(hits.select(self.key, _bm25(F.col("tf"), F.col("len"), F.col("df"), F.col("n"), F.col("avg")).alias("part")).groupBy(self.key).agg(F.round(F.sum("part"), 6).alias("score")), self.key, n)


def _bm25(tf: Column, length: Column, df: Column, n: Column, avg: Column) -> Column:
    idf = F.log(1 + (n - df + 0.5) / (df + 0.5))
    return idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / avg))


def _ranked(scored: DataFrame, key: str, n: int) -> DataFrame:
    best = scored.orderBy(F.desc("score"), key).limit(n)
    return best.withColumn("pos", F.row_number().over(Window.orderBy(F.desc("score"), key)) - 1)


def bm25_top(index: DataFrame, key: str, text: str, terms: list[str], n: int = LEXICAL) -> DataFrame:
    """(key, score, pos): the n best rows by BM25 of a collection without a kept index; score to six places, ties by key.

    Texts are read twice, once for the corpus' statistics and once for the rows that hold a term, and nothing but the hits is shuffled; for more
    than a query or two build a TextIndex. Rows without a term don't score; rows whose text is null don't count. A repeated term counts once.
    """
    terms = list(dict.fromkeys(terms))
    if not terms:
        return index.select(key, F.lit(0.0).alias("score"), F.lit(0).alias("pos")).limit(0)
    times = lambda w, term: F.size(F.filter(w, lambda x: x == term))
    counts = lambda w: F.array(*(times(w, t) for t in terms))
    rows = index.where(F.col(text).isNotNull()).select(key, T.let(terms_of(F.col(text)), lambda w: F.struct(F.size(w).alias("len"), counts(w).alias("tf"))).alias("w")).select(key, "w.len", "w.tf")
    tf = lambda i: F.get("tf", F.lit(i))
    stats = rows.agg(F.count("*").alias("n"), F.avg("len").alias("avg"), *(F.count_if(tf(i) > 0).alias(f"df{i}") for i in range(len(terms))))
    scored = rows.where(F.exists("tf", lambda x: x > 0)).join(F.broadcast(stats))
    score = sum((_bm25(tf(i), F.col("len"), F.col(f"df{i}"), F.col("n"), F.col("avg")) for i in range(len(terms))), F.lit(0.0))
    return _ranked(scored.select(key, F.round(score, 6).alias("score")), key, n)


# --- fusion and reranking ---------------------------------------------------


def fuse(dense: DataFrame, lexical: DataFrame, key: str, n: int = FUSED, k: int = RRF_K) -> DataFrame:
    """(key, rrf, fused_pos): reciprocal rank fusion of two lists with zero-based pos; ties keep the order dense list, then lexical list."""
    both = dense.select(key, F.lit(0).alias("src"), "pos").unionByName(lexical.select(key, F.lit(1).alias("src"), "pos"))
    scored = both.groupBy(key).agg(F.round(F.sum(1 / (k + F.col("pos") + 1)), 9).alias("rrf"), F.min(F.struct("src", "pos")).alias("first"))
    order = [F.desc("rrf"), F.col("first.src"), F.col("first.pos")]
    return scored.orderBy(*order).limit(n).withColumn("fused_pos", F.row_number().over(Window.orderBy(*order)) - 1).select(key, "rrf", "fused_pos")


def _scores(reranker: Reranker, query: str, it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for df in it:
        given = np.atleast_1d(np.asarray(reranker(query, [t or "" for t in df["_text"]]), float)) if len(df) else np.empty(0)
        yield df.drop(columns=["_text"]).assign(score=np.round(given, 6))


def rerank(fused: DataFrame, index: DataFrame, key: str, text: str, query: str | list[str], k: int = TOP, reranker: Reranker | None = None) -> DataFrame:
    """(key, score, fused_pos): the k best of the fused rows; ties keep the fused order.

    reranker scores a query and texts (0 to 1); without one the share of the query's distinct words that a text holds is the score. The fused
    list is broadcast if its size allows it.
    """
    rows = index.join(broadcast_if_small(fused.select(key, "fused_pos")), key)
    if reranker is None:
        scored = rows.select(key, F.round(lexical_score(query_terms(query) if isinstance(query, str) else query, F.col(text)), 6).alias("score"), "fused_pos")
    else:
        kind = dict(rows.dtypes)[key]
        asked = query if isinstance(query, str) else " ".join(query)
        scored = rows.select(key, "fused_pos", F.col(text).alias("_text")).mapInPandas(partial(_scores, reranker, asked), f"`{key}` {kind}, fused_pos int, score double")
    return scored.select(key, "score", "fused_pos").orderBy(F.desc("score"), "fused_pos").limit(k)


def search(index: DataFrame, query: str, encoder: Encoder, *, k: int | None = None, key: str = "chunk_id", text: str = "text", vector: str = "vector", reranker: Reranker | bool = True, generator: Generator | None = None, kept: TextIndex | None = None) -> DataFrame:
    """The k best rows (1 to 10, 5 by default): dense and lexical lists, fused and reranked.

    reranker is a model, True for the lexical scorer, or False for none: then it's the head of the dense list with its similarities. A generator adds
    an imagined passage to the dense query and to what's reranked, never to the lexical one; if it fails the plain query is used. Without
    lexical hits, or if a kept text index can't be read, the dense list stands.
    """
    k = T.clamp(k, 1, 10, TOP)
    dense_text = query
    if generator:
        try:
            dense_text = f"{query}\n{generator(query)}"
        except Exception:  # noqa: BLE001 - any failure of a model means: without it
            dense_text = query
    near = dense_top(index, key, vector, [float(x) for x in encoder([dense_text])[0]])
    if not reranker:
        return near.where(F.col("pos") < k).select(key, F.col("similarity").alias("score"), F.col("pos").alias("fused_pos"))
    if kept is None:
        lexical = bm25_top(index, key, text, query_terms(query))
    else:
        there = exists(index.sparkSession, f"{kept.path}/postings")
        lexical = kept.top(query_terms(query)) if there else bm25_top(index, key, text, [])
    return rerank(fuse(near, lexical, key), index, key, text, dense_text, k, None if reranker is True else reranker)


#: What the search tool answers when there's nothing to show.
NO_INDEX, NO_MODEL, NO_HIT = "The document index is empty/not built yet.", "Embedding model unavailable on the server; cannot search.", "No relevant passages found for: "


def search_message(index: DataFrame | None, query: str, encoder: Encoder | None, **options) -> str:
    """Results of search() as text, or why there are none: no index, no model, no hit."""
    if index is None:
        return NO_INDEX
    if encoder is None:
        return NO_MODEL
    key = options.get("key", "chunk_id")
    found = index.drop("fused_pos", "score").join(F.broadcast(search(index, query, encoder, **options)), key).orderBy(F.desc("score"), "fused_pos")
    rows = [r.asDict() for r in found.select("stem", "page", "text", "score").collect()]
    return render(rows, query) if rows else NO_HIT + query


def status(index: DataFrame | None, encoder: Encoder | None = None, reranker: Reranker | None = None) -> dict:
    """{ok, index_ready, embedder_ready, reranker_ready, docs}: what's there to search with, and how many rows."""
    docs = 0
    try:
        docs = index.count() if index is not None else 0
    except Exception:  # noqa: BLE001 - an index that can't be read has no rows to offer
        pass
    return {"ok": index is not None and encoder is not None, "index_ready": index is not None, "embedder_ready": encoder is not None, "reranker_ready": reranker is not None, "docs": docs}


class Snapshot:
    """A table that other processes write, read again at most every so many seconds; if that fails the last one stands."""

    def __init__(self, read, seconds: float = 15.0, clock=None):
        import time

        self.read, self.seconds, self.clock = read, seconds, clock or time.monotonic
        self.table, self.at = None, None

    def __call__(self) -> DataFrame | None:
        now = self.clock()
        if self.at is None or now - self.at >= self.seconds:
            self.at = now
            try:
                self.table = self.read()
            except Exception:  # noqa: BLE001 - keep what there is
                pass
        return self.table

    def expire(self) -> None:
        self.at = None


# --- answers and evaluation -------------------------------------------------


def passages(rows: DataFrame, text: str = "text", score: str = "score") -> DataFrame:
    """rows with collapsed text, without blank ones, a snippet of 320 characters and the score to three places."""
    clean = rows.withColumn(text, T.collapse(F.col(text))).where(F.coalesce(F.col(text), F.lit("")) != "")
    return clean.withColumn("snippet", T.snippet(F.col(text), 320)).withColumn(score, F.bround(score, 3))


def context(passages_: Column) -> Column:
    """An array of struct(stem, page, text) as the numbered context of a prompt."""
    return F.array_join(F.transform(passages_, lambda p, i: F.concat(F.lit("["), (i + 1).cast("string"), F.lit("] (source: "), p["stem"], F.lit(", p."), p["page"].cast("string"), F.lit(")\n"), p["text"])), "\n\n")


def answer(rows: list[dict], query: str, generator: Generator, sentinel: str) -> dict:
    """{answer, sources, abstained} of at most a page of passages; the model isn't called without any, and one that abstains gives neither text nor sources."""
    shown = [r for r in rows if (r.get("text") or "").strip()]
    if not shown:
        return {"answer": "", "sources": [], "abstained": True}
    prompt = "\n\n".join(f"[{i}] (source: {r['stem']}, p.{r['page']})\n{r['text']}" for i, r in enumerate(shown, 1))
    text = (generator(f"{prompt}\n\n{query}") or "").strip()
    if not text or sentinel in text:
        return {"answer": "", "sources": [], "abstained": True}
    sources = [{"stem": r["stem"], "page": r["page"], "score": round(r["score"], 3), "snippet": " ".join(r["text"].split())[:320]} for r in shown]
    return {"answer": text, "sources": sources, "abstained": False}


def head_line(place: Column, stem: Column, page: Column, score: Column) -> Column:
    """The first line of a shown result."""
    return F.format_string("[%d] %s (p.%s, score %.2f)", place, stem, page.cast("string"), F.bround(score, 2))


def render(rows: list[dict], query: str) -> str:
    """Results as text: how many there are for which query, then each one's place, source, page and score, and its text on one line."""
    shown = [f"[{i}] {r.get('stem') or r.get('source') or '?'} (p.{r['page']}, score {r['score']:.2f})\n{' '.join((r['text'] or '').split())}\n" for i, r in enumerate(rows, 1)]
    return "\n".join([f"Top {len(rows)} passage(s) for: {query}\n", *shown])


def rank_metrics(ranks: DataFrame, by: list[str], rank: str = "rank", k: int = 5) -> DataFrame:
    """hit_1, hit_k and mrr of ranks from 1, null for none, to six places."""
    hit = lambda n: F.round(F.avg(F.when(F.col(rank) <= n, 1.0).otherwise(0.0)), 6)
    return ranks.groupBy(*by).agg(F.count("*").alias("cases"), hit(1).alias("hit_1"), hit(k).alias("hit_k"), F.round(F.avg(F.coalesce(1 / F.col(rank), F.lit(0.0))), 6).alias("mrr"))
