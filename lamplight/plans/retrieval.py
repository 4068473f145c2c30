"""Queries of the index and of retrieval."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamplight.functions import text as T
from lamplight.operators import retrieval as R
from lamplight.operators import tables
from lamplight.plans.registry import SPACE, query
from lamplight.session import broadcast_if_small, table
from lamplight.sources.sinks import exists

TERMS = ["dormancy", "irrigation", "nitrogen", "household", "vigour"]
_DOT = "list_sum(list_transform(generate_series(1, len({a})), lambda i: {a}[i]::DOUBLE * {b}[i]::DOUBLE))"


def _cos(a: str, b: str) -> str:
    return f"round({_DOT.format(a=a, b=b)} / (sqrt({_DOT.format(a=a, b=a)}) * sqrt({_DOT.format(a=b, b=b)})), 6)"


_NEAR = f"SELECT e.vec_id, {_cos('e.embedding', 'q.embedding')} AS similarity FROM embeddings e, (SELECT embedding FROM embeddings WHERE vec_id = 0) q WHERE e.vec_id <> 0 ORDER BY similarity DESC, vec_id LIMIT 30"
_DENSE = f"SELECT vec_id, similarity, row_number() OVER (ORDER BY similarity DESC, vec_id) - 1 AS pos FROM ({_NEAR})"


def _vector0(spark: SparkSession, d: str) -> list[float]:
    return table(spark, d, "embeddings").where("vec_id = 0").first().embedding


def _dense(spark: SparkSession, d: str) -> DataFrame:
    return R.dense_top(table(spark, d, "embeddings").where("vec_id <> 0"), "vec_id", "embedding", _vector0(spark, d))


@query(f"SELECT vec_id, similarity, pos::INT AS pos FROM ({_DENSE})")
def e_dense_topk(spark, d):
    """The 30 vectors nearest vector 0, exactly."""
    return _dense(spark, d)


@query(f"""
    SELECT q.vec_id AS query_id, e.vec_id, {_cos('e.embedding', 'q.embedding')} AS similarity, (row_number() OVER (PARTITION BY q.vec_id ORDER BY {_cos('e.embedding', 'q.embedding')} DESC, e.vec_id))::INT AS rank
    FROM embeddings e JOIN (SELECT * FROM embeddings WHERE vec_id % 50 = 0) q ON e.vec_id <> q.vec_id QUALIFY rank <= 5""")
def e_dense_batch(spark, d):
    """The five nearest of every vector whose id is divisible by 50, against all."""
    e = table(spark, d, "embeddings").select("vec_id", "embedding")
    return R.dense_batch(e, "vec_id", "embedding", e.where("vec_id % 50 = 0").withColumnRenamed("vec_id", "query_id"), "query_id", 5)


def _bm25_sql(source: str, key: str) -> str:
    words = "regexp_extract_all(lower(text), '[a-z0-9]+')"
    terms = ", ".join(f"'{t}'" for t in TERMS)
    return f"""
    WITH w AS (SELECT {key}, {words} AS w FROM {source} WHERE text IS NOT NULL),
    c AS (SELECT {key}, len(w) AS len, unnest([{terms}]) AS term, w FROM w),
    t AS (SELECT {key}, len, term, len(list_filter(w, lambda x: x = term)) AS tf FROM c),
    n AS (SELECT count(*) AS n, avg(len(w)) AS avg FROM w),
    i AS (SELECT term, ln(1 + (n - df + 0.5) / (df + 0.5)) AS idf FROM (SELECT term, count(*) FILTER (tf > 0) AS df FROM t GROUP BY term), n),
    s AS (SELECT {key}, round(sum(idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / avg))), 6) AS score FROM t JOIN i USING (term), n GROUP BY {key} HAVING sum(tf) > 0)
    SELECT {key}, score, row_number() OVER (ORDER BY score DESC, {key}) - 1 AS pos FROM (SELECT {key}, score FROM s ORDER BY score DESC, {key} LIMIT 30)"""


@query(f"SELECT row_id, score, pos::INT AS pos FROM ({_bm25_sql('research', 'row_id')})")
def e_bm25(spark, d):
    """The 30 chunks with the best BM25 score for five terms."""
    return R.bm25_top(table(spark, d, "research"), "row_id", "text", TERMS)


# Hybrid retrieval runs over research, whose every row has text and vector; the query is a vector and five terms.
_Q = "(SELECT vector FROM research WHERE row_id = 'r0000000000' OR len(vector) = 64 ORDER BY row_id LIMIT 1)"
_OK = "len(r.vector) = 64 AND NOT list_contains(list_transform(r.vector, lambda x: isnan(x)), true) AND list_sum(list_transform(r.vector, lambda x: x::DOUBLE * x::DOUBLE)) > 0"
_NEAR_R = f"SELECT r.row_id, {_cos('r.vector', 'q.vector')} AS similarity FROM research r, {_Q} q WHERE {_OK} ORDER BY similarity DESC, row_id LIMIT 30"
_DENSE_R = f"SELECT row_id, similarity, row_number() OVER (ORDER BY similarity DESC, row_id) - 1 AS pos FROM ({_NEAR_R})"
_FUSED = f"""
    SELECT row_id, round(sum(1 / (60 + pos + 1)), 9) AS rrf, min(src * 1000 + pos) AS first
    FROM (SELECT row_id, 0 AS src, pos FROM ({_DENSE_R}) UNION ALL SELECT row_id, 1 AS src, pos FROM ({_bm25_sql('research', 'row_id')})) GROUP BY row_id ORDER BY rrf DESC, first LIMIT 24"""
_KEPT: dict[str, R.TextIndex] = {}


def text_index(spark: SparkSession, d: str) -> R.TextIndex:
    """The kept text index of a folder's research table, built at its first use in a session, or once the shared folder was emptied, and read by every later query."""
    name = f"{spark.sparkContext.applicationId} {d}"
    if name not in _KEPT or not exists(spark, f"{_KEPT[name].path}/terms/_SUCCESS"):
        _KEPT[name] = R.TextIndex.build(table(spark, d, "research"), "row_id", "text")
    return _KEPT[name]


def _dense_r(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "research").select("row_id", "vector")
    query = rows.where("size(vector) = 64").orderBy("row_id").first().vector
    return R.dense_top(rows, "row_id", "vector", query)


def _fused(spark: SparkSession, d: str) -> DataFrame:
    return R.fuse(_dense_r(spark, d), text_index(spark, d).top(TERMS), "row_id")


@query("""
    SELECT term, count(*) AS df, sum(tf)::BIGINT AS cf FROM (SELECT row_id, term, count(*) AS tf FROM (SELECT row_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS term FROM research) GROUP BY row_id, term) GROUP BY term""")
def e_term_stats(spark, d):
    """Document and collection frequency of every term of the kept index."""
    return text_index(spark, d).terms().select("term", "df", "cf")


@query(f"SELECT row_id, score, pos::INT AS pos FROM ({_bm25_sql('research', 'row_id')})")
def e_bm25_kept(spark, d):
    """The same from the kept index: the postings of five terms."""
    return text_index(spark, d).top(TERMS)


@query(f"SELECT row_id, rrf, (row_number() OVER (ORDER BY rrf DESC, first) - 1)::INT AS fused_pos FROM ({_FUSED})")
def e_rrf(spark, d):
    """The dense and lexical lists over all chunks, fused."""
    return _fused(spark, d)


_RERANKED = f"""
    WITH f AS (SELECT row_id, (row_number() OVER (ORDER BY rrf DESC, first) - 1)::INT AS fused_pos FROM ({_FUSED}))
    SELECT row_id, {{score}} AS score, fused_pos FROM f JOIN research USING (row_id) ORDER BY score DESC, fused_pos LIMIT 5"""


@query(_RERANKED.format(score=f"round(len(list_intersect(list_distinct(regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+')), [{', '.join(f"'{t}'" for t in TERMS)}])) / {len(TERMS)}.0, 6)::DOUBLE"))
def e_rerank_topk(spark, d):
    """Hybrid retrieval from end to end over all chunks: the five best of the fused list by the lexical scorer."""
    return R.rerank(_fused(spark, d), table(spark, d, "research").select("row_id", "text"), "row_id", "text", TERMS, 5)


def _brevity(query: str, texts: list[str]) -> list[float]:
    return [1 / (1 + len(t)) for t in texts]


@query(_RERANKED.format(score="round(1 / (1 + length(coalesce(text, ''))), 6)::DOUBLE"))
def e_rerank_injected(spark, d):
    """The same with an injected reranker, one that prefers short texts."""
    return R.rerank(_fused(spark, d), table(spark, d, "research").select("row_id", "text"), "row_id", "text", TERMS, 5, reranker=_brevity)


@query(f"SELECT row_id, round(1 / (60 + pos + 1), 9) AS rrf, pos::INT AS fused_pos FROM ({_DENSE_R}) WHERE pos < 24")
def e_fallback_no_fts(spark, d):
    """Without lexical hits the dense list stands."""
    return R.fuse(_dense_r(spark, d), text_index(spark, d).top([]), "row_id")


@query(f"SELECT vec_id, similarity FROM ({_DENSE}) WHERE pos < 5")
def e_fallback_no_rerank(spark, d):
    """Without a reranker the head of the dense list counts."""
    return _dense(spark, d).where("pos < 5").select("vec_id", "similarity")


@query("SELECT stem, count(*) AS n, count(*) FILTER (n_tokens = -1) AS fresh FROM (SELECT stem, n_tokens FROM research WHERE stem NOT IN (SELECT stem FROM files WHERE stem IS NOT NULL) UNION ALL SELECT DISTINCT stem, -1 FROM files WHERE stem IS NOT NULL) GROUP BY stem")
def e_replace_by_key(spark, d):
    """Chunks after those of all files' stems are replaced by one each."""
    old = table(spark, d, "research").where("stem is not null").select("stem", "n_tokens")
    new = table(spark, d, "files").where("stem is not null").select("stem", F.lit(-1).alias("n_tokens")).distinct()
    return tables.replace_by_key(old, new, "stem").groupBy("stem").agg(F.count("*").alias("n"), F.count_if(F.col("n_tokens") == -1).alias("fresh"))


@query("SELECT count(*) AS n, count(DISTINCT stem) AS stems FROM research WHERE source IS NULL OR NOT contains(source, 'ocr_out')")
def e_delete_like(spark, d):
    """The index without the rows of scanned sources; the underscore is no wildcard."""
    return tables.delete_containing(table(spark, d, "research"), "source", "ocr_out").agg(F.count("*").alias("n"), F.countDistinct("stem").alias("stems"))


@query("SELECT catalog_id IS NULL AS corpus, count(*) AS n FROM research GROUP BY 1")
def e_add_nullable(spark, d):
    """Corpus rows without the owner column, and catalogue rows, in one table."""
    rows = table(spark, d, "research")
    both = tables.add_nullable(rows.where("catalog_id is null").drop("catalog_id"), "catalog_id", "bigint").unionByName(rows.where("catalog_id is not null"))
    return both.groupBy(F.col("catalog_id").isNull().alias("corpus")).agg(F.count("*").alias("n"))


_RANKS = f"""
    WITH p AS (SELECT q.vec_id, q.label, e.label AS other, row_number() OVER (PARTITION BY q.vec_id ORDER BY {_cos('e.embedding', 'q.embedding')} DESC, e.vec_id) AS rank
        FROM embeddings e JOIN (SELECT * FROM embeddings WHERE vec_id % 50 = 0) q ON e.vec_id <> q.vec_id)
    SELECT vec_id, label, (min(rank) FILTER (rank <= 10 AND other = label))::INT AS rank FROM p GROUP BY vec_id, label"""


def _ranks(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings").select("vec_id", "embedding")
    labels = table(spark, d, "embeddings").select("vec_id", "label")
    asked = e.where("vec_id % 50 = 0").withColumnRenamed("vec_id", "query_id")
    near = R.dense_batch(e, "vec_id", "embedding", asked, "query_id", 10)
    cases = labels.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("label").alias("wanted"))
    hits = near.join(cases, "query_id").join(labels, "vec_id").where("label = wanted").groupBy("query_id").agg(F.min("rank").alias("rank"))
    return cases.join(hits, "query_id", "left").select(F.col("query_id").alias("vec_id"), F.col("wanted").alias("label"), "rank")


@query(_RANKS)
def h_rank_first(spark, d):
    """The rank of the first vector of the same label among the ten nearest."""
    return _ranks(spark, d)


@query(f"SELECT label, count(*) AS cases, round(avg((coalesce(rank, 99) <= 1)::INT), 6) AS hit_1, round(avg((coalesce(rank, 99) <= 5)::INT), 6) AS hit_k, round(avg(coalesce(1 / rank, 0)), 6) AS mrr FROM ({_RANKS}) GROUP BY label")
def h_metrics(spark, d):
    """Hit rates and mean reciprocal rank by label."""
    return R.rank_metrics(_ranks(spark, d), ["label"])


@query("SELECT case_id, count(DISTINCT stem) AS stems FROM eval_cases JOIN (SELECT DISTINCT stem FROM research WHERE stem IS NOT NULL) ON len(list_filter(relevant, lambda f: contains(lower(stem), lower(f)))) > 0 GROUP BY case_id")
def h_relevant_stems(spark, d):
    """How many stems each test case counts as relevant: those that contain one of its fragments."""
    cases = table(spark, d, "eval_cases").select("case_id", "relevant")
    stems = table(spark, d, "research").where("stem is not null").select("stem").distinct()
    return stems.join(broadcast_if_small(cases), T.contains_any(F.col("stem"), F.col("relevant"))).groupBy("case_id").agg(F.countDistinct("stem").alias("stems"))


_COLLAPSE = f"trim(regexp_replace(text, '{SPACE}+', ' ', 'g'))"


@query(f"SELECT row_id, md5(substr({_COLLAPSE}, 1, 320)) AS digest, length(substr({_COLLAPSE}, 1, 320))::INT AS n_chars FROM research WHERE {_COLLAPSE} <> ''")
def i_passages(spark, d):
    """Every chunk as a passage: collapsed, blank ones dropped, its snippet."""
    rows = R.passages(table(spark, d, "research").select("row_id", "text", F.lit(0.5).alias("score")))
    return rows.select("row_id", F.md5("snippet").alias("digest"), F.length("snippet").alias("n_chars"))


@query(f"SELECT case_id, (regexp_replace(coalesce(passage, ''), '{SPACE}+', '', 'g') = '') OR contains(passage, 'ripened') OR len(relevant) = 0 AS abstained FROM eval_cases")
def i_abstain(spark, d):
    """Test passages taken as answers, a word of theirs as the sentinel: which abstain."""
    return table(spark, d, "eval_cases").select("case_id", T.abstains(F.col("passage"), "ripened", F.col("relevant")).alias("abstained"))
