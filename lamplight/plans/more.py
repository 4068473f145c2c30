"""Further queries: paths and ids, work totals, results of a run, record chunks, lookups, answers, searches with injected models."""

from __future__ import annotations

from pyspark.sql import functions as F

from lamplight.functions import text as T
from lamplight.models import embed, hashing_encoder
from lamplight.operators import files, sync
from lamplight.operators import retrieval as R
from lamplight.operators.files import latest
from lamplight.plans.catalog import _BLOB
from lamplight.plans.corpus import _LATEST, _manifest
from lamplight.plans.registry import query, strip_sql
from lamplight.session import table

_NAME = r"regexp_extract(source, '([^/\\]*)$', 1)"


@query(rf"SELECT DISTINCT source, {_NAME} AS name, CASE WHEN strpos(substr({_NAME}, 2), '.') > 0 THEN regexp_replace({_NAME}, '\.[^.]*$', '') ELSE {_NAME} END AS base, lower(CASE WHEN strpos(substr({_NAME}, 2), '.') > 0 THEN regexp_extract({_NAME}, '(\.[^.]*)$', 1) ELSE '' END) AS suffix FROM research WHERE source IS NOT NULL")
def f_path_parts(spark, d):
    """Name, stem and suffix of every source path."""
    rows = table(spark, d, "research").where("source is not null").select("source").distinct()
    return rows.select("source", T.file_name(F.col("source")).alias("name"), T.stem(F.col("source")).alias("base"), T.suffix(F.col("source")).alias("suffix"))


@query("SELECT row_id, md5(concat(source, '::', chunk_index)) AS id FROM research WHERE source IS NOT NULL AND chunk_index IS NOT NULL")
def f_prototype_ids(spark, d):
    """Hashed ids of source and position."""
    return table(spark, d, "research").where("source is not null and chunk_index is not null").select("row_id", T.prototype_id(F.col("source"), F.col("chunk_index")).alias("id"))


@query(f"SELECT count(*) AS files, count(*) FILTER (status = 'pending') AS pending, coalesce(sum(pages), 0)::BIGINT AS pages, coalesce(sum(chars), 0)::BIGINT AS chars, round(coalesce(sum(pages) FILTER (status = 'done'), 0) / nullif(sum(seconds) FILTER (status = 'done'), 0), 4) AS pages_per_second FROM ({_LATEST})")
def b_work_totals(spark, d):
    """What the manifest holds, what's left and how fast it went."""
    done = F.col("status") == "done"
    rate = F.try_divide(F.coalesce(F.sum(F.when(done, F.col("pages"))), F.lit(0)).cast("double"), F.sum(F.when(done, F.col("seconds"))))
    return _manifest(spark, d).agg(F.count("*").alias("files"), F.count_if(F.col("status") == "pending").alias("pending"), F.coalesce(F.sum("pages"), F.lit(0)).alias("pages"), F.coalesce(F.sum("chars"), F.lit(0)).alias("chars"), F.round(rate, 4).alias("pages_per_second"))


@query(f"SELECT path, CASE WHEN status <> 'pending' THEN status WHEN pages >= 1 THEN 'done' ELSE 'error' END AS status, CASE WHEN status = 'pending' AND pages >= 1 THEN pages * 100 ELSE chars END AS chars, CASE WHEN status <> 'pending' THEN error WHEN coalesce(pages, 0) < 1 THEN 'no pages' END AS error FROM ({_LATEST}) WHERE status IS NOT NULL")
def b_finish(spark, d):
    """The manifest after a run in which files without pages fail."""
    m = _manifest(spark, d).where("status is not null")
    ok = F.coalesce(F.col("pages"), F.lit(0)) >= 1
    results = m.where("status = 'pending'").select("path", F.when(ok, "md").alias("out"), F.when(ok, F.col("pages") * 100).otherwise(F.col("chars")).alias("chars"), F.lit(1.0).alias("seconds"), F.when(~ok, "no pages").alias("error"), F.lit(0.0).alias("updated"))
    return files.finish(m, results).select("path", "status", "chars", "error")


@query(f"SELECT meta_id, path, (coalesce(m.pages, 0) - coalesce(f.pages, 0))::INT AS differ FROM metadata m JOIN (SELECT stem, path, pages FROM ({_LATEST}) QUALIFY row_number() OVER (PARTITION BY stem ORDER BY path DESC) = 1) f USING (stem)")
def a_paired_comparison(spark, d):
    """Metadata records beside the manifest row of their stem: how the page counts differ."""
    m = latest(_manifest(spark, d).where("stem is not null"), ["stem"], [F.desc("path")]).select("stem", "path", F.col("pages").alias("have"))
    return table(spark, d, "metadata").join(m, "stem").select("meta_id", "path", (F.coalesce("pages", F.lit(0)) - F.coalesce("have", F.lit(0))).cast("int").alias("differ"))


@query("SELECT r.stem, max(f.path) AS path FROM (SELECT DISTINCT stem FROM research WHERE catalog_id IS NULL AND stem IS NOT NULL) r LEFT JOIN files f ON r.stem = f.stem GROUP BY r.stem")
def f_lookup_file(spark, d):
    """The file of each document, if the manifest has it; of several the last by path."""
    one = table(spark, d, "files").where("stem is not null").groupBy("stem").agg(F.max("path").alias("path"))
    return table(spark, d, "research").where("catalog_id is null and stem is not null").select("stem").distinct().join(one, "stem", "left")


@query("SELECT id, processed_at IS NOT NULL OR (hit AND action = 'delete') AS done, CASE WHEN hit AND action <> 'delete' THEN coalesce(attempts, 0) + 1 ELSE attempts END AS attempts FROM (SELECT *, processed_at IS NULL AND coalesce(attempts, 0) < 5 AS hit FROM queue)")
def g_acknowledge(spark, d):
    """The outbox after a batch in which deletions work and the rest fails."""
    q = table(spark, d, "queue")
    outcome = q.where(sync.claimable()).select("id", F.when(F.col("action") != "delete", "refused").alias("error"))
    return sync.acknowledge(q, outcome, F.current_timestamp()).select("id", F.col("processed_at").isNotNull().alias("done"), "attempts")


@query(f"""
    WITH b AS (SELECT catalog_id, {_BLOB} AS t FROM view_catalogs WHERE deleted_at IS NULL AND is_published = 1),
    s AS (SELECT catalog_id, t, unnest(CASE WHEN length(t) <= 1500 THEN [0] ELSE generate_series(0, length(t) - 1, 1300) END) AS ix FROM b WHERE t <> '')
    SELECT concat('cat-', catalog_id, '-', ix // 1300) AS chunk_id, concat('catalog:', catalog_id) AS source, md5(substr(t, ix + 1, 1500)) AS digest FROM s""")
def g_catalog_chunks(spark, d):
    """The index rows of every published record."""
    actions = table(spark, d, "view_catalogs").select("catalog_id", F.lit("upsert").alias("action"))
    return sync.catalog_chunks(sync.gate(actions, table(spark, d, "view_catalogs"))).select("chunk_id", "source", F.md5("text").alias("digest"))


@query("SELECT stem, md5(string_agg(concat('[', n, '] (source: ', stem, ', p.', page, ')', chr(10), text), chr(10) || chr(10) ORDER BY n)) AS digest FROM (SELECT stem, page, text, row_number() OVER (PARTITION BY stem ORDER BY page, row_id) AS n FROM research WHERE page IS NOT NULL AND text IS NOT NULL AND stem IS NOT NULL) WHERE n <= 5 GROUP BY stem")
def i_context(spark, d):
    """Each document's first five passages as the context of a prompt."""
    from pyspark.sql import Window

    rows = table(spark, d, "research").where("page is not null and text is not null and stem is not null")
    head = rows.withColumn("n", F.row_number().over(Window.partitionBy("stem").orderBy("page", "row_id"))).where("n <= 5")
    passages = head.groupBy("stem").agg(F.array_sort(F.collect_list(F.struct("n", "stem", "page", "text"))).alias("p"))
    return passages.select("stem", F.md5(R.context(F.col("p"))).alias("digest"))


def _searched(spark, d, **options):
    encoder = hashing_encoder(64)
    rows = table(spark, d, "research").select(F.col("row_id").alias("chunk_id"), "stem", "page", "text")
    return R.search(embed(rows, "text", encoder), "irrigation and nitrogen of lowland rice", encoder, **options)


@query()
def e_search(spark, d):
    """Search from end to end with the stand-in encoder: embedding, both lists, fusion, reranking."""
    return _searched(spark, d)


@query()
def e_search_imagined(spark, d):
    """The same with an imagined passage added to the dense query and to what's reranked."""
    return _searched(spark, d, generator=lambda q: "Rice in lowland fields yields more with irrigation.")


@query()
def e_search_dense_only(spark, d):
    """The same without a reranker."""
    return _searched(spark, d, reranker=False)
