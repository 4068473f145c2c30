"""Queries that write tables and read them back: what comes back is compared with SQL over the tables they were made of."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamplight.models import embed, hashing_encoder
from lamplight.operators import files
from lamplight.operators import retrieval as R
from lamplight.plans.corpus import _TRIAGE, _lines
from lamplight.plans.registry import query
from lamplight.session import shared_folder, table
from lamplight.sources import readers, sinks


def _place(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query(f"SELECT doc_id::VARCHAR AS path, pages_total, pages_with_text, text_fraction, bucket FROM ({_TRIAGE}) WHERE bucket IN ('TEXT_READY', 'NEEDS_OCR')")
def s_triage_csv(spark, d):
    """Triage results through a CSV file, two buckets of it read."""
    made = files.triage(_lines(spark, d), "doc_id", F.col("pages"))
    path = _place(spark, "triage")
    sinks.write_csv(made.select(F.col("doc_id").alias("path"), F.col("doc_id").alias("name"), "pages_total", "pages_inspected", "pages_with_text", "text_fraction", "avg_chars_on_text_pages", "bucket", F.lit("a, \"b\"\nc").alias("error")), path)
    return readers.read_triage(spark, path, ("TEXT_READY", "NEEDS_OCR")).select("path", "pages_total", "pages_with_text", "text_fraction", "bucket")


@query("SELECT row_id, chunk_id, page, md5(text) AS digest FROM research WHERE text IS NOT NULL UNION ALL SELECT 'broken', NULL, NULL, count(*)::VARCHAR FROM region")
def s_torn_lines(spark, d):
    """Chunks through JSON lines in two appends, with a torn line for each region, which are set apart."""
    path = _place(spark, "lines")
    rows = table(spark, d, "research").where("text is not null").select("row_id", "chunk_id", "page", "text")
    sinks.write_json_lines(rows.where("page is null"), path)
    sinks.write_json_lines(rows.where("page is not null"), path, append=True)
    table(spark, d, "region").select(F.concat(F.lit('{"row_id": "'), "r_name").alias("value")).write.mode("append").text(path)
    good, broken = readers.read_json_lines(spark, path, "row_id string, chunk_id string, page int, text string")
    return good.select("row_id", "chunk_id", "page", F.md5("text").alias("digest")).unionByName(broken.agg(F.count("*").cast("string").alias("digest")).select(F.lit("broken").alias("row_id"), F.lit(None).cast("string").alias("chunk_id"), F.lit(None).cast("int").alias("page"), "digest"))


@query("SELECT DISTINCT trim(stem, ' ') AS stem FROM research WHERE trim(stem, ' ') <> ''")
def s_skip_list(spark, d):
    """Stems through a list file."""
    path = _place(spark, "list")
    sinks.write_list(table(spark, d, "research"), "stem", path)
    return readers.read_skip_list(spark, path)


@query("SELECT stem, min(n)::BIGINT AS n FROM (SELECT DISTINCT stem, 1 AS n FROM files WHERE stem IS NOT NULL UNION ALL SELECT DISTINCT stem, 2 FROM research WHERE stem IS NOT NULL) GROUP BY stem")
def s_append_missing(spark, d):
    """One row a stem, first of files, then of those stems of research that aren't there yet."""
    path = _place(spark, "append")
    for n, name in ((1, "files"), (2, "research")):
        sinks.append_missing(table(spark, d, name).where("stem is not null").select("stem").distinct().withColumn("n", F.lit(n).cast("bigint")), path, "stem")
    return spark.read.schema("stem string, n bigint").json(path)


@query("SELECT path, md5(coalesce(max(out) FILTER (pages > 5), min(out))) AS digest FROM files WHERE out IS NOT NULL GROUP BY path")
def s_keyed_texts(spark, d):
    """Scanned texts by path, written twice: of each path the newest write counts."""
    path = _place(spark, "keyed")
    rows = table(spark, d, "files").where("out is not null")
    sinks.write_texts(rows.groupBy("path").agg(F.min("out").alias("out")), "path", "out", path)
    sinks.write_texts(rows.where("pages > 5").groupBy("path").agg(F.max("out").alias("out")), "path", "out", path)
    return sinks.read_keyed(spark, path, "path").select("path", F.md5("out").alias("digest"))


@query("SELECT count(*) AS n, count(vector) AS vectors, count(DISTINCT chunk_id) AS ids FROM (SELECT chunk_id, nullif(text, NULL) AS vector FROM research WHERE page IS NOT NULL UNION ALL SELECT chunk_id, text FROM research WHERE page IS NULL)")
def s_index_flushes(spark, d):
    """The embedded index, written anew and then appended to."""
    path = _place(spark, "index")
    rows = embed(table(spark, d, "research").select("chunk_id", "page", "text"), "text", hashing_encoder(16))
    sinks.write_index(rows.where("page is not null"), path)
    sinks.write_index(rows.where("page is null"), path, append=True)
    return spark.read.parquet(path).agg(F.count("*").alias("n"), F.count("vector").alias("vectors"), F.countDistinct("chunk_id").alias("ids"))


@query("SELECT row_id, concat('[1] ', stem, ' (p.', page, ', score ', printf('%.2f', n_tokens / 256.0), ')') AS line, round_even(n_tokens / 256.0, 3)::DOUBLE AS score FROM research WHERE stem IS NOT NULL AND page IS NOT NULL AND n_tokens IS NOT NULL")
def i_rendered(spark, d):
    """The head line and the rounded score of every chunk as a result."""
    rows = table(spark, d, "research").where("stem is not null and page is not null and n_tokens is not null")
    score = F.col("n_tokens") / 256.0
    return rows.select("row_id", R.head_line(F.lit(1), F.col("stem"), F.col("page"), score).alias("line"), F.bround(score, 3).alias("score"))
