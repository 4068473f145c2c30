"""Queries of the operators in this subpackage, and their SQL where SQL can express them over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamplight.llm.encode import encode_corpus
from lamplight.llm.knn import nearest_vectors, similar_vectors
from lamplight.llm.leakage import find_leaks
from lamplight.llm.order_minhash import NearDuplicates, near_duplicate_records
from lamplight.llm.quality import profile, text_kinds, text_statistics
from lamplight.llm.reading_level import english_prose, reading_levels
from lamplight.llm.scan_repair import found_items, repair_scans
from lamplight.session import materialize, table

STEM_OPTIONS = {"unit": "char", "shingle": 3, "threshold": 0.5, "least": 3, "k": 3, "sample": 3, "tables": 96, "name": "omh-stem"}


def _stems(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "research").where("catalog_id is null and stem is not null").select("stem", F.col("stem").alias("spelling")).distinct()


#: Copies of one text that p1_found multiplies out to pairs; a larger group comes as a star around its least row_id.
EXPAND = 200


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    texts = NearDuplicates(table(spark, d, "research"), "row_id", "text").record_pairs(EXPAND).select(F.lit("text").alias("field"), "key_a", "key_b")
    stems = NearDuplicates(_stems(spark, d), "stem", "spelling", **STEM_OPTIONS).record_pairs(EXPAND).select(F.lit("stem").alias("field"), "key_a", "key_b")
    return texts.unionByName(stems)


def p1_links(spark: SparkSession, d: str) -> DataFrame:
    """Every two near classes of texts by their least row_id, with Jaccard and edit similarity; the same whatever the size of a class."""
    return NearDuplicates(table(spark, d, "research"), "row_id", "text", name="omh-links").representative_pairs()


def p1_records(spark: SparkSession, d: str) -> DataFrame:
    """One row a record: its class, the class's size and its links, at five-word shingles and similarity 0.8; shorter texts have no links."""
    return near_duplicate_records(table(spark, d, "research"), "row_id", "text", every=True, shingle=5, threshold=0.8, least=5, name="omh-records")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return text_kinds(table(spark, d, "research"), "row_id", "text").where("kind <> 'prose'").select(F.col("id").alias("row_id"), "kind")


def p3_statistics(spark: SparkSession, d: str) -> DataFrame:
    """Statistics, robust z-scores and kind of every chunk with a text."""
    return text_kinds(table(spark, d, "research"), "row_id", "text").withColumnRenamed("id", "row_id")


def p3_profile(spark: SparkSession, d: str) -> DataFrame:
    """By language, and for all together, median and spread of each statistic over the corpus."""
    return profile(materialize(text_statistics(table(spark, d, "documents"), "doc_id", "text"), "profile"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    near = similar_vectors(table(spark, d, "research"), "row_id", "vector", dim=64)
    return near.select(F.least("id", "other").alias("row_id_a"), F.greatest("id", "other").alias("row_id_b")).distinct()


def p4_nearest(spark: SparkSession, d: str) -> DataFrame:
    """The 10 most similar records, however similar, of each record whose number divides by 50."""
    research = table(spark, d, "research")
    queries = research.where("cast(substring(row_id, 2) as bigint) % 50 = 0")
    return nearest_vectors(research, "row_id", "vector", queries, dim=64).withColumnRenamed("id", "row_id")


def _scanned(spark: SparkSession, d: str) -> DataFrame:
    research = table(spark, d, "research").select(F.lit("research").alias("tab"), F.col("row_id").alias("rec"), "stem", "text")
    files = table(spark, d, "files").where("out is not null").select(F.lit("files").alias("tab"), F.col("path").alias("rec"), "stem", F.col("out").alias("text")).distinct()
    return research.unionByName(files)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return found_items(repair_scans(_scanned(spark, d), with_text=False))


def p5_repaired(spark: SparkSession, d: str) -> DataFrame:
    """Every text of research and files as continuous paragraphs."""
    return repair_scans(_scanned(spark, d)).select("tab", "rec", "repaired")


def p6_ids(spark: SparkSession, d: str) -> DataFrame:
    return encode_corpus(table(spark, d, "documents"), "doc_id", "text").withColumnRenamed("id", "doc_id")


def _leaks(spark: SparkSession, d: str, edits: int, **options) -> DataFrame:
    return find_leaks(table(spark, d, "documents"), "doc_id", "text", table(spark, d, "eval_cases"), "case_id", ["query", "passage"], edits=edits, **options).withColumnRenamed("id", "doc_id")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """Of the leaks with up to one edit those that hold twelve words unchanged."""
    return _leaks(spark, d, 1).where("edits = 0").select("doc_id", "case_id")


def p7_edited(spark: SparkSession, d: str) -> DataFrame:
    """Leaks with up to two word edits between windows of twelve words: one or two words replaced, or one inserted or dropped."""
    return _leaks(spark, d, 2, name="leaks-edited")


def p8_levels(spark: SparkSession, d: str) -> DataFrame:
    """Band, confidence and difficulty of every document, and what kind of text it is."""
    return reading_levels(table(spark, d, "documents"), "doc_id", "text", table(spark, d, "reading_labels")).withColumnRenamed("id", "doc_id")


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return english_prose(p8_levels(spark, d).withColumnRenamed("doc_id", "id")).select(F.col("id").alias("doc_id"), "band")


QUERIES = {"p1_found": p1_found, "p1_links": p1_links, "p1_records": p1_records, "p3_found": p3_found, "p3_statistics": p3_statistics, "p3_profile": p3_profile, "p4_found": p4_found, "p4_nearest": p4_nearest, "p5_found": p5_found, "p5_repaired": p5_repaired, "p6_ids": p6_ids, "p7_found": p7_found, "p7_edited": p7_edited, "p8_found": p8_found, "p8_levels": p8_levels}
def _near_sql(rows: str, units: str, least: int) -> str:
    """Pairs of rows(key, text) whose distinct sequences of three units (SQL list of t) have a Jaccard similarity of 0.5 or more."""
    return f"""
        SELECT a AS key_a, b AS key_b FROM (
            SELECT x.key AS a, y.key AS b, x.n AS n, y.n AS m, count(*) AS c
            FROM (SELECT key, g, count(*) OVER (PARTITION BY key) AS n FROM (SELECT DISTINCT key, array_to_string(w[i:i + 2], chr(31)) AS g FROM (SELECT key, w, unnest(generate_series(1, len(w) - 2)) AS i FROM (SELECT key, {units} AS w FROM {rows}) WHERE len(w) >= {least}))) x
            JOIN (SELECT key, g, count(*) OVER (PARTITION BY key) AS n FROM (SELECT DISTINCT key, array_to_string(w[i:i + 2], chr(31)) AS g FROM (SELECT key, w, unnest(generate_series(1, len(w) - 2)) AS i FROM (SELECT key, {units} AS w FROM {rows}) WHERE len(w) >= {least}))) y
            ON x.g = y.g AND x.key < y.key GROUP BY ALL) WHERE c >= 0.5 * (n + m - c)"""


_TEXTS = "(SELECT row_id AS key, lower(text) AS t FROM research WHERE text IS NOT NULL)"
_STEMS = "(SELECT DISTINCT stem AS key, lower(stem) AS t FROM research WHERE catalog_id IS NULL AND stem IS NOT NULL)"
ORACLES: dict[str, str] = {
    "p1_found": "SELECT 'text' AS field, key_a, key_b FROM (" + _near_sql(_TEXTS, "regexp_extract_all(t, '[a-z0-9]+')", 20) + ") UNION ALL SELECT 'stem', key_a, key_b FROM (" + _near_sql(_STEMS, "string_split(t, '')", 3) + ")",
    "p7_found": """
        WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM documents WHERE text IS NOT NULL),
        c AS (SELECT case_id, regexp_extract_all(lower(t), '[a-z0-9]+') AS w FROM (SELECT case_id, query AS t FROM eval_cases UNION ALL SELECT case_id, passage FROM eval_cases) WHERE t IS NOT NULL),
        dg AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 11], ' ') AS g FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 11)) AS i FROM d)),
        cg AS (SELECT DISTINCT case_id, array_to_string(w[i:i + 11], ' ') AS g FROM (SELECT case_id, w, unnest(generate_series(1, len(w) - 11)) AS i FROM c))
        SELECT DISTINCT doc_id, case_id FROM dg JOIN cg USING (g)""",
}
