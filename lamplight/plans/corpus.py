"""Queries of corpus building: pages, triage, manifest, duplicates, chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamplight.functions import text as T
from lamplight.operators import chunking, files
from lamplight.plans.registry import SPACE, query, strip_sql
from lamplight.session import table

_LINES = "string_split(text, chr(10))"


def _lines(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.split("text", "\n", -1).alias("pages"))


@query(f"SELECT doc_id, page::INT AS page, length(t)::INT AS n_chars, md5(t) AS digest FROM (SELECT doc_id, unnest({_LINES}) AS t, generate_subscripts({_LINES}, 1) AS page FROM documents)")
def a_page_explode(spark, d):
    """Lines of documents as pages, numbered from 1."""
    return _lines(spark, d).select("doc_id", F.posexplode("pages").alias("i", "t")).select("doc_id", (F.col("i") + 1).cast("int").alias("page"), F.length("t").alias("n_chars"), F.md5("t").alias("digest"))


@query("""
    WITH f AS (SELECT path, max(pages) AS n FROM files GROUP BY path)
    SELECT DISTINCT path, (CASE WHEN n <= 12 THEN i ELSE i * n // 12 END)::INT AS page FROM f, generate_series(0, 11) AS g(i) WHERE n > 0 AND (n > 12 OR i < n)""")
def a_page_pick(spark, d):
    """Evenly spread pages of each file."""
    pages = table(spark, d, "files").groupBy("path").agg(F.max("pages").alias("n"))
    return pages.select("path", F.explode(chunking.page_picks(F.col("n"))).alias("page"))


_TRIAGE = f"""
    WITH p AS (SELECT doc_id, text, {_LINES} AS pages, len({_LINES}) AS n FROM documents),
    k AS (SELECT DISTINCT doc_id, CASE WHEN n <= 12 THEN i ELSE i * n // 12 END AS ix FROM p, generate_series(0, 11) AS g(i) WHERE n > 12 OR i < n),
    l AS (SELECT doc_id, length({strip_sql('pages[ix + 1]')}) AS c FROM k JOIN p USING (doc_id)),
    s AS (SELECT doc_id, count(*) AS inspected, count(*) FILTER (c >= 50) AS full_pages, coalesce(sum(c) FILTER (c >= 50), 0) AS chars FROM l GROUP BY doc_id),
    r AS (SELECT p.doc_id, coalesce(n, 0)::INT AS pages_total, coalesce(inspected, 0)::INT AS pages_inspected, coalesce(full_pages, 0)::INT AS pages_with_text,
        round_even(coalesce(full_pages, 0) / greatest(coalesce(inspected, 0), 1), 3) AS text_fraction, round_even(coalesce(chars, 0) / greatest(coalesce(full_pages, 0), 1), 1)::DOUBLE AS avg_chars_on_text_pages, text FROM p LEFT JOIN s USING (doc_id))
    SELECT doc_id, pages_total, pages_inspected, pages_with_text, text_fraction, avg_chars_on_text_pages,
        CASE WHEN text IS NULL THEN 'ERROR_READ' WHEN text_fraction >= 0.80 THEN 'TEXT_READY' WHEN text_fraction <= 0.05 THEN 'NEEDS_OCR' ELSE 'SUSPECT_TEXT_LAYER' END AS bucket FROM r"""


@query(_TRIAGE)
def a_triage_bucket(spark, d):
    """Triage of documents by their lines as pages."""
    return files.triage(_lines(spark, d), "doc_id", F.col("pages"))


@query(f"SELECT bucket, count(*) AS n, round_even(100 * count(*) / sum(count(*)) OVER (), 1)::DOUBLE AS percent FROM ({_TRIAGE}) GROUP BY bucket")
def a_bucket_rollup(spark, d):
    """Triage buckets, with their percentage."""
    return files.shares(files.triage(_lines(spark, d), "doc_id", F.col("pages")), "bucket")


@query("""
    WITH o AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i, count(*) OVER () AS n FROM documents)
    SELECT doc_id FROM o WHERE n <= 30 OR i IN (SELECT j * (SELECT count(*) FROM documents) // 30 FROM generate_series(0, 29) AS g(j))""")
def a_systematic_sample(spark, d):
    """Thirty documents at even distances."""
    return files.systematic_sample(table(spark, d, "documents").select("doc_id"), ["doc_id"], 30)


@query(f"SELECT doc_id, count(*)::INT AS pages_total, sum(length({strip_sql('t')}))::BIGINT AS chars FROM (SELECT doc_id, unnest({_LINES}) AS t FROM documents) WHERE {strip_sql('t')} <> '' GROUP BY doc_id")
def a_nonempty_pages(spark, d):
    """Pages with at least one character, and how many characters they have."""
    pages = _lines(spark, d).select("doc_id", F.explode("pages").alias("t")).select("doc_id", T.strip(F.col("t")).alias("t")).where("t <> ''")
    return pages.groupBy("doc_id").agg(F.count("*").cast("int").alias("pages_total"), F.sum(F.length("t")).alias("chars"))


_LATEST = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY path ORDER BY updated DESC NULLS LAST, status, coalesce(out, ''), coalesce(error, ''), coalesce(pages, -1)) AS place FROM files WHERE path IS NOT NULL) WHERE place = 1"


def _manifest(spark: SparkSession, d: str) -> DataFrame:
    order = [F.col("updated").desc_nulls_last(), F.col("status").asc_nulls_last(), F.coalesce("out", F.lit("")), F.coalesce("error", F.lit("")), F.coalesce("pages", F.lit(-1))]
    return files.latest(table(spark, d, "files").where("path is not null"), ["path"], order)


@query(f"SELECT path, stem, status, pages, coalesce(chars, 0) AS chars, updated FROM ({_LATEST})")
def b_latest_status(spark, d):
    """The manifest: the latest row of each path."""
    return _manifest(spark, d).select("path", "stem", "status", "pages", F.coalesce("chars", F.lit(0)).alias("chars"), "updated")


_TIER = "CASE WHEN pages BETWEEN 1 AND 10 THEN 'small' WHEN pages BETWEEN 11 AND 50 THEN 'medium' WHEN pages >= 51 THEN 'large' END"


@query(f"SELECT tier, count(*) AS n, coalesce(sum(pages), 0)::BIGINT AS pages FROM (SELECT {_TIER} AS tier, pages FROM ({_LATEST})) GROUP BY tier")
def b_tier_rollup(spark, d):
    """Files and pages by size class; files without pages are in none."""
    return _manifest(spark, d).select(files.tier(F.col("pages")).alias("tier"), "pages").groupBy("tier").agg(F.count("*").alias("n"), F.coalesce(F.sum("pages"), F.lit(0)).alias("pages"))


@query(f"SELECT tier, path, pages, (row_number() OVER (PARTITION BY tier ORDER BY pages, path))::INT AS place FROM (SELECT {_TIER} AS tier, path, pages FROM ({_LATEST}) WHERE status = 'pending') WHERE tier IS NOT NULL")
def b_pending_order(spark, d):
    """The files to be worked on, by size class: every pending one, smallest first. Failed ones aren't tried again."""
    return files.work_order(_manifest(spark, d), ["path"])


@query("SELECT DISTINCT stem FROM research WHERE stem IS NOT NULL AND stem NOT IN (SELECT stem FROM files WHERE stem IS NOT NULL)")
def b_seed_insert_ignore(spark, d):
    """Stems to be added to the manifest: those it doesn't have."""
    return files.insert_or_ignore(table(spark, d, "files").where("stem is not null"), table(spark, d, "research").where("stem is not null").select("stem"), "stem")


@query(f"SELECT status, count(*) AS n, coalesce(sum(pages), 0)::BIGINT AS pages FROM (SELECT coalesce(status, 'none') AS status, pages FROM ({_LATEST})) GROUP BY ROLLUP (status)")
def b_status_total(spark, d):
    """Files and pages by status, and in all."""
    return files.status_totals(_manifest(spark, d))


@query("SELECT DISTINCT path, CASE WHEN status = 'pending' AND stem IN (SELECT stem FROM metadata) THEN 'skip' ELSE status END AS status FROM files")
def b_mark_skip(spark, d):
    """Pending files whose stem has metadata are marked to be skipped."""
    f = table(spark, d, "files").select("path", "stem", "status")
    have = f.join(table(spark, d, "metadata").select("stem").distinct(), "stem", "left_semi")
    return files.skip_pending(f, have.select("path")).select("path", "status").distinct()


_MEMBERS = """
    SELECT doc_id, source, n_chars AS size, md5(text) AS digest FROM documents WHERE text IS NOT NULL AND n_chars > 0
    QUALIFY count(*) OVER (PARTITION BY n_chars, md5(text)) > 1"""


def _members(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return files.duplicate_members(docs, "doc_id", F.col("n_chars"), F.col("text")).join(docs.select("doc_id", "source"), "doc_id")


@query(f"SELECT size, digest, count(*) AS n, min(doc_id) AS first_id FROM ({_MEMBERS}) GROUP BY size, digest")
def c_dup_sets(spark, d):
    """Sets of documents of equal content."""
    return files.duplicate_members(table(spark, d, "documents"), "doc_id", F.col("n_chars"), F.col("text")).groupBy("size", "digest").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id"))


_KEEPER = f"SELECT doc_id, size, digest FROM ({_MEMBERS}) QUALIFY row_number() OVER (PARTITION BY size, digest ORDER BY length(source), doc_id) = 1"


def _keepers(spark: SparkSession, d: str) -> DataFrame:
    return files.keepers(_members(spark, d), [F.col("source").isNull(), F.length("source"), F.col("doc_id")])


@query(_KEEPER)
def c_keeper(spark, d):
    """The document of each set that's kept: shortest source, then least id."""
    return _keepers(spark, d).select("doc_id", "size", "digest")


@query(f"SELECT doc_id FROM ({_MEMBERS}) WHERE doc_id NOT IN (SELECT doc_id FROM ({_KEEPER}))")
def c_skip_list(spark, d):
    """The redundant documents."""
    return _members(spark, d).join(_keepers(spark, d).select("doc_id"), "doc_id", "left_anti").select("doc_id")


@query(f"SELECT count(*) AS n, sum(doc_id)::BIGINT AS ids FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM ({_MEMBERS}) WHERE doc_id NOT IN (SELECT doc_id FROM ({_KEEPER})))")
def c_kept(spark, d):
    """How many documents are left without the redundant ones."""
    kept = table(spark, d, "documents").select("doc_id").join(c_skip_list(spark, d), "doc_id", "left_anti")
    return kept.agg(F.count("*").alias("n"), F.sum("doc_id").alias("ids"))


@query(f"""
    WITH f AS (SELECT path, pages, length(out) AS size, md5(out) AS digest FROM (SELECT DISTINCT path, pages, out FROM files WHERE out <> '')),
    s AS (SELECT size, digest, count(*) AS n, first(pages ORDER BY path, pages) AS pages FROM f GROUP BY size, digest HAVING count(*) > 1)
    SELECT coalesce(sum(coalesce(pages, 0) * (n - 1)), 0)::BIGINT AS redundant_pages FROM s""")
def c_redundant_pages(spark, d):
    """Pages that redundant copies of scanned files would take: of each set the first file's, by path, times the others."""
    f = table(spark, d, "files").where("out is not null").select("path", "pages", "out").distinct().withColumn("id", F.struct("path", "pages"))
    members = files.duplicate_members(f, "id", F.length("out"), F.col("out")).select("size", "digest", "id.path", "id.pages")
    return files.redundant_pages(members, [F.col("path"), F.col("pages")])


@query(f"SELECT coalesce(sum(size * (n - 1)), 0)::BIGINT AS redundant_chars FROM (SELECT size, digest, count(*) AS n FROM ({_MEMBERS}) GROUP BY size, digest)")
def c_redundant_total(spark, d):
    """Characters that redundant copies take."""
    return c_dup_sets(spark, d).agg(F.coalesce(F.sum(F.col("size") * (F.col("n") - 1)), F.lit(0)).alias("redundant_chars"))


def _window_sql(size: int, overlap: int) -> str:
    step = size - overlap
    return f"""
    WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '{SPACE}+'), lambda x: x <> '') AS w FROM documents WHERE text IS NOT NULL),
    s AS (SELECT doc_id, w, unnest(generate_series(0, len(w) - 1, {step})) AS ix FROM w WHERE len(w) > 0)
    SELECT doc_id, (ix // {step})::INT AS chunk_index, len(w[ix + 1:ix + {size}])::INT AS n_words, md5(array_to_string(w[ix + 1:ix + {size}], ' ')) AS digest FROM s"""


def _word_windows(spark: SparkSession, d: str, size: int, overlap: int) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", F.posexplode(chunking.word_windows(F.col("text"), size, overlap)).alias("chunk_index", "t"))
    return docs.select("doc_id", "chunk_index", F.size(F.split("t", " ", -1)).alias("n_words"), F.md5("t").alias("digest"))


@query(_window_sql(1000, 150))
def d_word_windows(spark, d):
    """Windows of 1,000 words, overlapping by 150."""
    return _word_windows(spark, d, 1000, 150)


@query(_window_sql(100, 15))
def d_word_windows_small(spark, d):
    """Windows of 100 words, overlapping by 15."""
    return _word_windows(spark, d, 100, 15)


@query(f"""
    WITH t AS (SELECT doc_id, {strip_sql('text')} AS t FROM documents WHERE text IS NOT NULL),
    s AS (SELECT doc_id, t, CASE WHEN length(t) <= 1500 THEN 0 ELSE ix END AS ix FROM (SELECT doc_id, t, unnest(generate_series(0, length(t) - 1, 1300)) AS ix FROM t WHERE t <> '') WHERE ix = 0 OR length(t) > 1500)
    SELECT doc_id, (ix // 1300)::INT AS chunk_index, length(substr(t, ix + 1, 1500))::INT AS n_chars, md5(substr(t, ix + 1, 1500)) AS digest FROM s""")
def d_char_windows(spark, d):
    """Windows of 1,500 characters, overlapping by 200."""
    w = table(spark, d, "documents").select("doc_id", F.posexplode(chunking.char_windows(F.col("text"))).alias("chunk_index", "t"))
    return w.select("doc_id", "chunk_index", F.length("t").alias("n_chars"), F.md5("t").alias("digest"))


@query(rf"""
    WITH f AS (SELECT DISTINCT path, out FROM files WHERE out IS NOT NULL),
    b AS (SELECT path, regexp_split_to_array(out, '\{{\d+\}}-{{20,}}') AS bodies, regexp_extract_all(out, '\{{(\d+)\}}-{{20,}}', 1) AS ids FROM f),
    p AS (SELECT path, bodies, ids, unnest(generate_series(0, len(bodies) - 1)) AS ord FROM b)
    SELECT path, ord::INT AS ord, (CASE WHEN ord = 0 THEN 1 ELSE ids[ord]::INT + 1 END)::INT AS page, md5({strip_sql('bodies[ord + 1]')}) AS digest FROM p WHERE ord > 0 OR len(bodies) = 1 OR {strip_sql('bodies[1]')} <> ''""")
def d_page_markers(spark, d):
    """Pages of paginated markdown."""
    f = table(spark, d, "files").where("out is not null").select("path", "out").distinct()
    pages = chunking.explode_pages(f, "path", chunking.pages_of_markdown(F.col("out")))
    return pages.select("path", "ord", "page", F.md5("text").alias("digest"))


@query()
def d_recursive_chunks(spark, d):
    """Recursive chunks of the paginated files, unreadable ones dropped."""
    f = table(spark, d, "files").where("out is not null").select("path", "out").distinct()
    chunks = chunking.chunk_pages(chunking.explode_pages(f, "path", chunking.pages_of_markdown(F.col("out"))), "path")
    return chunks.select("path", "page", "chunk_index", "n_tokens", F.md5("text").alias("digest"))


_GARBLE = """
    WITH t AS (SELECT row_id, regexp_extract_all(lower(text), '[a-z]{3,}') AS t FROM research WHERE text IS NOT NULL),
    v AS (SELECT row_id, len(t) AS n, len(list_filter(t, lambda x: NOT regexp_matches(x, '[aeiou]'))) AS bad FROM t)
    SELECT row_id, n::INT AS tokens, bad::INT AS vowelless, n < 12 OR bad <= 0.45 * n AS keep FROM v"""


@query(_GARBLE)
def d_garble(spark, d):
    """The unreadable-text filter over all chunks."""
    g = T.garble(F.col("text"))
    return table(spark, d, "research").where("text is not null").select("row_id", *(c.alias(n) for n, c in g.items()))


@query("SELECT row_id, concat(stem, '__p', page, '__c', chunk_index) = chunk_id AS same FROM research WHERE catalog_id IS NULL AND page IS NOT NULL AND chunk_index IS NOT NULL AND stem IS NOT NULL")
def d_chunk_ids(spark, d):
    """Chunk ids from their parts, against those stored."""
    rows = table(spark, d, "research").where("catalog_id is null and page is not null and chunk_index is not null and stem is not null")
    return rows.select("row_id", (T.chunk_id(F.col("stem"), F.col("page"), F.col("chunk_index")) == F.col("chunk_id")).alias("same"))


@query(f"SELECT count(*) AS chunks, round(avg(n_tokens), 4) AS mean_tokens, (count(*) FILTER (NOT keep)) AS dropped FROM research LEFT JOIN ({_GARBLE}) USING (row_id)")
def d_chunk_stats(spark, d):
    """Chunks, their mean length and how many the filter would drop."""
    keep = T.garble(F.col("text"))["keep"]
    return table(spark, d, "research").agg(F.count("*").alias("chunks"), F.round(F.avg("n_tokens"), 4).alias("mean_tokens"), F.count_if(~keep).alias("dropped"))
