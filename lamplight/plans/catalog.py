"""Queries of catalogue extraction and synchronisation."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamplight.functions import text as T
from lamplight.models import Generator
from lamplight.operators import catalog as C
from lamplight.operators import sync, tables
from lamplight.operators.chunking import abstract_of
from lamplight.plans.registry import SPACE, query, strip_sql
from lamplight.session import table

# The SQL writes every fixed value out itself, so that a wrong one in the operators shows.
_NULLS = "'none', 'null', 'n/a', 'na', 'unknown', 'not stated', 'not specified'"


def _clean_sql(c: str) -> str:
    quotes = """'^"+|"+$'"""
    bare = strip_sql(f"regexp_replace({strip_sql(f'CAST({c} AS VARCHAR)')}, {quotes}, '', 'g')")
    return f"(CASE WHEN {bare} = '' OR lower({bare}) IN ({_NULLS}) THEN NULL ELSE {bare} END)"


@query("""
    SELECT stem, md5(substr(string_agg(text, chr(10) ORDER BY n), 1, 2800)) AS digest
    FROM (SELECT stem, text, row_number() OVER (PARTITION BY stem ORDER BY page NULLS LAST, chunk_index NULLS LAST, chunk_id, row_id) AS n FROM research WHERE text IS NOT NULL) WHERE n <= 3 GROUP BY stem""")
def f_front_matter(spark, d):
    """The front matter of each document."""
    rows = table(spark, d, "research").withColumn("chunk_id", F.concat_ws("\u0000", "chunk_id", "row_id"))
    return C.front_matter(rows).select("stem", F.md5("front").alias("digest"))


@query("SELECT stem, max(page) AS pages FROM research WHERE catalog_id IS NULL GROUP BY stem")
def f_last_page(spark, d):
    """The last page of each document; catalogue-owned rows are none."""
    return C.last_pages(table(spark, d, "research"))


@query(f"SELECT meta_id, md5({_clean_sql('title')}) AS title, {_clean_sql('publisher')} AS publisher, substr({_clean_sql('year')}, 1, 4) AS year, {_clean_sql('language')} AS language, CASE WHEN {_clean_sql('type')} IN ('Books', 'Serials', 'Thesis/Dissertations', 'Technical Reports', 'Investigatory Projects', 'Vertical Files', 'Non-Prints') THEN {_clean_sql('type')} ELSE 'Books' END AS type FROM metadata")
def f_clean_nulls(spark, d):
    """Metadata with null words as nulls, years cut, types known."""
    c = F.col
    return table(spark, d, "metadata").select("meta_id", F.md5(T.clean_null(c("title"))).alias("title"), T.clean_null(c("publisher")).alias("publisher"), T.year(c("year")).alias("year"), T.clean_null(c("language")).alias("language"), T.known_type(c("type")).alias("type"))


_PATTERN = r"(?i)\b(restricted|confidential|not\s+for\s+public|not\s+for\s+circulation|not\s+for\s+distribution|internal\s+use\s+only|for\s+official\s+use\s+only|embargo|embargoed|do\s+not\s+distribute)\b".replace(r"\s", SPACE)


@query(f"SELECT meta_id, coalesce(regexp_matches(title, '{_PATTERN}'), false) OR coalesce(regexp_matches(abstract, '{_PATTERN}'), false) OR coalesce(restricted, false) AS hit FROM metadata")
def f_restricted(spark, d):
    """Metadata records that are restricted by their words or by their flag."""
    return table(spark, d, "metadata").select("meta_id", (T.is_restricted(F.col("title"), F.col("abstract")) | F.col("restricted").eqNullSafe(F.lit(True))).alias("hit"))


_FLAGS = f"""
    SELECT meta_id, list_filter([CASE WHEN {_clean_sql('title')} IS NULL OR length({_clean_sql('title')}) < 4 THEN 'no-title' END,
        CASE WHEN coalesce(regexp_matches(stem, '{_PATTERN}'), false) OR coalesce(regexp_matches(substr(abstract, 1, 2000), '{_PATTERN}'), false) OR coalesce(restricted, false) THEN 'restricted' END,
        CASE WHEN is_research = false THEN 'junk' END], lambda x: x IS NOT NULL) AS f FROM metadata"""


def _flags(spark: SparkSession, d: str) -> DataFrame:
    made = C.flags(T.clean_null(F.col("title")), F.col("stem"), F.col("abstract"), F.col("restricted"), F.col("is_research"))
    return table(spark, d, "metadata").select("meta_id", "type", made.alias("flags"))


@query(f"SELECT meta_id, array_to_string(f, ',') AS flags, CASE f[1] WHEN 'no-title' THEN 'No title could be read from the document' WHEN 'restricted' THEN 'Marked restricted / not for open circulation' WHEN 'junk' THEN 'Not research output (form, receipt, memo or similar)' END AS reason FROM ({_FLAGS})")
def f_triage_flags(spark, d):
    """The triage flags of every metadata record, in order, and the reason."""
    return _flags(spark, d).select("meta_id", F.array_join("flags", ",").alias("flags"), C.reason(F.col("flags")).alias("reason"))


@query(f"SELECT flag, count(*) AS n FROM (SELECT unnest(f) AS flag FROM ({_FLAGS})) GROUP BY flag UNION ALL SELECT '(published)', count(*) FROM ({_FLAGS}) WHERE len(f) = 0")
def f_flag_rollup(spark, d):
    """Records by flag, and those without one."""
    return C.flag_counts(_flags(spark, d))


@query(f"SELECT type, count(*) AS n FROM metadata JOIN ({_FLAGS}) USING (meta_id) WHERE len(f) = 0 GROUP BY type")
def f_published_types(spark, d):
    """Types of the records without flags."""
    return C.published_types(_flags(spark, d))


@query("SELECT DISTINCT stem FROM research WHERE catalog_id IS NULL AND stem IS NOT NULL AND stem NOT IN (SELECT stem FROM metadata WHERE stem IS NOT NULL AND NOT coalesce(list_contains(flags, 'error'), false))")
def f_resume(spark, d):
    """Documents that still need metadata; error records are tried again."""
    stems = table(spark, d, "research").where("catalog_id is null and stem is not null").select("stem").distinct()
    return C.todo(stems, table(spark, d, "metadata").where("stem is not null"))


_BLANK = SPACE[1:-1]
_HEAD = rf"(?is)^(.*?(?:^|\n)[{_BLANK}#*_>]*(?:abstract|summary)[{_BLANK}*_:.\-]*(?:\n|\z))"
_CLOSE = rf"(?i)\n[{_BLANK}#*_>]*(?:introduction|table of contents|contents|acknowledg|chapter|literature (?:cited|review)|review of literature|materials and methods|methodology|references|bibliography|list of (?:tables|figures))\b"


@query(rf"""
    WITH r AS (SELECT DISTINCT stem, page, chunk_index, text, md5(text) AS h FROM research WHERE stem IS NOT NULL AND text IS NOT NULL),
    o AS (SELECT *, lead(text) OVER w AS following, row_number() OVER w AS n FROM r WINDOW w AS (PARTITION BY stem ORDER BY page NULLS LAST, chunk_index NULLS LAST, h)),
    f AS (SELECT *, length(regexp_extract(substr(text, 1, 600), '{_HEAD}', 1)) AS cut FROM o WHERE regexp_matches(substr(text, 1, 600), '{_HEAD}')),
    b AS (SELECT stem, regexp_split_to_array(concat_ws(chr(10), substr(text, cut + 1), following), '{_CLOSE}')[1] AS body FROM f QUALIFY row_number() OVER (PARTITION BY stem ORDER BY n) = 1),
    c AS (SELECT stem, trim(regexp_replace(body, '{SPACE}+', ' ', 'g')) AS body FROM b)
    SELECT stem, CASE WHEN length(body) > 120 THEN md5(substr(body, 1, 4000)) END AS abstract FROM c""")
def f_abstract(spark, d):
    """Abstracts found under their heading."""
    return abstract_of(table(spark, d, "research")).select("stem", F.md5("abstract").alias("abstract"))


def _deterministic() -> Generator:
    """A stand-in model: it quotes the front matter's first 40 characters as the title, fenced, and fails on some of it."""
    import json

    def generate(prompt: str) -> str:
        if "nitrogen" in prompt:
            raise ValueError("too much nitrogen")
        if "irrigation" in prompt:
            return "I cannot say."
        title = prompt[:40]
        return "```json\n" + json.dumps({"title": title, "year": f"{len(prompt)}-x", "type": "Serials" if len(prompt) % 2 else "Maps", "is_research": len(prompt) % 3 > 0, "restricted": None, "authors": "N/A", "statement_of_responsibility": "by X"}) + "\n```"

    return generate


@query(f"""
    WITH o AS (SELECT stem, text, row_number() OVER (PARTITION BY stem ORDER BY page NULLS LAST, chunk_index NULLS LAST, chunk_id, row_id) AS n FROM research WHERE text IS NOT NULL AND stem IS NOT NULL),
    d AS (SELECT stem, max(page) AS pages FROM research WHERE stem IS NOT NULL GROUP BY stem),
    f AS (SELECT stem, substr(string_agg(text, chr(10) ORDER BY n) FILTER (n <= 3), 1, 2800) AS front, substr(string_agg(text, chr(10) ORDER BY n) FILTER (n <= 6), 1, 2000) AS opening FROM o GROUP BY stem),
    r AS (SELECT stem, pages, front, opening, coalesce({strip_sql('front')}, '') = '' AS blank, contains(front, 'nitrogen') AS failed, contains(front, 'irrigation') AS odd, substr(front, 1, 40) AS raw_title, length(front) AS n FROM d LEFT JOIN f USING (stem)),
    c AS (SELECT *, {_clean_sql('raw_title')} AS title FROM r),
    g AS (SELECT *, list_filter([CASE WHEN title IS NULL OR length(title) < 4 THEN 'no-title' END, CASE WHEN regexp_matches(stem, '{_PATTERN}') OR regexp_matches(opening, '{_PATTERN}') THEN 'restricted' END, CASE WHEN n % 3 = 0 THEN 'junk' END], lambda x: x IS NOT NULL) AS f FROM c)
    SELECT stem, pages, CASE WHEN blank OR failed OR odd THEN NULL ELSE md5(title) END AS title, CASE WHEN blank OR failed OR odd THEN NULL ELSE substr(n || '-x', 1, 4) END AS year,
        CASE WHEN blank OR failed OR odd THEN NULL WHEN n % 2 = 1 THEN 'Serials' ELSE 'Books' END AS type, CASE WHEN blank OR failed OR odd THEN NULL ELSE 'by X' END AS responsibility,
        CASE WHEN blank THEN 'no-title' WHEN failed OR odd THEN 'error' ELSE array_to_string(f, ',') END AS flags,
        CASE WHEN blank THEN 'No readable text in the index' WHEN failed OR odd THEN 'Extraction failed: ValueError' ELSE CASE f[1] WHEN 'no-title' THEN 'No title could be read from the document' WHEN 'restricted' THEN 'Marked restricted / not for open circulation' WHEN 'junk' THEN 'Not research output (form, receipt, memo or similar)' END END AS reason,
        CASE WHEN blank THEN NULL WHEN failed THEN 'too much nitrogen' WHEN odd THEN 'no JSON object in the answer' END AS error FROM g""")
def f_extract(spark, d):
    """Catalogue records of all documents, by a deterministic model that fails on some."""
    rows = table(spark, d, "research").withColumn("chunk_id", F.concat_ws("\u0000", "chunk_id", "row_id"))
    made = C.extract(rows, _deterministic)
    return made.select("stem", "pages", F.md5("title").alias("title"), "year", "type", "responsibility", F.array_join("flags", ",").alias("flags"), "reason", "error")


@query("SELECT event_id, json_extract_string(props, '$.k')::INT AS k FROM events")
def f_json_salvage(spark, d):
    """A number out of fenced and prose-wrapped JSON."""
    wrapped = F.concat(F.lit("Here it is:\n```json\n"), "props", F.lit("\n```\nDone."))
    return table(spark, d, "events").select("event_id", F.get_json_object(T.json_body(wrapped), "$.k").cast("int").alias("k"))


_WAITS = "processed_at IS NULL AND coalesce(attempts, 0) < 5"


@query(f"SELECT id, catalog_id, action FROM queue WHERE {_WAITS} ORDER BY created_at, id LIMIT 200")
def g_claim_batch(spark, d):
    """The next batch of the outbox."""
    return sync.claim(table(spark, d, "queue")).select("id", "catalog_id", "action")


@query(f"SELECT count(*) AS total, count(*) FILTER ({_WAITS}) AS pending, count(*) FILTER (processed_at IS NOT NULL) AS done, count(*) FILTER (processed_at IS NULL AND attempts >= 5) AS failed FROM queue")
def g_queue_stats(spark, d):
    """The outbox in one row."""
    return sync.queue_stats(table(spark, d, "queue"))


_LAST = "SELECT * FROM queue WHERE catalog_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY catalog_id ORDER BY created_at DESC NULLS LAST, id DESC) = 1"


@query(f"SELECT catalog_id, id, action FROM ({_LAST})")
def g_latest_action(spark, d):
    """The last action of every record."""
    return sync.latest_actions(table(spark, d, "queue")).select("catalog_id", "id", "action")


@query("""
    WITH p AS (SELECT DISTINCT catalog_id FROM view_catalogs WHERE deleted_at IS NULL AND is_published = 1), i AS (SELECT DISTINCT catalog_id FROM research WHERE catalog_id IS NOT NULL)
    SELECT catalog_id, 'upsert' AS action FROM p WHERE catalog_id NOT IN (SELECT catalog_id FROM i) UNION ALL SELECT catalog_id, 'delete' FROM i WHERE catalog_id NOT IN (SELECT catalog_id FROM p)""")
def g_reconcile(spark, d):
    """What's published and not indexed, and the reverse."""
    return sync.reconcile(table(spark, d, "view_catalogs"), table(spark, d, "research"))


@query("""
    WITH n AS (SELECT DISTINCT catalog_id FROM view_catalogs WHERE is_published = 1)
    SELECT id, catalog_id FROM queue WHERE processed_at IS NOT NULL OR catalog_id IS NULL OR catalog_id NOT IN (SELECT catalog_id FROM n) UNION ALL SELECT -catalog_id, catalog_id FROM n""")
def g_pending_dedupe(spark, d):
    """The outbox after a new row for each published record replaces the pending ones."""
    new = table(spark, d, "view_catalogs").where("is_published = 1").select("catalog_id").distinct().withColumn("id", -F.col("catalog_id"))
    return tables.replace_pending(table(spark, d, "queue").select("id", "catalog_id", "processed_at"), new).select("id", "catalog_id")


_PUBLISHED = strip_sql(f"concat({strip_sql("coalesce(publisher, '')")}, ' ', {strip_sql("coalesce(pub_year, '')")})")
_BLOB = strip_sql(f"concat_ws(chr(10), 'Title: ' || nullif(title_statement, ''), 'Author(s): ' || nullif(joint_authors, ''), 'Published: ' || nullif({_PUBLISHED}, ''), 'Summary: ' || nullif(summary, ''), 'Note: ' || nullif(general_note, ''))")


@query(f"SELECT catalog_id, md5({_BLOB}) AS digest FROM view_catalogs")
def g_metadata_blob(spark, d):
    """Every record as labelled lines."""
    return table(spark, d, "view_catalogs").select("catalog_id", F.md5(sync.metadata_blob()).alias("digest"))


_GATE = f"""
    SELECT q.catalog_id, q.action, CASE WHEN q.action = 'delete' THEN 'delete' WHEN v.catalog_id IS NULL THEN 'gone' WHEN coalesce(v.is_published, 0) <> 1 THEN 'on-hold' ELSE 'upsert' END AS verdict
    FROM ({_LAST}) q LEFT JOIN (SELECT * FROM view_catalogs WHERE deleted_at IS NULL) v ON q.catalog_id = v.catalog_id"""


@query(_GATE)
def g_gate(spark, d):
    """What becomes of the last action of every record."""
    return sync.gate(sync.latest_actions(table(spark, d, "queue")), table(spark, d, "view_catalogs")).select("catalog_id", "action", "verdict")


_APPLIED = f"""
    WITH g AS ({_GATE.replace(_LAST, f"SELECT * FROM queue WHERE catalog_id IS NOT NULL AND {_WAITS} QUALIFY row_number() OVER (PARTITION BY catalog_id ORDER BY created_at DESC NULLS LAST, id DESC) = 1")}),
    b AS (SELECT v.catalog_id, {_BLOB} AS t FROM view_catalogs v JOIN g ON v.catalog_id = g.catalog_id AND g.verdict = 'upsert' WHERE v.deleted_at IS NULL),
    n AS (SELECT catalog_id, CASE WHEN t = '' THEN 0 WHEN length(t) <= 1500 THEN 1 ELSE ceil(length(t) / 1300)::INT END AS n FROM b)
    SELECT catalog_id, count(*) AS chunks FROM research WHERE catalog_id IS NOT NULL AND catalog_id NOT IN (SELECT catalog_id FROM g) GROUP BY catalog_id
    UNION ALL SELECT catalog_id, n::BIGINT FROM n WHERE n > 0"""


@query(_APPLIED)
def g_apply_batch(spark, d):
    """Chunks of each record after the waiting outbox is applied as one batch."""
    index = table(spark, d, "research").drop("row_id", "vector")
    after = sync.apply_batch(index, table(spark, d, "queue").where(sync.claimable()), table(spark, d, "view_catalogs"))
    return after.where("catalog_id is not null").groupBy("catalog_id").agg(F.count("*").alias("chunks"))


_DRAINED = _APPLIED.replace("SELECT catalog_id, count(*) AS chunks FROM research", "SELECT 'index' AS part, catalog_id AS key, count(*) AS n FROM research").replace("UNION ALL SELECT catalog_id, n::BIGINT FROM n", "UNION ALL SELECT 'index', catalog_id, n::BIGINT FROM n")


@query(f"{_DRAINED} UNION ALL SELECT 'queue', id, CASE WHEN processed_at IS NULL AND coalesce(attempts, 0) < 5 THEN 1 ELSE 0 END + 10 * coalesce(attempts, 0) FROM queue")
def g_drain_stream(spark, d):
    """The same by the streaming drain, and what becomes of the queue: every waiting row is done now, without another attempt."""
    from lamplight.session import shared_folder
    from lamplight.streaming.drain import INDEX, Drain

    root = f"{shared_folder(spark)}/drain-{uuid.uuid4().hex}"
    columns = [c.split()[0] for c in INDEX.split(", ")]
    table(spark, d, "research").where("catalog_id is not null").select(*columns).write.parquet(f"{root}/index/base")
    table(spark, d, "queue").write.parquet(f"{root}/queue")
    view = table(spark, d, "view_catalogs")
    drain = Drain(spark, lambda: view, f"{root}/queue", f"{root}/index")
    drain.start(f"{root}/checkpoint").awaitTermination()
    chunks = drain.index().groupBy(F.col("catalog_id").alias("key")).agg(F.count("*").alias("n")).select(F.lit("index").alias("part"), "key", "n")
    before = table(spark, d, "queue").select("id", F.col("processed_at").isNull().alias("waited"))
    now = drain.queue().join(before, "id").select(F.lit("queue").alias("part"), F.col("id").alias("key"), (F.when(F.col("waited") & F.col("processed_at").isNotNull(), 1).otherwise(0) + 10 * F.col("attempts")).cast("bigint").alias("n"))
    return chunks.unionByName(now)


@query("""
    WITH m AS (SELECT 1 + meta_id % 200 AS catalog_id, pdf, row_number() OVER (PARTITION BY meta_id % 200 ORDER BY meta_id DESC) AS n FROM metadata WHERE meta_id % 7 <> 0)
    SELECT v.catalog_id, CASE WHEN m.pdf IN (SELECT path FROM files) THEN '/srv/' || ltrim(m.pdf, '/') END AS path FROM (SELECT catalog_id FROM view_catalogs WHERE deleted_at IS NULL) v LEFT JOIN (SELECT * FROM m WHERE n = 1) m USING (catalog_id)""")
def g_latest_media(spark, d):
    """The file of every live record: its newest medium that isn't deleted, by public path, if there is such a file."""
    deleted = F.when(F.col("meta_id") % 7 == 0, F.current_timestamp())
    media = table(spark, d, "metadata").select(F.col("meta_id").alias("id"), (1 + F.col("meta_id") % 200).alias("catalog_id"), F.translate("pdf", "/", "\\").alias("FileLocation"), deleted.alias("deleted_at"))
    files = table(spark, d, "files").select(sync.public_path(F.col("path"), "/srv").alias("path"))
    live = sync.live_catalog(table(spark, d, "view_catalogs")).select("catalog_id")
    return sync.located(live, media, files, "/srv")
