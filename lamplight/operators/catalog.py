"""Catalogue metadata: front matter, model output to records, triage flags, resume and statistics."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lamplight.functions import text as T
from lamplight.models import Generator
from lamplight.operators.chunking import abstract_of
from lamplight.session import materialize
from lamplight.sources.sinks import append_version, exists, overwrite_staged

#: The fields of a model's answer, the reasons of the flags, and of a document without readable text.
RECORD = "title string, authors string, statement_of_responsibility string, year string, publisher string, language string, abstract string, subjects string, type string, is_research string, restricted string"
REASONS = {"no-title": "No title could be read from the document", "restricted": "Marked restricted / not for open circulation", "junk": "Not research output (form, receipt, memo or similar)"}
NO_TEXT = "No readable text in the index"


def front_matter(chunks: DataFrame, key: str = "stem", parts: int = 3, most: int = 2800) -> DataFrame:
    """(key, front): a document's first `parts` chunks in reading order, joined by line breaks, cut to `most` characters.

    Only the first chunks of each document are gathered, by a rank limit before the shuffle.
    """
    order = [F.col("page").asc_nulls_last(), F.col("chunk_index").asc_nulls_last(), F.col("chunk_id")]
    first = chunks.where("text is not null").withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col("_n") <= parts)
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_n", "text"))), lambda x: x["text"]), "\n")
    return first.groupBy(key).agg(T.snippet(joined, most).alias("front"))


def last_pages(chunks: DataFrame, key: str = "stem", corpus_only: bool = True) -> DataFrame:
    """(key, pages): the highest page of each document; rows owned by the catalogue are no documents."""
    rows = chunks.where("catalog_id is null") if corpus_only else chunks
    return rows.groupBy(key).agg(F.max("page").alias("pages"))


def parse_record(raw: Column) -> Column:
    """A record from a model's answer; null where it holds no valid JSON object."""
    return F.from_json(T.json_body(raw), RECORD)


def normalised(record: Column) -> dict[str, Column]:
    """The fields of a record, cleaned; restricted and is_research stay true, false or null."""
    names = {c: c for c in ("title", "authors", "publisher", "language", "abstract", "subjects")} | {"responsibility": "statement_of_responsibility"}
    plain = {c: T.clean_null(record[given]) for c, given in names.items()}
    truth = lambda c: F.when(F.lower(record[c]) == "true", True).when(F.lower(record[c]) == "false", False)
    return plain | {"year": T.year(record["year"]), "type": T.known_type(record["type"]), "is_research": truth("is_research"), "restricted": truth("restricted")}


def flags(title: Column, stem: Column, opening: Column, restricted: Column, is_research: Column) -> Column:
    """The ordered triage flags: no-title, restricted, junk."""
    return F.array_compact(
        F.array(
            F.when(title.isNull() | (F.length(title) < 4), "no-title"),
            F.when(T.is_restricted(stem, T.snippet(opening, 2000)) | restricted.eqNullSafe(F.lit(True)), "restricted"),
            F.when(is_research.eqNullSafe(F.lit(False)), "junk"),
        )
    )


def reason(flags_: Column) -> Column:
    """Why a record is held back: by its first flag."""
    table = F.create_map(*(F.lit(x) for pair in REASONS.items() for x in pair))
    return F.element_at(table, F.get(flags_, F.lit(0)))


def todo(stems: DataFrame, done: DataFrame, key: str = "stem") -> DataFrame:
    """The stems that have no finished record; error records don't count as finished."""
    finished = done.where(~F.coalesce(F.array_contains("flags", "error"), F.lit(False))).select(key).distinct()
    return stems.join(finished, key, "left_anti")


def flag_counts(records: DataFrame) -> DataFrame:
    """(flag, n), and how many are published, that is without flags, as flag '(published)'."""
    each = records.select(F.explode("flags").alias("flag")).groupBy("flag").agg(F.count("*").alias("n"))
    clear = records.agg(F.count_if(F.coalesce(F.size("flags"), F.lit(0)) <= 0).alias("n")).select(F.lit("(published)").alias("flag"), "n")
    return each.unionByName(clear)


def published_types(records: DataFrame) -> DataFrame:
    return records.where(F.coalesce(F.size("flags"), F.lit(0)) <= 0).groupBy("type").agg(F.count("*").alias("n"))


# --- extraction -------------------------------------------------------------

#: Consecutive backend failures after which a run stops; characters kept of an error; chunks whose text is searched for phrases.
MOST_FAILURES, ERROR_CHARS, OPENING_CHUNKS = 8, 200, 6
OUTPUT = "stem string, pages int, title string, authors string, responsibility string, year string, publisher string, language string, abstract string, subjects string, type string, is_research boolean, restricted boolean, flags array<string>, reason string, error string"


class BackendDown(RuntimeError):
    """The model endpoint can't be used: nothing should be written as if it were the documents' fault."""


#: Errors of the backend, not of the document: they count towards the end of a run.
BACKEND_ERRORS = (BackendDown, ConnectionError, TimeoutError)


def check_backend(generator: Generator) -> None:
    """Raise BackendDown unless the model gives some text: to be called before a run."""
    try:
        answer = generator("Reply with only: OK")
    except Exception as e:
        raise BackendDown(f"the model will not generate ({type(e).__name__}: {str(e)[:120]})") from e
    if not isinstance(answer, str) or not answer.strip():
        raise BackendDown("the model gives no text")


def _ask(make: Callable[[], Generator], prompt: str, most: int, it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Documents with the model's raw answer or an error; after `most` backend failures in a row the rest of the task isn't asked any more."""
    generator = make()
    failures = 0
    for df in it:
        raw: list = []
        errors: list = []
        down: list = []
        for front in df["front"]:
            answer = error = None
            backend = False
            if failures >= most:
                backend, error = True, "BackendDown: not asked"
            elif isinstance(front, str) and front.strip():
                try:
                    answer, failures = generator(prompt % front if "%s" in prompt else f"{prompt}\n{front}"), 0
                except Exception as e:  # noqa: BLE001 - a document must not fail the others
                    backend = isinstance(e, BACKEND_ERRORS)
                    failures = failures + 1 if backend else 0
                    error = f"{type(e).__name__}: {e}"
            raw.append(answer)
            errors.append(error)
            down.append(backend)
        yield df.assign(raw=raw, failure=errors, down=down)


def extract(chunks: DataFrame, make: Callable[[], Generator], prompt: str = "%s", key: str = "stem", most_failures: int = MOST_FAILURES) -> DataFrame:
    """One record a document of chunks(key, chunk_id, page, chunk_index, text), with the columns OUTPUT and down.

    The front matter goes to the model that make() gives, once a task; its answer is salvaged, parsed and cleaned, the abstract is lifted from the
    text, and flags tell what holds the record back. A document without readable text has flag no-title and no other field; one whose
    model call or answer failed has flag error and the error's text, cut to 200 characters. down marks failures of the backend: from
    `most_failures` in a row on a task asks no more, and all of the rest are marked. Documents whose key is null are left out.
    """
    rows = chunks.where(F.col(key).isNotNull())
    pages = rows.groupBy(key).agg(F.max("page").alias("pages"))
    fronts = front_matter(rows, key).join(front_matter(rows, key, OPENING_CHUNKS, 2000).withColumnRenamed("front", "opening"), key)
    kind = dict(rows.dtypes)[key]
    docs = pages.join(fronts, key, "left").select(key, "pages", "front", "opening")
    asked = materialize(docs.mapInPandas(partial(_ask, make, prompt, most_failures), f"`{key}` {kind}, pages int, front string, opening string, raw string, failure string, down boolean"), "extract")
    asked = asked.join(abstract_of(rows, key).withColumnRenamed("abstract", "found"), key, "left").withColumn("r", parse_record(F.col("raw")))
    blank = F.coalesce(T.strip(F.col("front")), F.lit("")) == ""
    unread = F.when(F.col("r").isNull() & F.col("failure").isNull() & ~blank, "ValueError: no JSON object in the answer")
    failure = F.coalesce("failure", unread)
    fields = normalised(F.col("r")) | {"abstract": F.col("found")}
    made = asked.select(F.col(key).alias("stem"), "pages", "opening", "down", blank.alias("_blank"), failure.alias("_failure"), *(c.alias(n) for n, c in fields.items()))
    ok = ~F.col("_blank") & F.col("_failure").isNull()
    shown = flags(F.col("title"), F.col("stem"), F.col("opening"), F.col("restricted"), F.col("is_research"))
    given = F.when(F.col("_blank"), F.array(F.lit("no-title"))).when(F.col("_failure").isNotNull(), F.array(F.lit("error"))).otherwise(shown)
    name = F.regexp_extract("_failure", "^[^:]*", 0)
    why = F.when(F.col("_blank"), NO_TEXT).when(F.col("_failure").isNotNull(), F.concat(F.lit("Extraction failed: "), name)).otherwise(reason(shown))
    text = F.when(F.col("_failure").isNotNull() & ~F.col("_blank"), F.substring(F.regexp_replace("_failure", "^[^:]*: ?", ""), 1, ERROR_CHARS))
    own = {c.split()[0]: c.split(" ", 1)[1] for c in OUTPUT.split(", ")}
    columns = {"stem": F.col("stem"), "pages": F.col("pages"), "flags": given, "reason": why, "error": text}
    return made.select(*(columns.get(c, F.when(ok, F.col(c))).cast(t).alias(c) for c, t in own.items()), "down")


def without_errors(records: DataFrame) -> DataFrame:
    """The records that count as done: those without flag error."""
    return records.where(~F.coalesce(F.array_contains("flags", "error"), F.lit(False)))


def purge_errors(spark: SparkSession, path: str) -> int:
    """Drop the error records at path, by one staged rewrite, so that they're tried again; how many there were."""
    records = spark.read.schema(f"{OUTPUT}, version long").parquet(path)
    bad = records.count() - without_errors(records).count()
    if bad:
        overwrite_staged(without_errors(records), path, partition_by=["version"])
    return bad


def run_extraction(chunks: DataFrame, make: Callable[[], Generator], path: str, prompt: str = "%s", limit: int | None = None, most_failures: int = MOST_FAILURES) -> dict:
    """Extract the documents of chunks that have no finished record at path, and append their records: {asked, records, errors, aborted}.

    Fails with BackendDown before anything is written if the model gives no text. A run resumes: error records are tried again, and a document's
    newest record counts (read_records()). Records of documents that the backend, not the document, failed aren't written if the run was
    aborted, that is if some task met most_failures of them in a row. limit takes the first so many documents by stem.
    """
    spark = chunks.sparkSession
    check_backend(make())
    stems = chunks.where("stem is not null").select("stem").distinct()
    done = read_records(spark, path)
    waiting = todo(stems, done) if done is not None else stems
    waiting = waiting.orderBy("stem").limit(limit) if limit else waiting
    waiting = materialize(waiting, "extract-stems")
    made = materialize(extract(chunks.join(waiting, "stem", "left_semi"), make, prompt, most_failures=most_failures), "extract-records")
    counts = made.agg(F.count("*").alias("asked"), F.count_if(F.array_contains("flags", "error") & ~F.col("down")).alias("errors"), F.count_if("down").alias("down"), F.count_if((F.col("error") == "not asked") & F.col("down")).alias("skipped")).first()
    aborted = counts.skipped > 0
    kept = (made.where(~F.coalesce("down", F.lit(False))) if aborted else made).drop("down")
    version = 1 + (done.agg(F.max("version")).first()[0] or 0 if done is not None else 0)
    if counts.asked:
        append_version(kept, path, version)
    return {"asked": counts.asked, "records": counts.asked - (counts.down if aborted else 0), "errors": counts.errors + (0 if aborted else counts.down), "aborted": aborted}


def read_records(spark: SparkSession, path: str) -> DataFrame | None:
    """Of each stem the newest record at path, with its version; None if nothing is there yet."""
    if not exists(spark, path):
        return None
    rows = spark.read.schema(f"{OUTPUT}, version long").parquet(path)
    newest = rows.groupBy("stem").agg(F.max("version").alias("version"))
    return rows.join(newest, ["stem", "version"], "left_semi")
