"""The outbox of catalogue changes: claim, resolve, gate, apply, acknowledge, and reconcile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamplight.functions import text as T
from lamplight.models import PageParser
from lamplight.operators.chunking import char_windows
from lamplight.operators.files import latest, numbered_rows
from lamplight.operators.tables import replace_pending
from lamplight.sources.readers import read_documents

MOST_ATTEMPTS = 5


def claimable() -> Column:
    return F.col("processed_at").isNull() & (F.coalesce(F.col("attempts"), F.lit(0)) < MOST_ATTEMPTS)


def claim(queue: DataFrame, limit: int = 200) -> DataFrame:
    """The oldest `limit` rows that wait and have attempts left; a batch size, not a cap on the queue."""
    return queue.where(claimable()).orderBy("created_at", "id").limit(limit)


def queue_stats(queue: DataFrame) -> DataFrame:
    """One row (total, pending, done, failed), zeros for an empty queue."""
    return queue.agg(
        F.count("*").alias("total"),
        F.count_if(claimable()).alias("pending"),
        F.count_if(F.col("processed_at").isNotNull()).alias("done"),
        F.count_if(F.col("processed_at").isNull() & (F.col("attempts") >= MOST_ATTEMPTS)).alias("failed"),
    )


def latest_actions(rows: DataFrame) -> DataFrame:
    """The last row of each catalogue id, by created_at, id."""
    return latest(rows.where("catalog_id is not null"), ["catalog_id"], [F.col("created_at").desc_nulls_last(), F.desc("id")])


def live_catalog(view: DataFrame) -> DataFrame:
    return view.where("deleted_at is null")


def with_latest_media(view: DataFrame, media: DataFrame) -> DataFrame:
    """The catalogue with FileLocation of each id's newest medium that isn't deleted; null without one."""
    newest = latest(media.where("deleted_at is null"), ["catalog_id"], [F.desc("id")])
    return view.join(newest.select("catalog_id", "FileLocation"), "catalog_id", "left")


def public_path(location: Column, root: str) -> Column:
    return F.concat(F.lit(root.rstrip("/") + "/"), F.regexp_replace(F.regexp_replace(location, r"\\", "/"), "^/+", ""))


def gate(actions: DataFrame, view: DataFrame) -> DataFrame:
    """actions joined with the live catalogue, and what to do with each: delete, gone, on-hold or upsert."""
    live = live_catalog(view).withColumn("_there", F.lit(True))
    joined = actions.join(live, "catalog_id", "left")
    verdict = F.when(F.col("action") == "delete", "delete").when(F.col("_there").isNull(), "gone").when(~F.coalesce(F.col("is_published") == 1, F.lit(False)), "on-hold").otherwise("upsert")
    return joined.withColumn("verdict", verdict).drop("_there")


def metadata_blob() -> Column:
    """The labelled lines that stand for a catalogue record, stripped; publisher and year are stripped each and joined by a blank."""
    published = T.strip(F.concat_ws(" ", *(T.strip(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in ("publisher", "pub_year"))))
    return T.strip(T.labelled_blob({"Title": F.col("title_statement"), "Author(s)": F.col("joint_authors"), "Published": published, "Summary": F.col("summary"), "Note": F.col("general_note")}))


def catalog_chunks(gated: DataFrame, fulltext: Column | None = None) -> DataFrame:
    """Index rows of the records to upsert: windows of the metadata, then of the full text, numbered together."""
    parts = F.concat(char_windows(metadata_blob()), char_windows(F.coalesce(fulltext, F.lit("")))) if fulltext is not None else char_windows(metadata_blob())
    rows = gated.where("verdict = 'upsert'").select("catalog_id", F.posexplode(parts).alias("chunk_index", "text"))
    cid = F.col("catalog_id").cast("string")
    return rows.select(
        T.catalog_chunk_id(F.col("catalog_id"), F.col("chunk_index")).alias("chunk_id"), F.concat(F.lit("catalog:"), cid).alias("source"), F.concat(F.lit("catalog-"), cid).alias("stem"), F.lit(0).alias("page"), "chunk_index", F.lit(0).alias("n_tokens"), "text", "catalog_id"
    )


def apply_batch(index: DataFrame, rows: DataFrame, view: DataFrame) -> DataFrame:
    """The index after a batch of queue rows: the last action of each id, gated; every touched id is replaced or removed at once."""
    gated = gate(latest_actions(rows), view)
    touched = gated.select("catalog_id").distinct()
    kept = index.join(touched, "catalog_id", "left_anti")
    return kept.unionByName(catalog_chunks(gated), allowMissingColumns=True)


def acknowledge(queue: DataFrame, outcome: DataFrame, now: Column) -> DataFrame:
    """The queue after outcome(id, error): without an error done, with one another attempt, its text cut to 2,000 characters."""
    o = outcome.select("id", F.col("error").alias("_error"), F.lit(True).alias("_hit"))
    ok = F.col("_hit") & F.col("_error").isNull()
    bad = F.col("_hit") & F.col("_error").isNotNull()
    return (
        queue.join(o, "id", "left")
        .withColumn("processed_at", F.when(ok, now).otherwise(F.col("processed_at")))
        .withColumn("attempts", F.when(bad, F.coalesce("attempts", F.lit(0)) + 1).otherwise(F.col("attempts")))
        .withColumn("error", F.when(ok, F.lit(None)).when(bad, F.substring("_error", 1, 2000)).otherwise(F.col("error")))
        .select(*queue.columns)
    )


def acknowledged(queue: DataFrame, outcomes: DataFrame) -> DataFrame:
    """The queue after any number of batches' outcomes(id, error, at, version): one without an error is done, each with one another attempt.

    The error is the newest outcome's, cut to 2,000 characters, and null once a row is done.
    """
    error = F.substring("error", 1, 2000)
    o = outcomes.groupBy("id").agg(F.count_if(F.col("error").isNotNull()).cast("int").alias("_tries"), F.min(F.when(F.col("error").isNull(), F.col("at"))).alias("_done"), F.max_by(error, "version").alias("_error"), F.lit(True).alias("_hit"))
    joined = queue.join(o, "id", "left")
    done = F.coalesce("processed_at", "_done")
    last = F.when(F.col("_hit"), F.when(F.col("_done").isNull(), F.col("_error"))).otherwise(F.col("error"))
    return joined.withColumns({"processed_at": done, "attempts": F.coalesce("attempts", F.lit(0)) + F.coalesce("_tries", F.lit(0)), "error": last}).select(*queue.columns)


def located(rows: DataFrame, media: DataFrame, files: DataFrame, root: str) -> DataFrame:
    """rows with path, the public path of each catalogue id's newest medium that isn't deleted; null without one, or if files(path) lacks it."""
    placed = with_latest_media(rows, media).withColumn("path", public_path(F.col("FileLocation"), root)).drop("FileLocation")
    there = files.select("path").distinct().withColumn("_there", F.lit(True))
    return placed.join(there, "path", "left").withColumn("path", F.when(F.col("_there"), F.col("path"))).select(*rows.columns, "path")


def full_texts(rows: DataFrame, contents: DataFrame, parser: PageParser) -> DataFrame:
    """(catalog_id, fulltext) of rows(catalog_id, path): the page texts of contents(path, content), joined by line breaks and stripped.

    A record without a path or with a file that can't be read has an empty text.
    """
    wanted = rows.where("path is not null").select("path").distinct()
    return rows.select("catalog_id", "path").join(read_documents(contents.join(wanted, "path", "left_semi"), parser), "path", "left").select("catalog_id", F.coalesce("text", F.lit("")).alias("fulltext"))


def enqueued(queue: DataFrame, ids: DataFrame, action: str, reason: str, now: Column, first_id: int) -> DataFrame:
    """The queue after one new row for each distinct id of ids(catalog_id) replaces that id's pending rows: attempts 0, created now, ids from first_id by catalog_id."""
    new = ids.where("catalog_id is not null and catalog_id <> 0").select("catalog_id").distinct()
    numbered = numbered_rows(new, ["catalog_id"], first_id)
    rows = numbered.select(F.col("n").alias("id"), "catalog_id", F.lit(action).alias("action"), F.lit(reason).alias("reason"), F.lit(0).alias("attempts"), now.alias("created_at"))
    return replace_pending(queue, rows)


def reconcile(view: DataFrame, index: DataFrame) -> DataFrame:
    """(catalog_id, action): published records that aren't indexed to upsert, indexed ones that aren't published to delete."""
    published = live_catalog(view).where("is_published = 1").select("catalog_id").distinct()
    indexed = index.where("catalog_id is not null").select("catalog_id").distinct()
    missing = published.join(indexed, "catalog_id", "left_anti").withColumn("action", F.lit("upsert"))
    stale = indexed.join(published, "catalog_id", "left_anti").withColumn("action", F.lit("delete"))
    return missing.unionByName(stale)
