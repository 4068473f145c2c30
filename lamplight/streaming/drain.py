"""Draining the outbox: bounded batches, append-only changes to the index, acknowledgement, and retries by attempts."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamplight.functions.text import clamp
from lamplight.models import Encoder
from lamplight.operators.sync import acknowledged, catalog_chunks, claim, claimable, gate, latest_actions
from lamplight.session import materialize
from lamplight.sources.sinks import append_version, exists, overwrite_staged, remove

QUEUE = "id long, catalog_id long, action string, reason string, attempts int, created_at timestamp, processed_at timestamp, error string"
INDEX = "chunk_id string, source string, stem string, page int, chunk_index int, n_tokens int, text string, catalog_id long, vector array<float>"
OUTCOMES = "id long, error string, at timestamp"
#: Rows of one batch asked for over the network, by default and at most.
LIMIT, MOST = 25, 200
#: Rows of one batch of drain_all(), which nobody waits for: a batch costs the same few jobs whether it's small or large.
BULK = 100_000


def _encoded(encoder: Encoder, batch: int, it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Texts with their vectors; if a batch fails its texts are tried one by one, and those that fail get an error instead."""
    for df in it:
        vectors: list = []
        errors: list = []
        texts = df["text"].tolist()
        for i in range(0, len(texts), batch):
            part = texts[i : i + batch]
            try:
                vectors += list(np.asarray(encoder(part), np.float32))
                errors += [None] * len(part)
            except Exception:  # noqa: BLE001 - one text must not fail the others
                for text in part:
                    try:
                        vectors.append(np.asarray(encoder([text]), np.float32)[0])
                        errors.append(None)
                    except Exception as e:  # noqa: BLE001
                        vectors.append(None)
                        errors.append(f"{type(e).__name__}: {e}"[:2000])
        yield df.drop(columns=["vector"], errors="ignore").assign(vector=vectors, failure=errors)


class Drain:
    """Applies waiting queue rows to the index, oldest first, so many a batch.

    queue_path holds queue rows, which producers append; index_path/base the index, and index_path/changes one folder a batch with
    the new rows of every catalogue id it touched, or a row without text for an id that's gone. index_path/outcomes holds what became of the queue
    rows. All three only grow: nothing is rewritten by a batch, a folder appears by one rename, and one that's there already (a replayed
    batch) is left alone. index() and queue() put the parts together, always of the newest state; compact() folds the changes in.

    A record whose text or vector can't be made keeps its old rows; its queue rows get another attempt and the error's text, and are
    claimed again until they've had five. Others of the batch aren't held up.

    view gives the catalogue, fulltext (optional) a table (catalog_id, fulltext) of some records, encoder (optional) vectors of texts.
    """

    def __init__(self, spark: SparkSession, view: Callable[[], DataFrame], queue_path: str, index_path: str, *, encoder: Encoder | None = None, fulltext: Callable[[DataFrame], DataFrame] | None = None, batch: int = 32, dry_run: bool = False):
        self.spark, self.view, self.queue_path, self.index_path = spark, view, queue_path, index_path
        self.encoder, self.fulltext, self.batch_size, self.dry_run = encoder, fulltext, batch, dry_run

    def _read(self, folder: str, schema: str) -> DataFrame:
        path = f"{self.index_path}/{folder}"
        return self.spark.read.schema(schema).parquet(path) if exists(self.spark, path) else self.spark.createDataFrame([], schema)

    def index(self) -> DataFrame:
        """The index with all batches applied: of each catalogue id the rows of the newest batch that touched it."""
        changes = self._read("changes", f"{INDEX}, version long")
        newest = changes.groupBy("catalog_id").agg(F.max("version").alias("version"))
        live = changes.join(newest, ["catalog_id", "version"], "left_semi").where("text is not null")
        base = self._read("base", INDEX)
        return base.join(newest.select("catalog_id"), "catalog_id", "left_anti").select(*base.columns).unionByName(live.select(*base.columns))

    def queue(self) -> DataFrame:
        """The queue as it stands: attempts, processed_at and error after all batches."""
        return acknowledged(self.spark.read.schema(QUEUE).parquet(self.queue_path), self._read("outcomes", f"{OUTCOMES}, version long"))

    def compact(self) -> None:
        """Fold the changes into the base; to be run while no batch is."""
        overwrite_staged(self.index(), f"{self.index_path}/base")
        remove(self.spark, f"{self.index_path}/changes")

    def plan(self, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(changes, outcomes) of some queue rows: nothing is written."""
        gated = gate(latest_actions(rows), self.view())
        texts = self.fulltext(gated.where("verdict = 'upsert'")) if self.fulltext else None
        chunks = catalog_chunks(gated.join(texts, "catalog_id", "left"), F.col("fulltext")) if texts is not None else catalog_chunks(gated)
        bare = ", ".join(f for f in INDEX.split(", ") if not f.startswith("vector"))
        chunks = chunks.select(*(f.split()[0] for f in bare.split(", ")))
        if self.encoder:
            chunks = chunks.mapInPandas(partial(_encoded, self.encoder, self.batch_size), f"{INDEX}, failure string")
        else:
            chunks = chunks.withColumn("vector", F.lit(None).cast("array<float>")).withColumn("failure", F.lit(None).cast("string"))
        chunks = materialize(chunks, "drain-chunks")
        bad = chunks.where("failure is not null").groupBy("catalog_id").agg(F.min("failure").alias("error"))
        good = chunks.join(bad, "catalog_id", "left_anti").drop("failure")
        gone = gated.select("catalog_id").distinct().join(bad, "catalog_id", "left_anti").join(good.select("catalog_id").distinct(), "catalog_id", "left_anti")
        changes = good.unionByName(gone, allowMissingColumns=True)
        none = F.when(F.col("catalog_id").isNull(), "no catalogue id")
        outcomes = rows.select("id", "catalog_id").join(bad, "catalog_id", "left").select("id", F.coalesce("error", none).alias("error"), F.current_timestamp().alias("at"))
        return changes, outcomes

    def drain(self, limit: int | None = None) -> dict:
        """Apply one batch of up to `limit` rows (1 to 200, 25 by default): {processed, failed, remaining, took_ms}."""
        return self._batch(clamp(limit, 1, MOST, LIMIT))

    def _batch(self, limit: int) -> dict:
        began = time.monotonic()
        rows = materialize(claim(self.queue(), limit), "drain-batch")
        size = rows.count()
        failed = 0
        if size and not self.dry_run:
            version = int(self._read("outcomes", f"{OUTCOMES}, version long").agg(F.max("version")).first()[0] or 0) + 1
            changes, outcomes = self.plan(rows)
            append_version(changes, f"{self.index_path}/changes", version)
            # The outcomes come last: a batch that's cut off before is claimed again and gives the same changes.
            append_version(outcomes, f"{self.index_path}/outcomes", version)
            failed = self._read("outcomes", f"{OUTCOMES}, version long").where((F.col("version") == version) & F.col("error").isNotNull()).count()
        remaining = self.queue().where(claimable()).count()
        return {"processed": size - failed, "failed": failed, "remaining": remaining, "took_ms": int((time.monotonic() - began) * 1000)}

    def drain_all(self, limit: int = BULK) -> dict:
        """Batches of up to `limit` rows until nothing waits; a row that keeps failing is tried five times.

        Rows of one id in one batch give what they give in batches that follow each other: its last action.
        """
        total = {"processed": 0, "failed": 0, "remaining": 0, "took_ms": 0}
        while True:
            done = self._batch(max(1, limit))
            total = {k: done[k] if k == "remaining" else total[k] + done[k] for k in total}
            if self.dry_run or not done["remaining"]:
                return total

    def start(self, checkpoint: str, every: str | None = None):
        """A streaming query that drains the queue whenever files arrive in it and then ends, or, with an interval such as '30 seconds', for ever.

        With an interval a clock drives it, so that rows that failed are tried again without new ones; a batch that fails as a whole (the catalogue
        can't be read, say) is left for the next tick.
        """

        def tick(_: DataFrame, __: int) -> None:
            try:
                self.drain_all()
            except Exception:
                if not every:
                    raise

        if every:
            clock = self.spark.readStream.format("rate").option("rowsPerSecond", 1).load()
            return clock.writeStream.foreachBatch(tick).option("checkpointLocation", checkpoint).trigger(processingTime=every).start()
        arrivals = self.spark.readStream.schema(QUEUE).parquet(self.queue_path)
        return arrivals.writeStream.foreachBatch(tick).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


class Breaker:
    """Opens after so many consecutive failures of a backend; a success closes it."""

    def __init__(self, most: int = 8):
        self.most, self.failures = most, 0

    def report(self, ok: bool) -> None:
        self.failures = 0 if ok else self.failures + 1

    @property
    def open(self) -> bool:
        return self.failures >= self.most


def windowed_counts(events: DataFrame, ts: str, key: str, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts by tumbling window and key of a stream or table; in a stream rows later than `late` behind the newest are left out."""
    timed = events.withColumn(ts, F.col(ts).cast("timestamp"))
    timed = timed.withWatermark(ts, late) if events.isStreaming else timed
    return timed.groupBy(F.window(ts, width).alias("w"), key).agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), key, "n")
