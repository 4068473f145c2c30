"""Triage of scanned files, the work manifest, and exact duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamplight.functions import text as T
from lamplight.operators.chunking import page_picks
from lamplight.session import materialize

# --- triage -----------------------------------------------------------------


#: A page has text from so many characters; TEXT_READY from one share of pages, NEEDS_OCR up to the other.
LEAST_CHARS, READY, SCANNED = 50, 0.80, 0.05


def bucket(fraction: Column, error: Column | None = None) -> Column:
    """TEXT_READY, NEEDS_OCR or SUSPECT_TEXT_LAYER of a rounded fraction; an error's name comes first."""
    rule = F.when(fraction >= READY, "TEXT_READY").when(fraction <= SCANNED, "NEEDS_OCR").otherwise("SUSPECT_TEXT_LAYER")
    return rule if error is None else F.coalesce(error, rule)


def triage(docs: DataFrame, key: str, pages: Column, least_chars: int = LEAST_CHARS, most_pages: int = 12, failure: Column | None = None) -> DataFrame:
    """(key, pages_total, pages_inspected, pages_with_text, text_fraction, avg_chars_on_text_pages, bucket) from an array of page texts.

    failure names what went wrong, 'open' or 'read' (ERROR_OPEN, ERROR_READ); without it a null array is one that can't be read. An empty
    array is ERROR_EMPTY. Fractions are rounded half to even before they're judged.
    """
    count = F.coalesce(F.size(pages), F.lit(0))
    lengths = T.let(pages, lambda p: F.transform(page_picks(F.coalesce(F.size(p), F.lit(0)), most_pages), lambda i: F.coalesce(F.length(T.strip(F.get(p, i))), F.lit(0))))
    went = F.lower(failure) if failure is not None else F.lit(None).cast("string")
    error = F.when(went == "open", "ERROR_OPEN").when((went == "read") | pages.isNull(), "ERROR_READ").when(count <= 0, "ERROR_EMPTY")
    one = docs.select(key, count.alias("n"), F.coalesce(lengths, F.array().cast("array<int>")).alias("lengths"), error.alias("error"))
    one = one.withColumn("full", F.filter("lengths", lambda x: x >= least_chars))
    inspected, full = F.size("lengths"), F.size("full")
    fraction = F.bround(full / F.greatest(inspected, F.lit(1)), 3)
    chars = F.aggregate("full", F.lit(0).cast("long"), lambda a, x: a + x)
    return one.select(
        key, F.greatest("n", F.lit(0)).alias("pages_total"), inspected.alias("pages_inspected"), full.alias("pages_with_text"), fraction.alias("text_fraction"), F.bround(chars / F.greatest(full, F.lit(1)), 1).alias("avg_chars_on_text_pages"), bucket(fraction, F.col("error")).alias("bucket")
    )


def shares(df: DataFrame, by: str) -> DataFrame:
    """(by, n, percent of all), percent to one decimal. The window runs over one row a group value."""
    counts = df.groupBy(by).agg(F.count("*").alias("n"))
    return counts.select(by, "n", F.bround(100 * F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(0))), 1).alias("percent"))


def systematic_sample(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """The rows at places int(i * rows / n) of the given order, all rows if there are no more than n.

    Places come from row counts by range partition, so the sort is distributed and nothing but one count a partition is collected.
    """
    ordered = materialize(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "sample")
    counts = {r._part: r["count"] for r in ordered.groupBy("_part").count().collect()}
    total, before, at = sum(counts.values()), {}, 0
    for part in sorted(counts):
        before[part] = at
        at += counts[part]
    places = list(range(total)) if total <= n else sorted({i * total // n for i in range(n)})
    within = ordered.withColumn("_n", F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1)
    if total <= n:
        return df
    # Each wanted place as (partition, place within it): at most n rows.
    wanted = [(max(p for p in before if before[p] <= x), x) for x in places]
    chosen = df.sparkSession.createDataFrame([(p, x - before[p]) for p, x in wanted], "_part int, _n int")
    return within.join(F.broadcast(chosen), ["_part", "_n"], "left_semi").select(*df.columns)


def numbered_rows(df: DataFrame, order: list[str], start: int = 1) -> DataFrame:
    """df with n, the rows' numbers in the given order from `start`: sorted by range, numbered within each partition, and shifted by the counts of those before.

    One count a partition reaches the driver, and no row passes through a single task.
    """
    ordered = materialize(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "numbered")
    at, shift = start, {}
    for r in sorted(ordered.groupBy("_part").count().collect(), key=lambda r: r._part):
        shift[r._part] = at
        at += r["count"]
    within = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    base = F.element_at(F.create_map(*(F.lit(x) for pair in shift.items() for x in pair)), F.col("_part")) if shift else F.lit(start)
    return ordered.withColumn("n", (within + base).cast("long")).drop("_part")


# --- manifest ---------------------------------------------------------------


def tier(pages: Column) -> Column:
    """small 1 to 10, medium 11 to 50, large from 51; null for files without pages."""
    return F.when(pages.between(1, 10), "small").when(pages.between(11, 50), "medium").when(pages >= 51, "large")


def work_order(manifest: DataFrame, ties: list[str], limit: int | None = None) -> DataFrame:
    """(tier, *ties, pages, place): the pending files of each size class, smallest first; limit cuts each class, None doesn't.

    Files without pages are in no class and are never worked on.
    """
    todo = manifest.where("status = 'pending'").select(tier(F.col("pages")).alias("tier"), *ties, "pages").where("tier is not null")
    placed = todo.withColumn("place", F.row_number().over(Window.partitionBy("tier").orderBy("pages", *ties)))
    return placed if limit is None else placed.where(F.col("place") <= limit)


def progress(done: int, total: int, elapsed: float) -> dict:
    """{percent, rate, eta} of a run: items a second, and the time left as text, "--" while there's no rate."""
    rate = done / elapsed if elapsed > 0 else 0.0
    left = "--"
    if done > 0 and rate > 0:
        minutes, seconds = divmod(int((total - done) / rate), 60)
        hours, minutes = divmod(minutes, 60)
        left = f"{hours}h{minutes:02d}m" if hours else f"{minutes}m{seconds:02d}s"
    return {"percent": 100.0 * done / max(total, 1), "rate": rate, "eta": left}


def latest(df: DataFrame, keys: list[str], newest_first: list[Column]) -> DataFrame:
    """One row a key, the newest; a total order in newest_first makes it deterministic."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest_first))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")


def insert_or_ignore(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """The rows of new whose key isn't in old, one a key, to be appended."""
    return new.join(old.select(key), key, "left_anti").dropDuplicates([key])


def skip_pending(manifest: DataFrame, skipped: DataFrame, key: str = "path") -> DataFrame:
    """The manifest with status 'skip' where it's pending and its key is in skipped."""
    flags = skipped.select(key).distinct().withColumn("_skip", F.lit(True))
    status = F.when((F.col("status") == "pending") & F.col("_skip"), "skip").otherwise(F.col("status"))
    return manifest.join(flags, key, "left").withColumn("status", status).select(*manifest.columns)


def finish(manifest: DataFrame, results: DataFrame) -> DataFrame:
    """The manifest after results(path, out, chars, seconds, error, updated): done or error, error texts cut to 2,000 characters."""
    cols = ["out", "chars", "seconds", "error", "updated"]
    r = results.select("path", *(F.col(c).alias(f"_{c}") for c in cols), F.lit(True).alias("_hit"))
    joined = manifest.join(r, "path", "left")
    new = {c: F.when(F.col("_hit"), F.substring("_error", 1, 2000) if c == "error" else F.col(f"_{c}")).otherwise(F.col(c)) for c in cols}
    status = F.when(F.col("_hit") & F.col("_error").isNull(), "done").when(F.col("_hit"), "error").otherwise(F.col("status"))
    return joined.withColumns(new | {"status": status}).select(*manifest.columns)


def status_totals(manifest: DataFrame) -> DataFrame:
    """(status, n, pages): by status and, with status null, in all; null pages count as none. A null status is named 'none'."""
    return manifest.withColumn("status", F.coalesce("status", F.lit("none"))).rollup("status").agg(F.count("*").alias("n"), F.coalesce(F.sum("pages"), F.lit(0)).alias("pages"))


# --- exact duplicates -------------------------------------------------------


def duplicate_members(df: DataFrame, key: str, size: Column, content: Column) -> DataFrame:
    """(key, size, digest): the rows whose content occurs more than once; empty content, or content of unknown size, has no duplicates.

    Contents are hashed where they're read, and only keys, sizes and digests are kept, once; how often a digest occurs is counted with a
    partial count on each side of the shuffle, so a hot digest is no hot task.
    """
    hashed = materialize(df.select(key, size.alias("size"), F.md5(content).alias("digest")).where("size > 0 and digest is not null"), "digests")
    repeated = hashed.groupBy("size", "digest").agg(F.count("*").alias("n")).where("n > 1").select("size", "digest")
    return hashed.join(repeated, ["size", "digest"], "left_semi").select(key, "size", "digest")


def keepers(members: DataFrame, best: list[Column]) -> DataFrame:
    """One row a set of duplicates: the one of least values `best`, nulls first; found by a partial minimum, so a hot set is no hot task."""
    rows = members.groupBy("size", "digest").agg(F.min_by(F.struct(*members.columns), F.struct(*best)).alias("r"))
    return rows.select("r.*")


def redundant_pages(members: DataFrame, order: list[Column], pages: str = "pages") -> DataFrame:
    """One row (redundant_pages): of each set of duplicates the pages of its member of least values `order`, times its further members."""
    sets = members.groupBy("size", "digest").agg(F.count("*").alias("n"), F.min_by(F.coalesce(F.col(pages), F.lit(0)), F.struct(*order)).alias("pages"))
    return sets.agg(F.coalesce(F.sum(F.col("pages") * (F.col("n") - 1)), F.lit(0)).alias("redundant_pages"))
