"""Per-document text quality: statistics, their distributions by language as mergeable sketches, and what lies in the tails."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamplight.llm.text_stats import CLASSES, FIELDS, LANGS, sequence_counts, sequence_model, statistics
from lamplight.llm.words import batches
from lamplight.session import materialize

MEASURES = [f for f in FIELDS if f not in ("lang", "chars")]
#: Least spreads, so that a corpus of one kind doesn't make small differences look odd; 0.005 for other measures.
LEAST_SPREAD = {"sequence_score": 0.06, "common_ratio": 0.03}
STATS = ", ".join(f"{f} double" for f in FIELDS if f != "lang") + ", lang string"


def _counts(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(CLASSES * CLASSES, np.int64)
    for batch in it:
        texts = batch.column(0).to_pylist()
        for i, j in batches(texts):
            total += sequence_counts(texts[i:j])
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["pair", "n"])


def learn_sequences(df: DataFrame, text_col: str) -> np.ndarray:
    """The sequence model of all texts; at most CLASSES squared counts come to the driver."""
    rows = df.select(F.col(text_col)).where(F.col(text_col).isNotNull()).mapInArrow(_counts, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(CLASSES * CLASSES)
    for r in rows:
        counts[r.pair] = r.n
    return sequence_model(counts)


def stats_columns(texts: list[str | None], model: np.ndarray) -> list[pa.Array]:
    s = statistics(texts, model)
    return [*(pa.array(s[f].astype(np.float64)) for f in FIELDS if f != "lang"), pa.array([LANGS[x] for x in s["lang"]])]


def _stats(model: np.ndarray, it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in it:
        texts = batch.column(1).to_pylist()
        for i, j in batches(texts):
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), *stats_columns(texts[i:j], model)], ["id", *(f for f in FIELDS if f != "lang"), "lang"])


def text_statistics(df: DataFrame, id_col: str, text_col: str, model: np.ndarray | None = None) -> DataFrame:
    """One row of statistics a row of df. A null, empty or blank text has zeros."""
    model = learn_sequences(df, text_col) if model is None else model
    kind = dict(df.dtypes)[id_col]
    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(partial(_stats, model), f"id {kind}, {STATS}")


#: Stands for all languages together; its profile measures texts whose likeliest language has none.
ANY = "any"


def _sketches(k: int) -> list[Column]:
    return [F.count("*").alias("documents"), *(F.kll_sketch_agg_double(m, k).alias(m) for m in MEASURES)]


def with_certainty(stats: DataFrame, k: int = 400) -> DataFrame:
    """stats with certain: whether the share of the likeliest language's common words is half of the corpus' median share or more.

    Unreadable text has a few words of some language by chance; it must not make a language's profile by itself.
    """
    median = stats.where("words > 0").agg(F.kll_sketch_agg_double("common_ratio", k).alias("s"), F.count("*").alias("n")).where("n > 0").select(F.kll_sketch_get_quantile_double("s", F.lit(0.5)).alias("usual_share"))
    rows = stats.join(F.broadcast(median), how="left")  # one row
    return rows.withColumn("certain", F.coalesce(F.col("common_ratio") >= F.col("usual_share") / 2, F.lit(False))).drop("usual_share")


def profile(stats: DataFrame, k: int = 400) -> DataFrame:
    """By language, and for all together as ANY: count, and median and robust spread of each statistic, from KLL sketches merged over all documents.

    Only certain texts with words count, and a language has a row only if most of the texts it's likeliest for are certain. The spread is the mean
    of the distances of the 15.9 % and 84.1 % quantiles from the median, or a least spread.
    """
    stats = with_certainty(stats, k).where("words > 0")
    stands = stats.groupBy("lang").agg(F.count_if("certain").alias("c"), F.count("*").alias("n")).where("2 * c >= n").select("lang")
    each = stats.where("certain").groupBy("lang").agg(*_sketches(k)).join(F.broadcast(stands), "lang", "left_semi")
    whole = stats.where("certain").agg(*_sketches(k)).where("documents > 0").select(F.lit(ANY).alias("lang"), "documents", *MEASURES)
    q = lambda m, p: F.kll_sketch_get_quantile_double(m, F.lit(p))
    return each.unionByName(whole).select("lang", "documents", *(q(m, 0.5).alias(f"{m}_median") for m in MEASURES), *(F.greatest((q(m, 0.841) - q(m, 0.159)) / 2, F.lit(LEAST_SPREAD.get(m, 0.005))).alias(f"{m}_spread") for m in MEASURES))


def scored(stats: DataFrame, k: int = 400) -> DataFrame:
    """The statistics with a robust z-score z_<name> of each, and relative_common, the share of common words as a part of its median, against the profile of the text's likeliest language, or of all if that has none."""
    p = profile(stats, k).drop("documents")
    found = {r.lang: r for r in p.collect()}  # a row a language
    rows = [(lang, *(found.get(lang) or found.get(ANY) or [None] * len(p.columns))[1:]) for lang in LANGS]
    p = stats.sparkSession.createDataFrame(rows, "lang string, " + ", ".join(f"{c} double" for c in p.columns[1:]))
    z = [((F.col(m) - F.col(f"{m}_median")) / F.col(f"{m}_spread")).alias(f"z_{m}") for m in MEASURES]
    return stats.join(F.broadcast(p), "lang", "left").select(*stats.columns, *z, (F.col("common_ratio") / F.col("common_ratio_median")).alias("relative_common"))


def kind_of(tail: float = 3.5) -> Column:
    """'prose', 'list', 'table' or 'junk' of a row of scored(); null where there are no solid characters.

    What most of a text is (lines to fill in, cells, short entries) tells the kinds apart, so their shares are compared with fixed ones; how far a text
    must be from the corpus' prose is a matter of the tails of its language's distributions. Text is junk if it's mostly lines to fill in, or if few of its
    words are common and its character sequences lie in the lower tail or its symbols in the upper one, or its characters beyond ASCII lie far up there; a table if
    most of it stands in rows of cells and few words are common; a list if most of it stands in short entries and its share of common words is low, if
    not in the tail, the more so the fewer of its lines end a sentence.
    """
    z, share, common = (lambda m: F.col(f"z_{m}")), F.col, F.col("relative_common")
    # Where shares of common words vary much, their tail begins below what any prose has: then a small part of the median counts.
    few_common, low_common, hardly_any = (z("common_ratio") < -tail) | (common < 0.3), z("common_ratio") < -tail / 2, (z("common_ratio") < -1.4 * tail) | (common < 0.3)
    odd = (z("sequence_score") < -2 * tail) & few_common
    strange = (z("foreign_ratio") > 20 * tail) | (low_common & (z("symbol_ratio") > 20 * tail))
    junk = strange | (low_common & (z("sequence_score") < -5 * tail) & (share("cell_ratio") < 0.5)) | (odd & (share("cell_ratio") < 0.5) & (share("entry_ratio") < 0.5))
    return (
        F.when(F.col("chars") == 0, F.lit(None))
        .when((share("form_ratio") >= 0.5) | junk, "junk")
        .when((share("cell_ratio") >= 0.5) & few_common, "table")
        .when((share("entry_ratio") >= 0.6) & (z("common_ratio") < -0.8 * tail), "list")
        .when((share("entry_ratio") >= 0.85) & (common < 0.4), "list")
        .when((share("entry_ratio") >= 0.6) & ((z("common_ratio") < -0.65 * tail) | (common < 0.5)) & (share("line_end_ratio") < 0.15), "list")
        .when(hardly_any & (share("cell_ratio") >= share("entry_ratio")) & (share("cell_ratio") >= 0.35), "table")
        .when(hardly_any & (share("entry_ratio") >= 0.35), "list")
        .when(odd, "junk")
        .otherwise("prose")
    )


def text_kinds(df: DataFrame, id_col: str, text_col: str, tail: float = 3.5, name: str = "quality") -> DataFrame:
    """(id, kind, statistics and z-scores) for each row of df with a non-blank text; null and blank texts, and empty tables, give none."""
    stats = materialize(text_statistics(df, id_col, text_col), name)
    return scored(stats).withColumn("kind", kind_of(tail)).where("chars > 0")
