"""Readers: files, tables and tolerant JSON lines, all with explicit schemas."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamplight.functions import text as T
from lamplight.models import PageParser

TRIAGE = "path string, name string, pages_total string, pages_inspected string, pages_with_text string, text_fraction string, avg_chars_on_text_pages string, bucket string, error string"
EXTRACTED = "source string, stem string, pages_total int, pages array<struct<page: int, text: string>>"
CHUNKS = "chunk_id string, source string, stem string, page int, chunk_index int, n_tokens int, text string"


def list_files(spark: SparkSession, root: str, suffixes: tuple[str, ...] = (".pdf",)) -> DataFrame:
    """(path, length) of files below root with one of the suffixes, whatever their case, sorted by path. Contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length")
    return files.where(T.suffix(F.col("path")).isin(*suffixes)).orderBy("path")


def read_binary(spark: SparkSession, root: str, suffixes: tuple[str, ...] = (".pdf",)) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).where(T.suffix(F.col("path")).isin(*suffixes)).select("path", "length", "content")


def read_texts(spark: SparkSession, root: str, suffixes: tuple[str, ...] = (".md", ".txt")) -> DataFrame:
    """(path, stem, text) of whole text files; bytes that are no UTF-8 are dropped."""
    raw = read_binary(spark, root, suffixes)
    text = F.regexp_replace(F.make_valid_utf8(F.col("content").cast("string")), "\ufffd", "")
    return raw.select("path", T.stem(F.col("path")).alias("stem"), text.alias("text"))


def _parse(parser: PageParser, it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for df in it:
        rows = []
        for path, content in zip(df["path"], df["content"], strict=True):
            try:
                rows += [(path, n, (t or "").strip(), None) for n, t in enumerate(parser(bytes(content)), 1)]
            except Exception as e:  # noqa: BLE001 - one bad file must not end the job
                rows.append((path, None, None, f"{type(e).__name__}: {e}"[:2000]))
        yield pd.DataFrame(rows, columns=["path", "page", "text", "error"]).astype({"page": "Int64"})


def read_pages(files: DataFrame, parser: PageParser) -> DataFrame:
    """(path, page, text, error) of files(path, content) by an injected parser; a file that fails gives one row with its error."""
    return files.select("path", "content").mapInPandas(partial(_parse, parser), "path string, page long, text string, error string")


def read_documents(files: DataFrame, parser: PageParser) -> DataFrame:
    """(path, text): each file's page texts joined by line breaks and stripped; an empty text for a file that fails or has none."""
    return files.select("path", "content").mapInPandas(partial(_whole, parser), "path string, text string")


def _whole(parser: PageParser, it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for df in it:
        texts = []
        for content in df["content"]:
            try:
                texts.append("\n".join(t or "" for t in parser(bytes(content))).strip())
            except Exception:  # noqa: BLE001 - one bad file must not end the job
                texts.append("")
        yield pd.DataFrame({"path": df["path"], "text": pd.Series(texts, dtype=object)})


def read_triage(spark: SparkSession, path: str, buckets: tuple[str, ...] | None = None) -> DataFrame:
    """A triage CSV; numbers come as text and are parsed, what doesn't parse counts as 0."""
    df = spark.read.schema(TRIAGE).option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    df = df.where(F.col("bucket").isin(*buckets)) if buckets else df
    whole = {c: F.coalesce(F.col(c).try_cast("int"), F.lit(0)) for c in ("pages_total", "pages_inspected", "pages_with_text")}
    return df.withColumns(whole | {c: F.coalesce(F.col(c).try_cast("double"), F.lit(0.0)) for c in ("text_fraction", "avg_chars_on_text_pages")})


def read_extracted(spark: SparkSession, path: str) -> DataFrame:
    """(source, stem, page, text), one row a page, of one JSON file a document."""
    docs = spark.read.schema(EXTRACTED).option("multiLine", True).json(path)
    return docs.select("source", "stem", F.explode("pages").alias("p")).select("source", "stem", "p.page", "p.text")


def read_json_lines(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(good rows, broken lines): torn lines are set apart instead of ending the job."""
    column = "_broken"
    lines = spark.read.text(path).where(F.trim("value") != "")
    parsed = lines.select("value", F.from_json("value", f"{schema}, {column} string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": column}).alias("r"))
    good = parsed.where(f"r.{column} is null and r is not null").select("r.*").drop(column)
    return good, parsed.where(f"r.{column} is not null or r is null").select("value")


def read_manifest_array(spark: SparkSession, path: str, schema: str = "source string, out string") -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path).where("source is not null and source <> ''")


def read_skip_list(spark: SparkSession, path: str, name: str = "stem") -> DataFrame:
    return spark.read.text(path).select(F.trim("value").alias(name)).where(F.col(name) != "").distinct()


def read_jdbc(spark: SparkSession, url: str, table: str, key: str | None = None, low: int = 0, high: int = 0, parts: int = 16, **options: str) -> DataFrame:
    """A database table; with a numeric key it's read in `parts` ranges at once."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if key:
        reader = reader.option("partitionColumn", key).option("lowerBound", low).option("upperBound", high).option("numPartitions", parts)
    return reader.load()


def parse_env(text: str) -> dict[str, str]:
    """key=value lines; blank ones and comments are skipped, quotes around values dropped."""
    pairs = (line.split("=", 1) for line in text.splitlines() if "=" in line and not line.lstrip().startswith("#"))
    return {k.strip(): v.strip().strip("'\"") for k, v in pairs}
