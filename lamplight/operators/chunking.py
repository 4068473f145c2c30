"""Splitting texts into pages and overlapping chunks."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import partial

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamplight.functions import text as T
from lamplight.session import broadcast_if_small, materialize

#: Fixed value: what separates the pages of paginated markdown.
MARKER = r"\{(\d+)\}-{20,}"
#: Separators of the recursive splitter, strongest first, of plain and of paginated texts.
SEPARATORS = ["\n\n", "\n", ". ", "; ", " ", ""]
HEADED_SEPARATORS = ["\n## ", "\n### ", "\n#### ", *SEPARATORS]
#: Headings that open an abstract, and those (or beginnings of them) that end it; an underscore stands for one blank.
OPENS = "ABSTRACT|SUMMARY"
CLOSES = "INTRODUCTION|TABLE_OF_CONTENTS|CONTENTS|ACKNOWLEDG|CHAPTER|LITERATURE_CITED|LITERATURE_REVIEW|REVIEW_OF_LITERATURE|MATERIALS_AND_METHODS|METHODOLOGY|REFERENCES|BIBLIOGRAPHY|LIST_OF_TABLES|LIST_OF_FIGURES"
_TOKENS = re.compile(r"\w+|[^\w\s]")


def pages_of_markdown(md: Column) -> Column:
    """array<struct<ord, page, text>>: what follows the marker {N} is page N + 1; text before the first marker is page 1.

    Without a marker the whole text is page 1. The prefix counts only if something but white space stands in it.
    """
    bodies = F.split(md, MARKER, -1)
    ids = F.transform(F.regexp_extract_all(md, F.lit(MARKER), F.lit(1)), lambda x: x.cast("int") + 1)
    numbered = F.transform(bodies, lambda b, i: F.struct(i.alias("ord"), F.when(i == 0, F.lit(1)).otherwise(F.get(ids, i - 1)).alias("page"), T.strip(b).alias("text")))
    return F.filter(numbered, lambda p: (p["ord"] > 0) | (p["text"] != "") | (F.size(bodies) == 1))


def explode_pages(df: DataFrame, key: str, pages: Column) -> DataFrame:
    return df.select(key, F.explode(pages).alias("p")).select(key, "p.ord", "p.page", "p.text")


def page_picks(pages: Column, most: int = 12) -> Column:
    """At most `most` evenly spread zero-based pages; all if there are no more than that."""
    n = pages.cast("long")
    spread = F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(most - 1)), lambda i: F.floor(i * n / most).cast("int")))
    return F.when(n <= 0, F.array().cast("array<int>")).when(n <= most, F.sequence(F.lit(0), (F.greatest(n, F.lit(1)) - 1).cast("int"))).otherwise(spread)


def _starts(n: Column, step: int) -> Column:
    return F.when(n > 0, F.sequence(F.lit(0), (n - 1).cast("int"), F.lit(step))).otherwise(F.array().cast("array<int>"))


def word_windows(c: Column, size: int = 1000, overlap: int = 150) -> Column:
    """Windows of `size` words, ceil(n / step) of them: the last may lie within the one before."""
    words = F.filter(F.split(c, f"{T.SPACE}+"), lambda w: w != "")
    return T.let(words, lambda ws: F.transform(_starts(F.size(ws), size - overlap), lambda s: F.array_join(F.slice(ws, s + 1, size), " ")))


def char_windows(c: Column, size: int = 1500, overlap: int = 200) -> Column:
    """Windows of `size` characters of the stripped text, as cut: none of an empty text, one of a text that fits, else ceil(n / step)."""

    def windows(t: Column) -> Column:
        many = F.transform(_starts(F.length(t), size - overlap), lambda s: F.substring(t, s + 1, F.lit(size)))
        return F.when(F.coalesce(F.length(t), F.lit(0)) == 0, F.array().cast("array<string>")).when(F.length(t) <= size, F.array(t)).otherwise(many)

    return T.let(T.strip(c), windows)


def token_length(text: str) -> int:
    """The default length measure: words and single marks."""
    return len(_TOKENS.findall(text))


def split_recursively(text: str, size: int = 512, overlap: int = 80, length=token_length, separators: list[str] | None = None) -> list[str]:
    """Chunks of at most `size`, cut at the strongest separator that helps, each beginning with up to `overlap` of the one before.

    A separator stays with what follows it. Every character but white space at the ends of chunks occurs in some chunk, in order; only a single
    character can be longer than `size`.
    """

    def pieces(part: str, level: list[str]) -> Iterator[str]:
        if length(part) <= size or len(part) <= 1:
            yield part
            return
        for at, sep in enumerate(level):
            if sep == "":
                half = len(part) // 2
                for side in (part[:half], part[half:]):
                    yield from pieces(side, [""])
                return
            if part.find(sep, 1) > 0:
                cuts = [m.start() for m in re.finditer(re.escape(sep), part) if m.start() > 0]
                for a, b in zip([0, *cuts], [*cuts, len(part)], strict=True):
                    yield from pieces(part[a:b], level[at:] if b - a < len(part) else level[at + 1 :])
                return
        yield part

    out: list[str] = []
    held: list[tuple[str, int]] = []
    total = 0
    for piece in pieces(text, separators or SEPARATORS):
        n = length(piece)
        if held and total + n > size:
            out.append("".join(p for p, _ in held))
            while held and (total > overlap or total + n > size):
                total -= held.pop(0)[1]
        held.append((piece, n))
        total += n
    if held:
        out.append("".join(p for p, _ in held))
    return [c.strip() for c in out if c.strip()]


def _chunk(size: int, overlap: int, key: str, length: Callable[[str], int], separators: list[str], it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for df in it:
        rows = [(k, p, i, length(c), c) for k, p, t in zip(df[key], df["page"], df["text"], strict=True) for i, c in enumerate(split_recursively(t or "", size, overlap, length, separators))]
        yield pd.DataFrame(rows, columns=[key, "page", "chunk_index", "n_tokens", "text"])


def chunk_pages(pages: DataFrame, key: str, size: int = 512, overlap: int = 80, drop_garbled: bool = True, length: Callable[[str], int] = token_length, headed: bool = True) -> DataFrame:
    """Chunks of pages(key, page, text), numbered by page before empty and unreadable ones are dropped, so numbers may have gaps.

    length measures a text, token_length() unless another tokenizer is given. headed says that the texts are markdown, whose headings
    are the strongest places to cut. Null texts have no chunks. Two parts of a document on one page number give equal numbers.
    """
    kind = dict(pages.dtypes)[key]
    cut = partial(_chunk, size, overlap, key, length, HEADED_SEPARATORS if headed else SEPARATORS)
    chunks = pages.select(key, F.col("page").cast("int").alias("page"), "text").mapInPandas(cut, f"`{key}` {kind}, page int, chunk_index int, n_tokens int, text string")
    return chunks.where(T.garble(F.col("text"))["keep"]) if drop_garbled else chunks


def reading_order() -> Column:
    """The place of a chunk in its document: by page, then chunk_index, nulls last, then a hash of its text."""
    return F.struct(F.col("page").isNull(), "page", F.col("chunk_index").isNull(), "chunk_index", F.md5("text"))


def abstract_of(chunks: DataFrame, key: str = "stem") -> DataFrame:
    """(key, abstract): the text after the first heading "abstract" or "summary" among a document's chunks, in reading order.

    The heading stands alone on its line within the first 600 characters of its chunk, with or without markdown decoration. The abstract runs
    on into the next chunk and ends at the next section heading; more than 120 characters are kept, 4,000 at most. The first heading
    decides: a short abstract gives null. Chunks whose text is null are no chunks, and rows loaded twice count once.

    No document is gathered in one task: places are reduced to the first heading's and the next one by aggregates, and only the texts at
    these places are moved.
    """
    blank = T.SPACE[1:-1]
    head = rf"(?is)^(.*?(?:^|\n)[{blank}#*_>]*(?:{OPENS})[{blank}*_:.\-]*(?:\n|\z))"
    close = rf"(?i)\n[{blank}#*_>]*(?:{CLOSES.replace('_', ' ')})\b"
    rows = chunks.where(F.col(key).isNotNull() & F.col("text").isNotNull()).select(key, "text", reading_order().alias("place"))
    places = rows.select(key, "place", F.regexp_instr(F.substring("text", 1, 600), F.lit(head)).alias("hit"))
    first = places.where("hit > 0").groupBy(key).agg(F.min("place").alias("first"))
    second = places.drop("hit").join(first, key).where("place > first").groupBy(key).agg(F.min("place").alias("second"))
    wanted = materialize(first.join(second, key, "left").select(key, F.explode(F.array("first", "second")).alias("place")).where("place is not null"), "abstracts")
    found = rows.join(broadcast_if_small(wanted), [key, "place"], "left_semi").groupBy(key, "place").agg(F.first("text").alias("text"))
    texts = found.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("place", "text"))).alias("t"))
    own = F.get("t", F.lit(0))["text"]
    rest = F.substring(own, F.length(F.regexp_extract(F.substring(own, 1, 600), head, 1)) + 1, F.length(own))
    body = F.element_at(F.split(F.concat_ws("\n", rest, F.get("t", F.lit(1))["text"]), close, 2), 1)
    return texts.select(key, T.collapse(body).alias("body")).select(key, F.when(F.length("body") > 120, F.substring("body", 1, 4000)).alias("abstract"))
