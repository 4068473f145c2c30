import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lamplight.operators import chunking as C


def pages(spark, md):
    df = spark.createDataFrame([("k", md)], "key string, md string")
    return [(r.ord, r.page, r.text) for r in C.explode_pages(df, "key", C.pages_of_markdown(F.col("md"))).collect()]


def test_page_markers(spark):
    dashes = "-" * 48
    assert pages(spark, "no marker") == [(0, 1, "no marker")]
    assert pages(spark, f"pre {{0}}{dashes} a {{1}}{dashes}b") == [(0, 1, "pre"), (1, 1, "a"), (2, 2, "b")]
    assert pages(spark, f"{{4}}{dashes}a") == [(1, 5, "a")]
    assert pages(spark, "{0}" + "-" * 19 + " a") == [(0, 1, "{0}" + "-" * 19 + " a")]
    assert pages(spark, f"{{0}}{dashes}{{1}}{dashes}") == [(1, 1, ""), (2, 2, "")]
    assert pages(spark, None) == []


@pytest.mark.parametrize("n", [0, 1, 11, 12, 13, 50, 1106])
def test_page_picks(spark, n):
    got = spark.createDataFrame([(n,)], "n int").select(C.page_picks(F.col("n")).alias("p")).first().p
    assert got == (list(range(n)) if n <= 12 else sorted({int(i * n / 12) for i in range(12)}))


@pytest.mark.parametrize("n", [0, 1, 849, 850, 851, 1000, 1700, 2500])
def test_word_windows_closed_form(spark, n):
    text = " ".join(f"w{i}" for i in range(n))
    got = spark.createDataFrame([(text,)], "t string").select(C.word_windows(F.col("t")).alias("w")).first().w
    assert len(got) == math.ceil(n / 850)
    assert [w.split()[0] for w in got] == [f"w{i}" for i in range(0, n, 850)]
    assert all(len(w.split()) == min(1000, n - 850 * i) for i, w in enumerate(got))


@pytest.mark.parametrize(("n", "want"), [(0, 0), (1, 1), (1500, 1), (1501, 2), (2600, 2), (2601, 3)])
def test_char_windows_closed_form(spark, n, want):
    got = spark.createDataFrame([("x" * n,)], "t string").select(C.char_windows(F.col("t")).alias("w")).first().w
    assert len(got) == want


def test_windows_of_null(spark):
    df = spark.createDataFrame([(None,)], "t string")
    assert df.select(C.char_windows(F.col("t")).alias("w")).first().w == []
    assert not df.select(C.word_windows(F.col("t")).alias("w")).first().w


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab .\n#", max_size=400), st.integers(2, 30), st.integers(0, 10))
def test_recursive_splitter(text, size, overlap):
    solid = "".join(text.split())
    plain = C.split_recursively(text, size, 0, length=len)
    assert "".join("".join(plain).split()) == solid
    chunks = C.split_recursively(text, size, min(overlap, size - 1), length=len)
    assert all(len(c) <= size for c in [*plain, *chunks])
    assert len("".join("".join(chunks).split())) >= len(solid)
    assert all("".join(c.split()) in solid for c in chunks)


def test_chunk_numbers_have_gaps(spark):
    junk = " ".join(["bcdf"] * 40)
    text = "rice " * 20 + "\n\n" + junk + "\n\n" + "soil " * 20
    rows = C.chunk_pages(spark.createDataFrame([("s", 1, text), ("s", 2, None)], "stem string, page int, text string"), "stem", size=45, overlap=0).collect()
    assert sorted(r.chunk_index for r in rows) == [0, 2]


def abstracts(spark, rows):
    return {r.stem: r.abstract for r in C.abstract_of(spark.createDataFrame(rows, "stem string, page int, chunk_index int, text string")).collect()}


BODY = "Rice was grown on nine plots. " * 8


def test_abstract(spark):
    rows = [("a", 1, 0, "Title\n## **ABSTRACT**\n" + BODY), ("a", 1, 1, "more of it\n# Introduction\nno more"), ("b", 1, 0, "Summary\nshort"), ("b", 1, 1, "Introduction\nx"), ("c", 1, 0, "the abstract says"), ("d", 1, 0, "x" * 601 + "\nAbstract\n" + BODY)]
    got = abstracts(spark, rows)
    assert set(got) == {"a", "b"}
    assert got["b"] is None
    assert got["a"].endswith("more of it")


def test_abstract_headings(spark):
    ends = ["Literature Cited", "LITERATURE REVIEW", "References", "BIBLIOGRAPHY", "List of Tables", "list of figures", "Acknowledg.", "CHAPTER 2", "Methodology"]
    rows = [(f"e{i}", 1, 0, f"Abstract:\n{BODY}\n**{h}**\nrest") for i, h in enumerate(ends)]
    rows += [("k", 1, 0, f"Executive Summary\n{BODY}"), ("r", 1, 0, f"SUMMARY\n{BODY}\nResults\nKeywords: x"), ("n", 1, 0, f"SUMMARY\n{BODY}"), ("n", 1, 1, None), ("n", None, 0, "last"), ("n", 1, 0, f"SUMMARY\n{BODY}")]
    got = abstracts(spark, rows)
    assert {k for k in got if k[0] == "e" and got[k] == BODY.strip()} == {f"e{i}" for i in range(len(ends))}
    assert "k" not in got
    assert got["r"].endswith("Results Keywords: x")
    assert got["n"].endswith("plots. last")  # a row loaded twice counts once, nulls come last
    assert abstracts(spark, [("a", 1, 0, f"Abstract\n{'x' * 121}"), ("b", 1, 0, f"Abstract\n{'x' * 120}"), (None, 1, 0, f"Abstract\n{BODY}")]) == {"a": "x" * 121, "b": None}


def test_char_windows_are_as_cut(spark):
    text = "a" * 1499 + "  " + "b" * 1200
    got = spark.createDataFrame([(f" {text}\u3000",)], "t string").select(C.char_windows(F.col("t")).alias("w")).first().w
    assert got == [text[i : i + 1500] for i in range(0, len(text), 1300)] and got[0].endswith(" ")


def test_separators_of_plain_and_headed_texts():
    assert C.split_recursively("one two; three four", 10, 0, length=len) == ["one two;", "three", "four"]
    text = "aaaa bbbb\n## cccc dddd"
    assert C.split_recursively(text, 13, 0, length=len, separators=C.HEADED_SEPARATORS) == ["aaaa bbbb", "## cccc dddd"]


def test_length_is_injected(spark):
    rows = spark.createDataFrame([("s", 1, "rice soil duck yam")], "stem string, page int, text string")
    assert [r.n_tokens for r in C.chunk_pages(rows, "stem", length=len).collect()] == [18]
    assert [r.text for r in C.chunk_pages(rows, "stem", size=9, overlap=0, length=len, headed=False).collect()] == ["rice soil", "duck yam"]
