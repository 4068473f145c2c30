import pytest
from pyspark.sql import functions as F

from lamplight.operators import catalog as C


def test_front_matter_reads_in_order(spark):
    rows = [("s", "c3", 2, 0, "third"), ("s", "c1", 1, 0, "first"), ("s", "c2", 1, 1, "second"), ("s", "c4", 3, 0, "fourth"), ("s", "c0", None, 0, None)]
    df = spark.createDataFrame(rows, "stem string, chunk_id string, page int, chunk_index int, text string")
    assert C.front_matter(df).first().front == "first\nsecond\nthird"
    assert C.front_matter(df, most=7).first().front == "first\ns"
    assert C.front_matter(df.where("false")).count() == 0


def test_records_from_raw(spark):
    raw = [('```json\n{"title": "None", "year": "1999-2000", "type": "Vertical Files", "statement_of_responsibility": "by A. B", "restricted": "True", "is_research": false}\n```',), ('text {"title": "\\"Rice\\"", "type": "Odd"} text',), ("broken {", ), (None,)]
    df = spark.createDataFrame(raw, "raw string").select(C.parse_record(F.col("raw")).alias("r"))
    got = df.select(*(c.alias(n) for n, c in C.normalised(F.col("r")).items())).collect()
    assert (got[0].title, got[0].year, got[0].type, got[0].restricted, got[0].is_research, got[0].responsibility) == (None, "1999", "Vertical Files", True, False, "by A. B")
    assert (got[1].title, got[1].type, got[1].restricted) == ("Rice", "Books", None)
    assert got[2].title is None and got[3].title is None


def test_flags(spark):
    rows = [("Rice", "s", None, None, None), (None, "s", "strictly confidential", None, False), ("abc", "s", "x" * 2001 + " confidential", False, True), ("Rice", "s", "", True, True)]
    df = spark.createDataFrame(rows, "title string, stem string, opening string, restricted boolean, research boolean")
    made = C.flags(F.col("title"), F.col("stem"), F.col("opening"), F.col("restricted"), F.col("research"))
    got = df.select(made.alias("flags"), C.reason(made).alias("why"), F.lit("Books").alias("type"))
    assert [(r.flags, r.why) for r in got.collect()] == [([], None), (["no-title", "restricted", "junk"], "No title could be read from the document"), (["no-title"], "No title could be read from the document"), (["restricted"], "Marked restricted / not for open circulation")]
    assert {r.flag: r.n for r in C.flag_counts(got).collect()} == {"no-title": 2, "restricted": 2, "junk": 1, "(published)": 1}
    assert C.published_types(got).first().n == 1


def test_resume_retries_errors(spark):
    stems = spark.createDataFrame([("a",), ("b",), ("c",)], "stem string")
    done = spark.createDataFrame([("a", ["error"]), ("b", []), ("a", ["error"])], "stem string, flags array<string>")
    assert sorted(r.stem for r in C.todo(stems, done).collect()) == ["a", "c"]


def test_last_pages(spark):
    rows = [("a", 1, None), ("a", None, None), ("a", 7, None), ("catalog-1", 0, 1), ("b", None, None)]
    df = spark.createDataFrame(rows, "stem string, page int, catalog_id long")
    assert {r.stem: r.pages for r in C.last_pages(df).collect()} == {"a": 7, "b": None}


CHUNKS = "stem string, chunk_id string, page int, chunk_index int, text string"


def documents(spark):
    rows = [("a", "a1", 1, 0, "Rice of the valley"), ("a", "a2", 2, 0, "Abstract\n" + "Rice was grown. " * 12), ("b", "b1", 1, 0, "do not distribute"), ("c", "c1", 4, 0, " \n"), ("d", "d1", 1, 0, "bad"), ("e", "e1", 1, 0, "odd"), (None, "n", 1, 0, "x"), ("f", "f1", 1, 0, None)]
    return spark.createDataFrame(rows, CHUNKS)


def model(broken=()):
    def make():
        def generate(prompt):
            if any(b in prompt for b in broken):
                raise ConnectionError("down")
            if prompt == "bad":
                raise KeyError("x" * 300)
            if prompt == "odd":
                return "no object"
            return f'Here: {{"title": "{prompt[:8]}", "year": "2001-5", "type": "Non-Prints", "is_research": true}} done'

        return generate

    return make


def test_extraction(spark):
    got = {r.stem: r for r in C.extract(documents(spark), model()).collect()}
    assert set(got) == set("abcdef")
    a = got["a"]
    assert (a.title, a.year, a.type, a.flags, a.reason, a.pages, a.is_research, a.restricted) == ("Rice of", "2001", "Non-Prints", [], None, 2, True, None)
    assert a.abstract.startswith("Rice was grown.")
    assert got["b"].flags == ["restricted"]
    for stem in "cf":
        assert (got[stem].flags, got[stem].reason, got[stem].title, got[stem].error) == (["no-title"], C.NO_TEXT, None, None)
    assert (got["d"].flags, got["d"].reason, len(got["d"].error), got["d"].down) == (["error"], "Extraction failed: KeyError", 200, False)
    assert got["e"].flags == ["error"] and got["e"].title is None
    assert C.extract(documents(spark).where("false"), model()).count() == 0


def test_extraction_resumes_and_purges(spark, tmp_path):
    path = str(tmp_path / "r")
    assert C.run_extraction(documents(spark), model(), path, limit=2) == {"asked": 2, "records": 2, "errors": 0, "aborted": False}
    assert C.run_extraction(documents(spark), model(), path) == {"asked": 4, "records": 4, "errors": 2, "aborted": False}
    assert C.run_extraction(documents(spark), model(), path)["asked"] == 2  # only the failed ones
    records = C.read_records(spark, path)
    assert records.count() == 6 and records.where("version = 3").count() == 2
    assert C.purge_errors(spark, path) == 4 and C.purge_errors(spark, path) == 0
    assert sorted(r.stem for r in C.read_records(spark, path).collect()) == ["a", "b", "c", "f"]
    assert C.run_extraction(documents(spark), model(), path)["asked"] == 2


def test_breaker_ends_a_run(spark, tmp_path):
    path = str(tmp_path / "r")
    rows = spark.createDataFrame([(f"s{i:02d}", f"c{i}", 1, 0, f"text {i}") for i in range(30)], CHUNKS).coalesce(1)
    got = C.run_extraction(rows, model(broken=["text"]), path, most_failures=2)
    assert got["aborted"] and got["records"] == 0 and C.read_records(spark, path).count() == 0
    assert C.run_extraction(rows, model(), path) == {"asked": 30, "records": 30, "errors": 0, "aborted": False}


def test_backend_is_checked_first(spark, tmp_path):
    for generator in (lambda p: "", lambda p: 1 / 0, lambda p: None):
        with pytest.raises(C.BackendDown):
            C.run_extraction(documents(spark), lambda g=generator: g, str(tmp_path / "r"))
    assert not (tmp_path / "r").exists()
