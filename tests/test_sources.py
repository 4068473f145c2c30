import os
import time

import pytest

from lamplight.sources import readers, sinks


def test_files(spark, tmp_path):
    (tmp_path / "in/sub").mkdir(parents=True)
    (tmp_path / "in/a.PDF").write_bytes(b"one|two")
    (tmp_path / "in/sub/b.pdf").write_bytes(b"bad")
    (tmp_path / "in/c.md").write_bytes("café ".encode() + b"\xff\xfe" + b"end")
    root = str(tmp_path / "in")
    assert sorted(r.path.rsplit("/", 1)[1] for r in readers.list_files(spark, root).collect()) == ["a.PDF", "b.pdf"]
    assert [(r.stem, r.text) for r in readers.read_texts(spark, root).collect()] == [("c", "café end")]

    def parser(content):
        if content == b"bad":
            raise ValueError("no pages")
        return content.decode().split("|")

    got = {(r.path.rsplit("/", 1)[1], r.page, r.text, r.error) for r in readers.read_pages(readers.read_binary(spark, root), parser).collect()}
    assert got == {("a.PDF", 1, "one", None), ("a.PDF", 2, "two", None), ("b.pdf", None, None, "ValueError: no pages")}


def test_json_lines_tolerate_torn_ones(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"stem": "a", "flags": ["error"]}\n\n{"stem": "b"\n{"stem": "c"}\n')
    good, broken = readers.read_json_lines(spark, str(tmp_path / "x.jsonl"), "stem string, flags array<string>")
    assert [r.stem for r in good.collect()] == ["a", "c"]
    assert [r.value for r in broken.collect()] == ['{"stem": "b"']


def test_triage_csv(spark, tmp_path):
    (tmp_path / "t.csv").write_text('path,name,pages_total,pages_inspected,pages_with_text,text_fraction,avg_chars_on_text_pages,bucket,error\na,a,12,12,1,0.083,60.0,NEEDS_OCR,\nb,b,x,,0,,0,ERROR_READ,"bad, file"\n')
    rows = {r.path: r for r in readers.read_triage(spark, str(tmp_path / "t.csv")).collect()}
    assert (rows["a"].pages_total, rows["b"].pages_total, rows["b"].error) == (12, 0, "bad, file")
    assert readers.read_triage(spark, str(tmp_path / "t.csv"), ("NEEDS_OCR", "TEXT_READY")).count() == 1


def test_extracted_and_lists(spark, tmp_path):
    (tmp_path / "d.json").write_text('{"source": "x",\n "stem": "s", "pages_total": 0, "pages": [{"page": 2, "text": "t"}]}')
    assert [(r.stem, r.page) for r in readers.read_extracted(spark, str(tmp_path / "d.json")).collect()] == [("s", 2)]
    (tmp_path / "m.json").write_text('[{"source": "a", "out": "o"}, {"source": "", "out": "o"}, {"out": "o"}]')
    assert readers.read_manifest_array(spark, str(tmp_path / "m.json")).count() == 1
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "stem string")
    sinks.write_list(df, "stem", str(tmp_path / "list"))
    assert sorted(r.stem for r in readers.read_skip_list(spark, str(tmp_path / "list")).collect()) == ["a", "b"]
    assert readers.parse_env("# no\nA=1\n B = 'x=y' \nnothing") == {"A": "1", "B": "x=y"}


def test_staged_overwrite_of_its_own_source(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.overwrite_staged(spark.range(5), path)
    sinks.overwrite_staged(spark.read.parquet(path).where("id > 2"), path)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [3, 4]
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_append_resumes(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.append_missing(spark.createDataFrame([("a", 1)], "stem string, n int"), path, "stem")
    sinks.append_missing(spark.createDataFrame([("a", 2), ("b", 3)], "stem string, n int"), path, "stem")
    assert {(r.stem, r.n) for r in spark.read.json(path).collect()} == {("a", 1), ("b", 3)}
    sinks.write_csv(spark.createDataFrame([("a,b", None)], "x string, y string"), str(tmp_path / "c"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).first().x == "a,b"
    sinks.write_json_lines(spark.range(2), str(tmp_path / "j"))
    sinks.write_json_lines(spark.range(1), str(tmp_path / "j"), append=True)
    assert spark.read.json(str(tmp_path / "j")).count() == 3


def test_keyed_texts_versions_and_samples(spark, tmp_path):
    path = str(tmp_path / "k")
    sinks.write_texts(spark.createDataFrame([("a", "1"), ("b", "2"), (None, "x")], "stem string, text string"), "stem", "text", path)
    sinks.write_texts(spark.createDataFrame([("b", "3"), ("c", None)], "stem string, text string"), "stem", "text", path)
    assert {(r.stem, r.text) for r in sinks.read_keyed(spark, path, "stem").collect()} == {("a", "1"), ("b", "3"), ("c", None)}
    assert sinks.append_version(spark.range(1), str(tmp_path / "v"), 3) and not sinks.append_version(spark.range(9), str(tmp_path / "v"), 3)
    assert spark.read.parquet(str(tmp_path / "v")).count() == 1
    assert sinks.create_if_absent(spark, str(tmp_path / "m"), "path string") and not sinks.create_if_absent(spark, str(tmp_path / "m"), "path string")
    assert spark.read.parquet(str(tmp_path / "m")).count() == 0
    rows = spark.createDataFrame([(1, "in/x.pdf", "text", None), (2, "in/y.pdf", None, "ValueError")], "sample_idx int, source string, text string, error string")
    sinks.write_samples(rows, str(tmp_path / "s"))
    manifest = {r.sample_idx: (r.out, r.chars, r.error) for r in spark.read.json(str(tmp_path / "s/manifest")).collect()}
    assert manifest == {1: ("001__x", 4, None), 2: ("", 0, "ValueError")}
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "s/texts")).collect()] == [("001__x", "text")]
    sinks.write_index(spark.range(2), str(tmp_path / "i"))
    sinks.write_index(spark.range(1), str(tmp_path / "i"), append=True)
    assert spark.read.parquet(str(tmp_path / "i")).count() == 3


def test_whole_documents(spark):
    files = spark.createDataFrame([("a", bytearray(b"x|y ")), ("b", bytearray(b""))], "path string, content binary")
    got = {r.path: r.text for r in readers.read_documents(files, lambda c: c.decode().split("|") if c else 1 / 0).collect()}
    assert got == {"a": "x\ny", "b": ""}


def test_one_run_at_a_time(spark, tmp_path):
    path = str(tmp_path / "lock")
    with sinks.run_lock(spark, path):
        with pytest.raises(sinks.AlreadyRunning), sinks.run_lock(spark, path):
            pass
        assert (tmp_path / "lock").exists()
    assert not (tmp_path / "lock").exists()
    (tmp_path / "lock").touch()
    os.utime(path, (time.time() - 100, time.time() - 100))
    with pytest.raises(sinks.AlreadyRunning), sinks.run_lock(spark, path):
        pass
    with sinks.run_lock(spark, path, stale_seconds=50):
        pass


def test_jdbc_ranges(spark, monkeypatch):
    seen = {}

    class Reader:
        def __getattr__(self, name):
            def call(*a, **k):
                seen.update({a[0]: a[1]} if name == "option" else k)
                return self

            return call

    monkeypatch.setattr(type(spark), "read", property(lambda self: Reader()))
    readers.read_jdbc(spark, "jdbc:x", "queue", "id", 1, 100, 4, user="u")
    assert seen == {"url": "jdbc:x", "dbtable": "queue", "user": "u", "partitionColumn": "id", "lowerBound": 1, "upperBound": 100, "numPartitions": 4}
