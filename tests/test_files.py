from pyspark.sql import functions as F

from lamplight.operators import files as L

MANIFEST = "path string, stem string, pages int, status string, out string, chars int, seconds double, error string, updated double"


def test_bucket_bounds(spark):
    df = spark.createDataFrame([(0.0,), (0.05,), (0.083,), (0.799,), (0.80,), (1.0,)], "f double")
    assert [r.b for r in df.select(L.bucket(F.col("f")).alias("b")).collect()] == ["NEEDS_OCR"] * 2 + ["SUSPECT_TEXT_LAYER"] * 2 + ["TEXT_READY"] * 2


def test_triage_is_total(spark):
    long = "x" * 60
    rows = [(1, None), (2, []), (3, [long] * 4 + ["y"]), (4, ["y"] * 12), (5, [long] + [None] * 11)]
    got = {r.id: (r.bucket, r.pages_with_text) for r in L.triage(spark.createDataFrame(rows, "id int, p array<string>"), "id", F.col("p")).collect()}
    assert got == {1: ("ERROR_READ", 0), 2: ("ERROR_EMPTY", 0), 3: ("TEXT_READY", 4), 4: ("NEEDS_OCR", 0), 5: ("SUSPECT_TEXT_LAYER", 1)}


def test_triage_tells_open_from_read(spark):
    df = spark.createDataFrame([(1, None, "open"), (2, None, "read"), (3, ["x" * 60], None), (4, None, None)], "id int, p array<string>, e string")
    got = {r.id: (r.bucket, r.pages_inspected) for r in L.triage(df, "id", F.col("p"), failure=F.col("e")).collect()}
    assert got == {1: ("ERROR_OPEN", 0), 2: ("ERROR_READ", 0), 3: ("TEXT_READY", 1), 4: ("ERROR_READ", 0)}


def test_work_order(spark):
    df = spark.createDataFrame([("a", 9, "pending"), ("b", 2, "pending"), ("c", 60, "pending"), ("d", 0, "pending"), ("e", 3, "done"), ("f", None, "pending")], "path string, pages int, status string")
    assert {(r.tier, r.path, r.place) for r in L.work_order(df, ["path"]).collect()} == {("small", "b", 1), ("small", "a", 2), ("large", "c", 1)}
    assert L.work_order(df, ["path"], limit=1).count() == 2


def test_tiers(spark):
    df = spark.createDataFrame([(0,), (1,), (10,), (11,), (50,), (51,), (None,)], "n int")
    assert [r.t for r in df.select(L.tier(F.col("n")).alias("t")).collect()] == [None, "small", "small", "medium", "medium", "large", None]


def test_systematic_sample(spark):
    df = spark.range(101).repartition(3)
    assert sorted(r.id for r in L.systematic_sample(df, ["id"], 10).collect()) == [int(i * 101 / 10) for i in range(10)]
    assert L.systematic_sample(df, ["id"], 200).count() == 101
    assert L.systematic_sample(df.where("id < 0"), ["id"], 5).count() == 0


def test_manifest_changes(spark):
    old = spark.createDataFrame([("a", "s", 1, "pending", None, None, None, None, None), ("b", "s", 2, "pending", None, None, None, None, None), ("c", "t", 3, "done", "x", 1, 1.0, None, 1.0)], MANIFEST)
    new = spark.createDataFrame([("a", "s", 9, "pending", None, None, None, None, None), ("d", "u", 4, "pending", None, None, None, None, None)], MANIFEST)
    assert [r.path for r in L.insert_or_ignore(old, new, "path").collect()] == ["d"]
    skipped = spark.createDataFrame([("b",), ("c",), ("b",)], "path string")
    assert {r.path: r.status for r in L.skip_pending(old, skipped).collect()} == {"a": "pending", "b": "skip", "c": "done"}
    results = spark.createDataFrame([("a", "md", 2, 1.5, None, 2.0), ("b", None, None, 0.1, "e" * 3000, 2.0)], "path string, out string, chars int, seconds double, error string, updated double")
    done = {r.path: r for r in L.finish(old, results).collect()}
    assert (done["a"].status, done["a"].out, done["b"].status, len(done["b"].error), done["c"].out) == ("done", "md", "error", 2000, "x")
    totals = {r.status: (r.n, r.pages) for r in L.status_totals(old).collect()}
    assert totals == {"pending": (2, 3), "done": (1, 3), None: (3, 6)}


def test_duplicates(spark):
    rows = [(1, 3, "abc"), (2, 3, "abc"), (3, 3, "xyz"), (4, 5, "abcde"), (5, None, None), (6, 0, ""), (7, 0, ""), (8, 4, "abcd"), (9, 4, "abcd"), (10, 4, "abcd")]
    df = spark.createDataFrame(rows, "id int, n int, t string")
    members = L.duplicate_members(df, "id", F.col("n"), F.col("t"))
    assert sorted(r.id for r in members.collect()) == [1, 2, 8, 9, 10]  # empty content is no duplicate
    assert sorted(r.id for r in L.keepers(members, [-F.col("id")]).collect()) == [2, 10]
    paged = members.withColumn("pages", 11 - F.col("id"))
    assert L.redundant_pages(paged, [F.col("id")]).first().redundant_pages == 10 * 1 + 3 * 2
    assert L.redundant_pages(paged.where("id < 0"), [F.col("id")]).first().redundant_pages == 0
    assert L.duplicate_members(df.where("id < 0"), "id", F.col("n"), F.col("t")).count() == 0


def test_numbered_rows(spark):
    df = spark.createDataFrame([(i * 7 % 101,) for i in range(101)], "k int").repartition(5)
    assert [(r.k, r.n) for r in L.numbered_rows(df, ["k"], 10).orderBy("k").collect()] == [(i, 10 + i) for i in range(101)]
    assert L.numbered_rows(df.where("k < 0"), ["k"]).count() == 0


def test_progress():
    assert L.progress(0, 10, 5.0)["eta"] == L.progress(3, 10, 0.0)["eta"] == "--"
    assert L.progress(10, 40, 100.0) == {"percent": 25.0, "rate": 0.1, "eta": "5m00s"}
    assert L.progress(1, 101, 60.0)["eta"] == "1h40m"
