import datetime as dt
import random
import time

from pyspark.sql import functions as F

from lamplight.operators import sync, tables
from lamplight.sources import sinks
from lamplight.streaming.drain import INDEX, QUEUE, Breaker, Drain

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.UTC).replace(tzinfo=None)
VIEW = "catalog_id long, is_published int, title_statement string, summary string, general_note string, joint_authors string, publisher string, pub_year string, deleted_at timestamp"


def queue(spark, rows):
    return spark.createDataFrame([(i, c, a, None, n, T0 + dt.timedelta(minutes=m), None, None) for i, c, a, n, m in rows], QUEUE)


def view(spark):
    return spark.createDataFrame(
        [(1, 1, "Rice", "About rice.", "", None, "Press", "1999", None), (2, 0, "Soil", None, None, None, None, None, None), (3, 1, "Gone", None, None, None, None, None, T0), (4, 1, "Long", "word " * 700, None, "A, B", "", "2001", None)], VIEW
    )


def index(spark):
    return spark.createDataFrame([("cat-1-0", "catalog:1", "catalog-1", 0, 0, 0, "old", 1, None), ("cat-2-0", "catalog:2", "catalog-2", 0, 0, 0, "old", 2, None), ("x__p1__c0", "corpus/x", "x", 1, 0, 3, "text", None, None)], INDEX)


def test_claim_and_stats(spark):
    q = queue(spark, [(3, 1, "upsert", 0, 5), (1, 2, "delete", 4, 5), (2, 3, "upsert", 5, 1)])
    assert [r.id for r in sync.claim(q).collect()] == [1, 3]
    assert sync.queue_stats(q).first().asDict() == {"total": 3, "pending": 2, "done": 0, "failed": 1}
    assert sync.queue_stats(q.where("id < 0")).first().asDict() == {"total": 0, "pending": 0, "done": 0, "failed": 0}


def test_gate(spark):
    q = queue(spark, [(1, 1, "upsert", 0, 0), (2, 2, "upsert", 0, 0), (3, 3, "upsert", 0, 0), (4, 9, "upsert", 0, 0), (5, 1, "delete", 0, 1)])
    got = {r.catalog_id: r.verdict for r in sync.gate(sync.latest_actions(q), view(spark)).collect()}
    assert got == {1: "delete", 2: "on-hold", 3: "gone", 9: "gone"}


def test_blob(spark):
    assert view(spark).where("catalog_id = 1").select(sync.metadata_blob().alias("b")).first().b == "Title: Rice\nPublished: Press 1999\nSummary: About rice."


def test_apply_is_idempotent_and_order_free(spark):
    rows = [(1, 1, "upsert", 0, 0), (2, 2, "upsert", 0, 0), (3, 4, "upsert", 0, 0)]
    want = None
    for seed in range(2):
        random.Random(seed).shuffle(rows)
        once = sync.apply_batch(index(spark), queue(spark, rows), view(spark))
        twice = sync.apply_batch(once, queue(spark, rows), view(spark))
        got = sorted(map(str, once.collect()))
        assert got == sorted(map(str, twice.collect()))
        want = want or got
        assert got == want
    ids = {r.chunk_id for r in once.collect()}
    assert ids == {"x__p1__c0", "cat-1-0", "cat-4-0", "cat-4-1", "cat-4-2"}


def test_acknowledge(spark):
    q = queue(spark, [(1, 1, "upsert", 0, 0), (2, 2, "upsert", 4, 0), (3, 3, "upsert", 0, 0)])
    outcome = spark.createDataFrame([(1, None), (2, "x" * 3000)], "id long, error string")
    got = {r.id: (r.processed_at is not None, r.attempts, r.error and len(r.error)) for r in sync.acknowledge(q, outcome, F.current_timestamp()).collect()}
    assert got == {1: (True, 0, None), 2: (False, 5, 2000), 3: (False, 0, None)}


def test_reconcile(spark):
    assert {(r.catalog_id, r.action) for r in sync.reconcile(view(spark), index(spark)).collect()} == {(4, "upsert"), (2, "delete")}


def test_table_changes(spark):
    old = spark.createDataFrame([("a", "ocr_out/x"), ("b", "ocrXout/x"), ("c", None), (None, "d")], "k string, source string")
    assert sorted(r.source or "" for r in tables.delete_containing(old, "source", "ocr_out").collect()) == ["", "d", "ocrXout/x"]
    new = spark.createDataFrame([("a", "n1", 1), ("a", "n2", 2)], "k string, source string, extra int")
    got = tables.replace_by_key(old, new, "k")
    assert got.count() == 5 and set(got.columns) == {"k", "source", "extra"}
    assert tables.add_nullable(tables.add_nullable(old, "v", "bigint"), "v", "bigint").dtypes[-1] == ("v", "bigint")
    assert tables.delete_by_key(old, new, "k").count() == 3


def drain_at(spark, tmp_path, rows, **options):
    queue(spark, rows).coalesce(1).write.parquet(str(tmp_path / "q"))
    index(spark).write.parquet(str(tmp_path / "i/base"))
    return Drain(spark, lambda: view(spark), str(tmp_path / "q"), str(tmp_path / "i"), **options)


def chunks(df):
    return sorted((r.chunk_id, r.text) for r in df.collect())


def riceless():
    def encoder(texts):
        if any("Rice" in t for t in texts):
            raise ValueError("no rice")
        return [[float(len(t)), 1.0] for t in texts]

    return encoder


ROWS = [(1, 1, "upsert", 0, 0), (2, 2, "upsert", 0, 1), (3, 4, "upsert", 0, 2), (4, 4, "delete", 0, 3), (5, 3, "upsert", 5, 3), (6, 4, "upsert", 0, 4)]


def test_stream_equals_batch(spark, tmp_path):
    drain = drain_at(spark, tmp_path, ROWS)
    want = chunks(sync.apply_batch(index(spark), queue(spark, ROWS).where(sync.claimable()), view(spark)))
    for check in ("c1", "c2"):  # the second run finds nothing to do
        drain.start(str(tmp_path / check)).awaitTermination()
        assert chunks(drain.index()) == want
    assert {r.id: (r.processed_at is not None, r.attempts, r.error) for r in drain.queue().collect()} == {**{i: (True, 0, None) for i in (1, 2, 3, 4, 6)}, 5: (False, 5, None)}
    assert sync.queue_stats(drain.queue()).first().asDict() == {"total": 6, "pending": 0, "done": 5, "failed": 1}
    drain.compact()
    assert chunks(drain.index()) == want and not (tmp_path / "i/changes").exists()


def test_batches_are_bounded_and_rewrite_nothing(spark, tmp_path):
    drain = drain_at(spark, tmp_path, ROWS)
    before = sorted((tmp_path / "i/base").iterdir())
    assert {k: v for k, v in drain.drain(2).items() if k != "took_ms"} == {"processed": 2, "failed": 0, "remaining": 3}
    assert [r.id for r in drain.queue().where("processed_at is not null").orderBy("id").collect()] == [1, 2]
    assert drain.drain(2)["remaining"] == 1 and drain.drain()["remaining"] == 0 and drain.drain()["processed"] == 0
    assert sorted((tmp_path / "i/base").iterdir()) == before
    assert {"cat-4-0", "cat-4-1", "cat-4-2", "cat-1-0"} <= {r.chunk_id for r in drain.index().collect()}


def test_replayed_batch_changes_nothing(spark, tmp_path):
    drain = drain_at(spark, tmp_path, ROWS)
    drain.drain()
    want = chunks(drain.index())
    sinks.remove(spark, str(tmp_path / "i/outcomes"))  # as if cut off before the acknowledgement
    drain.drain()
    assert chunks(drain.index()) == want and drain.queue().where(sync.claimable()).count() == 0


def test_poison_row_is_tried_five_times_and_holds_up_nobody(spark, tmp_path):
    drain = drain_at(spark, tmp_path, ROWS, encoder=riceless())
    first = drain.drain()
    assert (first["processed"], first["failed"], first["remaining"]) == (4, 1, 1)
    assert {r.chunk_id: r.vector for r in drain.index().where("catalog_id = 4").collect()}["cat-4-0"] == [1500.0, 1.0]
    assert ("cat-1-0", "old") in chunks(drain.index())  # what can't be made anew stays
    assert drain.drain_all()["failed"] == 4
    poison = drain.queue().where("id = 1").first()
    assert (poison.attempts, poison.processed_at, poison.error) == (5, None, "ValueError: no rice")
    assert drain.drain() | {"took_ms": 0} == {"processed": 0, "failed": 0, "remaining": 0, "took_ms": 0}


def test_dry_run_and_full_texts(spark, tmp_path):
    texts = spark.createDataFrame([(1, "full text of it")], "catalog_id long, fulltext string")
    dry = drain_at(spark, tmp_path, ROWS, dry_run=True, fulltext=lambda rows: texts)
    assert dry.drain()["processed"] == 5 and chunks(dry.index()) == chunks(index(spark))
    changes, outcomes = dry.plan(dry.queue().where(sync.claimable()))
    assert {(r.chunk_id, r.text) for r in changes.where("catalog_id = 1").collect()} == {("cat-1-0", "Title: Rice\nPublished: Press 1999\nSummary: About rice."), ("cat-1-1", "full text of it")}
    assert outcomes.where("error is null").count() == 5


def test_empty_queue(spark, tmp_path):
    assert drain_at(spark, tmp_path, []).drain_all() | {"took_ms": 0} == {"processed": 0, "failed": 0, "remaining": 0, "took_ms": 0}


def test_clock_drives_retries(spark, tmp_path):
    drain = drain_at(spark, tmp_path, ROWS[:2])
    stream = drain.start(str(tmp_path / "c"), every="1 second")
    try:
        for _ in range(60):
            if (tmp_path / "i/outcomes").exists():
                break
            time.sleep(1)
    finally:
        stream.stop()
    assert drain.queue().where("processed_at is null").count() == 0


def test_media_and_full_texts(spark):
    media = spark.createDataFrame([(1, 1, "old.pdf", None), (2, 1, "\\\\up\\a.pdf", None), (3, 2, "gone.pdf", None), (4, 4, "/up/b.pdf", None), (5, 4, "x.pdf", T0)], "id long, catalog_id long, FileLocation string, deleted_at timestamp")
    contents = spark.createDataFrame([("/srv/up/a.pdf", bytearray(b" one|two ")), ("/srv/up/b.pdf", bytearray(b"bad"))], "path string, content binary")
    rows = sync.located(view(spark), media, contents, "/srv/")
    assert {r.catalog_id: r.path for r in rows.collect()} == {1: "/srv/up/a.pdf", 2: None, 3: None, 4: "/srv/up/b.pdf"}

    def parser(content):
        if content == b"bad":
            raise ValueError
        return content.decode().split("|")

    assert {r.catalog_id: r.fulltext for r in sync.full_texts(rows, contents, parser).collect()} == {1: "one\ntwo", 2: "", 3: "", 4: ""}


def test_enqueued(spark):
    q = queue(spark, [(1, 7, "upsert", 3, 0), (2, 8, "upsert", 0, 0)])
    ids = spark.createDataFrame([(9,), (7,), (7,), (None,), (0,)], "catalog_id long")
    got = sync.enqueued(q, ids, "delete", "reconcile", F.lit(T0), 100)
    assert {(r.id, r.catalog_id, r.action, r.reason, r.attempts, r.created_at) for r in got.where("id > 1").collect()} == {(2, 8, "upsert", None, 0, T0), (100, 7, "delete", "reconcile", 0, T0), (101, 9, "delete", "reconcile", 0, T0)}
    assert got.count() == 3 and sync.enqueued(q, ids.where("false"), "delete", "r", F.lit(T0), 1).count() == 2


def test_breaker():
    b = Breaker(3)
    for ok in (False, False, True, False, False):
        b.report(ok)
    assert not b.open
    b.report(False)
    assert b.open


def test_long_queue_takes_few_batches(spark, tmp_path):
    rows = [(i, 1 + i % 5, "delete" if i % 7 == 0 else "upsert", 0, i) for i in range(1, 1001)]
    drain = drain_at(spark, tmp_path, rows)
    assert drain.drain_all() | {"took_ms": 0} == {"processed": 1000, "failed": 0, "remaining": 0, "took_ms": 0}
    assert len(list((tmp_path / "i/outcomes").iterdir())) == 1
    assert chunks(drain.index()) == chunks(sync.apply_batch(index(spark), queue(spark, rows).where(sync.claimable()), view(spark)))
    bounded = drain_at(spark, tmp_path / "bounded", rows)
    assert bounded.drain(5000)["processed"] == 200  # a batch asked for over the network


def test_bulk_batches_equal_small_ones(spark, tmp_path):
    rows = [(i, 1 + i % 5, "delete" if i % 3 == 0 else "upsert", 0, i) for i in range(1, 31)]
    small, large = (drain_at(spark, tmp_path / n, rows) for n in ("small", "large"))
    small.drain_all(20)
    large.drain_all()
    assert chunks(small.index()) == chunks(large.index())
    state = lambda d: sorted((r.id, r.processed_at is not None, r.attempts, r.error) for r in d.queue().collect())
    assert state(small) == state(large)
