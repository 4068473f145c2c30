import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from lamplight.llm import words as W
from lamplight.llm.order_minhash import NearDuplicates, near_duplicate_records
from lamplight.llm.queries import QUERIES


def test_words_equal_a_plain_scan():
    texts = ["Rice, RICE 12x!", None, "", "\n\n", "a-b_c é d", "İstanbul K 1"]
    w = W.words(texts)
    want = [re.findall("[a-z0-9]+", (t or "").lower()) for t in texts]
    assert [int(x) for x in (w.first[1:] - w.first[:-1])] == [len(x) for x in want]
    flat = [x for one in want for x in one]
    assert len(set(zip(flat, w.hash.tolist(), strict=True))) == len(set(flat)) == len(set(w.hash.tolist()))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text("ab ", max_size=30), max_size=6), st.integers(1, 4))
def test_grams_and_distinct(texts, k):
    w = W.words(texts)
    g, f = W.grams(w.hash, w.first, k)
    d, fd = W.distinct(g, f)
    o = W.occurrence_labelled(g, f)
    for i, t in enumerate(texts):
        own = re.findall("[a-z0-9]+", t.lower())
        runs = list(zip(*(own[j:] for j in range(k)), strict=False)) if len(own) >= k else []
        assert f[i + 1] - f[i] == len(runs)
        assert fd[i + 1] - fd[i] == len(set(runs))
        assert len(set(o[f[i] : f[i + 1]].tolist())) == len(runs)


def make(n=300, seed=1):
    rng = random.Random(seed)
    lexicon = [f"w{i}" for i in range(400)]
    texts = [[rng.choice(lexicon) for _ in range(rng.randint(20, 90))] for _ in range(n)]
    for base in range(40):
        for _ in range(rng.randint(1, 4)):
            t = list(texts[base])
            for _ in range(rng.randint(0, 4)):
                t[rng.randrange(len(t))] = rng.choice(lexicon)
            if rng.random() < 0.4:
                cut = rng.randrange(len(t))
                t = t[cut:] + t[:cut]
            texts.append(t)
    texts += [texts[0]] * 30
    return [" ".join(t) for t in texts]


def brute(texts, k, threshold, least):
    grams = []
    for t in texts:
        own = re.findall("[a-z0-9]+", (t or "").lower())
        grams.append(set(zip(*(own[j:] for j in range(k)), strict=False)) if len(own) >= least else None)
    return {(i, j) for i in range(len(texts)) for j in range(i + 1, len(texts)) if grams[i] and grams[j] and len(grams[i] & grams[j]) >= threshold * len(grams[i] | grams[j])}


def test_pairs_equal_brute_force(spark):
    texts = make()
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    got = {(r.key_a, r.key_b) for r in NearDuplicates(df, "id", "text").record_pairs(200).collect()}
    want = brute(texts, 3, 0.5, 20)
    assert got <= want
    assert len(got) >= 0.98 * len(want)


def test_characters(spark):
    stems = ["Dalsivayara_Contamina_1983", "dalsivayara contamina 1983", "Rice_Vol3", "Unlike", "ab", ""]
    df = spark.createDataFrame([(s, s) for s in stems], "stem string, spelling string")
    op = NearDuplicates(df, "stem", "spelling", unit="char", least=3, k=3, sample=3, tables=96)
    assert {(r.key_a, r.key_b) for r in op.record_pairs(200).collect()} == {(stems[0], stems[1])}


def test_edges(spark):
    long = " ".join(f"x{i}" for i in range(60_000))
    rows = [(1, None, 0), (2, "", 0), (3, long, 0), (4, long + " end", 0), (5, "too short", 0), (3, long, 0), (None, long, 0)]
    df = spark.createDataFrame(rows, "id int, text string, cls int")
    assert {(r.key_a, r.key_b) for r in NearDuplicates(df, "id", "text").record_pairs(200).collect()} == {(3, 4)}
    assert sorted((r.id, r.links) for r in near_duplicate_records(df, "id", "text").collect()) == [(3, 1), (4, 1)]
    assert NearDuplicates(df.where("false"), "id", "text").record_pairs(200).count() == 0


def test_hot_group_of_copies_is_one_class(spark):
    text = " ".join(f"y{i}" for i in range(40))
    df = spark.createDataFrame([(i, text) for i in range(3000)] + [(5000, text + " more")], "id int, text string")
    got = near_duplicate_records(df, "id", "text")
    assert {(r.class_id, r.links) for r in got.collect()} == {(r.class_id, 1) for r in got.collect()}
    assert got.select("class_id").distinct().count() == 2


def test_hot_copies_are_a_star(spark):
    text = " ".join(f"y{i}" for i in range(40))
    df = spark.createDataFrame([(i, text) for i in range(300)] + [(900, text + " more"), (901, text + " more")], "id int, text string")
    got = {(r.key_a, r.key_b) for r in NearDuplicates(df, "id", "text").record_pairs(200).collect()}
    assert got == {(0, i) for i in range(1, 300)} | {(0, 900), (0, 901), (900, 901)}


def test_hot_bucket_in_blocks(spark):
    from lamplight.llm.lsh import candidate_pairs

    rows = spark.range(100).selectExpr("7L as key", "id").unionByName(spark.createDataFrame([(1, 5), (1, 9), (1, 9), (2, 3)], "key long, id long"))
    got = {(r.a, r.b) for r in candidate_pairs(rows, "t", block=16).collect()}
    assert got == {(a, b) for a in range(100) for b in range(a + 1, 100)}


def test_records_have_one_row_each(spark, tmp_path):
    nine = "one two three four five six seven eight nine"
    texts = [("a", nine), ("b", nine + " ten"), ("c", "Rice and soil."), ("d", "rice AND soil"), ("e", "rice"), ("f", None), ("g", None), ("h", ""), ("i", " \n"), ("j", "..."), ("k", nine.upper()), ("l", "a b c d e"), ("m", "a b c d e"), ("a", nine)]
    spark.createDataFrame(texts, "row_id string, text string").write.parquet(f"{tmp_path}/research.parquet")
    rows = QUERIES["p1_records"](spark, str(tmp_path)).collect()
    assert sorted(r.id for r in rows) == list("abcdefghijklm")
    cls, links = {r.id: r.class_id for r in rows}, {r.id: r.links for r in rows}
    assert cls["a"] == cls["k"] and cls["c"] == cls["d"] and cls["l"] == cls["m"]
    assert len(set(cls.values())) == 10
    assert {i for i in links if links[i]} == {"a", "b", "k"} and links["b"] == 1


def test_members_and_links_of_any_size(spark):
    text = " ".join(f"y{i}" for i in range(40))
    rows = [(i, text) for i in range(50)] + [(900, text + " more"), (901, text + " more"), (902, " ".join(f"z{i}" for i in range(40)))]
    op = NearDuplicates(spark.createDataFrame(rows, "id int, text string"), "id", "text")
    assert {(r.representative, r.copies) for r in op.members().collect()} == {(0, 50), (900, 2), (902, 1)}
    (pair,) = op.representative_pairs().collect()
    assert (pair.key_a, pair.key_b) == (0, 900)
    assert abs(pair.similarity - 38 / 39) < 1e-9 and abs(pair.edit_similarity - 40 / 41) < 1e-9
    assert op.record_pairs(10).count() == 49 + 2 + 1  # a star of 50, its centre with two copies, and these
    assert op.record_pairs(50).count() == 50 * 49 // 2 + 50 * 2 + 1


def test_edit_similarity_is_null_beyond_the_band(spark):
    words = [f"w{i}" for i in range(120)]
    df = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[60:] + words[:60]))], "id int, text string")
    (pair,) = NearDuplicates(df, "id", "text").representative_pairs().collect()
    assert pair.similarity > 0.9 and pair.edit_similarity is None


def test_places_are_told_apart_in_very_long_texts():
    from lamplight.llm.order_minhash import sketch_keys

    import numpy as np

    n = 1_200_000
    h = W.mix(np.arange(n, dtype=np.uint64))
    turned = np.concatenate([h[n // 2 :], h[: n // 2]])
    keys = [sketch_keys(x, np.array([0, n]), 4, 2, 12) for x in (h, turned)]
    assert 0 < (keys[0] == keys[1]).sum() < 12  # samples of both halves change their order


def test_key_filter(spark):
    import numpy as np

    from lamplight.llm.lsh import key_filter, may_be_in

    keys = spark.range(5000).selectExpr("xxhash64(id) as k")
    bitmap = key_filter(keys, 5000).value
    have = np.array([r.k for r in keys.collect()], np.int64).view(np.uint64)
    assert may_be_in(bitmap, have).all()
    assert may_be_in(bitmap, W.mix(np.arange(10_000, dtype=np.uint64))).mean() < 0.2
    assert not may_be_in(key_filter(keys.limit(0), 0).value, have).any()


def test_pairs_by_chance_are_not_written(spark, tmp_path, monkeypatch):
    import numpy as np

    from lamplight.llm import lsh

    written = {}
    keep = lambda df, name: written.setdefault(name, materialize(df, name))
    materialize = lsh.materialize
    monkeypatch.setattr(lsh, "materialize", keep)
    near = lambda a, b: np.abs(a[:, 0] - b[:, 0]) <= 1
    rows = spark.range(100).selectExpr("7L as key", "id", "id as s").unionByName(spark.range(50, 60).selectExpr("8L as key", "id", "id as s"))
    for block in (16, 512):  # in blocks, and in one task
        written.clear()
        got = sorted((r.a, r.b) for r in lsh.candidate_pairs(rows, "t", block, near).collect())
        assert got == [(a, a + 1) for a in range(99)]
        assert written["t"].where("a is not null").count() == (9 if block == 16 else 99 + 9)
    edges = spark.createDataFrame([(1, 5, 0), (1, 9, 5), (1, 9, 5), (2, 3, 0)], "key long, id long, s long")
    assert lsh.candidate_pairs(edges, "t2", keep=near).count() == 0 and lsh.candidate_pairs(edges.where("false"), "t3", keep=near).count() == 0


def test_sketches_of_classes_meet_in_their_buckets(spark, monkeypatch):
    from lamplight.llm import lsh

    written = {}
    materialize = lsh.materialize
    monkeypatch.setattr(lsh, "materialize", lambda df, name: written.setdefault(name, materialize(df, name)))
    shared = "in the year of the survey"  # all texts have these words, and nothing else, in common
    df = spark.createDataFrame([(i, f"{shared} " + " ".join(f"w{i}x{j}" for j in range(150))) for i in range(200)], "id int, text string")
    assert NearDuplicates(df, "id", "text", sample=1, name="chance").class_pairs().count() == 0
    assert written["chance-candidates"].count() == 0
