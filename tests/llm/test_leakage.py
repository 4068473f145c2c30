import random
import re

from lamplight.llm import leakage
from lamplight.llm.leakage import edit_distances, find_leaks
from lamplight.llm.queries import QUERIES

import numpy as np
import pytest


def corpus(spark, edits, n=200, seed=5):
    rng = random.Random(seed)
    lexicon = [f"w{i}" for i in range(300)]
    items = [(c, " ".join(rng.choice(lexicon) for _ in range(rng.randint(4, 40))), " ".join(rng.choice(lexicon) for _ in range(60)) if c % 3 else None) for c in range(30)]
    docs, planted = [], set()
    for i in range(n):
        t = [rng.choice(lexicon) for _ in range(80)]
        if i % 2:
            c, q, p = items[rng.randrange(len(items))]
            source = (p or q).split()
            if len(source) >= 12:
                at = rng.randrange(len(source) - 11)
                piece = source[at : at + 12]
                for _ in range(edits):
                    piece[rng.randrange(1, 11)] = "zz"
                t[20:20] = piece
                planted.add((i, c))
        docs.append((i, ", ".join(t).upper()))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "case_id long, query string, passage string"), docs, items, planted


def grams(t):
    w = re.findall("[a-z0-9]+", (t or "").lower())
    return set(zip(*(w[j:] for j in range(12)), strict=False)) if len(w) >= 12 else set()


def leaks(df, cases, **options):
    return find_leaks(df, "doc_id", "text", cases, "case_id", ["query", "passage"], **options)


def test_exact_passages_equal_brute_force(spark):
    df, cases, docs, items, _ = corpus(spark, 0)
    got = {(r.id, r.case_id) for r in leaks(df, cases).where("edits = 0").collect()}
    assert got == {(i, c) for i, t in docs for c, q, p in items if grams(t) & (grams(q) | grams(p))}


def test_join_of_keys_equals_the_scan(spark, monkeypatch):
    df, cases, *_ = corpus(spark, 1)
    want = {tuple(r) for r in leaks(df, cases, edits=2).collect()}
    monkeypatch.setattr(leakage, "ITEM_WINDOWS", 50)
    assert {tuple(r) for r in leaks(df, cases, edits=2).collect()} == want
    assert leaks(df.where("false"), cases, edits=2).count() == 0


def test_ids_of_any_type(spark):
    df, cases, *_ = corpus(spark, 0, n=20)
    named = leaks(df.selectExpr("concat('d', doc_id) as doc_id", "text"), cases.selectExpr("concat('c', case_id) as case_id", "query", "passage"))
    assert {(r.id, r.case_id) for r in named.collect()} == {(f"d{r.id}", f"c{r.case_id}") for r in leaks(df, cases).collect()}


def test_repetitions_follow_the_recall():
    assert leakage.repetitions(12, 0, 6, 0.95) == 1
    few, more, two = leakage.repetitions(12, 1, 6, 0.8), leakage.repetitions(12, 1, 6, 0.98), leakage.repetitions(12, 2, 6, 0.98)
    assert 1 < few < more < two <= leakage.MOST_REPEATS
    with pytest.raises(ValueError, match="repetitions"):
        leakage.repetitions(12, 2, 16, 0.9999)


def test_recall_reaches_its_target_against_brute_force(spark):
    for edits in (1, 2):
        df, cases, *_ = corpus(spark, edits, n=400)
        want = {(r.id, r.case_id) for r in leaks(df, cases, edits=edits, recall=1).collect()}
        got = {(r.id, r.case_id) for r in leaks(df, cases, edits=edits).collect()}
        assert got <= want and len(got) >= 0.95 * len(want)


def _one_edit(rng, lexicon, words, kind):
    """Twelve of the words, or so many that twelve stay, with one edit inside."""
    n = 14 if kind == "drop" else 12
    at = rng.randrange(len(words) - n + 1)
    piece, place = words[at : at + n], rng.randrange(2, n - 2)
    return piece[:place] + (["zz"] if kind != "drop" else []) + piece[place + (kind != "insert") :]


def test_production_finds_edited_passages(spark, tmp_path):
    rng = random.Random(11)
    lexicon = [f"w{i}" for i in range(300)]
    items = [(c, " ".join(rng.choice(lexicon) for _ in range(20)), " ".join(rng.choice(lexicon) for _ in range(40))) for c in range(20)]
    docs, planted = [], {}
    for i in range(240):
        kind = ("replace", "insert", "drop")[i % 3]
        c, q, p = rng.choice(items)
        t = [rng.choice(lexicon) for _ in range(80)]
        t[20:20] = _one_edit(rng, lexicon, rng.choice([q, p]).split(), kind)
        docs.append((i, " ".join(t)))
        planted[i, c] = kind
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "case_id long, query string, passage string").write.parquet(f"{tmp_path}/eval_cases.parquet")
    rows = QUERIES["p7_edited"](spark, str(tmp_path)).collect()
    got = {(r.doc_id, r.case_id) for r in rows}
    for kind in ("replace", "insert", "drop"):
        mine = {k for k in planted if planted[k] == kind}
        assert len(mine & got) >= 0.95 * len(mine)
    assert all(0 < r.edits <= 2 for r in rows)


def test_pieces_equal_brute_force(spark):
    df, cases, docs, items, _ = corpus(spark, 2, n=60)
    got = {(r.id, r.case_id): (r.edits, r.windows) for r in find_leaks(df, "doc_id", "text", cases, "case_id", ["query", "passage"], edits=2, recall=1).collect()}
    code = {}
    windows = lambda t: [[code.setdefault(x, len(code)) for x in w] for w in _windows(t)]
    want = {}
    held = [(c, np.array(windows(q) + windows(p)).reshape(-1, 12)) for c, q, p in items]
    for i, t in docs:
        here = np.array(windows(t))
        for c, there in held:
            d = edit_distances(np.repeat(here, len(there), axis=0), np.tile(there, (len(here), 1)), 2)
            if (d <= 2).any():
                want[i, c] = (int(d.min()), int((d <= 2).sum()))
    assert want and got == want


def _windows(t):
    w = re.findall("[a-z0-9]+", (t or "").lower())
    return [w[j : j + 12] for j in range(len(w) - 11)]


def test_edit_distance():
    x, y = np.array([[1, 2, 3, 4], [1, 2, 3, 4], [1, 2, 3, 4]]), np.array([[1, 2, 3, 4], [2, 3, 4, 5], [9, 9, 9, 9]])
    assert edit_distances(x, y, 2).tolist() == [0, 2, 3]


def test_edges(spark):
    df, cases, *_ = corpus(spark, 0, n=4)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "short text"), (4, "w1 " * 100_000)], "doc_id long, text string")
    assert find_leaks(odd, "doc_id", "text", cases, "case_id", ["query", "passage"]).count() == 0
    assert find_leaks(df, "doc_id", "text", cases.where("false"), "case_id", ["query", "passage"]).count() == 0
    assert find_leaks(df.where("false"), "doc_id", "text", cases, "case_id", ["query", "passage"]).count() == 0
