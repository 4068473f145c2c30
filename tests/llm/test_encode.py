import random

import pytest

from lamplight.llm import encode as E

tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def vocabulary():
    try:
        return open(E.VOCABULARY, "rb").read()
    except OSError:
        pytest.skip("no vocabulary file")


def plain(vocabulary, texts):
    encoding = E._encoder(vocabulary, E.PATTERN)[0]
    return [encoding.encode_ordinary(t or "") for t in texts]


def test_fragments_give_the_ids_of_whole_texts(vocabulary):
    parts = ["a", "b", " ", "  ", "\n", "\n\n", "'", "'s", "'re", "don't", "\t", "é", "ñ", " ", "　", "中", "😀", "1", "23", ".", "!!", "…", "“", "<|endoftext|>", "zq", "QX", "'ll", "\"'t", "_", "\x1c", "\x85", "​", "İ", "naïve"]
    rng = random.Random(1)
    texts = [None, "", *("".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(5000))]
    ids, first = E.encode_texts(texts, vocabulary)
    assert [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)] == plain(vocabulary, texts)


def test_corpus(spark, vocabulary):
    long = "rice and soil " * 50_000
    rows = [(1, None, [0]), (2, "", None), (3, "Rice grows.", None), (3, "Rice grows.", None), (4, long, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids array<int>")
    got = [(r.id, r.ids) for r in E.encode_corpus(df, "doc_id", "text").collect()]
    want = plain(vocabulary, ["Rice grows.", long])
    assert sorted((i, x) for i, x in got if i != 4) == [(1, []), (2, []), (3, want[0]), (3, want[0])]
    assert dict(got)[4] == want[1]
    assert E.encode_corpus(df.where("false"), "doc_id", "text").count() == 0
