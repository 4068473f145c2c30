import random

from lamplight.llm.reading_level import BANDS, ReadingModel, english_prose, reading_levels

WORDS = {
    "primary": ("the cat dog boy hat sun red big wet", "sees likes has", 5),
    "secondary": ("farmer village market season water healthy common careful harvest", "gathered because the members followed the", 16),
    "college": ("experimental irrigation treatment significant moisture variation physiological", "interacted with the", 22),
    "specialist": ("socioeconomic institutionalization multidimensional characterization biogeochemical intensification methodological", "necessitates the integrated consideration of", 34),
}


def text(band, rng):
    nouns, verbs, n = WORDS[band]
    nouns = nouns.split()
    return " ".join(" ".join(["The", *(rng.choice(nouns) for _ in range(n // 2)), "of the", verbs, *(rng.choice(nouns) for _ in range(n // 2))]) + "." for _ in range(8))


def data(n, seed):
    rng = random.Random(seed)
    bands = [BANDS[i % 4] for i in range(n)]
    return [text(b, rng) for b in bands], bands


def test_held_out_accuracy():
    model = ReadingModel(*data(80, 1))
    texts, bands = data(120, 2)
    p = model.probabilities(texts)
    assert sum(BANDS[k] == b for k, b in zip(p.argmax(axis=1), bands, strict=True)) >= 114


def test_levels(spark):
    texts, bands = data(80, 3)
    rows = [*enumerate(texts), (200, None), (201, ""), (202, "One two. " * 20_000), (203, texts[1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as band")
    labels = [(i, f"r{k}", b) for i, b in enumerate(bands) for k in range(1 + i % 2)] + [(0, "r9", None), (1, "r9", "primary"), (1, "r9", "primary"), (201, "r1", "odd")]
    df = reading_levels(docs, "doc_id", "text", spark.createDataFrame(labels, "doc_id long, rater string, band string"))
    got = {r.id: r for r in df.collect()}
    assert len(got) == len(rows)
    assert got[200].kind is None and got[201].kind is None
    assert got[203].band == got[1].band == "secondary"
    assert sum(got[i].band == b for i, b in enumerate(bands)) >= 76
    assert {r.id for r in english_prose(df).collect()} <= set(range(80)) | {202, 203}


def test_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "The cat sees the hat. It is red.")], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, rater string, band string")
    assert reading_levels(docs, "doc_id", "text", labels).count() == 1
    assert reading_levels(docs.where("false"), "doc_id", "text", labels).count() == 0
