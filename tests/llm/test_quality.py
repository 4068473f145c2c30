import random

import numpy as np

from lamplight.llm.quality import profile, text_kinds, text_statistics
from lamplight.llm.text_stats import COMMON, statistics


NOUNS = "rice soil duck okra yam taro corn bean leaf root harvest yields table contents farmer river season market water field winter village garden pepper coffee cattle bridge school weather knowledge".split()
VERBS = "grows carries brings watches follows changes describes improves protects explains measures delays".split()


def prose(i):
    rng = random.Random(i)
    n, v = (lambda: rng.choice(NOUNS)), (lambda: rng.choice(VERBS))
    return " ".join(f"The {n()} of the {n()} {v()} what {n()} and {n()} had been in the {n()}, because it {v()} {rng.randint(2, 900)} of their {n()}." for _ in range(8))


LIST = "Contents\n" + "\n".join(f"- {w} harvest" for w in "rice soil duck okra yam taro corn bean leaf root".split())
TABLE = "Table 1. Yields\n" + "\n".join(f"{w} | {i * 7} | {i * 13.5} | {i}" for i, w in enumerate("rice soil duck okra yam taro corn bean".split()))
JUNK = "xkq zvbn qwrtp lkjhg mnbvc zxcv qqwrt plkm nbgtr vfdsx cxzq wsxz " * 3
FORM = "\n".join(f"{w}: ______________________" for w in ("Name", "Date", "Place", "Crop"))


def test_kinds(spark):
    rows = [(i, prose(i)) for i in range(60)] + [(100, LIST), (101, TABLE), (102, JUNK), (103, FORM), (104, None), (105, ""), (106, " \n "), (107, "%^&*{}<>~|\\=+#@ " * 9)]
    df = spark.createDataFrame(rows, "id int, text string").selectExpr("*", "1 as words", "'x' as kind")
    got = {r.id: r.kind for r in text_kinds(df, "id", "text").collect()}
    assert {got[i] for i in range(60)} == {"prose"}
    assert {i: got.get(i) for i in range(100, 108)} == {100: "list", 101: "table", 102: "junk", 103: "junk", 104: None, 105: None, 106: None, 107: "junk"}
    assert text_kinds(df.where("false"), "id", "text").count() == 0


def test_statistics_by_hand():
    s = statistics(["The rice, the soil.\nNo end", None, "12 345"], np.zeros(1024))
    assert s["words"].tolist() == [6, 0, 2]
    assert s["common_ratio"].tolist() == [3 / 6, 0, 0]
    assert s["line_end_ratio"].tolist() == [0.5, 0, 0]
    assert s["digit_ratio"].tolist() == [0, 0, 1]
    assert round(s["mean_word_length"][0], 4) == round((3 + 4 + 3 + 4 + 2 + 3) / 6, 4)
    assert "the" in COMMON["en"]


def test_profile_by_language(spark):
    rows = [(i, prose(i)) for i in range(20)] + [(50 + i, "El precio de la cosecha fue mayor que en los otros años y los socios de la zona lo vendieron con su ayuda.") for i in range(20)] + [(99, None)]
    p = {r.lang: r for r in profile(text_statistics(spark.createDataFrame(rows, "id int, text string"), "id", "text")).collect()}
    assert set(p) == {"en", "es", "any"}
    assert p["any"].documents == 40 and p["en"].documents == 20 and p["en"].words_median > 40


def test_unreadable_text_makes_no_language_of_its_own(spark):
    """Letters at random hold a French or Spanish word now and then; such texts must not be each other's measure."""
    rng = random.Random(4)
    noise = [" ".join("".join(rng.choice("aelnsudt01|!") for _ in range(rng.randint(1, 4))) for _ in range(90)) for _ in range(12)]
    rows = [(i, prose(i)) for i in range(60)] + [(100 + i, t) for i, t in enumerate(noise)] + [(200, "Ã©â€™°n tÂ€ " * 20)]
    got = text_kinds(spark.createDataFrame(rows, "id int, text string"), "id", "text").collect()
    assert {r.kind for r in got if r.id < 100} == {"prose"}
    assert {r.z_common_ratio < -3.5 for r in got if 100 <= r.id < 200} == {True}
    assert {r.kind for r in got if r.id >= 100} == {"junk"}
