import pytest
from pyspark.sql import functions as F

from lamplight.functions import text as T


def one(spark, value, expression, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expression.alias("y")).first().y


@pytest.mark.parametrize(("value", "want"), [("  a \u00a0\u3000 b\t\nc ", "a b c"), ("", ""), (None, None), ("\u2028", "")])
def test_collapse_takes_every_unicode_space(spark, value, want):
    assert one(spark, value, T.collapse(F.col("x"))) == want


def test_strip_keeps_inner_space(spark):
    assert one(spark, "\u00a0 a  b\t", T.strip(F.col("x"))) == "a  b"


@pytest.mark.parametrize(("path", "name", "stem", "suffix"), [("a/b.c/d.tar.PDF", "d.tar.PDF", "d.tar", ".pdf"), (r"c:\x\y.md", "y.md", "y", ".md"), ("plain", "plain", "plain", ""), (".hidden", ".hidden", ".hidden", "")])
def test_paths(spark, path, name, stem, suffix):
    assert one(spark, path, T.file_name(F.col("x"))) == name
    assert one(spark, path, T.stem(F.col("x"))) == stem
    assert one(spark, path, T.suffix(F.col("x"))) == suffix


@pytest.mark.parametrize(("value", "want"), [(' "None" ', None), ("N/A", None), ("null", None), ("", None), (None, None), (' "Rice" ', "Rice"), (" 'Rice' ", "'Rice'"), ("'None'", "'None'"), ('" none "', None), ("none of it", "none of it")])
def test_clean_null(spark, value, want):
    assert one(spark, value, T.clean_null(F.col("x"))) == want


def test_year_is_not_validated(spark):
    assert one(spark, "19x4-05", T.year(F.col("x"))) == "19x4"


@pytest.mark.parametrize(("raw", "want"), [('```json\n{"a": {"b": 1}}\n```', '{"a": {"b": 1}}'), ('Sure: {"a": 1} done', '{"a": 1}'), ("no object", None)])
def test_json_body(spark, raw, want):
    assert one(spark, raw, T.json_body(F.col("x"))) == want


def test_restricted_needs_word_bounds(spark):
    assert one(spark, "strictly CONFIDENTIAL.", T.is_restricted(F.col("x")))
    assert not one(spark, "x_confidential_y", T.is_restricted(F.col("x")))
    assert one(spark, None, T.is_restricted(F.col("x"))) is False


@pytest.mark.parametrize(("value", "want"), [("under embargo until May", True), ("EMBARGOED", True), ("For official  use only", True), ("not\u00a0 for\ndistribution", True), ("Not for public viewing", True), ("do not distribute", True), ("RESTRICTED", True), ("proprietary", False), ("do not copy", False), ("unrestricted", False)])
def test_restricted_phrases(spark, value, want):
    assert one(spark, value, T.is_restricted(F.col("x"))) is want


@pytest.mark.parametrize(("value", "want"), [("Books", "Books"), ("Thesis/Dissertations", "Thesis/Dissertations"), ("Technical Reports", "Technical Reports"), ("Investigatory Projects", "Investigatory Projects"), ("Vertical Files", "Vertical Files"), ("Non-Prints", "Non-Prints"), ("Serials", "Serials"), ("Maps", "Books"), (None, "Books")])
def test_types(spark, value, want):
    assert one(spark, value, T.known_type(F.col("x"))) == want


def test_y_is_no_vowel(spark):
    assert one(spark, "rhythm rice myth", T.garble(F.col("x"))["vowelless"]) == 2


def test_let_computes_once(spark):
    assert one(spark, " ab ", T.let(T.strip(F.col("x")), lambda t: F.concat(t, t))) == "abab"


def test_garble_bounds(spark):
    keep = T.garble(F.col("x"))["keep"]
    bad, good = "xkcd", "rice"
    assert one(spark, " ".join([bad] * 11), keep)  # fewer than twelve tokens
    assert one(spark, " ".join([bad] * 9 + [good] * 11), keep)  # 9 of 20 is 0.45, not more
    assert not one(spark, " ".join([bad] * 10 + [good] * 10), keep)


def test_abstains(spark):
    df = spark.createDataFrame([("yes", ["p"]), ("", ["p"]), ("so NOT FOUND it is", ["p"]), ("yes", []), (None, None)], "a string, p array<string>")
    got = [r.y for r in df.select(T.abstains(F.col("a"), "NOT FOUND", F.col("p")).alias("y")).collect()]
    assert got == [False, True, True, True, True]


def test_clamp():
    assert T.clamp(None, 1, 10, 5) == 5
    assert T.clamp(50, 1, 10, 5) == 10
    assert T.clamp(0, 1, 10, 5) == T.clamp(-3, 1, 10, 5) == 1


def test_like_literal():
    assert T.like_literal("ocr_out%") == r"ocr\_out\%"
