"""Text expressions: one home for every pattern. All are column expressions, none a UDF."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Every Unicode white space character; Java's \s and Spark's trim know only ASCII ones.
SPACE = r"[\s\x0b\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
SPACES = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())
#: Words that stand for a missing value, lower case.
NULL_WORDS = ["none", "null", "n/a", "na", "unknown", "not stated", "not specified"]
#: Record types that are kept as they are.
TYPES = ["Books", "Serials", "Thesis/Dissertations", "Technical Reports", "Investigatory Projects", "Vertical Files", "Non-Prints"]
#: Phrase families that mark restricted material; an underscore stands for a run of white space.
_RESTRICTED = r"\b(restricted|confidential|not_for_(public|circulation|distribution)|internal_use_only|for_official_use_only|embargo(ed)?|do_not_distribute)\b"
RESTRICTED = "(?i)" + _RESTRICTED.replace("_", f"{SPACE}+")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once a row, however often the body, or a lambda in it, refers to it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(c: Column) -> Column:
    """c without white space at its ends."""
    return F.btrim(c, F.lit(SPACES))


def collapse(c: Column) -> Column:
    """c stripped, each run of white space as one blank."""
    return F.trim(F.regexp_replace(c, f"{SPACE}+", " "))


def snippet(c: Column, n: int) -> Column:
    """The first n code points."""
    return F.substring(c, 1, n)


def file_name(path: Column) -> Column:
    """The last component of a path with either kind of slash."""
    return F.regexp_extract(path, r"([^/\\]*)$", 1)


def stem(path: Column) -> Column:
    """The last component without its suffix; a leading dot is no suffix."""
    return F.regexp_replace(file_name(path), r"(?<=.)\.[^.]*$", "")


def suffix(path: Column) -> Column:
    """The lower-case suffix with its dot, or an empty string."""
    return F.lower(F.regexp_extract(file_name(path), r"(?<=.)(\.[^.]*)$", 1))


def chunk_id(stem_: Column, page: Column, index: Column) -> Column:
    return F.concat(stem_, F.lit("__p"), page.cast("string"), F.lit("__c"), index.cast("string"))


def catalog_chunk_id(catalog_id: Column, index: Column) -> Column:
    return F.concat(F.lit("cat-"), catalog_id.cast("string"), F.lit("-"), index.cast("string"))


def prototype_id(path: Column, index: Column) -> Column:
    """The hex MD5 of path::index."""
    return F.md5(F.concat(path, F.lit("::"), index.cast("string")))


def clean_null(c: Column) -> Column:
    """c as a string without white space and enclosing double quotes; null if nothing or a null word is left."""
    bare = strip(F.btrim(strip(c.cast("string")), F.lit('"')))
    return F.when((bare == "") | F.lower(bare).isin(NULL_WORDS), None).otherwise(bare)


def year(c: Column) -> Column:
    """The first four characters of the cleaned value; not checked for digits."""
    return F.substring(clean_null(c), 1, 4)


def known_type(c: Column, default: str = "Books") -> Column:
    value = clean_null(c)
    return F.when(value.isin(TYPES), value).otherwise(default)


def json_body(c: Column) -> Column:
    """The outermost {...} of a text that may be fenced or wrapped in prose; null if there is none."""
    found = F.regexp_extract(c, r"(?s)\{.*\}", 0)
    return F.when(found != "", found)


def is_restricted(*columns: Column) -> Column:
    return reduce(lambda a, b: a | b, (F.coalesce(c.rlike(RESTRICTED), F.lit(False)) for c in columns))


def alphabetic_tokens(c: Column) -> Column:
    """Runs of three or more ASCII letters, lower case."""
    return F.regexp_extract_all(F.lower(c), F.lit("[a-z]{3,}"), F.lit(0))


def garble(c: Column, least: int = 12, share: float = 0.45) -> dict[str, Column]:
    """tokens, vowelless and keep of the unreadable-text filter: fewer than `least` tokens are kept, more if at most `share` lack a vowel (a, e, i, o, u)."""
    tokens = alphabetic_tokens(c)
    n = F.size(tokens)
    bad = F.size(F.filter(tokens, lambda t: ~t.rlike("[aeiou]")))
    return {"tokens": n, "vowelless": bad, "keep": (n < least) | (bad <= share * n)}


def has_text(c: Column, least: int = 50) -> Column:
    return F.length(strip(c)) >= least


def contains_any(c: Column, fragments: Column) -> Column:
    """Whether any fragment occurs in c, whatever the case; false for null or empty fragments."""
    return F.coalesce(F.exists(fragments, lambda f: F.contains(F.lower(c), F.lower(f))), F.lit(False))


def abstains(answer: Column, sentinel: str, passages: Column) -> Column:
    """Whether an answer abstains: blank, holds the sentinel, or had no passages."""
    text = F.coalesce(strip(answer), F.lit(""))
    return (text == "") | F.contains(text, F.lit(sentinel)) | (F.coalesce(F.size(passages), F.lit(0)) <= 0)


def labelled_blob(parts: dict[str, Column]) -> Column:
    """Lines "Label: value", without those whose value is null or empty."""
    return F.concat_ws("\n", *(F.when(c.isNotNull() & (c != ""), F.concat(F.lit(f"{label}: "), c)) for label, c in parts.items()))


def clamp(value: int | None, low: int, high: int, default: int) -> int:
    """A driver-side parameter brought within its bounds; None means the default."""
    return default if value is None else max(low, min(value, high))


def like_literal(text: str) -> str:
    """text for use inside a LIKE pattern with backslash as escape."""
    return text.replace("\\", "\\\\").replace("%", r"\%").replace("_", r"\_")
