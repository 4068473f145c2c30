"""Several values packed in one cell: delimiter skeletons, one splitting rule a skeleton, positional extraction.

A cell is cut into units (words, initials, numbers, runs of white space, single other characters), each masked by one letter for its
shape; delimiters stay. Runs of units that no rule ever cuts (the words of a term, a person's names, whatever stands between two separators or
two quotes) are masked by one letter again, so a skeleton tells delimiters and not words, and there are far fewer skeletons than cells.
Cells of equal skeleton split alike: the rules are resolved once for each distinct skeleton, as ranges of runs, and joined back; the
values are cut out by position.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamplight.session import broadcast_if_small, materialize

#: Cells that mean "no value", lower case.
PLACEHOLDERS = ["", "none", "n/a", "na", "null", "not stated", "unknown", "[]", "-"]
#: Nouns that mark a body; those that can open its name come first.
OPENING = "Association Bureau Center Centre College Commission Committee Department Faculty Federation Foundation Friends Institute Laboratory Ministry Museum National Office School Society Union University".split()
CLOSING = "Agency Authority Bank Board Club Company Cooperative Corporation Council Division Group Library Network Press Program Project Reserve Service Station Studies".split()

_WORD = r"\p{L}[\p{L}\p{M}\p{N}]*(?:['\u2019-][\p{L}\p{M}\p{N}]+)*"
UNITS = rf"(?s)\bJr\b\.?|\bSr\b\.?|\b\p{{Lu}}\.|{_WORD}|\p{{N}}+(?:[.,]\p{{N}}+)*|(?U:\s+)|."


def _shape(u: Column) -> Column:
    one_of = lambda words: u.isin(*words)
    return (
        F.when(u.rlike(r"^[JS]r\.?$"), "J")
        .when(u.rlike(r"^\p{Lu}\.$"), "I")
        .when(one_of(OPENING), "H")
        .when(one_of(CLOSING), "B")
        .when(one_of(["and", "y", "et"]), "d")
        .when(one_of(["of", "the", "for", "de", "del", "des"]), "o")
        .when(u.rlike(r"^\p{Lu}"), "N")
        .when(u.rlike(r"^\p{L}"), "w")
        .when(u.rlike(r"^\p{N}"), "9")
        .when(u.rlike(r"[\r\n]"), "n")
        .when(u.rlike("\t"), "t")
        .when(u.rlike(r"^(?U:\s)"), "_")
        .when(u.rlike("^[\u201c\u201d\"]$"), '"')
        .when(u.rlike("^[\uff1b;]$"), ";")
        .otherwise(u)
    )


_STRONG = ";|nt\u00b7\u2022"
# P stands for a person given name first, N also for a name with initials.
_PERSON = re.compile(r"^(?:P|N(?:_?I)*(?:_N)+)(?:_J)?$")
_SURNAME_FIRST = re.compile(r"^(?:P|N(?:_N)?),_?(?:P|N(?:_?[NI])*)(?:,?_?J)?$")
_NUMBERED = re.compile(r"(?:^|(?<=[_nt;|,]))(?:9[.)]|\(9\))(?=[_nt]|[NwHBo])")


# Runs, as patterns over shapes. A number followed by a point or bracket may number an item and is in none.
_ANY = "[NIHBodwJ]"
_FIGURE = r"9(?![.)])"
_TERM = rf"{_ANY}(?:(?:_-+_|_|/)(?:{_ANY}|{_FIGURE}))*"
_NAMED = r"(?<![NIHBodwJ9]_)N(?:_?I)*(?:_N)+(?!_[NIHBodw9])|N(?:_?I)+(?!_N)"
_BETWEEN = rf"[NIHBodw](?:[_,&.'-]*(?:{_ANY}|{_FIGURE}))*"
_INSIDE = rf"(?<=\")[NIHBodw](?:[_,&.'/-]*(?:{_ANY}|{_FIGURE}))*(?=\")"
_SEPARATED = r"[;|nt\u00b7\u2022]|^[_nt\[]*(?:9[.)]|\(9\))"


_DELIMITER = r"_*[;|nt\u00b7\u2022]_*|_*,_*(?![d&]_)"  # with the blanks beside it


def _runs(shapes: Column, kind: Column) -> Column:
    """The runs of a cell's shapes, delimiters among them, in order."""
    apart = F.regexp_replace(shapes, '"[^"]*"', "").rlike(_SEPARATED)  # a separator within quotes separates nothing
    slashes = F.contains(shapes, F.lit("/"))
    between = _BETWEEN.replace("[_,&.'-]", "(?:_-+_|[_,&.'-]|(?<!_)/(?!_))")
    pattern = (
        F.when((kind == "terms") & (apart | (~F.contains(shapes, F.lit('"')) & shapes.rlike("_/|/_"))), F.lit(between))
        .when(kind == "terms", F.lit(_TERM))
        .when(apart & ~slashes, F.lit(_BETWEEN))
        .otherwise(F.lit(_NAMED))
    )
    return F.regexp_extract_all(shapes, F.concat(F.lit(f"{_INSIDE}|{_DELIMITER}|"), pattern, F.lit("|(?s).")), F.lit(0))


def _masked(run: Column, kind: Column) -> Column:
    """One letter for a run: itself if it's one unit, a delimiter's own, P for a person given name first, else N, or w in terms."""
    delimiter = F.regexp_extract(run, "^_*([^_])_*$", 1)
    return F.when(F.length(run) == 1, run).when(delimiter != "", delimiter).when(kind == "terms", "w").when(run.rlike(r"^N(?:_?I)*(?:_N)+$"), "P").otherwise("N")


def _trim(k: str, s: int, e: int) -> tuple[int, int]:
    """The range without blanks, bullets, item numbers and enclosing brackets or quotes at its ends."""
    while True:
        before = s, e
        while s < e and k[s] in "_nt\u2022\u00b7":
            s += 1
        while s < e and k[e - 1] in "_nt,":
            e -= 1
        if s + 1 < e and k[s] in "-*\u2013" and k[s + 1] in "_nt":
            s += 1
        m = _NUMBERED.match(k[s:e])
        if m and m.end() < e - s:
            s += m.end()
        if e - s >= 2 and (k[s], k[e - 1]) in {('"', '"'), ("[", "]"), ("'", "'")} and not (k[s] == '"' and k[s + 1] == '"' and e - s > 2):
            s, e = s + 1, e - 1
        if (s, e) == before:
            return s, e


def _quoted(k: str) -> list[tuple[int, int]]:
    """Ranges (quotes included) of quoted values: from a quote where a value can begin to the next single one where it can end."""
    out, i = [], 0
    while i < len(k):
        if k[i] == '"' and re.search(r"(?:^|[;|,nt\u00b7\u2022/\[]|[.)]_)_*$", k[:i]):
            j = i + 1
            while j < len(k):
                if k[j] == "\\" and j + 1 < len(k):
                    j += 2
                    continue
                if k[j] == '"':
                    if j + 1 < len(k) and k[j + 1] == '"' and j > i + 1:
                        j += 2
                        continue
                    if re.match(r"_*(?:$|[;|,nt\u00b7\u2022/\]])", k[j + 1 :]):
                        break
                j += 1
            if j < len(k):
                out.append((i, j + 1))
                i = j + 1
                continue
        i += 1
    return out


def _names_by_comma(k: str, s: int, e: int) -> list[tuple[int, int]]:
    """Names in one range that has no other delimiter: by comma and "and" if the parts are whole names, else the range itself."""
    cuts, at = [], s
    for m in re.finditer(r",|(?<=_)[d&](?=_)", k[s:e]):
        cuts.append((at, s + m.start()))
        at = s + m.end()
    cuts.append((at, e))
    parts = [p for p in (_trim(k, *c) for c in cuts) if p[0] < p[1]]
    if len(parts) < 2:
        return [(s, e)]
    text = [k[a:b] for a, b in parts]
    if _PERSON.match(text[0]) and sum(bool(_PERSON.match(t)) for t in text) >= 2 or (_PERSON.match(text[0]) and re.search(r"[HB]", text[1])):
        out: list[tuple[int, int]] = []
        for (a, b), t in zip(parts, text, strict=True):
            starts = _PERSON.match(t) or (re.search(r"[HB]", t) and re.search(r"_", t) and not (out and re.search(r"H", k[out[-1][0] : out[-1][1]]) and not re.match(r"^H|^N_[HB]", t)))
            if out and not starts:
                out[-1] = (out[-1][0], b)
            else:
                out.append((a, b))
        return out
    halves = re.split(r"_[d&]_", k[s:e])
    if len(halves) > 1 and all(_SURNAME_FIRST.match(h.strip("_,")) for h in halves):
        out, at = [], s
        for h in halves:
            out.append((at, at + len(h)))
            at += len(h) + 3
        return out
    if len(parts) >= 4 and not re.search("[HBow]", k[s:e]):
        pairs = [p for p, t in zip(parts, text, strict=True) if t != "J"]
        if len(pairs) % 2 == 0 and all(re.match(r"^(?:P|N(?:_[NI])*)$", k[a:b]) for a, b in pairs) and all(k[a:b] == "N" for a, b in pairs[0::2]):
            starts = [p[0] for p in pairs[0::2]]
            return [(a, b) for a, b in zip(starts, [*starts[1:], e], strict=True)]
    return [(s, e)]


def _slashes(k: str, s: int, e: int, protect: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Cuts of a range of names at slashes; "N N/N B" (as in Seed/Fertilizer Board) is one body."""
    cuts, at = [], s
    for i in range(s, e):
        if k[i] != "/" or any(a <= i < b for a, b in protect):
            continue
        spaced = k[i - 1 : i] == "_" or k[i + 1 : i + 2] == "_"
        left, right = k[at:i].strip("_"), re.split(r"/", k[i + 1 : e])[0].strip("_")
        if not spaced and re.match(r"^(?:N_)?N_N$|^N$|^P$", left) and re.match(r"^N_[BH]$", right):
            continue
        cuts.append((at, i))
        at = i + 1
    return [*cuts, (at, e)]


def resolve(k: str, kind: str) -> list[tuple[int, int]]:
    """The unit ranges of the values of a cell with skeleton k; kind is 'names' or 'terms'."""
    s, e = 0, len(k)
    while s < e and k[s] in "_nt":
        s += 1
    while s < e and k[e - 1] in "_nt":
        e -= 1
    if s < e and k[s] == "[" and k[e - 1] == "]":
        s, e = s + 1, e - 1
    shift, k = s, k[s:e]
    quoted = _quoted(k)
    inside = [any(a <= i < b for a, b in quoted) for i in range(len(k))]
    numbers = [m.start() for m in _NUMBERED.finditer(k) if not inside[m.start()]]
    numbered = bool(numbers) and not k[: numbers[0]].strip("_nt")
    spaced_slash = lambda i: k[i] == "/" and (k[i - 1 : i] == "_" or k[i + 1 : i + 2] == "_")
    strong = [i for i in range(len(k)) if not inside[i] and (k[i] in _STRONG or (kind == "terms" and spaced_slash(i)))]
    bounds, at = [], 0
    for i in sorted({*strong, *(numbers if numbered else [])}):
        bounds.append((at, i))
        at = i if numbered and i in numbers else i + 1
    bounds.append((at, len(k)))
    separated = bool(strong) or (numbered and len(numbers) > 1)
    out: list[tuple[int, int]] = []
    for a, b in bounds:
        own = [q for q in quoted if a <= q[0] and q[1] <= b]
        if kind == "names":
            pieces = _slashes(k, a, b, quoted)
            by_comma = not separated and len(pieces) == 1
        else:
            pieces, by_comma = [(a, b)], not separated and not numbered
        if own and not separated:
            by_comma = True
        for c, d in pieces:
            if not by_comma:
                out.append((c, d))
            elif own or kind == "terms":
                at = c
                for i in range(c, d):
                    if k[i] == "," and not inside[i]:
                        out.append((at, i))
                        at = i + 1
                out.append((at, d))
            else:
                out.extend(_names_by_comma(k, *_trim(k, c, d)))
    return [(shift + a, shift + b) for a, b in (_trim(k, *r) for r in out) if a < b]


def _resolve_all(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for df in it:
        spans = [[{"s": a, "n": b - a} for a, b in resolve(k, kind)] for k, kind in zip(df["skeleton"], df["kind"], strict=True)]
        yield pd.DataFrame({"kind": df["kind"], "skeleton": df["skeleton"], "spans": spans})


def split_packed(df: DataFrame, id_col: str, fields: dict[str, str], name: str = "packed") -> DataFrame:
    """(id, field, pos, item): one row a value of each cell of the columns in `fields` (column -> 'names' or 'terms'), pos from 1.

    Null, blank and placeholder cells have no rows, empty values take no position. Items lose enclosing quotes, brackets, bullets and
    item numbers; doubled quotes become single ones and runs of white space one blank. Repeated rows give their items each;
    an empty table gives none. Rules are broadcast while their size allows it, else joined by shuffle.
    """
    # Extra columns never matter, as only these are read.
    cells = df.select(F.col(id_col).alias("id"), F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.lit(k).alias("kind"), F.col(f).cast("string").alias("cell")) for f, k in fields.items()))).alias("c")).select("id", "c.*")
    tidy = F.lower(F.regexp_replace(F.regexp_replace("cell", r"(?U)\s+", " "), r"""^[ "'\[]+|[ "'\]]+$""", ""))
    cells = cells.where(F.col("cell").isNotNull() & ~tidy.isin(PLACEHOLDERS))
    cells = cells.withColumn("units", F.regexp_extract_all("cell", F.lit(UNITS), F.lit(0)))
    shapes = F.array_join(F.transform("units", _shape), "")
    cells = cells.withColumn("runs", _runs(shapes, F.col("kind")))
    cells = cells.withColumn("skeleton", F.array_join(F.transform("runs", lambda r: _masked(r, F.col("kind"))), "")).withColumn("sizes", F.transform("runs", F.length)).drop("runs")
    rules = materialize(cells.select("kind", "skeleton").distinct().mapInPandas(_resolve_all, "kind string, skeleton string, spans array<struct<s: int, n: int>>"), f"{name}-rules")
    total = lambda start, n: F.aggregate(F.slice("sizes", start, n), F.lit(0), lambda a, x: a + x)
    parts = cells.join(broadcast_if_small(rules), ["kind", "skeleton"]).select("id", "field", "units", "sizes", F.posexplode("spans").alias("at", "run"))
    parts = parts.select("id", "field", "units", "at", F.struct(total(F.lit(1), F.col("run.s")).alias("s"), total(F.col("run.s") + 1, F.col("run.n")).alias("n")).alias("span"))
    text = F.array_join(F.slice("units", F.col("span.s") + 1, F.col("span.n")), "")
    item = F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(text, r'\\"', '"'), '""', '"'), r"(?U)\s+", " "))
    return parts.select("id", "field", (F.col("at") + 1).cast("int").alias("pos"), item.alias("item"))
