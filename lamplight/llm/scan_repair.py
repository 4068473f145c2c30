"""Repair of text from scanned pages: page lines, words cut at line ends, and misread characters.

Three passes over whole texts. The first counts the corpus' words and function-word bigrams and lists the short lines that may be running
headers, footers or page numbers. Evidence for each candidate line is then gathered by stem and by wording. The last pass drops
the page lines, rejoins cut words and decodes every line as a noisy channel: candidate words come from character confusions, whose
probabilities are estimated on the corpus, and a Viterbi search weighs them with the n-gram likelihood of the line.
"""

from __future__ import annotations

import atexit
import logging
import math
import re
import shutil
import sqlite3
import tempfile
import uuid
from collections.abc import Collection, Iterator
from functools import lru_cache, partial
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamplight.llm.lsh import key_filter, may_be_in
from lamplight.llm.text_stats import COMMON
from lamplight.llm.words import batches
from lamplight.session import materialize

#: What a recogniser may print for what stands on the page.
CONFUSIONS = [
    *[("0", "o"), ("1", "l"), ("1", "i"), ("3", "e"), ("5", "s"), ("6", "b"), ("8", "b"), ("9", "g"), ("@", "a"), ("$", "s"), ("|", "l"), ("|", "i"), ("!", "l"), ("!", "i")],
    *[("c", "e"), ("e", "c"), ("l", "i"), ("i", "l"), ("f", "t"), ("t", "f"), ("l", "t"), ("b", "h"), ("h", "b"), ("o", "a"), ("a", "o"), ("u", "n"), ("n", "u"), ("v", "y"), ("y", "v"), ("q", "g"), ("g", "q"), ("j", "i")],
    *[("rn", "m"), ("m", "rn"), ("ri", "n"), ("n", "ri"), ("ii", "u"), ("u", "ii"), ("cl", "d"), ("d", "cl"), ("li", "h"), ("h", "li"), ("vv", "w"), ("w", "vv"), ("in", "m"), ("nn", "m"), ("ln", "h"), ("tl", "d"), ("lc", "k"), ("ti", "h")],
]
#: Section headings, letters only.
HEADINGS = set(
    "abstract acknowledgement acknowledgements acknowledgment acknowledgments appendix appendices background bibliography conclusion conclusions contents discussion foreword glossary introduction limitations limitationsofthestudy listoffigures listoftables literaturecited materialsandmethods methodology methods objectives preface recommendation recommendations references results resultsanddiscussion reviewofliterature scopeandlimitations significanceofthestudy statementoftheproblem summary summaryandconclusions tableofcontents theoreticalframework itemsneeded".split()
)
_log = logging.getLogger(__name__)
#: Words of the channel's vocabulary that are held in memory: the most frequent ones, at most so many; and twice as many bigrams. The rest are kept in a file.
VOCABULARY = 200_000
#: Counts of words and bigrams that a task of the survey holds before it gives them out.
PARTIAL_COUNTS = 1_000_000
_FUNCTION = {w for lang in COMMON.values() for w in lang}
_TITLE_WORDS = {"in", "of", "and", "no", "the", "for", "on"}
_CHARS = r"A-Za-z0-9@|$À-ɏ"
_TOKEN = re.compile(rf"[{_CHARS}]+(?:['’!-][{_CHARS}]+)*")
_PART = re.compile(rf"[{_CHARS}'’!-]")
_CUT = re.compile("[-‐‑¬\u00ad][ \u00a0]*(?:\r\n|\r|\n)\\s*")
_TAIL = re.compile(rf"[{_CHARS}]+(?:['’!-][{_CHARS}]+)*$")
_BREAK = re.compile(rf"([{_CHARS}]+(?:['’!-][{_CHARS}]+)*)[-‐‑¬­][  ]*$")
_MARKER = re.compile(r"^\s*\{\d+\}-{20,}\s*$")
_LINES = re.compile(r"\r\n|\r|\n")
_NUMBER = r"(?:\d{1,4}|[ivxlc]{1,7})"
_PAGE = re.compile(rf"^[\W_]*(?:(?:page|pages|pp|pg|p)\.?\s*)?{_NUMBER}(?:\s*(?:of|/)\s*\d{{1,4}})?[\W_]*$", re.I)
_SIGNED = re.compile(r"page|p\.|pp|[\[\](){}—–-]", re.I)
_LEAD = re.compile(rf"^[\W_]*(?:(?:page|p)\.?\s*)?{_NUMBER}(?:\s*of\s*\d+)?[\W_]*?\s{{2,}}(?=[|*_~]?\s?\S*[^\W\d])", re.I)
_TRAIL = re.compile(rf"(?<=\S)\s{{2,}}[\W_]*(?:(?:page|p)\.?\s*)?{_NUMBER}(?:\s*of\s*\d+)?[\W_]*$", re.I)
_CELLS = re.compile(r"\S(?:\t|\s{2,}|\s*\|\s*|;(?=\S))(?=\S)")
_LISTED = re.compile(r"^(?:[-•*·]\s|\(?\w{1,3}[.)]\s|#|\*\*|table\b|figure\b|fig\.)", re.I)


def _letters(s: str) -> str:
    return re.sub(r"[^a-z]", "", s.lower().replace("0", "o").replace("1", "l"))


def candidate_lines(lines: list[str]) -> list[tuple[int, str, int, int, int]]:
    """(line, key, form, interrupts, beside): lines that may be page lines.

    form is 0 for a bare page number, 1 for one set off by signs or a word, 2 for a title with a page number, 3 for a title. key is the title's
    letters. interrupts says that the line is short and stands inside a sentence, beside is 1 next to a page
    number or at a page's edge, and 2 for a short line next to a page number.
    """
    forms: dict[int, tuple[str, int]] = {}
    solid = [i for i, line in enumerate(lines) if line.strip()]
    markers = {i for i in solid if _MARKER.match(lines[i])}
    for i in solid:
        s = lines[i].strip()
        if len(s) > 90 or i in markers or "..." in s or "__" in s:
            continue
        if _PAGE.match(s):
            forms[i] = ("", 1 if _SIGNED.search(s) else 0)
            continue
        if len(s) > 12 and "  " not in s and (s[0].islower() or (s[-1] in ".;," and s[0].isalpha())):
            continue  # no title: soon done with
        title = _TRAIL.sub("", _LEAD.sub("", s))
        form = 2 if title != s else 3
        bare = title.strip("|*_~= \t")
        if not bare or len(bare.split()) > 10 or _CELLS.search(bare) or _LISTED.match(title) or sum(c.isalpha() for c in bare) < 5:
            continue
        if not (bare[0].isupper() or title[0] in "|*_~") or re.search(r"[.!?] [A-Z]", re.sub(r"\bN[o0]\. ", "", bare)):
            continue
        if form == 3 and (bare[-1] in ".!?;,:-‐‑¬­" or any(w in _FUNCTION and w not in _TITLE_WORDS for w in bare.lower().split())):
            continue
        key = _letters(bare)
        if key in HEADINGS:
            continue
        forms[i] = (key, form)
    if not forms:
        return []
    near = lambda i, step: next((j for j in (solid if step > 0 else reversed(solid)) if (j - i) * step > 0 and forms.get(j, ("", 9))[1] > 2), None)
    place = {i: n for n, i in enumerate(solid)}
    widths = sorted(len(lines[i].rstrip()) for i in solid if i not in forms and i not in markers)
    width = widths[-1 - len(widths) // 20] if widths else 0
    out = []
    for i, (key, form) in forms.items():
        before, after = near(i, -1), near(i, 1)
        above, below = (lines[before].rstrip() if before is not None and before not in markers else ""), (lines[after].strip() if after is not None and after not in markers else "")
        open_above = not above or above[-1] not in ".!?:\"”"
        runs_on = bool(below) and (below[0].islower() or below[0].isdigit()) or bool(above and _BREAK.search(above))
        short = len(lines[i].strip()) < 0.8 * max(len(above), len(below.split("\n")[0]), 1)
        n = place[i]
        around = [solid[m] for m in (n - 1, n + 1) if 0 <= m < len(solid)]
        edge = len(around) < 2 or any(a in markers for a in around)
        by_number = any(forms.get(a, ("", 9))[1] < 2 for a in around)
        # Directly above or below, without a blank line: a row of cells, or figures like a bare number itself.
        tight = [a for a in around if abs(a - i) == 1 and a not in markers and forms.get(a, ("", 9))[1] > 2]
        cells = any(_CELLS.search(lines[a].strip()) and (a not in forms) for a in tight)
        if (cells and form != 1) or (form == 0 and any(not any(c.isalpha() for c in lines[a]) for a in tight)):
            continue
        if form == 0 and any(forms.get(a, ("", 9))[1] == 0 and abs(a - i) == 1 for a in around):
            continue
        out.append((i, key, form, int(short and open_above and runs_on and bool(below)), 2 if by_number and len(lines[i].strip()) < 0.75 * width else int(edge or by_number)))
    if sum(1 for x in out if x[2] == 2) > 4 and len(out) > len(solid) / 3:
        return [x for x in out if x[2] == 1]  # a table of contents: its titles and numbers are entries
    return out


def _cuts(text: str) -> Iterator[tuple[int, str, int, str]]:
    """(begin, left part, end, right part) of each word that a line break cuts."""
    for m in _CUT.finditer(text):
        start = m.start()
        while start and _PART.match(text[start - 1]):
            start -= 1
        left = _TAIL.search(text, start, m.start())
        right = _TOKEN.match(text, m.end())
        if not left or not right or sum(c.isalpha() for c in left.group()) * 2 <= len(left.group()):
            continue
        first = right.group()[0]
        if first.isalpha() and (first.islower() or m.group()[0] in "¬\u00ad"):
            yield left.start(), left.group(), right.end(), right.group()


def _without_cuts(text: str) -> str:
    out, at = [], 0
    for begin, _, end, _ in _cuts(text):
        if begin >= at:
            out += [text[at:begin], "\n"]
        at = end
    return "".join([*out, text[at:]]) if out else text


def _word_counts(texts: list[str]) -> pa.Table:
    """(what, word, n): words and function-word bigrams ('pair') of some texts, with their counts."""
    tokens = [t for text in texts for t in (*_TOKEN.findall(_without_cuts(text).lower()), "")]
    coded = pc.dictionary_encode(pa.array(tokens, pa.string()))
    names, code = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
    known = names.to_pylist()
    blank = known.index("") if "" in known else -1
    function = np.array([n in _FUNCTION for n in known], bool)
    count = np.bincount(code, minlength=len(known))
    if blank >= 0:
        count[blank] = 0
    a, b = code[:-1], code[1:]
    keep = (function[a] | function[b]) & (a != blank) & (b != blank)
    pair, n = np.unique(a[keep] * len(known) + b[keep], return_counts=True)
    at = np.flatnonzero(count)
    size = max(1, len(known))
    pairs = pc.binary_join_element_wise(names.take(pa.array(pair // size)), names.take(pa.array(pair % size)), " ")
    what = pa.array(["word"] * len(at) + ["pair"] * len(pair), pa.string())
    return pa.table({"what": what, "word": pa.concat_arrays([names.take(pa.array(at)), pairs]), "n": pa.array(np.concatenate([count[at], n]).astype(np.int64))})


def _summed(parts: list[pa.Table]) -> pa.Table:
    """One row for each word or pair of some counts."""
    return pa.concat_tables(parts).group_by(["what", "word"]).aggregate([("n", "sum")]).rename_columns({"n_sum": "n"}).select(["what", "word", "n"])


def _survey(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (what, uid, stem, word, line, form, interrupts, beside, n): 'line' candidates and partial counts of 'word' and 'pair'.

    Counts are summed over a partition's batches, and given out whenever more than PARTIAL_COUNTS wait; none is left out.
    """
    names = ["what", "uid", "stem", "word", "line", "form", "interrupts", "beside", "n"]
    schema = pa.schema([("what", pa.string()), ("uid", pa.int64()), ("stem", pa.string()), ("word", pa.string()), *((c, pa.int64()) for c in names[4:])])
    waiting: list[pa.Table] = []
    size = 0

    def give(counts: pa.Table) -> Iterator[pa.RecordBatch]:
        for part in counts.combine_chunks().to_batches(max_chunksize=50_000):
            none = pa.nulls(len(part), pa.int64())
            yield pa.RecordBatch.from_arrays([part.column(0), none, pa.nulls(len(part), pa.string()), part.column(1), none, none, none, none, part.column(2)], schema=schema)

    for batch in it:
        found: list[tuple] = []
        texts = batch.column(2).to_pylist()
        for uid, stem, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts, strict=True):
            if "\n" in text or "\r" in text:
                for i, key, form, interrupts, beside in candidate_lines(_LINES.split(text)):
                    found.append((uid, stem, key, i, form, interrupts, beside))
        cols = list(zip(*found, strict=True)) or [()] * 7
        arrays = [pa.array(["line"] * len(found), pa.string()), *(pa.array(c, schema.field(n).type) for c, n in zip(cols, names[1:8], strict=True)), pa.array([1] * len(found), pa.int64())]
        yield pa.RecordBatch.from_arrays(arrays, schema=schema)
        for i, j in batches(texts, 20_000, 8_000_000):
            waiting.append(_word_counts(texts[i:j]))
            size += len(waiting[-1])
            if size > PARTIAL_COUNTS:
                waiting = [_summed(waiting)]
                size = len(waiting[0])
                if size > PARTIAL_COUNTS // 2:
                    yield from give(waiting[0])
                    waiting, size = [], 0
    if waiting:
        yield from give(_summed(waiting))


def _variants(word: str, rules: list[tuple[str, str]]) -> Iterator[tuple[str, tuple[int, ...]]]:
    """Words that misread to this one by one rule, at one place, at several, or at all."""
    for r, (wrong, right) in enumerate(rules):
        if wrong not in word:
            continue
        at = [i for i in range(len(word)) if word.startswith(wrong, i)]
        choices = [c for n in range(1, len(at) + 1) for c in combinations(at, n)] if len(at) <= 3 else [*((a,) for a in at), tuple(at)]
        for chosen in choices:
            out, last = [], 0
            for a in chosen:
                if a < last:
                    break
                out += [word[last:a], right]
                last = a + len(wrong)
            else:
                yield "".join(out) + word[last:], (r,)


@lru_cache(maxsize=1)
def _opened(name: str) -> sqlite3.Connection:
    return sqlite3.connect(f"file:{SparkFiles.get(name)}?mode=ro&immutable=1", uri=True, check_same_thread=False)


@lru_cache(maxsize=300_000)
def _stored(name: str, what: str, word: str) -> int:
    row = _opened(name).execute("SELECT n FROM counts WHERE what = ? AND word = ?", (what, word)).fetchone()
    return row[0] if row else 0


class Counts(NamedTuple):
    """Counts of words or bigrams: the most frequent in memory, the rest, if any, which have `most` at most, in the file `rest` that every executor has."""

    held: dict[str, int]
    what: str
    rest: str | None = None
    most: int = 0

    def beyond(self, word: str, least: int = 1) -> int:
        """The count of a word that isn't held; one below `least` may be told as 0, so that it needn't be looked up."""
        return _stored(self.rest, self.what, word) if self.rest and self.most >= least else 0


class Channel:
    """Vocabulary, function-word bigrams and confusion probabilities."""

    def __init__(self, words: dict[str, int] | Counts, pairs: dict[str, int] | Counts, chance: list[float] | None = None, total: int | None = None):
        self.more_words = words if isinstance(words, Counts) else Counts(words, "word")
        self.more_pairs = pairs if isinstance(pairs, Counts) else Counts(pairs, "pair")
        self.words, self.pairs = self.more_words.held, self.more_pairs.held
        self.total = max(1, sum(self.words.values()) if total is None else total)
        self.chance = chance or [1e-3] * len(CONFUSIONS)
        self.memo: dict[str, list[tuple[str, float]] | None] = {}
        self.clean: set[str] = set()

    def count(self, word: str, least: int = 1) -> int:
        """The corpus' count of a word; one below `least` may be told as 0."""
        return self.words.get(word) or self.more_words.beyond(word, least)

    def candidates(self, token: str) -> list[tuple[str, float]] | None:
        """(word, log of channel times prior count) of each candidate for a token, itself included; None if it surely stands."""
        if token in self.memo:
            return self.memo[token]
        word = token.lower()
        own = self.count(word)
        odd = bool(re.search(r"[0-9@|$!]", word))
        letters = sum(c.isalpha() for c in word)
        result = None
        if letters and len(word) >= 2 and letters * 2 >= len(word) and not re.search(r"\d{2}", word) and own < 0.02 * self.total:
            one: dict[str, tuple[float, float]] = {}
            for v, (r,) in _variants(word, CONFUSIONS):
                n = self.count(v, 1 if odd else own + 1)
                if n and v.replace("-", "").replace("'", "").isalpha() and (n > own or odd):
                    one[v] = max(one.get(v, (0.0, 0.0)), (n * self.chance[r], n))
            if not one and own <= 2 and len(word) >= 6 and (odd or token[0].islower()):
                for v, (r,) in _variants(word, CONFUSIONS):
                    for u, (q,) in _variants(v, CONFUSIONS):
                        n = self.count(u, 20)
                        if n >= 20 and u.isalpha():
                            one[u] = max(one.get(u, (0.0, 0.0)), (n * self.chance[r] * self.chance[q] * 10, n))
            if odd and not one and letters >= 3:
                plain = word
                for wrong, right in (("0", "o"), ("1", "l"), ("5", "s"), ("9", "g"), ("@", "a"), ("|", "l"), ("$", "s"), ("3", "e"), ("8", "b"), ("6", "b"), ("!", "l")):
                    plain = plain.replace(wrong, right)
                if plain.replace("-", "").isalpha() and re.search(r"[a-z][0-9@|$!]+[a-z]|^[0-9@][a-z]{3}", word):
                    one[plain] = (1e-3, 1.0)
            if one:
                expected = sum(x for x, _ in one.values())
                name = token[0].isupper() and not any(n > 30 and n > 20 * own for _, n in one.values())
                keep = 1e-9 if odd else max(own - 5 * expected, 0) + (0.5 if name else 0.05)
                result = [(word, math.log(keep)), *((v, math.log(x)) for v, (x, _) in one.items())]
                best = max(result, key=lambda x: x[1])
                if best[0] == word and best[1] > 4 + max(x[1] for x in result[1:]):
                    result = None
        if len(self.memo) < 500_000:
            self.memo[token] = result
            if result is None:
                self.clean.add(token)
        return result

    def _step(self, before: str, word: str) -> float:
        """How much likelier the bigram makes the word than its count alone; only function words have bigrams."""
        if before in _FUNCTION or word in _FUNCTION:
            m, own = self.count(before), self.count(word)
            if m and own:
                n = self.pairs.get(f"{before} {word}") or self.more_pairs.beyond(f"{before} {word}")
                return math.log((0.5 * n / m + 0.5 * own / self.total) / (own / self.total))
        return 0.0

    def decode(self, tokens: list[str]) -> list[str]:
        """The likeliest words of one line."""
        options = [self.candidates(t) for t in tokens]
        if not any(options):
            return [t.lower() for t in tokens]
        states: list[tuple[str, float, int]] = []
        trace = []
        for t, option in zip(tokens, options, strict=True):
            new = []
            for word, score in option or [(t.lower(), 0.0)]:
                if states:
                    from_, best = max(((i, s + self._step(w, word)) for i, (w, s, _) in enumerate(states)), key=lambda x: x[1])
                else:
                    from_, best = -1, 0.0
                new.append((word, best + score, from_))
            trace.append(new)
            states = new
        i = max(range(len(states)), key=lambda j: states[j][1])
        out = []
        for new in reversed(trace):
            out.append(new[i][0])
            i = new[i][2]
        return out[::-1]

    def joined(self, left: str, right: str) -> str:
        """The word that a line break cut into left and right, with a hyphen only if the corpus writes it so."""
        best, score = left.lower() + right.lower(), 0.5
        for glue in ("", "-"):
            word = self.decode([left + glue + right])[0]
            if self.count(word) > score:
                best, score = word, self.count(word)
        return best


def _confident(shared, it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    words: Counts = shared.value
    for df in it:
        rule, n = [], []
        for word, count in zip(df["word"], df["n"], strict=True):
            if len(word) < 5:
                continue
            hits = {(v, r) for v, (r,) in _variants(word, CONFUSIONS) if (words.held.get(v) or words.beyond(v, 50 * count)) >= 50 * count}
            if len({v for v, _ in hits}) == 1:
                for _, r in hits:
                    rule.append(r)
                    n.append(count / len(hits))
        yield pd.DataFrame({"rule": pd.Series(rule, dtype="int64"), "n": pd.Series(n, dtype="float64")})


def _having(wanted, it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows whose uid, in the first column, may be in the filter."""
    for batch in it:
        yield batch.filter(pa.array(may_be_in(wanted.value, batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))))


def _apply(shared, with_text: bool, without, it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repair rows (uid, tab, rec, text, lines to drop); with a filter only those whose uid isn't in it, which have no lines to drop."""
    channel: Channel = shared.value
    kinds = pa.list_(pa.struct([("kind", pa.string()), ("item", pa.string())]))
    for batch in it:
        if without:
            batch = batch.filter(pa.array(~may_be_in(without.value, batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))))
        batch = batch.select(batch.schema.names[1:])
        texts, drops = batch.column(2).to_pylist(), batch.column(3).to_pylist()
        found, repaired = [], []
        for text, drop in zip(texts, drops, strict=True):
            items, paragraphs = repair(text, drop or (), channel, with_text)
            found.append([{"kind": k, "item": i} for k, i in items])
            repaired.append(paragraphs)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, kinds), pa.array(repaired, pa.string())], ["tab", "rec", "found", "repaired"])


def repair(text: str, drop: Collection[int], channel: Channel, with_text: bool = True) -> tuple[set[tuple[str, str]], str | None]:
    """What was wrong with a text, as (kind, item), and, if wanted, its paragraphs without page lines, cut and misread words."""
    items: set[tuple[str, str]] = set()
    if drop or "}--" in text:
        gone = set(drop)
        lines = _LINES.split(text)
        items.update(("line", lines[i].strip()) for i in gone if i < len(lines))
        text = "\n".join(line for i, line in enumerate(lines) if i not in gone and not _MARKER.match(line))
    given = set(_TOKEN.findall(text))
    long = [t for t in given if len(t) >= 4 and t[0].isalpha()]
    readable = sum(channel.count(t.lower()) > 2 for t in long) * 2 >= len(long)
    out, at = [], 0
    for begin, left, end, right in _cuts(text):
        if begin < at:
            continue
        word = channel.joined(left, right)
        items.add(("hyphen", word))
        raw = (left + right).lower()
        if readable and word.replace("-", "") != raw.replace("-", ""):
            items.add(("misread", word))
        out += [text[at:begin], word.capitalize() if left[0].isupper() else word]
        at = end
    if out:
        text = "".join([*out, text[at:]])
        given = set(_TOKEN.findall(text))
    if readable:
        doubtful = {t for t in given if t not in channel.clean and channel.candidates(t)}
        if doubtful:
            lines = text.split("\n")
            for n, line in enumerate(lines):
                spans = list(_TOKEN.finditer(line))
                tokens = [x.group() for x in spans]
                if doubtful.isdisjoint(tokens):
                    continue
                for x, new in reversed(list(zip(spans, channel.decode(tokens), strict=True))):
                    if new != x.group().lower():
                        items.add(("misread", new))
                        line = line[: x.start()] + (new.capitalize() if x.group()[0].isupper() else new) + line[x.end() :]
                lines[n] = line
            text = "\n".join(lines)
    return items, paragraphs(text) if with_text else None


def paragraphs(text: str) -> str:
    """Lines joined to paragraphs, which blank lines part; rows of cells and listed entries keep their line."""
    out = []
    for block in re.split(r"\n\s*\n", text.replace("\r\n", "\n").replace("\r", "\n")):
        joined = ""
        for line in filter(None, (x.strip() for x in block.split("\n"))):
            own = bool(_CELLS.search(line) or _LISTED.match(line))
            joined += ("\n" if joined and own else " " if joined else "") + line
        if joined:
            out.append(joined)
    return "\n\n".join(out)


def _most_frequent(counted: DataFrame, most: int, what: str) -> tuple[dict[str, int], DataFrame | None, int]:
    """The counts of the `most` most frequent ones, the others as a table, if there are any, and their highest count; a warning tells of these."""
    rows = counted.orderBy(F.desc("n"), "word").limit(most + 1).select("word", "n").collect()
    known = {r.word: r.n for r in rows[:most]}
    if len(rows) <= most:
        return known, None, 0
    first = rows[most]
    _log.warning("of the %s only the %d most frequent are held in memory; the rarer ones, from count %d down, are looked up in a file", what, most, first.n)
    return known, counted.where((F.col("n") < first.n) | ((F.col("n") == first.n) & (F.col("word") >= first.word))), first.n


def _kept_in_file(rests: list[DataFrame]) -> str:
    """The name of a file, sent to every executor, with the counts of rests(what, word, n); a part of them is in memory at a time."""
    spark = rests[0].sparkSession
    name = f"lamplight-counts-{uuid.uuid4().hex}.db"
    folder = tempfile.mkdtemp(prefix="lamplight-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    file = sqlite3.connect(f"{folder}/{name}")
    file.execute("PRAGMA journal_mode = OFF")
    file.execute("CREATE TABLE counts (what TEXT, word TEXT, n INTEGER, PRIMARY KEY (what, word)) WITHOUT ROWID")
    for rest in rests:
        file.executemany("INSERT INTO counts VALUES (?, ?, ?)", rest.select("what", "word", "n").orderBy("what", "word").toLocalIterator())
    file.commit()
    file.close()
    spark.sparkContext.addFile(f"{folder}/{name}")
    return name


def _vocabulary(counted: DataFrame) -> tuple[Counts, Counts]:
    """All words of more than one occurrence and bigrams of more than four."""
    words, more_words, top_word = _most_frequent(counted.where("what = 'word' and n > 1"), VOCABULARY, "words")
    pairs, more_pairs, top_pair = _most_frequent(counted.where("what = 'pair' and n > 4"), 2 * VOCABULARY, "bigrams")
    rests = [x for x in (more_words, more_pairs) if x is not None]
    file = _kept_in_file(rests) if rests else None
    return Counts(words, "word", file if more_words is not None else None, top_word), Counts(pairs, "pair", file if more_pairs is not None else None, top_pair)


def repair_scans(rows: DataFrame, with_text: bool = True, name: str = "scans") -> DataFrame:
    """(tab, rec, found array<struct<kind, item>>, repaired) for each row of rows(tab, rec, stem, text).

    repaired is null unless with_text. kind 'line' is a running header, footer or page number, 'hyphen' a word that a line break cut, 'misread' a word with misread characters.
    Null texts have no row; blank ones have nothing found. Rows that repeat are repaired each; an empty table gives none. Only texts with lines to
    drop, told by a filter of fixed size, are shuffled, to meet these. What's held in memory is
    bounded: VOCABULARY words, twice as many bigrams with function words, and one number a confusion. Of more, the most frequent are
    held so, the others looked up in a file that every executor gets, and a warning is logged; results are the same.
    """
    spark = rows.sparkSession
    rows = rows.select("tab", "rec", "stem", "text").where("text is not null").withColumn("uid", F.xxhash64("tab", "rec", "text"))
    survey = materialize(rows.select("uid", "stem", "text").mapInArrow(_survey, "what string, uid long, stem string, word string, line long, form long, interrupts long, beside long, n long"), f"{name}-survey")
    counted = materialize(survey.where("what <> 'line'").groupBy("what", "word").agg(F.sum("n").alias("n")).where("n > 1 or what = 'word'"), f"{name}-counts")
    words, pairs = _vocabulary(counted)
    vocabulary = spark.sparkContext.broadcast(words)
    wrong = {r.rule: r.n for r in counted.where("what = 'word'").select("word", "n").mapInPandas(partial(_confident, vocabulary), "rule long, n double").groupBy("rule").agg(F.sum("n").alias("n")).collect()}
    if words.rest:
        holding = [F.coalesce(F.sum(F.when(F.contains("word", F.lit(right)), F.col("n"))), F.lit(0)) for _, right in CONFUSIONS]
        total, *written = counted.where("what = 'word' and n > 1").agg(F.sum("n"), *holding).first()
    else:
        total, written = sum(words.held.values()), [sum(n for w, n in words.held.items() if right in w) for _, right in CONFUSIONS]
    chance = [max(2e-6, min(0.05, (wrong.get(r, 0) + 0.5) / (1000 + n))) for r, n in enumerate(written)]
    channel = spark.sparkContext.broadcast(Channel(words, pairs, chance, total))

    lines = survey.where("what = 'line'").select("uid", "stem", "word", "line", "form", "interrupts", "beside")
    # Page numbers need no evidence of others, and would all meet on one empty key.
    numbers, titles = lines.where("form < 2"), lines.where("form >= 2")
    by_key = titles.groupBy("word").agg(F.count("*").alias("key_n"), F.avg("interrupts").alias("key_interrupts"), F.avg((F.col("form") == 2).cast("int")).alias("key_paged"))
    by_stem = titles.groupBy("stem", "word").agg(F.count("*").alias("stem_n"), F.sum("interrupts").alias("stem_interrupts"))
    judged = titles.join(by_key, "word", "left").join(by_stem, ["stem", "word"], "left")
    sure = ((F.col("form") == 2) & ((F.col("key_n") > 1) | (F.col("interrupts") + F.col("beside") > 0))) | (
        (F.col("form") == 3) & ((F.col("interrupts") == 1) | ((F.col("stem_n") > 1) & ((F.col("key_interrupts") > 0.15) | (F.col("key_paged") > 0.1))) | ((F.col("key_n") > 3) & (F.col("key_interrupts") > 0.3)) | (F.col("beside") == 2) | ((F.col("beside") > 0) & (F.col("stem_n") > 1) & (F.col("key_n") < 3 * F.col("stem_n"))))
    )
    gone = numbers.select("uid", "line").unionByName(judged.where(sure).select("uid", "line"))
    drop = materialize(gone.groupBy("uid").agg(F.collect_set("line").alias("drop")), f"{name}-drops")
    wanted = key_filter(drop.select("uid"), drop.count())
    plain, schema = rows.select("uid", "tab", "rec", "text"), "tab string, rec string, found array<struct<kind: string, item: string>>, repaired string"
    some = plain.mapInArrow(partial(_having, wanted), plain.schema).join(drop, "uid", "left").select("uid", "tab", "rec", "text", "drop")
    rest = plain.withColumn("drop", F.lit(None).cast("array<bigint>"))
    return some.mapInArrow(partial(_apply, channel, with_text, None), schema).unionByName(rest.mapInArrow(partial(_apply, channel, with_text, wanted), schema))


def found_items(repaired: DataFrame) -> DataFrame:
    """(tab, rec, kind, item), distinct, of repair_scans()."""
    return repaired.select("tab", "rec", F.explode("found").alias("f")).select("tab", "rec", "f.kind", "f.item").distinct()
