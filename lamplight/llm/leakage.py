"""Passages of held-out test items inside a corpus: CGK embedding, bit-sampling LSH over windows, edit verification.

The CGK random walk (Chakraborty, Goldenberg, Koucky 2016) reads a window of words left to right: at each step it writes the
word it stands on and moves on or stays, as a random bit of (step, word) says. Windows at small edit distance are soon in step
again, so their walks agree in most places. Each repetition hashes a few sampled places of a walk of its own into one key;
equal windows agree on every key of every repetition. How many repetitions reach a target recall is found by simulating them.

For a recall of 1 candidates come from pieces instead: of edits + 1 pieces of an item's window, one at least stands unchanged
in every window within that many edits, so none is missed.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamplight.llm.lsh import key_filter, may_be_in
from lamplight.llm.words import batches, grams, mix, owner, sequence_hash, words
from lamplight.session import materialize

_PAD = np.uint64(0x5851F42D4C957F2D)
#: Test items of so many windows go to every task; larger sets meet the corpus' windows in a join of their keys.
ITEM_WINDOWS = 500_000
#: Repetitions at most: a recall that needs more is refused.
MOST_REPEATS = 64
_BITMAP = 22
_CHUNK = 1 << 15


def _plan(window: int, sample: int, repeat: int) -> tuple[list[int], list[int]]:
    """For one repetition: an odd multiplier a step, whose product's top bit moves the walk, and the sampled steps."""
    rng = np.random.default_rng(7919 * repeat + 13)
    places = np.sort(rng.choice(2 * window, size=sample, replace=False))
    return [int(x) | 1 for x in rng.integers(1, 2**63, size=int(places[-1]) + 1)], places.tolist()


def walk_keys(h: np.ndarray, at: np.ndarray, window: int, sample: int, repeat: int) -> np.ndarray:
    """The key of each window (beginning at word `at` of h) in one repetition."""
    steps, places = _plan(window, sample, repeat)
    wanted = set(places)
    out = np.empty(len(at), np.uint64)
    with np.errstate(over="ignore"):
        for c in range(0, len(at), _CHUNK):  # a piece that stays in the processor's cache
            pos = at[c : c + _CHUNK].copy()
            end = pos + window
            key = np.full(len(pos), repeat, np.uint64)
            for j, odd in enumerate(steps):
                word = np.where(pos < end, h[np.minimum(pos, len(h) - 1)], _PAD) if j >= window else h[pos]
                if j in wanted:
                    key = mix(key * np.uint64(0x9FB21C651E98DF25) + word)
                pos += ((word * np.uint64(odd)) >> np.uint64(63)).view(np.int64)
            out[c : c + _CHUNK] = key
    return out


def _edited(window: int, edits: int, n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Random windows (rows) and edited ones, by kind of edit: words replaced, and, for two edits, one inserted or one dropped."""
    rng = np.random.default_rng(5)
    x = rng.integers(1, 2**63, size=(n, window)).astype(np.uint64)
    fresh = rng.integers(1, 2**63, size=(n, window)).astype(np.uint64)
    rank = np.argsort(np.argsort(rng.random((n, window)), axis=1), axis=1)
    yield x, np.where(rank < edits, fresh, x)
    if edits >= 2:
        at, place = rng.integers(1, window - 1, size=n)[:, None], np.arange(window)
        shifted = np.roll(x, 1, axis=1)
        yield x, np.where(place < at, x, np.where(place == at, fresh, shifted))
        shifted = np.concatenate([x[:, 1:], fresh[:, :1]], axis=1)
        yield x, np.where(place < at, x, shifted)


@cache
def repetitions(window: int, edits: int, sample: int, recall: float, n: int = 2000) -> int:
    """How many repetitions find the share `recall` of windows edited so much, for the kind of edit that's hardest to find."""
    if edits == 0:
        return 1
    at, most = np.arange(n) * window, 0
    for x, y in _edited(window, edits, n):
        found = np.zeros(n, bool)
        for r in range(MOST_REPEATS):
            found |= walk_keys(x.ravel(), at, window, sample, r) == walk_keys(y.ravel(), at, window, sample, r)
            if found.mean() >= recall:
                break
        else:
            raise ValueError(f"a recall of {recall} takes more than {MOST_REPEATS} repetitions: sample fewer places")
        most = max(most, r + 1)
    return most


def edit_distances(x: np.ndarray, y: np.ndarray, most: int) -> np.ndarray:
    """Word edit distance of each row of x to that row of y, within a band of `most`; larger ones count as most + 1."""
    n, m = x.shape
    if most == 0:
        return (x != y).any(axis=1).astype(np.int64)
    far = most + 1
    before = np.tile(np.minimum(np.arange(m + 1), far), (n, 1))
    for i in range(1, m + 1):
        now = np.full((n, m + 1), far)
        now[:, 0] = min(i, far)
        for j in range(max(1, i - most), min(m, i + most) + 1):
            now[:, j] = np.minimum(np.minimum(before[:, j], now[:, j - 1]) + 1, before[:, j - 1] + (x[:, i - 1] != y[:, j - 1]))
        before = np.minimum(now, far)
    return before[:, m]


def _may_match(x: np.ndarray, y: np.ndarray, here: np.ndarray, there: np.ndarray, window: int, edits: int) -> np.ndarray:
    """Which windows (from word `here` of x and `there` of y) may be within `edits`: all others surely aren't.

    In two windows of one length, a word that stays is moved by edits // 2 places at most; at most `edits` words don't stay.
    """
    left, missing = np.arange(len(here)), np.zeros(len(here), np.int64)
    for i in range(window):
        word, begin = x[here[left] + i], there[left]
        same = np.zeros(len(left), bool)
        for j in range(max(0, i - edits // 2), min(window, i + edits // 2 + 1)):
            same |= word == y[begin + j]
        missing = missing + ~same
        ok = missing <= edits
        left, missing = left[ok], missing[ok]
    return left


def _windows(first: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the windows of some texts begin, and the text of each."""
    runs = np.maximum(np.diff(first) - window + 1, 0)
    at = np.arange(runs.sum()) + np.repeat(first[:-1] - np.concatenate([[0], np.cumsum(runs)[:-1]]), runs)
    return at, np.repeat(np.arange(len(runs)), runs)


class _Items:
    """The windows of test items, in the form a scan needs. case: the item's number, cases: the ids by number."""

    def __init__(self, cases: pa.Array, texts: list[str], window: int, sample: int, repeats: int, edits: int):
        w = words(texts)
        self.cases, self.hash = cases, w.hash
        self.at, self.case = _windows(w.first, window)
        self.keys = []
        for r in range(repeats):
            keys = walk_keys(w.hash, self.at, window, sample, r)
            order = np.argsort(keys, kind="stable")
            bitmap = np.zeros(1 << _BITMAP, bool)
            bitmap[(keys >> np.uint64(64 - _BITMAP)).astype(np.int64)] = True
            self.keys.append((keys[order], order, bitmap))
        if not repeats:
            # The distinct pieces, and by piece the (window, piece's place in it) that have it.
            self.length = window // (edits + 1)
            pieces, first = grams(w.hash, w.first, self.length)
            begin = np.arange(len(pieces)) + np.repeat(w.first[:-1] - first[:-1], np.diff(first))
            at = np.concatenate([np.searchsorted(begin, self.at + k * self.length) for k in range(edits + 1)])
            order = np.argsort(pieces[at], kind="stable")
            self.pieces = pieces[at][order]
            self.whose = np.tile(np.arange(len(self.at)), edits + 1)[order]
            self.place = np.repeat(np.arange(edits + 1) * self.length, len(self.at))[order]
        self.known = np.zeros(1 << _BITMAP, bool)
        self.known[(w.hash >> np.uint64(64 - _BITMAP)).astype(np.int64)] = True


def _sharing_pieces(items: _Items, h: np.ndarray, first: np.ndarray, at: np.ndarray, window: int, edits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word at which a window of h begins, window of the items) of all pairs within `edits`, and of some others, a piece of the texts at a time."""
    pieces, runs = grams(h, first, items.length)
    begin = np.arange(len(pieces)) + np.repeat(first[:-1] - runs[:-1], np.diff(runs))
    wanted = np.zeros(len(h), bool)
    wanted[at] = True
    low, high = np.searchsorted(items.pieces, pieces), np.searchsorted(items.pieces, pieces, "right")
    hit = np.flatnonzero(high > low)
    low, n, begin = low[hit], (high - low)[hit], begin[hit]
    total = np.concatenate([[0], np.cumsum(n)])
    lo = 0
    while lo < len(hit):
        hi = max(lo + 1, int(np.searchsorted(total, total[lo] + 200_000, "right")) - 1)
        m = n[lo:hi]
        entry = np.arange(m.sum()) + np.repeat(low[lo:hi] - (total[lo:hi] - total[lo]), m)
        x, y, place = np.repeat(begin[lo:hi], m), items.whose[entry], items.place[entry]
        for shift in range(-(edits // 2), edits // 2 + 1):
            start = x - place - shift
            ok = (place + shift >= 0) & (place + shift <= window - items.length) & (start >= 0)
            ok[ok] = wanted[start[ok]]
            here, there = start[ok], y[ok]
            near = _may_match(h, items.hash, here, items.at[there], window, edits)
            yield here[near], there[near]
        lo = hi


def _sharing_keys(items: _Items, h: np.ndarray, at: np.ndarray, window: int, sample: int, edits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word at which a window of h begins, window of the items) of the pairs that share a repetition's key, without those that surely aren't within `edits`."""
    for r, (keys, order, bitmap) in enumerate(items.keys):
        own = walk_keys(h, at, window, sample, r)
        hit = np.flatnonzero(bitmap[(own >> np.uint64(64 - _BITMAP)).astype(np.int64)])
        low, high = np.searchsorted(keys, own[hit]), np.searchsorted(keys, own[hit], "right")
        total = np.concatenate([[0], np.cumsum(high - low)])
        lo = 0
        while lo < len(hit):
            hi = max(lo + 1, int(np.searchsorted(total, total[lo] + 200_000, "right")) - 1)
            n = (high - low)[lo:hi]
            there = order[np.arange(n.sum()) + np.repeat(low[lo:hi] - (total[lo:hi] - total[lo]), n)]
            here = np.repeat(at[hit[lo:hi]], n)
            near = _may_match(h, items.hash, here, items.at[there], window, edits)
            yield here[near], there[near]
            lo = hi


def _scan(items: _Items, window: int, sample: int, edits: int, it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    inner = np.arange(window)
    for batch in it:
        texts = batch.column(1).to_pylist()
        for i, j in batches(texts):
            w = words(texts[i:j])
            if len(w.hash) < window:
                continue
            # At most `edits` of a window's words can be missing from a test item at that distance.
            new = np.concatenate([[0], np.cumsum(~items.known[(w.hash >> np.uint64(64 - _BITMAP)).astype(np.int64)])])
            at = np.flatnonzero(new[window:] - new[:-window] <= edits)
            own = owner(w.first)
            at = at[own[at] == own[at + window - 1]]
            if not len(at):
                continue
            pairs = _sharing_keys(items, w.hash, at, window, sample, edits) if items.keys else _sharing_pieces(items, w.hash, w.first, at, window, edits)
            found = [np.stack(pair) for pair in pairs]
            if not found:
                continue
            here, there = np.unique(np.concatenate(found, axis=1), axis=1)
            for c in range(0, len(here), 200_000):
                x, y = here[c : c + 200_000], there[c : c + 200_000]
                d = edit_distances(w.hash[x[:, None] + inner], items.hash[items.at[y][:, None] + inner], edits)
                good = d <= edits
                x, y, d = x[good], y[good], d[good]
                doc = own[x]
                _, once = np.unique(np.stack([doc, items.case[y]]), axis=1, return_inverse=True)
                if not len(once):
                    continue
                size = once.max() + 1
                best = np.full(size, edits + 1)
                np.minimum.at(best, once, d)
                count, head = np.bincount(once, minlength=size), np.empty(size, np.int64)
                head[once[::-1]] = np.arange(len(once))[::-1]
                ids = batch.column(0).take(pa.array(i + doc[head]))
                yield pa.RecordBatch.from_arrays([ids, items.cases.take(pa.array(items.case[y[head]])), pa.array(best), pa.array(count)], ["id", "case_id", "edits", "windows"])


def _keyed_windows(window: int, sample: int, repeats: int, wanted, it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, w, words, keys): of each text the windows, their hash, their words' hashes, and their keys; with a filter only keys that pass it."""
    inner = np.arange(window)
    signed = lambda x: pa.array(x.view(np.int64))
    for batch in it:
        texts = batch.column(1).to_pylist()
        for i, j in batches(texts, 1024, 500_000):
            w = words(texts[i:j])
            at, own = _windows(w.first, window)
            if not len(at):
                continue
            keys = np.stack([walk_keys(w.hash, at, window, sample, r) for r in range(repeats)], axis=1)
            keep = may_be_in(wanted.value, keys.ravel()).reshape(keys.shape) if wanted else np.ones(keys.shape, bool)
            row = np.flatnonzero(keep.any(axis=1))
            for c in range(0, len(row), 50_000):
                some = row[c : c + 50_000]
                flat = np.ascontiguousarray(w.hash[at[some][:, None] + inner])
                name = sequence_hash(flat.ravel(), np.arange(len(some) + 1) * window)
                lists = pa.ListArray.from_arrays(pa.array((np.arange(len(some) + 1) * window).astype(np.int32)), signed(flat.ravel()))
                first = np.concatenate([[0], np.cumsum(keep[some].sum(axis=1))])
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(i + own[some])), signed(name), lists, pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), signed(keys[some][keep[some]]))], ["id", "w", "words", "keys"])


def _verify(window: int, edits: int, it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in it:
        x, y = (batch.column(c).flatten().to_numpy(zero_copy_only=False).reshape(-1, window) for c in (2, 3))
        d = edit_distances(x, y, edits)
        rows = pa.array(np.flatnonzero(d <= edits))
        yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), pa.array(d[d <= edits])], ["x", "y", "edits"])


def _by_join(texts: DataFrame, held: DataFrame, window: int, sample: int, repeats: int, edits: int, name: str) -> DataFrame:
    """find_leaks() for test items too many for every task: keys of both sides meet in a join, in one scan of the corpus.

    A filter of fixed size leaves few of the corpus' windows; equal windows are verified once.
    """
    windows = lambda df, wanted: df.mapInArrow(partial(_keyed_windows, window, sample, repeats, wanted), f"id {dict(df.dtypes)['id']}, w long, words array<long>, keys array<long>")
    there = materialize(windows(held, None), f"{name}-items")
    keys = there.select(F.explode("keys").alias("key"))
    here = materialize(windows(texts, key_filter(keys, keys.count())), f"{name}-windows")
    side = lambda df, w: df.select(F.col("w").alias(w), F.explode("keys").alias("key")).distinct()
    pairs = side(here, "x").join(side(there, "y"), "key").select("x", "y").distinct()
    spelled = lambda df, w, as_: df.select(F.col("w").alias(w), F.col("words").alias(as_)).dropDuplicates([w])
    rows = pairs.join(spelled(here, "x", "wx"), "x").join(spelled(there, "y", "wy"), "y").select("x", "y", "wx", "wy")
    good = rows.mapInArrow(partial(_verify, window, edits), "x long, y long, edits long")
    ids = here.groupBy("id", F.col("w").alias("x")).agg(F.count("*").alias("n"))
    cases = there.groupBy(F.col("id").alias("case_id"), F.col("w").alias("y")).agg(F.count("*").alias("m"))
    return good.join(ids, "x").join(cases, "y").select("id", "case_id", "edits", (F.col("n") * F.col("m")).alias("windows"))


def find_leaks(corpus: DataFrame, id_col: str, text_col: str, items: DataFrame, case_col: str, item_cols: list[str], *, window: int = 12, edits: int = 1, recall: float = 0.98, sample: int = 6, name: str = "leaks") -> DataFrame:
    """(id, case_id, edits, windows): the documents that hold a passage of a test item.

    A document holds one if some `window` consecutive words of its text are within `edits` word edits of `window` consecutive
    words of one of the item's columns. edits is the least distance seen, windows counts matching pairs of windows. A word inserted into a
    window or dropped from it costs 2 edits, as its end shifts too.

    Equal windows are always found. Of edited ones, of the kind of edit that's hardest to find, a single pair of windows is found with
    probability `recall`, which sets the number of repetitions; a passage usually has several. With recall = 1 every case is found, by pieces.

    The corpus is scanned once and not shuffled: items of up to ITEM_WINDOWS windows go to every task, more meet it in a join of keys.
    Null texts, and texts or items of fewer words than a window, match nothing; empty tables give no rows. Repeated items or
    rows are matched like others and merged in the result by id and case. Ids may be of any type.
    """
    scanned = corpus.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text is not null")
    held = items.select(F.col(case_col).alias("id"), F.explode(F.array(*item_cols)).alias("text")).where("id is not null and text is not null")
    size = F.size(F.regexp_extract_all(F.lower("text"), F.lit("[a-z0-9]+"), F.lit(0))) - window + 1
    held = held.withColumn("n", size).where("n > 0")
    repeats = repetitions(window, edits, sample, recall) if recall < 1 else 0
    total = held.agg(F.sum("n").alias("n")).first().n or 0
    kinds = f"id {dict(scanned.dtypes)['id']}, case_id {dict(held.dtypes)['id']}, edits long, windows long"
    if total > ITEM_WINDOWS and repeats:
        found = _by_join(scanned, held.select("id", "text"), window, sample, repeats, edits, name)
    else:
        if total > ITEM_WINDOWS:
            raise ValueError(f"{total} windows of test items are too many for a recall of 1")
        block = held.select("id", "text").toArrow()
        carried = _Items(block.column(0).combine_chunks(), block.column(1).to_pylist(), window, sample, repeats, edits)
        found = scanned.mapInArrow(partial(_scan, carried, window, sample, edits), kinds)
    return found.groupBy("id", "case_id").agg(F.min("edits").alias("edits"), F.sum("windows").alias("windows"))
