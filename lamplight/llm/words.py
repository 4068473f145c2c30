"""Batch text hashing with numpy: words, k-mers and their per-document layout, without a Python loop over words.

A batch of texts is laid out as one byte buffer with a NUL between texts. Words are runs of a-z and 0-9 after
lower-casing. Word hashes come from prefix sums of a polynomial over the buffer, so a batch costs a few array passes.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_P_INV = np.uint64(pow(int(_P), -1, 1 << 64))
_WORD = np.zeros(256, bool)
_WORD[list(b"abcdefghijklmnopqrstuvwxyz0123456789")] = True
_POWERS: dict[int, np.ndarray] = {}


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser (xor-shift-multiply) of unsigned values, seeded."""
    x = (x ^ np.uint64((seed * 0xD6E8FEB86659FD93 + 0x2545F4914F6CDD1D) & (2**64 - 1))) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


def powers(base: np.uint64, n: int) -> np.ndarray:
    """1, base, base**2 ... modulo 2**64, cached by base and grown as needed."""
    have = _POWERS.get(int(base))
    if have is None or len(have) < n:
        size = 1 << max(16, (n - 1).bit_length())
        have = np.empty(size, np.uint64)
        have[0], filled, step = 1, 1, base
        while filled < size:
            have[filled : 2 * filled] = have[:filled] * step
            filled, step = 2 * filled, step * step
        _POWERS[int(base)] = have
    return have[:n]


class Words(NamedTuple):
    """hash: of each word; start, end: bytes of each word in data; first: of text i, its first word (n + 1 entries)."""

    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    data: np.ndarray


def words(texts: list[str | None]) -> Words:
    """The words of every text; a null text has none."""
    raw = [(t or "").lower().encode("utf-8", "ignore") for t in texts]
    data = np.frombuffer(b"\0" + b"\0".join(raw) + b"\0", np.uint8)
    is_word = _WORD[data]
    edge = np.flatnonzero(is_word[1:] != is_word[:-1]) + 1
    start, end = edge[0::2], edge[1::2]
    with np.errstate(over="ignore"):
        sums = np.empty(len(data) + 1, np.uint64)
        sums[0] = 0
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(_P, len(data)), out=sums[1:])
        value = mix((sums[end] - sums[start]) * powers(_P_INV, len(data))[start])
    at = np.cumsum([1, *(len(r) + 1 for r in raw)])
    return Words(value, start, end, np.searchsorted(start, at), data)


def grams(value: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all runs of k values within each text, in text order, and each text's first run (n + 1 entries)."""
    count = np.diff(first)
    runs = np.maximum(count - k + 1, 0)
    out_first = np.concatenate([[0], np.cumsum(runs)])
    at = np.arange(out_first[-1]) + np.repeat(first[:-1] - out_first[:-1], runs)
    with np.errstate(over="ignore"):
        h = value[at].copy()
        for j in range(1, k):
            h = h * np.uint64(0x9FB21C651E98DF25) + value[at + j]
        return mix(h), out_first


def owner(first: np.ndarray) -> np.ndarray:
    """The text of each item."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def _keyed(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.uint64]:
    """(text number, top bits of the hash) in one integer, for one fast sort; and how many bits the text number takes."""
    bits = np.uint64(max(1, (len(first) - 1).bit_length()))
    return (owner(first).astype(np.uint64) << (np.uint64(64) - bits)) | (h >> bits), bits


def occurrence_labelled(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The hashes with each item's occurrence number within its text mixed in: the second "a b c" differs from the first."""
    key, _ = _keyed(h, first)
    srt = np.sort(key)
    again = np.unique(srt[1:][srt[1:] == srt[:-1]])
    if not len(again):
        return h
    at = np.flatnonzero(again[np.minimum(np.searchsorted(again, key), len(again) - 1)] == key)
    at = at[np.argsort(key[at], kind="stable")]
    fresh = np.ones(len(at), bool)
    fresh[1:] = key[at[1:]] != key[at[:-1]]
    run = np.arange(len(at)) - np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
    out = h.copy()
    with np.errstate(over="ignore"):
        out[at[run > 0]] = mix(h[at[run > 0]] ^ (run[run > 0].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)))
    return out


def distinct(h: np.ndarray, first: np.ndarray, keep_bits: int = 48) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct hashes, ascending and cut to their top keep_bits, and each text's first (n + 1 entries)."""
    key, bits = _keyed(h, first)
    assert 64 - int(bits) >= keep_bits, "too many texts in one batch"
    key >>= np.uint64(64 - int(bits) - keep_bits)
    key.sort()
    if len(key):
        key = key[np.concatenate([[True], key[1:] != key[:-1]])]
    own = (key >> np.uint64(keep_bits)).astype(np.int64)
    return key & np.uint64((1 << keep_bits) - 1), np.searchsorted(own, np.arange(len(first)))


def sequence_hash(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One hash for each text's whole word sequence; equal sequences get equal hashes."""
    with np.errstate(over="ignore"):
        at = np.arange(len(h)) - np.repeat(first[:-1], np.diff(first))
        weighed = h * powers(np.uint64(0xD1342543DE82EF95), int(at.max()) + 1 if len(at) else 1)[at]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(weighed, dtype=np.uint64)])
        return mix(sums[first[1:]] - sums[first[:-1]] + np.diff(first).astype(np.uint64))


def segment_min(v: np.ndarray, first: np.ndarray, empty: np.uint64 = np.uint64(2**64 - 1)) -> np.ndarray:
    """The least value of each text; empty where a text has none."""
    out = np.full(len(first) - 1, empty, np.uint64)
    full = np.flatnonzero(np.diff(first))
    if len(full):
        out[full] = np.minimum.reduceat(v, first[:-1][full])
    return out


def batches(texts: list[str | None], most: int = 1024, chars: int = 2_000_000):
    """Slices of the list of at most so many texts and, but for a single longer text, so many characters."""
    start = size = 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > start and (i - start >= most or size + n > chars):
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def characters(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each lower-cased character, and each text's first (n + 1 entries)."""
    low = [(t or "").lower() for t in texts]
    code = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    with np.errstate(over="ignore"):
        return mix(code), np.cumsum([0, *map(len, low)])
