"""Per-document text statistics over byte buffers, computed a batch at a time with array operations."""

from __future__ import annotations

import numpy as np

from lamplight.llm.words import Words, words

#: Common function words by language.
COMMON = {
    "en": "a about after against all also an and any are as at be because been before between both but by can could did do does each for from had has have he her his how if in into is it its like many may more most must no nor not of often on one only or other our out over she should so some such than that the their them then there these they this those through to under until up was we were what when where which while who will with within would you your".split(),
    "es": "al como con cuando de del desde el ella ellos en entre era es esta este fue ha han hasta la las le lo los mayor muy no o para pero por que se segun ser si sin sobre su sus un una y ya".split(),
    "fr": "a au aux avec ce ces cette dans de des donne du elle en entre est et il ils la le les leur mais ne nous on ou par pas pour qui que sa se selon ses son sont sur un une".split(),
    "fil": "ang ay at ayon bago dahil dapat din hindi isa ito ka kami kanilang kay kung kaya ko lang mas matapos mga na namin ng ni nila nito pa para sa si sila upang".split(),
}
LANGS = list(COMMON)
_BITS = 20
CLASSES = 32
_NAMES = ["chars", "words", "mean_word_length", "symbol_ratio", "foreign_ratio", "digit_ratio", "common_ratio", "line_end_ratio", "entry_ratio", "cell_ratio", "form_ratio", "sequence_score"]
FIELDS = [*_NAMES, "lang"]


def _classes() -> np.ndarray:
    """Of each byte its class for sequence statistics: 0 to 25 letters, then digit, blank, sentence mark, other mark, symbol, non-ASCII."""
    c = np.full(256, 30, np.int64)
    c[128:] = 31
    for i in range(26):
        c[97 + i] = c[65 + i] = i
    c[48:58] = 26
    c[[9, 10, 11, 12, 13, 32]] = 27
    c[list(b".,")] = 28
    c[list(b";:?!'\"()-")] = 29
    return c


_CLASS = _classes()
_BLANK = np.isin(np.arange(256), [9, 11, 12, 13, 32])
_BREAK = np.arange(256) == 10
_END = np.isin(np.arange(256), list(b".!?:;"))
_STOP = np.isin(np.arange(256), list(b".!?"))
_UPPER = (np.arange(256) >= 65) & (np.arange(256) < 91)
_ALNUM = _CLASS <= 26
_LETTER = (_CLASS <= 25) | (_CLASS == 31)
_SYMBOL = _CLASS == 30


def _common_table() -> np.ndarray:
    table = np.zeros(1 << _BITS, np.uint8)
    for bit, lang in enumerate(LANGS):
        table[(words([" ".join(COMMON[lang])]).hash >> np.uint64(64 - _BITS)).astype(np.int64)] |= np.uint8(1 << bit)
    return table


_TABLE: list[np.ndarray] = []


def common_bits(hashes: np.ndarray) -> np.ndarray:
    """Bit l of each word: whether it's a common word of language l."""
    if not _TABLE:
        _TABLE.append(_common_table())
    return _TABLE[0][(hashes >> np.uint64(64 - _BITS)).astype(np.int64)]


def buffer(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, each ended by a line break, and each text's first byte (n + 1 entries)."""
    raw = [(t or "").replace("\r\n", "\n").replace("\r", "\n").replace("\u00a0", " ").encode("utf-8", "replace") + b"\n" for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])


def sequence_counts(texts: list[str | None]) -> np.ndarray:
    """How often each class of byte follows each other, over all texts; blanks in a row count once."""
    data, _ = buffer(texts)
    c = _CLASS[data]
    c = c[np.concatenate([[True], (c[1:] != 27) | (c[:-1] != 27)])]
    return np.bincount(c[:-1] * CLASSES + c[1:], minlength=CLASSES * CLASSES)


def sequence_model(counts: np.ndarray) -> np.ndarray:
    """log2 P(next class | class), add-one smoothed, of summed counts."""
    m = counts.reshape(CLASSES, CLASSES) + 1.0
    return np.log2(m / m.sum(axis=1, keepdims=True)).ravel()


def _per(first: np.ndarray, x: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(x, dtype=np.float64)])
    return sums[first[1:]] - sums[first[:-1]]


def statistics(texts: list[str | None], model: np.ndarray, w: Words | None = None) -> dict[str, np.ndarray]:
    """The statistics FIELDS of each text. chars counts bytes that are not blank, foreign_ratio those beyond ASCII. Line shares weigh a line by its characters; sequence_score is the mean of the model over the text."""
    data, first = buffer(texts)
    w = w or words(texts)
    cls = _CLASS[data]
    blank = _BLANK[data] | _BREAK[data]
    solid = np.maximum(_per(first, ~blank), 1)
    out = {"chars": _per(first, ~blank), "words": np.diff(w.first).astype(float)}
    out["mean_word_length"] = _per(w.first, w.end - w.start) / np.maximum(out["words"], 1)
    out["symbol_ratio"] = _per(first, _SYMBOL[data]) / solid
    out["foreign_ratio"] = _per(first, cls == 31) / solid
    out["digit_ratio"] = _per(first, cls == 26) / solid
    bits = common_bits(w.hash)
    count = np.stack([_per(w.first, (bits >> b) & 1) for b in range(len(LANGS))])
    out["lang"] = np.where(count.max(axis=0) > 0, count.argmax(axis=0), 0)
    out["common_ratio"] = count.max(axis=0) / np.maximum(out["words"], 1)

    step = np.concatenate([model[cls[:-1] * CLASSES + cls[1:]], [0.0]])
    counted = np.concatenate([(cls[1:] != 27) | (cls[:-1] != 27), [False]])
    counted[first[1:] - 1] = False
    out["sequence_score"] = _per(first, step * counted) / np.maximum(_per(first, counted), 1)

    # Lines: [start, stop) without the break; blank ones are left out.
    stop = np.flatnonzero(_BREAK[data])
    start = np.concatenate([[0], stop[:-1] + 1])
    solids = np.concatenate([[0], np.cumsum(~blank)])
    size = solids[stop] - solids[start]
    start, stop, size = start[size > 0], stop[size > 0], size[size > 0]
    if not len(start):
        zero = np.zeros(len(texts))
        return out | {n: zero for n in _NAMES if n not in out}
    place = np.flatnonzero(~blank)
    head, tail = place[solids[start]], place[solids[stop] - 1]
    text_of = np.searchsorted(first, start, "right") - 1

    def between(flag: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flag)])
        return sums[stop] - sums[start]

    token = ~blank & np.concatenate([[True], blank[:-1]])
    tokens = between(token)
    letters = np.concatenate([[0], np.cumsum(_LETTER[data])])
    begin = np.flatnonzero(token)
    finish = np.flatnonzero(~blank & np.concatenate([blank[1:], [True]])) + 1
    plain = np.zeros(len(data), bool)
    plain[begin[letters[finish] == letters[begin]]] = True  # tokens without a letter
    figures = between(plain)
    gap = blank & np.concatenate([[False], blank[:-1]]) & np.concatenate([[False], ~(blank[:-1] & np.concatenate([[False], blank[:-2]]))])
    gap[first[:-1]] = False
    tight = np.concatenate([~blank[1:], [False]])  # not followed by a blank
    bars, tabs = between(data == ord("|")), between(data == 9)
    semis = between((data == ord(";")) & tight) + between((data == ord(",")) & tight & ~np.concatenate([_ALNUM[data[1:]] & (data[1:] < 58), [False]]))
    inner_gap = between(gap & (np.arange(len(data)) > 0))
    cells = 1 + np.maximum.reduce([np.maximum(bars - 1, 0), tabs, semis, np.where((head == start) | (inner_gap > 1), inner_gap, 0)])
    pieces = np.maximum(tokens - between((data == ord("|")) & token), 1)
    leader = between((data == ord(".")) & np.concatenate([data[1:] == ord("."), [False]]))
    blanks_to_fill = between((data == ord("_")) & np.concatenate([data[1:] == ord("_"), [False]]))
    form = (blanks_to_fill >= 4) & (blanks_to_fill * 2 >= size - 12)
    cell = ~form & (leader < 3) & (((figures * 2 >= tokens) & (tokens >= 3)) | ((cells >= 3) & (pieces <= 3 * cells)) | ((tabs >= 1) & (pieces <= 4 * cells)))
    h = data[head]
    marked = _SYMBOL[h] | (h == ord("-")) | (h == ord("(")) | ((h >= 48) & (h < 58)) | ((h >= 65) & (h < 91)) | (h >= 128)
    # A line that ends a sentence is an entry only with an initial in it, as in references.
    ended = _STOP[data[tail]]
    initial = between(_UPPER[data] & np.concatenate([data[1:] == ord("."), [False]]) & np.concatenate([[False], blank[:-1]]))
    entry = ~form & ~cell & (((tokens <= 9) & marked & (size <= 20 * tokens) & (~ended | (initial > 0))) | (leader >= 3))
    weight = size.astype(float)
    whole = np.maximum(np.bincount(text_of, weight, len(texts)), 1)
    for name, flag in (("entry_ratio", entry), ("cell_ratio", cell), ("form_ratio", form)):
        out[name] = np.bincount(text_of, weight * flag, len(texts)) / whole
    lines = np.maximum(np.bincount(text_of, minlength=len(texts)), 1)
    out["line_end_ratio"] = np.bincount(text_of, _END[data[tail]], len(texts)) / lines
    return out
