"""Reading level of documents: a regularised sentence classifier on character and word features, aggregated and calibrated.

Sentences of labelled documents carry the document's band and train a softmax model over hashed words, hashed four-character
sequences and a few length measures, with an L2 penalty. A document's level distribution is the mean over its sentences; a second, small
softmax model, fitted on labelled documents that the first one hasn't seen, turns the distribution and the document's length
measures into a calibrated band.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lamplight.llm.quality import STATS, kind_of, learn_sequences, scored, stats_columns
from lamplight.llm.text_stats import FIELDS
from lamplight.llm.words import Words, batches, words
from lamplight.session import materialize

BANDS = ["primary", "secondary", "college", "specialist"]
#: Labelled documents that the models are fitted on at most, those of least id hash.
TRAINING_DOCUMENTS = 1500
_WORD_BITS, _CHAR_BITS, _DENSE = 15, 17, 6
_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[65:91] += 32
_FOLD[[9, 10, 11, 12, 13]] = 32
_END, _SPACE = np.isin(np.arange(256), list(b".!?")), np.isin(np.arange(256), [9, 10, 13, 32])
_CLOSE = np.isin(np.arange(256), list(b"\"')"))
_VOWEL = np.isin(np.arange(256), list(b"aeiouy"))


class Sentences:
    """The sentences of a batch: byte and word bounds, the document of each, and dense features."""

    def __init__(self, texts: list[str | None]):
        w: Words = words([(t or "").replace("\r\n", "\n") for t in texts])
        data = w.data
        after = np.concatenate([data[1:], [0]])
        last = np.concatenate([data[2:], [0, 0]])
        ends = _END[data] & (_SPACE[after] | (after == 0) | (_CLOSE[after] & (_SPACE[last] | (last == 0)))) | ((data == 10) & (after == 10)) | (data == 0)
        stop = np.flatnonzero(ends) + 1
        word_at = np.searchsorted(w.start, np.concatenate([[0], stop]))
        size = np.diff(word_at)
        keep = np.flatnonzero(size >= 3)
        self.word_first, self.word_last = word_at[:-1][keep], word_at[1:][keep]
        self.data, self.w = data, w
        self.first, self.last = w.start[self.word_first], w.end[self.word_last - 1]
        self.doc = np.searchsorted(w.first, self.word_first, "right") - 1
        n = (self.word_last - self.word_first).astype(float)
        length = np.concatenate([[0], np.cumsum(w.end - w.start)])
        long = np.concatenate([[0], np.cumsum(w.end - w.start >= 10)])
        vowel = _VOWEL[data] & ~np.concatenate([[False], _VOWEL[data[:-1]]])
        beats = np.concatenate([[0], np.cumsum(vowel)])
        per = lambda x: (x[self.word_last] - x[self.word_first]) / n
        syllables = (beats[self.last] - beats[self.first]) / n
        self.words = n
        self.dense = np.stack([np.log(n) - 2.8, n / 20 - 1, per(length) - 5, per(long) * 4, syllables - 1.7, np.ones(len(n))], axis=1)

    def word_index(self) -> np.ndarray:
        return (self.w.hash >> np.uint64(64 - _WORD_BITS)).astype(np.int64)

    def char_index(self) -> np.ndarray:
        """Of each byte, the bucket of the four characters that begin there."""
        c = _FOLD[self.data]
        c = np.concatenate([c, np.zeros(3, np.uint32)])
        h = (c[:-3] * np.uint32(0x9E3779B1)) ^ (c[1:-2] * np.uint32(0x85EBCA77)) ^ (c[2:-1] * np.uint32(0xC2B2AE3D)) ^ (c[3:] * np.uint32(0x27D4EB2F))
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        return (h >> np.uint32(32 - _CHAR_BITS)).astype(np.int64)


def _sums(weights: np.ndarray, index: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Per sentence, the summed rows weights[index[first:last]], all classes in one pass; no sentence is empty, and they don't overlap."""
    rows = np.take(weights, np.append(index, 0), axis=0)
    return np.add.reduceat(rows, np.stack([first, last], axis=1).ravel(), axis=0)[::2].astype(np.float64)


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


class SentenceModel:
    """A softmax model over a sentence's mean word weights, mean character weights and dense features."""

    def __init__(self, classes: int):
        self.word = np.zeros((1 << _WORD_BITS, classes), np.float32)
        self.char = np.zeros((1 << _CHAR_BITS, classes), np.float32)
        self.dense = np.zeros((_DENSE, classes))

    def probabilities(self, s: Sentences) -> np.ndarray:
        if not len(s.words):
            return np.empty((0, self.dense.shape[1]))
        z = _sums(self.word, s.word_index(), s.word_first, s.word_last) / np.sqrt(s.words)[:, None]
        z += _sums(self.char, s.char_index(), s.first, s.last) / np.sqrt(s.last - s.first)[:, None]
        return _softmax(z + s.dense @ self.dense)

    def fit(self, s: Sentences, label: np.ndarray, rounds: int = 40, rate: float = 0.5, penalty: float = 1e-4) -> SentenceModel:
        """Full-batch gradient descent with momentum; sentences of each band weigh the same in all."""
        classes = self.dense.shape[1]
        words_of = np.repeat(np.arange(len(label)), s.word_last - s.word_first)
        wi = s.word_index()[np.arange(len(words_of)) + np.repeat(s.word_first - np.concatenate([[0], np.cumsum(s.word_last - s.word_first)[:-1]]), s.word_last - s.word_first)]
        size = s.last - s.first
        chars_of = np.repeat(np.arange(len(label)), size)
        ci = s.char_index()[np.arange(len(chars_of)) + np.repeat(s.first - np.concatenate([[0], np.cumsum(size)[:-1]]), size)]
        wv, cv = 1 / np.sqrt(s.words), 1 / np.sqrt(size)
        share = 1 / np.maximum(np.bincount(label, minlength=classes), 1)[label]
        share /= share.sum()
        target = np.eye(classes)[label]
        speed = [np.zeros(x.shape) for x in (self.word, self.char, self.dense)]
        scale = [60.0, 60.0, 1.0]
        for _ in range(rounds):
            error = (self.probabilities(s) - target) * share[:, None]
            grads = [
                np.stack([np.bincount(wi, (error[:, c] * wv)[words_of], len(self.word)) for c in range(classes)], axis=1),
                np.stack([np.bincount(ci, (error[:, c] * cv)[chars_of], len(self.char)) for c in range(classes)], axis=1),
                s.dense.T @ error,
            ]
            for i, x in enumerate((self.word, self.char, self.dense)):
                speed[i] = 0.8 * speed[i] - rate * scale[i] * (grads[i] + penalty * x)
                x += speed[i].astype(x.dtype)
        return self


def document_features(model: SentenceModel, texts: list[str | None]) -> np.ndarray:
    """Per document: mean level distribution by sentence and by word, mean dense features, and the logarithm of its sentences' mean length."""
    s = Sentences(texts)
    p = model.probabilities(s)
    n = len(texts)
    count = np.maximum(np.bincount(s.doc, minlength=n), 1)
    total = np.maximum(np.bincount(s.doc, s.words, n), 1)
    mean = lambda x: np.bincount(s.doc, x, n) / count
    by_word = lambda x: np.bincount(s.doc, x * s.words, n) / total
    level = p @ np.arange(p.shape[1])
    cols = [mean(p[:, c]) for c in range(p.shape[1])] + [by_word(p[:, c]) for c in range(p.shape[1])]
    cols += [mean(s.dense[:, c]) for c in range(_DENSE - 1)] + [by_word(s.dense[:, c]) for c in (2, 3, 4)] + [mean(level), by_word(level), np.log(total / count) - 2.8, np.ones(n)]
    return np.stack(cols, axis=1)


#: Of the labelled documents of each band, the share that the sentence model is fitted on; the rest calibrates it.
FITTED = 0.6


class ReadingModel:
    """Sentence model, fitted on one part of (text, band) pairs, and calibration, fitted on that model's outputs for the other part."""

    def __init__(self, texts: list[str], bands: list[str], penalty: float = 1e-3):
        label = np.array([BANDS.index(b) for b in bands], np.int64)
        fitted = np.zeros(len(texts), bool)  # evenly spread within each band
        for b in range(len(BANDS)):
            at = np.flatnonzero(label == b)
            fitted[at] = np.floor(np.arange(1, len(at) + 1) * FITTED) > np.floor(np.arange(len(at)) * FITTED)
        s = Sentences([t for t, h in zip(texts, fitted, strict=True) if h])
        self.model = SentenceModel(len(BANDS))
        if len(s.words):
            self.model.fit(s, label[fitted][s.doc])
        x, label = document_features(self.model, [t for t, h in zip(texts, fitted, strict=True) if not h] or [""]), label[~fitted]
        x = x[: len(label)]
        self.center, self.scale = (x.mean(axis=0), x.std(axis=0) + 1e-6) if len(x) else (np.zeros(x.shape[1]), np.ones(x.shape[1]))
        self.center[-1], self.scale[-1] = 0, 1
        x = (x - self.center) / self.scale
        share = 1 / np.maximum(np.bincount(label, minlength=len(BANDS)), 1)[label]
        share /= max(share.sum(), 1e-9)
        target, z, speed = np.eye(len(BANDS))[label], np.zeros((x.shape[1], len(BANDS))), 0.0
        for _ in range(400):
            error = (_softmax(x @ z) - target) * share[:, None]
            speed = 0.9 * speed - 0.3 * (x.T @ error + penalty * z)
            z = z + speed
        self.calibration = z

    def probabilities(self, texts: list[str | None]) -> np.ndarray:
        return _softmax(((document_features(self.model, texts) - self.center) / self.scale) @ self.calibration)


def _levels(shared, sequences: np.ndarray, it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    model: ReadingModel = shared.value
    for batch in it:
        texts = batch.column(1).to_pylist()
        for i, j in batches(texts):
            p = model.probabilities(texts[i:j])
            best = p.argmax(axis=1)
            cols = [pa.array([BANDS[b] for b in best]), pa.array(p.max(axis=1)), pa.array(p @ np.arange(len(BANDS)))]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), *cols, *stats_columns(texts[i:j], sequences)], ["id", "band", "confidence", "difficulty", *(f for f in FIELDS if f != "lang"), "lang"])


def training_set(df: DataFrame, id_col: str, text_col: str, labels: DataFrame, most: int = TRAINING_DOCUMENTS) -> tuple[list[str], list[str]]:
    """Texts and bands of at most `most` labelled documents: the band most raters gave; documents without a clear one are left out."""
    votes = labels.where(F.col("band").isin(BANDS)).select("doc_id", "rater", "band").distinct().groupBy("doc_id", "band").count()
    rank = Window.partitionBy("doc_id").orderBy(F.desc("count"))
    clear = votes.withColumn("next", F.lead("count").over(rank)).withColumn("place", F.row_number().over(rank)).where("place = 1 and (next is null or next < count)")
    chosen = clear.select("doc_id", "band").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where("text is not null").join(chosen, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").select("text", "band").collect()
    return [r.text for r in rows], [r.band for r in rows]


def reading_levels(df: DataFrame, id_col: str, text_col: str, labels: DataFrame, most: int = TRAINING_DOCUMENTS, name: str = "reading") -> DataFrame:
    """(id, band, confidence, difficulty, kind, statistics): the band of each text, and what kind of text it is.

    labels has doc_id, rater and band; nulls, repeats and disagreement are settled by majority. Two bounded things reach the driver: the
    texts of at most `most` labelled documents, and the sequence counts. Every document is scored whole, in one pass without a
    shuffle. A null or blank text has kind null, and its band means nothing; without labels every band is equally likely. Empty tables
    give no rows.
    """
    sequences = learn_sequences(df, text_col)
    shared = df.sparkSession.sparkContext.broadcast(ReadingModel(*training_set(df, id_col, text_col, labels, most)))
    kind = dict(df.dtypes)[id_col]
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = materialize(rows.mapInArrow(partial(_levels, shared, sequences), f"id {kind}, band string, confidence double, difficulty double, {STATS}"), name)
    return scored(out).withColumn("kind", kind_of())


def english_prose(levels: DataFrame, least_words: int = 40) -> DataFrame:
    """Of reading_levels(): the documents that are mainly English prose of so many words."""
    return levels.where((F.col("kind") == "prose") & (F.col("lang") == "en") & (F.col("words") >= least_words))
