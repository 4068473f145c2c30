"""Near-duplicate records with small edits: Order MinHash sketches, then verification of the candidates.

Order MinHash (Marcais et al. 2019) samples, for each of several random orders, the least few occurrence-labelled k-mers of a
text and keeps them in text order, so that a shared sketch speaks for similar content in a similar sequence. Candidates are aligned within a
band, which gives their edit similarity, and compared by their exact shingle sets, which decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamplight.llm.alignment import aligned
from lamplight.llm.lsh import candidate_pairs, key_filter, may_be_in
from lamplight.llm.words import batches, characters, distinct, grams, mix, occurrence_labelled, owner, segment_min, sequence_hash, words
from lamplight.session import materialize

_MAX = np.uint64(2**64 - 1)
#: Half of a sampled value is the k-mer's hash, half its place, so places are told apart in texts of up to 2**32 k-mers.
_HALF = np.uint64(32)
_PLACE = np.uint64(2**32 - 1)


def _units(texts: list[str | None], unit: str) -> tuple[np.ndarray, np.ndarray]:
    if unit == "char":
        return characters(texts)
    w = words(texts)
    return w.hash, w.first


def sketch_keys(h: np.ndarray, first: np.ndarray, k: int, sample: int, tables: int) -> np.ndarray:
    """A bucket key of each text (rows) in each table (columns): that table's least `sample` k-mers, in text order."""
    g, f = grams(h, first, k)
    g = occurrence_labelled(g, f)
    own = owner(f)
    place = (np.arange(len(g)) - f[:-1][own]).astype(np.uint64)
    keys = np.empty((len(first) - 1, tables), np.uint64)
    with np.errstate(over="ignore"):
        for t in range(tables):
            v = (mix(g, t + 1) & ~_PLACE) | place
            taken = []
            for s in range(sample):
                if s:
                    v = np.where(v == taken[-1][own], _MAX, v)
                taken.append(segment_min(v, f))
            x = np.sort([(m << _HALF) | (m >> _HALF) for m in taken], axis=0)  # by place
            key = np.full(len(first) - 1, t, np.uint64)
            for m in x:
                key = mix(key * np.uint64(0x9FB21C651E98DF25) + (m & _PLACE))
            keys[:, t] = key
    return keys


def bin_sketch(d: np.ndarray, first: np.ndarray) -> np.ndarray:
    """256 bits a text: of each of 64 ranges of the shingle hashes (48 bits, ascending) the least one, as 1 to 15; 0 for none."""
    own = owner(first)
    bins = own * 64 + (d >> np.uint64(42)).astype(np.int64)
    at = np.flatnonzero(np.concatenate([[True], bins[1:] != bins[:-1]])) if len(d) else np.empty(0, np.int64)
    out = np.zeros((len(first) - 1) * 64, np.uint64)
    with np.errstate(over="ignore"):
        out[bins[at]] = mix(d[at]) % np.uint64(15) + np.uint64(1)
    shift = np.uint64(4) * np.arange(16, dtype=np.uint64)
    return np.bitwise_or.reduce(out.reshape(-1, 4, 16) << shift, axis=2)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64))


def _map(what: str, unit: str, k: int, sample: int, tables: int, shingle: int, least: int, wanted, it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of texts(id, text) the 'keys' (key, class, sketch), the 'classes' (id, class), or the unit 'sequences' of the wanted classes."""
    for batch in it:
        ids, texts = batch.column(0), batch.column(1).to_pylist()
        for i, j in batches(texts):
            h, first = _units(texts[i:j], unit)
            keep = np.flatnonzero(np.diff(first) >= least)
            if not len(keep):
                continue
            count = np.diff(first)[keep]
            begin = np.concatenate([[0], np.cumsum(count)])
            h = h[np.arange(begin[-1]) + np.repeat(first[:-1][keep] - begin[:-1], count)]
            cls = sequence_hash(h, begin)
            if what == "classes":
                yield pa.RecordBatch.from_arrays([ids.slice(i, j - i).take(pa.array(keep)), _signed(cls)], ["id", "cls"])
                continue
            _, once = np.unique(cls, return_index=True)
            if what == "keys":
                keys = sketch_keys(h, begin, k, sample, tables)[once]
                s = bin_sketch(*distinct(*grams(h, begin, shingle)))[once]
                yield pa.RecordBatch.from_arrays([_signed(keys.ravel()), *(_signed(np.repeat(x, tables)) for x in (cls[once], *s.T))], ["key", "id", "s0", "s1", "s2", "s3"])
                continue
            once = once[may_be_in(wanted.value, cls[once])]
            size = count[once]
            flat = h[np.arange(size.sum()) + np.repeat(begin[once] - np.concatenate([[0], np.cumsum(size)[:-1]]), size)]
            yield pa.RecordBatch.from_arrays([_signed(cls[once]), pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), _signed(flat))], ["cls", "units"])


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list column, and where each list begins (n + 1 entries)."""
    first = column.offsets.to_numpy().astype(np.int64)
    return column.values.to_numpy(zero_copy_only=False)[first[0] : first[-1]].view(np.uint64), first - first[0]


def _verify(shingle: int, threshold: float, band: int, it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of pairs(a, b, units of a, units of b) those that reach the threshold, with both similarities."""
    for batch in it:
        for i in range(0, len(batch), 2000):
            part = batch.slice(i, 2000)
            (x, fx), (y, fy) = _lists(part.column(2)), _lists(part.column(3))
            (gx, ex), (gy, ey) = distinct(*grams(x, fx, shingle)), distinct(*grams(y, fy, shingle))
            both = np.sort(np.concatenate([(owner(ex).astype(np.uint64) << np.uint64(48)) | gx, (owner(ey).astype(np.uint64) << np.uint64(48)) | gy]))
            common = np.bincount((both[1:][both[1:] == both[:-1]] >> np.uint64(48)).astype(np.int64), minlength=len(part))
            jaccard = common / np.maximum(np.diff(ex) + np.diff(ey) - common, 1)
            good = np.flatnonzero(jaccard >= threshold)
            if not len(good):
                continue
            n, m = np.diff(fx)[good], np.diff(fy)[good]
            take = lambda v, f, size: v[np.arange(size.sum()) + np.repeat(f[:-1][good] - np.concatenate([[0], np.cumsum(size)[:-1]]), size)]
            d = aligned(take(x, fx, n), np.concatenate([[0], np.cumsum(n)]), take(y, fy, m), np.concatenate([[0], np.cumsum(m)]), band)
            edit = pa.array(1 - d / np.maximum(np.maximum(n, m), 1), mask=d > band)
            rows = pa.array(good)
            yield pa.RecordBatch.from_arrays([part.column(0).take(rows), part.column(1).take(rows), pa.array(jaccard[good]), edit], ["a", "b", "similarity", "edit_similarity"])


def _nonzero_nibbles(x: np.ndarray) -> np.ndarray:
    y = x | (x >> np.uint64(1))
    y |= y >> np.uint64(2)
    return np.bitwise_count(y & np.uint64(0x1111111111111111)).sum(1, dtype=np.int64)


def _may_reach(threshold: float, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the sketches of each pair, as rows of a and b, leave the threshold within four standard deviations."""
    a, b = np.ascontiguousarray(a).view(np.uint64), np.ascontiguousarray(b).view(np.uint64)
    differ, filled = _nonzero_nibbles(a ^ b), _nonzero_nibbles(a | b)
    return filled - differ >= threshold * filled - 2.0 * np.sqrt(filled)


class NearDuplicates:
    """Near-duplicate records of df by text similarity.

    Two texts are near duplicates if the Jaccard similarity of their distinct `shingle`-unit sequences reaches `threshold`.
    Units are words (runs of a-z and 0-9 after lower-casing) or lower-cased characters. Texts of equal unit sequences form a
    class; candidates are sought between classes only, so a hot group of copies costs one sketch a batch of rows.

    Candidates share, in at least one of `tables` random orders, the `sample` least occurrence-labelled k-mers in equal text order.
    A bit sketch (64 bins), which goes along with the keys, discards pairs that are out of reach by four standard deviations where a bucket is
    read, before they're written or shuffled. The unit sequences of what's left, found by a
    filter of fixed size whatever the number of records, meet once, are compared by their exact shingle sets and aligned within `band` edits.

    Texts that are null or have fewer than `least` units belong to no class and have no row. Ids that repeat count as one record.
    An empty table gives empty results.
    """

    def __init__(self, df: DataFrame, id_col: str, text_col: str, *, unit: str = "word", shingle: int = 3, threshold: float = 0.5, least: int = 20, k: int = 4, sample: int = 2, tables: int = 28, band: int = 32, name: str = "omh"):
        self.threshold, self.shingle, self.band, self.name = threshold, shingle, band, name
        self.rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull())
        self.kind = dict(self.rows.dtypes)["id"]
        self._args = (unit, k, sample, tables, shingle, max(least, shingle))
        self.classes = materialize(self._mapped("classes", f"id {self.kind}, cls long"), f"{name}-classes")

    def _mapped(self, what: str, schema: str, wanted=None) -> DataFrame:
        return self.rows.mapInArrow(partial(_map, what, *self._args, wanted), schema)

    def class_pairs(self) -> DataFrame:
        """(a, b, similarity, edit_similarity): classes a < b whose similarity reaches the threshold.

        edit_similarity is 1 less the units edited, as a share of the longer text's; null beyond `band` edits, as when passages are reordered.
        """
        keys = self._mapped("keys", "key long, id long, s0 long, s1 long, s2 long, s3 long")
        near = materialize(candidate_pairs(keys, f"{self.name}-candidates", keep=partial(_may_reach, self.threshold)), f"{self.name}-near")
        wanted = key_filter(near.select("a").unionByName(near.select(F.col("b").alias("a"))), 2 * near.count())
        units = materialize(self._mapped("sequences", "cls long, units array<long>", wanted).dropDuplicates(["cls"]), f"{self.name}-units")
        both = near.join(units.select(F.col("cls").alias("a"), F.col("units").alias("ua")), "a").join(units.select(F.col("cls").alias("b"), F.col("units").alias("ub")), "b")
        return both.select("a", "b", "ua", "ub").mapInArrow(partial(_verify, self.shingle, self.threshold, self.band), "a long, b long, similarity double, edit_similarity double")

    def members(self) -> DataFrame:
        """(id, cls, representative, copies): one row a record, its class, the class's least id and how many records it has."""
        sizes = self.classes.groupBy("cls").agg(F.countDistinct("id").alias("copies"), F.min("id").alias("representative"))
        return self.classes.select("id", "cls").distinct().join(sizes, "cls").select("id", "cls", "representative", "copies")

    def representative_pairs(self) -> DataFrame:
        """(key_a, key_b, similarity, edit_similarity): every two near classes by their least ids, key_a < key_b."""
        least = self.classes.groupBy("cls").agg(F.min("id").alias("id"))
        pairs = self.class_pairs().join(least.select(F.col("cls").alias("a"), F.col("id").alias("x")), "a").join(least.select(F.col("cls").alias("b"), F.col("id").alias("y")), "b")
        return pairs.select(F.least("x", "y").alias("key_a"), F.greatest("x", "y").alias("key_b"), "similarity", "edit_similarity")

    def record_pairs(self, expand: int) -> DataFrame:
        """(key_a, key_b): representative_pairs() and members() put together as pairs of records, key_a < key_b.

        A class of at most `expand` copies is multiplied out, within itself and with its near classes. A larger one isn't: each copy is
        paired with the class's least id, and that one with the records of near classes, so no link between different texts is lost and a
        hot group of n copies gives n pairs. Which it is can be seen from members().copies.
        """
        members = materialize(self.members(), f"{self.name}-members")
        small = F.col("copies") <= expand
        shown = members.where(small | (F.col("id") == F.col("representative"))).select("id", "cls", "copies")
        across = self.class_pairs().select("a", "b").join(shown.select(F.col("cls").alias("a"), F.col("id").alias("x")), "a").join(shown.select(F.col("cls").alias("b"), F.col("id").alias("y")), "b")
        several = members.where(small & (F.col("copies") > 1))
        within = several.select("cls", F.col("id").alias("x")).join(several.select("cls", F.col("id").alias("y")), "cls").where("x < y")
        star = members.where(~small & (F.col("id") != F.col("representative"))).select(F.col("representative").alias("x"), F.col("id").alias("y"))
        every = across.select("x", "y").unionByName(within.select("x", "y")).unionByName(star)
        return every.select(F.least("x", "y").alias("key_a"), F.greatest("x", "y").alias("key_b"))


def _sequence_classes(unit: str, it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, cls): the hash of each text's unit sequence, null for a text without units."""
    for batch in it:
        texts = batch.column(1).to_pylist()
        for i, j in batches(texts):
            h, first = _units(texts[i:j], unit)
            cls = sequence_hash(h, first).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(cls, mask=np.diff(first) == 0)], ["id", "cls"])


def near_duplicate_records(df: DataFrame, id_col: str, text_col: str, *, every: bool = False, **options) -> DataFrame:
    """(id, class_id, copies, links): one row a record, the class of its exact unit sequence, how many records share it, and how many other classes are near it.

    Records whose text is null or has fewer than `least` units have no row, unless `every` is set: then those of equal unit
    sequences form a class too, a text without units is a class of its own, and neither has links.
    """
    op = NearDuplicates(df, id_col, text_col, **options)
    pairs = op.class_pairs()
    degree = pairs.select(F.explode(F.array("a", "b")).alias("cls")).groupBy("cls").agg(F.count("*").alias("links"))
    classes = op.classes.select("id", "cls").distinct()
    if every:
        ids = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("id is not null")
        short = ids.mapInArrow(partial(_sequence_classes, op._args[0]), f"id {op.kind}, cls long").groupBy("id").agg(F.min("cls").alias("cls"))
        rest = short.join(classes.select("id").distinct(), "id", "left_anti").select("id", F.coalesce("cls", F.xxhash64(F.lit("without units"), "id")).alias("cls"))
        classes = materialize(classes.unionByName(rest), f"{op.name}-records")
    sizes = classes.groupBy("cls").agg(F.count("*").alias("copies"))
    return classes.join(sizes, "cls").join(degree, "cls", "left").select("id", F.col("cls").alias("class_id"), "copies", F.coalesce("links", F.lit(0)).alias("links"))
