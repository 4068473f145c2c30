"""Candidate pairs from hash buckets, with hot buckets cut into blocks, and filters of fixed size for keys."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamplight.llm.words import mix
from lamplight.session import materialize

PAIRS = "a long, b long, bucket long, part int, parts int, ids array<long>, more array<long>"
_SCHEMA = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("bucket", pa.int64()), ("part", pa.int32()), ("parts", pa.int32()), ("ids", pa.list_(pa.int64())), ("more", pa.list_(pa.int64()))])
#: Whether the sketches of each pair, as rows of two equal tables, let it be one.
Keep = Callable[[np.ndarray, np.ndarray], np.ndarray]


def _pairs_of_sorted(block: int, keep: Keep | None, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by key, id, with sketches after these. Small buckets give the pairs a < b that keep lets pass, large ones their ids and sketches in blocks (bucket, part, parts, ids, more)."""

    def out(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), *(pa.nulls(len(a), f.type) for f in list(_SCHEMA)[2:])], schema=_SCHEMA)

    def bucket(key: int, ids: np.ndarray, more: np.ndarray) -> Iterator[pa.RecordBatch]:
        starts = range(0, len(ids), block)
        for n, i in enumerate(starts):
            none = pa.nulls(1, pa.int64())
            lists = (pa.array([x[i : i + block].ravel()], pa.list_(pa.int64())) for x in (ids, more))
            yield pa.RecordBatch.from_arrays([none, none, pa.array([key]), pa.array([n], pa.int32()), pa.array([len(starts)], pa.int32()), *lists], schema=_SCHEMA)

    def emit(key: np.ndarray, one: np.ndarray, more: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(key):
            return
        fresh = np.concatenate([[True], (key[1:] != key[:-1]) | (one[1:] != one[:-1])])
        key, one, more = key[fresh], one[fresh], more[fresh]
        edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
        size = np.diff(edge)
        for i in np.flatnonzero(size > block):
            yield from bucket(int(key[edge[i]]), one[edge[i] : edge[i + 1]], more[edge[i] : edge[i + 1]])
        cold = np.repeat((size > 1) & (size <= block), size)
        key, one, more = key[cold], one[cold], more[cold]
        first, gap = np.arange(len(key)), 0  # of the rows whose bucket goes on beyond the gap
        while len(first):
            gap += 1
            first = first[: np.searchsorted(first, len(key) - gap)]
            first = first[key[first] == key[first + gap]]
            for i in range(0, len(first), 100_000):
                x = first[i : i + 100_000]
                x = x[keep(more[x], more[x + gap])] if keep else x
                if len(x):
                    yield out(one[x], one[x + gap])

    waiting: list[tuple[np.ndarray, ...]] = []  # the bucket that may go on in the next batch
    for batch in batches:
        key, one = (batch.column(c).to_numpy(zero_copy_only=False) for c in range(2))
        more = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[2:]], 1) if batch.num_columns > 2 else np.empty((len(key), 0), np.int64)
        if not len(key):
            continue
        if waiting and waiting[0][0][0] != key[-1]:
            first = int(np.searchsorted(key, key[-1]))
            waiting.append((key[:first], one[:first], more[:first]))
            yield from emit(*map(np.concatenate, zip(*waiting, strict=True)))
            waiting = [(key[first:], one[first:], more[first:])]
        elif not waiting:
            first = int(np.searchsorted(key, key[-1]))
            yield from emit(key[:first], one[:first], more[:first])
            waiting = [(key[first:], one[first:], more[first:])]
        else:
            waiting.append((key, one, more))
    if waiting:
        yield from emit(*map(np.concatenate, zip(*waiting, strict=True)))


def _pairs_of_two_blocks(keep: Keep, it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs a < b of each row's two blocks (ids, sketches, ids, sketches) that keep lets pass."""
    for batch in it:
        for r in range(len(batch)):
            xs, xm, ys, ym = (batch.column(c)[r].values.to_numpy(zero_copy_only=False) for c in range(4))
            xm, ym = xm.reshape(len(xs), -1), ym.reshape(len(ys), -1)
            step = max(1, 200_000 // max(1, len(ys)))
            for i in range(0, len(xs), step):
                a, b = np.nonzero(xs[i : i + step, None] < ys[None, :])
                a += i
                good = keep(xm[a], ym[b])
                yield pa.RecordBatch.from_arrays([pa.array(xs[a[good]]), pa.array(ys[b[good]])], ["a", "b"])


def pairs_of_blocks(hot: DataFrame, columns: list[str]) -> DataFrame:
    """(xs, ys) of every two blocks of one bucket, a block with itself included, as structs of `columns`; hot has bucket, part, parts and these.

    Each block is sent to its partners by a row for each, and blocks are spread before that, so the work of a hot bucket falls to all tasks.
    """
    each = hot.repartition(F.xxhash64("bucket", "part")).select("bucket", "part", F.struct(*columns).alias("x"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("with"))
    met = each.groupBy("bucket", F.least("part", "with").alias("lo"), F.greatest("part", "with").alias("hi")).agg(F.sort_array(F.collect_list(F.struct("part", "x"))).alias("both"))
    return met.select(F.get("both", F.lit(0))["x"].alias("xs"), F.element_at("both", -1)["x"].alias("ys"))


def candidate_pairs(rows: DataFrame, name: str, block: int = 512, keep: Keep | None = None) -> DataFrame:
    """The distinct pairs (a < b) of ids that share a bucket in rows(key long, id long) and that keep, if given, lets pass by their sketches.

    Sketches are the long columns after these two, the same in every row of an id. Pairs that share a bucket by chance grow with the square of
    the rows; keep meets them where they arise, so that they cost time and are neither written nor shuffled.

    One shuffle by key; ids of a bucket are streamed in order, so that a bucket takes eight bytes an id, and its sketch. A bucket of more
    than `block` ids leaves as blocks of ids, which meet each other and are multiplied out spread over all tasks: no task
    holds more than block * block pairs at a time, and no pair is left out. An empty table gives no pairs.
    """
    ordered = rows.repartition("key").sortWithinPartitions("key", "id")
    found = materialize(ordered.mapInArrow(partial(_pairs_of_sorted, block, keep), PAIRS), name)
    if keep:
        met = pairs_of_blocks(found.where("ids is not null"), ["ids", "more"]).select(*(F.col(f"{x}.{c}").alias(f"{x}_{c}") for x in ("xs", "ys") for c in ("ids", "more")))
        hot = met.mapInArrow(partial(_pairs_of_two_blocks, keep), "a long, b long")
    else:
        hot = pairs_of_blocks(found.where("ids is not null"), ["ids"])
        hot = hot.select(F.explode("xs.ids").alias("a"), F.col("ys.ids").alias("y")).select("a", F.explode("y").alias("b")).where("a < b")
    return found.where("a is not null").select("a", "b").unionByName(hot).distinct()


#: Bits of a key filter, at most: 32 MB. Beyond some thirty million keys it lets ever more strangers pass, and never keeps a key out.
FILTER_BITS = 1 << 28


def _filter_words(bits: int, it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    mine = np.zeros(bits // 64, np.uint64)
    for batch in it:
        place = mix(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)) & np.uint64(bits - 1)
        np.bitwise_or.at(mine, (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63)))
    at = np.flatnonzero(mine)
    for i in range(0, len(at), 100_000):
        some = at[i : i + 100_000]
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(mine[some].view(np.int64))], ["word", "bits"])


def key_filter(keys: DataFrame, count: int) -> Broadcast:
    """A broadcast bitmap for may_be_in(): every one of the `count` keys (one long column) is in it, and few others.

    Its size follows count up to FILTER_BITS, which bounds what's sent to the driver and to the executors.
    """
    bits = min(FILTER_BITS, 1 << max(16, int(8 * count - 1).bit_length()))
    words = keys.mapInArrow(partial(_filter_words, bits), "word int, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    bitmap = np.zeros(bits // 64, np.uint64)
    bitmap[words.column(0).to_numpy()] = words.column(1).to_numpy().view(np.uint64)
    return keys.sparkSession.sparkContext.broadcast(bitmap)


def may_be_in(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Of each unsigned key, whether the filter lets it pass."""
    place = mix(keys) & np.uint64(64 * len(bitmap) - 1)
    return (bitmap[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1
