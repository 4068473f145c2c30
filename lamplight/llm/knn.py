"""The most similar vectors of every vector: multiprobe p-stable hashing, then exact reranking.

A table hashes a unit vector by m random projections cut into cells of one width (Datar et al. 2004). Besides its own cells a vector
visits in each table the cells it would fall into by the likeliest small displacements (Lv et al. 2007), in the order of their estimated
success for this vector: the fewer and nearer the cell borders that are crossed, the likelier. Rows carry a sketch of the vector at four bits a dimension, at most SKETCH of them, so a bucket discards what is out of reach by itself, and only pairs that
pass go on to the exact cosine.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lamplight.llm.lsh import key_filter, may_be_in, pairs_of_blocks
from lamplight.llm.words import mix
from lamplight.session import materialize

#: A perturbation is a set of places in the list of a vector's border crossings, nearest first.
PERTURBATIONS = [(0,), (1,), (0, 1), (2,), (0, 2), (3,), (1, 2), (0, 3), (4,)]
#: Dimensions of a sketch, at most; longer vectors are projected to so many.
SKETCH = 64
#: Four bits a dimension: the step between levels, as a share of the standard deviation of a unit vector's coordinates.
_LEVELS = 0.4
#: How far a sketch's cosine may lie below the true one: about four standard deviations of the rounding, and of the projection if there's one.
_SLACK, _PROJECTED_SLACK = 0.08, 0.16


def usable_matrix(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows that hold a finite, non-zero vector of `dim` numbers, and those vectors at unit length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    start = column.offsets.to_numpy()
    length = np.diff(start)
    at = np.flatnonzero((length == dim) & np.asarray(column.is_valid()))
    if not len(at):
        return at, np.empty((0, dim))
    flat = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    m = flat[start[:-1][at][:, None] + np.arange(dim)]
    norm = np.sqrt((m * m).sum(axis=1))
    good = np.isfinite(norm) & (norm > 0)
    return at[good], m[good] / norm[good][:, None]


def _direction_hash(u: np.ndarray) -> np.ndarray:
    """A hash of each unit vector, even; equal up to length when the coordinates are equal to five places."""
    with np.errstate(over="ignore"):
        q = np.round(u * 1e5).astype(np.int64).astype(np.uint64)
        odd = mix(np.arange(u.shape[1], dtype=np.uint64)) | np.uint64(1)
        return mix((mix(q) * odd).sum(axis=1, dtype=np.uint64)) & ~np.uint64(1)


def _projected(u: np.ndarray) -> np.ndarray:
    """Unit vectors themselves, or if they have more dimensions than a sketch, their projections to so many, at unit length."""
    if u.shape[1] <= SKETCH:
        return u
    x = u @ np.random.default_rng(20240301).normal(size=(u.shape[1], SKETCH))
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def slack(dim: int) -> float:
    return _SLACK if dim <= SKETCH else _PROJECTED_SLACK


def _pack(u: np.ndarray) -> np.ndarray:
    """Sketches at four bits a dimension, sixteen dimensions a word."""
    u = _projected(u)
    step = _LEVELS / np.sqrt(u.shape[1])
    level = np.clip(np.floor(u / step) + 8, 0, 15).astype(np.uint64)
    level = np.pad(level, ((0, 0), (0, -u.shape[1] % 16)), constant_values=8).reshape(len(u), -1, 16)
    return np.bitwise_or.reduce(level << (np.uint64(4) * np.arange(16, dtype=np.uint64)), axis=2)


def _unpack(q: np.ndarray) -> np.ndarray:
    """Approximate unit vectors of packed ones."""
    level = (q[:, :, None] >> (np.uint64(4) * np.arange(16, dtype=np.uint64))) & np.uint64(15)
    x = level.reshape(len(q), 16 * q.shape[1]).astype(np.float32) - 7.5
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def _buckets(u: np.ndarray, m: int, width: float, tables: int, probes: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of each vector (rows): in each table its own, then the `probes` likeliest others; and which of them are probed ones."""
    rng = np.random.default_rng(20240229)
    keys = []
    for t in range(tables):
        x = u @ rng.normal(size=(u.shape[1], m)) / width + rng.random(m)
        weight = mix(np.arange(m, dtype=np.uint64), t + 1) | np.uint64(1)
        cell = np.floor(x)
        part = x - cell
        border = np.concatenate([part, 1 - part], axis=1)
        order = np.argsort(border, axis=1)[:, :5]
        far = np.take_along_axis(border, order, axis=1) ** 2
        with np.errstate(over="ignore"):
            base = (cell.astype(np.int64).astype(np.uint64) * weight).sum(axis=1, dtype=np.uint64) + np.uint64(t + 1)
            move = np.where(order < m, np.uint64(0) - weight[order % m], weight[order % m])
            others = np.stack([base + move[:, list(p)].sum(axis=1, dtype=np.uint64) for p in PERTURBATIONS], axis=1)
        likeliest = np.argsort(np.stack([far[:, list(p)].sum(axis=1) for p in PERTURBATIONS], axis=1), axis=1, kind="stable")[:, :probes]
        keys.append(mix(np.concatenate([base[:, None], np.take_along_axis(others, likeliest, axis=1)], axis=1)))
    keys = np.concatenate(keys, axis=1)
    return keys, np.broadcast_to(np.arange(keys.shape[1]) % (keys.shape[1] // tables) > 0, keys.shape)


def _rows(what: str, dim: int, m: int, width: float, tables: int, probes: int, wanted, it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows(id, vector) the 'classes' (id, class), the 'keys' (key, class, sketch), or the 'units', unit vectors of the wanted classes."""
    signed = lambda x: pa.array(np.ascontiguousarray(x).view(np.int64))
    for batch in it:
        for i in range(0, len(batch), 2048):
            part = batch.slice(i, 2048)
            at, u = usable_matrix(part.column(1), dim)
            if not len(at):
                continue
            cls = _direction_hash(u)
            if what == "classes":
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(at)), signed(cls)], ["id", "cls"])
                continue
            cls, once = np.unique(cls, return_index=True)
            if what == "units":
                keep = may_be_in(wanted.value, cls)
                cls, u = cls[keep], u[once[keep]]
                flat = pa.ListArray.from_arrays(pa.array(np.arange(len(u) + 1, dtype=np.int32) * dim), pa.array(u.ravel().astype(np.float32)))
                yield pa.RecordBatch.from_arrays([signed(cls), flat], ["cls", "unit"])
                continue
            u = u[once]
            q = _pack(u)
            keys, probed = _buckets(u, m, width, tables, probes)
            each = np.repeat(np.arange(len(u)), keys.shape[1])
            yield pa.RecordBatch.from_arrays([signed(keys.ravel()), signed(cls[each] | probed.ravel().astype(np.uint64)), *(signed(q[each, c]) for c in range(q.shape[1]))], ["key", "id", *(f"q{c}" for c in range(q.shape[1]))])


PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64())])
BLOCKS = pa.schema([*PAIRS, ("bucket", pa.int64()), ("part", pa.int32()), ("parts", pa.int32()), ("ids", pa.list_(pa.int64())), ("qs", pa.list_(pa.int64()))])


def _emit(a: np.ndarray, b: np.ndarray, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Pairs of ids whose last bit says that the bucket is a probed one; of two probed ones, and of an id with itself, there's none."""
    keep = (a >> np.uint64(1) != b >> np.uint64(1)) & ((a & b & np.uint64(1)) == 0)
    a, b = a[keep] & ~np.uint64(1), b[keep] & ~np.uint64(1)
    if len(a):
        a, b = a.view(np.int64), b.view(np.int64)
        rest = [pa.nulls(len(a), f.type) for f in list(schema)[2:]]
        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), *rest], schema=schema)


def _near_in_blocks(limit: float, schema: pa.Schema, x: np.ndarray, vx: np.ndarray, y: np.ndarray, vy: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The pairs of x and y that may reach the limit; if y is x, each pair once."""
    for i in range(0, len(x), 256):
        low = i if y is x else 0
        p, q = np.nonzero(vx[i : i + 256] @ vy[low:].T >= limit)
        p, q = p + i, q + low
        if y is x:
            p, q = p[q > p], q[q > p]
        yield from _emit(x[p], y[q], schema)


def _near_in_buckets(limit: float, block: int, it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by key, id. The pairs a < b of ids in one bucket whose sketches reach the limit; a bucket of more than `block` ids gives its blocks (bucket, part, parts, ids, sketches)."""
    lists = lambda x: pa.array([x.ravel().view(np.int64)], pa.list_(pa.int64()))

    def pairs(key: np.ndarray, one: np.ndarray, q: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(key):
            return
        fresh = np.concatenate([[True], (key[1:] != key[:-1]) | (one[1:] != one[:-1])])
        key, one, q = key[fresh], one[fresh], q[fresh]
        edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
        size = np.diff(edge)
        small = np.repeat((size > 1) & (size <= 24), size)
        ks, os, vs = key[small], one[small], _unpack(q[small])
        for gap in range(1, min(24, len(ks))):
            i = np.flatnonzero((ks[gap:] == ks[:-gap]) & ((os[gap:] & os[:-gap] & np.uint64(1)) == 0))
            if len(i):
                i = i[np.einsum("ij,ij->i", vs[i], vs[i + gap]) >= limit]
                yield from _emit(os[i], os[i + gap], BLOCKS)
        for g in np.flatnonzero(size > 24):
            lo, hi = edge[g], edge[g + 1]
            if size[g] <= block:
                x, v = one[lo:hi], _unpack(q[lo:hi])
                yield from _near_in_blocks(limit, BLOCKS, x, v, x, v)
                continue
            starts = range(lo, hi, block)
            for n, i in enumerate(starts):
                end = min(i + block, hi)
                none = pa.nulls(1, pa.int64())
                yield pa.RecordBatch.from_arrays([none, none, pa.array(key[lo : lo + 1].view(np.int64)), pa.array([n], pa.int32()), pa.array([len(starts)], pa.int32()), lists(one[i:end]), lists(q[i:end])], schema=BLOCKS)

    waiting: list[list[np.ndarray]] = []
    for batch in it:
        if not len(batch):
            continue
        cols = [batch.column(c).to_numpy(zero_copy_only=False).view(np.uint64) for c in range(batch.num_columns)]
        key, one, q = cols[0], cols[1], np.stack(cols[2:], axis=1)
        # Rows sort by the signed key; the last bucket may go on in the next batch.
        last = int(np.searchsorted(key.view(np.int64), key.view(np.int64)[-1]))
        if waiting and waiting[-1][0][-1] != key[-1]:
            waiting.append([key[:last], one[:last], q[:last]])
            yield from pairs(*map(np.concatenate, zip(*waiting, strict=True)))
            waiting = []
            key, one, q = key[last:], one[last:], q[last:]
        elif not waiting:
            yield from pairs(key[:last], one[:last], q[:last])
            key, one, q = key[last:], one[last:], q[last:]
        waiting.append([key, one, q])
    if waiting:
        yield from pairs(*map(np.concatenate, zip(*waiting, strict=True)))


def _near_in_pairs_of_blocks(limit: float, words: int, it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs of each row's two blocks (xs, xq, ys, yq) whose sketches reach the limit."""
    for batch in it:
        for r in range(len(batch)):
            xs, xq, ys, yq = (batch.column(c)[r].values.to_numpy(zero_copy_only=False).view(np.uint64) for c in range(4))
            vx = _unpack(xq.reshape(-1, words))
            if np.array_equal(xs, ys):
                yield from _near_in_blocks(limit, PAIRS, xs, vx, xs, vx)
            else:
                yield from _near_in_blocks(limit, PAIRS, xs, vx, ys, _unpack(yq.reshape(-1, words)))


def _cosines(least: float, it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of pairs(a, b, unit of a, unit of b) those whose cosine, to six places, is `least` or more."""
    for batch in it:
        if not len(batch):
            continue
        x, y = (batch.column(c).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1).astype(np.float64) for c in (2, 3))
        s = np.round(np.einsum("ij,ij->i", x, y), 6)
        rows = pa.array(np.flatnonzero(s >= least))
        yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), pa.array(s[s >= least])], ["a", "b", "similarity"])


def similar_vectors(df: DataFrame, id_col: str, vector_col: str, *, dim: int, k: int = 10, least: float = 0.85, m: int = 12, width: float = 2.2, tables: int = 6, probes: int = 3, block: int = 4096, name: str = "knn") -> DataFrame:
    """(id, other, similarity, place): for each record its k most similar others of cosine `least` or more, places from 1.

    Ties in similarity (to six places) go by id. Vectors that are null, empty, of another length than dim, all zero or not finite
    take no part. Vectors of one direction form a class, hashed once a batch; of a class at most k + 1 members, those of least
    id, can be among anybody's k, so hot groups of copies give k rows a record and no more.

    Rows are bucketed by tables * (1 + probes) keys and shuffled once, at 16 bytes and a sketch a row, however long the vectors. All pairs
    of a bucket are compared: one of more than `block` vectors leaves as blocks, which meet each other spread over all tasks, so a hot one
    takes time that grows with the square of its size, but no pair is left out. The vectors of what's left are found by a filter of
    fixed size. Recall is measured in the tests. An empty table gives no rows; ids that repeat count once.
    """
    kind = dict(df.dtypes)[id_col]
    rows = df.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<float>").alias("v")).where("id is not null and v is not null")
    mapped = lambda what, schema, wanted=None: rows.mapInArrow(partial(_rows, what, dim, m, width, tables, probes, wanted), schema)
    words, limit = -(-min(dim, SKETCH) // 16), least - slack(dim)
    classes = materialize(mapped("classes", f"id {kind}, cls long"), f"{name}-classes")
    keys = mapped("keys", "key long, id long, " + ", ".join(f"q{c} long" for c in range(words)))
    found = materialize(keys.repartition("key").sortWithinPartitions("key", "id").mapInArrow(partial(_near_in_buckets, limit, block), "a long, b long, bucket long, part int, parts int, ids array<long>, qs array<long>"), f"{name}-buckets")
    hot = pairs_of_blocks(found.where("ids is not null"), ["ids", "qs"]).select(F.col("xs.ids").alias("xs"), F.col("xs.qs").alias("xq"), F.col("ys.ids").alias("ys"), F.col("ys.qs").alias("yq"))
    near = found.where("a is not null").select("a", "b").unionByName(hot.mapInArrow(partial(_near_in_pairs_of_blocks, limit, words), "a long, b long"))
    near = materialize(near.distinct(), f"{name}-candidates")
    wanted = key_filter(near.select("a").unionByName(near.select(F.col("b").alias("a"))), 2 * near.count())
    units = materialize(mapped("units", "cls long, unit array<float>", wanted).dropDuplicates(["cls"]), f"{name}-units")
    both = near.join(units.select(F.col("cls").alias("a"), F.col("unit").alias("ua")), "a").join(units.select(F.col("cls").alias("b"), F.col("unit").alias("ub")), "b")
    exact = materialize(both.select("a", "b", "ua", "ub").mapInArrow(partial(_cosines, least), "a long, b long, similarity double"), f"{name}-exact")

    members = classes.select("id", "cls").distinct()
    few = members.withColumn("n", F.row_number().over(Window.partitionBy("cls").orderBy("id"))).where(F.col("n") <= k + 1).select(F.col("cls").alias("to"), F.col("id").alias("other"))
    both = exact.select(F.col("a").alias("cls"), F.col("b").alias("to"), "similarity").unionByName(exact.select(F.col("b").alias("cls"), F.col("a").alias("to"), "similarity"))
    reach = both.join(few, "to").select("cls", "other", "similarity")
    # The k of a class, plus one as a member may meet itself among its copies.
    several = few.groupBy("to").count().where("count > 1").select("to")
    own = few.join(several, "to", "left_semi").select(F.col("to").alias("cls"), "other", F.lit(1.0).alias("similarity"))
    best = reach.unionByName(own).withColumn("n", F.row_number().over(Window.partitionBy("cls").orderBy(F.desc("similarity"), "other"))).where(F.col("n") <= k + 1).drop("n")
    mine = members.join(best, "cls").where("id <> other")
    return mine.withColumn("place", F.row_number().over(Window.partitionBy("id").orderBy(F.desc("similarity"), "other"))).where(F.col("place") <= k).select("id", "other", "similarity", "place")


def _nearest(shared, dim: int, k: int, it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, other, similarity): of a task's rows the k most similar to each query, ties by id."""
    names, vectors = shared.value
    ids, best = np.empty((0, len(names)), object), np.empty((0, len(names)))
    for batch in it:
        for i in range(0, len(batch), 2048):
            part = batch.slice(i, 2048)
            at, u = usable_matrix(part.column(1), dim)
            if not len(at):
                continue
            other = np.array(part.column(0).take(pa.array(at)).to_pylist(), object)
            order = np.argsort(other, kind="stable")
            near = np.where(other[order][:, None] == names[None, :], -np.inf, np.round(u[order] @ vectors.T, 6))
            top = np.argsort(-near, axis=0, kind="stable")[:k]
            ids, best = np.concatenate([ids, other[order][top]]), np.concatenate([best, np.take_along_axis(near, top, axis=0)])
            if len(best) > k:
                rank = np.argsort(ids, axis=0, kind="stable")
                ids, best = np.take_along_axis(ids, rank, axis=0), np.take_along_axis(best, rank, axis=0)
                rank = np.argsort(-best, axis=0, kind="stable")[:k]
                ids, best = np.take_along_axis(ids, rank, axis=0), np.take_along_axis(best, rank, axis=0)
    query = np.tile(names, (len(best), 1))
    ok = np.isfinite(best)
    for i in range(0, int(ok.sum()), 100_000):
        part = slice(i, i + 100_000)
        yield pa.RecordBatch.from_pydict({"id": query[ok][part].tolist(), "other": ids[ok][part].tolist(), "similarity": best[ok][part]})


def nearest_vectors(df: DataFrame, id_col: str, vector_col: str, queries: DataFrame, *, dim: int, k: int = 10, block: int = 2000) -> DataFrame:
    """(id, other, similarity, place): for each query, a row of queries(id_col, vector_col), its k most similar rows of df, however similar.

    Exact: the queries go through the rows in blocks, each broadcast. Ties in similarity (to six places) go by id; a query doesn't find its
    own id. Vectors that similar_vectors() leaves out take no part. Ids of strings or whole numbers are taken to be unique.
    """
    spark, kind = df.sparkSession, dict(df.dtypes)[id_col]
    some = lambda x: x.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<float>").alias("v")).where("id is not null and v is not null")
    rows, schema = some(df), f"id {kind}, other {kind}, similarity double"
    out, names, vectors = spark.createDataFrame([], schema), [], []

    def scan() -> DataFrame:
        good, u = usable_matrix(pa.array(vectors, pa.list_(pa.float32())), dim)
        return rows.mapInArrow(partial(_nearest, spark.sparkContext.broadcast((np.array(names, object)[good], u)), dim, k), schema)

    for row in some(queries).toLocalIterator():
        names.append(row.id)
        vectors.append(row.v)
        if len(names) == block:
            out, names, vectors = out.unionByName(scan()), [], []
    if names:
        out = out.unionByName(scan())
    place = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("similarity"), "other"))
    return out.withColumn("place", place).where(F.col("place") <= k)
