import numpy as np
import pyarrow as pa

from lamplight.llm.knn import _buckets, _near_in_buckets, _near_in_pairs_of_blocks, _pack, similar_vectors
from lamplight.llm.queries import QUERIES

NAN = float("nan")


def brute(ids, vectors, k, least):
    u = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    s = np.round(u @ u.T, 6)
    out = set()
    for i, a in enumerate(ids):
        order = sorted((j for j in range(len(ids)) if j != i and s[i, j] >= least), key=lambda j: (-s[i, j], ids[j]))[:k]
        out |= {(a, ids[j]) for j in order}
    return out


def test_recall_against_brute_force(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(1500, 64))
    near = base[:300] / np.linalg.norm(base[:300], axis=1, keepdims=True) + rng.normal(size=(300, 64)) * rng.uniform(0.01, 0.06, size=(300, 1))
    vectors = np.concatenate([base, near * rng.uniform(0.4, 3, size=(300, 1)), base[:20]]).astype(np.float32)
    ids = list(range(len(vectors)))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, vectors, strict=True)], "id int, v array<float>")
    got = {(r.id, r.other) for r in similar_vectors(df, "id", "v", dim=64).collect()}
    want = brute(ids, vectors.astype(float), 10, 0.85)
    assert got <= want
    assert len(got) >= 0.95 * len(want)


def test_edges(spark):
    v = [1.0] + [0.0] * 63
    rows = [(1, v, "x"), (2, [2.0] + [0.0] * 63, "x"), (3, None, None), (4, [], ""), (5, [0.0] * 64, ""), (6, [NAN] + v[1:], ""), (7, v[:5], ""), (1, v, "x"), (8, [float("inf")] + v[1:], ""), (None, v, "")]
    df = spark.createDataFrame(rows, "id int, v array<float>, other string")
    assert {(r.id, r.other, r.similarity, r.place) for r in similar_vectors(df, "id", "v", dim=64).collect()} == {(1, 2, 1.0, 1), (2, 1, 1.0, 1)}
    assert similar_vectors(df.where("false"), "id", "v", dim=64).count() == 0


def test_hot_copies_give_k_each(spark):
    rng = np.random.default_rng(0)
    v = rng.normal(size=64).astype(np.float32).tolist()
    df = spark.createDataFrame([(i, v) for i in range(2000)], "id int, v array<float>")
    got = similar_vectors(df, "id", "v", dim=64, k=3)
    assert got.count() == 6000
    assert {r.other for r in got.where("id = 1000").collect()} == {0, 1, 2}


def skewed():
    """A third of all vectors are one dense topic, all alike but no copies."""
    rng = np.random.default_rng(8)
    topic = rng.normal(size=64) / 8 + rng.normal(size=(600, 64)) * 0.045
    vectors = np.concatenate([rng.normal(size=(1200, 64)), topic * rng.uniform(0.4, 3, size=(600, 1))]).astype(np.float32)
    return list(range(len(vectors))), vectors


def test_recall_on_a_dense_topic(spark):
    ids, vectors = skewed()
    df = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, vectors, strict=True)], "id int, v array<float>")
    got = {(r.id, r.other) for r in similar_vectors(df, "id", "v", dim=64, block=32).collect()}
    want = brute(ids, vectors.astype(float), 10, 0.85)
    assert len(want) >= 6000
    assert len(got & want) >= 0.95 * len(want)
    whole = {(r.id, r.other) for r in similar_vectors(df, "id", "v", dim=64).collect()}
    assert got == whole


def test_large_bucket_is_compared_in_full():
    rng = np.random.default_rng(2)
    u = rng.normal(size=(9000, 64))
    u[8000:] = u[:1000] + rng.normal(size=(1000, 64)) * 0.1
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    q = _pack(u).view(np.int64)
    table = pa.table({"key": np.full(9000, -5), "id": np.arange(9000) * 2, **{f"q{c}": q[:, c] for c in range(4)}})
    found = [b for b in _near_in_buckets(0.77, 4096, iter(table.to_batches(max_chunksize=1000)))]
    blocks = [b for b in found if b.column("ids").null_count == 0]
    assert [(b.column("part")[0].as_py(), b.column("parts")[0].as_py(), len(b.column("ids")[0])) for b in blocks] == [(0, 3, 4096), (1, 3, 4096), (2, 3, 808)]
    met = [pa.RecordBatch.from_arrays([x.column("ids"), x.column("qs"), y.column("ids"), y.column("qs")], ["xs", "xq", "ys", "yq"]) for i, x in enumerate(blocks) for y in blocks[i:]]
    pairs = {(a, b) for p in _near_in_pairs_of_blocks(0.77, 4, iter(met)) for a, b in zip(p.column(0).to_pylist(), p.column(1).to_pylist(), strict=True)}
    assert {(2 * i, 2 * (i + 8000)) for i in range(1000)} <= pairs


def test_long_vectors_are_sketched(spark):
    rng = np.random.default_rng(6)
    base = rng.normal(size=(400, 300))
    near = base[:200] / np.linalg.norm(base[:200], axis=1, keepdims=True) + rng.normal(size=(200, 300)) * rng.uniform(0.005, 0.03, size=(200, 1))
    vectors = np.concatenate([base, near]).astype(np.float32)
    assert _pack(vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).shape == (600, 4)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "id int, v array<float>")
    got = {(r.id, r.other) for r in similar_vectors(df, "id", "v", dim=300).collect()}
    want = brute(list(range(600)), vectors.astype(float), 10, 0.85)
    assert got <= want and len(got) >= 0.95 * len(want)


def test_probes_are_the_likeliest_of_each_vector():
    u = np.random.default_rng(1).normal(size=(50, 64))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    own, probed = _buckets(u, 12, 2.2, 6, 0)
    assert own.shape == (50, 6) and not probed.any()
    few, more = (_buckets(u, 12, 2.2, 6, n)[0].reshape(50, 6, -1) for n in (2, 5))
    assert (few == more[:, :, :3]).all() and (few[:, :, 0] == own).all()
    more = more.reshape(50, -1)
    moved = _buckets(u + 1e-9, 12, 2.2, 6, 5)[0]
    assert (moved == more).mean() > 0.9


def test_nearest_without_a_floor_equal_brute_force(spark, tmp_path):
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(3000, 64)).astype(np.float32)
    vectors[100:112] = vectors[0]
    ids = [f"r{i:010d}" for i in range(3000)]
    rows = [(i, v.tolist()) for i, v in zip(ids, vectors, strict=True)] + [("r0000005000", None), ("r0000005050", [0.0] * 64), ("r0000005100", [NAN] * 64)]
    spark.createDataFrame(rows, "row_id string, vector array<float>").repartition(3).write.parquet(f"{tmp_path}/research.parquet")
    got = {(r.row_id, r.other) for r in QUERIES["p4_nearest"](spark, str(tmp_path)).collect()}
    wanted = set(ids[::50])
    want = {(a, b) for a, b in brute(ids, vectors.astype(float), 10, -1.0) if a in wanted}
    assert len(want) == 600 and got == want
