import numpy as np
import pytest

from quern.llm import vectors

SCHEMA = "id string, record_id string, embedding array<double>"


def brute(ids, recs, x, k=5):
    """{id: [(other, cosine)]} by comparing all pairs."""
    u = x / np.linalg.norm(x, axis=1)[:, None]
    s = np.round(u @ u.T, 6)
    out = {}
    for i, name in enumerate(ids):
        others = [(-s[i, j], ids[j]) for j in range(len(ids)) if recs[j] != recs[i]]
        out[name] = [(o, -c) for c, o in sorted(others)[:k]]
    return out


def found(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.id, r["rank"])):
        out.setdefault(r.id, []).append((r.other, r.cosine))
    return out


def test_neighbours_without_cosine_cut(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1500, 64))
    ids, recs = [f"v{i:04d}" for i in range(1500)], [f"r{i // 2}" for i in range(1500)]
    rows = [(i, r, v.tolist()) for i, r, v in zip(ids, recs, x)]
    got = found(vectors.neighbours(spark.createDataFrame(rows + rows[:50], SCHEMA), probes=154).collect())
    want = brute(ids, recs, x)
    assert {i: [o for o, _ in v] for i, v in got.items()} == {i: [o for o, _ in v] for i, v in want.items()}
    assert all(abs(a[1] - b[1]) < 2e-6 for i in want for a, b in zip(got[i], want[i]))


def test_neighbours_of_every_member_of_a_class(spark):
    rng = np.random.default_rng(4)
    same = rng.normal(size=64)
    x = np.concatenate([np.repeat(same[None, :], 80, 0), rng.normal(size=(40, 64))])
    ids, recs = [f"v{i:04d}" for i in range(120)], [f"r{i // 8}" for i in range(120)]
    df = spark.createDataFrame([(i, r, v.tolist()) for i, r, v in zip(ids, recs, x)], SCHEMA)
    got, want = found(vectors.neighbours(df).collect()), brute(ids, recs, x)
    assert {i: [o for o, _ in v] for i, v in got.items()} == {i: [o for o, _ in v] for i, v in want.items()}


def test_neighbours_of_nothing(spark):
    rows = [("a", "r", None), ("b", "s", [0.0] * 64), ("c", "t", [1.0] * 32)]
    assert vectors.neighbours(spark.createDataFrame(rows, SCHEMA)).collect() == []
    assert vectors.neighbours(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("size", ["sf0.01"])
def test_recall_of_true_neighbours(spark, size):
    df = spark.read.parquet(f"/root/testdata/{size}/embeddings_chunks.parquet")
    got = found(vectors.neighbours(df).collect())
    rows = {r.id: r for r in df.collect() if r.embedding and len(r.embedding) == 64 and any(r.embedding)}
    ids = sorted(rows)
    want = brute(ids, [rows[i].record_id for i in ids], np.array([rows[i].embedding for i in ids]))
    true = [(i, o) for i in want for o, _ in want[i]]
    assert sum(o in dict(got.get(i, [])) for i, o in true) >= 0.9 * len(true)
    assert all(len(v) == 5 for v in got.values()) and set(got) == set(ids)


def test_a_long_list_is_divided():
    """A list of vectors around one centre, each with a twin near it: fewer pairs than all, and the twins stay together."""
    rng = np.random.default_rng(12)
    centre = rng.normal(size=64)
    x = centre + 0.3 * rng.normal(size=(1500, 64))
    x = np.concatenate([x, x + 0.02 * rng.normal(size=x.shape)])
    x = (x / np.linalg.norm(x, axis=1)[:, None]).astype(np.float32)
    pivots = x[rng.choice(1500, 120, replace=False)]
    prefix = vectors.prefixes(x, pivots)
    k, p, f = vectors.divided(np.zeros(len(x), np.int64), np.arange(len(x)), prefix, 500)
    size = np.unique(k, return_counts=True)[1]
    pairs = sum(int(n) * (int(n) - 1) // 2 for n in size)
    assert size.max() <= 500 and pairs < 0.6 * len(x) * (len(x) - 1) // 2 and set(p) == set(range(len(x)))
    same, other, _ = vectors.divided(np.arange(50), np.arange(50), prefix[:50], 500)
    assert (same == np.arange(50)).all() and (other == np.arange(50)).all()
    lists = [set() for _ in x]
    for a, b in zip(k.tolist(), p.tolist()):
        lists[b].add(a)
    assert np.mean([bool(lists[i] & lists[i + 1500]) for i in range(1500)]) >= 0.95


def mutual(ids, recs, x, k=5):
    near = {i: {o for o, c in v if c >= 0.95} for i, v in brute(ids, recs, x, k).items()}
    return {(i, o) for i in near for o in near[i] if i < o and i in near[o]}


def pairs_of(spark, ids, recs, x):
    rows = [(i, r, v.tolist()) for i, r, v in zip(ids, recs, x)]
    return [(r.id_a, r.id_b) for r in vectors.mutual_pairs(spark.createDataFrame(rows, SCHEMA)).collect()]


def test_every_pair_at_the_bound(spark):
    """Pairs whose cosine is just above or below 0.95, in a crowd: the index of pivots alone leaves some out."""
    rng = np.random.default_rng(21)
    x = rng.normal(size=(2000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    side = rng.normal(size=x.shape)
    side -= (side * x).sum(1)[:, None] * x
    side /= np.linalg.norm(side, axis=1)[:, None]
    cosine = rng.uniform(0.949, 0.953, len(x))[:, None]
    x = np.concatenate([x, (cosine * x + np.sqrt(1 - cosine**2) * side) * rng.uniform(0.1, 9, (2000, 1))])
    ids, recs = [f"v{i:04d}" for i in rng.permutation(4000)], [f"r{i}" for i in range(4000)]
    got, want = pairs_of(spark, ids, recs, x), mutual(ids, recs, x)
    assert len(want) > 1000 and len(got) == len(set(got)) and set(got) == want


def test_pairs_of_many_close_vectors(spark):
    """Clusters of nearly equal, of equal and of close vectors: ties go to the smaller id."""
    rng = np.random.default_rng(22)
    centres = rng.normal(size=(3, 64))
    x = np.concatenate([centres[0] + 1e-7 * rng.normal(size=(400, 64)), np.repeat(centres[1:2], 400, 0) * rng.uniform(0.5, 2, (400, 1)), centres[2] + 0.1 * rng.normal(size=(400, 64)), rng.normal(size=(400, 64))])
    ids, recs = [f"v{i:04d}" for i in rng.permutation(1600)], [f"r{i}" for i in rng.integers(0, 300, 1600)]
    got, want = pairs_of(spark, ids, recs, x), mutual(ids, recs, x)
    assert len(got) == len(set(got)) and set(got) == want
