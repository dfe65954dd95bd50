"""Top-k search, clustering and hard negatives against brute force in Python integers."""

import math
from hashlib import sha256

import numpy as np
import pytest

from bazaarlens.llm import lookup_clusters, norm_buckets, residue_scores, vectors

NAN, INF = float("nan"), float("inf")


def made(seed: int, n: int, dim: int, spread: bool = True) -> list[tuple]:
    """Rows with copies, near copies, lengths of many sizes and zero vectors."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim)) * (rng.lognormal(0, 1.5, (n, 1)) if spread else 1)
    x[5] = x[50 % n]
    x[7:60] = x[50 % n] * (1 + 1e-3 * rng.normal(size=(53, 1)))
    x[61] = 0
    return [(int(i), [float(v) for v in row], int(rng.integers(3))) for i, row in enumerate(x)]


HARD = [
    (None, [1.0, 2.0], 1), (100, None, 1), (150, [1.0, None], 1), (200, [NAN, 1.0], 1), (250, [INF, 1.0], 1), (300, [0.0, 0.0], 1),
    (350, [], 1), (400, [], 0), (450, [1.0, -1.0], None), (500, [1.0, -1.0], 0), (500, [1.0, -1.0], 0), (501, [1.0, -0.5], 0),
    (502, [0.9, -0.5], 2), (503, [0.8, -0.5], 2), (504, [0.8, -0.5], 2), (505, [-1.0, 1.0], 2), (550, [1.0], 0), (551, [-3.5], 0),
]
SCHEMA = "vec_id long, embedding array<double>, label int"


def usable(rows, scale):
    return [(i, [math.floor(scale * v) for v in x], label) for i, x, label in rows if i is not None and x is not None and all(v is not None and math.isfinite(v) for v in x)]


def dot(a, b):
    return sum(x * y for x, y in zip(a, b, strict=True))


def best(rows, k):
    known, out = usable(rows, 256), []
    for n, (i, q, _) in enumerate(known):
        if i % 50 == 0:
            scored = sorted((-dot(q, p), j) for m, (j, p, _) in enumerate(known) if m != n and len(p) == len(q))
            out += [(i, rank + 1, j, -s) for rank, (s, j) in enumerate(scored[:k])]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("spread", [True, False])
def test_top_k_equals_brute_force(spark, monkeypatch, spread):
    for name, size in (("BUCKET", 128), ("FEW", 8)):
        monkeypatch.setattr(norm_buckets, name, size)
    monkeypatch.setattr(norm_buckets, "in_cells", lambda rows, *key: vectors.in_cells(rows, *key, size=300))
    monkeypatch.setattr(norm_buckets, "in_blocks", lambda rows: vectors.in_blocks(rows, size=9))
    rows = made(1, 1500, 12, spread)
    assert got(norm_buckets.top_k(spark.createDataFrame(rows, SCHEMA).repartition(4))) == best(rows, 5)


def test_top_k_of_hard_rows(spark):
    clash = spark.createDataFrame(HARD, SCHEMA).selectExpr("*", "1 as row", "2 as cell", "'x' as norm", "3 as score")
    assert got(norm_buckets.top_k(clash)) == best(HARD, 5)
    assert norm_buckets.top_k(clash.where("vec_id < 0")).collect() == []
    assert norm_buckets.top_k(clash.where("vec_id = 550")).collect() == []  # no other row


def test_products_beyond_doubles_are_exact(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(v) for v in rng.integers(-(2**20), 2**20, 8)], 0) for i in range(120)]
    assert got(norm_buckets.top_k(spark.createDataFrame(rows, SCHEMA))) == best(rows, 5)
    with pytest.raises(Exception, match="components too large in vec_id 7"):
        norm_buckets.top_k(spark.createDataFrame([*rows[:2], (7, [1e200] * 8, 0)], SCHEMA)).collect()


def test_coordinate_ranges_hold_every_row_above_the_local_threshold():
    rng = np.random.default_rng(5)
    x = np.repeat(rng.normal(size=(40, 16)), 12, 0) + 0.05 * rng.normal(size=(480, 16))
    q = np.floor(1000 * x).astype(np.int64)
    norms = np.sqrt((q * q).sum(1))
    order = np.argsort(-norms)
    bucket = norm_buckets.Bucket(q[order], norms[order], np.arange(480), np.arange(480))
    unit, held = q[order] / norms[order][:, None], 0
    for i in range(0, 480, 20):
        for local in (0.8, 0.95, 0.99):
            hits = set(bucket.within(unit[i], local).tolist())
            assert set(np.flatnonzero(unit @ unit[i] >= local).tolist()) <= hits
            held += len(hits)
    assert held < 0.2 * 24 * 3 * 480
    assert norm_buckets.COSINE <= bucket.level(unit, np.full(480, 0.99)) <= 0.99 and bucket.level(unit, np.full(480, 0.1)) == np.inf


def clusters(rows, k, rounds, dim):
    known = [(i, [math.floor(64 * v) for v in x]) for i, x, _ in rows if x is not None and len(x) == dim and all(v is not None and math.isfinite(v) for v in x)]
    lots = sorted((sha256(f"1:{i}".encode()).hexdigest(), i, q) for i, q in known if i is not None)
    centroids = [q for _, _, q in lots[:k]]

    def near(q):
        return min((sum((a - b) ** 2 for a, b in zip(q, c, strict=True)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        told = [(near(q)[1], q) for _, q in known]
        for c in range(len(centroids)):
            own = [q for n, q in told if n == c]
            if own:
                centroids[c] = [sum(v) // len(own) for v in zip(*own, strict=True)]
    told = [(i, *near(q)) for i, q in known]
    each = [sum(d for _, d, n in told if n == c) for c in range(len(centroids))]
    return sorted(((i, c, d, each[c], sum(each), sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for i, d, c in told), key=repr)


def test_clusters_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(lookup_clusters, "VECTORS", 100)
    rows = made(2, 700, 6) + [(None, [0.5] * 6, 0), (900, None, 0), (901, [1.0], 0), (902, [NAN] * 6, 0), (3, [0.25] * 6, 1), (903, [None] * 6, 0)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as q", "2 as cluster", "'x' as distance").repartition(3)
    made_ = sorted((tuple(r) for r in lookup_clusters.cluster(df, dim=6).collect()), key=repr)
    assert made_ == clusters(rows, 16, 3, 6)


def test_clusters_of_few_and_large_vectors(spark):
    df = spark.createDataFrame([(1, [0.5, 1.0], 0), (2, [-0.5, 1.0], 0), (2, [-0.5, 1.0], 0)], SCHEMA)
    rows = [(1, [0.5, 1.0], 0), (2, [-0.5, 1.0], 0), (2, [-0.5, 1.0], 0)]
    assert sorted(tuple(r) for r in lookup_clusters.cluster(df, dim=2).collect()) == clusters(rows, 16, 3, 2)
    assert lookup_clusters.cluster(df, dim=64).collect() == []
    assert lookup_clusters.cluster(df, dim=64).columns == lookup_clusters.cluster(df, dim=2).columns
    with pytest.raises(Exception, match="component too large in vec_id 9"):
        lookup_clusters.cluster(df.union(spark.createDataFrame([(9, [1e30, 0.0], 0)], SCHEMA)), dim=2).collect()


def test_tables_of_wide_and_narrow_columns():
    rng = np.random.default_rng(7)
    q = np.c_[rng.integers(-3, 4, 200), rng.integers(-(2**26), 2**26, 200)]
    c = q[:5]
    assert (lookup_clusters.distances(q, c) == ((q[:, None] - c[None]) ** 2).sum(2)).all()


def mined(rows):
    known, out = [(i, q, label) for i, q, label in usable(rows, 256) if label is not None], []
    for n, (i, q, label) in enumerate(known):
        if i % 50:
            continue
        scored = [(-dot(q, p), j, m) for m, (j, p, _) in enumerate(known) if m != n and len(p) == len(q)]
        for s, j, _ in sorted(x for x in scored if known[x[2]][2] == label)[:5]:
            fit = sorted(x for x in scored if known[x[2]][2] != label and 50 * -s <= 100 * -x[0] <= 95 * -s)
            out += [(i, j, rank + 1, x[1], -s, -x[0]) for rank, x in enumerate(fit[:3])]
    return sorted(out)


def test_hard_negatives_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(residue_scores, "ROWS", 5)
    monkeypatch.setattr(residue_scores, "in_cells", lambda rows, *key: vectors.in_cells(rows, *key, size=200))
    monkeypatch.setattr(residue_scores, "in_blocks", lambda rows: vectors.in_blocks(rows, size=9))
    for rows in (made(4, 1200, 10), HARD, made(6, 800, 70, False)):
        df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as row", "2 as cell", "'x' as rank", "3 as anchor").repartition(4)
        want = mined(rows)
        assert got(residue_scores.mine(df)) == want and (want or rows is HARD)
    assert residue_scores.mine(df.where("vec_id < 0")).collect() == []


def test_labels_are_moved_before_mining(spark):
    df = spark.createDataFrame([(14, [1.0], 9), (15, [1.0], 9), (21, [1.0], None), (None, [1.0], 3)], SCHEMA)
    assert [r.label for r in residue_scores.relabelled(df).collect()] == [0, 9, None, 3]


@pytest.mark.parametrize("size", [8, 2**9, 2**20, 2**27])
def test_residue_scores_are_exact(size):
    rng = np.random.default_rng(size)
    a, b = rng.integers(-size, size, (7, 130)), rng.integers(-size, size, (40, 130))
    a[0], b[0], b[1] = -size, -size, size - 1
    norm = lambda q: np.sqrt((q.astype(float) ** 2).sum(1))
    scores = residue_scores.Scores(b, norm(b), float(norm(a).max()))
    want = a.astype(object) @ b.T.astype(object)
    assert (scores.of(a) == want).all() and len(scores.primes) == {8: 2, 2**9: 3, 2**20: 6, 2**27: 7}[size]
