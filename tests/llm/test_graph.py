import numpy as np
import pytest

from bazaarlens.llm import flat_graph
from bazaarlens.llm.queries import QUERIES

KIND = "vec_id long, embedding array<double>, label int"


@pytest.fixture(scope="module")
def crowded():
    """Vectors with crowds of near copies, equal ones, and the cases that link with nothing."""
    rng = np.random.default_rng(5)
    rows = []
    for label in (0, 1):
        centres = rng.normal(size=(12, 16))
        for centre in centres:
            for _ in range(rng.integers(1, 40)):
                rows.append(((centre + rng.normal(0, 0.12, 16)).tolist(), label))
        rows += [(rng.normal(size=16).tolist(), label) for _ in range(200)]
    rows += [(rows[3][0], rows[3][1])] * 5 + [((2 * np.array(rows[4][0])).tolist(), rows[4][1])]
    rows += [(rows[0][0], None), (None, 0), ([], 0), ([0.0] * 16, 0), ([None] * 16, 0), ([float("nan")] + [1.0] * 15, 0), ([float("inf")] * 16, 0), ([1.0, 2.0], 0), ([1.0, 2.0], 0)]
    return [(i, x, label) for i, (x, label) in enumerate(rows)]


def by_force(rows, least=0.98):
    n, parent = {r[0]: 0 for r in rows}, {r[0]: r[0] for r in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    good = [r for r in rows if r[1] and r[2] is not None and None not in r[1] and np.isfinite(r[1]).all() and np.any(r[1])]
    for i, (a, x, label) in enumerate(good):
        for b, y, other in good[:i]:
            if label == other and len(x) == len(y):
                u, v = np.array(x), np.array(y)
                if u @ v / np.sqrt((u @ u) * (v @ v)) >= least:
                    n[a] += 1
                    n[b] += 1
                    r, s = find(a), find(b)
                    parent[max(r, s)] = min(r, s)
    return {k: (n[k], find(k)) for k in n}


@pytest.mark.parametrize("limit", [4096, 60])
def test_links_and_components(spark, crowded, monkeypatch, limit):
    monkeypatch.setattr(flat_graph, "LIMIT", limit)  # small: shards in parts
    monkeypatch.setattr(flat_graph, "SHARD", 100)
    made = {r.vec_id: (r.n_links, r.component_id) for r in flat_graph.near_dedup(spark.createDataFrame(crowded, KIND)).collect()}
    there = by_force(crowded)
    assert made.keys() == there.keys()
    assert all(made[k][0] <= there[k][0] for k in there)  # nothing below the threshold
    assert sum(m[0] for m in made.values()) >= 0.95 * sum(t[0] for t in there.values())
    assert sum(made[k][1] != there[k][1] for k in there) <= 0.02 * len(there)


def planted(n, dim=64, seed=11):
    """Vectors around random directions: pairs, chains and groups whose cosines lie on both sides of the threshold."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    x /= np.sqrt((x * x).sum(1, keepdims=True))
    near = n // 4
    of = rng.integers(near, n, near)
    of[: near // 4] = rng.integers(near, near + n // 100, near // 4)  # larger groups
    noise = rng.normal(size=(near, dim))
    noise /= np.sqrt((noise * noise).sum(1, keepdims=True))
    x[:near] = x[of] + noise * rng.uniform(0.02, 0.25, (near, 1))
    x[: near // 8] = x[near // 8 : near // 4] + 0.15 * noise[: near // 8]  # chains
    return [(int(i), row.tolist(), int(i) % 3 if i >= near else int(of[i]) % 3) for i, row in enumerate(x)]


def test_recall_of_planted_links(spark):
    frame = spark.createDataFrame(planted(9000), KIND).repartition(8)
    result = flat_graph.near_dedup(frame)
    found, there = flat_graph.audit(frame, result, every=10).first()
    assert there > 200 and 0.95 * there <= found <= there


def test_a_crowd_makes_rows_in_proportion(spark):
    """Near copies of one vector: rows in shards and answers follow their number, and every pair is counted."""
    rng = np.random.default_rng(3)
    base = rng.normal(size=32)
    rows = [(i, (base + 0.02 * rng.normal(size=32)).tolist(), 0) for i in range(3000)]
    frame = spark.createDataFrame(rows, KIND)
    points = frame.selectExpr("label", "embedding x", "vec_id rep", "1L copies", "size(embedding) dim")
    assert flat_graph.to_shards(points).count() <= 2 * len(rows)
    made = flat_graph.near_dedup(frame).collect()
    assert {(r.n_links, r.component_id) for r in made} == {(2999, 0)}


def test_query_covers_the_table(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    result = QUERIES["op5_flat_graph"](spark, sf_dir)
    assert result.count() == vectors.count()
    found, there = flat_graph.audit(vectors, result, every=5).first()
    assert found >= 0.9 * there


def test_audit_counts_by_comparison(spark, crowded):
    frame = spark.createDataFrame(crowded, KIND)
    found, there = flat_graph.audit(frame, flat_graph.near_dedup(frame), every=10).first()
    assert there == sum(n for k, (n, _) in by_force(crowded).items() if k % 10 == 0) > 0
    assert found >= 0.9 * there


def test_no_vectors(spark):
    assert flat_graph.near_dedup(spark.createDataFrame([], KIND)).collect() == []
    rows = flat_graph.near_dedup(spark.createDataFrame([(1, None, None), (None, [1.0], 1), (None, [1.0], 1)], KIND)).collect()
    assert sorted((r.n_links, r.component_id, r.kept) for r in rows if r.vec_id == 1) == [(0, 1, True)] and len(rows) == 3


def test_vectors_of_any_size_are_compared(spark):
    rows = [(1, [1e200, 1e200], 0), (2, [1.0, 1.0], 0), (3, [1e-200, 1e-200], 0), (4, [5e-324, 0.0], 0), (5, [1.0, 0.0], 0)]
    made = flat_graph.near_dedup(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in made) == [(1, 2, 1), (2, 2, 1), (3, 2, 1), (4, 1, 4), (5, 1, 4)]
