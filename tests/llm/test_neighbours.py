import numpy as np
import pytest

from evigraph.llm import neighbours as N
from evigraph.llm import vectorgraph as G


def clustered(n, d=32, seed=0):
    r = np.random.default_rng(seed)
    centres = r.standard_normal((n // 4, d))
    x = centres[r.integers(0, len(centres), n)] + r.uniform(0.02, 0.5, (n, 1)) * r.standard_normal((n, d))
    return x * r.uniform(0.5, 4, (n, 1))


def unit(x):
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def recall(found, x, k=5, least=0.0):
    s = unit(x) @ unit(x).T
    np.fill_diagonal(s, -2)
    want = np.argsort(-s, axis=1)[:, :k]
    hit = sum(len({int(j) for j in want[i] if s[i, j] >= least} & set(found[i])) for i in range(len(x)))
    return hit / sum((s[i, want[i]] >= least).sum() for i in range(len(x)))


def test_graph_recall():
    x = unit(clustered(3000)).astype(np.float32)
    graph, ids, _, trees = G.build(x)
    assert recall([set(r[:5].tolist()) for r in ids], x) > 0.95
    other = np.arange(0, 3000, 7)
    q, _ = G.search(x, graph, x[other], trees)
    assert (q[:, 0] == other).mean() > 0.99


def test_graph_degenerate():
    for n in (2, 3, 7):
        x = unit(np.random.default_rng(n).standard_normal((n, 4))).astype(np.float32)
        _, ids, _, _ = G.build(x)
        assert all(set(r[r >= 0].tolist()) == set(range(n)) - {i} for i, r in enumerate(ids))
    same = np.ones((500, 4), np.float32) / 2
    graph, ids, _, _ = G.build(same)
    assert (ids[:, 0] >= 0).all() and graph.shape == (500, G.EDGES)


def tables(spark, x, model="m-32-a", text=lambda i: i, ids=lambda i: f"id{i:05}"):
    h = lambda i: f"{text(i):064x}"
    e = spark.createDataFrame([("claim", ids(i), model, "t", h(i)) for i in range(len(x))], "kind string, id string, model_id string, embedded_at string, text_hash string")
    t = spark.createDataFrame([(h(i), model, [float(y) for y in v], "t") for i, v in enumerate(x)], "text_hash string, model_id string, embedding array<float>, embedded_at string")
    return e, t


@pytest.mark.parametrize("shard_rows", [100_000, 300, 100])
def test_pairs_against_brute_force(spark, shard_rows):
    x = clustered(1200)
    e, t = tables(spark, x)
    got = N.similar_ids(e.union(e.limit(50)), t.union(t.limit(50)), least=0.85, shard_rows=shard_rows).collect()
    assert {r.place for r in got} <= {1, 2, 3, 4, 5} and len({(r.id, r.place) for r in got}) == len(got)
    found = [set() for _ in x]
    s = unit(x.astype(np.float32).astype(float))
    for r in got:
        i, j = int(r.id[2:]), int(r.other_id[2:])
        found[i].add(j)
        assert abs(r.cosine - s[i] @ s[j]) < 1e-6 and r.cosine >= 0.85
    assert recall(found, x, least=0.85) >= 0.95


def test_a_third_of_all_vectors_in_one_place(spark, monkeypatch):
    x = clustered(1500, seed=3)
    x[:500] = x[0] + 0.05 * np.random.default_rng(1).standard_normal((500, 32))
    monkeypatch.setattr(N, "SPLIT", 1)
    of = N.fitted(unit(x), len(x), 100)
    assert len(of.centroids) >= 10 and (of.parts > 1).any()
    e, t = tables(spark, x)
    found = [set() for _ in x]
    for r in N.similar_ids(e, t, least=0.85, shard_rows=100).collect():
        found[int(r.id[2:])].add(int(r.other_id[2:]))
    assert recall(found, x, least=0.85) >= 0.95


def test_unreferenced_vectors_take_no_place(spark):
    x = np.array([[1.0, 0.001 * i] + [0.0] * 30 for i in range(12)])
    e, t = tables(spark, x)
    got = N.similar_ids(e.where("id IN ('id00000', 'id00011')"), t).collect()
    assert {(r.id, r.other_id) for r in got} == {("id00000", "id00011"), ("id00011", "id00000")}


def test_unusable_vectors_and_copies(spark):
    good = [1.0] + [0.0] * 31
    near = [1.0, 0.1] + [0.0] * 30
    vectors = [good, good, near, None, good[:20], [0.0] * 32, [float("nan")] + good[1:], [float("inf")] + good[1:], [-1.0] + good[1:]]
    e = spark.createDataFrame([("node", f" ID{i} ", "m-32", "t", f"SHA256:{i:064X}") for i in range(len(vectors))] + [("node", None, "m-32", "t", "0" * 64), ("node", "lost", "m-32", "t", "f" * 64)], "kind string, id string, model_id string, embedded_at string, text_hash string")
    t = spark.createDataFrame([(f"{i:064x}", "m-32", v, "t") for i, v in enumerate(vectors)], "text_hash string, model_id string, embedding array<float>, embedded_at string")
    assert {(r.id_a, r.id_b) for r in N.similar_pairs(N.similar_ids(e, t)).collect()} == {("id0", "id1"), ("id0", "id2"), ("id1", "id2")}


def test_many_ids_of_one_text(spark):
    e, t = tables(spark, np.tile([[1.0] + [0.0] * 31], (400, 1)), text=lambda i: 1)
    got = N.similar_ids(e, t).collect()
    assert len(got) == 400 * 5 and all(r.cosine == 1.0 for r in got)
    assert {r.other_id for r in got} == {f"id{i:05}" for i in range(6)}


def test_empty(spark):
    e, t = tables(spark, clustered(8))
    assert N.similar_ids(e.limit(0), t).collect() == [] and N.similar_ids(e, t.limit(0)).collect() == []
