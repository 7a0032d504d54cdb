import numpy as np

from evigraph.operators import pairs as P


def vectors(spark, n=90, grps=4, seed=2):
    x = np.random.default_rng(seed).standard_normal((n, 5))
    x[7] = 0
    df = spark.createDataFrame([(i, f"g{i % grps}", [float(v) for v in x[i]]) for i in range(n)], "id int, grp string, embedding array<double>")
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    u = np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)
    return df, np.round(u @ u.T, 9), np.array([i % grps for i in range(n)])


def test_histogram_counts_and_cut(spark):
    df, s, g = vectors(spark)
    i, j = np.triu_indices(90, 1)
    same = g[i] == g[j]
    want = {}
    for c, y in zip(np.round(s[i, j], 6), same, strict=True):
        p = want.setdefault(float(c) + 0.0, [0, 0])
        p[0 if y else 1] += 1
    h = P.cosine_histogram(df, block=25)
    assert {r.cut: [r.p, r.n] for r in h.collect()} == want
    c = P.cut_counts(df, 0.2, block=25).first()
    assert (c.kept, c.missed, c.false_links) == (int((s[i, j][same] >= 0.2).sum()), int((s[i, j][same] < 0.2).sum()), int((s[i, j][~same] >= 0.2).sum()))
    assert abs(c.separation - (s[i, j][same].min() - s[i, j][~same].max())) < 1e-8
    scored = spark.createDataFrame([(0.9, True), (0.8, True), (0.7, False), (0.8, False), (0.1, False)], "score double, same boolean")
    assert P.best_cut(P.score_histogram(scored)).first().asDict() == {"cut": 0.8, "kept": 2, "missed": 0, "false_links": 1, "balanced_accuracy": round((1 + 2 / 3) / 2, 9)}


def test_rank_of_first_match(spark):
    df, s, g = vectors(spark)
    t = s.copy()
    np.fill_diagonal(t, -2)
    want = {}
    for i in range(90):
        best = t[i][(g == g[i]) & (np.arange(90) != i)].max()
        want[i] = 1 + int((t[i] > best).sum())
    assert {r.id: r["rank"] for r in P.rank_of_first_match(df, block=25).collect()} == want
    alone = spark.createDataFrame([(1, "a", [1.0]), (2, "b", [1.0]), (3, "b", [0.5])], "id int, grp string, embedding array<double>")
    assert {r.id: r["rank"] for r in P.rank_of_first_match(alone).collect()} == {2: 1, 3: 1}


def test_similar_groups(spark):
    df, s, _ = vectors(spark)
    for least in (0.7, 0.95):
        at = list(range(90))
        for _ in range(90):
            for i in range(90):
                for j in range(90):
                    if i != j and s[i, j] >= least:
                        at[i] = at[j] = min(at[i], at[j])
        assert {r.id: r.component for r in P.similar_groups(df, least, block=25).collect()} == dict(enumerate(at))
    assert P.similar_groups(df.limit(0), 0.5).collect() == [] and P.cosine_histogram(df.limit(1)).collect() == []
    assert P.cut_counts(df.limit(0), 0.5).first().kept == 0
