import math
import random
from statistics import NormalDist

from pyspark.sql import functions as F

from evigraph.llm import ranking as R

SCHEMA = "id string, a double, b double, other string"


def brute(rows, names):
    best = {}
    for k, *v in rows:
        if k is None:
            continue
        v = [None if x is None or math.isnan(x) else x for x in v]
        best[k] = [x if y is None else y if x is None else max(x, y) for x, y in zip(best.get(k, [None] * len(v)), v, strict=True)]
    z = {k: [] for k in best}
    for i in range(len(names)):
        vals = sorted(v[i] for v in best.values() if v[i] is not None)
        for k, v in best.items():
            if v[i] is not None:
                p = (sum(x < v[i] for x in vals) + vals.count(v[i]) / 2) / len(vals)
                z[k].append(NormalDist().inv_cdf(p))
    fused = {k: (sum(v) / len(v) if v else None) for k, v in z.items()}
    return sorted(fused, key=lambda k: (fused[k] is None, -round(fused[k] or 0, 6), k)), fused


def test_against_brute_force(spark):
    r = random.Random(3)
    rows = [(f"k{i}", r.choice([0.0, 0.0, 1.0, r.random(), None, math.nan, math.inf]), r.choice([r.gauss(0, 1e6), 5.0, -math.inf]), "x") for i in range(200)]
    df = spark.createDataFrame(rows + rows[:9] + [(None, 1.0, 1.0, "x")], SCHEMA)
    got = R.gaussian_rank_fusion(df, "id", {"a": 1.0, "b": 1.0}).collect()
    order, fused = brute([x[:3] for x in rows], ["a", "b"])
    assert sorted(r.evidence_rank for r in got) == list(range(1, 201))
    for x in got:
        assert abs(x.fused - fused[x.id]) < 1e-6
    place = {x.id: x.evidence_rank for x in got}
    assert all(place[a] < place[b] for a, b in zip(order, order[1:], strict=False) if abs(fused[a] - fused[b]) > 1e-6 or abs(fused[a] - fused[b]) < 1e-12 and a < b)


def test_range_does_not_matter(spark):
    rows = [(f"k{i}", float(i % 17), float(i * 7 % 23), "x") for i in range(50)]
    a = R.gaussian_rank_fusion(spark.createDataFrame(rows, SCHEMA), "id", {"a": 1.0, "b": 1.0}).collect()
    b = R.gaussian_rank_fusion(spark.createDataFrame([(k, math.exp(x), 1e9 * y, o) for k, x, y, o in rows], SCHEMA), "id", {"a": 1.0, "b": 1.0}).collect()
    assert sorted(a) == sorted(b)


def test_nothing_to_rank(spark):
    assert R.gaussian_rank_fusion(spark.createDataFrame([], SCHEMA), "id", {"a": 1.0}).collect() == []
    got = R.gaussian_rank_fusion(spark.createDataFrame([("b", None, 1.0, ""), ("a", math.nan, None, "")], SCHEMA), "id", {"a": 1.0}).collect()
    assert [(r.id, r.evidence_rank, r.fused) for r in sorted(got, key=lambda r: r.evidence_rank)] == [("a", 1, None), ("b", 2, None)]


def test_percentiles_with_ties_and_pieces(spark):
    r = random.Random(1)
    vals = [float(r.choice([1, 1, 1, 2, r.randint(3, 400)])) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    s = sorted(vals)
    for x in R.percentiles(df, "v", pieces=8).collect():
        assert abs(x.p - (sum(y < x.value for y in s) + s.count(x.value) / 2) / len(s)) < 1e-12


def test_probit(spark):
    ps = [1e-6, 0.01, 0.02425, 0.3, 0.5, 0.7, 0.99, 1 - 1e-6]
    got = spark.createDataFrame([(p,) for p in ps], "p double").select("p", R.probit(F.col("p")).alias("z")).collect()
    assert all(abs(r.z - NormalDist().inv_cdf(r.p)) < 1e-7 for r in got)
