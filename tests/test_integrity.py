import random

from pyspark.sql import functions as F

from evigraph.operators import integrity as N


def missing(spark, parents, refs):
    p = spark.createDataFrame([("t", k, 1) for k in parents], "target string, key string, code int")
    r = spark.createDataFrame([("t", k, 1) for k in refs], "target string, key string, block int")
    return {x.key for x in N.missing_keys(p, r).collect()}


def test_integers_and_other_keys(spark):
    r = random.Random(5)
    parents = [str(i) for i in range(65_000, 66_200) if i % 100]
    parents += [f"id-{i}" for i in range(300)] + ["007", "0", "9" * 30]
    refs = [str(r.randint(64_900, 66_300)) for _ in range(900)] + [f"id-{r.randint(0, 400)}" for _ in range(300)] + ["7", "007", "0", "00", "9" * 30, "8" * 30, None] * 3
    assert missing(spark, parents, refs) == {x for x in refs if x is not None} - set(parents)


def test_runs_are_maximal_inside_blocks(spark):
    p = spark.createDataFrame([("t", str(k)) for k in [1, 2, 3, 7, 8, 65_535, 65_536]], "target string, key string")
    assert sorted((r.run_start, r.run_end) for r in N.key_runs(p).collect()) == [(1, 3), (7, 8), (65_535, 65_535), (65_536, 65_536)]


def test_equal_codes_are_told_apart(spark, monkeypatch):
    real = N.coded
    monkeypatch.setattr(N, "coded", lambda df, key: real(df, key).withColumns({c: F.lit(0).cast("bigint") for c in ("code", "block")}))
    assert missing(spark, ["a", "b"], ["a", "b", "c"]) == {"c"}


def test_empty_sides(spark):
    assert missing(spark, [], ["a", "1", None]) == {"a", "1"} and missing(spark, ["a"], []) == set()


def test_orphans(spark):
    claims = spark.createDataFrame([(" C1", "R1 ", "2025-01-31T23:59:59Z"), (" C1", "R1 ", "2025-01-31T23:59:59Z"), ("c2", "lost", "2025-02-01 00:00:00"), ("c3", " ", "2025-02-01"), ("c4", None, "x"), ("c5", "lost", "not a time"), ("c6", "late", "2025-03-01T00:30:00+01:00")], "id string, record_id string, created_at string")
    refs = spark.createDataFrame([("c1", "n1", "a"), ("C1", "gone", "a"), ("c2", "retired", "a"), ("nowhere", "gone", "a"), ("c2", None, "a"), ("c2", "retired", "a")], "claim_id string, node_id string, target string")
    receipts = spark.createDataFrame([("SHA256:" + "A" * 64, "lost", "2025-04-05T00:00:00.123456+00:00"), ("b" * 64, "r1", "2025-04-05")], "record_content_hash string, record_id string, imported_at string")
    records = spark.createDataFrame([("r1",), (None,)], "id string")
    nodes = spark.createDataFrame([("N1", None), ("retired", "2025"), ("both", "2025"), ("both", None)], "id string, retired_at string")
    got = {tuple(r) for r in N.orphan_references(claims, refs, receipts, records, nodes).collect()}
    assert got == {
        ("claims", "2025-02", "c2", "lost"), ("claims", None, "c5", "lost"), ("claims", "2025-02", "c6", "late"), ("claim_node_refs", "2025-01", "c1", "gone"),
        ("claim_node_refs", "2025-02", "c2", "retired"), ("claim_node_refs", None, "nowhere", "gone"), ("digest_import_receipts", "2025-04", "a" * 64, "lost"),
    }
    assert N.orphan_references(*[x.limit(0) for x in (claims, refs, receipts, records, nodes)]).collect() == []


def test_hot_key(spark):
    claims = spark.range(5000).selectExpr("concat('c', id) AS id", "IF(id % 3 = 0, 'hot', 'r1') AS record_id", "'2025-01-01' AS created_at")
    none = spark.createDataFrame([], "claim_id string, node_id string")
    got = N.orphan_references(claims, none, spark.createDataFrame([], "record_content_hash string, record_id string, imported_at string"), spark.createDataFrame([("r1",)], "id string"), spark.createDataFrame([], "id string, retired_at string"))
    assert got.count() == 1667
