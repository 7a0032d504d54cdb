from evigraph.operators import claimrefs as C
from evigraph.operators import consistency as K

NODES = [("n1", "person", "Ada", 1, "ada"), ("n2", "person", "Tom", 2, "tom"), ("n3", "place", "Dock", 3, "dock"), ("n4", "place", "Peru, Dock", 4, "peru-dock"), ("n5", "person", "Eve", 5, "eve")]


def test_findings(spark, rows):
    nodes = spark.createDataFrame(NODES, "id string, node_type string, name string, seq int, slug string")
    p = spark.createDataFrame([("n1",), ("n2",), ("gone",), ("n5",), (None,), ("n1",)], "node_id string")
    briefs = spark.createDataFrame([("people/ada", ["n1"], "h", "p"), ("people/old", ["n1"], "h", None), ("people/dead", ["x", "y"], "h", "p"), ("events/both", ["x", "n2"], "h", "p"), ("people/eve", ["n5"], "h", "p")], "reference string, node_ids array<string>, brief_hash string, payload_hash string")
    articles = spark.createDataFrame([("people/ada", "h", "p"), ("people/old", "h", "p"), ("events/both", "g", "p"), ("people/none", "h", "p")], "reference string, brief_hash string, payload_hash string")
    undone = spark.createDataFrame([("n5", "veto-1234567"), ("n1", "veto-2")], "node_id string, veto_id string")
    got = {r[0]: (r[1], r[2]) for r in K.findings(p, nodes, briefs, articles, undone).collect()}
    assert got == {
        "proposal-points-at-dead-node": (1, ["gone"]), "brief-for-dead-node": (1, ["people/dead"]), "brief-stranded-by-rename": (1, ["people/old"]), "page-trails-its-brief": (2, ["events/both", "people/old"]),
        "veto-undone-page-absent": (1, ["people/eve (veto veto-123)"]), "one-place-two-nodes": (1, ["Dock = Peru, Dock"]),
    }
    few = {r[0]: r[1] for r in K.findings(p, nodes, briefs.limit(0)).collect()}
    assert few == {"proposal-points-at-dead-node": 1, "proposal-without-brief": 3, "one-place-two-nodes": 1}
    assert K.findings(p.limit(0), nodes.limit(0), briefs.limit(0), articles, undone).collect() == []


def test_judgements(spark, rows):
    node = lambda n: (n, "person", ["b", "a"])
    e = [
        (1, "s1", "set", "h", "f", node("Ada"), "verified", "2025-01-01T00:00:00Z", None), (2, "s2", "set", "h", "f", node("Ada"), "suspect", "2025-01-02T00:00:00Z", None), (3, "u1", "unset", None, None, None, None, "2025-01-03T00:00:00Z", "s2"),
        (4, "s3", "set", "h", "g", node("Ada"), "suspect", "2025-01-01T00:00:00Z", None), (5, "s4", "set", "h", "g", node("Ada"), "verified", "2025-01-01T00:00:00Z", None), (6, "s5", "set", "h", "k", node("Tom"), "doubtful", "2025-01-01T00:00:00Z", None),
        (7, "u2", "unset", None, None, None, None, "2025-01-03T00:00:00Z", "zz"), (8, "s6", "set", "h", "k", node("Tom"), "suspect", "2025-01-01T00:00:00Z", None), (9, "s7", "set", "h", "m", node("Ada"), "suspect", "2025-01-01T00:00:00Z", None), (10, "s8", "set", "h", "e", node("Ada"), "suspect", "2025-01-01T00:00:00Z", None),
    ]
    df = spark.createDataFrame(e, "seq int, id string, op string, record_hash string, claim_fingerprint string, node struct<name:string,node_type:string,prior_names:array<string>>, status string, set_at string, reverses string")
    s, problems = C.active_statuses(df)
    assert rows(s, "claim_fingerprint", "status") == [("e", "suspect"), ("f", "verified"), ("k", "suspect"), ("m", "suspect")]
    assert rows(problems) == [("s4", "contradiction"), ("s5", "unknown status"), ("zz", "unknown_operation")]
    claims = spark.createDataFrame([("c1", "h", "f"), ("c2", "h", "k"), ("c3", "h", "m"), ("c4", "h", "m"), ("c5", "h", "e")], "id string, record_hash string, claim_fingerprint string")
    nodes = spark.createDataFrame([("n1", "person", "Ada"), ("n2", "person", "Tom"), ("n3", "person", "Tom")], "id string, node_type string, name string")
    edges, aliases = spark.createDataFrame([("c1", "n1")], "claim_id string, node_id string"), spark.createDataFrame([], "alias string, node_id string")
    found, lost = C.replayed(s, claims, edges, nodes, aliases)
    assert rows(found) == [("c1", "n1", "verified")] and rows(lost, "claim_fingerprint", "why") == [("e", "edge gone"), ("k", "node ambiguous"), ("m", "several claims")]
    ids = {r.i for r in df.where("op = 'set'").select(C.event_id().alias("i")).collect()}
    assert len(ids) == 8
