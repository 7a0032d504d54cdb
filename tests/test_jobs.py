from evigraph.operators import jobs as J

H = ["a" * 64, "b" * 64, "c" * 64, "d" * 64]


def test_ingest(spark, rows):
    s = spark.createDataFrame([(H[0], "MP3"), (H[0], "pdf"), (H[1], "pdf"), (H[2], "zip"), (H[2], None), (H[3], None), (None, "pdf")], "hash string, ext string")
    done, old = spark.createDataFrame([(H[1],)], "hash string"), spark.createDataFrame([(H[3],), (None,)], "hash string")
    assert rows(J.ingest_jobs(s, done, old), "hash", "label", "lane") == [(H[0], "audio/video aaaaaaaaaaaa", "gpu"), (H[2], "zip cccccccccccc", "eager")]
    assert J.ingest_jobs(s.limit(0), done, old).collect() == []


def test_rebuild_and_digest(spark, rows):
    k = lambda *x: spark.createDataFrame([(v,) for v in x], "key string")
    assert rows(J.rebuild_jobs(k("a", "b", "b"), k("a")), "status", "orphans") == [("blocked", 1)] and J.rebuild_jobs(k("a"), k("a", "c")).collect() == []
    d = spark.createDataFrame([(H[0], None, "T"), (H[1], "F", "T"), (H[2], None, None), (H[3], "x", None)], "hash string, friendly_name string, title string")
    reasons = spark.createDataFrame([(H[1], "old"), (H[1], "edited"), (H[1], "old"), (H[2], "old"), (H[3], None)], "hash string, reason string")
    demand = spark.createDataFrame([(H[0], 2.5)], "hash string, value double")
    got = rows(J.digest_jobs(d, spark.createDataFrame([(H[1],), (H[3],)], "hash string"), reasons, demand), "label", "trigger", "value", "reasons")
    assert got == [("F", "stale", None, ["edited", "old"]), ("T", "never_done", 2.5, []), ("record cccccccccccc", "never_done", None, [])]


def test_synthesise(spark, rows):
    cols = "reference string, node_id string, brief_hash string, payload_hash string, title string, node_ids array<string>"
    old = spark.createDataFrame([("p/a", "1", "h", "p", "A", ["1"]), ("p/b", "2", "h", "p", "B", ["2"]), ("p/z", "4", "h", "p", "Z", ["4"])], cols)
    new = spark.createDataFrame([("p/a", "1", "h", "p", "A", ["1"]), ("p/b", "2", "h2", "p", "B!", ["2", "3"]), ("p/c", "3", "h", "p", "C", ["3"]), ("p/d", "4", "h", "p", "D", ["4"])], cols)
    c = "reference string, place int, claim_id string, claim_hash string"
    oc = spark.createDataFrame([("p/b", 1, "x", "h"), ("p/b", 2, "y", "h"), ("p/b", 3, "z", None), ("p/b", 4, "w", "h")], c)
    nc = spark.createDataFrame([("p/b", 1, "y", "h"), ("p/b", 2, "x", "i"), ("p/b", 3, "z", None), ("p/b", 4, "v", "h")], c)
    got = rows(J.synthesise_jobs(old, new, oc, nc), "reference", "trigger", "reasons", "removed", "added", "changed", "moved")
    assert got == [("p/b", "stale_brief", ["page_identity_mismatch", "page_member_mismatch", "selection_hash_mismatch"], 1, 1, 1, 1), ("p/c", "never_done", ["brief_missing"], 0, 0, 0, 0), ("p/d", "stale_brief", ["brief_missing"], 0, 0, 0, 0)]


def test_assemble(spark, rows):
    b = spark.createDataFrame([(r, "h", "p") for r in ("ok", "stale", "cites", "gone", "edited", "gen", "up")] + [("nohash", None, "p")], "reference string, brief_hash string, payload_hash string")
    bc = spark.createDataFrame([("cites", "x", "1"), ("cites", "y", "1"), ("ok", "x", "1")], "reference string, claim_id string, claim_hash string")
    a = [("ok", "en", "h", "p", {"model": "m", "body_sha256": "s"}, "s"), ("stale", "de", "h", None, {}, "s"), ("cites", "en", "h", "p", None, None), ("edited", "en", "h", "p", {"body_sha256": "s"}, "t"), ("gen", "en", "h", "p", {"model": "old"}, "t"), ("up", "en", "h", "p", {}, "t")]
    arts = spark.createDataFrame(a, "reference string, language string, brief_hash string, payload_hash string, built_by map<string,string>, body_sha256 string")
    cites = spark.createDataFrame([("ok", "en", "x", "1"), ("cites", "en", "x", "2"), ("cites", "en", "q", "1"), ("cites", "en", "y", "1")], "reference string, language string, claim_id string, claim_hash string")
    up = spark.createDataFrame([("up",)], "reference string")
    got = rows(J.assemble_jobs(b, bc, arts, cites, {"model": "m", "other": "x"}, up), "id", "status", "trigger", "reasons", "consequence", "citations", "missing", "mismatched")
    assert got == [
        ("assemble:cites", "eligible", "stale_brief", ["citation_missing", "citation_hash_mismatch"], "repair", 3, 1, 1), ("assemble:edited", "blocked", "stale_brief", ["body_modified"], "verify", 0, 0, 0),
        ("assemble:gen", "eligible", "stale_brief", ["generator_changed"], "verify", 0, 0, 0), ("assemble:gone", "eligible", "never_done", ["article_missing"], "finish", 0, 0, 0),
        ("assemble:stale:de", "eligible", "stale_brief", ["payload_hash_mismatch"], "finish", 0, 0, 0), ("assemble:up", "blocked", "inherited_freshness", [], "finish", 0, 0, 0),
    ]


def test_graph_jobs(spark, rows):
    n = lambda *x: spark.createDataFrame([(v,) for v in x], "node_id string")
    p = spark.createDataFrame([(3, 10), (7, 3000)], "bucket int, pending int")
    assert rows(J.graph_jobs(n("a", "b"), n("b", "c"), p)) == [("embed:3", "embed", 10, 1), ("embed:7", "embed", 3000, 10), ("propose-pages", "propose", 2, None)]
    assert J.graph_jobs(n("a"), n("a", "a"), p.limit(0)).collect() == []
