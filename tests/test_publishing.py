from evigraph.operators import publishing as P


def test_published(spark, rows):
    b = spark.createDataFrame([("people/a.yaml", None, "A"), ("people/b.yaml", "not a mapping", None)], "file string, error string, title string")
    c = spark.createDataFrame([("people/a.yaml", "1", "h1"), ("people/a.yaml", "2", "h9"), ("people/a.yaml", "3", None), ("people/b.yaml", "4", "h1"), ("people/a.yaml", "5", "h2")], "file string, claim_id string, content_hash string")
    s = spark.createDataFrame([("h1", "public_domain"), ("h2", " "), (None, "x")], "content_hash string, status string")
    out, by_status, bad = P.published(b, c, s)
    assert rows(out) == [("people/a.yaml", "A", "published")] and rows(by_status) == [("public_domain", 1), ("unknown", 3)] and rows(bad) == [("people/b.yaml", "not a mapping")]
    assert P.published(b.limit(0), c, s)[1].collect() == []


def pages(spark):
    p = spark.createDataFrame([("p1", "Event", "events/event.yaml"), ("p2", "Solo", "events/solo.yaml")], "page_id string, name string, file string")
    return p, spark.createDataFrame([("p1", "n3", 0), ("p1", "n4", 1), ("p2", "n5", 0)], "page_id string, node_id string, position int")


def test_unbuildable(spark, rows):
    files = [
        ("people/gone.yaml", ["x", "y"]), ("people/none.yaml", ["n1"]), ("people/two.yaml", ["n2"]), ("old/two.yaml", ["n2"]), ("people/three.yaml", ["n3"]), ("events/event.yaml", ["n3", "n4"]), ("events/old.yaml", ["n3", "n4"]),
        ("events/split.yaml", ["n2", "n3"]), ("empty.yaml", []), ("people/five.yaml", ["n5"]), ("people/mixed.yaml", ["x", "n2"]),
    ]
    f = spark.createDataFrame(files, "file string, node_ids array<string>")
    ids = lambda *x: spark.createDataFrame([(v,) for v in x], "id string")
    current = spark.createDataFrame([(f"n{i}", f"people/{w}.yaml") for i, w in enumerate(["zero", "one", "two", "three", "four", "five"])], "id string, file string")
    args = (f, ids("n1", "n2", "n3", "n4", "n5"), ids("n2", "n3", "n4", "n5", "n5"), current, *pages(spark))
    base = {
        "people/gone.yaml": "node retired or absent", "people/none.yaml": "node has no claims", "old/two.yaml": "stale path; the node's brief is now people/two.yaml", "events/old.yaml": "stale path; the node's brief is now events/event.yaml",
        "events/split.yaml": "the composition it describes is gone", "people/mixed.yaml": "the composition it describes is gone",
    }
    assert {r.file: r.why for r in P.unbuildable(*args, None).collect()} == base
    articles = spark.createDataFrame([("events/event.yaml",)], "file string")
    assert {r.file: r.why for r in P.unbuildable(*args, articles).collect()} == base | {"people/three.yaml": "its subject moved to the composed page Event"}


def test_refiled(spark, rows):
    f = spark.createDataFrame([("people/old.yaml", ["n2"]), ("people/older.yaml", ["n2"]), ("people/two.yaml", ["n2"]), ("people/three.yaml", ["n3"]), ("people/x.yaml", ["n9"])], "file string, node_ids array<string>")
    renamed = spark.createDataFrame([("n2",), ("n3",), ("n7",)], "id string")
    current = spark.createDataFrame([("n2", "people/two.yaml"), ("n3", "people/three.yaml"), ("n7", "people/seven.yaml")], "id string, file string")
    got = rows(P.refiled(f, renamed, current, *pages(spark)))
    assert got == [(["n2"], "people/two.yaml", ["people/old.yaml", "people/older.yaml"]), (["n3", "n4"], "events/event.yaml", ["people/three.yaml"])]


def test_vault(spark, rows, monkeypatch):
    names = spark.createDataFrame([("1", "Ada [x]", "person"), ("2", "Dock", "place"), ("3", "Dock", "place"), ("4", None, "place")], "id string, name string, node_type string")
    edges = spark.createDataFrame([("c1", "1"), ("c1", "2"), ("c1", "3"), ("c2", "3"), ("c3", "2"), ("c4", "4")], "claim_id string, node_id string")
    claims = spark.createDataFrame([("c1", "saw\n it", "r1", "T"), ("c2", "same", "r1", "T"), ("c3", "same", "r1", "T"), ("c4", "lost", "r1", "T"), ("c5", None, None, None)], "id string, content string, record_id string, record string")
    monkeypatch.setattr(P, "PART", 1)
    lines = P.vault_lines(names, edges, claims)
    assert rows(lines, "folder", "file", "part", "line") == [("person", "Ada -x-.md", 0, "- saw it (T) [[Dock]]"), ("place", "Dock.md", 0, "- saw it (T) [[Ada x]]"), ("place", "Dock.md", 1, "- same (T)")]
    assert rows(P.vault_notes(lines), "file", "part") == [("Ada -x-.md", 0), ("Dock.md", 0), ("Dock.md", 1)]
    n = spark.createDataFrame([("A#b|c",), ("",), (None,)], "name string").select(P.wikilink("name").alias("w"))
    assert [r.w for r in n.collect()] == ["[[Abc]]", "_", "_"]
