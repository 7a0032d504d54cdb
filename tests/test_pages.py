from pyspark.sql import functions as F

from evigraph.operators import pages as P

MEMBER = "array<struct<name:string,node_type:string,prior_names:array<string>>>"
NODES = [("n1", "person", "Ada Brenner"), ("n2", "person", "Tom Vale"), ("n3", "person", "Tom Vale"), ("n4", "organisation", "KL-TV"), ("n5", "event", "Coast Sighting"), ("n6", "organisation", "Under Sea Watch")]


def graph(spark):
    nodes = spark.createDataFrame(NODES, "id string, node_type string, name string")
    return nodes, spark.createDataFrame([("The Gull", "n5"), ("The Gull", "n1")], "alias string, node_id string")


def test_identities(spark, rows):
    asked = [("a", "Ada Brenner", "person", None), ("b", "Tom Vale", "person", None), ("c", "KL TV", "organisation", None), ("d", "New Name", "event", ["Coast Sighting", None]), ("e", "The Gull", "event", []), ("f", "Undersea-Watch", "organisation", None), ("g", "Ada Brener", "person", None), ("h", "Ada Brenner", "place", None), ("i", None, "person", None)]
    df = spark.createDataFrame(asked, "ref string, name string, node_type string, prior_names array<string>")
    got = {r.ref: (r.node_id, r.state) for r in P.resolve_identities(df, *graph(spark)).collect()}
    ok = lambda n: (n, "resolved")
    assert got == {"a": ok("n1"), "b": (None, "ambiguous"), "c": ok("n4"), "d": ok("n5"), "e": ok("n5"), "f": ok("n6"), "g": (None, "lost"), "h": (None, "lost"), "i": (None, "lost")}


def test_vetoes(spark, rows):
    m = lambda *names: [(n, t, None) for n, t in names]
    events = [("veto", "v1", 1, "why", m(("Ada Brenner", "person"), ("Tom Vale", "person"))), ("veto", "v2", 2, None, m(("KL-TV", "organisation"))), ("unveto", "v2", 1, None, None), ("veto", "v1", 3, "later", m(("Ada Brenner", "person"))), ("veto", None, 3, "x", m(("KL-TV", "organisation")))]
    df = spark.createDataFrame(events, f"op string, veto_id string, at int, reason string, nodes {MEMBER}")
    assert rows(P.active_vetoes(df, *graph(spark))) == [("v1", "n1", "later", 3)]
    assert P.active_vetoes(df.limit(0), *graph(spark)).collect() == []


def test_compositions(spark, rows):
    m = lambda *names: [(n, t, None) for n, t in names]
    ada, gull, lost = ("Ada Brenner", "person"), ("Coast Sighting", "event"), ("Nobody", "person")
    events = [
        ("compose", "p1", 1, True, "Coast Sighting", None, "event", m(gull, lost, ada, gull)), ("compose", "p2", 1, None, "X", "x", "event", m(ada)), ("compose", "p3", 1, True, "Y", None, "event", m(lost)),
        ("compose", "p4", 1, True, "Z", None, "event", m(ada)), ("decompose", "p4", 2, None, None, None, None, None), ("compose", "p5", 1, True, "W", None, "event", None),
    ]
    df = spark.createDataFrame(events, f"op string, page_id string, at int, confirmed boolean, name string, slug string, node_type string, members {MEMBER}")
    pages, members, gone = P.composed_pages(df, *graph(spark))
    assert rows(pages, "page_id", "slug", "section", "state", "members", "dropped") == [("p1", "coast-sighting", "events", "composed", 2, 1), ("p2", "x", "events", "unconfirmed", 1, 0), ("p3", "y", "events", "lost", 0, 1), ("p5", "w", "events", "lost", 0, 0)]
    assert rows(members) == [("p1", "n1", 1), ("p1", "n5", 0)]
    assert rows(gone) == [("people", "ada-brenner", "p1", "n1")]
    gate = spark.createDataFrame([("n1", 9), ("n4", 8)], "node_id string, claims int")
    assert rows(P.page_set(gate, pages, members)) == [("n4", ["n4"]), ("p1", ["n5", "n1"])]
    i = spark.createDataFrame([("n4", None, 3)], "nid string, sources int, unscored int")
    assert rows(P.proposals(gate, members.limit(0), members, i)) == [("n4", 8, None, 3)]
    assert P.proposals(gate, gate, members, i).where(F.lit(True)).collect() == []
