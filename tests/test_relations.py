import random

import numpy as np

from evigraph.functions import kernel
from evigraph.operators import cluster, ledger, pairs, reconcile, resolve, search


def test_components_against_union_find(spark):
    r = random.Random(7)
    edges = [(r.randint(0, 150), r.randint(0, 150)) for _ in range(110)] + [(i, i + 1) for i in range(200, 260)] + [(300, i) for i in range(301, 340)] + [(None, 1), (5, 5)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    got = {x.id: x.component for x in cluster.components(spark.createDataFrame(edges, "a bigint, b bigint"), spark.createDataFrame([(999,), (None,)], "id bigint")).collect()}
    assert got == {i: find(i) for i in parent} | {999: 999}
    assert cluster.components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_reconcile_is_a_multiset_difference(spark, rows):
    old = spark.createDataFrame([("r", "h", 1), ("r", "h", 2), ("r", "g", 3), ("r", None, 4)], "rid string, h string, seq int")
    new = spark.createDataFrame([("r", "h", 10), ("r", "k", 11), ("r", None, 12)], "rid string, h string, seq int")
    got = rows(reconcile.reconcile(old, new, ["rid", "h"], "seq", "seq"), "h", "old", "new", "action")
    assert sorted(got, key=repr) == sorted([("h", 2, 10, "carry"), ("h", 1, None, "delete"), ("g", 3, None, "delete"), ("k", None, 11, "insert"), (None, 4, None, "delete"), (None, None, 12, "insert")], key=repr)
    again = reconcile.reconcile(new, new, ["rid", "h"], "seq", "seq").where("h IS NOT NULL AND action <> 'carry'")
    assert again.count() == 0


def test_upserts_and_sets(spark, rows):
    a = spark.createDataFrame([("k", 1), ("l", 1)], "k string, v int")
    b = spark.createDataFrame([("k", 2), ("m", 2)], "k string, v int")
    assert rows(reconcile.upsert(a, b, ["k"])) == [("k", 2), ("l", 1), ("m", 2)] and rows(reconcile.upsert(a, b, ["k"], keep="old")) == [("k", 1), ("l", 1), ("m", 2)]
    assert rows(reconcile.replace_sets(a, b, "k")) == [("k", 2), ("l", 1), ("m", 2)]
    assert rows(reconcile.differences(a, a.unionByName(a.limit(1)))) == [("right", "k", 1)]


def test_merges_in_their_order(spark, rows):
    r = random.Random(8)
    for n in (3, 12, 40):
        events = [(f"n{r.randrange(n)}", f"n{r.randrange(n)}", r.randrange(30)) for _ in range(2 * n)] + [(None, "n0", 1), ("n0", None, 1)]
        root = {f"n{i}": f"n{i}" for i in range(n)}
        for _, s, v in sorted({(at, s, v) for s, v, at in events if s and v and s != v}):
            a, b = root[s], root[v]
            root = {k: a if x == b else x for k, x in root.items()}
        got = dict(rows(ledger.merge_map(spark.createDataFrame(events, "survivor string, victim string, at int")), "node_id", "survivor"))
        assert got == {k: x for k, x in root.items() if k != x}
    assert ledger.merge_map(spark.createDataFrame([], "survivor string, victim string, at int")).collect() == []


def test_merge_then_undo_changes_nothing(spark, rows):
    edges = spark.createDataFrame([("c1", "a", "mentioned"), ("c1", "b", "subject"), ("c2", "b", None), ("c3", "z", "setting")], "claim_id string, node_id string, salience string")
    merges = spark.createDataFrame([("a", "b", 1), ("q", "a", 2)], "survivor string, victim string, at int")
    m = ledger.merge_map(merges)
    assert rows(m, "node_id", "survivor") == [("a", "q"), ("b", "q")]
    merged = reconcile.repoint_edges(edges, m)
    assert rows(merged, "claim_id", "node_id", "salience") == [("c1", "q", "subject"), ("c2", "q", None), ("c3", "z", "setting")]
    assert rows(reconcile.undo_merge(merged, reconcile.reversal(edges, m), m)) == rows(edges)


def test_ledgers(spark, rows):
    ev = spark.createDataFrame([(1, None, 10), (2, 1, 20), (3, 1, 30), (4, 9, 40), (5, None, 50), (6, 5, 45)], "id int, compensates int, at int")
    act, refused = ledger.active(ev)
    assert rows(act, "id") == [(5,)] and rows(refused, "id", "reason") == [(3, "already taken back"), (4, "unknown event"), (6, "not later")]
    assert rows(ledger.tips(spark.createDataFrame([(1, None), (2, 1), (3, None)], "id int, supersedes int")), "id") == [(2,), (3,)]
    st = spark.createDataFrame([("k", 1, "a"), ("k", 2, "b"), ("k", 2, "c"), ("l", 1, "x")], "k string, at int, v string")
    assert rows(ledger.latest(st, ["k"], ["at", "v"], "v")) == [("k", "c", 3, True), ("l", "x", 1, False)]


def test_overlapping_texts_against_brute_force(spark):
    r = random.Random(11)
    base = [[f"w{r.randint(0, 400)}" for _ in range(r.randint(8, 60))] for _ in range(40)]
    texts = []
    for i in range(150):
        w = list(r.choice(base))
        for _ in range(r.randint(0, 4)):
            w[r.randrange(len(w))] = f"z{r.randint(0, 9)}"
        if i % 9 == 0:
            w = w[: len(w) // 2] + [f"q{r.randint(0, 999)}" for _ in range(r.choice([0, 2, 90]))]
        texts.append((i, " ".join(w)))
    texts += [(900, None), (901, ""), (902, "one two"), (903, "One, two!")]
    sh = lambda t: {tuple(t.split()[k : k + 5]) for k in range(max(len(t.split()) - 4, 1))}
    p, m = pairs.overlapping(spark.createDataFrame(texts, "id int, text string"))
    rep = {x.id: x.rep for x in m.collect()}
    assert rep[903] == 902 and 900 not in rep and 901 not in rep
    sets = {i: sh(t) for i, t in texts[:150]}
    reps = sorted({rep[i] for i in sets})
    want = {(a, b) for a in reps for b in reps if a < b and (len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.6 or sets[a] & sets[b] and len(sets[a] & sets[b]) / min(len(sets[a]), len(sets[b])) >= 0.9)}
    got = {(x.a, x.b) for x in p.collect()}
    assert got == want and len(want) > 20


def test_exact_neighbours_in_blocks(spark):
    x = np.random.default_rng(1).standard_normal((90, 6))
    df = spark.createDataFrame([(i, i % 3, [float(v) for v in x[i]]) for i in range(90)], "id int, grp int, embedding array<float>")
    u = x.astype(np.float32).astype(float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    s = np.round(u @ u.T, 9)
    for other in (False, True):
        got = {}
        for r in pairs.cosine_pairs(df, 4, block=25, other_group=other).collect():
            got.setdefault(r.id, []).append((r.place, r.other))
        for i in range(90):
            ok = [j for j in range(90) if j != i and not (other and j % 3 == i % 3)]
            assert [j for _, j in sorted(got[i])] == sorted(ok, key=lambda j: (-s[i, j], j))[:4]


def test_fuzzy_pairs_lose_nothing(spark, small):
    from evigraph.operators.graph import Graph

    n = Graph(spark, small).nodes("node_type", "name").selectExpr("node_type AS kind", "name").distinct()
    extra = [("person", x) for x in ("A. Marsh", "Adam Marsh", "Adam Marsh Vale", "Marsh, Adam", "Marshe, Adam", "Adem Mersh")] + [("place", x) for x in ("Peru, Lima, Dock 51", "Lima, Dock 51", "Peru, Lima, Dock 52", "Dock 51", "Lima Dock")]
    extra += [("event", x) for x in ("1951 Coast Signal Review Panel (CSRP) hearing", "1951 CSRP hearing", "1951 CSRP hearings", "CSRP", "Coast Signal Review Panel (CSRP)", "Panel (CSRP) hearing")]
    names = n.union(spark.createDataFrame(extra, "kind string, name string")).distinct()
    got = {(r.kind, r.a, r.b): r.similarity for r in resolve.fuzzy_pairs(names, names).where("a < b").collect()}
    every = [tuple(r) for r in names.collect()]
    want = {(k, a, b): kernel.similarity(a, b) for k, a in every for q, b in every if k == q and a < b and kernel.similarity(a, b) >= kernel.FUZZY}
    assert got == want


def test_fuzzy_pairs_lose_no_one_sided_numbers(spark):
    place = "Vemviskwand Observation Wing"
    names = [place, f"{place} 26", f"{place} Annex", f"{place} 27", "Kevin Observation 26", "K. O. 26", "Norlund Wing, Annex 3", "Norlund Wing, Annex"] + [f"Vemviskwand {x} {y}" for x in ("Observation", "Wing") for y in ("Radar", "Tower", "Hangar")]
    df = spark.createDataFrame([("place", n) for n in names], "kind string, name string")
    got = {(r.a, r.b): r.similarity for r in resolve.fuzzy_pairs(df, df).where("a < b").collect()}
    assert got == {(a, b): kernel.similarity(a, b) for a in names for b in names if a < b and kernel.similarity(a, b) >= kernel.FUZZY}
    assert (f"{place} 26", f"{place} Annex") in got


def test_near_tokens_lose_nothing(spark):
    r = random.Random(3)
    words = {"".join(r.choices("abcd", k=r.randint(1, 12))) for _ in range(220)}
    words |= {w[: len(w) // 2] + "x" + w[len(w) // 2 :] for w in list(words)[:80]} | {w + "q" for w in list(words)[:40]}
    got = {(x.t, x.u) for x in resolve.near_tokens(spark.createDataFrame([(w,) for w in words], "t string")).collect()}
    assert got == {(a, b) for a in words for b in words if a != b and len(a) > 2 and len(b) > 2 and kernel.ratio(a, b) >= 0.81}


def test_match_tiers(spark):
    nodes = spark.createDataFrame([("1", "person", "Robert Marsh", 2), ("2", "organisation", "Defence Signal Agency (DSA)", 3), ("3", "organisation", "KLOS-TV", 4), ("4", "object", "H-2 Gull", 5), ("5", "person", "Ada Brenner", 6), ("6", "person", "Robert Marsh", 1), ("7", "person", "Vale", 7)], "id string, node_type string, name string, seq int")
    aliases = spark.createDataFrame([("Grey Book", "4"), ("Ada", "5")], "alias string, node_id string")
    refs = spark.createDataFrame([("6", 2), ("1", 9)], "node_id string, refs int")
    asked = [("person", "Robert Marsh"), ("organisation", "klos tv"), ("organisation", "DSA"), ("object", "H2Gull"), ("person", "Bob Marsh"), ("person", "Ada Brener"), ("object", "Grey Book"), ("person", "[interviewer]"), ("person", "Nobody Known"), ("place", "DSA"), ("person", "Vale"), ("person", "Ada")]
    got = {r.name: (r.node_id, r.tier) for r in resolve.match_names(spark.createDataFrame(asked, "kind string, name string"), nodes, aliases, refs).collect()}
    assert got == {"Robert Marsh": ("1", "exact"), "klos tv": ("3", "equivalent"), "DSA": ("2", "acronym"), "H2Gull": ("4", "punctuation"), "Bob Marsh": ("6", "nickname"), "Ada Brener": ("5", "fuzzy"), "Grey Book": ("4", "alias")}


def test_match_in_record(spark):
    people = [("r1", "1", "Ada Brenner"), ("r1", "2", "Tom Vale"), ("r1", "3", "Tim Vale"), ("r1", "4", "Lind"), ("r2", "1", "Ada Brenner"), ("r2", "1", "Ada Brenner"), ("r2", "5", None)]
    aliases = spark.createDataFrame([("The pilot", "2"), ("The pilot", "5")], "alias string, node_id string")
    asked = [("r1", "Brenner"), ("r1", "Vale"), ("r1", "Tom"), ("r1", "Lind"), ("r1", "The pilot"), ("r2", "Vale"), ("r2", "Ada"), ("r1", "A."), ("r1", None)]
    out = resolve.match_in_record(spark.createDataFrame(asked, "record_id string, name string"), spark.createDataFrame(people, "record_id string, node_id string, name string"), aliases)
    got = {(r.record_id, r.name): (r.node_id, r.via) for r in out.collect()}
    assert got == {("r1", "Brenner"): ("1", "word"), ("r1", "Tom"): ("2", "word"), ("r1", "Lind"): ("4", "name"), ("r1", "The pilot"): ("2", "alias"), ("r2", "Ada"): ("1", "word")}


def test_fuller_names(spark):
    people = [("A. Brenner",), ("Ada Brenner",), ("Anna Brenner",), ("T. Vale",), ("Ada's Brenner",), ("Tom Marsh",), (None,)]
    got = [tuple(r) for r in resolve.fuller_names(spark.createDataFrame(people, "name string")).collect()]
    assert got == [("A. Brenner", 2, "Ada Brenner")]



def test_search(spark, rows):
    docs = spark.createDataFrame([("a", "a radar return"), ("b", "radar"), ("c", "nothing"), ("d", None)], "id string, content string")
    vec = spark.createDataFrame([("a", [1.0, 0.0]), ("c", [0.0, 1.0]), ("e", [0.0, 0.0])], "id string, embedding array<float>")
    assert [r.id for r in search.keyword_search(docs, "the radar return").collect()] == ["a", "b"]
    assert search.query_tokens("of the") == ["of", "the"] and search.keyword_search(docs, "").collect() == []
    assert [(r.id, r.distance) for r in search.vector_search(vec, [1.0, 0.0]).collect()] == [("a", 0.0), ("c", 1.0), ("e", 1.0)]
    got = [(r.id, r.distance) for r in search.hybrid_search(docs, vec, "radar return", [1.0, 0.0], limit=3).collect()]
    assert got[0] == ("a", -0.25) and {g[0] for g in got} == {"a", "b", "c"}
    assert [r.id for r in search.hybrid_search(docs, vec, "zzz", [0.0, 1.0], limit=1).collect()] == ["c"]
    assert [r.id for r in search.hybrid_search(docs, vec, "radar", [1.0, 0.0], limit=1, rerank=lambda p: [float(t == "nothing") for _, t in p]).collect()] == ["c"]


def test_fuzzy_pairs_of_two_sides(spark, monkeypatch):
    frequent = [("organisation", f"{x} Observation Bureau") for x in ("Kelm", "Dorvik", "Tandrel", "Moskwin", "Brelund")]
    left = [("organisation", "Kelm Obsrvation Bureau"), ("person", "A. Marsh"), ("place", "Peru, Lima, Dock")]
    right = [*frequent, ("person", "Adam Marsh"), ("place", "Lima, Dock"), ("place", "Dock, Harbour"), ("person", "Adem Marsh")]
    tables, wrote = {}, resolve.materialise
    monkeypatch.setattr(resolve, "materialise", lambda df, name, *more: tables.setdefault(name, wrote(df, name, *more)))
    df = lambda x: spark.createDataFrame(x, "kind string, name string")
    got = {(r.kind, r.a, r.b): r.similarity for r in resolve.fuzzy_pairs(df(left), df(right)).collect()}
    assert got == {(k, a, b): kernel.similarity(a, b) for k, a in left for q, b in right if k == q and kernel.similarity(a, b) >= kernel.FUZZY}
    # names of one side aren't compared, nor names that share a misspelled frequent word alone
    assert {(r.a, r.b) for r in tables["candidates"].collect()} == {(a, b) for _, a, b in got}


def test_near_tokens_of_any_length(spark):
    r = random.Random(5)
    words = {"".join(r.choices("abcde", k=r.randint(9, 24))) for _ in range(80)}
    words |= {"".join(c for i, c in enumerate(w) if i not in r.sample(range(len(w)), r.randint(1, 4))) for w in list(words)} | {w[:6] + "yx" + w[6:] for w in list(words)[:40]}
    got = [(x.t, x.u) for x in resolve.near_tokens(spark.createDataFrame([(w,) for w in words], "t string")).collect()]
    assert len(got) == len(set(got)) and set(got) == {(a, b) for a in words for b in words if a != b and kernel.ratio(a, b) >= 0.81}


def test_match_of_the_first_tiers(spark, monkeypatch):
    from evigraph.plans import resolving

    monkeypatch.setattr(resolve, "fuzzy_pairs", lambda *a, **k: 1 / 0)
    nodes = spark.createDataFrame(resolving.CASE_NODES, "id string, node_type string, name string, seq long")
    asked = spark.createDataFrame([c[:2] for c in resolving.CASE_MATCHES], "kind string, name string")
    out = resolve.match_names(asked, nodes, spark.createDataFrame(resolving.CASE_ALIASES, "alias string, node_id string"), spark.createDataFrame(resolving.CASE_REFS, "node_id string, refs long"), upto="alias")
    assert {tuple(r)[:4] for r in out.collect()} == {c[:4] for c in resolving.CASE_MATCHES if c[3] in ("exact", "alias")}
