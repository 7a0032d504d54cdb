from pyspark.sql import functions as F

from evigraph.functions import names
from evigraph.operators import briefs, gate
from evigraph.operators import evidence as E


def frame(spark, schema, rows):
    return spark.createDataFrame(rows, schema)


def test_spread_and_counts(spark, rows):
    nc = frame(spark, "nid string, cid string, rid string", [("n", f"c{i}", f"r{r}") for i, r in enumerate([1, 1, 1, 2, 2, 3, 4])] + [("m", "c0", "r1"), ("m", "x", None)])
    works = frame(spark, "rid string, work string", [("r1", "r1"), ("r2", "r2"), ("r3", "r2")])
    assert rows(E.spread_per_node(nc, works)) == [("m", 2, 1, 1, 1), ("n", 7, 3, 3, 3)]
    assert rows(E.counts_per_node(nc, works)) == [("m", 2, 1), ("n", 7, 3)]


def test_scores(spark):
    claims = frame(
        spark, "id string, claim_type string, attestation string, record_id string, speaker_id string, origin_kind string, origin string, origin_ref string",
        [("a", "observation", "first_hand", "r1", "s1", "speaker", None, None), ("b", "observation", "first_hand", "r2", "s2", "speaker", None, None), ("c", "opinion", None, "r3", None, None, None, None), ("d", "testimony", "second_hand", "r4", "s1", "speaker", None, None), ("e", "odd", "odd", "r5", None, "anonymous", None, "x")],
    )
    corr = frame(spark, "claim_a string, claim_b string, similarity double", [("a", "b", 0.9), ("a", "d", 0.9), ("d", "e", 0.9)])
    index = frame(spark, "name string, nid string", [])
    out = {r.claim_id: r for r in E.scores(claims, corr, index).collect()}
    assert (out["a"].source_count, out["a"].corroboration_count, out["a"].score, out["a"].tier) == (2, 2, 0.9375, "strong")
    assert (out["c"].source_count, out["c"].score, out["c"].tier) == (1, 0.15, "insufficient")
    assert out["d"].source_count == 2 and abs(out["d"].score - (1 - 0.52**2)) < 1e-9 and out["e"].base_weight == 0.25


def test_independence(spark, rows):
    claims = frame(
        spark, "id string, record_id string, speaker_id string, origin_kind string, origin string, origin_ref string",
        [("1", "r1", "s", "speaker", None, None), ("2", "r2", "s", "unattributed", None, None), ("3", "r3", None, "named", "DIA", None), ("4", "r4", None, "document", "Defense Intelligence Agency", None), ("5", "r5", None, "anonymous", None, "a"), ("6", "r5", None, "anonymous", None, "b"), ("7", "r6", None, "anonymous", None, None), ("8", "r7", None, None, None, None), ("9", "r8", None, "named", " ", None)],
    )
    index = frame(spark, "name string, nid string", [("dia", "n1"), ("defense intelligence agency", "n1")])
    nc = frame(spark, "nid string, cid string", [("x", str(i)) for i in range(1, 10)] + [("y", "8")])
    got = {r.nid: r for r in E.independence_per_node(nc, claims, index).collect()}
    assert (got["x"].sources, got["x"].scored, got["x"].unscored) == (4, 7, 2) and got["y"].sources is None and got["y"].unscored_share == 1.0


def test_reach_with_hubs_equals_pairs(spark, rows):
    nc = frame(spark, "nid string, rid string, cid string", [("hub", f"r{i}", "c") for i in range(30)] + [("n1", "r1", "c"), ("n1", "x", "c"), ("n2", "x", "c"), ("n2", "y", "c"), ("n3", "alone", "c"), ("n4", None, "c")])
    want = rows(E.record_reach(nc, hub=1000))
    assert want == rows(E.record_reach(nc, hub=2)) and dict((r[0], r[1]) for r in want) == {f"r{i}": 29 + (i == 1) for i in range(30)} | {"x": 2, "y": 1}
    assert E.record_reach(nc.limit(0)).collect() == []


def test_subject_counts(spark, rows):
    nodes = frame(spark, "id string, node_type string, name string", [("p", "person", "Ada Brenner"), ("o", "organisation", "Coast Signal Panel (CSP)"), ("l", "place", "Peru, Lima, Dock 7"), ("x", "object", "A+ (b) kit"), ("z", "person", None)])
    aliases = frame(spark, "node_id string, alias string", [("p", "Gull"), ("p", None), ("x", "")])
    texts = {
        "p": ["Ada Brenner saw it", "At noon on 8 July 1951, Commander Brenner ordered it", "The brenner report", "GULL went up", "According to Ada Brenner's wing it flew", "Brennerite", "Some Brenner", "", None, "A long clause " + "x" * 90 + ", Brenner said"],
        "o": ["the CSP met", "Coast signal panel met", "Panel met", "CSP-2 met"], "l": ["Dock 7 burnt", "Lima burnt"], "x": ["A+ (b) kit, found", "A (b) kit"], "z": ["Ada"],
    }
    rows_ = [(n, f"{n}{i}", t) for n, ts in texts.items() for i, t in enumerate([*ts, ts[0]])]
    nc, claims = frame(spark, "nid string, cid string", [r[:2] for r in rows_]), frame(spark, "id string, content string", [r[1:] for r in rows_])
    assert rows(gate.subject_counts(nodes, aliases, nc, claims)) == [("l", 1), ("o", 2), ("p", 4), ("x", 1)]
    assert gate.subject_counts(nodes, aliases, nc.limit(0), claims).collect() == []


def test_record_scoped_people(spark):
    df = frame(spark, "n string", [("[interviewer 2]",), ("Chris",), ("Dr. Chris",), ("Chris Doe",), ("Doe, J.",), (None,)])
    assert [r[0] for r in df.select(names.record_scoped("n")).collect()] == [True, True, True, False, False, None]


def chosen(claims, cap, budget, limit, focus):
    """A plain account of the selection, for one node: claims (source, id, key, importance, cost)."""
    claims = sorted(claims, key=lambda c: c[2])
    if len(claims) <= cap and limit is None:
        return [c[1] for c in claims]
    of = {}
    for c in claims:
        of.setdefault(c[0], []).append(c)
    first = {s: q[0][2] for s, q in of.items()}
    if limit is not None and len(of) > limit:
        by_focus = sorted(of, key=lambda s: (-focus.get(s, 0.0), -len(of[s]), first[s]))
        pool = [s for s in by_focus if len(of[s]) >= briefs.SUBSTANTIAL] or by_focus
        order = pool[:1] + sorted(pool[1:], key=lambda s: (-len(of[s]), first[s])) + [s for s in by_focus if s not in pool]
        of = {s: of[s] for s in order[:limit]}
    turns = sorted((t, first[s], c) for s, q in of.items() for t, c in enumerate(sorted(q, key=lambda c: (-c[3], c[2]))))
    out, spent = [], 0
    for _, _, c in turns[:cap]:
        spent += c[4]
        if budget is not None and spent > budget:
            break
        out.append(c[1])
    return out


def test_selection_against_a_plain_account(spark):
    import random

    r = random.Random(5)
    rows_, want = [], {}
    focus = {(f"n{n}", f"s{s}"): r.choice([0.0, 0.2, 0.5, 1.0]) for n in range(60) for s in range(9)}
    for n in range(60):
        claims = [(r.choice([None, *[f"s{s}" for s in range(n % 9)]]), f"c{n}-{i}", i * 7 % 101, r.choice([0, 1, 100, 1000]), r.randint(1, 60)) for i in range(r.randint(1, 50))]
        limit = 3 if n % 2 else None
        rows_ += [(f"n{n}", limit, *c) for c in claims]
        of = {s: focus[(f"n{n}", s)] for s in {c[0] for c in claims} if s}
        want[f"n{n}"] = {k: sorted(chosen(claims, 12, k, limit, of)) for k in (None, 200)}
    df = frame(spark, "node string, lim int, source string, id string, key int, importance int, cost long", rows_)
    f = frame(spark, "node string, source string, focus double", [(n, s, v) for (n, s), v in focus.items()])
    for budget in (None, 200):
        got = {}
        for x in briefs.spread_selection(df, 12, budget, F.col("lim"), f).collect():
            got.setdefault(x.node, []).append(x.id)
        assert {n: sorted(v) for n, v in got.items()} == {n: v[budget] for n, v in want.items() if v[budget]}
    assert briefs.spread_selection(df.limit(0), 12, 200).collect() == []


def test_suspect_claims_come_last(spark, rows):
    df = frame(spark, "id string, suspect boolean, hit boolean, own boolean, attestation string", [("a", True, True, True, "first_hand"), ("b", None, None, None, None), ("c", False, False, False, "second_hand"), ("d", False, True, False, None), ("e", False, False, True, "third_hand")])
    got = df.select("id", briefs.importance(F.col("suspect"), F.col("hit"), F.col("own")).alias("v"))
    assert [r.id for r in got.orderBy(F.desc("v")).collect()] == ["d", "e", "c", "b", "a"]
    assert briefs.budget_for(1000) == 850


def test_slugs(spark, rows):
    df = frame(spark, "id string, node_type string, name string", [("aaaaaaaaaa", "person", "Jo Doe"), ("bbbbbbbbbb", "person", "Jo  Doe!"), ("cccccccccc", "place", "Jo Doe")])
    assert rows(briefs.slug_map(df), "id", "slug") == [("aaaaaaaaaa", "jo-doe"), ("bbbbbbbbbb", "jo-doe-bbbbbbbb"), ("cccccccccc", "jo-doe")]


def test_compacted_graph_answers_the_same(spark, small, tmp_path, rows):
    from evigraph.operators.graph import Graph

    a = Graph(spark, small)
    b = a.compact(str(tmp_path / "clean"))
    for f in (lambda g: g.node_claims(), lambda g: g.works(), lambda g: g.nodes("node_type", "name"), lambda g: g.edges(), lambda g: ev_scores(g)):
        assert rows(f(a)) == rows(f(b))


def ev_scores(g):
    c = g.claims("claim_type", "attestation", "record_id", "speaker_id", "origin_kind", "origin", "origin_ref")
    return E.scores(c, g.corroborations(), E.name_index(g.nodes("name"), g.aliases(), False)).select("claim_id", "score", "tier")
