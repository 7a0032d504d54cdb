from evigraph.operators import merging as M
from evigraph.plans.merging import CASE_CONFIRMATIONS, CASE_RELATIONS, CASE_VERDICTS


def pairs(spark, rows, cols="a string, b string, score double"):
    return spark.createDataFrame(rows, cols)


def test_names_count_before_similarity(spark, rows):
    names, fuzzy = pairs(spark, [("b", "a", 0.9), ("a", "a", 0.9), ("a", None, 0.9)]), pairs(spark, [("a", "b", 1.0), ("b", "c", 0.8)])
    assert rows(M.labelled_edges(names, fuzzy)) == [("a", "b", 0.9, "name-equivalent"), ("b", "c", 0.8, "fuzzy")]


def test_rejected_pairs_split_clusters(spark, rows):
    edges = M.labelled_edges(pairs(spark, [("a", "b", 0.95), ("c", "d", 0.95)]), pairs(spark, [("b", "c", 0.8)]))
    nodes = spark.createDataFrame([(x, x.upper(), "person") for x in "abcd"], "id string, name string, node_type string")
    claims = spark.createDataFrame([("b", 4), ("c", 9), ("d", 9)], "node_id string, claims int")
    none = edges.select("a", "b").limit(0)
    cards, m = M.clusters_of(edges, none, nodes, claims)
    assert rows(cards) == [("a", 4, "C", "person", 0.95, "name-equivalent")] and rows(m, "node_id") == [("a",), ("b",), ("c",), ("d",)]
    cards, m = M.clusters_of(edges, pairs(spark, [("c", "b")], "a string, b string"), nodes, claims)
    assert rows(cards, "component", "members", "suggested_canonical") == [("a", 2, "B"), ("c", 2, "C")]
    out = M.reranked(cards, m, pairs(spark, [("b", "a", 0.3), ("a", "b", 0.4), ("a", "c", 0.99)]))
    assert rows(out, "component", "rule_score", "score") == [("a", 0.95, 0.4), ("c", 0.95, 0.95)]
    assert M.clusters_of(edges.limit(0), none, nodes, claims)[0].collect() == []


def test_one_node_stands_for_a_name(spark, rows):
    nodes = [("1", "X", "person"), ("2", "X", "person"), ("3", "X", "person"), ("4", "X", "place"), ("5", "X", "person"), ("6", None, "person"), ("7", "Y", "person")]
    df = spark.createDataFrame(nodes, "id string, name string, node_type string")
    rejected = pairs(spark, [("5", "1"), ("7", "9")], "a string, b string")
    assert rows(M.standing(df, rejected)) == [("1", "1"), ("2", "2"), ("3", "2"), ("4", "4"), ("5", "5"), ("6", "6"), ("7", "7")]
    assert rows(M.standing(df, rejected.limit(0)), "rep") == [("1",), ("1",), ("1",), ("1",), ("4",), ("6",), ("7",)]


def test_pairs_are_scored_once(spark, rows):
    memo = pairs(spark, [("a", "b", 0.1, 1), ("b", "a", 0.2, 2)], "a string, b string, score double, seq int")
    texts = spark.createDataFrame([("a", "x"), ("b", "xx"), ("c", "xxx")], "id string, text string")
    asked = pairs(spark, [("a", "b"), ("c", "a"), ("c", "a"), ("c", "lost"), (None, "a")], "a string, b string")
    out = M.score_pairs(asked, memo, texts, lambda p: [len(x) + len(y) / 10 for x, y in p], batch=1)
    assert rows(out) == [("a", "b", 0.2, False), ("a", "c", 1.3, True)]
    assert M.score_pairs(asked.limit(0), memo, texts, lambda p: []).collect() == []


def test_the_band_and_the_plan(spark):
    scores = pairs(spark, [("a", "b", 0.9, None), ("a", "c", 0.95, 0.1), ("b", "c", 0.89, 1.0), ("c", "d", 1.0, 1.0)], "a string, b string, names_only double, with_claims double")
    types = spark.createDataFrame([("a", "person"), ("b", "person"), ("c", "place"), ("d", "place")], "id string, node_type string")
    verdicts = pairs(spark, [("d", "c")], "a string, b string")
    all_pairs = pairs(spark, [("b", "a"), ("a", "c"), ("b", "c"), ("c", "d"), ("b", "d")], "a string, b string")
    lengths = spark.createDataFrame([("a", 100), ("b", 170)], "id string, n int")
    p = M.plan(all_pairs, scores, verdicts, types, lengths).first()
    assert p.asDict() == {"shortlist_pairs": 5, "new_pairs": 1, "to_verify": 1, "verify_calls": 1, "input_tokens": 100, "output_tokens": 200, "cached_context_tokens": 108_000, "usd": 0.1}
    assert M.plan(all_pairs, scores, verdicts, types, lengths, cross_type=True).first().to_verify == 2
    assert M.plan(all_pairs.limit(0), scores, verdicts, types, lengths).first().usd == 0


def test_relations(spark, rows):
    v = spark.createDataFrame(CASE_VERDICTS, "a string, b string, verdict string, shared_subject string, reason string, at int")
    c = spark.createDataFrame(CASE_CONFIRMATIONS, "a string, b string, verdict string, at int")
    out, refused = M.relations(v, c)
    assert rows(out) == sorted(CASE_RELATIONS, key=repr) and rows(refused) == [("s1", "s2", "maybe", "verdict")]


def test_claim_lines_and_prefixes(spark, rows):
    claims = spark.createDataFrame([(f"{i:08d}-x", "r", "testimony", f" t{i} ", str(i % 3), i) for i in range(6)] + [("00000009-a", "q", None, None, None, 1), ("00000009-b", "q", None, "z", None, 0)], "id string, record_id string, claim_type string, content string, location_in_record string, seq int")
    keep = claims.where("id IN ('00000004-x', '00000001-x', '00000005-x')").select("id")
    assert rows(M.claim_lines(claims, keep, limit=2)) == [("q", 1, "[00000009] (None) z"), ("q", 2, "[00000009] (None) "), ("r", 1, "[00000001] (testimony) t1"), ("r", 2, "[00000004] (testimony) t4")]
    links = spark.createDataFrame([("q", "00000009"), ("r", "00000003-whatever"), ("r", "nope")], "record_id string, short string")
    assert rows(M.full_ids(links, claims), "record_id", "id") == [("q", "00000009-b"), ("r", "00000003-x"), ("r", "nope")]


def test_a_judge_that_stumbles(spark, rows):
    items = spark.createDataFrame([("a", str(i), t) for i, t in enumerate(["yes", "no", "odd", "boom", "yes"])], "a string, b string, text string").coalesce(1)

    def ask(texts):
        if "boom" in texts:
            raise ValueError("no reply")
        return [{"same": True, "reason": "r"} if t == "yes" else {"same": False} if t == "no" else {"same": "perhaps"} for t in texts][:2]

    got = rows(M.judged(items, ask, size=3), "b", "same", "reason")
    assert got == [("0", True, "r"), ("1", False, ""), ("2", None, ""), ("3", None, "ValueError: no reply"), ("4", None, "ValueError: no reply")]
