import random

from evigraph.llm import components as C


def union_find(ids, edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for i in ids:
        find(i)
    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in parent}


def run(spark, ids, edges):
    v = spark.createDataFrame([(i, 1) for i in ids], "id string, label int")
    e = spark.createDataFrame([(a, b, "x") for a, b in edges], "a string, b string, label string")
    return {r.id: r.group_id for r in C.group_ids(v, e).collect()}


def test_shapes_against_union_find(spark):
    r = random.Random(2)
    ids = [f"n{i:03}" for i in range(120)]
    chain = list(zip(ids[:40], ids[1:41], strict=True))
    star = [("n119", i) for i in ids[50:80]]
    noise = [(r.choice(ids[80:110]), r.choice(ids[80:110])) for _ in range(25)]
    edges = chain + star + noise + chain[:5] + [(b, a) for a, b in chain[:5]] + [("n000", "n000")]
    r.shuffle(edges)
    assert run(spark, ids, edges) == union_find(ids, edges)


def test_nulls_and_empty(spark):
    assert run(spark, ["b", None, "b"], [("a", None), (None, None)]) == {"a": "a", "b": "b"}
    assert run(spark, [], []) == {}
    assert run(spark, [], [("x", "y")]) == {"x": "x", "y": "x"}


def test_proposals(spark):
    rows = [([" A ", "b", None, "B"], None, "confident"), (["c"], "B ", "Flagged"), (None, "lone", "flagged"), ([], None, "confident"), (["a", "z"], "z", "keep_separate"), (["q"], "", None), (["c", "c"], "c", "confident")]
    df = spark.createDataFrame(rows, "node_ids array<string>, suggested_canonical string, section string")
    assert {r.node_id: r.group_id for r in C.proposal_groups(df).collect()} == {"a": "a", "b": "a", "c": "a", "lone": "lone"}
