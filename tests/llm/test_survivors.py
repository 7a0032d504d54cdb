import random
from datetime import datetime

from evigraph.llm import survivors as S

SCHEMA = "node_id string, node_type string, name string, name_uses bigint, alias string, alias_uses bigint, reported_at timestamp, entity string"


def frame(spark, rows):
    return spark.createDataFrame([(*r[:6], datetime(2025, 1, r[6]), "x") for r in rows], SCHEMA)


def get(spark, rows):
    return {r.node_id: (r.node_type, r.name) for r in S.survivors(frame(spark, rows)).collect()}


def test_latest_counts_decide(spark):
    rows = [
        (" N1", "person", "Ann  Lee ", 5, "An Lee", 90, 1), ("n1", None, "Ann Lee", 50, "An Lee", 7, 2), ("n1", None, "Ann Lee", None, "A. Lee", 3, 3),
        ("n2", "place", "Old", 3, "New", 8, 1), ("n2", "object", "New", 9, "Old", None, 2), ("n2", "object", "New", 9, "Old", None, 2),
    ]
    assert get(spark, rows) == {"n1": ("person", "Ann Lee"), "n2": ("object", "New")}


def test_gaps(spark):
    rows = [("n1", None, None, None, None, None, 1), ("n2", " ", "x", None, "y", None, 1), (None, "person", "z", 1, None, None, 1), ("n3", "topic", "b", 4, "a", 4, 1), ("n4", "topic", "", 4, "  ", 4, 1)]
    assert get(spark, rows) == {"n1": (None, None), "n2": (None, "x"), "n3": ("topic", "a"), "n4": ("topic", None)}
    assert S.survivors(frame(spark, [])).collect() == []


def test_several_true_values_are_kept(spark):
    rows = [(f"n{i}", "person", "right", 500, "wrong", 1, 1) for i in range(20)] + [("n99", "person", "one", 40, "two", 60, 1)]
    out = {r.node_id: r for r in S.survivors(frame(spark, rows)).collect()}
    assert out["n0"].spellings == ["right"] and out["n0"].name == "right" and out["n99"].name == "two"


def test_two_sided_quality(spark):
    # a careful source, a noisy one that asserts false values, a shy one that leaves true ones out
    obs = []
    for e in range(60):
        for v, true in (("t1", True), ("t2", True), ("f", False)):
            obs += [(f"e{e}", v, "careful", float(true), float(not true)), (f"e{e}", v, "noisy", 1.0 if true or e % 2 else 0.0, 0.0 if true or e % 2 else 1.0), (f"e{e}", v, "shy", 1.0 if true and e % 3 else 0.0, 0.0 if true and e % 3 else 1.0)]
    facts, quality = S.latent_truth(spark.createDataFrame(obs, "entity string, value string, source string, yes double, no double"))
    judged = {(r.entity, r.value): r.p_true >= 0.5 for r in facts.collect()}
    assert all(judged[f"e{e}", v] == (v != "f") for e in range(60) for v in ("t1", "t2", "f"))
    q = {r.source: r for r in quality.collect()}
    assert q["shy"].sensitivity < q["careful"].sensitivity and q["noisy"].specificity < q["careful"].specificity


def test_a_count_of_nothing_beats_no_count(spark):
    t = [("n", "person", "Aa", None, "Bb", 0, 1), ("m", "person", "Aa", 0, "Bb", None, 1), ("o", "person", "Bb", None, "Aa", None, 1)]
    from datetime import datetime

    df = spark.createDataFrame([(*r[:6], datetime(2025, 1, r[6])) for r in t], "node_id string, node_type string, name string, name_uses long, alias string, alias_uses long, reported_at timestamp_ntz")
    assert {(r.node_id, r.name) for r in S.survivors(df).collect()} >= {("n", "Bb"), ("m", "Aa")}


def test_the_posterior_nominates_the_name(spark, monkeypatch):
    # with the posterior turned round in each source, each nominates its least used spelling
    true_model = S.latent_truth

    def turned(observations):
        facts, quality = true_model(observations)
        return facts.withColumn("log_odds", -facts["log_odds"]), quality

    rows = [("n", "person", "a", 50, "b", 20, 1), ("n", "person", "c", 9, "d", 3, 1)]
    assert get(spark, rows)["n"] == ("person", "a")
    monkeypatch.setattr(S, "latent_truth", turned)
    assert get(spark, rows)["n"] == ("person", "c")


def test_a_judged_name_falls_only_to_a_greater_count(spark):
    # of nearly equal counts the model prefers the alias, as aliases hardly ever assert what is false here
    rows = [(f"n{i}", "person", "right", 500, "wrong", 1, 1) for i in range(20)]
    rows += [("tie", "person", "a", 4, "b", 4, 1), ("more", "person", "b", 41, "a", 40, 1), ("less", "person", "b", 40, "a", 41, 1), ("m", "person", "a", 4, "b", 4, 1), ("m", "person", "a", 4, "x", 1, 1)]
    out = {r.node_id: (r.name, r.agreed) for r in S.survivors(frame(spark, rows)).collect()}
    assert {k: out[k] for k in ("tie", "more", "less", "m", "n0")} == {"tie": ("a", False), "more": ("b", False), "less": ("a", True), "m": ("a", False), "n0": ("right", True)}


def test_counts_that_a_double_or_a_model_does_not_hold(spark):
    rows = [
        ("big", "person", "b", 2**53, "c", 2**53 + 1, 1), ("big", "person", "a", 2**53, "c", 2**53 + 1, 1), ("one", "person", "a", 2**62, None, None, 1), ("one", "person", "b", 2**62 + 1, None, None, 1),
        ("below", "person", "b", -5, "a", None, 1), ("two below", "person", "a", -5, "b", -2, 1), ("two below", "person", "c", -3, "b", -2, 1),
    ]
    assert {k: v[1] for k, v in get(spark, rows).items()} == {"big": "c", "one": "b", "below": "b", "two below": "b"}


def test_a_type_without_a_time_is_not_the_latest(spark):
    df = spark.createDataFrame([("n", "place", "x", 1, None, None, None, "x"), ("n", "person", "x", 1, None, None, datetime(2025, 1, 1), "x")], SCHEMA)
    assert [r.node_type for r in S.survivors(df).collect()] == ["person"]


def test_the_most_used_spelling_is_always_a_finalist(spark):
    r = random.Random(5)
    rows = [(f"n{i}", "person", r.choice("abcdef"), r.choice([None, -1, 0, 1, 2, 3, 2**53, 2**53 + 1]), r.choice("abcdef"), r.choice([None, 0, 1, 2, 3, 9, 2**62]), r.randint(1, 4)) for i in range(150) for _ in range(5)]
    counts, least = {}, (0, 0, 0)
    for n, _, name, name_uses, alias, alias_uses, day in rows:
        for v, uses in ((name, name_uses), (alias, alias_uses)):
            best = counts.setdefault(n, {}).setdefault(v, least)
            if uses is not None:
                counts[n][v] = max(best, (1, day, uses))
    most = {n: min(c, key=lambda v: (-c[v][0], -c[v][2], v)) for n, c in counts.items()}
    assert {k: v[1] for k, v in get(spark, rows).items()} == most
