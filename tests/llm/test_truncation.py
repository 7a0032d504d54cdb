import random

from evigraph.llm import truncation as T

SCHEMA = "doc_id bigint, text string, source string, n_chars bigint"


def prose(r, n):
    return " ".join(r.choice(["alpha beta gamma delta epsilon", "the witness saw a light over the ridge", "nothing was found by the patrol"]).capitalize() + f" {r.randint(1, 999)}." for _ in range(n))


def corpus(seed=1):
    r = random.Random(seed)
    rows, cut = [], set()
    for i in range(300):
        t = prose(r, r.randint(5, 40))
        kind = i % 10
        source = f"s{i % 3}"
        n = len(t)
        if source == "s0" and n > 600:
            t, n = t[:600], 600
            if t[-1] != ".":
                cut.add(i)
            if t.rstrip()[-1:] == ".":
                cut.discard(i)
        elif source == "s1" and n > 700:
            t = t[:700] + " [...]"
            n = len(t)
            cut.add(i)
        elif kind == 5:
            t += f"\n\nEncl. {i}"
            n = len(t)
        elif kind == 6:
            t += "\n- list item"
            n = len(t)
        elif kind == 7:
            t = "<p>" + t + "</p>"
            n = len(t)
        elif kind == 8:
            t = t[:-7]
            cut.add(i)
        rows.append((i, t, source, n))
    return rows, cut


def run(spark, rows):
    return T.truncated(spark.createDataFrame(rows, SCHEMA))


def test_planted_cuts(spark):
    rows, cut = corpus()
    assert {r.doc_id for r in run(spark, rows).where("cut").collect()} == cut


def test_spike_of_a_source(spark):
    rows, _ = corpus()
    found = {(r["_source"], r.unit, r.length) for r in T.spikes(T.described(spark.createDataFrame(rows, SCHEMA))).collect()}
    assert ("s0", "chars", 600) in found and ("s1", "bare", 700) in found


def test_no_cases(spark):
    rows = [(1, None, "a", 3), (2, "", "a", 0), (3, " \n\t", "a", None), (4, "It ended here.", None, None), (5, "Title without stop", "b", 18), (5, "Title without stop", "b", 18), (6, "He said “so.”", "b", 13), (7, "終わり。", "b", 4), (8, "x" * 300_000 + ".", "b", 300_001)]
    out = sorted((r.doc_id, r.cut) for r in run(spark, rows).collect())
    assert out == [(4, False), (5, True), (5, True), (6, False), (7, False), (8, False)]


def test_marks_and_announced_length(spark):
    rows = [(1, "The light moved and... [continued", "a", 33), (2, "The light moved (more)", "a", 22), (3, "Half a char�", "a", 12), (4, "All of it.", "a", 500), (5, "“It climbed…", "a", 12), (6, "A note.\n[end of tape 3]", "a", 23), (7, "It was so.\n(3 May 1950)", "a", 23)]
    assert {r.doc_id: r.cut for r in run(spark, rows).collect()} == {1: True, 2: True, 3: True, 4: True, 5: True, 6: False, 7: False}


def test_by_source_and_empty(spark):
    out = T.truncation_by_source(run(spark, [(1, "So it was.", "a", 10), (2, "So it w", "a", 7)])).collect()
    assert [tuple(r) for r in out] == [("a", 2, 1, 0.5)]
    assert run(spark, []).collect() == []
