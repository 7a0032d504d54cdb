import random

import numpy as np

from evigraph.llm import leakage as L

ITEM = "One two three four five six seven eight nine ten eleven twelve thirteen fourteen."


def brute(docs, items, n=L.WORDS):
    windows = {}
    for i, t in items:
        w = L.words(t)
        for k in range(len(w) - n + 1):
            windows.setdefault(tuple(w[k : k + n]), set()).add(i)
    out = set()
    for d, t in docs:
        w = L.words(t)
        for k in range(len(w) - n + 1):
            out |= {(d, i) for i in windows.get(tuple(w[k : k + n]), ())}
    return out


def found(spark, docs, items, **more):
    d = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "1 AS item_id", "true AS exact")
    i = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "7 AS doc_id")
    return {(r.doc_id, r.item_id, r.exact) for r in L.leaked_items(d, i, **more).collect()}


def test_whole_part_and_separators(spark):
    docs = [(1, "x " + ITEM.upper() + " y"), (2, "ONE... two, three\nfour\tfive*six - seven_eight nine ten eleven twelve"), (3, "one two three four five six seven eight nine ten eleven"), (4, None), (5, ""), (6, ITEM), (6, ITEM)]
    assert found(spark, docs, [(1, ITEM), (2, None), (3, "short item"), (4, ITEM)]) == {(d, i, True) for d in (1, 2, 6) for i in (1, 4)}


def test_no_window_spans_two_documents(spark):
    w = ITEM.split()
    assert found(spark, [(1, " ".join(w[:6])), (2, " ".join(w[6:]))], [(1, ITEM)]) == set()


def test_other_scripts_and_long_texts(spark):
    item = "Ένα δύο τρία τέσσερα πέντε έξι επτά οκτώ εννέα δέκα ένδεκα δώδεκα"
    assert found(spark, [(1, "λέξη " * 50_000 + item.upper())], [(9, item)]) == {(1, 9, True)} or found(spark, [(1, "λέξη " * 50_000 + item)], [(9, item)]) == {(1, 9, True)}


def test_near_passages(spark):
    near = "one two three extra four five six seven eight nine ten eleven more twelve"
    far = "one two three " + "extra " * 9 + "four five six seven eight nine ten eleven twelve"
    got = found(spark, [(1, near), (2, far)], [(1, ITEM)], span=16)
    assert (1, 1, False) in got and not any(d == 2 for d, _, _ in got) and not any(e for *_, e in got)


def test_random_texts_against_brute_force(spark):
    r = random.Random(4)
    vocab = [f"w{i}" for i in range(9)]
    items = [(i, " ".join(r.choices(vocab, k=r.randint(5, 30)))) for i in range(12)]
    docs = []
    for d in range(60):
        t = r.choices(vocab, k=r.randint(0, 60))
        if d % 3 == 0:
            w = items[d % 12][1].split()
            a = r.randint(0, len(w) // 2)
            t = t + w[a : a + r.randint(10, 16)] + t
        docs.append((d, " ".join(t)))
    assert {(d, i) for d, i, _ in found(spark, docs, items)} == brute(docs, items)


def test_segments_and_item_blocks(spark, monkeypatch):
    docs, items = [(i, f"a{i} " + ITEM) for i in range(9)] + [(99, "none of it")], [(i, ITEM + f" b{i}") for i in range(3)] + [(7, "never " * 20)]
    monkeypatch.setattr(L, "ITEM_WORDS", 20)
    d, i = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    index = L.build_index(d, segment_words=20)
    assert index.where("shard = -1").count() > 4
    assert {(r.doc_id, r.item_id) for r in L.leaked_in(index, i).collect()} == brute(docs, items)
    # the stored index answers another item set
    assert {(r.doc_id, r.item_id) for r in L.leaked_in(index, i.where("item_id = 2")).collect()} == {(d, 2) for d in range(9)}


def test_postings_pack_and_unpack():
    r = random.Random(1)
    for top in (1, 200, 300, 70_000, 1 << 33):
        p = np.array(sorted({r.randrange(top) for _ in range(50)}), np.int64)
        if np.diff(p).max(initial=0) < 1 << 32:
            assert L.unpacked(L.packed(p)).tolist() == p.tolist()


def test_the_index_holds_every_word(spark):
    docs = [("x", "A b a_b, C"), ("y", ""), ("z", None), ("w", "b é b")]
    index = L.build_index(spark.createDataFrame(docs, "doc_id string, text string").coalesce(1))
    rows = {r.term: L.unpacked(r.positions).tolist() for r in index.where("term IS NOT NULL").collect()}
    at = 5 + L.GAP
    assert rows == {"a": [0, 2], "b": [1, 3, at, at + 2], "c": [4], "é": [at + 1]}
    assert [r["keys"] for r in index.where("shard = -1").collect()] == [["x", "w"]]


def test_empty_tables(spark):
    assert found(spark, [], [(1, ITEM)]) == set() and found(spark, [(1, ITEM)], []) == set()
