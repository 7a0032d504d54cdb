import random

import pytest

from evigraph.operators import incremental as I

SCHEMA = "key string, token string"


def frame(spark, state):
    return spark.createDataFrame([(k, v, "x") for k, v in state.items()], SCHEMA + ", node string")


def collect(df):
    return {(r.key, r.token, r.change) for r in df.collect()}


def test_runs_process_exactly_what_changed(spark, tmp_path):
    r = random.Random(1)
    state, seen = {}, {}
    for step in range(4):
        for _ in range(40):
            state[f"k{r.randint(0, 90)}"] = f"t{r.randint(0, 3)}"
        for k in r.sample(sorted(state), 3):
            del state[k]
        version, out = I.run_incremental(spark, frame(spark, state), str(tmp_path / "s"), lambda c: c)
        want = {(k, v, "changed" if k in seen else "new") for k, v in state.items() if seen.get(k) != v} | {(k, None, "deleted") for k in seen if k not in state}
        assert version == step + 1 and collect(out) == want
        seen = dict(state)
    assert collect(I.run_incremental(spark, frame(spark, state), str(tmp_path / "s"), lambda c: c)[1]) == set()


def test_a_failed_run_neither_skips_nor_repeats(spark, tmp_path):
    d = str(tmp_path / "s")
    I.run_incremental(spark, frame(spark, {"a": "1", "b": "1"}), d, lambda c: c)

    def fails(c):
        raise RuntimeError("half-way")

    with pytest.raises(RuntimeError):
        I.run_incremental(spark, frame(spark, {"a": "2", "b": "1", "c": "1"}), d, fails)
    # output and rows of a run that was killed were written, the marker wasn't
    (tmp_path / "s" / "v2-killed" / "output").mkdir(parents=True, exist_ok=True)
    assert I.committed(spark, d) == 1
    v, out = I.run_incremental(spark, frame(spark, {"a": "2", "b": "1", "c": "1"}), d, lambda c: c)
    assert v == 2 and collect(out) == {("a", "2", "changed"), ("c", "1", "new")}


def test_of_two_runs_at_once_one_is_lost(spark, tmp_path):
    d, inner = str(tmp_path / "s"), []
    I.run_incremental(spark, frame(spark, {"a": "1"}), d, lambda c: c)

    def meanwhile(c):
        inner.append(collect(I.run_incremental(spark, frame(spark, {"a": "1", "b": "1"}), d, lambda x: x)[1]))
        return c

    with pytest.raises(I.RunLost):
        I.run_incremental(spark, frame(spark, {"a": "3"}), d, meanwhile)
    assert inner == [{("b", "1", "new")}] and I.committed(spark, d) == 2
    assert collect(I.run_incremental(spark, frame(spark, {"a": "3"}), d, lambda c: c)[1]) == {("a", "3", "changed"), ("b", None, "deleted")}


def test_partial_runs_and_what_they_write(spark, tmp_path):
    d = str(tmp_path / "s")
    state = {f"k{i}": str(i) for i in range(600)}
    I.run_incremental(spark, frame(spark, state), d, lambda c: c)
    first = I.State(spark, d, 1)
    v, out = I.run_incremental(spark, frame(spark, {"k7": "x", "k8": "8", "new": "1"}), d, lambda c: c, partial=True)
    assert collect(out) == {("k7", "x", "changed"), ("new", "1", "new")}
    now = I.State(spark, d, v)
    moved = {r for r in now.at if now.at[r] != first.at.get(r)}
    assert 1 <= len(moved) <= 2 and len(now.at) == 16
    state |= {"k7": "x", "new": "1"}
    assert {(r.key, r.token) for r in now.rows().collect()} == set(state.items())
    assert sorted(now.tree().collect()) == sorted(I.tree(frame(spark, state), now.leaf).collect())
    assert collect(I.run_incremental(spark, spark.createDataFrame([], SCHEMA), d, lambda c: c, partial=True)[1]) == set()
    # old versions go, the rows that still count stay
    assert I.committed(spark, d) == 3 and not (tmp_path / "s" / "_committed-1").exists()
    assert {(r.key, r.token) for r in I.State(spark, d, 3).rows().collect()} == set(state.items())


def test_depth_follows_the_number_of_keys():
    assert [I.leaf_digits(n) for n in (0, 1, 10**6, 10**9, 10**12)] == [2, 2, 3, 5, 8] and I.widths(5) == [0, 2, 4, 5]
    assert [I.range_digits(n) for n in (0, 10**6, 10**9)] == [1, 1, 2]


def test_trees(spark):
    state = frame(spark, {f"k{i}": str(i) for i in range(500)})
    a, b = I.tree(I.one_row_per_key(state)), I.tree(I.one_row_per_key(state.repartition(7)))
    assert sorted(a.collect()) == sorted(b.collect())
    other = I.tree(I.one_row_per_key(frame(spark, {f"k{i}": str(i) if i != 77 else "x" for i in range(500)})))
    assert I.changed_leaves(a, other).count() == 1 and I.changed_leaves(a, b).count() == 0
    assert I.tree(I.one_row_per_key(spark.createDataFrame([], SCHEMA))).count() == 0


def test_nulls_and_repeats(spark, tmp_path):
    df = spark.createDataFrame([("a", None), ("a", None), (None, "x"), ("b", "1"), ("b", "2")], SCHEMA)
    assert collect(I.run_incremental(spark, df, str(tmp_path / "s"), lambda c: c)[1]) == {("a", "", "new"), ("b", "2", "new")}
    assert collect(I.run_incremental(spark, df.limit(0), str(tmp_path / "s"), lambda c: c)[1]) == {("a", None, "deleted"), ("b", None, "deleted")}


H = ["a" * 64, "b" * 64, "c" * 64, "d" * 64, "e" * 64, "f" * 64]


def test_due_records(spark):
    from datetime import datetime as D

    digests = spark.createDataFrame(
        [(H[0], "1" * 64, D(2025, 1, 1), D(2025, 1, 2)), ("SHA256:" + H[0].upper(), "2" * 64, D(2025, 1, 3), D(2025, 1, 1)), (H[0], None, D(2025, 2, 1), D(2025, 2, 1)), (H[1], "sha256:" + "1" * 64, D(2025, 1, 1), D(2025, 1, 1)), (H[2], "1" * 64, D(2025, 1, 1), None), (H[3], "1" * 64, D(2025, 1, 1), None), (H[4], None, D(2025, 1, 1), None), (None, "1" * 64, D(2025, 1, 1), None), (H[5], "1" * 64, D(2025, 1, 1), None)],
        "record_content_hash string, digest_sha256 string, produced_at timestamp, arrived_at timestamp",
    )
    receipts = spark.createDataFrame(
        [(H[0], "2" * 64, 2, 1), (H[1], "9" * 64, 2, 1), (H[1], "1" * 64, 2, 3), (H[1], "9" * 64, 2, 4), (H[2], "1" * 64, None, 3), (H[3], "1" * 64, 1, 3), (H[3], "1" * 64, 2, 1)],
        "record_content_hash string, digest_sha256 string, import_generation int, run_id bigint",
    )
    runs = spark.createDataFrame([(1, "succeeded", 1), (3, "Succeeded", 2), (4, "failed", 3)], "run_id bigint, run_status string, import_generation int")
    due = lambda d, r, u: {x.key for x in I.due_records(d, r, u).collect()}
    assert due(digests, receipts, runs) == {H[2], H[3], H[5]}
    assert due(digests, receipts, runs.limit(0)) == {H[0], H[1], H[2], H[3], H[5]}
    assert due(digests.limit(0), receipts, runs) == set()
