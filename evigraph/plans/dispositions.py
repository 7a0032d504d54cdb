"""Queries of ledgers under rules; their inputs are small tables of cases, since the data has no such ledgers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dispositions as D
from .curation import _event_ledger
from .registry import Registry
from .resolving import _values
from ..operators.graph import Graph

R = Registry()

T = "2025-01-0{}T00:00:00Z".format
OPERATIONS = [(1, "a", False, T(1)), (2, "b", False, T(2)), (3, "a", True, T(3)), (4, "a", True, T(4)), (5, "c", True, T(3)), (6, "b", True, T(1)), (7, "d", False, T(1)), (8, "d", True, "2025-01-05 00:00"), (9, " ", False, T(1)), (10, None, True, T(1)), (11, "b", False, T(9))]
OPERATION_PROBLEMS = [(4, "a", "duplicate_reversal"), (5, "c", "unknown_operation"), (6, "b", "reversal_not_later"), (8, "d", "invalid_reversal_timestamp"), (9, " ", "missing_id"), (10, None, "missing_id"), (11, "b", "duplicate_operation")]


@R.add("g18_operation_problem_cases", _values(OPERATION_PROBLEMS, "seq, id, cause"))
def g18(spark, sf):
    return D.operations(spark.createDataFrame(OPERATIONS, "seq int, id string, reversal boolean, at string"))[1]


@R.add("g18_reversed_events", """
WITH e AS (SELECT *, lag(event_id) OVER w AS b, lag(event_type) OVER w AS k FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)), c AS (SELECT b AS id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z' AS reversed_at, strftime(e.ts, '%Y-%m-%dT%H:%M:%S') AS t FROM e WHERE event_type = 'error' AND k <> 'error')
SELECT CAST(o.event_id AS VARCHAR) AS id, CASE WHEN c.id IS NULL THEN 'active' ELSE 'reversed' END AS state FROM events o LEFT JOIN (SELECT c.id FROM c JOIN events b ON b.event_id = c.id WHERE c.t > strftime(b.ts, '%Y-%m-%dT%H:%M:%S')) c ON c.id = o.event_id WHERE o.event_type <> 'error'""")
def g18_events(spark, sf):
    """The events with errors as reversals of what came before, a stand-in for a ledger."""
    e = _event_ledger(Graph(spark, sf))
    at = F.concat(F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
    x = e.select(F.col("id").alias("seq"), F.coalesce("compensates", "id").cast("string").alias("id"), F.col("compensates").isNotNull().alias("reversal"), at.alias("at"))
    return D.operations(x)[0].select("id", "state")


ENTRIES = [
    ("d1", "merge", "m1", "s", "c", "unresolved_drift", T(1), None), ("d2", "merge", "m1", "s", "c", "applied", T(2), "d1"), ("d3", "merge", "m2", "s", "c", "absorbed", T(1), None), ("d4", "merge", "m2", "s", "c", "superseded", T(2), None), ("d5", "rename", "r1", "s", "c", "applied", T(1), "d1"),
    ("d6", "rename", "r2", "s", "c", "invalid", T(1), "zz"), ("d7", "rename", "r3", "s", "c", "whatever", T(1), None), ("d8", "merge", "m3", "s", "c", "absorbed", T(1), None), ("d9", "merge", "m3", "s", "c", "absorbed", T(2), "d8"), ("e1", "merge", "m3", "s", "c", "absorbed", T(3), "d8"), ("e2", "merge", "m4", "s", "c", "unconfirmed", T(1), None),
    ("e3", "merge", "m5", "s", "c", "applied", T(1), None), ("e4", "merge", "m1", "s", "c2", "absorbed", T(1), None),
]
CHAIN_PROBLEMS = [("d4", "must supersede the tip"), ("d5", "supersedes another basis"), ("d6", "supersedes an unknown entry"), ("d7", "unknown outcome"), ("e1", "supersedes no tip")]
CHAIN_TIPS = [("d2", "m1", "applied"), ("d4", "m2", "superseded"), ("d5", "r1", "applied"), ("d6", "r2", "invalid"), ("d7", "r3", "whatever"), ("e1", "m3", "absorbed"), ("e2", "m4", "unconfirmed"), ("e3", "m5", "applied"), ("e4", "m1", "absorbed")]
_ENTRY = "id string, phase string, operation_id string, source string, candidate string, outcome string, classified_at string, supersedes string"


@R.add("m17_chain_problem_cases", _values(CHAIN_PROBLEMS, "id, cause"))
def m17(spark, sf):
    return D.chains(spark.createDataFrame(ENTRIES, _ENTRY))[1]


@R.add("m17_tip_cases", _values(CHAIN_TIPS, "id, operation_id, outcome"))
def m17_tips(spark, sf):
    return D.chains(spark.createDataFrame(ENTRIES, _ENTRY))[0].select("id", "operation_id", "outcome")


REPLAYED = [("merge", "m1", "applied_normally"), ("merge", "m2", "lost"), ("merge", "m3", "compensated_normally"), ("merge", "m4", "invalid"), ("merge", "m5", "contraction"), ("merge", "m6", "drift"), ("merge", "m7", "pending_normally"), ("rename", "r1", "applied_normally"), ("rename", "r2", "invalid"), ("rename", "r3", "applied_normally")]
REPLAY_PROBLEMS = [("merge", "m3", "chain not closed"), ("merge", "m4", "blocking disposition"), ("merge", "m4", "must match the replay"), ("merge", "m5", "redundant root"), ("merge", "m6", "missing disposition"), ("rename", "r2", "blocking disposition"), ("rename", "r3", "chain not closed")]


@R.add("m17_replay_problem_cases", _values(REPLAY_PROBLEMS, "phase, operation_id, problem"))
def m17_replay(spark, sf):
    tips = D.chains(spark.createDataFrame(ENTRIES, _ENTRY))[0].where("candidate = 'c'")
    return D.replay_problems(tips, spark.createDataFrame(REPLAYED, "phase string, operation_id string, outcome string"))


PROPOSALS = [("rename-proposal:1", T(1)), ("rename-proposal:2", T(1)), ("rename-proposal:3", T(1)), ("rename-proposal:4", T(1)), ("rename-proposal:5", T(1))]
ROUTES = [("rename", "o1", "rename-proposal:1", True), ("rename", "o2", "rename-proposal:2", False), ("reject", "o3", "rename-proposal:3", True), ("merge", "o4", "rename-proposal:3", True), ("merge", "o5", "rename-proposal:4", True), ("merge", "o5", "rename-proposal:4", True), ("rename", "o6", "rename-proposal:9", True), ("rename", "o7", None, True)]
ROUTE_OUTCOMES = [("rename-proposal:1", 1, "renamed"), ("rename-proposal:2", 0, "pending"), ("rename-proposal:3", 2, "conflicting"), ("rename-proposal:4", 1, "merged"), ("rename-proposal:5", 0, "pending")]


@R.add("m12_proposal_route_cases", _values(ROUTE_OUTCOMES, "proposal_id, routes, outcome"))
def m12(spark, sf):
    return D.proposal_routes(spark.createDataFrame(PROPOSALS, "id string, at string"), spark.createDataFrame(ROUTES, "kind string, operation_id string, proposal_id string, active boolean"))[0]


RANKERS = [("old", "q1", 0.5, 0.5, 0.5), ("old", "q2", 0.6, 0.5, 0.5), ("new", "q1", 0.7, 0.75, 0.5), ("new", "q2", 0.45, 0.5, 0.75)]
RANKER_CASES = [("fast", 0.025, 0.125, 0.125, 1, True, True, True, False), ("shared", 0.025, 0.125, 0.125, 1, False, None, None, False), ("better", 0.225, 0.25, 0.125, 0, True, True, False, False), ("good", 0.225, 0.25, 0.125, 0, True, True, True, True)]


@R.add("z16_ranker_cases", _values(RANKER_CASES, "name, ndcg_delta, mrr_delta, recall_delta, regressions, performance_valid, latency_ok, memory_ok, replace"))
def z16(spark, sf):
    better = [*RANKERS[:3], ("new", "q2", 0.85, 0.75, 0.75)]
    out = None
    for name, rows, memory, alone in (("fast", RANKERS, 150.0, True), ("shared", RANKERS, 150.0, False), ("better", better, 250.0, True), ("good", better, 150.0, True)):
        perf = spark.createDataFrame([("old", 10.0, 100.0, True), ("new", 20.0, memory, alone)], "ranker string, latency double, memory double, controlled boolean")
        x = D.compared_rankers(spark.createDataFrame(rows, "ranker string, query string, ndcg double, mrr double, recall double"), perf).select(F.lit(name).alias("name"), "ndcg_delta", "mrr_delta", "recall_delta", "regressions", "performance_valid", "latency_ok", "memory_ok", "replace")
        out = x if out is None else out.unionByName(x)
    return out


LABELLED = [("a", "b", "spelling", True), ("c", "d", "spelling", True), ("e", "f", "part of", False), ("g", "h", "part of", False), ("i", "j", "sibling", False)]
SAFETY = [("spelling", 2, 1, 1, 0), ("part of", 2, 1, 0, 1), ("sibling", 1, 1, 0, 0)]


@R.add("z15_merge_safety_cases", _values(SAFETY, 'shape, pairs, "right", missed, false_merges'))
def z15(spark, sf):
    return D.merge_safety(spark.createDataFrame(LABELLED, "a string, b string, shape string, same boolean"), spark.createDataFrame([("b", "a"), ("e", "f"), ("e", "f"), ("x", "y")], "a string, b string"))
