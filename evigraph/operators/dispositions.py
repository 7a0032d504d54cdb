"""Ledgers under rules: operations and their reversals, event identities, proposals' routes,
chains of dispositions, and whether a replayed graph may take the place of the live one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..common import parse_utc
from ..functions.text import has_offset

# What replaying an operation may come to without a word, what a disposition may
# say, which of these don't stand in the way, and the names that event and operation ids carry.
NORMAL = ("applied_normally", "compensated_normally", "pending_normally", "rejected_normally")
SAFE = ("applied", "absorbed", "superseded", "compensated", "contraction_drop")
BLOCKING = ("unresolved_drift", "unconfirmed", "invalid")
OPERATION_PREFIX, COMPENSATION_PREFIX, PROPOSAL_PREFIX = "rename-operation:", "rename-compensation:", "rename-proposal:"
KEYS = {
    "rename": ("schema", "op", "operation_id", "at", "by", "new_name", "node", "proposal_id"), "reject_proposal": ("schema", "op", "operation_id", "proposal_id", "at", "by", "reason"),
    "compensate": ("schema", "op", "id", "at", "by", "reason", "reverses"),
}


def operations(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(operations, problems) of a ledger of base events and reversals that name them.

    events: (seq, id, reversal boolean, at). operations: (id, at, reversed_at, state), state being
    active or reversed. An operation id stands for one base event. problems: (seq, id, cause) of
    events without an id, repeated ids, and reversals whose time has no offset, that name an
    unknown id, one that was reversed before, or one that is not earlier (by at, then id). An
    operation with a repeated id counts by its first event.
    """
    no_id = F.coalesce(F.trim("id") == "", F.lit(True))
    e = events.withColumn("_t", F.coalesce("at", F.lit("")))
    w = W.partitionBy("id").orderBy("_t", "seq")
    base = e.where(~no_id & ~F.col("reversal")).withColumn("_n", F.row_number().over(w))
    first = base.where("_n = 1").select("id", "at", "_t")
    r = e.where(~no_id & F.col("reversal")).withColumn("_ok", F.coalesce(has_offset("at"), F.lit(False)) & parse_utc("at").isNotNull())
    r = r.join(first.select("id", F.col("_t").alias("_b")), "id", "left")
    later = F.col("_ok") & F.col("_b").isNotNull() & (F.col("_t") > F.col("_b"))
    r = r.withColumn("_later", later).withColumn("_n", F.row_number().over(W.partitionBy("id", "_later").orderBy("_t", "seq")))
    cause = F.when(~F.col("_ok"), "invalid_reversal_timestamp").when(F.col("_b").isNull(), "unknown_operation").when(~F.col("_later"), "reversal_not_later").when(F.col("_n") > 1, "duplicate_reversal")
    r = r.withColumn("cause", cause)
    taken = r.where("cause IS NULL").select("id", F.col("at").alias("reversed_at"))
    problems = e.where(no_id).select("seq", "id", F.lit("missing_id").alias("cause")).unionByName(base.where("_n > 1").select("seq", "id", F.lit("duplicate_operation").alias("cause"))).unionByName(r.where("cause IS NOT NULL").select("seq", "id", "cause"))
    out = first.join(taken, "id", "left").select("id", "at", "reversed_at", F.when(F.col("reversed_at").isNull(), "active").otherwise("reversed").alias("state"))
    return out, problems


def node_identity(node: Column) -> Column:
    """A node's natural identity in canonical form: prior names sorted, each once."""
    return F.struct(node["name"].alias("name"), node["node_type"].alias("node_type"), F.array_sort(F.array_distinct(F.coalesce(node["prior_names"], F.array().cast("array<string>")))).alias("prior_names"))


def _content_id(prefix: str, *fields: Column) -> Column:
    return F.concat(F.lit(prefix), F.sha2(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}), 256))


def checked_events(events: DataFrame) -> DataFrame:
    """events with expected_id and error, null where an event is whole.

    events: (keys array, schema, op, event_id, at, by, new_name, node struct<name, node_type,
    prior_names>, proposal_id, reason, reverses array); keys are the event's own, in its order.
    An event must be of a known op, have exactly that op's keys in their order, a time with an
    offset, who did it, and an id that is the SHA-256 of what it says.
    """
    blank = lambda c: F.coalesce(F.trim(c) == "", F.lit(True))
    c = lambda n: F.col(n)
    head = [c("schema"), c("op")]
    ids = {
        "rename": _content_id(OPERATION_PREFIX, *head, c("at"), c("by"), c("new_name"), node_identity(c("node")).alias("node"), c("proposal_id")),
        "reject_proposal": _content_id(OPERATION_PREFIX, *head, c("proposal_id"), c("at"), c("by"), c("reason")),
        "compensate": _content_id(COMPENSATION_PREFIX, *head, c("at"), c("by"), c("reason"), c("reverses")),
    }
    expected, shape = F.lit(None).cast("string"), F.lit(False)
    for op, keys in KEYS.items():
        expected = F.when(c("op") == op, ids[op]).otherwise(expected)
        shape = F.when(c("op") == op, F.array_join("keys", ",") == ",".join(keys)).otherwise(shape)
    proposal = c("proposal_id").startswith(PROPOSAL_PREFIX) & (F.length("proposal_id") > len(PROPOSAL_PREFIX))
    reverses = (F.size("reverses") > 0) & (F.array_join(F.array_sort(F.array_distinct("reverses")), ",") == F.array_join("reverses", ",")) & F.forall("reverses", lambda r: r.rlike(f"^{OPERATION_PREFIX}[0-9a-f]{{64}}$"))
    body = (
        F.when(c("op") == "rename", blank("new_name") | blank(c("node")["name"]) | blank(c("node")["node_type"]) | (c("proposal_id").isNotNull() & ~proposal))
        .when(c("op") == "reject_proposal", blank("reason") | ~F.coalesce(proposal, F.lit(False)))
        .otherwise(blank("reason") | ~F.coalesce(reverses, F.lit(False)))
    )
    error = (
        F.when(~F.coalesce(c("op").isin(*KEYS), F.lit(False)), "unknown op").when(~F.coalesce(shape, F.lit(False)), "closed shape").when(~F.coalesce(has_offset("at"), F.lit(False)), "time without offset")
        .when(blank("by") | body, "invalid field").when(~c("event_id").eqNullSafe(expected), "id doesn't match")
    )
    return events.withColumns({"expected_id": expected, "error": error})


def proposal_routes(proposals: DataFrame, routes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(outcomes, unknown): what became of rename proposals, by exactly one route each.

    proposals: (id, at); routes: (kind, operation_id, proposal_id, active): renames, rejections
    and merges that name a proposal. A proposal without an active route is pending, with one it
    is renamed, rejected or merged, with several conflicting. unknown: (kind, operation_id,
    proposal_id) of routes to proposals that don't exist.
    """
    known = proposals.select(F.col("id").alias("proposal_id")).distinct()
    named = routes.where("proposal_id IS NOT NULL")
    live = named.where("active").select("kind", "operation_id", "proposal_id").distinct().groupBy("proposal_id").agg(F.count("*").alias("n"), F.min("kind").alias("kind"))
    x = proposals.select(F.col("id").alias("proposal_id")).distinct().join(live, "proposal_id", "left")
    done = F.element_at(F.create_map(F.lit("rename"), F.lit("renamed"), F.lit("reject"), F.lit("rejected"), F.lit("merge"), F.lit("merged")), F.col("kind"))
    outcome = F.when(F.col("n").isNull(), "pending").when(F.col("n") == 1, done).otherwise("conflicting")
    return x.select("proposal_id", F.coalesce("n", F.lit(0)).alias("routes"), outcome.alias("outcome")), named.join(known, "proposal_id", "left_anti").select("kind", "operation_id", "proposal_id").distinct()


BASIS = ("phase", "operation_id", "source", "candidate")


def chains(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(tips, problems) of a ledger of dispositions.

    entries: (id, phase, operation_id, source, candidate, outcome, classified_at, supersedes),
    the fingerprints of both graphs being part of what an entry is about. The entries of one
    basis, by classified_at and id, must form a line: the first supersedes nothing, each other
    one the one before it. The last is the tip and is in force. problems: (id, cause).
    """
    w = W.partitionBy(*BASIS).orderBy("classified_at", "id")
    known = entries.select(F.col("id").alias("supersedes"), *[F.col(b).alias(f"_{b}") for b in BASIS]).dropDuplicates(["supersedes"])
    x = entries.withColumns({"_before": F.lag("id").over(w), "_last": F.lead("id").over(w).isNull()}).join(known, "supersedes", "left")
    x = x.withColumn("_copies", F.count("*").over(W.partitionBy("id")))
    other = F.col("_phase").isNotNull() & ~(F.struct(*BASIS).eqNullSafe(F.struct(*[F.col(f"_{b}").alias(b) for b in BASIS])))
    cause = (
        F.when(F.col("_copies") > 1, "duplicate id").when(~F.coalesce(F.col("outcome").isin(*SAFE, *BLOCKING), F.lit(False)), "unknown outcome")
        .when(F.col("supersedes").isNotNull() & F.col("_phase").isNull(), "supersedes an unknown entry").when(F.col("supersedes").isNotNull() & other, "supersedes another basis")
        .when(F.col("_before").isNotNull() & F.col("supersedes").isNull(), "must supersede the tip").when(F.col("supersedes").isNotNull() & ~F.col("supersedes").eqNullSafe(F.col("_before")), "supersedes no tip")
    )
    tips = x.where("_last").select("id", *BASIS, "outcome", "classified_at", "supersedes")
    return tips, x.select("id", cause.alias("cause")).where("cause IS NOT NULL").distinct()


def replay_problems(tips: DataFrame, outcomes: DataFrame) -> DataFrame:
    """(phase, operation_id, problem): why a replayed graph may not take the place of the live one;
    no rows mean that it may.

    tips as of chains(), of one pair of graphs; outcomes: (phase, operation_id, outcome) of the
    replay, one row per operation. Every outcome that isn't normal needs a disposition that
    doesn't block. An unconfirmed or invalid one needs its like; applied or compensated ends a
    chain, but is no root; a chain whose operation replays normally must end so.
    """
    o = outcomes.select("phase", "operation_id", F.col("outcome").alias("replayed"))
    t = tips.select("phase", "operation_id", "outcome", F.col("supersedes").isNull().alias("root"), F.lit(True).alias("there"))
    x = o.join(t, ["phase", "operation_id"], "full_outer")
    normal, there = F.col("replayed").isin(*NORMAL), F.col("there").isNotNull()
    closing = F.when(F.col("replayed") == "compensated_normally", "compensated").otherwise("applied")
    problems = F.array_compact(F.array(
        F.when(F.col("replayed").isNull(), "no such operation"),
        F.when(F.col("replayed").isNotNull() & ~normal & ~there, "missing disposition"),
        F.when(there & F.col("outcome").isin(*BLOCKING), "blocking disposition"),
        F.when(F.col("replayed").isin("unconfirmed", "invalid") & there & (F.col("outcome") != F.col("replayed")), "must match the replay")
        .when(there & F.col("outcome").isin("applied", "compensated") & F.col("root"), "redundant root")
        .when(there & normal & (F.col("outcome") != closing), "chain not closed"),
    ))
    return x.select("phase", "operation_id", F.explode(problems).alias("problem"))


def compared_rankers(queries: DataFrame, performance: DataFrame) -> DataFrame:
    """One row: whether the ranker `new` may replace `old`, and by which criteria.

    queries: (ranker, query, ndcg, mrr, recall) with the same queries for both; performance:
    (ranker, latency, memory, controlled). Quality must gain 0.03 of nDCG, not lose MRR, and at
    most two queries may lose more than 0.10 of nDCG. Latency and memory may double at most;
    both are null, and the answer no, unless both runs had the machine to themselves.
    """
    side = lambda r: queries.where(F.col("ranker") == r).select("query", *[F.col(c).alias(f"{r}_{c}") for c in ("ndcg", "mrr", "recall")])
    q = side("old").join(side("new"), "query", "full_outer").agg(
        F.sum((F.col("old_ndcg").isNull() | F.col("new_ndcg").isNull()).cast("int")).alias("unmatched"), *[(F.avg(f"new_{c}") - F.avg(f"old_{c}")).alias(f"{c}_delta") for c in ("ndcg", "mrr", "recall")],
        F.sum(F.coalesce(F.col("new_ndcg") - F.col("old_ndcg") < -0.10, F.lit(False)).cast("int")).alias("regressions"),
    )
    one = lambda r, c: F.max(F.when(F.col("ranker") == r, F.col(c)))
    p = performance.agg(F.min(F.coalesce("controlled", F.lit(False))).alias("valid"), F.try_divide(one("new", "latency"), one("old", "latency")).alias("latency_ratio"), F.try_divide(one("new", "memory"), one("old", "memory")).alias("memory_ratio"))
    x = q.join(F.broadcast(p))  # one row each
    fast, small = F.when(F.col("valid"), F.col("latency_ratio") <= 2), F.when(F.col("valid"), F.col("memory_ratio") <= 2)
    quality = (F.col("ndcg_delta") >= 0.03) & (F.col("mrr_delta") >= 0) & (F.col("regressions") <= 2) & (F.col("unmatched") == 0)
    return x.select(*[F.round(f"{c}_delta", 9).alias(f"{c}_delta") for c in ("ndcg", "mrr", "recall")], "regressions", "unmatched", F.col("valid").alias("performance_valid"), fast.alias("latency_ok"), small.alias("memory_ok"), F.coalesce(quality & fast & small, F.lit(False)).alias("replace"))


def merge_safety(labelled: DataFrame, proposed: DataFrame) -> DataFrame:
    """(shape, pairs, right, missed, false_merges): proposed pairs against labelled ones by the
    shape of the relation. labelled: (a, b, shape, same); proposed: (a, b), in any order."""
    key = lambda x: x.withColumns({"a": F.least("a", "b"), "b": F.greatest("a", "b")})
    x = key(labelled).join(key(proposed).select("a", "b").distinct().withColumn("_p", F.lit(True)), ["a", "b"], "left").withColumn("_p", F.coalesce("_p", F.lit(False)))
    n = lambda c: F.sum(c.cast("int"))
    return x.groupBy("shape").agg(F.count("*").alias("pairs"), n(F.col("same") == F.col("_p")).alias("right"), n(F.col("same") & ~F.col("_p")).alias("missed"), n(~F.col("same") & F.col("_p")).alias("false_merges"))
