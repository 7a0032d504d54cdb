"""Judgements on whether a claim belongs to a node, kept in a ledger that outlives ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dispositions import node_identity, operations
from .pages import resolve_identities

# What may be said of a claim's reference; nothing said is unreviewed.
STATUSES = ("verified", "suspect")
LOCATOR = ("record_hash", "claim_fingerprint", "node")


def fingerprint(*parts: str | Column) -> Column:
    """A claim's fingerprint inside its record: SHA-256 over what it says."""
    return F.sha2(F.to_json(F.struct(*parts), {"ignoreNullFields": "false"}), 256)


def event_id(op: str | Column = "op") -> Column:
    """The id that an event's content gives it."""
    return F.sha2(F.to_json(F.struct(op, "record_hash", "claim_fingerprint", node_identity(F.col("node")).alias("node"), "status", "set_at", "reverses"), {"ignoreNullFields": "false"}), 256)


def active_statuses(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(statuses, problems) of a ledger of judgements.

    events: (seq, id, op 'set' or 'unset', record_hash, claim_fingerprint, node, status, set_at,
    reverses). An unset takes back the one earlier set that it names. Of what is left of a claim
    and node the last by set_at counts. problems: (id, cause): those of dispositions.operations,
    statuses that don't exist, and sets of one instant that contradict each other, of which none counts.
    """
    ops, wrong = operations(events.select("seq", F.when(F.col("op") == "unset", F.col("reverses")).otherwise(F.col("id")).alias("id"), (F.col("op") == "unset").alias("reversal"), F.col("set_at").alias("at")))
    kept = events.where("op = 'set'").join(ops.where("state = 'active'").select("id"), "id", "left_semi").dropDuplicates(["id"])
    ok = kept.where(F.col("status").isin(*STATUSES)).withColumn("node", node_identity(F.col("node")))
    last = ok.groupBy(*LOCATOR).agg(F.max("set_at").alias("set_at"))
    at_last = ok.join(last, [*LOCATOR, "set_at"]).groupBy(*LOCATOR, "set_at").agg(F.countDistinct("status").alias("n"), F.max(F.struct("id", "status")).alias("s"))
    problems = wrong.select("id", "cause").unionByName(kept.where(~F.coalesce(F.col("status").isin(*STATUSES), F.lit(False))).select("id", F.lit("unknown status").alias("cause"))).unionByName(at_last.where("n > 1").select(F.col("s.id").alias("id"), F.lit("contradiction").alias("cause")))
    return at_last.where("n = 1").select(*LOCATOR, "s.status", "set_at"), problems


def replayed(statuses: DataFrame, claims: DataFrame, edges: DataFrame, nodes: DataFrame, aliases: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(claim_id, node_id, status) in the graph as it is, and (record_hash, claim_fingerprint, why)
    of what no longer finds its place.

    claims: (id, record_hash, claim_fingerprint); a judgement needs exactly one claim of its
    locator, one live node of its identity, and an edge between the two.
    """
    x = statuses.withColumn("ref", F.sha2(F.to_json("node"), 256))
    n = resolve_identities(x.select("ref", "node.name", "node.node_type", "node.prior_names").distinct(), nodes, aliases)
    c = claims.groupBy("record_hash", "claim_fingerprint").agg(F.countDistinct("id").alias("n"), F.min("id").alias("claim_id"))
    e = edges.select("claim_id", "node_id").distinct().withColumn("edge", F.lit(True))
    y = x.join(n, "ref", "left").join(c, ["record_hash", "claim_fingerprint"], "left").join(e, ["claim_id", "node_id"], "left")
    why = F.when(F.col("n").isNull(), "claim gone").when(F.col("n") > 1, "several claims").when(F.col("node_id").isNull(), F.concat(F.lit("node "), F.coalesce("state", F.lit("lost")))).when(F.col("edge").isNull(), "edge gone")
    y = y.withColumn("why", why)
    return y.where("why IS NULL").select("claim_id", "node_id", "status"), y.where("why IS NOT NULL").select("record_hash", "claim_fingerprint", "why")
