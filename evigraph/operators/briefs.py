"""Denormalised summaries of a node: order, selection, profiles, slugs, hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..schema import ATTESTATION_WEIGHT

#: Tokens that stand around a claim in a brief; claims from which a source is substantial.
OVERHEAD, SUBSTANTIAL = 20, 5
#: Sources that a brief of a type draws on at most; other types have no limit.
MAX_SOURCES = {"event": 5}


def slug(c: str | Column) -> Column:
    x = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(F.regexp_replace(F.lower(x), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def slug_map(nodes: DataFrame) -> DataFrame:
    """(id, node_type, slug): inside a type the first id keeps a slug, others get their first 8 letters."""
    w = W.partitionBy("base", "node_type").orderBy("id")
    x = nodes.select("id", "node_type", slug("name").alias("base")).withColumn("n", F.row_number().over(w))
    return x.select("id", "node_type", F.when(F.col("n") == 1, F.col("base")).otherwise(F.concat("base", F.lit("-"), F.substring("id", 1, 8))).alias("slug"))


def reading_key() -> Column:
    """Orders claims as they are read: records without a date last, by date, by record, then by
    the place in it, numbers before other places, at last by id.

    Needs record_date, record_hash, record_id, location_in_record and id.
    """
    number = F.trim("location_in_record").try_cast("double")
    return F.struct(
        F.col("record_date").isNull().alias("undated"), F.coalesce("record_date", F.lit("")).alias("date"), F.coalesce("record_hash", "record_id", F.lit("")).alias("record"),
        number.isNull().alias("lexical"), F.coalesce(number, F.lit(0.0)).alias("number"), F.when(number.isNull(), F.coalesce("location_in_record", F.lit(""))).otherwise("").alias("place"), F.col("id").alias("id"),
    )


def reading_order(claims: DataFrame, by: str) -> DataFrame:
    """(id, by, place): each claim's place in the reading order among those of one `by`."""
    return claims.withColumn("place", F.row_number().over(W.partitionBy(by).orderBy(reading_key()))).select("id", by, "place")


def profiles(nodes: DataFrame, node_claims: DataFrame, claims: DataFrame, n: int = 5, width: int = 200) -> DataFrame:
    """(id, profile): name, type and the n longest claims of each live node, cut to width."""
    c = node_claims.select("nid", "cid").join(claims.withColumnRenamed("id", "cid"), "cid")
    w = W.partitionBy("nid").orderBy(F.desc(F.length("content")), F.coalesce("claim_hash", "cid"), "cid")
    top = c.withColumn("p", F.row_number().over(w)).where(F.col("p") <= n)
    lists = top.groupBy(F.col("nid").alias("id")).agg(F.array_sort(F.collect_list(F.struct("p", F.substring("content", 1, width).alias("t")))).alias("top"))
    lines = F.when(F.size("top") > 0, F.array_join(F.transform("top", lambda x: F.concat(F.lit("\n- "), x["t"])), "")).otherwise("\n(none recorded)")
    return nodes.join(lists, "id", "left").select("id", F.concat(F.lit("Name: "), "name", F.lit("\nType: "), "node_type", F.lit("\nClaims:"), F.coalesce(lines, F.lit("\n(none recorded)"))).alias("profile"))


def tokens(c: str | Column) -> Column:
    """An estimate of a text's tokens: its characters / 2.7, and one."""
    x = F.col(c) if isinstance(c, str) else c
    return (F.floor(F.length(x) / F.lit(2.7)) + 1).cast("bigint")


def budget_for(window: int) -> int:
    """The tokens of a model's window that a brief may take."""
    return int(window * 0.85)


def claim_cost(content: str = "content", excerpt: str = "original_excerpt") -> Column:
    """The tokens of a claim as it is rendered: content and excerpt, and what stands around them."""
    return tokens(F.concat(F.coalesce(content, F.lit("")), F.coalesce(excerpt, F.lit("")))) + F.lit(OVERHEAD)


def kept_sources(sources: DataFrame, limit: Column) -> DataFrame:
    """The sources of each node that a brief draws on, at most `limit` (null = all of them).

    sources: (node, source, size, first, focus). The one most about the node comes first, then
    the others by size; sources of fewer than SUBSTANTIAL claims come last, by focus, unless
    no source has as many.
    """
    w = W.partitionBy("node")
    x = sources.withColumn("_some", F.max(F.col("size") >= SUBSTANTIAL).over(w)).withColumn("_late", F.col("_some") & (F.col("size") < SUBSTANTIAL))
    x = x.withColumn("_lead", F.row_number().over(w.orderBy("_late", F.desc(F.coalesce("focus", F.lit(0.0))), F.desc("size"), "first")) == 1)
    late_focus = F.when(F.col("_late"), -F.coalesce("focus", F.lit(0.0))).otherwise(0.0)
    x = x.withColumn("_at", F.row_number().over(w.orderBy(F.desc("_lead"), "_late", late_focus, F.desc("size"), "first")))
    return x.where(limit.isNull() | (F.col("_at") <= limit)).drop("_some", "_late", "_lead", "_at")


def spread_selection(rows: DataFrame, cap: int, budget: int | None = None, limit: Column | None = None, focus: DataFrame | None = None) -> DataFrame:
    """(node, source, id, turn): the claims of each node that a brief takes, in turn from its sources.

    rows: (node, source, id, key, importance, cost), key being reading_key(). A node without a
    limit on its sources and with at most cap claims keeps all, whatever they cost. Else its
    sources (see kept_sources; limit may use the node's columns in `rows`) take turns in the
    order in which they are first read, each with its most important claims first, until cap or
    the first claim that passes the budget of tokens. Claims without a source are one source.

    Only keys, costs and importance are moved, no texts; of a source at most cap claims reach
    the node's order, and of a node at most cap its running cost.
    """
    of = F.coalesce("source", F.lit(""))
    asked = F.lit(None).cast("int") if limit is None else limit
    sources = rows.withColumn("_limit", asked).groupBy("node", of.alias("_source")).agg(F.count("*").alias("size"), F.min("key").alias("first"), F.min("_limit").alias("_limit"))
    about = sources.withColumn("focus", F.lit(0.0)) if focus is None else sources.join(focus.select("node", F.col("source").alias("_source"), "focus"), ["node", "_source"], "left")
    kept = kept_sources(about.withColumnRenamed("_source", "source"), F.col("_limit")).select("node", F.col("source").alias("_source"), "first", "_limit")
    total = sources.groupBy("node").agg(F.sum("size").alias("_all"))
    x = rows.withColumn("_source", of).join(kept, ["node", "_source"])
    x = x.withColumn("_turn", F.row_number().over(W.partitionBy("node", "_source").orderBy(F.desc("importance"), "key"))).where(F.col("_turn") <= cap)
    turn = W.partitionBy("node").orderBy("_turn", "first")
    x = x.select("node", "source", "id", "cost", "_turn", "first", "_limit").withColumn("turn", F.row_number().over(turn)).where(F.col("turn") <= cap)
    if budget is not None:
        x = x.join(total, "node").withColumn("_spent", F.sum("cost").over(turn.rowsBetween(W.unboundedPreceding, 0)))
        x = x.where(((F.col("_all") <= cap) & F.col("_limit").isNull()) | (F.col("_spent") <= budget))
    return x.select("node", "source", "id", "turn")


def importance(suspect: Column, corroborated: Column, by_node: Column, attestation: str = "attestation") -> Column:
    """Not suspect before suspect, corroborated before not, spoken by the node before not, then
    how close the witness was. Suspect claims stay, but displace no others."""
    rank = F.lit(0)
    for i, a in enumerate(sorted(ATTESTATION_WEIGHT, key=ATTESTATION_WEIGHT.get), 1):
        rank = F.when(F.col(attestation) == a, F.lit(i)).otherwise(rank)
    yes = lambda c: F.coalesce(c, F.lit(False)).cast("int")
    return (1 - yes(suspect)) * 1000 + yes(corroborated) * 100 + yes(by_node) * 10 + rank


def payload_hash(*cols: str) -> Column:
    """SHA-256 of the columns as compact JSON in this order, nulls kept."""
    return F.sha2(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}), 256)
