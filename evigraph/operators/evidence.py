"""Evidence analytics: counts, spread, independence, scores, salience, focus, demand."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..common import with_position
from ..schema import ATTESTATION_WEIGHT, CLAIM_TYPE_WEIGHT, TIER_CUTS
from ..session import materialise

UNIT = "\u001f"


def lookup(c: str | Column, values: dict, default) -> Column:
    x = F.col(c) if isinstance(c, str) else c
    out = F.lit(default)  # null where there is none
    for k, v in values.items():
        out = F.when(x == k, F.lit(v)).otherwise(out)
    return out


def counts_per_node(node_claims: DataFrame, works: DataFrame) -> DataFrame:
    """(nid, claims, sources): distinct claims and distinct works; a record without a row is its own work."""
    x = node_claims.join(works, "rid", "left").withColumn("work", F.coalesce("work", "rid"))
    return x.groupBy("nid").agg(F.countDistinct("cid").alias("claims"), F.countDistinct("work").alias("sources"))


def spread_per_node(node_claims: DataFrame, works: DataFrame) -> DataFrame:
    """(nid, claims, sources, top_source, second_source): claims of the best and the second-best work.

    One shuffle by (node, work) and one by node; a node's works are folded into two maxima by
    partial aggregation, so a hub's list never forms.
    """
    x = node_claims.join(works, "rid", "left").select("nid", F.coalesce("work", "rid").alias("work"), "cid")
    per_work = materialise(x.groupBy("nid", "work").agg(F.countDistinct("cid").alias("n")), "claims_per_work")
    best = F.max(F.struct("n", "work"))
    per_node = per_work.groupBy("nid").agg(F.sum("n").alias("claims"), F.count("work").alias("sources"), best.alias("b"))
    second = per_work.join(per_node.select("nid", F.col("b.work").alias("top")), "nid").where(~F.col("work").eqNullSafe(F.col("top"))).groupBy("nid").agg(F.max("n").alias("second"))
    # a claim belongs to one record and so to one work: the sum over works counts it once
    return per_node.join(second, "nid", "left").select("nid", "claims", "sources", F.col("b.n").alias("top_source"), F.coalesce("second", F.lit(0)).alias("second_source"))


def base_weight(claim_type: str = "claim_type", attestation: str = "attestation") -> Column:
    return lookup(claim_type, CLAIM_TYPE_WEIGHT, 0.5) * lookup(attestation, ATTESTATION_WEIGHT, 0.5)


def tier(score: Column) -> Column:
    out = F.lit("insufficient")
    for name, cut in reversed(TIER_CUTS):
        out = F.when(score >= cut, F.lit(name)).otherwise(out)
    return out


def name_index(nodes: DataFrame, aliases: DataFrame, folded: bool) -> DataFrame:
    """(name, nid): what a name resolves to, live nodes before aliases, then the smaller id."""
    key = (lambda c: F.lower(F.trim(c))) if folded else (lambda c: F.trim(c))
    a = nodes.select(key("name").alias("name"), F.lit(0).alias("p"), F.col("id").alias("nid"))
    b = aliases.select(key("alias").alias("name"), F.lit(1).alias("p"), F.col("node_id").alias("nid"))
    return a.unionByName(b).where("name <> ''").groupBy("name").agg(F.min_by("nid", F.struct("p", "nid")).alias("nid"))


def provenance_roots(claims: DataFrame, index: DataFrame, folded: bool) -> DataFrame:
    """claims with (root_kind, root): who stands behind each claim.

    No chain or an origin without a name is unknown; a speaker or nobody named is the speaker
    or else the record; all anonymous origins are one; a named origin or a document is the
    node it resolves to, else its own text.
    """
    named = F.trim("origin")
    c = claims.withColumn("_name", F.when(F.col("origin_kind").isin("named", "document") & (named != ""), F.lower(named) if folded else named))
    c = c.join(index.select(F.col("name").alias("_name"), F.col("nid").alias("_nid")), "_name", "left")
    own = F.col("origin_kind").isin("speaker", "unattributed")
    kind = (
        F.when(F.col("origin_kind").isNull(), "unknown")
        .when(own, F.when(F.col("speaker_id").isNotNull(), "speaker").otherwise("record"))
        .when(F.col("origin_kind") == "anonymous", "anonymous")
        .when(F.col("_nid").isNotNull(), "node")
        .when(F.col("_name").isNotNull(), F.col("origin_kind"))
        .otherwise("unknown")
    )
    root = F.when(own, F.coalesce("speaker_id", "record_id")).when(F.col("_nid").isNotNull(), F.col("_nid")).otherwise(F.coalesce(F.lower("_name"), F.lit("")))
    return c.withColumns({"root_kind": kind, "root": root}).drop("_name", "_nid")


def _independent(rows: DataFrame, by: str, unknown_counts: bool) -> DataFrame:
    """(by, sources, scored, unscored) over rows (by, id, record_id, origin_ref, root_kind, root).

    Anonymous records aren't told apart: they add the most that any one record's distinct
    origin references prove, at least one.
    """
    unknown = F.col("root_kind") == "unknown"
    anonymous = F.col("root_kind") == "anonymous"
    rooted = ~anonymous if unknown_counts else ~anonymous & ~unknown
    plain = rows.groupBy(by).agg(
        F.countDistinct(F.when(rooted, F.concat_ws(UNIT, "root_kind", F.coalesce("root", F.lit("")) ))).alias("roots"),
        F.sum((~unknown).cast("int")).alias("scored"),
        F.sum(unknown.cast("int")).alias("unscored"),
    )
    anon = rows.where(anonymous).groupBy(by, "record_id").agg(F.greatest(F.countDistinct(F.when(F.col("origin_ref") != "", F.col("origin_ref"))), F.lit(1)).alias("n"))
    anon = anon.groupBy(by).agg(F.max("n").alias("anonymous"))
    return plain.join(anon, by, "left").select(by, (F.col("roots") + F.coalesce("anonymous", F.lit(0))).alias("sources"), "scored", "unscored")


def independence_per_node(node_claims: DataFrame, claims: DataFrame, index: DataFrame) -> DataFrame:
    """(nid, sources, scored, unscored, unscored_share): independent sources behind each node.

    Claims without a known root are left out and counted; sources is null where nothing is scored.
    """
    c = provenance_roots(claims, index, folded=True).withColumnRenamed("id", "cid")
    x = node_claims.select("nid", "cid").join(c.select("cid", "record_id", "origin_ref", "root_kind", "root"), "cid")
    out = _independent(x, "nid", unknown_counts=False)
    share = F.col("unscored") / (F.col("scored") + F.col("unscored"))
    return out.select("nid", F.when(F.col("scored") > 0, F.col("sources")).alias("sources"), "scored", "unscored", share.alias("unscored_share"))


def both_ways(corroborations: DataFrame) -> DataFrame:
    """(id, other, similarity): each undirected pair from either end, distinct."""
    a = corroborations.select(F.col("claim_a").alias("id"), F.col("claim_b").alias("other"), "similarity")
    b = corroborations.select(F.col("claim_b").alias("id"), F.col("claim_a").alias("other"), "similarity")
    return a.unionByName(b).distinct()


def scores(claims: DataFrame, corroborations: DataFrame, index: DataFrame) -> DataFrame:
    """(claim_id, base_weight, source_count, corroboration_count, score, corroboration_bonus, tier).

    Sources that agree are taken as independent: score = 1 - (1 - base)^sources. A claim's
    sources are the distinct roots of itself and its corroborations; unknown chains are one root.
    """
    c = provenance_roots(claims, index, folded=False)
    pairs = both_ways(corroborations)
    group = pairs.select(F.col("id").alias("claim_id"), F.col("other").alias("id")).unionByName(c.select(F.col("id").alias("claim_id"), "id")).distinct()
    x = group.join(c.select("id", "record_id", "origin_ref", "root_kind", "root"), "id")
    n = _independent(x, "claim_id", unknown_counts=True).select("claim_id", F.col("sources").alias("source_count"))
    m = pairs.groupBy(F.col("id").alias("claim_id")).agg(F.count("*").alias("corroboration_count"))
    out = claims.select(F.col("id").alias("claim_id"), base_weight().alias("base_weight")).join(n, "claim_id", "left").join(m, "claim_id", "left")
    sources = F.coalesce("source_count", F.lit(0))
    combined = F.when(sources <= 1, F.col("base_weight")).otherwise(1 - F.pow(1 - F.col("base_weight"), sources))
    final = F.round(F.least(combined, F.lit(1.0)), 9)
    return out.select("claim_id", F.round("base_weight", 9).alias("base_weight"), sources.alias("source_count"), F.coalesce("corroboration_count", F.lit(0)).alias("corroboration_count"), final.alias("score"), F.round(combined - F.col("base_weight"), 9).alias("corroboration_bonus"), tier(final).alias("tier"))


def entailment_summary(claims: DataFrame) -> DataFrame:
    """One row: how the entailment labels fall; an entailment not by the quote counts as by the window."""
    label = F.coalesce("entailment_label", F.lit("unassessed"))
    n = lambda cond, name: F.coalesce(F.sum(F.when(cond, 1).otherwise(0)), F.lit(0)).alias(name)
    quote = F.coalesce(F.col("entailment_premise") == "quote", F.lit(False))
    out = claims.agg(
        n(label.isin("entails", "neutral", "contradicts"), "assessed"), n(label == "unassessed", "unassessed"), n(label == "entails", "entails"), n(label == "neutral", "neutral"),
        n(label == "contradicts", "contradicts"), n((label == "entails") & quote, "entailed_by_quote"), n((label == "entails") & ~quote, "entailed_by_window"),
    )
    frac = lambda c: F.bround(F.try_divide(F.col(c), F.col("assessed")), 3)
    return out.withColumns({"entailed_by_quote_fraction": frac("entailed_by_quote"), "entailed_by_window_fraction": frac("entailed_by_window")})


def salience_coverage(edges: DataFrame) -> DataFrame:
    """(salience, n): edges by salience; not assessed is a value of its own."""
    return edges.groupBy(F.coalesce("salience", F.lit("null")).alias("salience")).agg(F.count("*").alias("n"))


def edge_shape(edges: DataFrame, nodes: DataFrame, claims: DataFrame) -> DataFrame:
    """(id, name, node_type, edges, records, sole, sole_share) per live node: sole edges are on claims that name nothing else."""
    width = edges.groupBy("claim_id").agg(F.count("*").alias("width"))
    x = edges.join(width, "claim_id").join(claims.select(F.col("id").alias("claim_id"), "record_id"), "claim_id")
    per = x.groupBy("node_id").agg(F.count("*").alias("edges"), F.countDistinct("record_id").alias("records"), F.sum((F.col("width") == 1).cast("int")).alias("sole"))
    return nodes.join(per.withColumnRenamed("node_id", "id"), "id").select("id", "name", "node_type", "edges", "records", "sole", (F.col("sole") / F.col("edges")).alias("sole_share"))


def implausible_subjects(edges: DataFrame, nodes: DataFrame, share: float = 0.02) -> DataFrame:
    """(node_id, name, subject_edges, ceiling): live or retired nodes marked subject on more edges than a share of all assessed ones."""
    total = edges.where("salience IS NOT NULL").agg(F.count("*").alias("n")).select(F.greatest(F.floor(F.col("n") * share), F.lit(1)).alias("ceiling"), (F.col("n") > 0).alias("any"))
    per = edges.where("salience = 'subject'").groupBy("node_id").agg(F.count("*").alias("subject_edges"))
    hit = per.join(F.broadcast(total), (F.col("subject_edges") > F.col("ceiling")) & F.col("any"))  # one row
    return hit.join(nodes.select(F.col("id").alias("node_id"), "name"), "node_id").select("node_id", "name", "subject_edges", "ceiling")


def related_nodes(edges: DataFrame, nodes: DataFrame, top: int = 30) -> DataFrame:
    """(a, b, shared, place): for each node the live nodes named with it on most claims.

    The self-join is by claim, which names few nodes; counts are added up map-side.
    """
    x = edges.select("claim_id", F.col("node_id").alias("a"))
    y = edges.select("claim_id", F.col("node_id").alias("b"))
    shared = x.join(y, "claim_id").where("a <> b").groupBy("a", "b").agg(F.countDistinct("claim_id").alias("shared"))
    named = shared.join(nodes.select(F.col("id").alias("b"), "name"), "b")
    w = W.partitionBy("a").orderBy(F.desc("shared"), "name", "b")
    return named.withColumn("place", F.row_number().over(w)).where(F.col("place") <= top).select("a", "b", "shared", "place")


#: Nodes in more records than this hand out a bitmap instead of pairs.
HUB_RECORDS = 128


def record_reach(node_claims: DataFrame, hub: int = HUB_RECORDS) -> DataFrame:
    """(rid, reach, demand): other records that share a node with each record, and 1 + ln(1 + reach).

    Records get dense numbers. A node in few records hands each of them the numbers of the
    others, at most `hub`; a hub hands each one bitmap of its records, not a pair for each two.
    A record's reach is the union of what it gets, itself left out; one of 0 is left out.
    """
    pairs = node_claims.where("rid IS NOT NULL").select("rid", "nid").distinct()
    numbered = with_position(pairs.select("rid").distinct(), [F.col("rid").asc()], "no", start=0)
    sizes = pairs.groupBy("nid").agg(F.count("*").alias("size"))
    x = materialise(pairs.join(numbered, "rid").join(sizes, "nid").select("rid", "nid", "no", "size"), "record_nodes")
    bucket, bit = F.expr("bitmap_bucket_number(no)").alias("bucket"), F.expr("bitmap_construct_agg(bitmap_bit_position(no))").alias("bits")
    few, many = x.where(F.col("size") <= hub), x.where(F.col("size") > hub)
    light = few.select("rid", "nid").join(few.select("nid", "no"), "nid").select("rid", "no").distinct().groupBy("rid", bucket).agg(bit)
    heavy = many.select("rid", "nid").join(many.groupBy("nid", bucket).agg(bit), "nid").groupBy("rid", "bucket").agg(F.expr("bitmap_or_agg(bits)").alias("bits"))
    union = light.unionByName(heavy).groupBy("rid", "bucket").agg(F.expr("bitmap_or_agg(bits)").alias("bits"))
    out = union.groupBy("rid").agg((F.sum(F.expr("bitmap_count(bits)")) - 1).alias("reach"))
    return out.where("reach > 0").select("rid", "reach", F.bround(1 + F.log1p("reach"), 3).alias("demand"))


def source_focus(node_claims: DataFrame, claims: DataFrame, works: DataFrame) -> DataFrame:
    """(nid, work, focus): the share of a work's claims that concern a node."""
    all_of = claims.select(F.col("id").alias("cid"), F.col("record_id").alias("rid")).join(works, "rid", "left").withColumn("work", F.coalesce("work", "rid")).where("work IS NOT NULL")
    size = all_of.groupBy("work").agg(F.countDistinct("cid").alias("size"))
    on = node_claims.select("nid", "cid").join(all_of.select("cid", "work"), "cid").groupBy("nid", "work").agg(F.countDistinct("cid").alias("n"))
    return on.join(size, "work").select("nid", "work", (F.col("n") / F.col("size")).alias("focus"))
