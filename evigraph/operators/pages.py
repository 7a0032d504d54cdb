"""Pages: what the gate proposes, what editors veto, and pages composed of several nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import kernel, text
from ..session import materialise
from . import briefs

# The folder of pages of each type.
SECTIONS = {"person": "people", "organisation": "organisations", "project": "projects", "event": "events", "topic": "topics", "place": "places", "object": "objects", "document": "documents"}
OTHER_SECTION = "other"


def section(c: str):
    out = F.lit(OTHER_SECTION)
    for k, v in SECTIONS.items():
        out = F.when(F.col(c) == k, F.lit(v)).otherwise(out)
    return out


def resolve_identities(asked: DataFrame, nodes: DataFrame, aliases: DataFrame) -> DataFrame:
    """(ref, node_id, state): the live node that a ledger means by (name, node_type, prior_names).

    A ledger outlives ids, so it names nodes. One live node of the type that has the name, a
    prior name or either as alias is meant; of several none (ambiguous). Only if there is none
    do the equivalence key and then letters and digits alone decide, with one node each. What
    nothing leads to is lost. Never by similarity.
    """
    names = asked.select("ref", "node_type", F.explode(F.array_distinct(F.array_compact(F.concat(F.array("name"), F.coalesce("prior_names", F.array().cast("array<string>")))))).alias("name")).distinct()
    live = nodes.select(F.col("id").alias("node_id"), "node_type", "name").where("name IS NOT NULL").distinct()
    routes = live.unionByName(aliases.select("node_id", F.col("alias").alias("name")).join(live.select("node_id", "node_type"), "node_id").select("node_id", "node_type", "name")).distinct()
    by = lambda x, y, on: x.join(y, on).groupBy("ref").agg(F.countDistinct("node_id").alias("n"), F.min("node_id").alias("id"))
    exact = by(names, routes, ["node_type", "name"])
    keys = lambda x: x.withColumns({"key": kernel.equivalence_udf("name"), "blind": text.blind_key("name")})
    asked_keys, live_keys = materialise(keys(names), "asked_keys"), materialise(keys(live), "live_keys")
    same = by(asked_keys.drop("name", "blind"), live_keys.select("node_id", "node_type", "key"), ["node_type", "key"])
    blind = by(asked_keys.drop("name", "key"), live_keys.select("node_id", "node_type", "blind"), ["node_type", "blind"])
    x = asked.select("ref").distinct()
    for name, df in (("e", exact), ("k", same), ("b", blind)):
        x = x.join(df.select("ref", F.col("n").alias(f"{name}_n"), F.col("id").alias(f"{name}_id")), "ref", "left")
    n, ident = F.coalesce("e_n", "k_n", "b_n", F.lit(0)), F.when(F.col("e_n").isNotNull(), F.col("e_id")).when(F.col("k_n").isNotNull(), F.col("k_id")).otherwise(F.col("b_id"))
    return x.select("ref", F.when(n == 1, ident).alias("node_id"), F.when(n == 1, "resolved").when(n > 1, "ambiguous").otherwise("lost").alias("state"))


def active_vetoes(events: DataFrame, nodes: DataFrame, aliases: DataFrame) -> DataFrame:
    """(veto_id, node_id, reason, at): nodes that are never a page.

    events: (op, veto_id, at, reason, nodes array<struct<name,node_type,prior_names>>). A veto
    that an unveto names, whenever it came, has no effect; members that don't resolve to one
    live node are left out. Of several vetoes with one id the last counts per node.
    """
    undone = events.where("op = 'unveto'").select("veto_id").distinct()
    v = events.where("op = 'veto' AND veto_id IS NOT NULL").join(undone, "veto_id", "left_anti").select("veto_id", "at", "reason", F.explode("nodes").alias("n"))
    v = v.select("veto_id", "at", "reason", "n.*").withColumn("ref", F.sha2(F.to_json(F.struct("name", "node_type", "prior_names"), {"ignoreNullFields": "false"}), 256))
    found = resolve_identities(v.select("ref", "name", "node_type", "prior_names").distinct(), nodes, aliases).where("node_id IS NOT NULL")
    return v.join(found, "ref").groupBy("veto_id", "node_id").agg(F.max_by("reason", F.struct("at", "reason")).alias("reason"), F.max("at").alias("at"))


def composed_pages(events: DataFrame, nodes: DataFrame, aliases: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(pages, members, superseded) of a ledger of compositions.

    events: (op, page_id, at, confirmed, name, slug, node_type, members array<struct<name,node_type,
    prior_names>>). pages has a row for each composition that no decompose names: (page_id, name,
    slug, section, state, members, dropped), state being composed, unconfirmed (no reviewer's
    confirmation), or lost (no member in the graph); dropped counts members that don't resolve.
    members: (page_id, node_id, position) in the order of the composition, a node once.
    superseded: (section, slug, page_id, node_id) of members whose own page has another address.
    """
    undone = events.where("op = 'decompose'").select("page_id").distinct()
    e = materialise(events.where("op = 'compose' AND page_id IS NOT NULL").join(undone, "page_id", "left_anti").withColumn("slug", F.coalesce("slug", briefs.slug(F.coalesce("name", F.lit("")))) ), "compositions")
    m = e.select("page_id", "node_type", F.posexplode("members").alias("at", "m")).select("page_id", "at", F.col("m.name").alias("name"), F.coalesce("m.node_type", "node_type").alias("node_type"), F.col("m.prior_names").alias("prior_names"))
    m = m.withColumn("ref", F.sha2(F.to_json(F.struct("name", "node_type", "prior_names"), {"ignoreNullFields": "false"}), 256))
    found = materialise(m.select("page_id", "at", "ref").join(resolve_identities(m.select("ref", "name", "node_type", "prior_names").distinct(), nodes, aliases), "ref", "left"), "members")
    counts = found.groupBy("page_id").agg(F.countDistinct("node_id").alias("members"), F.sum(F.col("node_id").isNull().cast("int")).alias("dropped"))
    p = e.drop("members").join(counts, "page_id", "left").fillna(0, ["members", "dropped"])
    state = F.when(~F.coalesce("confirmed", F.lit(False)), "unconfirmed").when(F.col("members") == 0, "lost").otherwise("composed")
    pages = p.select("page_id", "name", "slug", section("node_type").alias("section"), state.alias("state"), "members", "dropped")
    kept = found.where("node_id IS NOT NULL").join(pages.where("state = 'composed'").select("page_id", "slug", "section"), "page_id").groupBy("page_id", "node_id", "slug", "section").agg(F.min("at").alias("at"))
    w = W.partitionBy("page_id").orderBy("at")
    members = kept.withColumn("position", F.row_number().over(w) - 1)
    own = briefs.slug_map(nodes).select(F.col("id").alias("node_id"), section("node_type").alias("own_section"), F.col("slug").alias("own_slug"))
    gone = members.join(own, "node_id").where("own_section <> section OR own_slug <> slug")
    return pages, members.select("page_id", "node_id", "position"), gone.select(F.col("own_section").alias("section"), F.col("own_slug").alias("slug"), "page_id", "node_id")


def proposals(gate: DataFrame, vetoed: DataFrame, covered: DataFrame, independence: DataFrame) -> DataFrame:
    """The gate's rows that are neither vetoed nor covered by a composed page, with their
    independent sources and unscored claims, the strongest first.

    vetoed, covered: (node_id); independence as of evidence.independence_per_node.
    """
    i = independence.select(F.col("nid").alias("node_id"), F.col("sources").alias("independent_sources"), F.col("unscored").alias("unscored_claims"))
    out = gate.join(vetoed.select("node_id").distinct(), "node_id", "left_anti").join(covered.select("node_id").distinct(), "node_id", "left_anti").join(i, "node_id", "left")
    return out.orderBy(F.desc("claims"), "node_id")


def page_set(gate: DataFrame, pages: DataFrame, members: DataFrame) -> DataFrame:
    """(page_id, node_ids): composed pages with their members in order, and every other node of
    the gate as a page of its own (page_id is then the node's)."""
    composed = members.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("position", "node_id"))).alias("m")).select("page_id", F.transform("m", lambda x: x["node_id"]).alias("node_ids"))
    single = gate.join(members.select("node_id").distinct(), "node_id", "left_anti").select(F.col("node_id").alias("page_id"), F.array("node_id").alias("node_ids"))
    return composed.join(pages.where("state = 'composed'").select("page_id"), "page_id", "left_semi").unionByName(single)
