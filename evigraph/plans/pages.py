"""Queries of page proposals, vetoes and composed pages.

The tables hold no ledgers of editors. Those here are made of the merge proposals, by rules that
the queries' names and _LEDGERS state: kept-separate ones veto their nodes, confident ones
compose a page, those without a type are taken back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..common import norm_id
from ..operators import evidence as ev
from ..operators import gate, pages
from ..operators.graph import Graph
from .evidence import _ABOUT
from .registry import Registry
from .sqlbase import ident
from .sqlbase import with_parts as q

R = Registry()


def _proposals(g):
    """Each proposal with the natural identities of its nodes; retired nodes are named too."""
    p = g.raw("merge_proposals_referenced_sources").distinct()
    x = p.select("proposal_id", "section", "reason", F.col("node_type").isNull().alias("untyped"), norm_id("suggested_canonical").alias("canonical"), F.posexplode_outer("node_ids").alias("at", "id")).withColumn("id", norm_id("id"))
    n = g.nodes("node_type", "name", live=False)
    x = x.join(n, "id", "left").where("name IS NOT NULL").select("proposal_id", "section", "reason", "untyped", "canonical", F.struct("at", F.struct("name", "node_type", F.array().cast("array<string>").alias("prior_names")).alias("n")).alias("m"))
    x = x.groupBy("proposal_id", "section", "reason", "untyped", "canonical").agg(F.transform(F.array_sort(F.collect_list("m")), lambda m: m["n"]).alias("nodes"))
    return x.join(n.select(F.col("id").alias("canonical"), F.col("name").alias("canonical_name"), F.col("node_type").alias("canonical_type")), "canonical", "left")


def _vetoes(g):
    p = _proposals(g).where("section = 'keep_separate'")
    v = p.select(F.lit("veto").alias("op"), F.col("proposal_id").alias("veto_id"), F.col("proposal_id").alias("at"), "reason", "nodes", "untyped")
    return v.unionByName(v.where("untyped").withColumn("op", F.lit("unveto"))).drop("untyped")


def _compositions(g):
    p = _proposals(g).where("section = 'confident'")
    c = p.select(F.lit("compose").alias("op"), F.col("proposal_id").alias("page_id"), F.col("proposal_id").alias("at"), F.col("canonical").isNotNull().alias("confirmed"), F.col("canonical_name").alias("name"), F.lit(None).cast("string").alias("slug"), F.coalesce("canonical_type", F.col("nodes")[0]["node_type"]).alias("node_type"), F.col("nodes").alias("members"), "untyped")
    return c.unionByName(c.where("untyped").withColumn("op", F.lit("decompose"))).drop("untyped")


_KEY = "trim(regexp_replace(regexp_replace(lower(regexp_replace({0}, '\\s*\\([A-Z0-9][A-Z0-9-]+[A-Z0-9]\\)\\s*$', '')), '[-_.]+', ' ', 'g'), '[\\s\\x{{00a0}}]+', ' ', 'g'))"
_FOLD = "strip_accents({0})"


def _key(c):
    return _KEY.format(_FOLD.format(c))


_LEDGERS = f"""
, mp AS (SELECT DISTINCT proposal_id, section, reason, node_type IS NULL AS untyped, {ident('suggested_canonical')} AS canonical, node_ids FROM merge_proposals_referenced_sources),
mi AS (SELECT proposal_id, section, reason, untyped, canonical, i AS pl, {ident('node_ids[i]')} AS id FROM (SELECT *, unnest(range(1, len(node_ids) + 1)) AS i FROM mp WHERE len(node_ids) > 0)),
mn AS (SELECT mi.*, n.name, n.node_type FROM mi JOIN allnode n ON n.id = mi.id WHERE n.name IS NOT NULL),
rt AS (SELECT id, node_type, name FROM node WHERE name IS NOT NULL UNION SELECT node.id, node.node_type, alias.alias FROM alias JOIN node ON node.id = alias.node_id),
aske AS (SELECT DISTINCT name, node_type FROM mn),
re AS (SELECT a.name, a.node_type, count(DISTINCT rt.id) AS n, min(rt.id) AS id FROM aske a JOIN rt ON rt.node_type = a.node_type AND rt.name = a.name GROUP BY 1, 2),
rk AS (SELECT a.name, a.node_type, count(DISTINCT n.id) AS n, min(n.id) AS id FROM aske a JOIN node n ON n.node_type = a.node_type AND {_key('n.name')} = {_key('a.name')} GROUP BY 1, 2),
rb AS (SELECT a.name, a.node_type, count(DISTINCT n.id) AS n, min(n.id) AS id FROM aske a JOIN node n ON n.node_type = a.node_type AND regexp_replace(lower(n.name), '[^a-z0-9]', '', 'g') = regexp_replace(lower(a.name), '[^a-z0-9]', '', 'g') AND regexp_replace(lower(a.name), '[^a-z0-9]', '', 'g') <> '' GROUP BY 1, 2),
rs AS (SELECT a.name, a.node_type, CASE WHEN coalesce(re.n, rk.n, rb.n) = 1 THEN CASE WHEN re.n IS NOT NULL THEN re.id WHEN rk.n IS NOT NULL THEN rk.id ELSE rb.id END END AS node_id FROM aske a LEFT JOIN re USING (name, node_type) LEFT JOIN rk USING (name, node_type) LEFT JOIN rb USING (name, node_type)),
vt AS (SELECT DISTINCT mn.proposal_id AS veto_id, rs.node_id, mn.reason FROM mn JOIN rs USING (name, node_type) WHERE section = 'keep_separate' AND NOT untyped AND rs.node_id IS NOT NULL),
cp AS (SELECT mp.proposal_id AS page_id, n.name, coalesce(n.node_type, (SELECT arg_min(node_type, pl) FROM mn WHERE mn.proposal_id = mp.proposal_id)) AS node_type, mp.canonical IS NOT NULL AS confirmed FROM mp LEFT JOIN allnode n ON n.id = mp.canonical WHERE section = 'confident' AND NOT untyped AND proposal_id IN (SELECT proposal_id FROM mn)),
cm AS (SELECT cp.page_id, mn.pl, rs.node_id FROM cp JOIN mn ON mn.proposal_id = cp.page_id JOIN rs ON rs.name = mn.name AND rs.node_type = mn.node_type),
pg AS (SELECT cp.*, (SELECT count(DISTINCT node_id) FROM cm WHERE cm.page_id = cp.page_id) AS members, (SELECT count(*) FROM cm WHERE cm.page_id = cp.page_id AND node_id IS NULL) AS dropped FROM cp),
ps AS (SELECT page_id, name, node_type, CASE WHEN NOT confirmed THEN 'unconfirmed' WHEN members = 0 THEN 'lost' ELSE 'composed' END AS state, members, dropped, trim(regexp_replace(lower(coalesce(name, '')), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM pg),
pm AS (SELECT page_id, node_id, row_number() OVER (PARTITION BY page_id ORDER BY min(pl)) - 1 AS position FROM cm JOIN ps USING (page_id) WHERE state = 'composed' AND node_id IS NOT NULL GROUP BY 1, 2)
"""
_SECTION = "CASE {0} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in pages.SECTIONS.items()) + " ELSE 'other' END"


@R.add("m13_vetoes_of_separate_proposals", q("allnode node alias", _LEDGERS + "SELECT veto_id, node_id, reason FROM vt"))
def m13(spark, sf):
    g = Graph(spark, sf)
    return pages.active_vetoes(_vetoes(g), g.nodes("node_type", "name"), g.aliases()).select("veto_id", "node_id", "reason")


def _composed(g):
    return pages.composed_pages(_compositions(g), g.nodes("node_type", "name"), g.aliases())


@R.add("m15_pages_of_confident_proposals", q("allnode node alias", _LEDGERS + f"SELECT page_id, name, slug, {_SECTION.format('node_type')} AS section, state, members, dropped FROM ps"))
def m15(spark, sf):
    return _composed(Graph(spark, sf))[0]


@R.add("m15_page_members", q("allnode node alias", _LEDGERS + "SELECT page_id, node_id, position FROM pm"))
def m15_members(spark, sf):
    return _composed(Graph(spark, sf))[1]


_SLUGS = ", sb AS (SELECT id, node_type, trim(regexp_replace(lower(name), '[^a-z0-9]+', '-', 'g'), '-') AS base FROM node), sl AS (SELECT id, node_type, CASE WHEN row_number() OVER (PARTITION BY base, node_type ORDER BY id) = 1 THEN base ELSE base || '-' || left(id, 8) END AS slug FROM sb)"


@R.add("m15_superseded_pages", q("allnode node alias", _LEDGERS + _SLUGS + f"SELECT {_SECTION.format('sl.node_type')} AS section, sl.slug, pm.page_id, pm.node_id FROM pm JOIN sl ON sl.id = pm.node_id JOIN ps ON ps.page_id = pm.page_id WHERE sl.slug <> ps.slug OR {_SECTION.format('sl.node_type')} <> {_SECTION.format('ps.node_type')}"))
def m15_superseded(spark, sf):
    return _composed(Graph(spark, sf))[2]


_PROPOSED = _LEDGERS + _ABOUT.rstrip() + """), ix AS (SELECT nc.nid, r.* FROM nc JOIN rooted r ON r.id = nc.cid),
ia AS (SELECT nid, max(n) AS n FROM (SELECT nid, record_id, greatest(count(DISTINCT nullif(origin_ref, '')), 1) AS n FROM ix WHERE root_kind = 'anonymous' GROUP BY 1, 2) GROUP BY 1),
ip AS (SELECT nid, count(DISTINCT CASE WHEN root_kind NOT IN ('anonymous', 'unknown') THEN root_kind || chr(31) || coalesce(root, '') END) AS roots, count(*) FILTER (root_kind <> 'unknown') AS scored, count(*) FILTER (root_kind = 'unknown') AS unscored FROM ix GROUP BY 1)
SELECT ga.*, CASE WHEN scored > 0 THEN roots + coalesce(ia.n, 0) END AS independent_sources, unscored AS unscored_claims FROM ga LEFT JOIN ip ON ip.nid = ga.node_id LEFT JOIN ia ON ia.nid = ga.node_id
WHERE ga.node_id NOT IN (SELECT node_id FROM vt) AND ga.node_id NOT IN (SELECT node_id FROM pm)"""
_PROPOSED = _PROPOSED.replace("\nSELECT gt.id AS node_id", ",\nga AS (SELECT gt.id AS node_id")


@R.add("v6_page_proposals", q("allnode node alias nc work clm rooted", _PROPOSED))
def v6(spark, sf):
    """The gate less what the two ledgers above take out."""
    g = Graph(spark, sf)
    passed = gate.page_gate(g)
    ids = passed.select(F.col("node_id").alias("nid"))
    independence = ev.independence_per_node(g.node_claims().join(ids, "nid", "left_semi"), g.claims("record_id", "speaker_id", "origin_kind", "origin", "origin_ref"), ev.name_index(g.nodes("name"), g.aliases(), True))
    vetoed = pages.active_vetoes(_vetoes(g), g.nodes("node_type", "name"), g.aliases())
    return pages.proposals(passed, vetoed, _composed(g)[1], independence)


@R.add("b8_page_set", q("allnode node alias nc work clm", _LEDGERS + _ABOUT.replace("\nSELECT gt.id AS node_id", ",\nga AS (SELECT gt.id AS node_id").rstrip() + ") SELECT CAST(page_id AS VARCHAR) AS page_id, list(node_id ORDER BY position) AS node_ids FROM pm GROUP BY 1 UNION ALL SELECT node_id, [node_id] FROM ga WHERE node_id NOT IN (SELECT node_id FROM pm)"))
def b8(spark, sf):
    g = Graph(spark, sf)
    p, m, _ = _composed(g)
    return pages.page_set(gate.page_gate(g), p.withColumn("page_id", F.col("page_id").cast("string")), m.withColumn("page_id", F.col("page_id").cast("string")))
