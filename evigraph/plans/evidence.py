"""Queries over the evidence graph: scans, filters, joins, counts, independence, scores, salience."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .. import schema
from ..operators import evidence as ev
from ..operators import gate, resolve
from ..operators.graph import Graph
from .registry import Registry
from ..functions import kernel
from .sqlbase import NODE_TYPE, ident, person_words, scoped, strip_acronym
from .sqlbase import with_parts as q

R = Registry()


def _graph(f):
    return lambda spark, sf: f(Graph(spark, sf))


def add(name: str, sql: str | None = None):
    def put(f):
        R.add(name, sql)(_graph(f))
        return f

    return put


# ---- projections, filters, predicates


@add("f1_live_nodes", q("node", "SELECT id, node_type, name FROM node WHERE node_type = 'person'"))
def live(g):
    return g.nodes("node_type", "name").where("node_type = 'person'")


_LOOKUP = f"""
, t AS (SELECT DISTINCT {"nullif(regexp_extract(lower(record_content_hash), '([0-9a-f]{64})\\s*$', 1), '')"} AS h, nullif(lower(trim(record_id)), '') AS r FROM digest_import_receipts)
SELECT t.h AS content_hash, t.r AS record_ref, coalesce(a.id, b.id) AS record_id, CASE WHEN a.id IS NOT NULL THEN 'id' WHEN b.id IS NOT NULL THEN 'hash' END AS via
FROM t LEFT JOIN (SELECT DISTINCT id FROM rec) a ON a.id = t.r LEFT JOIN (SELECT content_hash, min(id) AS id FROM rec GROUP BY 1) b ON b.content_hash = t.h
"""


@add("f2_record_lookup", q("rec", _LOOKUP))
def record_lookup(g):
    from ..common import norm_hash, norm_id

    t = g.raw("digest_import_receipts").select(norm_hash("record_content_hash").alias("content_hash"), norm_id("record_id").alias("record_ref")).distinct()
    r = g.records("content_hash")
    by_id = r.select(F.col("id").alias("record_ref"), F.col("id").alias("a")).distinct()
    by_hash = r.where("content_hash IS NOT NULL").groupBy("content_hash").agg(F.min("id").alias("b"))
    out = t.join(by_id, "record_ref", "left").join(by_hash, "content_hash", "left")
    return out.select("content_hash", "record_ref", F.coalesce("a", "b").alias("record_id"), F.when(F.col("a").isNotNull(), "id").when(F.col("b").isNotNull(), "hash").alias("via"))


@add("f4_prefix_lookup", q("rec", "SELECT d.digest_path, min(rec.id) AS record_id FROM (SELECT DISTINCT digest_path FROM digests) d JOIN rec ON left(rec.content_hash, 16) = regexp_extract(d.digest_path, '/([0-9a-f]{16})[.]yaml$', 1) GROUP BY 1"))
def prefix_lookup(g):
    d = g.raw("digests").select("digest_path").distinct().withColumn("p", F.regexp_extract("digest_path", r"/([0-9a-f]{16})[.]yaml$", 1))
    r = g.records("content_hash").select("id", F.substring("content_hash", 1, 16).alias("p"))
    return d.join(r, "p").groupBy("digest_path").agg(F.min("id").alias("record_id"))


@add("f5_substring_search", q("clm", "SELECT id, content FROM clm WHERE lower(content) LIKE '%radar%return%'"))
def substring_search(g):
    return g.claims("content").where(F.lower("content").like("%radar%return%"))


@add("f14_distributable", q("rec", """SELECT coalesce(json_extract_string(metadata, '$.copyright'), 'absent') AS copyright, coalesce(json_extract_string(metadata, '$.copyright') IN ('public_domain', 'open_licence'), false) AS distributable, count(*) AS n FROM rec GROUP BY ALL"""))
def distributable(g):
    c = F.get_json_object("metadata", "$.copyright")
    r = g.records("metadata", "title", "content_hash", "record_date", "producer_id", "created_at", "work_id")
    return r.select(F.coalesce(c, F.lit("absent")).alias("copyright"), F.coalesce(c.isin("public_domain", "open_licence"), F.lit(False)).alias("distributable")).groupBy("copyright", "distributable").agg(F.count("*").alias("n"))


@add("g5_decoded_metadata", q("allnode", "SELECT json_extract_string(metadata, '$.run_kind') AS run_kind, CAST(json_extract(metadata, '$.digests') AS BIGINT) AS digests, count(*) AS n FROM allnode GROUP BY ALL"))
def decoded(g):
    m = F.from_json("metadata", "run_kind string, digests bigint")
    n = g.nodes("node_type", "name", "metadata", "created_at", "retired_at", "seq", live=False)
    return n.select(m["run_kind"].alias("run_kind"), m["digests"].alias("digests")).groupBy("run_kind", "digests").agg(F.count("*").alias("n"))


@add("u7_constraint_violations", q("allnode rec clm edge", """
SELECT 'nodes' AS table_name, 'unique' AS rule, 'id' AS column_name, count(*) AS n FROM (SELECT id FROM allnode GROUP BY id HAVING count(*) > 1) HAVING count(*) > 0
UNION ALL SELECT 'nodes', 'allowed', 'node_type', count(*) FROM allnode WHERE node_type NOT IN ('person', 'organisation', 'project', 'event', 'topic', 'place', 'object', 'document') HAVING count(*) > 0
UNION ALL SELECT 'claims', 'reference', 'record_id', count(*) FROM clm WHERE record_id NOT IN (SELECT id FROM rec) HAVING count(*) > 0
UNION ALL SELECT 'claims', 'reference', 'speaker_id', count(*) FROM clm WHERE speaker_id NOT IN (SELECT id FROM allnode) HAVING count(*) > 0
UNION ALL SELECT 'edges', 'reference', 'claim_id', count(*) FROM edge WHERE claim_id NOT IN (SELECT id FROM clm) HAVING count(*) > 0
UNION ALL SELECT 'edges', 'reference', 'node_id', count(*) FROM edge WHERE node_id NOT IN (SELECT id FROM allnode) HAVING count(*) > 0"""))
def constraint_violations(g):
    t = {
        "nodes": g.nodes("node_type", "name", "metadata", "created_at", "retired_at", "seq", live=False),
        "records": g.records("title"),
        "claims": g.claims("claim_type", "attestation", "record_id", "speaker_id", "claim_role", "origin_kind", "entailment_label"),
        "edges": g.edges(),
    }
    return schema.violations(t)


# ---- joins


@add("j1_claims_of_node", q("node edge clm", "SELECT n.id AS node_id, count(*) AS claims, min(c.claim_date) AS first_date, max(c.claim_date) AS last_date FROM node n JOIN edge e ON e.node_id = n.id JOIN clm c ON c.id = e.claim_id GROUP BY 1"))
def claims_of_node(g):
    x = g.edges().join(g.claims("claim_date").withColumnRenamed("id", "claim_id"), "claim_id").join(g.nodes("name").select(F.col("id").alias("node_id")), "node_id")
    return x.groupBy("node_id").agg(F.count("*").alias("claims"), F.min("claim_date").alias("first_date"), F.max("claim_date").alias("last_date"))


@add("j2_claims_with_record_and_speaker", q("clm rec allnode", "SELECT c.id, r.title, n.name AS speaker FROM clm c LEFT JOIN rec r ON r.id = c.record_id LEFT JOIN allnode n ON n.id = c.speaker_id"))
def with_record_and_speaker(g):
    r, n = g.records("title").withColumnRenamed("id", "record_id"), g.nodes("name", live=False).select(F.col("id").alias("speaker_id"), F.col("name").alias("speaker"))
    return g.claims("record_id", "speaker_id").join(r, "record_id", "left").join(n, "speaker_id", "left").select("id", "title", "speaker")


@add("j3_nodes_with_claims", q("node nc", "SELECT id, node_type FROM node WHERE id IN (SELECT nid FROM nc)"))
def nodes_with_claims(g):
    return g.nodes("node_type").join(g.node_claims().select(F.col("nid").alias("id")), "id", "left_semi")


@add("j4_claims_without_references", q("clm edge", "SELECT id, record_id FROM clm WHERE id NOT IN (SELECT claim_id FROM edge)"))
def claims_without_references(g):
    return g.claims("record_id").join(g.edges().select(F.col("claim_id").alias("id")), "id", "left_anti").select("id", "record_id")


@add("j5_related_nodes", q("edge node", """
SELECT a, b, shared, place FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY shared DESC, name, b) AS place FROM (
  SELECT x.node_id AS a, y.node_id AS b, n.name, count(DISTINCT x.claim_id) AS shared FROM edge x JOIN edge y ON x.claim_id = y.claim_id AND x.node_id <> y.node_id JOIN node n ON n.id = y.node_id GROUP BY 1, 2, 3)) WHERE place <= 30"""))
def related(g):
    return ev.related_nodes(g.edges(), g.nodes("name"))


@add("j6_record_demand", q("nc", """
, x AS (SELECT DISTINCT rid, nid FROM nc WHERE rid IS NOT NULL)
SELECT a.rid, count(DISTINCT b.rid) AS reach, round_even(1 + ln(1 + count(DISTINCT b.rid)), 3) AS demand FROM x a JOIN x b ON a.nid = b.nid AND a.rid <> b.rid GROUP BY a.rid"""))
def demand(g):
    return ev.record_reach(g.node_claims())


@add("j12_find_node_by_name", q("node alias edge", """
, n AS (SELECT n.name, n.id, row_number() OVER (PARTITION BY n.name ORDER BY coalesce(r.c, 0) DESC, n.id) AS p FROM node n LEFT JOIN (SELECT node_id, count(*) AS c FROM edge GROUP BY 1) r ON r.node_id = n.id),
a AS (SELECT alias, min(node_id) AS id FROM alias JOIN node ON node.id = node_id GROUP BY 1),
w AS (SELECT DISTINCT trim(name) AS name FROM canonical_spelling_outvoted WHERE trim(name) <> '' UNION SELECT alias FROM alias)
SELECT w.name, coalesce(n.id, a.id) AS node_id FROM w LEFT JOIN n ON n.name = w.name AND p = 1 LEFT JOIN a ON a.alias = w.name"""))
def find_by_name(g):
    refs = g.edges().groupBy(F.col("node_id").alias("id")).agg(F.count("*").alias("c"))
    n = g.nodes("name").join(refs, "id", "left")
    by_name = n.groupBy("name").agg(F.min_by("id", F.struct(-F.coalesce("c", F.lit(0)), F.col("id"))).alias("a"))
    al = g.aliases()
    by_alias = al.join(g.nodes("name").select(F.col("id").alias("node_id")), "node_id", "left_semi").groupBy(F.col("alias").alias("name")).agg(F.min("node_id").alias("b"))
    asked = g.raw("canonical_spelling_outvoted").select(F.trim("name").alias("name")).where("name <> ''").union(al.select("alias")).distinct()
    return asked.join(by_name, "name", "left").join(by_alias, "name", "left").select("name", F.coalesce("a", "b").alias("node_id"))


@add("j14_receipts_against_digests", """
WITH d AS (SELECT regexp_extract(lower(record_content_hash), '([0-9a-f]{64})$', 1) AS k, arg_max(regexp_extract(lower(digest_sha256), '([0-9a-f]{64})$', 1), (produced_at, arrived_at, digest_sha256)) AS v FROM digests WHERE digest_sha256 IS NOT NULL GROUP BY 1),
r AS (SELECT regexp_extract(lower(record_content_hash), '([0-9a-f]{64})$', 1) AS k, arg_max(regexp_extract(lower(digest_sha256), '([0-9a-f]{64})$', 1), run_id) AS v FROM digest_import_receipts WHERE run_id IN (SELECT run_id FROM import_runs WHERE run_status = 'succeeded') GROUP BY 1)
SELECT CASE WHEN r.k IS NULL THEN 'missing' WHEN d.k IS NULL THEN 'orphan' WHEN d.v = r.v THEN 'current' ELSE 'changed' END AS state, count(*) AS n FROM d FULL JOIN r ON d.k = r.k GROUP BY 1""")
def receipts_against_digests(g):
    from ..operators import incremental as inc

    d = inc.digests_in_force(g.raw("digests"))
    r = inc.imported_state(g.raw("digest_import_receipts"), g.raw("import_runs")).select("key", F.col("digest").alias("was"))
    x = d.join(r, "key", "full_outer")
    state = F.when(F.col("was").isNull(), "missing").when(F.col("digest").isNull(), "orphan").when(F.col("digest") == F.col("was"), "current").otherwise("changed")
    return x.groupBy(state.alias("state")).agg(F.count("*").alias("n"))


# ---- aggregations


_COUNTS = "SELECT n.id, n.node_type, count(DISTINCT x.cid) AS claims, count(DISTINCT coalesce(w.work, x.rid)) AS sources FROM node n JOIN nc x ON x.nid = n.id LEFT JOIN work w ON w.rid = x.rid GROUP BY 1, 2"


@add("a1_node_counts", q("node nc work", _COUNTS))
def node_counts(g):
    return g.nodes("node_type").join(ev.counts_per_node(g.node_claims(), g.works()).withColumnRenamed("nid", "id"), "id")


_SPREAD = """
, s AS (SELECT nid, work, n, row_number() OVER (PARTITION BY nid ORDER BY n DESC, work DESC) AS p FROM (SELECT x.nid, coalesce(w.work, x.rid) AS work, count(DISTINCT x.cid) AS n FROM nc x LEFT JOIN work w ON w.rid = x.rid GROUP BY 1, 2)),
sp AS (SELECT nid, sum(n) AS claims, count(work) AS sources, max(n) FILTER (p = 1) AS top_source, coalesce(max(n) FILTER (p = 2), 0) AS second_source FROM s GROUP BY nid)
"""


@add("a2_source_spread", q("nc work", _SPREAD + "SELECT nid, CAST(claims AS BIGINT) AS claims, sources, top_source, second_source FROM sp"))
def source_spread(g):
    return ev.spread_per_node(g.node_claims(), g.works())


@add("a3_claims_per_node", q("nc", "SELECT nid, count(*) AS claims FROM nc GROUP BY nid"))
def claims_per_node(g):
    return g.node_claims().groupBy("nid").agg(F.countDistinct("cid").alias("claims"))


@add("a5_graph_stats", q("allnode rec clm edge", """
SELECT 'nodes' AS what, count(*) AS n FROM allnode UNION ALL SELECT 'records', count(DISTINCT id) FROM rec UNION ALL SELECT 'claims', count(DISTINCT id) FROM clm UNION ALL SELECT 'edges', count(*) FROM edge
UNION ALL SELECT 'active_nodes', count(*) FROM allnode WHERE retired_at IS NULL UNION ALL SELECT 'type:' || node_type, count(*) FROM allnode WHERE retired_at IS NULL GROUP BY node_type"""))
def graph_stats(g):
    n = g.nodes("node_type", "retired_at", live=False)
    one = lambda df, name: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("what"), "n")
    out = one(n, "nodes").unionByName(one(g.records(), "records")).unionByName(one(g.claims(), "claims")).unionByName(one(g.edges(), "edges"))
    alive = n.where("retired_at IS NULL")
    return out.unionByName(one(alive, "active_nodes")).unionByName(alive.groupBy(F.concat(F.lit("type:"), "node_type").alias("what")).agg(F.count("*").alias("n")))


@add("a6_entailment_summary", q("clm", """
SELECT *, round_even(entailed_by_quote / assessed, 3) AS entailed_by_quote_fraction, round_even(entailed_by_window / assessed, 3) AS entailed_by_window_fraction FROM (
SELECT count(*) FILTER (entailment_label IN ('entails', 'neutral', 'contradicts')) AS assessed, count(*) FILTER (entailment_label IS NULL) AS unassessed, count(*) FILTER (entailment_label = 'entails') AS entails,
 count(*) FILTER (entailment_label = 'neutral') AS neutral, count(*) FILTER (entailment_label = 'contradicts') AS contradicts, count(*) FILTER (entailment_label = 'entails' AND entailment_premise = 'quote') AS entailed_by_quote,
 count(*) FILTER (entailment_label = 'entails' AND entailment_premise IS DISTINCT FROM 'quote') AS entailed_by_window FROM clm)"""))
def entailment(g):
    return ev.entailment_summary(g.claims("entailment_label", "entailment_premise"))


@add("a7_salience_coverage", q("edge", "SELECT coalesce(salience, 'null') AS salience, count(*) AS n FROM edge GROUP BY 1"))
def coverage(g):
    return ev.salience_coverage(g.edges())


_SHAPE = """
, w AS (SELECT claim_id, count(*) AS width FROM edge GROUP BY 1)
SELECT n.id, n.name, n.node_type, count(*) AS edges, count(DISTINCT c.record_id) AS records, count(*) FILTER (w.width = 1) AS sole, count(*) FILTER (w.width = 1) / count(*) AS sole_share
FROM edge e JOIN w USING (claim_id) JOIN node n ON n.id = e.node_id JOIN clm c ON c.id = e.claim_id GROUP BY 1, 2, 3"""


@add("a8_edge_shape", q("edge node clm", _SHAPE))
def edge_shape(g):
    return ev.edge_shape(g.edges(), g.nodes("name", "node_type"), g.claims("record_id"))


@add("a9_sole_reference_edges", q("edge", "SELECT count(*) AS n FROM (SELECT claim_id FROM edge GROUP BY 1 HAVING count(*) = 1)"))
def sole_edges(g):
    return g.edges().groupBy("claim_id").count().where("count = 1").agg(F.count("*").alias("n"))


@add("a10_implausible_subjects", q("edge allnode", """
, t AS (SELECT greatest(CAST(floor(count(*) * 0.02) AS BIGINT), 1) AS ceiling FROM edge WHERE salience IS NOT NULL)
SELECT e.node_id, n.name, count(*) AS subject_edges, any_value(t.ceiling) AS ceiling FROM edge e JOIN allnode n ON n.id = e.node_id, t WHERE salience = 'subject' GROUP BY 1, 2 HAVING count(*) > any_value(t.ceiling)"""))
def implausible(g):
    return ev.implausible_subjects(g.edges(), g.nodes("name", live=False))


@add("a11_node_independence", q("nc rooted", """
, x AS (SELECT nc.nid, r.* FROM nc JOIN rooted r ON r.id = nc.cid),
a AS (SELECT nid, max(n) AS n FROM (SELECT nid, record_id, greatest(count(DISTINCT nullif(origin_ref, '')), 1) AS n FROM x WHERE root_kind = 'anonymous' GROUP BY 1, 2) GROUP BY 1),
p AS (SELECT nid, count(DISTINCT CASE WHEN root_kind NOT IN ('anonymous', 'unknown') THEN root_kind || chr(31) || coalesce(root, '') END) AS roots, count(*) FILTER (root_kind <> 'unknown') AS scored, count(*) FILTER (root_kind = 'unknown') AS unscored FROM x GROUP BY 1)
SELECT p.nid, CASE WHEN scored > 0 THEN roots + coalesce(a.n, 0) END AS sources, scored, unscored, unscored / (scored + unscored) AS unscored_share FROM p LEFT JOIN a USING (nid)"""))
def independence(g):
    return ev.independence_per_node(g.node_claims(), g.claims("record_id", "speaker_id", "origin_kind", "origin", "origin_ref"), ev.name_index(g.nodes("name"), g.aliases(), True))


_SCORES = """
, b AS (SELECT claim_a AS id, claim_b AS other FROM corr UNION SELECT claim_b, claim_a FROM corr),
gr AS (SELECT id AS claim_id, other AS id FROM b UNION SELECT id, id FROM clm),
x AS (SELECT gr.claim_id, r.* FROM gr JOIN rooted0 r ON r.id = gr.id),
an AS (SELECT claim_id, max(n) AS n FROM (SELECT claim_id, record_id, greatest(count(DISTINCT nullif(origin_ref, '')), 1) AS n FROM x WHERE root_kind = 'anonymous' GROUP BY 1, 2) GROUP BY 1),
p AS (SELECT claim_id, count(DISTINCT CASE WHEN root_kind <> 'anonymous' THEN root_kind || chr(31) || coalesce(root, '') END) AS roots FROM x GROUP BY 1),
w AS (SELECT id, (CASE claim_type WHEN 'measurement' THEN 0.9e0 WHEN 'testimony' THEN 0.8e0 WHEN 'observation' THEN 0.75e0 WHEN 'administrative' THEN 0.7e0 WHEN 'hearsay' THEN 0.4e0 WHEN 'opinion' THEN 0.3e0 ELSE 0.5e0 END)
 * (CASE attestation WHEN 'first_hand' THEN 1.0e0 WHEN 'second_hand' THEN 0.6e0 WHEN 'third_hand' THEN 0.3e0 ELSE 0.5e0 END) AS base FROM clm),
s AS (SELECT w.id, base, p.roots + coalesce(an.n, 0) AS n, (SELECT count(*) FROM b WHERE b.id = w.id) AS m FROM w JOIN p ON p.claim_id = w.id LEFT JOIN an ON an.claim_id = w.id),
c AS (SELECT *, CASE WHEN n <= 1 THEN base ELSE 1 - pow(1 - base, n) END AS comb FROM s)
SELECT id AS claim_id, round(base, 9) AS base_weight, n AS source_count, m AS corroboration_count, round(least(comb, 1), 9) AS score, round(comb - base, 9) AS corroboration_bonus,
 CASE WHEN round(comb, 9) >= 0.85 THEN 'strong' WHEN round(comb, 9) >= 0.65 THEN 'moderate' WHEN round(comb, 9) >= 0.40 THEN 'weak' ELSE 'insufficient' END AS tier FROM c"""


@add("v1_evidence_scores", q("corr rooted0", _SCORES))
def evidence_scores(g):
    c = g.claims("claim_type", "attestation", "record_id", "speaker_id", "origin_kind", "origin", "origin_ref")
    return ev.scores(c, g.corroborations(), ev.name_index(g.nodes("name"), g.aliases(), False))


@add("v2_provenance_roots", q("rooted0", "SELECT id, root_kind, root FROM rooted0"))
def roots(g):
    c = ev.provenance_roots(g.claims("record_id", "speaker_id", "origin_kind", "origin"), ev.name_index(g.nodes("name"), g.aliases(), False), False)
    return c.select("id", "root_kind", "root")


@add("g1_corroborations_both_ways", q("corr", "SELECT claim_a AS id, claim_b AS other, similarity FROM corr UNION SELECT claim_b, claim_a, similarity FROM corr"))
def corroborations(g):
    return ev.both_ways(g.corroborations())


@add("a15_source_focus", q("nc clm work", """
, c AS (SELECT c.id AS cid, coalesce(w.work, c.record_id) AS work FROM clm c LEFT JOIN work w ON w.rid = c.record_id WHERE coalesce(w.work, c.record_id) IS NOT NULL), t AS (SELECT work, count(DISTINCT cid) AS size FROM c GROUP BY 1)
SELECT x.nid, c.work, count(DISTINCT c.cid) / any_value(t.size) AS focus FROM nc x JOIN c ON c.cid = x.cid JOIN t ON t.work = c.work GROUP BY 1, 2"""))
def focus(g):
    return ev.source_focus(g.node_claims(), g.claims("record_id"), g.works())


@add("a23_copyright_mix", q("nc rec", """SELECT x.nid, coalesce(json_extract_string(r.metadata, '$.copyright'), 'unknown') AS status, count(DISTINCT x.rid) AS records FROM nc x LEFT JOIN (SELECT id, min(metadata) AS metadata FROM rec GROUP BY 1) r ON r.id = x.rid WHERE x.rid IS NOT NULL GROUP BY 1, 2"""))
def copyright_mix(g):
    r = g.records("metadata").groupBy(F.col("id").alias("rid")).agg(F.min("metadata").alias("metadata"))
    x = g.node_claims().where("rid IS NOT NULL").select("nid", "rid").distinct().join(r, "rid", "left")
    return x.groupBy("nid", F.coalesce(F.get_json_object("metadata", "$.copyright"), F.lit("unknown")).alias("status")).agg(F.count("*").alias("records"))


@add("v9_page_set", q("node nc", "SELECT n.id, n.node_type, count(DISTINCT x.cid) AS claims, count(DISTINCT x.rid) AS records FROM node n JOIN nc x ON x.nid = n.id GROUP BY 1, 2 HAVING count(DISTINCT x.cid) >= 2 AND count(DISTINCT x.rid) >= 2"))
def page_set(g):
    x = g.node_claims().groupBy(F.col("nid").alias("id")).agg(F.countDistinct("cid").alias("claims"), F.countDistinct("rid").alias("records"))
    return g.nodes("node_type").join(x.where("claims >= 2 AND records >= 2"), "id")


@add("v8_single_source_nodes", q("node nc work", _SPREAD + "SELECT n.id, n.node_type, CAST(sp.claims AS BIGINT) AS claims, sp.sources, sp.top_source, sp.second_source FROM sp JOIN node n ON n.id = sp.nid WHERE sp.claims >= 8 AND sp.second_source < 3"))
def single_source(g):
    s = ev.spread_per_node(g.node_claims(), g.works()).where("claims >= 8 AND second_source < 3")
    return g.nodes("node_type").join(s.withColumnRenamed("nid", "id"), "id")


_GATE = _SPREAD + """
SELECT n.id AS node_id, n.node_type, CASE WHEN n.node_type IN ('place', 'object', 'document') THEN 'high-bar' ELSE 'page-worthy' END AS tier, CAST(sp.claims AS BIGINT) AS claims, sp.sources, sp.top_source, sp.second_source
FROM node n JOIN sp ON sp.nid = n.id WHERE sp.second_source >= 3 AND ((n.node_type IN ('person', 'organisation', 'project', 'event', 'topic') AND sp.claims >= 8 AND sp.sources >= 3) OR (n.node_type IN ('place', 'object', 'document') AND sp.claims >= 12 AND sp.sources >= 4))"""


@add("v5_page_gate_floors", q("node nc work", _GATE))
def gate_floors(g):
    return gate.floors_passed(g.nodes("node_type", "name"), ev.spread_per_node(g.node_claims(), g.works())).drop("name")


_OPENING = gate.OPENING.replace("ARTICLES", "|".join(gate.ARTICLES)).replace("HONORIFICS", "|".join(sorted(kernel.HONORIFICS))).replace("\\W", "[^\\p{L}\\p{N}\\p{M}_]")
_ABOUT = _SPREAD + f"""
, gt AS (SELECT n.id, n.node_type, n.name, CASE WHEN n.node_type IN ('place', 'object', 'document') THEN 'high-bar' ELSE 'page-worthy' END AS tier, CAST(sp.claims AS BIGINT) AS claims, sp.sources, sp.top_source, sp.second_source
FROM node n JOIN sp ON sp.nid = n.id WHERE sp.second_source >= 3 AND ((n.node_type IN ('person', 'organisation', 'project', 'event', 'topic') AND sp.claims >= 8 AND sp.sources >= 3) OR (n.node_type IN ('place', 'object', 'document') AND sp.claims >= 12 AND sp.sources >= 4))),
{person_words('gt')},
b AS (SELECT gt.id, gt.name, node_type, {strip_acronym('gt.name')} AS bare, pw.w FROM gt JOIN pw USING (name)),
f AS (SELECT id, name AS f FROM b UNION SELECT id, bare FROM b UNION SELECT id, regexp_extract(name, '\\(([A-Za-z0-9./-]{{2,10}})\\)\\s*$', 1) FROM b UNION SELECT id, split_part(bare, ',', -1) FROM b WHERE position(',' IN bare) > 0
 UNION SELECT id, w[-1] FROM b WHERE node_type = 'person' AND len(w) > 1 AND length(w[-1]) > 2 UNION SELECT a.node_id, a.alias FROM alias a JOIN b ON b.id = a.node_id),
pt AS (SELECT id, '(?is)^{_OPENING}' || string_agg(f, '|' ORDER BY n DESC, f) || ')(?:[^\\p{{L}}\\p{{N}}\\p{{M}}_-]|$)' AS pattern FROM (SELECT DISTINCT id, regexp_replace(trim(f), '([^\\p{{L}}\\p{{N}}\\s])', '\\\\\\1', 'g') AS f, length(trim(f)) AS n FROM f WHERE length(trim(f)) > 1) GROUP BY id),
sc AS (SELECT id, count(*) AS subject_claims FROM (SELECT DISTINCT pt.id, c.content FROM pt JOIN nc ON nc.nid = pt.id JOIN clm c ON c.id = nc.cid WHERE regexp_matches(c.content, pt.pattern)) GROUP BY 1)
SELECT gt.id AS node_id, gt.node_type, gt.name, tier, claims, sources, top_source, second_source, coalesce(subject_claims, 0) AS subject_claims FROM gt LEFT JOIN sc ON sc.id = gt.id LEFT JOIN pw ON pw.name = gt.name
WHERE NOT (gt.node_type IN ('person', 'organisation', 'object') AND coalesce(subject_claims, 0) < 3) AND NOT (gt.node_type = 'person' AND {scoped('pw.w', 'gt.name')})"""


@add("v5_page_gate", q("node nc work clm alias", _ABOUT))
def page_gate(g):
    return gate.page_gate(g)


@add("v7_page_floor_report", q("node nc work rooted", _SPREAD + """
, gt AS (SELECT n.id, CAST(sp.claims AS BIGINT) AS claims, sp.sources, sp.top_source FROM node n JOIN sp ON sp.nid = n.id WHERE sp.second_source >= 3 AND n.node_type IN ('person', 'organisation', 'project', 'event', 'topic') AND sp.claims >= 8 AND sp.sources >= 3),
x AS (SELECT nc.nid, r.* FROM nc JOIN rooted r ON r.id = nc.cid),
a AS (SELECT nid, max(n) AS n FROM (SELECT nid, record_id, greatest(count(DISTINCT nullif(origin_ref, '')), 1) AS n FROM x WHERE root_kind = 'anonymous' GROUP BY 1, 2) GROUP BY 1),
p AS (SELECT nid, count(DISTINCT CASE WHEN root_kind NOT IN ('anonymous', 'unknown') THEN root_kind || chr(31) || coalesce(root, '') END) AS roots, count(*) FILTER (root_kind <> 'unknown') AS scored, count(*) FILTER (root_kind = 'unknown') AS unscored FROM x GROUP BY 1),
i AS (SELECT p.nid, CASE WHEN scored > 0 THEN roots + coalesce(a.n, 0) END AS origins, unscored / (scored + unscored) AS us FROM p LEFT JOIN a USING (nid))
SELECT gt.id AS node_id, gt.claims, top_source / gt.claims AS dominance, origins, us AS unscored_share,
 CASE WHEN top_source / gt.claims >= 0.8 THEN 'one source dominates' WHEN us >= 0.25 OR origins IS NULL THEN 'untested' WHEN origins < 2 THEN 'one origin' ELSE 'passes' END AS verdict FROM gt JOIN i ON i.nid = gt.id"""))
def floor_report(g):
    return gate.floor_report(g)


@add("v17_belonging_standin", q("edge", """SELECT node_id, count(*) FILTER (salience IN ('subject', 'participant')) AS verified, count(*) FILTER (salience = 'mentioned') AS suspect, count(*) FILTER (salience IS NULL OR salience = 'setting') AS unreviewed, count(*) AS total FROM edge GROUP BY 1"""))
def belonging(g):
    e = g.edges()
    status = e.select("claim_id", "node_id", F.when(F.col("salience").isin("subject", "participant"), "verified").when(F.col("salience") == "mentioned", "suspect").alias("status")).where("status IS NOT NULL")
    return gate.belonging(e.select("claim_id", "node_id"), status)


# ---- windows, ranks, limits


@add("w1_name_ambiguity", q("node edge", """
SELECT name, id, refs, place FROM (SELECT n.name, n.id, coalesce(r.c, 0) AS refs, row_number() OVER (PARTITION BY n.name ORDER BY coalesce(r.c, 0) DESC, n.id) AS place, count(*) OVER (PARTITION BY n.name) AS k
 FROM node n LEFT JOIN (SELECT node_id, count(*) AS c FROM edge GROUP BY 1) r ON r.node_id = n.id) WHERE k > 1"""))
def name_ambiguity(g):
    refs = g.edges().groupBy(F.col("node_id").alias("id")).agg(F.count("*").alias("refs"))
    n = g.nodes("name").join(refs, "id", "left").withColumn("refs", F.coalesce("refs", F.lit(0)))
    w = W.partitionBy("name")
    return n.withColumns({"place": F.row_number().over(w.orderBy(F.desc("refs"), "id")), "k": F.count("*").over(w)}).where("k > 1").select("name", "id", "refs", "place")


@add("w6_slugs", q("node", """
, b AS (SELECT id, node_type, trim(regexp_replace(lower(name), '[^a-z0-9]+', '-', 'g'), '-') AS base FROM node)
SELECT id, node_type, CASE WHEN row_number() OVER (PARTITION BY base, node_type ORDER BY id) = 1 THEN base ELSE base || '-' || left(id, 8) END AS slug FROM b"""))
def slugs(g):
    from ..operators import briefs

    return briefs.slug_map(g.nodes("node_type", "name"))


@add("w7_profiles", q("node nc clm", """
, c AS (SELECT nc.nid, c.content, c.claim_hash, c.id, row_number() OVER (PARTITION BY nc.nid ORDER BY length(c.content) DESC, coalesce(c.claim_hash, c.id), c.id) AS p FROM nc JOIN clm c ON c.id = nc.cid)
SELECT n.id, 'Name: ' || n.name || chr(10) || 'Type: ' || n.node_type || chr(10) || 'Claims:' || coalesce(string_agg(chr(10) || '- ' || left(c.content, 200), '' ORDER BY c.p), chr(10) || '(none recorded)') AS profile
FROM node n LEFT JOIN c ON c.nid = n.id AND c.p <= 5 GROUP BY n.id, n.name, n.node_type"""))
def profiles(g):
    from ..operators import briefs

    return briefs.profiles(g.nodes("name", "node_type"), g.node_claims(), g.claims("content", "claim_hash"))


@add("w10_latest_event", """
SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type, max(ts) AS ts, count(*) AS n FROM events GROUP BY 1""")
def latest_event(g):
    e = g.raw("events")
    return e.groupBy("user_id").agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("event_type"), F.max("ts").alias("ts"), F.count("*").alias("n"))


@add("l4_reading_order", q("rk", "SELECT id, record_id, row_number() OVER (PARTITION BY record_id ORDER BY pos) AS place FROM rk WHERE record_id IS NOT NULL"))
def reading_order(g):
    from ..operators import briefs

    return briefs.reading_order(g.reading_claims().where("record_id IS NOT NULL"), "record_id")


@add("l9_batches", q("node", "SELECT batch, count(*) AS n, min(id) AS first_id FROM (SELECT id, (row_number() OVER (ORDER BY id) - 1) // 50 AS batch FROM node) GROUP BY 1"))
def batches(g):
    from ..common import with_position

    x = with_position(g.nodes("name").select("id"), [F.col("id").asc()], "n", start=0)
    return x.groupBy(F.floor(F.col("n") / 50).alias("batch")).agg(F.count("*").alias("n"), F.min("id").alias("first_id"))


# ---- further relations


@add("g4_claims_with_refs", q("clm edge", "SELECT c.id, list_sort(list(e.node_id)) AS node_ids, count(*) AS refs FROM clm c JOIN edge e ON e.claim_id = c.id GROUP BY 1"))
def claims_with_refs(g):
    e = g.edges().join(g.claims().withColumnRenamed("id", "claim_id"), "claim_id", "left_semi")
    return e.groupBy(F.col("claim_id").alias("id")).agg(F.sort_array(F.collect_list("node_id")).alias("node_ids"), F.count("*").alias("refs"))


@add("g25_graph_version", q("clm", "SELECT record_id, max(left(replace(created_at, ' ', 'T'), 19)) AS version FROM clm WHERE record_id IS NOT NULL GROUP BY 1"))
def graph_version(g):
    from ..common import parse_utc

    c = g.claims("record_id", "created_at").where("record_id IS NOT NULL")
    return c.groupBy("record_id").agg(F.date_format(F.max(parse_utc("created_at")), "yyyy-MM-dd'T'HH:mm:ss").alias("version"))


_REPORTED = f"SELECT DISTINCT {ident('node_id')} AS id, {NODE_TYPE} AS node_type, lower(trim(regexp_replace(name, '\\s+', ' ', 'g'))) AS key FROM canonical_spelling_outvoted WHERE trim(name) <> '' AND node_type IS NOT NULL"


@add("e7_cross_type_twins", f"WITH k AS ({_REPORTED}) SELECT DISTINCT a.id AS id_a, b.id AS id_b, a.node_type AS type_a, b.node_type AS type_b, a.key FROM k a JOIN k b ON a.key = b.key AND a.node_type < b.node_type")
def twins(g):
    """Names that reports give to nodes of several types (live nodes have none of one name)."""
    from ..common import node_type, norm_id

    n = g.raw("canonical_spelling_outvoted").select(norm_id("node_id").alias("id"), node_type("node_type").alias("node_type"), "name")
    return resolve.cross_type_twins(n)


#: Places: bare ones and those that end in them.
CASE_PLACES = [("1", "Roswell", 5), ("2", "USA, New Mexico,  roswell ", 9), ("3", "Canada, Roswell", 7), ("4", "Lima", 1), ("5", "Lima, Peru", 2), ("6", "Peru, Lima", 3), ("7", "Cusco", 4), ("8", None, 5)]


@add("e14_doubled_place_cases", "SELECT * FROM (VALUES ('1', '3'), ('4', '6')) t(bare_id, compound_id)")
def doubled_places(g):
    return resolve.doubled_places(g.spark.createDataFrame(CASE_PLACES, "id string, name string, seq int"))
