"""Queries of publishing: copyright of what goes out, briefs that nothing may be built from, notes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import briefs, consistency, gate, pages, publishing
from ..operators import evidence as ev
from ..operators.graph import Graph
from .curation import _SELECT, _selected
from .evidence import _SPREAD
from .pages import _LEDGERS, _SECTION, _SLUGS, _composed
from .registry import Registry
from .sqlbase import with_parts as q

R = Registry()


def _file(kind: str, slug: str):
    return F.concat(pages.section(kind), F.lit("/"), slug, F.lit(".yaml"))


@R.add("s15_published_claims_by_status", q("nc clm corr node work rk rec", _SELECT + """SELECT coalesce(json_extract_string(r.metadata, '$.copyright'), 'unknown') AS status, count(*) AS claims FROM sel JOIN node ON node.id = sel.nid JOIN clm c ON c.id = sel.id LEFT JOIN (SELECT content_hash, min(metadata) AS metadata FROM rec WHERE content_hash IS NOT NULL GROUP BY 1) r ON r.content_hash = (SELECT min(content_hash) FROM rec WHERE rec.id = c.record_id) GROUP BY 1"""))
def s15(spark, sf):
    g = Graph(spark, sf)
    b = briefs.slug_map(g.nodes("node_type", "name")).select("id", _file("node_type", "slug").alias("file"), F.lit(None).cast("string").alias("error"))
    hashes = g.records("content_hash").groupBy(F.col("id").alias("record_id")).agg(F.min("content_hash").alias("content_hash"))
    c = _selected(g).select(F.col("node").alias("nid"), "id").join(g.claims("record_id"), "id").join(hashes, "record_id", "left").select("nid", F.col("id").alias("claim_id"), "content_hash")
    claims = c.join(b.select(F.col("id").alias("nid"), "file"), "nid").select("file", "claim_id", "content_hash")
    status = g.records("content_hash", "metadata").where("content_hash IS NOT NULL").groupBy("content_hash").agg(F.get_json_object(F.min("metadata"), "$.copyright").alias("status"))
    return publishing.published(b, claims, status)[1]


_OWN = f", ow AS (SELECT sl.id, {_SECTION.format('sl.node_type')} || '/' || sl.slug || '.yaml' AS file FROM sl), pf AS (SELECT page_id, name, {_SECTION.format('node_type')} || '/' || slug || '.yaml' AS file FROM ps WHERE state = 'composed')"


def _files(g):
    """Briefs as they would lie if every node, retired ones too, kept the section of its type and its plain name."""
    n = g.nodes("node_type", "name", live=False).where("name IS NOT NULL")
    return n.select(_file("node_type", briefs.slug("name")).alias("file"), "id").groupBy("file").agg(F.min("id").alias("id")).select("file", F.array("id").alias("node_ids"))


def _places(g):
    own = briefs.slug_map(g.nodes("node_type", "name")).select("id", _file("node_type", "slug").alias("file"))
    p, m, _ = _composed(g)
    p = p.where("state = 'composed'").select("page_id", "name", F.concat("section", F.lit("/"), "slug", F.lit(".yaml")).alias("file"))
    return own, p, m


@R.add("b9_unbuildable_briefs", q("allnode node alias nc", _LEDGERS + _SLUGS + _OWN + f""", fl AS (SELECT file, min(id) AS id FROM (SELECT id, {_SECTION.format('node_type')} || '/' || trim(regexp_replace(lower(name), '[^a-z0-9]+', '-', 'g'), '-') || '.yaml' AS file FROM allnode WHERE name IS NOT NULL) GROUP BY 1),
px AS (SELECT node_id, min(page_id) AS page_id FROM pm GROUP BY 1), one AS (SELECT list(node_id ORDER BY position) AS l, page_id FROM pm GROUP BY page_id), co AS (SELECT l[1] AS node_id, min(pf.file) AS file FROM one JOIN pf USING (page_id) WHERE len(l) = 1 GROUP BY 1),
w AS (SELECT fl.file, CASE WHEN node.id IS NULL THEN 'node retired or absent' WHEN fl.id NOT IN (SELECT nid FROM nc) THEN 'node has no claims' WHEN px.page_id IS NOT NULL THEN 'its subject moved to the composed page ' || pf.name WHEN fl.file <> coalesce(co.file, ow.file) THEN 'stale path; the node''s brief is now ' || coalesce(co.file, ow.file) END AS why
 FROM fl LEFT JOIN node ON node.id = fl.id LEFT JOIN px ON px.node_id = fl.id LEFT JOIN pf ON pf.page_id = px.page_id LEFT JOIN ow ON ow.id = fl.id LEFT JOIN co ON co.node_id = fl.id)
SELECT file, why FROM w WHERE why IS NOT NULL"""))
def b9(spark, sf):
    g = Graph(spark, sf)
    own, p, m = _places(g)
    return publishing.unbuildable(_files(g), g.nodes(), g.node_claims().select(F.col("nid").alias("id")), own, p, m, p.select("file"))


@R.add("b10_refiled_briefs", q("allnode node alias", _LEDGERS + _SLUGS + _OWN + f""", fl AS (SELECT file, min(id) AS id FROM (SELECT id, {_SECTION.format('node_type')} || '/' || trim(regexp_replace(lower(name), '[^a-z0-9]+', '-', 'g'), '-') || '.yaml' AS file FROM allnode WHERE name IS NOT NULL) GROUP BY 1),
px AS (SELECT node_id, min(page_id) AS page_id FROM pm GROUP BY 1), ls AS (SELECT page_id, list(node_id ORDER BY position) AS node_ids FROM pm GROUP BY 1),
h AS (SELECT coalesce(ls.node_ids, [fl.id]) AS node_ids, coalesce(pf.file, ow.file) AS write, fl.file FROM fl LEFT JOIN px ON px.node_id = fl.id LEFT JOIN pf ON pf.page_id = px.page_id LEFT JOIN ls ON ls.page_id = px.page_id LEFT JOIN ow ON ow.id = fl.id WHERE fl.id IN (SELECT id FROM node))
SELECT node_ids, any_value(write) AS write, list_sort(list_filter(list(DISTINCT file), lambda f: f <> any_value(write))) AS prune FROM h GROUP BY 1""".replace("list_sort(list_filter(list(DISTINCT file), lambda f: f <> any_value(write)))", "list_sort(coalesce(list(DISTINCT file) FILTER (write IS NULL OR file <> write), []))")))
def b10(spark, sf):
    """All live nodes as renamed ones: those whose file moves have something to prune."""
    g = Graph(spark, sf)
    own, p, m = _places(g)
    return publishing.refiled(_files(g), g.nodes(), own, p, m)


_NOTES = """, e AS (SELECT DISTINCT edge.claim_id, n.name, n.node_type FROM edge JOIN node n ON n.id = edge.node_id WHERE n.name IS NOT NULL), lk AS (SELECT claim_id, list_sort(list(DISTINCT name)) AS linked FROM e GROUP BY 1),
tt AS (SELECT id, min(title) AS title FROM rec GROUP BY 1), u AS (SELECT e.node_type, e.name, c.record_id, c.content, min(c.id) AS claim_id, min(tt.title) AS record FROM e JOIN clm c ON c.id = e.claim_id LEFT JOIN tt ON tt.id = c.record_id WHERE c.content IS NOT NULL GROUP BY 1, 2, 3, 4),
v AS (SELECT u.*, row_number() OVER (PARTITION BY node_type, name ORDER BY record_id NULLS FIRST, claim_id) AS place, list_transform(list_filter(lk.linked, lambda o: o <> u.name), lambda o: '[[' || trim(regexp_replace(o, '[\\[\\]|#^]', '', 'g')) || ']]') AS others FROM u JOIN lk USING (claim_id))"""


@R.add("s16_vault_lines", q("node edge clm rec", _NOTES + """ SELECT node_type AS folder, substr(trim(regexp_replace(regexp_replace(name, '[\\\\/:*?"<>|#^\\[\\]\\x00-\\x1f]', '-', 'g'), '\\s+', ' ', 'g')), 1, 200) || '.md' AS file, (place - 1) // 10000 AS part, place,
 '- ' || regexp_replace(content, '\\s*\\n\\s*', ' ', 'g') || ' (' || coalesce(record, '_') || ')' || CASE WHEN len(others) > 0 THEN ' ' || array_to_string(others, ', ') ELSE '' END AS line FROM v"""))
def s16(spark, sf):
    g = Graph(spark, sf)
    titles = g.records("title").groupBy(F.col("id").alias("record_id")).agg(F.min("title").alias("record"))
    c = g.claims("content", "record_id").join(titles, "record_id", "left")
    return publishing.vault_lines(g.nodes("node_type", "name"), g.edges(), c)


@R.add("b8_person_listing", q("node nc work", "SELECT n.id, count(DISTINCT nc.cid) AS claims, count(DISTINCT coalesce(w.work, nc.rid)) AS works FROM (SELECT DISTINCT id FROM node WHERE node_type = 'person') n LEFT JOIN nc ON nc.nid = n.id LEFT JOIN work w ON w.rid = nc.rid GROUP BY 1"))
def b8(spark, sf):
    g = Graph(spark, sf)
    c = g.node_claims().join(g.works(), "rid", "left").select("nid", "cid", F.coalesce("work", "rid").alias("work"))
    return publishing.person_listing(g.nodes("node_type"), c)


@R.add("z12_findings", q("allnode node alias nc work", _SPREAD + _SLUGS + f"""
, pr AS (SELECT DISTINCT n.id FROM allnode n JOIN sp ON sp.nid = n.id WHERE sp.second_source >= 3 AND ((n.node_type IN ('person', 'organisation', 'project', 'event', 'topic') AND sp.claims >= 8 AND sp.sources >= 3) OR (n.node_type IN ('place', 'object', 'document') AND sp.claims >= 12 AND sp.sources >= 4))),
fl AS (SELECT file, min(id) AS id FROM (SELECT id, {_SECTION.format('node_type')} || '/' || trim(regexp_replace(lower(name), '[^a-z0-9]+', '-', 'g'), '-') AS file FROM allnode WHERE name IS NOT NULL) GROUP BY 1),
x AS (SELECT 'proposal-points-at-dead-node' AS finding, id AS x FROM pr WHERE id NOT IN (SELECT id FROM node)
UNION ALL SELECT 'brief-for-dead-node', file FROM fl WHERE id NOT IN (SELECT id FROM node)
UNION ALL SELECT 'brief-stranded-by-rename', file FROM fl JOIN sl ON sl.id = fl.id WHERE split_part(file, '/', -1) <> sl.slug
UNION ALL SELECT 'proposal-without-brief', name || ' (' || left(id, 8) || ')' FROM node WHERE id IN (SELECT id FROM pr) AND id NOT IN (SELECT id FROM fl))
SELECT finding, count(*) AS n, list_sort(list(x))[:5] AS examples FROM x GROUP BY 1"""))
def z12_findings(spark, sf):
    """Proposals from the floors over retired nodes as well, briefs as _files() has them."""
    g = Graph(spark, sf)
    floors = gate.floors_passed(g.nodes("node_type", "name", live=False), ev.spread_per_node(g.node_claims(), g.works()))
    slugs = briefs.slug_map(g.nodes("node_type", "name")).select("id", "slug")
    b = _files(g).select(F.regexp_replace("file", r"\.yaml$", "").alias("reference"), "node_ids", F.lit("h").alias("brief_hash"), F.lit("p").alias("payload_hash"))
    return consistency.findings(floors.select("node_id"), g.nodes("node_type", "name", "seq").join(slugs, "id"), b)
