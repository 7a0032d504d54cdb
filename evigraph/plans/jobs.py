"""Queries of the jobs that are to be done next."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..common import norm_hash
from ..operators import briefs, gate, jobs
from ..operators import evidence as ev
from ..operators import incremental as inc
from ..operators.graph import Graph
from .curation import _select_sql, _selected
from .evidence import _ABOUT
from .registry import Registry
from .sqlbase import hash64
from .sqlbase import with_parts as q

R = Registry()
OLD = (30, 1200)


@R.add("z1_ingest_jobs", q("rec", f"SELECT DISTINCT 'ingest:' || content_hash AS id, content_hash AS hash, 'unknown ' || left(content_hash, 12) AS label, 'eager' AS lane, '~extraction' AS effort FROM rec WHERE content_hash IS NOT NULL AND content_hash NOT IN (SELECT {hash64('record_content_hash')} FROM digest_import_receipts WHERE {hash64('record_content_hash')} IS NOT NULL)"))
def z1(spark, sf):
    """Contents of records without a receipt; the tables don't name file types."""
    g = Graph(spark, sf)
    s = g.records("content_hash").select(F.col("content_hash").alias("hash"), F.lit(None).cast("string").alias("ext"))
    done = g.raw("digest_import_receipts").select(norm_hash("record_content_hash").alias("hash"))
    return jobs.ingest_jobs(s, done, done.where(F.lit(False)))


_INFORCE = f"d AS (SELECT DISTINCT {hash64('record_content_hash')} AS k FROM digests WHERE {hash64('record_content_hash')} IS NOT NULL AND {hash64('digest_sha256')} IS NOT NULL)"


@R.add("z3_rebuild_jobs", q("rec", f", {_INFORCE} SELECT 'rebuild:graph' AS id, 'blocked' AS status, 'canonical_set_contraction' AS trigger, count(*) AS orphans FROM (SELECT DISTINCT content_hash AS k FROM rec WHERE content_hash IS NOT NULL) WHERE k NOT IN (SELECT k FROM d) HAVING count(*) > 0"))
def z3(spark, sf):
    g = Graph(spark, sf)
    return jobs.rebuild_jobs(g.records("content_hash").where("content_hash IS NOT NULL").select(F.col("content_hash").alias("key")), inc.digests_in_force(g.raw("digests")))


@R.add("z4_digest_jobs", q("rec nc", f""", {_INFORCE}, x AS (SELECT DISTINCT rid, nid FROM nc WHERE rid IS NOT NULL), dm AS (SELECT a.rid, round_even(1 + ln(1 + count(DISTINCT b.rid)), 3) AS demand FROM x a JOIN x b ON a.nid = b.nid AND a.rid <> b.rid GROUP BY 1),
g AS (SELECT max(extraction_generation) AS g FROM digests), l AS (SELECT {hash64('record_content_hash')} AS h, arg_max(extraction_generation, (produced_at, arrived_at)) AS gen FROM digests WHERE {hash64('digest_sha256')} IS NOT NULL GROUP BY 1),
r AS (SELECT content_hash AS h, min(coalesce(f.friendly_name, title)) AS label, max(dm.demand) AS value FROM rec JOIN (SELECT lower(trim(id)) AS i, min(friendly_name) AS friendly_name FROM records GROUP BY 1) f ON f.i = rec.id LEFT JOIN dm ON dm.rid = rec.id WHERE content_hash IS NOT NULL GROUP BY 1)
SELECT 'digest:' || r.h AS id, r.h AS hash, coalesce(label, 'record ' || left(r.h, 12)) AS label, CASE WHEN d.k IS NULL THEN 'never_done' ELSE 'stale' END AS trigger, value, CASE WHEN d.k IS NOT NULL THEN ['older generation'] ELSE [] END AS reasons
FROM r LEFT JOIN d ON d.k = r.h LEFT JOIN l ON l.h = r.h, g WHERE d.k IS NULL OR l.gen < g.g"""))
def z4(spark, sf):
    g = Graph(spark, sf)
    r = g.records("content_hash", "friendly_name", "title")
    d = g.raw("digests").select(norm_hash("record_content_hash").alias("hash"), norm_hash("digest_sha256").alias("sha"), "extraction_generation", "produced_at", "arrived_at")
    newest = d.agg(F.max("extraction_generation").alias("newest"))
    last = d.where("sha IS NOT NULL").groupBy("hash").agg(F.max_by("extraction_generation", F.struct("produced_at", "arrived_at")).alias("gen"))
    reasons = last.join(F.broadcast(newest)).select("hash", F.when(F.col("gen") < F.col("newest"), "older generation").alias("reason"))  # one row
    demand = ev.record_reach(g.node_claims()).select(F.col("rid").alias("id"), "demand").join(r.select("id", F.col("content_hash").alias("hash")), "id").groupBy("hash").agg(F.max("demand").alias("value"))
    return jobs.digest_jobs(r.select(F.col("content_hash").alias("hash"), "friendly_name", "title"), d.where("sha IS NOT NULL").select("hash"), reasons, demand)


def _state(g, cap, budget):
    """(briefs, their claims): what the writer makes under a cap; an older cap stands in for briefs on disk."""
    c = g.reading_claims("claim_hash", "content").withColumn("h", F.coalesce("claim_hash", F.sha2("content", 256))).withColumn("key", briefs.reading_key()).select("id", "key", "h")
    s = _selected(g, cap, budget).select("node", "id").join(c, "id")
    claims = s.withColumn("place", F.row_number().over(W.partitionBy("node").orderBy("key")))
    lists = claims.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("place", "id", "h"))).alias("c"))
    n = briefs.slug_map(g.nodes("node_type", "name")).join(g.nodes("name"), "id")
    b = n.join(lists.withColumnRenamed("node", "id"), "id").select(F.col("id").alias("reference"), F.col("id").alias("node_id"), "slug", "node_type", F.col("name").alias("title"), F.sha2(F.array_join(F.transform("c", lambda x: F.concat_ws(":", x["id"], x["h"])), ","), 256).alias("brief_hash"), F.sha2(F.concat_ws("|", "name", F.size("c").cast("string")), 256).alias("payload_hash"))
    live = b.select(F.col("reference").alias("node"))
    return b, claims.join(live, "node", "left_semi").select(F.col("node").alias("reference"), "place", F.col("id").alias("claim_id"), F.col("h").alias("claim_hash"))


_HASHED = """, {c} AS (SELECT sel.nid AS reference, row_number() OVER (PARTITION BY sel.nid ORDER BY sel.pos) AS place, sel.id AS claim_id, coalesce(clm.claim_hash, sha256(clm.content)) AS h FROM {sel} sel JOIN clm ON clm.id = sel.id JOIN node ON node.id = sel.nid),
{n}b AS (SELECT c.reference, sha256(string_agg(c.claim_id || ':' || c.h, ',' ORDER BY place)) AS brief_hash, sha256(any_value(node.name) || '|' || count(*)) AS payload_hash FROM {c} c JOIN node ON node.id = c.reference GROUP BY 1)"""
_NOW, _THEN = _select_sql(40, 1800), f", old AS (SELECT nid, src, id, pos, turn FROM z WHERE turn <= {OLD[0]} AND ((alln <= {OLD[0]} AND lim IS NULL) OR spent <= {OLD[1]}))"
_BOTH = _NOW + _THEN + _HASHED.format(n="n", c="ncl", sel="sel") + _HASHED.format(n="o", c="oc", sel="old")


@R.add("z6_synthesise_jobs", q("nc clm corr node work rk", _BOTH + """, j AS (SELECT coalesce(a.reference, b.reference) AS reference, a.place AS p, b.place AS q, a.h AS h, b.h AS i FROM oc a FULL JOIN ncl b ON a.reference = b.reference AND a.claim_id = b.claim_id),
k AS (SELECT reference, count(*) FILTER (q IS NULL) AS removed, count(*) FILTER (p IS NULL) AS added, count(*) FILTER (h <> i) AS changed, count(*) FILTER (h = i AND p <> q) AS moved FROM j GROUP BY 1)
SELECT 'synthesise:' || nb.reference AS id, nb.reference, CASE WHEN ob.reference IS NULL THEN 'never_done' ELSE 'stale_brief' END AS trigger, CASE WHEN ob.reference IS NULL THEN ['brief_missing'] ELSE list_filter([CASE WHEN nb.payload_hash <> ob.payload_hash THEN 'payload_hash_mismatch' END, CASE WHEN nb.brief_hash <> ob.brief_hash THEN 'selection_hash_mismatch' END], lambda x: x IS NOT NULL) END AS reasons,
 coalesce(removed, 0) AS removed, coalesce(added, 0) AS added, coalesce(changed, 0) AS changed, coalesce(moved, 0) AS moved FROM nb LEFT JOIN ob USING (reference) LEFT JOIN k ON k.reference = nb.reference WHERE ob.reference IS NULL OR nb.brief_hash <> ob.brief_hash OR nb.payload_hash <> ob.payload_hash"""))
def z6(spark, sf):
    g = Graph(spark, sf)
    (ob, oc), (nb, nc) = _state(g, *OLD), _state(g, 40, 1800)
    return jobs.synthesise_jobs(ob, nb, oc, nc)


@R.add("z7_assemble_jobs", q("nc clm corr node work rk", _BOTH + """, m AS (SELECT oc.reference, count(*) AS citations, count(*) FILTER (ncl.claim_id IS NULL) AS missing FROM oc LEFT JOIN ncl USING (reference, claim_id) GROUP BY 1)
SELECT 'assemble:' || nb.reference AS id, nb.reference, 'en' AS language, 'eligible' AS status, CASE WHEN ob.reference IS NULL THEN 'never_done' ELSE 'stale_brief' END AS trigger, CASE WHEN ob.reference IS NULL THEN ['article_missing'] ELSE list_filter([CASE WHEN nb.brief_hash <> ob.brief_hash THEN 'brief_hash_mismatch' END, CASE WHEN nb.payload_hash <> ob.payload_hash THEN 'payload_hash_mismatch' END, CASE WHEN missing > 0 THEN 'citation_missing' END], lambda x: x IS NOT NULL) END AS reasons,
 CASE WHEN missing > 0 THEN 'repair' ELSE 'finish' END AS consequence, coalesce(citations, 0) AS citations, coalesce(missing, 0) AS missing, 0 AS mismatched FROM nb LEFT JOIN ob USING (reference) LEFT JOIN m ON m.reference = nb.reference WHERE ob.reference IS NULL OR nb.brief_hash <> ob.brief_hash OR nb.payload_hash <> ob.payload_hash OR missing > 0"""))
def z7(spark, sf):
    """Articles built from the briefs under the older cap, citing all their claims."""
    g = Graph(spark, sf)
    (ob, oc), (nb, nc) = _state(g, *OLD), _state(g, 40, 1800)
    articles = ob.select("reference", F.lit("en").alias("language"), "brief_hash", "payload_hash", F.create_map().cast("map<string,string>").alias("built_by"), F.lit(None).cast("string").alias("body_sha256"))
    return jobs.assemble_jobs(nb, nc, articles, oc.select("reference", F.lit("en").alias("language"), "claim_id", "claim_hash"))


@R.add("z8_graph_jobs", q("allnode node alias nc work clm", _ABOUT.replace("\nSELECT gt.id AS node_id", ",\nga AS (SELECT gt.id AS node_id").rstrip() + """), em AS (SELECT DISTINCT nullif(lower(trim(id)), '') AS id FROM embedding_model WHERE kind = 'claim'),
df AS (SELECT count(*) AS n FROM gt WHERE id NOT IN (SELECT node_id FROM ga)), ub AS (SELECT left(sha256(id), 1) AS bucket, count(*) AS pending FROM clm WHERE id NOT IN (SELECT id FROM em) GROUP BY 1)
SELECT 'propose-pages' AS id, 'propose' AS type, n, NULL AS minutes FROM df WHERE n > 0 UNION ALL SELECT 'embed:' || bucket, 'embed', pending, CAST(greatest(round_even(pending / 4.9 / 60, 0), 1) AS INTEGER) FROM ub"""))
def z8(spark, sf):
    """The nodes past the floors alone stand in for a recorded proposal; buckets by SHA-256 (z8_embedding_jobs has crc32)."""
    from ..common import norm_id

    g = Graph(spark, sf)
    floors = gate.floors_passed(g.nodes("node_type", "name"), ev.spread_per_node(g.node_claims(), g.works()))
    done = g.raw("embedding_model").where("kind = 'claim'").select(norm_id("id").alias("id")).distinct()
    pending = g.claims().join(done, "id", "left_anti").groupBy(F.substring(F.sha2("id", 256), 1, 1).alias("bucket")).agg(F.count("*").alias("pending"))
    return jobs.graph_jobs(gate.page_gate(g), floors, pending)
