"""Queries of unique resolution, pair sets, calibration, reverification, batches and pruning."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..common import table, with_position
from ..functions import text
from ..operators import gate, pairs, resolve
from ..operators import evidence as ev
from ..operators.graph import Graph
from .curation import _PENDING
from .evidence import _SPREAD
from .pairing import _ALL, _labelled
from .registry import Registry
from .sqlbase import with_parts as q

R = Registry()


def _asked(g):
    r = g.raw("canonical_spelling_outvoted")
    clean = lambda c: F.trim(F.regexp_replace(c, r"\s+", " ")).alias("name")
    return r.select(clean("name")).unionByName(r.select(clean("alias"))).where("name <> ''")


@R.add("e6_unique_names", q("node alias", """
, a AS (SELECT DISTINCT trim(regexp_replace(x, '\\s+', ' ', 'g')) AS name FROM (SELECT unnest([name, alias]) AS x FROM canonical_spelling_outvoted) WHERE trim(x) <> ''),
r AS (SELECT id, name FROM node UNION SELECT node_id, alias FROM alias WHERE node_id IN (SELECT id FROM node)), h AS (SELECT a.name, count(DISTINCT r.id) AS n, min(r.id) AS m FROM a LEFT JOIN r ON r.name = a.name GROUP BY 1)
SELECT name, CASE WHEN n = 1 THEN 'unique' WHEN n > 1 THEN 'ambiguous' ELSE 'lost' END AS state, CASE WHEN n = 1 THEN m END AS node_id FROM h"""))
def e6(spark, sf):
    g = Graph(spark, sf)
    return resolve.resolve_unique(_asked(g), g.nodes("name"), g.aliases())


@R.add("m14_tag_outcomes", q("node alias", """
, a AS (SELECT DISTINCT trim(regexp_replace(x, '\\s+', ' ', 'g')) AS name FROM (SELECT unnest([name, alias]) AS x FROM canonical_spelling_outvoted) WHERE trim(x) <> ''),
r AS (SELECT id, name FROM node UNION SELECT node_id, alias FROM alias WHERE node_id IN (SELECT id FROM node)), h AS (SELECT a.name, count(DISTINCT r.id) AS n FROM a LEFT JOIN r ON r.name = a.name GROUP BY 1)
SELECT CASE WHEN n = 1 THEN 'applied' WHEN n > 1 THEN 'pending' ELSE 'lost' END AS outcome, count(*) AS n FROM h GROUP BY 1"""))
def m14(spark, sf):
    g = Graph(spark, sf)
    out = F.when(F.col("state") == "unique", "applied").when(F.col("state") == "ambiguous", "pending").otherwise("lost")
    return resolve.resolve_unique(_asked(g), g.nodes("name"), g.aliases()).groupBy(out.alias("outcome")).agg(F.count("*").alias("n"))


_KEYS = ", k AS (SELECT id, node_type, trim(regexp_replace(regexp_replace(lower(name), '[-_.]+', ' ', 'g'), '\\s+', ' ', 'g')) AS key FROM node), ne AS (SELECT a.id AS a, b.id AS b FROM k a JOIN k b ON a.key = b.key AND a.id < b.id AND a.key <> '')"
_PROPOSED = """, ids AS (SELECT proposal_id, nullif(lower(trim(x)), '') AS x FROM (SELECT proposal_id, unnest(node_ids) AS x FROM merge_proposals_referenced_sources)), pp AS (SELECT DISTINCT p.x AS a, o.x AS b FROM ids p JOIN ids o USING (proposal_id) WHERE p.x < o.x),
u AS (SELECT a, b, 'names' AS source FROM ne UNION SELECT a, b, 'proposals' FROM pp)"""


def _pair_sets(spark, sf):
    from ..operators.ledger import separate_pairs
    from ..common import norm_id

    g = Graph(spark, sf)
    names = resolve.name_edges(g.nodes("node_type", "name"))
    proposed = separate_pairs(g.raw("merge_proposals_referenced_sources").where("node_ids IS NOT NULL").select(F.transform("node_ids", norm_id).alias("ids")), "ids")
    return resolve.union_of_pairs({"names": names, "proposals": proposed}, g.nodes())


@R.add("u3_pair_set_union", q("node", _KEYS + _PROPOSED + " SELECT a, b, list_sort(list(source)) AS sources FROM u WHERE a IN (SELECT id FROM node) AND b IN (SELECT id FROM node) GROUP BY a, b"))
def u3(spark, sf):
    return _pair_sets(spark, sf)[0]


@R.add("u3_dropped_pairs", q("node", _KEYS + _PROPOSED + " SELECT source, count(*) FILTER (NOT (a IN (SELECT id FROM node) AND b IN (SELECT id FROM node))) AS n FROM u GROUP BY 1"))
def u3_dropped(spark, sf):
    return _pair_sets(spark, sf)[1]


@R.add("w4_rank_of_first_match", f"WITH {_ALL}, b AS (SELECT id, max(cosine) AS best FROM s WHERE la = lb GROUP BY 1) SELECT s.id, 1 + count(*) FILTER (cosine > best) AS rank FROM s JOIN b USING (id) GROUP BY s.id")
def w4(spark, sf):
    return pairs.rank_of_first_match(_labelled(spark, sf))


@R.add("g32_cut_report", f"WITH {_ALL} SELECT round(min(cosine) FILTER (la = lb) - max(cosine) FILTER (la <> lb), 9) AS separation, count(*) FILTER (la = lb AND cosine >= 0.3) AS kept, count(*) FILTER (la = lb AND cosine < 0.3) AS missed, count(*) FILTER (la <> lb AND cosine >= 0.3) AS false_links FROM s WHERE id < other")
def g32(spark, sf):
    return pairs.cut_counts(_labelled(spark, sf), 0.3)


@R.add("v10_corroboration_candidates", f"""WITH {_ALL}, n AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY cosine DESC, other) AS place FROM s) WHERE place <= 4)
SELECT DISTINCT least(id, other) AS claim_a, greatest(id, other) AS claim_b, cosine AS similarity FROM n WHERE la <> lb AND cosine >= 0.3""")
def v10(spark, sf):
    v = _labelled(spark, sf)
    label = v.select("id", "grp")
    # five neighbours with the vector itself, cut before own groups are left out
    near = pairs.cosine_pairs(v, 4).join(label, "id").join(label.select(F.col("id").alias("other"), F.col("grp").alias("other_grp")), "other")
    return near.where("grp <> other_grp AND cosine >= 0.3").select(F.least("id", "other").alias("claim_a"), F.greatest("id", "other").alias("claim_b"), F.col("cosine").alias("similarity")).distinct()


@R.add("v11_similar_groups", f"""WITH RECURSIVE {_ALL}, e AS (SELECT id AS a, other AS b FROM s WHERE cosine >= 0.4), t(id, c) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT e.a, t.c FROM e JOIN t ON t.id = e.b) SELECT id, min(c) AS component FROM t GROUP BY id""")
def v11(spark, sf):
    return pairs.similar_groups(_labelled(spark, sf), 0.4)


_LOCATORS = """
, l AS (SELECT c.id, r.content_hash AS h, c.claim_hash AS f FROM clm c LEFT JOIN rec r ON r.id = c.record_id), n AS (SELECT h, f, count(DISTINCT id) AS n FROM l WHERE h IS NOT NULL AND f IS NOT NULL GROUP BY 1, 2),
x AS (SELECT corr.claim_a, corr.claim_b, coalesce(na.n, 0) AS a, coalesce(nb.n, 0) AS b FROM corr JOIN l la ON la.id = claim_a JOIN l lb ON lb.id = claim_b LEFT JOIN n na ON na.h = la.h AND na.f = la.f LEFT JOIN n nb ON nb.h = lb.h AND nb.f = lb.f)
SELECT CASE WHEN a = 0 OR b = 0 THEN 'source absent' WHEN a > 1 OR b > 1 THEN 'blocked' ELSE 'pending' END AS status, count(*) AS n FROM x GROUP BY 1"""


@R.add("m18_reverification_inventory", q("corr clm rec", _LOCATORS))
def m18(spark, sf):
    g = Graph(spark, sf)
    hashes = g.records("content_hash").withColumnRenamed("id", "record_id")
    loc = g.claims("record_id", "claim_hash").join(hashes, "record_id", "left").select("id", F.col("content_hash").alias("h"), F.col("claim_hash").alias("f"))
    n = loc.where("h IS NOT NULL AND f IS NOT NULL").groupBy("h", "f").agg(F.countDistinct("id").alias("n"))
    of = loc.join(n, ["h", "f"], "left").select("id", F.coalesce("n", F.lit(0)).alias("n"))
    x = g.corroborations().join(of.select(F.col("id").alias("claim_a"), F.col("n").alias("a")), "claim_a").join(of.select(F.col("id").alias("claim_b"), F.col("n").alias("b")), "claim_b")
    status = F.when((F.col("a") == 0) | (F.col("b") == 0), "source absent").when((F.col("a") > 1) | (F.col("b") > 1), "blocked").otherwise("pending")
    return x.groupBy(status.alias("status")).agg(F.count("*").alias("n"))


@R.add("l8_length_batches", q("clm", "SELECT batch, count(*) AS n, min(w) AS shortest, max(w) AS longest FROM (SELECT length(content) AS w, (row_number() OVER (ORDER BY length(content), id) - 1) // 500 AS batch FROM clm) GROUP BY 1"))
def l8(spark, sf):
    c = Graph(spark, sf).claims("content").select("id", F.length("content").alias("w"))
    x = with_position(c, [F.col("w").asc(), F.col("id").asc()], "n", start=0)
    return x.groupBy(F.floor(F.col("n") / 500).alias("batch")).agg(F.count("*").alias("n"), F.min("w").alias("shortest"), F.max("w").alias("longest"))


@R.add("b9_prune_decisions", q("allnode nc work", _SPREAD + """
SELECT n.id AS node_id, CASE WHEN n.retired_at IS NOT NULL THEN 'remove: retired' WHEN sp.nid IS NULL THEN 'remove: no claims' WHEN n.node_type NOT IN ('person', 'organisation', 'project', 'event', 'topic', 'place', 'object', 'document') THEN 'keep: curated type'
 WHEN sp.second_source < 3 THEN 'hold: one source' WHEN (n.node_type IN ('place', 'object', 'document') AND (sp.claims < 12 OR sp.sources < 4)) OR sp.claims < 8 OR sp.sources < 3 THEN 'hold: below floor' ELSE 'keep' END AS decision FROM allnode n LEFT JOIN sp ON sp.nid = n.id"""))
def b9(spark, sf):
    g = Graph(spark, sf)
    s = ev.spread_per_node(g.node_claims(), g.works()).withColumnRenamed("nid", "id").withColumn("there", F.lit(True))
    n = g.nodes("node_type", "retired_at", live=False).join(s, "id", "left")
    high = F.col("node_type").isin(*gate.HIGH_BAR_TYPES)
    (pc, ps), (hc, hs) = gate.FLOORS["page-worthy"], gate.FLOORS["high-bar"]
    low = (high & ((F.col("claims") < hc) | (F.col("sources") < hs))) | (F.col("claims") < pc) | (F.col("sources") < ps)
    decision = (
        F.when(F.col("retired_at").isNotNull(), "remove: retired").when(F.col("there").isNull(), "remove: no claims")
        .when(~F.col("node_type").isin(*gate.HIGH_BAR_TYPES, *gate.PAGE_WORTHY_TYPES), "keep: curated type").when(F.col("second_source") < gate.SECOND_SOURCE, "hold: one source").when(low, "hold: below floor").otherwise("keep")
    )
    return n.select(F.col("id").alias("node_id"), decision.alias("decision"))


@R.add("z8_embedding_jobs", q("clm", _PENDING + " SELECT CAST(bucket AS INTEGER) AS bucket, n AS pending, CAST(greatest(round_even(n / 4.9 / 60, 0), 1) AS INTEGER) AS minutes FROM pe"))
def z8(spark, sf):
    g = Graph(spark, sf)
    from ..common import norm_id

    done = g.raw("embedding_model").where("kind = 'claim'").select(norm_id("id").alias("id")).distinct()
    n = g.claims().join(done, "id", "left_anti").groupBy(text.bucket("id").alias("bucket")).agg(F.count("*").alias("pending"))
    return n.withColumn("minutes", F.greatest(F.bround(F.col("pending") / 4.9 / 60).cast("int"), F.lit(1)))


@R.add("f9_band_of_two_scores", """
SELECT claim_id, least(score, base_weight) AS low, greatest(score, base_weight) AS high FROM (SELECT DISTINCT lower(trim(claim_id)) AS claim_id, score, base_weight FROM score_breakdown) WHERE score >= 0.7 AND base_weight >= 0.7 AND NOT isnan(score) AND NOT isnan(base_weight)""")
def f9(spark, sf):
    from ..common import norm_id

    s = table(spark, sf, "score_breakdown").select(norm_id("claim_id").alias("claim_id"), "score", "base_weight").distinct()
    band = (F.least("score", "base_weight") >= 0.7) & ~F.isnan("score") & ~F.isnan("base_weight") & F.col("score").isNotNull() & F.col("base_weight").isNotNull()
    return s.where(band).select("claim_id", F.least("score", "base_weight").alias("low"), F.greatest("score", "base_weight").alias("high"))
