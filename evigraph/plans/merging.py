"""Queries of merge proposals: clusters, plans, verdicts; relations between records."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..common import norm_id
from ..operators import briefs, ledger, merging, pairs, resolve
from ..operators.graph import Graph
from .pairing import _ALL, _labelled
from .registry import Registry
from .resolving import _values
from .sqlbase import ident
from .sqlbase import with_parts as q

R = Registry()


def _sets(g, *sections):
    return ledger.separate_pairs(g.raw("merge_proposals_referenced_sources").where(F.col("section").isin(*sections)).select(F.transform("node_ids", norm_id).alias("ids")), "ids")


def _counts(g):
    return g.edges().groupBy("node_id").agg(F.count("*").alias("claims"))


_KEYS = ", k AS (SELECT id, node_type, trim(regexp_replace(regexp_replace(lower(name), '[-_.]+', ' ', 'g'), '\\s+', ' ', 'g')) AS key FROM node), g AS (SELECT key, count(DISTINCT node_type) AS types FROM k WHERE key <> '' GROUP BY key), ne AS (SELECT a.id AS a, b.id AS b, CASE WHEN g.types > 1 THEN 0.9e0 ELSE 0.95e0 END AS score FROM k a JOIN k b ON a.key = b.key AND a.id < b.id JOIN g ON g.key = a.key)"
_IDS = f", pi AS (SELECT DISTINCT section, proposal_id, {ident('x')} AS x FROM (SELECT section, proposal_id, unnest(node_ids) AS x FROM merge_proposals_referenced_sources)), sp AS (SELECT DISTINCT a.section, a.x AS a, b.x AS b FROM pi a JOIN pi b ON a.proposal_id = b.proposal_id AND a.section = b.section AND a.x < b.x), cn AS (SELECT node_id, count(*) AS claims FROM edge GROUP BY 1)"
_CARDS = _KEYS + _IDS + """, ke AS (SELECT a, b, score FROM ne WHERE (a, b) NOT IN (SELECT (a, b) FROM sp WHERE section = 'keep_separate')), s AS (SELECT a, b FROM ke UNION SELECT b, a FROM ke UNION SELECT a, a FROM ke UNION SELECT b, b FROM ke),
t(id, c) AS (SELECT a, b FROM s UNION SELECT s.a, t.c FROM s JOIN t ON t.id = s.b), m AS (SELECT id, min(c) AS component FROM t GROUP BY 1),
i AS (SELECT m.component, max(ke.score) AS score FROM ke JOIN m ON m.id = ke.a GROUP BY 1), d AS (SELECT m.component, count(*) AS members, arg_min(n.name, (-coalesce(claims, 0), n.id)) AS suggested_canonical, arg_min(n.node_type, (-coalesce(claims, 0), n.id)) AS node_type FROM m JOIN node n ON n.id = m.id LEFT JOIN cn ON cn.node_id = m.id GROUP BY 1)
SELECT component, members, suggested_canonical, node_type, score, 'name-equivalent' AS reason FROM d JOIN i USING (component)"""


def _clusters(g, fuzzy: bool):
    n, rejected = g.nodes("node_type", "name"), _sets(g, "keep_separate")
    st = merging.standing(n, rejected)
    reps = n.join(st.where("id = rep").select("id"), "id", "left_semi")
    # nodes of one name are tied to the one that stands for them, with the score of equal names
    several = n.groupBy(resolve.plain_key("name").alias("key")).agg((F.countDistinct("node_type") > 1).alias("wide"))
    star = st.where("id <> rep").join(n.withColumn("key", resolve.plain_key("name")), "id").join(several, "key").where("key <> ''").select(F.col("rep").alias("a"), F.col("id").alias("b"), F.when(F.col("wide"), F.lit(0.9)).otherwise(F.lit(0.95)).alias("score"))
    edges = merging.labelled_edges(resolve.name_edges(reps).unionByName(star), resolve.fuzzy_edges(reps) if fuzzy else None)
    return merging.clusters_of(edges, rejected, n, _counts(g))


@R.add("e10_name_clusters_less_rejected", q("node edge", _CARDS, recursive=True))
def e10_names(spark, sf):
    return _clusters(Graph(spark, sf), False)[0]


@R.add("e10_merge_proposals")
def e10(spark, sf):
    """Name and fuzzy edges together; similarity has no SQL, see e1_similarity_cases and the tests."""
    return _clusters(Graph(spark, sf), True)[0]


def _scores(g):
    """The proposals' scores as names-only scores: a stand-in for the memo of a scorer."""
    p = g.raw("merge_proposals_referenced_sources").where("score IS NOT NULL AND NOT isnan(score)").select("score", F.transform("node_ids", norm_id).alias("ids"))
    x = p.select("score", "ids", F.explode("ids").alias("a")).select("score", "a", F.explode("ids").alias("b")).where("a < b")
    return x.groupBy("a", "b").agg(F.max("score").alias("names_only"), F.min("score").alias("with_claims"))


_SCORED = f", sx AS (SELECT a, b, max(score) AS names_only, min(score) AS with_claims FROM (SELECT p.score, {ident('p.x')} AS a, {ident('o.x')} AS b FROM (SELECT rowid_ AS r, score, unnest(node_ids) AS x FROM (SELECT row_number() OVER () AS rowid_, * FROM merge_proposals_referenced_sources)) p JOIN (SELECT rowid_ AS r, unnest(node_ids) AS x FROM (SELECT row_number() OVER () AS rowid_, * FROM merge_proposals_referenced_sources)) o ON p.r = o.r WHERE p.score IS NOT NULL AND NOT isnan(p.score)) WHERE a < b GROUP BY 1, 2)"
_PROFILE = """, pc AS (SELECT nc.nid, c.content, c.claim_hash, c.id, row_number() OVER (PARTITION BY nc.nid ORDER BY length(c.content) DESC, coalesce(c.claim_hash, c.id), c.id) AS p FROM nc JOIN clm c ON c.id = nc.cid),
ln AS (SELECT n.id, length('Name: ' || n.name || chr(10) || 'Type: ' || n.node_type || chr(10) || 'Claims:' || coalesce(string_agg(chr(10) || '- ' || left(pc.content, 200), '' ORDER BY pc.p), chr(10) || '(none recorded)')) AS n FROM node n LEFT JOIN pc ON pc.nid = n.id AND pc.p <= 5 GROUP BY n.id, n.name, n.node_type)"""
_BANDED = _KEYS + _IDS + _SCORED + """, pr AS (SELECT a, b FROM ne UNION SELECT a, b FROM sp WHERE section IN ('confident', 'flagged')),
tv AS (SELECT pr.a, pr.b, sx.names_only, sx.with_claims FROM pr JOIN sx USING (a, b) LEFT JOIN node x ON x.id = pr.a LEFT JOIN node y ON y.id = pr.b WHERE names_only >= 0.9 AND x.node_type IS NOT DISTINCT FROM y.node_type AND (pr.a, pr.b) NOT IN (SELECT (a, b) FROM sp WHERE section = 'keep_separate'))"""


def _shortlist(g):
    n = resolve.name_edges(g.nodes("node_type", "name")).select("a", "b")
    return n.unionByName(_sets(g, "confident", "flagged"))


@R.add("f9_pairs_to_verify", q("node edge", _BANDED + " SELECT a, b, names_only, with_claims FROM tv"))
def f9(spark, sf):
    g = Graph(spark, sf)
    return merging.to_verify(_shortlist(g), _scores(g), _sets(g, "keep_separate"), g.nodes("node_type"))


@R.add("e12_merge_plan", q("node edge nc clm", _BANDED + _PROFILE + """, c AS (SELECT count(*) AS v, coalesce(sum(coalesce(x.n, 0) + coalesce(y.n, 0)), 0) AS chars FROM tv LEFT JOIN ln x ON x.id = tv.a LEFT JOIN ln y ON y.id = tv.b)
SELECT (SELECT count(*) FROM pr) AS shortlist_pairs, (SELECT count(*) FROM pr WHERE (a, b) NOT IN (SELECT (a, b) FROM sx)) AS new_pairs, v AS to_verify, CAST(ceil(v / 20) AS BIGINT) AS verify_calls, CAST(floor(chars / 2.7) AS BIGINT) AS input_tokens, v * 200 AS output_tokens, CAST(ceil(v / 20) * 108000 AS BIGINT) AS cached_context_tokens, round_even(ceil(v / 20) * 0.1, 2) AS usd FROM c"""))
def e12(spark, sf):
    g = Graph(spark, sf)
    texts = briefs.profiles(g.nodes("name", "node_type"), g.node_claims(), g.claims("content", "claim_hash"))
    return merging.plan(_shortlist(g), _scores(g), _sets(g, "keep_separate"), g.nodes("node_type"), texts.select("id", F.length("profile").alias("n")))


@R.add("e13_landed_verdicts", q("node edge", _KEYS + _IDS + _SCORED + """, y AS (SELECT sx.* FROM sx WHERE names_only >= 0.85 AND (a, b) NOT IN (SELECT (a, b) FROM sp WHERE section = 'flagged')),
z AS (SELECT y.*, CASE WHEN coalesce(cb.claims, 0) > coalesce(ca.claims, 0) THEN y.b ELSE y.a END AS s FROM y JOIN node na ON na.id = y.a JOIN node nb ON nb.id = y.b LEFT JOIN cn ca ON ca.node_id = y.a LEFT JOIN cn cb ON cb.node_id = y.b)
SELECT a, b, s AS suggested_survivor, n.name AS suggested_canonical, n.node_type, round_even(least(names_only, with_claims), 3) AS score FROM z JOIN node n ON n.id = z.s"""))
def e13(spark, sf):
    """Scores from 0.85 on as yes-verdicts (a stand-in for a judge), the flagged pairs as the queue."""
    g = Graph(spark, sf)
    v = _scores(g).withColumn("same", F.col("names_only") >= 0.85)
    return merging.land(v, _sets(g, "flagged"), g.nodes("node_type", "name"), _counts(g))


@R.add("l6_record_pairs_to_judge", f"""WITH {_ALL}, n AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY cosine DESC, other) AS place FROM s WHERE la <> lb) WHERE place <= 10),
h AS (SELECT a, b, hits FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY hits DESC, b) AS place FROM (SELECT la AS a, lb AS b, count(*) AS hits FROM n GROUP BY 1, 2)) WHERE place <= 15)
SELECT least(a, b) AS a, greatest(a, b) AS b, CAST(sum(CASE WHEN a < b THEN hits ELSE 0 END) AS BIGINT) AS hits_ab, CAST(sum(CASE WHEN a > b THEN hits ELSE 0 END) AS BIGINT) AS hits_ba FROM h GROUP BY 1, 2""")
def l6(spark, sf):
    v = _labelled(spark, sf)
    hits = pairs.record_pairs(pairs.cosine_pairs(v, 10, other_group=True), v.select("id", "grp"))
    return merging.pairs_to_judge(hits, hits.where(F.lit(False)))


#: Verdicts on record pairs and their confirmations, and what they come to.
CASE_VERDICTS = [("r1", "r2", "same_subject", " dock ", "both say so", 1), ("r4", "r3", "possibly_related", None, None, 1), ("r5", "r6", "unrelated", "", "", 1), ("r7", "r8", "unrelated", None, None, 1), ("r8", "r7", "same_subject", "gull", "later", 2), ("r9", "r9", "same_subject", None, None, 1), ("s1", "s2", "maybe", None, None, 1), ("s3", "s4", "same_subject", None, "x", 5)]
CASE_CONFIRMATIONS = [("r2", "r1", "possibly_related", 2), ("r3", "r4", "unrelated", 2), ("r5", "r6", "same_subject", 2), ("s3", "s4", "unrelated", 4)]
CASE_RELATIONS = [
    ("r1", "r2", "same_subject", "dock", "both say so", "same_subject", "possibly_related", True), ("r3", "r4", "unrelated", None, "failed confirmation: ", "possibly_related", "unrelated", False), ("r5", "r6", "unrelated", None, None, "unrelated", None, None),
    ("r7", "r8", "same_subject", "gull", "later", "same_subject", None, None), ("s3", "s4", "same_subject", None, "x", "same_subject", None, None),
]


@R.add("v13_relation_cases", _values(CASE_RELATIONS, "a, b, verdict, shared_subject, reason, first_verdict, confirm_verdict, confirmed"))
def v13(spark, sf):
    v = spark.createDataFrame(CASE_VERDICTS, "a string, b string, verdict string, shared_subject string, reason string, at int")
    return merging.relations(v, spark.createDataFrame(CASE_CONFIRMATIONS, "a string, b string, verdict string, at int"))[0]


@R.add("g14_claim_lines", q("clm", """SELECT record_id, row_number() OVER (PARTITION BY record_id ORDER BY location_in_record NULLS FIRST, seq, id) AS place, '[' || left(id, 8) || '] (' || coalesce(claim_type, 'None') || ') ' || trim(coalesce(content, '')) AS line FROM clm WHERE record_id IS NOT NULL"""))
def g14(spark, sf):
    return merging.claim_lines(Graph(spark, sf).claims("record_id", "claim_type", "content", "location_in_record", "seq"))
