"""Queries of reconciliation, curation, briefs, freshness and consistency."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..common import norm_hash, norm_id
from ..functions import text
from ..operators import briefs, ledger, reconcile, resolve
from ..operators import evidence as ev
from ..operators import incremental as inc
from ..operators.graph import Graph
from .registry import Registry
from .sqlbase import CRC_TABLE, crc32, hash64, ident, person_words, scoped, state_hash
from .sqlbase import with_parts as q

R = Registry()


def add(name: str, sql: str | None = None):
    def put(f):
        R.add(name, sql)(lambda spark, sf: f(Graph(spark, sf)))
        return f

    return put


# ---- import and reconciliation


@add("m2_reconcile_claims", q("clm", f"""
, old AS (SELECT record_id, claim_hash, seq AS old, row_number() OVER (PARTITION BY record_id, claim_hash ORDER BY seq DESC) AS n FROM clm),
new AS (SELECT record_id, claim_hash, seq AS new, row_number() OVER (PARTITION BY record_id, claim_hash ORDER BY seq) AS n FROM (SELECT {ident('record_id')} AS record_id, claim_hash, seq FROM claims)),
x AS (SELECT coalesce(old.record_id, new.record_id) AS record_id, CASE WHEN old IS NULL THEN 'insert' WHEN new IS NULL THEN 'delete' ELSE 'carry' END AS action FROM old FULL JOIN new ON old.record_id = new.record_id AND old.claim_hash = new.claim_hash AND old.n = new.n)
SELECT action, count(*) AS n, count(DISTINCT record_id) AS records FROM x GROUP BY 1"""))
def m2(g):
    raw = g.raw("claims").select(norm_id("record_id").alias("record_id"), "claim_hash", "seq")
    x = reconcile.reconcile(g.claims("record_id", "claim_hash", "seq"), raw, ["record_id", "claim_hash"], "seq", "seq")
    return x.groupBy("action").agg(F.count("*").alias("n"), F.countDistinct("record_id").alias("records"))


@add("m3_fuller_names", q("node", f"""
, p AS (SELECT DISTINCT name FROM node WHERE node_type = 'person'), {person_words('p')},
k AS (SELECT name, w, w[1][1] AS letter, w[-1] AS family FROM pw WHERE len(w) > 1 AND NOT {scoped('w', 'name')}),
f AS (SELECT o.name, n.name AS fuller FROM k o JOIN k n ON n.family = o.family AND n.letter = o.letter WHERE regexp_full_match(o.w[1], '[a-z](\\.[a-z])*') AND NOT regexp_full_match(n.w[1], '[a-z](\\.[a-z])*')
 AND (len(o.w) = 2 OR (len(o.w) = 3 AND len(list_filter(n.w[2:-2], lambda v: v = o.w[2] OR ((length(v) = 1 OR length(o.w[2]) = 1) AND v[1] = o.w[2][1]))) > 0)) AND NOT regexp_matches(regexp_replace(n.name, '\\([^)]*\\)', ' ', 'g'), '[''’]s\\b') AND NOT regexp_matches(regexp_replace(n.name, '\\([^)]*\\)', ' ', 'g'), '(^|[\\s/,])\\p{{Ll}}'))
SELECT name, count(*) AS candidates, min(fuller) AS fuller FROM f GROUP BY name"""))
def m3(g):
    """Names of people whose given name is an initial, with the names that spell it out."""
    return resolve.fuller_names(g.nodes("node_type", "name").where("node_type = 'person'").select("name").distinct())


@add("m4_upserted_receipts", f"""
SELECT k AS record_content_hash, v AS digest_sha256, import_generation, run_id FROM (SELECT {hash64('record_content_hash')} AS k, {hash64('digest_sha256')} AS v, import_generation, run_id,
 row_number() OVER (PARTITION BY {hash64('record_content_hash')} ORDER BY run_id DESC, {hash64('digest_sha256')} DESC NULLS LAST, import_generation DESC NULLS LAST) AS n FROM digest_import_receipts) WHERE n = 1""")
def m4(g):
    r = g.raw("digest_import_receipts").select(norm_hash("record_content_hash").alias("record_content_hash"), norm_hash("digest_sha256").alias("digest_sha256"), "import_generation", "run_id")
    x = r.groupBy("record_content_hash").agg(F.max_by(F.struct("digest_sha256", "import_generation", "run_id"), F.struct("run_id", "digest_sha256", "import_generation")).alias("s"))
    return x.select("record_content_hash", "s.digest_sha256", "s.import_generation", "s.run_id")


@add("m6_cascade_of_lost_records", q("clm rec edge", """
, gone AS (SELECT id FROM clm WHERE record_id NOT IN (SELECT id FROM rec))
SELECT 'claims' AS table_name, count(*) AS n FROM clm WHERE id NOT IN (SELECT id FROM gone) UNION ALL SELECT 'edges', count(*) FROM edge WHERE claim_id NOT IN (SELECT id FROM gone)"""))
def m6(g):
    c = g.claims("record_id")
    gone = c.where("record_id IS NOT NULL").join(g.records().select(F.col("id").alias("record_id")), "record_id", "left_anti").select("id")
    kept = reconcile.cascade(gone, "id", {"claims": (c.select("id"), ["id"]), "edges": (g.edges(), ["claim_id"])})
    out = [df.agg(F.count("*").alias("n")).select(F.lit(k).alias("table_name"), "n") for k, df in kept.items()]
    return out[0].unionByName(out[1])


def _merges(g):
    p = g.raw("merge_proposals_referenced_sources").where("section = 'confident'")
    ids = F.array_distinct(F.array_compact(F.transform(F.coalesce("node_ids", F.array().cast("array<string>")), norm_id)))
    x = p.select("proposal_id", norm_id("suggested_canonical").alias("s"), ids.alias("ids")).where("size(ids) > 0")
    s = F.when(F.array_contains("ids", F.col("s")), F.col("s")).otherwise(F.array_min("ids"))
    return x.select(s.alias("survivor"), F.explode("ids").alias("victim"), F.col("proposal_id").alias("at")).where("survivor <> victim").distinct()


_MERGES = f"""p AS (SELECT proposal_id AS tm, {ident('suggested_canonical')} AS s, list_filter(list_transform(coalesce(node_ids, []), lambda x: {ident('x')}), lambda x: x IS NOT NULL) AS ids FROM merge_proposals_referenced_sources WHERE section = 'confident'),
m AS (SELECT DISTINCT survivor, victim, tm FROM (SELECT tm, CASE WHEN list_contains(ids, s) THEN s ELSE list_min(ids) END AS survivor, unnest(ids) AS victim FROM p WHERE len(ids) > 0) WHERE survivor <> victim),
mo AS (SELECT *, row_number() OVER (ORDER BY tm, survivor, victim) AS i FROM m), mx AS (SELECT DISTINCT x FROM (SELECT survivor AS x FROM m UNION SELECT victim FROM m)),
fo(i, rt) AS (SELECT CAST(0 AS BIGINT), map_from_entries(list((x, x))) FROM mx UNION ALL
 SELECT mo.i, map_from_entries(list_transform(map_entries(fo.rt), lambda e: (e.key, CASE WHEN e.value = fo.rt[mo.victim] THEN fo.rt[mo.survivor] ELSE e.value END))) FROM fo JOIN mo ON mo.i = fo.i + 1),
mp AS (SELECT e.key AS node_id, e.value AS survivor FROM (SELECT unnest(map_entries(rt)) AS e FROM (SELECT rt FROM fo ORDER BY i DESC LIMIT 1)) WHERE e.key <> e.value)"""


@add("m9_merge_replay", f"WITH RECURSIVE {_MERGES} SELECT node_id, survivor FROM mp")
def m9(g):
    return ledger.merge_map(_merges(g))


@add("m7_edges_after_merges", q("edge", f""", {_MERGES} SELECT e.claim_id, coalesce(mp.survivor, e.node_id) AS node_id, CASE max(CASE salience WHEN 'subject' THEN 4 WHEN 'participant' THEN 3 WHEN 'setting' THEN 2 WHEN 'mentioned' THEN 1 ELSE 0 END) WHEN 4 THEN 'subject' WHEN 3 THEN 'participant' WHEN 2 THEN 'setting' WHEN 1 THEN 'mentioned' END AS salience
FROM edge e LEFT JOIN mp ON mp.node_id = e.node_id GROUP BY 1, 2""", recursive=True))
def m7(g):
    return reconcile.repoint_edges(g.edges(), ledger.merge_map(_merges(g)))


@add("m8_merge_and_undo", q("edge", "SELECT claim_id, node_id, salience FROM edge"))
def m8(g):
    e, m = g.edges(), ledger.merge_map(_merges(g))
    return reconcile.undo_merge(reconcile.repoint_edges(e, m), reconcile.reversal(e, m), m)


@add("m10_edges_kept_apart", q("node", f"""
, k AS (SELECT id, node_type, trim(regexp_replace(regexp_replace(lower(name), '[-_.]+', ' ', 'g'), '\\s+', ' ', 'g')) AS key FROM node), e AS (SELECT a.id AS a, b.id AS b FROM k a JOIN k b ON a.key = b.key AND a.id < b.id AND a.key <> ''),
s AS (SELECT proposal_id, {ident('x')} AS x FROM (SELECT proposal_id, unnest(node_ids) AS x FROM merge_proposals_referenced_sources WHERE section = 'keep_separate')), sp AS (SELECT DISTINCT p.x AS a, o.x AS b FROM s p JOIN s o ON p.proposal_id = o.proposal_id AND p.x < o.x)
SELECT a, b FROM e WHERE (a, b) NOT IN (SELECT (a, b) FROM sp)"""))
def m10(g):
    p = g.raw("merge_proposals_referenced_sources").where("section = 'keep_separate'").select(F.transform("node_ids", norm_id).alias("ids"))
    return resolve.name_edges(g.nodes("node_type", "name")).select("a", "b").join(ledger.separate_pairs(p, "ids"), ["a", "b"], "left_anti")


@add("m11_renames", f"""
WITH r AS (SELECT {ident('node_id')} AS node_id, trim(regexp_replace(name, '\\s+', ' ', 'g')) AS name, reported_at FROM canonical_spelling_outvoted WHERE trim(name) <> '' AND {ident('node_id')} IS NOT NULL),
l AS (SELECT node_id, arg_max(name, (reported_at, name)) AS name, count(*) AS n, max(reported_at) AS at FROM r GROUP BY 1)
SELECT l.node_id, l.name, l.n, (SELECT count(DISTINCT r.name) > 1 FROM r WHERE r.node_id = l.node_id AND r.reported_at = l.at) AS conflict FROM l""")
def m11(g):
    r = g.raw("canonical_spelling_outvoted").select(norm_id("node_id").alias("node_id"), F.trim(F.regexp_replace("name", r"\s+", " ")).alias("name"), "reported_at").where("name <> '' AND node_id IS NOT NULL")
    return ledger.latest(r, ["node_id"], ["reported_at", "name"], "name")


def _event_ledger(g):
    e = g.raw("events").select("event_id", "user_id", "event_type", "ts")
    w = W.partitionBy("user_id").orderBy("ts", "event_id")
    before, kind = F.lag("event_id").over(w), F.lag("event_type").over(w)
    return e.withColumn("compensates", F.when((F.col("event_type") == "error") & (kind != "error"), before)).where("event_type <> 'error' OR compensates IS NOT NULL").select(F.col("event_id").alias("id"), "user_id", "event_type", F.col("ts").alias("at"), "compensates")


@add("m16_active_events", """
WITH e AS (SELECT *, lag(event_id) OVER w AS b, lag(event_type) OVER w AS k FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)), c AS (SELECT b FROM e WHERE event_type = 'error' AND k <> 'error')
SELECT user_id, event_type, count(*) AS n FROM e WHERE event_type <> 'error' AND event_id NOT IN (SELECT b FROM c) GROUP BY 1, 2""")
def m16(g):
    return ledger.active(_event_ledger(g))[0].groupBy("user_id", "event_type").agg(F.count("*").alias("n"))


@add("m17_tips", f"""
WITH d AS (SELECT DISTINCT {hash64('record_content_hash')} AS k, {hash64('digest_sha256')} AS v, produced_at FROM digests WHERE digest_sha256 IS NOT NULL)
SELECT k, v, produced_at FROM (SELECT *, lead(produced_at) OVER (PARTITION BY k ORDER BY produced_at, v) AS nx FROM d) WHERE nx IS NULL""")
def m17(g):
    d = g.raw("digests").select(norm_hash("record_content_hash").alias("k"), norm_hash("digest_sha256").alias("v"), "produced_at").where("v IS NOT NULL").distinct()
    key = F.struct("produced_at", "v")
    chain = d.withColumns({"id": F.struct("k", "produced_at", "v"), "supersedes": F.lag(F.struct("k", "produced_at", "v")).over(W.partitionBy("k").orderBy(key))})
    return ledger.tips(chain).select("k", "v", "produced_at")


@add("m19_state_hashes", q("clm edge allnode", state_hash("clm", "id content record_id claim_hash", "claims") + " UNION ALL " + state_hash("edge", "claim_id node_id salience", "edges") + " UNION ALL " + state_hash("allnode", "id node_type name", "nodes")))
def m19(g):
    out = [reconcile.state_hash(df, n) for n, df in (("claims", g.claims("content", "record_id", "claim_hash")), ("edges", g.edges()), ("nodes", g.nodes("node_type", "name", live=False)))]
    return out[0].unionByName(out[1]).unionByName(out[2])


@add("m19_table_differences", q("clm", f"""
, a AS (SELECT id FROM clm), b AS (SELECT {ident('claim_id')} AS id FROM score_breakdown)
SELECT 'left' AS side, id FROM (SELECT id FROM a EXCEPT ALL SELECT id FROM b) UNION ALL SELECT 'right', id FROM (SELECT id FROM b EXCEPT ALL SELECT id FROM a)"""))
def m19d(g):
    return reconcile.differences(g.claims(), g.raw("score_breakdown").select(norm_id("claim_id").alias("id")))


@add("m23_stale_embeddings", q("clm node", f"""
, t AS (SELECT 'claim' AS kind, id, sha256(content) AS h FROM clm UNION ALL SELECT 'node', id, sha256(name) FROM node), m AS (SELECT DISTINCT kind, {ident('id')} AS id, model_id, {hash64('text_hash')} AS h FROM embedding_model)
SELECT m.kind, model_id, CASE WHEN t.id IS NULL THEN 'forgotten' WHEN t.h <> m.h THEN 'stale' ELSE 'fresh' END AS state, count(*) AS n FROM m LEFT JOIN t ON t.kind = m.kind AND t.id = m.id GROUP BY ALL"""))
def m23(g):
    t = g.claims("content").select(F.lit("claim").alias("kind"), "id", F.sha2("content", 256).alias("now")).unionByName(g.nodes("name").select(F.lit("node").alias("kind"), "id", F.sha2("name", 256).alias("now")))
    m = g.raw("embedding_model").select("kind", norm_id("id").alias("id"), "model_id", norm_hash("text_hash").alias("h")).distinct()
    state = F.when(F.col("now").isNull(), "forgotten").when(F.col("now") != F.col("h"), "stale").otherwise("fresh")
    return m.join(t, ["kind", "id"], "left").groupBy("kind", "model_id", state.alias("state")).agg(F.count("*").alias("n"))


_PENDING = f", {CRC_TABLE}, pe AS (SELECT {crc32('id')} % 32 AS bucket, count(*) AS n FROM (SELECT DISTINCT id FROM clm WHERE id NOT IN (SELECT {ident('id')} FROM embedding_model WHERE kind = 'claim' AND {ident('id')} IS NOT NULL)), crc GROUP BY 1)"


@add("m24_pending_by_bucket", q("clm", _PENDING + " SELECT CAST(bucket AS INTEGER) AS bucket, n FROM pe"))
def m24(g):
    done = g.raw("embedding_model").where("kind = 'claim'").select(norm_id("id").alias("id")).distinct()
    return g.claims().join(done, "id", "left_anti").groupBy(text.bucket("id").alias("bucket")).agg(F.count("*").alias("n"))


@add("m25_backfilled_hashes", q("clm", "SELECT id, coalesce(claim_hash, sha256(concat_ws('|', content, claim_type, coalesce(record_id, '')))) AS claim_hash FROM clm"))
def m25(g):
    c = g.claims("content", "claim_type", "record_id", "claim_hash")
    return c.select("id", F.coalesce("claim_hash", F.sha2(F.concat_ws("|", "content", "claim_type", F.coalesce("record_id", F.lit(""))), 256)).alias("claim_hash"))


@add("s17_embedding_cache_misses", f"""
WITH m AS (SELECT DISTINCT {hash64('text_hash')} AS h, model_id FROM embedding_model), c AS (SELECT DISTINCT {hash64('text_hash')} AS h, model_id FROM text_embeddings WHERE embedding IS NOT NULL)
SELECT h AS text_hash, model_id FROM m WHERE (h, model_id) NOT IN (SELECT (h, model_id) FROM c)""")
def s17(g):
    key = [norm_hash("text_hash").alias("text_hash"), F.col("model_id")]
    held = g.raw("text_embeddings").where("embedding IS NOT NULL").select(*key).distinct()
    return g.raw("embedding_model").select(*key).distinct().join(held, ["text_hash", "model_id"], "left_anti")


# ---- briefs


CAP, BUDGET = 40, 1800


def _select_sql(cap: int, budget: int) -> str:
    return _SELECT_SQL.replace("$CAP", str(cap)).replace("$BUDGET", str(budget))


_SELECT_SQL = """
, cw AS (SELECT c.id AS cid, coalesce(w.work, c.record_id) AS work FROM clm c LEFT JOIN work w ON w.rid = c.record_id), sz AS (SELECT work, count(DISTINCT cid) AS n FROM cw WHERE work IS NOT NULL GROUP BY 1),
x AS (SELECT nc.nid, coalesce(cw.work, '') AS src, c.id, c.pos, CASE WHEN n.node_type = 'event' THEN 5 END AS lim, CASE c.attestation WHEN 'first_hand' THEN 3 WHEN 'second_hand' THEN 2 WHEN 'third_hand' THEN 1 ELSE 0 END + CASE WHEN c.speaker_id = nc.nid THEN 10 ELSE 0 END + CASE WHEN k.id IS NOT NULL THEN 100 ELSE 0 END AS imp,
 floor(length(coalesce(c.content, '') || coalesce(c.original_excerpt, '')) / 2.7) + 21 AS cost
 FROM nc JOIN rk c ON c.id = nc.cid JOIN cw ON cw.cid = nc.cid JOIN node n ON n.id = nc.nid LEFT JOIN (SELECT claim_a AS id FROM corr UNION SELECT claim_b FROM corr) k ON k.id = c.id),
s AS (SELECT x.nid, src, lim, count(*) AS size, min(pos) AS first, count(*) / any_value(sz.n) AS focus, count(*) >= 5 AS big FROM x LEFT JOIN sz ON sz.work = x.src GROUP BY 1, 2, 3),
s1 AS (SELECT *, bool_or(big) OVER (PARTITION BY nid) AND NOT big AS late FROM s), s2 AS (SELECT *, row_number() OVER (PARTITION BY nid ORDER BY late, coalesce(focus, 0) DESC, size DESC, first) AS lead FROM s1),
s3 AS (SELECT *, row_number() OVER (PARTITION BY nid ORDER BY lead > 1, late, CASE WHEN late THEN -coalesce(focus, 0) ELSE 0 END, size DESC, first) AS pl FROM s2), kept AS (SELECT * FROM s3 WHERE lim IS NULL OR pl <= lim),
y AS (SELECT x.*, kept.first, (SELECT sum(size) FROM s WHERE s.nid = x.nid) AS alln, row_number() OVER (PARTITION BY x.nid, x.src ORDER BY imp DESC, x.pos) AS t FROM x JOIN kept ON kept.nid = x.nid AND kept.src = x.src),
z AS (SELECT *, row_number() OVER w AS turn, sum(cost) OVER (PARTITION BY nid ORDER BY t, first ROWS UNBOUNDED PRECEDING) AS spent FROM y WINDOW w AS (PARTITION BY nid ORDER BY t, first)),
sel AS (SELECT nid, src, id, pos, turn FROM z WHERE turn <= $CAP AND ((alln <= $CAP AND lim IS NULL) OR spent <= $BUDGET))
"""
_SELECT = _select_sql(CAP, BUDGET)


def _selected(g, cap: int = CAP, budget: int = BUDGET):
    """What the briefs of live nodes take. No review of belonging is among the tables: no claim is suspect."""
    hit = g.corroborations().select(F.explode(F.array("claim_a", "claim_b")).alias("id")).distinct().withColumn("hit", F.lit(True))
    works = g.works()
    c = g.reading_claims("content", "original_excerpt", "attestation", "speaker_id").join(hit, "id", "left").join(works.withColumnRenamed("rid", "record_id"), "record_id", "left")
    c = c.select("id", F.coalesce("work", "record_id").alias("source"), briefs.reading_key().alias("key"), briefs.claim_cost().alias("cost"), "hit", "speaker_id", "attestation")
    nc = g.node_claims()
    kinds = g.nodes("node_type").withColumnRenamed("id", "node")
    x = nc.select(F.col("nid").alias("node"), F.col("cid").alias("id")).join(c, "id").join(kinds, "node")
    x = x.withColumn("importance", briefs.importance(F.lit(False), F.col("hit"), F.col("speaker_id") == F.col("node")))
    limit = ev.lookup("node_type", briefs.MAX_SOURCES, None)
    focus = ev.source_focus(nc, g.claims("record_id"), works).withColumnsRenamed({"nid": "node", "work": "source"})
    return briefs.spread_selection(x.select("node", "node_type", "source", "id", "key", "importance", "cost"), cap, budget, limit.cast("int"), focus)


@add("b2_spread_selection", q("nc clm corr node work rk", _SELECT + "SELECT nid, nullif(src, '') AS work, id, turn FROM sel"))
def b2(g):
    return _selected(g).select(F.col("node").alias("nid"), F.col("source").alias("work"), "id", "turn")


_BRIEF = _SELECT + ", b AS (SELECT n.id AS node_id, n.node_type, n.name, count(*) AS claims, count(DISTINCT nullif(src, '')) AS works, list(sel.id ORDER BY pos) AS claim_ids FROM node n JOIN sel ON sel.nid = n.id GROUP BY 1, 2, 3) "


@add("b1_briefs", q("nc clm corr node work rk", _BRIEF + "SELECT node_id, node_type, name, claims, works, claim_ids FROM b"))
def b1(g):
    s = _selected(g).select("node", "source", "id").join(g.reading_claims(), "id").withColumn("key", briefs.reading_key())
    b = s.groupBy(F.col("node").alias("id")).agg(F.count("*").alias("claims"), F.countDistinct("source").alias("works"), F.array_sort(F.collect_list(F.struct("key"))).alias("c"))
    return g.nodes("node_type", "name").join(b, "id").select(F.col("id").alias("node_id"), "node_type", "name", "claims", "works", F.transform("c", lambda r: r["key"]["id"]).alias("claim_ids"))


_JSON = "'{\"node_type\":' || to_json(node_type) || ',\"name\":' || to_json(name) || ',\"claim_ids\":' || to_json(claim_ids) || '}'"


@add("b6_brief_hashes", q("nc clm corr node work rk", _BRIEF + f"SELECT node_id, sha256({_JSON}) AS brief_hash FROM b"))
def b6(g):
    return b1(g).select("node_id", briefs.payload_hash("node_type", "name", "claim_ids").alias("brief_hash"))


@add("w12_order_changes", q("rk", """
, o AS (SELECT id, record_id, row_number() OVER (PARTITION BY record_id ORDER BY seq, id) AS old, row_number() OVER (PARTITION BY record_id ORDER BY pos) AS new FROM rk WHERE record_id IS NOT NULL)
SELECT record_id, count(*) AS claims, count(*) FILTER (old <> new) AS moved FROM o GROUP BY 1"""))
def w12(g):
    c = g.reading_claims("seq").where("record_id IS NOT NULL").withColumn("key", briefs.reading_key())
    w = W.partitionBy("record_id")
    x = c.withColumns({"old": F.row_number().over(w.orderBy("seq", "id")), "new": F.row_number().over(w.orderBy("key"))})
    return x.groupBy("record_id").agg(F.count("*").alias("claims"), F.sum((F.col("old") != F.col("new")).cast("int")).alias("moved"))


@add("v18_page_drift", q("clm edge", f"""
, f AS (SELECT DISTINCT {ident('id')} AS id, {hash64('text_hash')} AS h FROM embedding_model WHERE kind = 'claim'), x AS (SELECT e.node_id, f.h AS frozen, sha256(c.content) AS now FROM edge e LEFT JOIN clm c ON c.id = e.claim_id LEFT JOIN f ON f.id = e.claim_id)
SELECT node_id, count(*) FILTER (frozen = now) AS same, count(*) FILTER (frozen <> now) AS changed, count(*) FILTER (frozen IS NULL AND now IS NOT NULL) AS added, count(*) FILTER (now IS NULL AND frozen IS NOT NULL) AS removed FROM x GROUP BY 1"""))
def v18(g):
    f = g.raw("embedding_model").where("kind = 'claim'").select(norm_id("id").alias("claim_id"), norm_hash("text_hash").alias("frozen")).distinct()
    x = g.edges().join(g.claims("content").select(F.col("id").alias("claim_id"), F.sha2("content", 256).alias("now")), "claim_id", "left").join(f, "claim_id", "left")
    n = lambda c, name: F.sum(F.when(c, 1).otherwise(0)).alias(name)
    return x.groupBy("node_id").agg(n(F.col("frozen") == F.col("now"), "same"), n(F.col("frozen") != F.col("now"), "changed"), n(F.col("frozen").isNull() & F.col("now").isNotNull(), "added"), n(F.col("now").isNull() & F.col("frozen").isNotNull(), "removed"))


# ---- freshness and consistency


_STATE = f"""
WITH runs AS (SELECT run_id, import_generation FROM import_runs WHERE run_status = 'succeeded'),
d AS (SELECT k, arg_max(v, (produced_at, arrived_at, v)) AS v FROM (SELECT {hash64('record_content_hash')} AS k, {hash64('digest_sha256')} AS v, produced_at, arrived_at FROM digests) WHERE k IS NOT NULL AND v IS NOT NULL GROUP BY k),
r AS (SELECT k, v, g FROM (SELECT {hash64('record_content_hash')} AS k, {hash64('digest_sha256')} AS v, import_generation AS g, row_number() OVER (PARTITION BY {hash64('record_content_hash')} ORDER BY run_id DESC, {hash64('digest_sha256')} DESC NULLS LAST, import_generation DESC NULLS LAST) AS n FROM digest_import_receipts WHERE run_id IN (SELECT run_id FROM runs)) WHERE n = 1),
c AS (SELECT arg_max(import_generation, run_id) AS g FROM runs)
"""


@add("z2_import_jobs", _STATE + """SELECT key, list_filter([CASE WHEN r.k IS NULL THEN 'never imported' END, CASE WHEN r.v <> d.v THEN 'digest changed' END, CASE WHEN r.k IS NOT NULL AND r.g IS NULL THEN 'no generation' END, CASE WHEN r.g <> c.g THEN 'older generation' END], lambda x: x IS NOT NULL) AS reasons
FROM (SELECT d.k AS key, d.v, d.k FROM d) d LEFT JOIN r ON r.k = d.k, c WHERE r.k IS NULL OR r.v IS DISTINCT FROM d.v OR r.g IS DISTINCT FROM c.g""")
def z2(g):
    d, r = inc.digests_in_force(g.raw("digests")), inc.imported_state(g.raw("digest_import_receipts"), g.raw("import_runs"))
    now = g.raw("import_runs").where("run_status = 'succeeded'").agg(F.max_by("import_generation", "run_id").alias("g")).first()["g"]
    x = d.join(r.select("key", F.col("digest").alias("was"), "generation", F.lit(True).alias("there")), "key", "left")
    reasons = F.array_compact(F.array(F.when(F.col("there").isNull(), "never imported"), F.when(F.col("was") != F.col("digest"), "digest changed"), F.when(F.col("there") & F.col("generation").isNull(), "no generation"), F.when(F.col("generation") != now, "older generation")))
    due = F.col("there").isNull() | ~F.col("was").eqNullSafe(F.col("digest")) | ~F.col("generation").eqNullSafe(F.lit(now))
    return x.where(due).select("key", reasons.alias("reasons"))


@add("a20_reason_groups", f"""
SELECT {hash64('record_content_hash')} AS k, coalesce(list_sort(list(DISTINCT extraction_config) FILTER (extraction_config IS NOT NULL)), []) AS configs, max(CASE run_status WHEN 'succeeded' THEN 3 WHEN 'failed' THEN 2 WHEN 'aborted' THEN 1 ELSE 0 END) AS best FROM digest_import_receipts JOIN import_runs USING (run_id) GROUP BY 1""")
def a20(g):
    rank = ev.lookup("run_status", {"succeeded": 3, "failed": 2, "aborted": 1}, 0)
    runs = g.raw("import_runs").select("run_id", rank.alias("r"))
    x = g.raw("digest_import_receipts").select(norm_hash("record_content_hash").alias("k"), "extraction_config", "run_id").join(runs, "run_id")
    return x.groupBy("k").agg(F.sort_array(F.collect_set("extraction_config")).alias("configs"), F.max("r").alias("best"))


@add("z5_review_queue", q("nc rec", """
, x AS (SELECT DISTINCT rid, nid FROM nc WHERE rid IS NOT NULL), d AS (SELECT a.rid, round_even(1 + ln(1 + count(DISTINCT b.rid)), 3) AS demand FROM x a JOIN x b ON a.nid = b.nid AND a.rid <> b.rid GROUP BY 1)
SELECT r.id, d.demand, row_number() OVER (ORDER BY d.demand DESC NULLS LAST, r.id) AS place FROM (SELECT DISTINCT id FROM rec) r LEFT JOIN d ON d.rid = r.id"""))
def z5(g):
    from ..common import with_position

    d = ev.record_reach(g.node_claims()).select(F.col("rid").alias("id"), "demand")
    x = g.records().join(d, "id", "left")
    return with_position(x, [F.col("demand").desc_nulls_last(), F.col("id").asc()], "place").select("id", "demand", "place")


@add("z9_generation_freshness", f"""
SELECT extraction_generation, count(DISTINCT {hash64('record_content_hash')}) AS records, max(produced_at) AS newest FROM digests GROUP BY 1""")
def z9(g):
    return g.raw("digests").select("extraction_generation", norm_hash("record_content_hash").alias("k"), "produced_at").groupBy("extraction_generation").agg(F.countDistinct("k").alias("records"), F.max("produced_at").alias("newest"))


@add("z11_duplicate_bindings", f"""
SELECT h AS content_hash, len(rs) AS n, sha256(array_to_string(rs, ',')) AS fingerprint FROM (SELECT {hash64('record_content_hash')} AS h, list_sort(list(DISTINCT {ident('record_id')})) AS rs FROM digest_import_receipts WHERE {ident('record_id')} IS NOT NULL AND {hash64('record_content_hash')} IS NOT NULL GROUP BY 1) WHERE len(rs) > 1""")
def z11(g):
    """Contents that receipts bind to several records, with a fingerprint of these."""
    x = g.raw("digest_import_receipts").select(norm_id("record_id").alias("r"), norm_hash("record_content_hash").alias("content_hash")).where("r IS NOT NULL AND content_hash IS NOT NULL").distinct()
    y = x.groupBy("content_hash").agg(F.sort_array(F.collect_list("r")).alias("rs")).where("size(rs) > 1")
    return y.select("content_hash", F.size("rs").alias("n"), F.sha2(F.array_join("rs", ","), 256).alias("fingerprint"))


@add("z12_consistency", q("allnode node rec clm edge", """
SELECT 'claims on lost records' AS what, count(*) AS n FROM clm WHERE record_id NOT IN (SELECT id FROM rec)
UNION ALL SELECT 'edges on retired nodes', count(*) FROM edge WHERE node_id IN (SELECT id FROM allnode WHERE retired_at IS NOT NULL)
UNION ALL SELECT 'claims without edges', count(*) FROM clm WHERE id NOT IN (SELECT claim_id FROM edge)
UNION ALL SELECT 'names of several live nodes', count(*) FROM (SELECT node_type, name FROM node GROUP BY 1, 2 HAVING count(*) > 1)
UNION ALL SELECT 'claims later than their end', count(*) FROM clm WHERE claim_date > date_end
UNION ALL SELECT 'records created after their claims', count(*) FROM (SELECT DISTINCT c.id FROM clm c JOIN rec r ON r.id = c.record_id WHERE left(replace(r.created_at, ' ', 'T'), 19) > left(replace(c.created_at, ' ', 'T'), 19))"""))
def z12(g):
    from ..common import parse_utc

    c, e = g.claims("record_id", "claim_date", "date_end", "created_at"), g.edges()
    retired = g.nodes("retired_at", live=False).where("retired_at IS NOT NULL").select(F.col("id").alias("node_id"))
    at = lambda x: F.date_trunc("second", parse_utc(x))
    late = c.select("id", "record_id", at("created_at").alias("c_at")).join(g.records("created_at").select(F.col("id").alias("record_id"), at("created_at").alias("r_at")), "record_id").where("r_at > c_at").select("id").distinct()
    checks = {
        "claims on lost records": c.where("record_id IS NOT NULL").join(g.records().select(F.col("id").alias("record_id")), "record_id", "left_anti"),
        "edges on retired nodes": e.join(retired, "node_id", "left_semi"),
        "claims without edges": c.join(e.select(F.col("claim_id").alias("id")), "id", "left_anti"),
        "names of several live nodes": g.nodes("node_type", "name").groupBy("node_type", "name").count().where("count > 1"),
        "claims later than their end": c.where("claim_date > date_end"),
        "records created after their claims": late,
    }
    out = [df.agg(F.count("*").alias("n")).select(F.lit(k).alias("what"), "n") for k, df in checks.items()]
    x = out[0]
    for y in out[1:]:
        x = x.unionByName(y)
    return x


@add("a22_declaring_records", q("nc", ", x AS (SELECT DISTINCT rid, nid FROM nc WHERE rid IS NOT NULL), s AS (SELECT rid, count(*) AS declared FROM x GROUP BY 1) SELECT x.nid, x.rid, s.declared FROM x JOIN s USING (rid)"))
def a22(g):
    x = g.node_claims().where("rid IS NOT NULL").select("nid", "rid").distinct()
    return x.join(x.groupBy("rid").agg(F.count("*").alias("declared")), "rid").select("nid", "rid", "declared")


@add("z14_context_census", q("clm", """
SELECT coalesce(origin_kind, 'no chain') AS origin_kind, count(*) AS claims, count(origin_ref) AS with_reference, count(*) FILTER (attribution_in_text) AS attributed, count(*) FILTER (attribution_in_text IS NULL) AS undeclared FROM clm GROUP BY 1"""))
def z14(g):
    c = g.claims("origin_kind", "origin_ref", "attribution_in_text")
    n = lambda x: F.sum(F.when(x, 1).otherwise(0))
    return c.groupBy(F.coalesce("origin_kind", F.lit("no chain")).alias("origin_kind")).agg(F.count("*").alias("claims"), F.count("origin_ref").alias("with_reference"), n(F.col("attribution_in_text")).alias("attributed"), n(F.col("attribution_in_text").isNull()).alias("undeclared"))


@add("r1_daily_events", "SELECT date_trunc('day', ts) AS day, event_type, count(*) AS n, round(sum(value), 6) AS total FROM events GROUP BY 1, 2")
def r1(g):
    return g.raw("events").groupBy(F.date_trunc("day", "ts").alias("day"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 6).alias("total"))


@add("r2_pricing_summary", """SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2""")
def r2(g):
    x = g.raw("lineitem").where(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp"))
    return x.groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 4).alias("revenue"), F.count("*").alias("n"))


