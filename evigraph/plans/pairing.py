"""Queries over search, pairs and clusters."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..common import table
from ..operators import cluster, pairs, search
from ..operators.graph import Graph
from .registry import Registry
from .sqlbase import ident
from .sqlbase import with_parts as q

R = Registry()

QUERY = "What did the lookout say about the radar return and the flight plan?"
TOKENS = search.query_tokens(QUERY)


def _claims(spark, sf):
    return Graph(spark, sf).claims("content")


def _idf_sql() -> str:
    df = ", ".join(f"count(*) FILTER (lower(content) LIKE '%{t}%') AS t{i}" for i, t in enumerate(TOKENS))
    return f"t AS (SELECT count(*) AS n, {df} FROM clm), w AS (SELECT " + ", ".join(f"ln(1 + n / (1 + t{i})) AS w{i}" for i in range(len(TOKENS))) + " FROM t)"


_TOTAL = "(" + " + ".join(f"w{i}" for i in range(len(TOKENS))) + ")"
_SCORE = " + ".join(f"CASE WHEN lower(content) LIKE '%{t}%' THEN w{i} ELSE 0.0 END" for i, t in enumerate(TOKENS))
_ANY = " OR ".join(f"lower(content) LIKE '%{t}%'" for t in TOKENS)
_KW = f"kw AS (SELECT id, round(({_SCORE}) / {_TOTAL}, 9) AS score FROM clm, w WHERE {_ANY} ORDER BY score DESC, id LIMIT 30)"


@R.add("q1_idf_weights", q("clm", f", {_idf_sql()} SELECT token, weight FROM (" + " UNION ALL ".join(f"SELECT '{t}' AS token, round(w{i}, 9) AS weight FROM w" for i, t in enumerate(TOKENS)) + ")"))
def q1(spark, sf):
    w = search.idf_weights(_claims(spark, sf), TOKENS)
    return spark.createDataFrame(list(zip(TOKENS, [round(x, 9) for x in w], strict=True)), "token string, weight double")


@R.add("q2_keyword_search", q("clm", f", {_idf_sql()}, {_KW} SELECT id, score FROM kw"))
def q2(spark, sf):
    return search.keyword_search(_claims(spark, sf), QUERY)


def _unit_vectors(spark, sf):
    """The driver's embeddings as vectors of documents: id of the same number."""
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding"), F.col("label"))


_PROBE = "p AS (SELECT CAST(embedding AS DOUBLE[]) AS q FROM embeddings WHERE vec_id = (SELECT min(vec_id) FROM embeddings))"


def _probe(spark, sf):
    return [float(x) for x in _unit_vectors(spark, sf).orderBy("id").first()["embedding"]]


@R.add("q3_vector_search", f"WITH {_PROBE} SELECT vec_id AS id, round(1 - list_cosine_similarity(CAST(embedding AS DOUBLE[]), q), 9) AS distance FROM embeddings, p ORDER BY distance, id LIMIT 10")
def q3(spark, sf):
    return search.vector_search(_unit_vectors(spark, sf), _probe(spark, sf))


_DOC_TOKENS = search.query_tokens("radar return over the ridge")


def _doc_sql() -> str:
    toks = _DOC_TOKENS
    df = ", ".join(f"count(*) FILTER (lower(text) LIKE '%{t}%') AS t{i}" for i, t in enumerate(toks))
    score = " + ".join(f"CASE WHEN lower(text) LIKE '%{t}%' THEN w{i} ELSE 0.0 END" for i, t in enumerate(toks))
    total = "(" + " + ".join(f"w{i}" for i in range(len(toks))) + ")"
    hit = " OR ".join(f"lower(text) LIKE '%{t}%'" for t in toks)
    return f"t AS (SELECT count(*) AS n, {df} FROM documents), w AS (SELECT " + ", ".join(f"ln(1 + n / (1 + t{i})) AS w{i}" for i in range(len(toks))) + f" FROM t), kw AS (SELECT doc_id AS id, round(({score}) / {total}, 9) AS score FROM documents, w WHERE {hit} ORDER BY score DESC, id LIMIT 10)"


_FUSED = f"""{_PROBE}, {_doc_sql()},
cos AS (SELECT vec_id AS id, list_cosine_similarity(CAST(embedding AS DOUBLE[]), q) AS c FROM embeddings, p),
sem AS (SELECT id, round(1 - c, 9) AS distance FROM cos ORDER BY distance, id LIMIT 10),
r AS (SELECT id, row_number() OVER (ORDER BY distance, id) AS rank FROM sem UNION ALL SELECT id, row_number() OVER (ORDER BY score DESC, id) FROM kw),
f AS (SELECT id, round(sum(1 / (CAST(60 AS DOUBLE) + rank)), 12) AS rrf FROM r GROUP BY id)"""


@R.add("q4_rank_fusion", f"WITH {_FUSED} SELECT id, rrf FROM f")
def q4(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("content"))
    sem = search.vector_search(_unit_vectors(spark, sf), _probe(spark, sf))
    kw = search.keyword_search(docs, "radar return over the ridge", 10)
    return search.rrf([search.ranked(sem, "id", [F.asc("distance"), F.asc("id")], 10), search.ranked(kw, "id", [F.desc("score"), F.asc("id")], 10)])


@R.add("q5_hybrid_search", f"WITH {_FUSED}, ch AS (SELECT id FROM f ORDER BY rrf DESC, id LIMIT 10) SELECT ch.id, round(1 - (coalesce(cos.c, 0) + 0.25 * coalesce(kw.score, 0)), 9) AS distance FROM ch LEFT JOIN cos ON cos.id = ch.id LEFT JOIN kw ON kw.id = ch.id ORDER BY distance, ch.id LIMIT 10")
def q5(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("content"))
    return search.hybrid_search(docs, _unit_vectors(spark, sf), "radar return over the ridge", _probe(spark, sf))


_SPLIT = r"[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
_RERANKED = f"""WITH {_PROBE}, {_doc_sql().replace("doc_id AS id", "CAST(doc_id AS VARCHAR) AS id").replace("LIMIT 10", "LIMIT 50").replace("FROM documents", "FROM (SELECT * FROM documents WHERE text IS NOT NULL)")},
sem AS (SELECT CAST(vec_id AS VARCHAR) AS id, round(1 - list_cosine_similarity(CAST(embedding AS DOUBLE[]), q), 9) AS distance FROM embeddings, p ORDER BY distance, id LIMIT 50),
r AS (SELECT id, row_number() OVER (ORDER BY distance, id) AS rank FROM sem UNION ALL SELECT id, row_number() OVER (ORDER BY score DESC, id) FROM kw),
ch AS (SELECT id FROM (SELECT id, round(sum(1 / (CAST(60 AS DOUBLE) + rank)), 12) AS rrf FROM r GROUP BY id) ORDER BY rrf DESC, id LIMIT 50),
sc AS (SELECT ch.id, CAST(len(list_filter(regexp_split_to_array(lower(d.text), '{_SPLIT}'), lambda w: w IN ({", ".join(f"'{t}'" for t in _DOC_TOKENS)}))) AS DOUBLE) / (1 + length(d.text) / 500) AS s FROM ch JOIN documents d ON CAST(d.doc_id AS VARCHAR) = ch.id WHERE d.text IS NOT NULL)
SELECT id, round(1 - 1 / (1 + exp(-s)), 9) AS distance FROM sc ORDER BY distance, id LIMIT 10"""


@R.add("q6_reranked_search", _RERANKED)
def q6(spark, sf):
    words = set(_DOC_TOKENS)

    def scorer(pairs_):
        return [float(sum(w in words for w in t.lower().split())) / (1 + len(t) / 500) for _, t in pairs_]

    docs = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("id"), F.col("text").alias("content")).where("content IS NOT NULL")
    vectors = _unit_vectors(spark, sf).withColumn("id", F.col("id").cast("string"))
    return search.hybrid_search(docs, vectors, "radar return over the ridge", _probe(spark, sf), rerank=scorer)


@R.add(
    "a24_retrieval_metrics",
    """
WITH s AS (SELECT a.vec_id AS query, b.vec_id AS id, row_number() OVER (PARTITION BY a.vec_id ORDER BY round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 9) DESC, b.vec_id) AS rank
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id),
rel AS (SELECT a.vec_id AS query, b.vec_id AS id, row_number() OVER (PARTITION BY a.vec_id ORDER BY b.vec_id) AS r FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id),
i AS (SELECT query, sum(1 / log2(r + 1.0)) FILTER (r <= 10) AS best, count(*) AS n FROM rel GROUP BY 1),
g AS (SELECT s.query, sum(1 / log2(s.rank + 1.0)) AS dcg, 1 / min(s.rank) AS mrr, count(*) AS found FROM s JOIN rel USING (query, id) WHERE s.rank <= 10 GROUP BY 1)
SELECT i.query, round(coalesce(dcg / best, 0), 9) AS ndcg, round(coalesce(mrr, 0), 9) AS mrr, round(coalesce(found / n, 0), 9) AS recall FROM i LEFT JOIN g USING (query)
""",
)
def a24(spark, sf):
    v = _unit_vectors(spark, sf).select("id", F.col("label").alias("grp"), "embedding")
    near = pairs.cosine_pairs(v, 10).select(F.col("id").alias("query"), F.col("other").alias("id"), F.col("place").alias("rank"))
    label = v.select("id", "grp")
    rel = label.select(F.col("id").alias("query"), "grp").join(label, "grp").where("query <> id").select("query", "id", F.lit(1.0).alias("gain"))
    return search.retrieval_metrics(near, rel)


_ALL = "s AS (SELECT a.vec_id AS id, b.vec_id AS other, a.label AS la, b.label AS lb, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 9) AS cosine FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id)"


def _labelled(spark, sf):
    return _unit_vectors(spark, sf).select("id", F.col("label").alias("grp"), "embedding")


@R.add("j9_nearest_vectors", f"WITH {_ALL} SELECT id, other, cosine, place FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY cosine DESC, other) AS place FROM s) WHERE place <= 20")
def j9(spark, sf):
    return pairs.cosine_pairs(_labelled(spark, sf), 20)


@R.add("j10_nearest_in_other_groups", f"WITH {_ALL} SELECT id, other, cosine, place FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY cosine DESC, other) AS place FROM s WHERE la <> lb) WHERE place <= 10")
def j10(spark, sf):
    return pairs.cosine_pairs(_labelled(spark, sf), 10, other_group=True)


@R.add("v12_record_pairs", f"""WITH {_ALL}, n AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY cosine DESC, other) AS place FROM s WHERE la <> lb) WHERE place <= 10)
SELECT a, b, hits, claims, place FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY hits DESC, b) AS place FROM (SELECT la AS a, lb AS b, count(*) AS hits, count(DISTINCT id) AS claims FROM n GROUP BY 1, 2)) WHERE place <= 15""")
def v12(spark, sf):
    v = _labelled(spark, sf)
    return pairs.record_pairs(pairs.cosine_pairs(v, 10, other_group=True), v.select("id", "grp"))


#: The cuts of a profile, and two that these vectors reach.
PROFILE_CUTS = (0.95, 0.90, 0.85, 0.83, 0.80, 0.75, 0.70, 0.65, 0.60, 0.55, 0.4, 0.3)


@R.add("v14_similarity_profile", f"""WITH {_ALL}, n AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY cosine DESC, other) AS place FROM s WHERE la <> lb) WHERE place <= 10)
SELECT count(*) AS n, max(cosine) AS max, median(cosine) AS median, min(cosine) AS min, {", ".join(f"count(*) FILTER (cosine >= {c}) AS at_{round(c * 100)}" for c in PROFILE_CUTS)} FROM n""")
def v14(spark, sf):
    return pairs.similarity_profile(pairs.cosine_pairs(_labelled(spark, sf), 10, other_group=True), PROFILE_CUTS)


@R.add("v15_best_cut", f"""WITH {_ALL}, g AS (SELECT round(cosine, 6) AS cut, count(*) FILTER (la = lb) AS p, count(*) FILTER (la <> lb) AS n FROM s WHERE id < other GROUP BY 1),
t AS (SELECT sum(p) AS tp, sum(n) AS tn FROM g), c AS (SELECT cut, sum(p) OVER w AS kept, sum(n) OVER w AS fl FROM g WINDOW w AS (ORDER BY cut DESC))
SELECT cut, CAST(kept AS BIGINT) AS kept, CAST(tp - kept AS BIGINT) AS missed, CAST(fl AS BIGINT) AS false_links, round((kept / tp + 1 - fl / tn) / 2, 9) AS balanced_accuracy FROM c, t ORDER BY 5 DESC, 1 LIMIT 1""")
def v15(spark, sf):
    return pairs.best_cut(pairs.cosine_histogram(_labelled(spark, sf)))


@R.add("z17_centroids", "WITH e AS (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings) SELECT label AS grp, list(x ORDER BY i) AS centroid FROM (SELECT label, i, round(avg(CAST(x AS DOUBLE)), 9) AS x FROM e GROUP BY 1, 2) GROUP BY 1")
def z17(spark, sf):
    return pairs.centroids(_labelled(spark, sf))


_WORDS = "regexp_extract_all(lower(text), '[\\w]+')"
_SHINGLES = """
WITH d AS (SELECT doc_id AS id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}\\p{M}\\p{Pc}]+') AS w FROM documents),
h AS (SELECT DISTINCT id, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT id, count(*) AS n, md5(string_agg(s, '|' ORDER BY s)) AS sig FROM h GROUP BY id),
r AS (SELECT sig, min(id) AS rep FROM n GROUP BY sig)
"""


@R.add("m20_shingle_classes", _SHINGLES + "SELECT n.id, r.rep FROM n JOIN r USING (sig)")
def m20_classes(spark, sf):
    return pairs.overlapping(table(spark, sf, "documents"), key="doc_id")[1]


_CLAIM_SHINGLES = _SHINGLES.replace("SELECT doc_id AS id", "SELECT id").replace("lower(text)", "lower(content)").replace("FROM documents", f"FROM (SELECT DISTINCT {ident('id')} AS id, content FROM claims WHERE {ident('id')} IS NOT NULL)")


@R.add("m20_overlapping_claims", _CLAIM_SHINGLES + """, k AS (SELECT h.* FROM h JOIN r ON r.rep = h.id), c AS (SELECT x.id AS a, y.id AS b, count(*) AS shared FROM k x JOIN k y ON x.s = y.s AND x.id < y.id GROUP BY 1, 2)
SELECT a, b, shared / (p.n + o.n - shared) AS jaccard, shared / least(p.n, o.n) AS containment, shared FROM c JOIN n p ON p.id = a JOIN n o ON o.id = b WHERE shared / (p.n + o.n - shared) >= 0.6 OR shared / least(p.n, o.n) >= 0.9""")
def m20_pairs(spark, sf):
    """Claims: the documents hold copies, which m20_shingle_classes has, and few that are near."""
    return pairs.overlapping(Graph(spark, sf).claims("content"), text="content")[0]


@R.add("m22_works", _SHINGLES.replace("WITH d", "WITH RECURSIVE d") + """, k AS (SELECT h.* FROM h JOIN r ON r.rep = h.id), c AS (SELECT x.id AS a, y.id AS b, count(*) AS shared FROM k x JOIN k y ON x.s = y.s AND x.id < y.id GROUP BY 1, 2),
p AS (SELECT a, b FROM c JOIN n p ON p.id = a JOIN n o ON o.id = b WHERE shared / (p.n + o.n - shared) >= 0.6 OR shared / least(p.n, o.n) >= 0.9),
e AS (SELECT a, b FROM p UNION SELECT b, a FROM p UNION SELECT n.id, r.rep FROM n JOIN r USING (sig) UNION SELECT r.rep, n.id FROM n JOIN r USING (sig)),
t(id, g) AS (SELECT a, b FROM e UNION SELECT e.a, t.g FROM e JOIN t ON t.id = e.b) SELECT id AS doc_id, min(g) AS work_id FROM t GROUP BY id""")
def m22(spark, sf):
    p, m = pairs.overlapping(table(spark, sf, "documents"), key="doc_id")
    e = p.select("a", "b").unionByName(m.select(F.col("id").alias("a"), F.col("rep").alias("b")))
    return cluster.components(e).select(F.col("id").alias("doc_id"), F.col("component").alias("work_id"))


#: Texts of records with what they say of their source, and the pairs that say the same.
CASE_RECORDS = [
    ("a", '---\ntitle: T\nsource_url: "http://x/1"\nsource_id: 7\n---\nbody\nsource_id: 9\n'), ("b", "---\nsource_url: http://x/1\n---\n"), ("c", "---\nsource_url: http://x/1\nsuperseded_by: b\n---\n"), ("d", "source_id: 7\nno front matter"), ("e", "source_id: 9"),
    ("f", "---\nsource_url: http://x/1\nsource_id: 7\n---\n"), ("g", "---\nsource_url:\n---\n"), ("h", None), ("i", "---\nsource_url: http://X/1\n---\n"),
]


@R.add("m21_same_origin_cases", "SELECT * FROM (VALUES ('a', 'b', 'source_url'), ('a', 'f', 'source_url'), ('a', 'd', 'source_id'), ('a', 'f', 'source_id')) t(a, b, field)")
def m21_cases(spark, sf):
    return pairs.same_origin(spark.createDataFrame(CASE_RECORDS, "id string, text string"))


@R.add("m21_records_of_one_work", q("rec", "SELECT a.id AS a, b.id AS b FROM rec a JOIN rec b ON a.work_id = b.work_id AND a.id < b.id"))
def m21(spark, sf):
    r = Graph(spark, sf).records("work_id").where("work_id IS NOT NULL")
    return r.select(F.col("id").alias("a"), "work_id").join(r.select(F.col("id").alias("b"), "work_id"), "work_id").where("a < b").select("a", "b").distinct()


_NAMES = ", k AS (SELECT id, node_type, lower(trim(regexp_replace(regexp_replace(name, '[-_.]+', ' ', 'g'), '\\s+', ' ', 'g'))) AS key FROM node), g AS (SELECT key, count(DISTINCT node_type) AS types FROM k GROUP BY key), e AS (SELECT a.id AS a, b.id AS b, CASE WHEN g.types > 1 THEN 0.9e0 ELSE 0.95e0 END AS score FROM k a JOIN k b ON a.key = b.key AND a.id < b.id JOIN g ON g.key = a.key)"


def _name_edges(spark, sf):
    from ..operators import resolve

    return resolve.name_edges(Graph(spark, sf).nodes("node_type", "name"))


@R.add("e8_name_edges", q("node", _NAMES + " SELECT a, b, score FROM e"))
def e8(spark, sf):
    return _name_edges(spark, sf)


@R.add("e10_merge_clusters", q("node", _NAMES + ", s AS (SELECT a, b FROM e UNION SELECT b, a FROM e UNION SELECT a, a FROM e UNION SELECT b, b FROM e), t(id, c) AS (SELECT a, b FROM s UNION SELECT s.a, t.c FROM s JOIN t ON t.id = s.b), m AS (SELECT id, min(c) AS component FROM t GROUP BY 1), z AS (SELECT component, count(*) AS members FROM m GROUP BY 1), i AS (SELECT m.component, count(*) AS pairs, max(e.score) AS best FROM e JOIN m ON m.id = e.a GROUP BY 1) SELECT component, members, pairs, best FROM z JOIN i USING (component)", recursive=True))
def e10(spark, sf):
    return cluster.clusters(_name_edges(spark, sf))


@R.add("e13_proposals_not_yet_queued", q("node", _NAMES + """, p AS (SELECT DISTINCT least(x, y) AS a, greatest(x, y) AS b FROM (SELECT lower(trim(u)) AS x, ids FROM (SELECT node_ids AS ids, unnest(node_ids) AS u FROM merge_proposals_referenced_sources)) , LATERAL (SELECT lower(trim(v)) AS y FROM (SELECT unnest(ids) AS v)) WHERE x <> y) SELECT e.a, e.b FROM e WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.a = e.a AND p.b = e.b)"""))
def e13(spark, sf):
    from ..common import norm_id

    ids = table(spark, sf, "merge_proposals_referenced_sources").select(F.array_distinct(F.array_compact(F.transform(F.coalesce("node_ids", F.array().cast("array<string>")), norm_id))).alias("i"))
    p = ids.select("i", F.explode("i").alias("x")).select("x", F.explode("i").alias("y")).where("x < y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()
    return _name_edges(spark, sf).select("a", "b").join(p, ["a", "b"], "left_anti")
