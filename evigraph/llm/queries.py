"""Queries of the training-data problems tagged llm, with their SQL."""

from __future__ import annotations

from ..common import table
from ..plans.registry import Registry
from . import bpe, components, leakage, names, neighbours, ranking, survivors, truncation

R = Registry()

_ID = "nullif(lower(trim({0}, ' ' || chr(9) || chr(10) || chr(13) || chr(160))), '')"


def _poly(x: str, coefs) -> str:
    out = f"CAST({coefs[0]!r} AS DOUBLE)"
    for c in coefs[1:]:
        out = f"({out} * {x} + CAST({c!r} AS DOUBLE))"
    return out


def _probit_sql(p: str) -> str:
    q = f"sqrt(-2.0 * ln(least({p}, CAST(1.0 AS DOUBLE) - {p})))"
    tail = f"{_poly(q, ranking.C)} / ({_poly(q, ranking.D)} * {q} + 1.0)"
    m = f"({p} - CAST(0.5 AS DOUBLE))"
    r = f"({m} * {m})"
    middle = f"{_poly(r, ranking.A)} * {m} / ({_poly(r, ranking.B)} * {r} + 1.0)"
    return f"CASE WHEN {p} < 0.02425 THEN {tail} WHEN {p} > 1 - 0.02425 THEN -({tail}) ELSE {middle} END"


@R.add("p2_found")
def p2_found(spark, sf):
    return names.same_entity_pairs(names.name_groups(table(spark, sf, "nodes")))


@R.add("p2_groups")
def p2_groups(spark, sf):
    return names.name_groups(table(spark, sf, "nodes"))


_P3_NAMES = ("corroboration_bonus", "base_weight", "confidence")


def _p3_sql() -> str:
    ctes = [
        f"""c AS (SELECT {_ID.format("id")} AS claim_id, max(CASE WHEN NOT isnan(confidence) THEN confidence END) AS confidence FROM claims GROUP BY 1),
s AS (SELECT k AS claim_id, max(CASE WHEN NOT isnan(corroboration_bonus) THEN corroboration_bonus END) AS corroboration_bonus,
  max(CASE WHEN NOT isnan(base_weight) THEN base_weight END) AS base_weight
  FROM (SELECT {_ID.format("claim_id")} AS k, * FROM score_breakdown) WHERE k IS NOT NULL GROUP BY 1),
j AS (SELECT s.*, c.confidence FROM s LEFT JOIN c USING (claim_id))"""
    ]
    for n in _P3_NAMES:
        ctes.append(
            f"""p_{n} AS (SELECT claim_id, (rank() OVER (ORDER BY {n}) - 1 + count(*) OVER (PARTITION BY {n}) / CAST(2 AS DOUBLE)) / CAST(count(*) OVER () AS DOUBLE) AS p
  FROM j WHERE {n} IS NOT NULL),
z_{n} AS (SELECT claim_id, {_probit_sql("p")} AS z FROM p_{n})"""
        )
    zs = [f"z_{n}.z" for n in _P3_NAMES]
    total = " + ".join(f"coalesce({z}, 0)" for z in zs)
    weight = " + ".join(f"(CASE WHEN {z} IS NULL THEN 0.0 ELSE 1.0 END)" for z in zs)
    joins = " ".join(f"LEFT JOIN z_{n} ON z_{n}.claim_id = j.claim_id" for n in _P3_NAMES)
    ctes.append(
        f"f AS (SELECT j.claim_id, round(({total}) / nullif(CAST({weight} AS DOUBLE), 0), 9) AS fused, "
        + ", ".join(f"round({z}, 9) AS z_{n}" for z, n in zip(zs, _P3_NAMES, strict=True))
        + f" FROM j {joins})"
    )
    return "WITH " + ",\n".join(ctes) + "\nSELECT claim_id, row_number() OVER (ORDER BY fused DESC NULLS LAST, claim_id) AS evidence_rank, fused, z_corroboration_bonus, z_base_weight, z_confidence FROM f"


@R.add("p3_evidence_ranking", _p3_sql())
def p3_evidence_ranking(spark, sf):
    return ranking.evidence_ranking(table(spark, sf, "score_breakdown"), table(spark, sf, "claims"))


def _spelling_sql(c: str) -> str:
    return f"nullif(trim(regexp_replace({c}, '[\\s\\x{{00a0}}]+', ' ', 'g')), '')"


_P4 = f"""
WITH r AS (SELECT {_ID.format("node_id")} AS node_id, nullif(trim(node_type), '') AS node_type, {_spelling_sql("name")} AS name, name_uses,
  {_spelling_sql("alias")} AS alias, alias_uses, reported_at FROM canonical_spelling_outvoted WHERE {_ID.format("node_id")} IS NOT NULL),
u AS (SELECT node_id, name AS v, name_uses AS uses, reported_at FROM r WHERE name IS NOT NULL
  UNION ALL SELECT node_id, alias, alias_uses, reported_at FROM r WHERE alias IS NOT NULL),
l AS (SELECT node_id, v, uses FROM (SELECT *, row_number() OVER (PARTITION BY node_id, v ORDER BY uses IS NULL, reported_at DESC NULLS LAST, uses DESC) AS n FROM u) WHERE n = 1),
b AS (SELECT node_id, v FROM (SELECT *, row_number() OVER (PARTITION BY node_id ORDER BY uses DESC NULLS LAST, v) AS n FROM l) WHERE n = 1),
t AS (SELECT node_id, node_type FROM (SELECT *, row_number() OVER (PARTITION BY node_id ORDER BY reported_at DESC NULLS LAST, node_type) AS n FROM r WHERE node_type IS NOT NULL) WHERE n = 1)
SELECT x.node_id, t.node_type, b.v AS name FROM (SELECT DISTINCT node_id FROM r) x LEFT JOIN b USING (node_id) LEFT JOIN t USING (node_id)
"""


@R.add("p4_found", _P4)
def p4_found(spark, sf):
    return survivors.survivors(table(spark, sf, "canonical_spelling_outvoted")).select("node_id", "node_type", "name")


@R.add("p4_survivors")
def p4_survivors(spark, sf):
    return survivors.survivors(table(spark, sf, "canonical_spelling_outvoted"))


@R.add("p4_source_quality")
def p4_source_quality(spark, sf):
    return survivors.spelling_truth(table(spark, sf, "canonical_spelling_outvoted"))[1]


def _similar(spark, sf):
    return neighbours.similar_ids(table(spark, sf, "embedding_model"), table(spark, sf, "text_embeddings"))


@R.add("p5_found")
def p5_found(spark, sf):
    return neighbours.similar_pairs(_similar(spark, sf))


@R.add("p5_similar")
def p5_similar(spark, sf):
    return _similar(spark, sf)


@R.add(
    "p6_found",
    f"""
WITH RECURSIVE i AS (SELECT row_number() OVER () AS r, list_append(coalesce(node_ids, []), suggested_canonical) AS ids
  FROM merge_proposals_referenced_sources WHERE lower(trim(section)) IN ('confident', 'flagged')),
m AS (SELECT DISTINCT r, {_ID.format("x")} AS id FROM (SELECT r, unnest(ids) AS x FROM i) WHERE {_ID.format("x")} IS NOT NULL),
e AS (SELECT DISTINCT a.id AS a, b.id AS b FROM m a JOIN m b USING (r)),
c(id, g) AS (SELECT a, b FROM e UNION SELECT e.a, c.g FROM e JOIN c ON c.id = e.b)
SELECT id AS node_id, min(g) AS group_id FROM c GROUP BY id
""",
)
def p6_found(spark, sf):
    return components.proposal_groups(table(spark, sf, "merge_proposals_referenced_sources"))


@R.add("p8_ids")
def p8_ids(spark, sf):
    return bpe.encode_corpus(table(spark, sf, "documents"))


def _windows_sql(table: str, key: str) -> str:
    return f"SELECT DISTINCT {key}, array_to_string(w[i:i + {leakage.WORDS - 1}], ' ') AS s FROM (SELECT {key}, w, unnest(range(1, len(w) - {leakage.WORDS - 2})) AS i FROM (SELECT {key}, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS w FROM {table} WHERE text IS NOT NULL) WHERE len(w) >= {leakage.WORDS})"


@R.add("p9_found", f"WITH d AS ({_windows_sql('documents', 'doc_id')}), i AS ({_windows_sql('eval_items', 'item_id')}) SELECT DISTINCT doc_id, item_id FROM d JOIN i USING (s)")
def p9_found(spark, sf):
    return leakage.leaked_items(table(spark, sf, "documents"), table(spark, sf, "eval_items")).select("doc_id", "item_id")


@R.add("p9_near")
def p9_near(spark, sf):
    return leakage.leaked_items(table(spark, sf, "documents"), table(spark, sf, "eval_items"), span=leakage.SPAN)


@R.add("p10_found")
def p10_found(spark, sf):
    return truncation.truncated(table(spark, sf, "documents")).where("cut").select("doc_id")


@R.add("p10_by_source")
def p10_by_source(spark, sf):
    return truncation.truncation_by_source(truncation.truncated(table(spark, sf, "documents")))
