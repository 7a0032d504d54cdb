"""Queries of the general training-data problems (1 and 7)."""

from __future__ import annotations

from ..common import table
from ..operators import incremental, integrity
from .registry import Registry

R = Registry()

_HASH = "nullif(regexp_extract(lower({0}), '([0-9a-f]{{64}})\\s*$', 1), '')"
_ID = "nullif(lower(trim({0}, ' ' || chr(9) || chr(10) || chr(13) || chr(160))), '')"


@R.add(
    "p1_found",
    f"""
WITH runs AS (SELECT run_id, import_generation FROM import_runs WHERE lower(trim(run_status)) = 'succeeded'),
d AS (SELECT k, arg_max(v, (produced_at, arrived_at, v)) AS v FROM (
  SELECT {_HASH.format("record_content_hash")} AS k, {_HASH.format("digest_sha256")} AS v, produced_at, arrived_at FROM digests)
  WHERE k IS NOT NULL AND v IS NOT NULL GROUP BY k),
r AS (SELECT k, v, import_generation FROM (
  SELECT {_HASH.format("record_content_hash")} AS k, {_HASH.format("digest_sha256")} AS v, t.import_generation,
    row_number() OVER (PARTITION BY {_HASH.format("record_content_hash")} ORDER BY run_id DESC, {_HASH.format("digest_sha256")} DESC NULLS LAST, t.import_generation DESC NULLS LAST) AS n
  FROM digest_import_receipts t WHERE run_id IN (SELECT run_id FROM runs)) WHERE n = 1)
SELECT d.k AS record_content_hash FROM d LEFT JOIN r ON d.k = r.k
WHERE r.k IS NULL OR r.v IS DISTINCT FROM d.v OR r.import_generation IS DISTINCT FROM (SELECT arg_max(import_generation, run_id) FROM runs)
""",
)
def p1_found(spark, sf):
    t = lambda n: table(spark, sf, n)
    return incremental.due_records(t("digests"), t("digest_import_receipts"), t("import_runs")).withColumnRenamed("key", "record_content_hash")


_ORPHANS = f"""
WITH rec AS (SELECT {_ID.format("id")} AS k FROM records), nod AS (SELECT {_ID.format("id")} AS k FROM nodes WHERE retired_at IS NULL),
c AS (SELECT {_ID.format("id")} AS k, min(left(trim(created_at), 7)) AS period FROM claims GROUP BY 1)
SELECT DISTINCT * FROM (
SELECT 'claims' AS table_name, left(trim(created_at), 7) AS period, {_ID.format("id")} AS row_key, {_ID.format("record_id")} AS ref_key
FROM claims WHERE {_ID.format("record_id")} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM rec WHERE k = {_ID.format("record_id")})
UNION ALL
SELECT 'claim_node_refs', c.period, {_ID.format("claim_id")}, {_ID.format("node_id")}
FROM claim_node_refs LEFT JOIN c ON c.k = {_ID.format("claim_id")}
WHERE {_ID.format("node_id")} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM nod WHERE nod.k = {_ID.format("node_id")})
UNION ALL
SELECT 'digest_import_receipts', left(trim(imported_at), 7), {_HASH.format("record_content_hash")}, {_ID.format("record_id")}
FROM digest_import_receipts WHERE {_ID.format("record_id")} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM rec WHERE k = {_ID.format("record_id")}))
"""


def _orphans(spark, sf):
    t = lambda n: table(spark, sf, n)
    return integrity.orphan_references(t("claims"), t("claim_node_refs"), t("digest_import_receipts"), t("records"), t("nodes"))


@R.add("p7_found", _ORPHANS)
def p7_found(spark, sf):
    return _orphans(spark, sf)


@R.add("p7_summary", f"SELECT table_name, period, count(*) AS n_rows, count(DISTINCT ref_key) AS n_keys FROM ({_ORPHANS}) GROUP BY ALL")
def p7_summary(spark, sf):
    return integrity.orphan_summary(_orphans(spark, sf))


_AT = "CASE WHEN regexp_matches({0}, '(?i)(Z|UTC|[+-]\\d{{2}}:?\\d{{2}})$') AND length(trim({0})) > 10 THEN CAST(trim({0}) AS TIMESTAMPTZ) WHEN regexp_matches(trim({0}), '^\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN CAST(trim({0}) || CASE WHEN length(trim({0})) = 10 THEN 'T00:00:00Z' ELSE 'Z' END AS TIMESTAMPTZ) END"
_STATES = f"""
WITH o AS ({_ORPHANS}), gn AS (SELECT DISTINCT {_ID.format("id")} AS k FROM nodes WHERE retired_at IS NOT NULL),
mr AS (SELECT {_ID.format("id")} AS k, min({_AT.format("created_at")}) AS made FROM records GROUP BY 1), mn AS (SELECT {_ID.format("id")} AS k, min({_AT.format("created_at")}) AS made FROM nodes WHERE retired_at IS NULL GROUP BY 1),
cl AS (SELECT {_ID.format("id")} AS row_key, {_ID.format("record_id")} AS r, {_AT.format("created_at")} AS ts FROM claims), sd AS (SELECT row_key, min(ts) AS ts FROM cl GROUP BY 1),
lt AS (SELECT DISTINCT 'claims' AS table_name, ts, row_key, r FROM cl JOIN mr ON mr.k = r WHERE made > ts
 UNION SELECT DISTINCT 'digest_import_receipts', ts, row_key, r FROM (SELECT {_HASH.format("record_content_hash")} AS row_key, {_ID.format("record_id")} AS r, {_AT.format("imported_at")} AS ts FROM digest_import_receipts) JOIN mr ON mr.k = r WHERE made > ts
 UNION SELECT DISTINCT 'claim_node_refs', sd.ts, sd.row_key, n FROM (SELECT {_ID.format("claim_id")} AS c, {_ID.format("node_id")} AS n FROM claim_node_refs) JOIN sd ON sd.row_key = c JOIN mn ON mn.k = n WHERE made > sd.ts),
x AS (SELECT table_name, period, CASE WHEN table_name = 'claim_node_refs' AND ref_key IN (SELECT k FROM gn) THEN 'deleted' ELSE 'missing' END AS state FROM o UNION ALL SELECT table_name, period, 'late' FROM (SELECT DISTINCT table_name, strftime(ts AT TIME ZONE 'UTC', '%Y-%m') AS period, row_key, r FROM lt))
SELECT table_name, period, state, count(*) AS n_rows FROM x GROUP BY ALL"""


@R.add("p7_states", _STATES)
def p7_states(spark, sf):
    t = lambda n: table(spark, sf, n)
    return integrity.reference_states(t("claims"), t("claim_node_refs"), t("digest_import_receipts"), t("records"), t("nodes"))
