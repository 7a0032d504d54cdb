"""SQL for the clean tables that the queries' SQL starts from."""

from __future__ import annotations

from ..functions import kernel


def ident(c: str) -> str:
    return f"nullif(lower(trim({c}, ' ' || chr(9) || chr(10) || chr(13) || chr(160))), '')"


def hash64(c: str) -> str:
    return f"nullif(regexp_extract(lower({c}), '([0-9a-f]{{64}})\\s*$', 1), '')"


NODE_TYPE = "CASE WHEN lower(trim(node_type)) IN ('organization', 'org', 'organisations', 'organizations') THEN 'organisation' WHEN lower(trim(node_type)) IN ('people', 'persons') THEN 'person' ELSE lower(trim(node_type)) END"

#: Each clean table by name: its text and the tables it needs.
PARTS = {
    "allnode": (f"SELECT DISTINCT {ident('id')} AS id, {NODE_TYPE} AS node_type, name, metadata, created_at, retired_at, seq FROM nodes WHERE {ident('id')} IS NOT NULL", ()),
    "node": ("SELECT * FROM allnode WHERE retired_at IS NULL", ("allnode",)),
    "rec": (f"SELECT DISTINCT {ident('id')} AS id, title, record_date, producer_id, {hash64('content_hash')} AS content_hash, metadata, created_at, {ident('work_id')} AS work_id FROM records WHERE {ident('id')} IS NOT NULL", ()),
    "clm": (f"""SELECT DISTINCT {ident('id')} AS id, content, original_excerpt, claim_type, attestation, {ident('record_id')} AS record_id, {ident('speaker_id')} AS speaker_id, location_in_record, claim_date, date_end,
  confidence, created_at, claim_role, claim_hash, origin_kind, origin, entailment_label, entailment_score, entailment_premise, origin_ref, attribution_in_text, seq FROM claims WHERE {ident('id')} IS NOT NULL""", ()),
    "edge": (f"""SELECT cid AS claim_id, nid AS node_id, CASE max(r) WHEN 4 THEN 'subject' WHEN 3 THEN 'participant' WHEN 2 THEN 'setting' WHEN 1 THEN 'mentioned' END AS salience FROM (
  SELECT {ident('claim_id')} AS cid, {ident('node_id')} AS nid, CASE salience WHEN 'subject' THEN 4 WHEN 'participant' THEN 3 WHEN 'setting' THEN 2 WHEN 'mentioned' THEN 1 ELSE 0 END AS r FROM claim_node_refs)
  WHERE cid IS NOT NULL AND nid IS NOT NULL GROUP BY cid, nid""", ()),
    "nc": ("SELECT speaker_id AS nid, id AS cid, record_id AS rid FROM clm WHERE speaker_id IS NOT NULL UNION SELECT e.node_id, c.id, c.record_id FROM edge e JOIN clm c ON c.id = e.claim_id", ("clm", "edge")),
    "work": ("SELECT id AS rid, min(coalesce(work_id, id)) AS work FROM rec GROUP BY id", ("rec",)),
    "alias": (f"SELECT alias, node_id, min(reported_at) AS first_at FROM (SELECT trim(regexp_replace(alias, '\\s+', ' ', 'g')) AS alias, {ident('node_id')} AS node_id, reported_at FROM canonical_spelling_outvoted) WHERE alias <> '' AND node_id IS NOT NULL GROUP BY alias, node_id", ()),
    "rk": ("""SELECT *, row_number() OVER (ORDER BY record_date IS NULL, coalesce(record_date, ''), coalesce(record_hash, record_id, ''), num IS NULL, coalesce(num, 0), CASE WHEN num IS NULL THEN coalesce(location_in_record, '') ELSE '' END, id) AS pos
  FROM (SELECT c.*, r.record_date, r.record_hash, try_cast(trim(location_in_record) AS DOUBLE) AS num FROM clm c LEFT JOIN (SELECT id, min(record_date) AS record_date, min(content_hash) AS record_hash FROM rec GROUP BY 1) r ON r.id = c.record_id)""", ("clm", "rec")),
    "corr": ("""SELECT DISTINCT least(claim_id, other) AS claim_a, greatest(claim_id, other) AS claim_b, CAST(0.85 AS DOUBLE) AS similarity FROM (
  SELECT c.id AS claim_id, c.record_id AS r, lag(c.id) OVER w AS other, lag(c.record_id) OVER w AS other_r FROM edge e JOIN clm c ON c.id = e.claim_id
  WINDOW w AS (PARTITION BY e.node_id, c.seq // 100000 ORDER BY c.seq, c.id)) WHERE r <> other_r AND claim_id <> other""", ("edge", "clm")),
    "idx0": ("SELECT trim(name) AS name, arg_min(nid, (p, nid)) AS nid FROM (SELECT name, 0 AS p, id AS nid FROM node UNION ALL SELECT alias, 1, node_id FROM alias) WHERE trim(name) <> '' GROUP BY 1", ("node", "alias")),
    "idx1": ("SELECT lower(trim(name)) AS name, arg_min(nid, (p, nid)) AS nid FROM (SELECT name, 0 AS p, id AS nid FROM node UNION ALL SELECT alias, 1, node_id FROM alias) WHERE trim(name) <> '' GROUP BY 1", ("node", "alias")),
    "rooted": ("""SELECT c.*, CASE WHEN origin_kind IS NULL THEN 'unknown' WHEN origin_kind IN ('speaker', 'unattributed') THEN CASE WHEN speaker_id IS NOT NULL THEN 'speaker' ELSE 'record' END
  WHEN origin_kind = 'anonymous' THEN 'anonymous' WHEN i.nid IS NOT NULL THEN 'node' WHEN trim(origin) <> '' THEN origin_kind ELSE 'unknown' END AS root_kind,
  CASE WHEN origin_kind IN ('speaker', 'unattributed') THEN coalesce(speaker_id, record_id) WHEN i.nid IS NOT NULL THEN i.nid ELSE coalesce(CASE WHEN origin_kind IN ('named', 'document') THEN lower(trim(origin)) END, '') END AS root
  FROM clm c LEFT JOIN idx1 i ON origin_kind IN ('named', 'document') AND i.name = lower(trim(origin))""", ("clm", "idx1")),
    "rooted0": ("""SELECT c.*, CASE WHEN origin_kind IS NULL THEN 'unknown' WHEN origin_kind IN ('speaker', 'unattributed') THEN CASE WHEN speaker_id IS NOT NULL THEN 'speaker' ELSE 'record' END
  WHEN origin_kind = 'anonymous' THEN 'anonymous' WHEN i.nid IS NOT NULL THEN 'node' WHEN trim(origin) <> '' THEN origin_kind ELSE 'unknown' END AS root_kind,
  CASE WHEN origin_kind IN ('speaker', 'unattributed') THEN coalesce(speaker_id, record_id) WHEN i.nid IS NOT NULL THEN i.nid ELSE coalesce(CASE WHEN origin_kind IN ('named', 'document') THEN lower(trim(origin)) END, '') END AS root
  FROM clm c LEFT JOIN idx0 i ON origin_kind IN ('named', 'document') AND i.name = trim(origin)""", ("clm", "idx0")),
}


_TRIMMED = r"'^[^\p{L}\p{N}\p{M}_]+|[^\p{L}\p{N}\p{M}_]+$'"


def _words(t: str) -> str:
    return f"list_filter(list_transform(regexp_split_to_array({t}, '[\\s/,]+'), lambda w: regexp_replace(w, {_TRIMMED}, '', 'g')), lambda w: w <> '')"


def _in(words) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


def person_words(source: str, column: str = "name", out: str = "pw") -> str:
    """CTEs that end in `out` (column, w): the words of each different name of a source, as kernel.person_words()."""
    skip = lambda x, words: f"{x}[coalesce(list_position(list_transform({x}, lambda w: w NOT IN {_in(words)}), true), len({x}) + 1):]"
    return f"""{out}_x AS (SELECT {column}, regexp_replace(lower({column}), '\\([^)]*\\)', ' ', 'g') AS x FROM (SELECT DISTINCT {column} FROM {source} WHERE {column} IS NOT NULL)),
{out}_p AS (SELECT {column}, split_part(x, ',', 1) AS f, CASE WHEN position(',' IN x) > 0 THEN substr(x, position(',' IN x) + 1) ELSE '' END AS g FROM {out}_x),
{out}_w AS (SELECT {column}, CASE WHEN len(list_filter(regexp_split_to_array(g, '[\\s.]+'), lambda w: w <> '' AND w NOT IN {_in(kernel.SUFFIXES)})) = 0 THEN {_words('f')} ELSE list_concat({_words('g')}, {_words('f')}) END AS w FROM {out}_p),
{out}_h AS (SELECT {column}, list_reverse({skip('w', kernel.HONORIFICS)}) AS w FROM {out}_w),
{out} AS (SELECT {column}, list_reverse({skip('w', kernel.SUFFIXES)}) AS w FROM {out}_h)"""


def scoped(w: str, name: str) -> str:
    """Whether a person's name has no family name, from its words."""
    return f"({name} SIMILAR TO '\\s*\\[[^\\[\\]]+\\]\\s*' OR CASE WHEN len({w}) > 1 THEN regexp_full_match({w}[-1], '[a-z](\\.[a-z])*') AND NOT regexp_full_match({w}[-1], '[ivx]{{1,4}}') ELSE len({w}) = 0 OR {w}[1] NOT IN {_in(kernel.MONONYMS)} END)"


#: A table of 256 numbers, as a CTE `crc (t)`: of each byte the remainder by the CRC-32 polynomial.
CRC_TABLE = "crc AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384::BIGINT, c >> 1) ELSE c >> 1 END, i::BIGINT)) AS t)"


def crc32(x: str) -> str:
    """The CRC-32 of an ASCII text, beside the CTE crc."""
    return f"xor(list_reduce(list_transform(string_split({x}, ''), lambda c: ord(c)::BIGINT), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]), 4294967295::BIGINT), 4294967295::BIGINT)"


def state_hash(table: str, columns: str, name: str) -> str:
    """(table_name, n, digest) of a table's columns, as reconcile.state_hash()."""
    cols = sorted(columns.split())
    body = " || ',' || ".join(f"'\"{c}\":' || coalesce(to_json({c})::VARCHAR, 'null')" for c in cols)
    sums = ", ".join(f"'|', coalesce(sum(CAST('0x' || substr(h, {1 + 8 * i}, 8) AS BIGINT)), 0)" for i in range(4))
    return f"SELECT '{name}' AS table_name, count(*) AS n, sha256(concat(count(*), {sums})) AS digest FROM (SELECT sha256('{{' || {body} || '}}') AS h FROM (SELECT DISTINCT {', '.join(cols)} FROM {table}))"


def strip_acronym(name: str) -> str:
    """Without a trailing acronym of three or more; two letters are not looked at."""
    return f"rtrim(regexp_replace({name}, '\\s*\\([A-Z0-9][A-Z0-9-]+[A-Z0-9]\\)\\s*$', ''))"


def with_parts(need: str, body: str, recursive: bool = False) -> str:
    """WITH the named clean tables (blank-separated), then the body; body may go on with ', x AS (...)'."""
    order: list[str] = []

    def put(n: str) -> None:
        for x in PARTS[n][1]:
            put(x)
        if n not in order:
            order.append(n)

    for n in need.split():
        put(n)
    ctes = ",\n".join(f"{n} AS ({PARTS[n][0]})" for n in order)
    return f"WITH {'RECURSIVE ' if recursive else ''}{ctes}\n{body}"
