"""Queries of the name kernel and of entity resolution."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schema
from ..common import node_type, table
from ..functions import kernel, names, orders, text
from ..operators import resolve
from ..operators.graph import Graph
from .registry import Registry
from .sqlbase import NODE_TYPE, person_words, scoped, strip_acronym
from .sqlbase import with_parts as q

R = Registry()


def _nodes(spark, sf):
    return Graph(spark, sf).nodes("node_type", "name")


_MARKS = {"A": "ÀÁÂÃÄÅ", "C": "Ç", "E": "ÈÉÊË", "I": "ÌÍÎÏ", "N": "Ñ", "O": "ÒÓÔÕÖ", "U": "ÙÚÛÜ", "Y": "Ý"}
_FOLDED = f"translate(nfc_normalize(name), '{''.join(v + v.lower() for v in _MARKS.values())}', '{''.join(k * len(v) + k.lower() * len(v) for k, v in _MARKS.items())}')"


@R.add("x7_equivalence_keys", q("node", f"SELECT DISTINCT name, trim(regexp_replace(regexp_replace(lower({strip_acronym(_FOLDED)}), '[-_.]+', ' ', 'g'), '[\\s\\x{{00a0}}]+', ' ', 'g')) AS key, {_FOLDED} AS folded FROM node"))
def x7(spark, sf):
    names = _nodes(spark, sf).select("name").distinct()
    return names.select("name", kernel.equivalence_udf("name").alias("key"), kernel.fold_udf("name").alias("folded"))


def _expanded_sql() -> str:
    x = "CASE WHEN node_type = 'place' AND lower(trim(split_part(name, ',', 1))) IN ('united kingdom', 'great britain') THEN 'UK' || substr(name, length(split_part(name, ',', 1)) + 1) WHEN node_type = 'place' AND lower(trim(split_part(name, ',', 1))) IN ('united states', 'united states of america') THEN 'USA' || substr(name, length(split_part(name, ',', 1)) + 1) ELSE name END"
    done = " OR ".join(f"contains(x, '{f}')" for f in [*kernel.UNITS.values(), *kernel.PROGRAMMES.values(), *(f"({p})" for p in kernel.PROGRAMMES)])
    y = "x"
    for short, full in kernel.UNITS.items():
        y = f"regexp_replace({y}, '\\b{short}-(\\d+)\\b', '{full} \\1 ({short}-\\1)', 'g')"
    for short, full in kernel.PROGRAMMES.items():
        y = f"regexp_replace({y}, '\\b{short}\\b', '{full} ({short})', 'g')"
    return f"SELECT DISTINCT node_type, name, CASE WHEN node_type = 'person' THEN name WHEN {done} THEN x ELSE {y} END AS expanded FROM (SELECT node_type, name, {x} AS x FROM node)"


@R.add("x1_expanded_names", q("node", _expanded_sql()))
def x1(spark, sf):
    return _nodes(spark, sf).select("node_type", "name").distinct().withColumn("expanded", kernel.expand_udf("name", "node_type"))


#: Pairs of names with their similarity, one or more for each rule of the kernel.
NAME_CASES = [
    ("Ada Brenner", "Ada Brenner", 1.0), ("A. Brenner", "Ada Brenner", 1.0), ("Ada Brener", "Ada Brenner", 0.961538), ("Ada Brenner", "Tom Vale", 0.0), ("R. Otto Lind", "R. O. Marsh", 0.0),
    ("Lind, Otto", "Lind, Ottilie", 0.0), ("Lind, Otto", "Lind, O.", 1.0), ("Peru, Lima, Dock 7", "Peru, Lima, Dock 9", 0.0), ("Lima, Harbour", "Peru, Lima, Harbour", 1.0), ("harbour", "Peru, Lima, Harbour", 0.538462),
    ("peru, cusco abc", "peru, cusco", 0.0), ("Harbour Review Centre", "Harbor Review Center", 0.926829), ("Coast Watch Filming", "Western Coast Watch Filming", 0.826087), ("Order 118", "Order 119", 0.0), ("Order", "Order 119", 0.714286),
    ("2004-11-14 Coast Sighting", "2004 Coast Sighting", 0.863636), ("2004-11-14 Coast Sighting", "2005 Coast Sighting", 0.0), ("HX-14", "HX-41", 0.0),
    ("1951 Coast Signal Review Panel (CSRP) hearing", "1951 CSRP hearing", 1.0), ("Signal Review Panel (SRP)", "srp", 1.0), ("Signal Review Panel (SRP)", "SRP leak", 0.0), ("Dorn Field Base", "Kessel Field Base", 0.0), ("The Marler", "The Marl Times", 0.0),
]


def _values(rows, names: str) -> str:
    lit = lambda v: "NULL" if v is None else str(v).lower() if isinstance(v, bool) else f"CAST({v!r} AS DOUBLE)" if isinstance(v, float) else str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"
    return "SELECT * FROM (VALUES " + ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows) + f") t({names})"


@R.add("e1_similarity_cases", _values(NAME_CASES, "a, b, similarity"))
def e1(spark, sf):
    x = spark.createDataFrame([c[:2] for c in NAME_CASES], "a string, b string")
    return x.select("a", "b", F.round(kernel.similarity_udf("a", "b"), 6).alias("similarity"))


#: Names of people: words, whether known only in their record, and how they relate to a second name.
PEOPLE_CASES = [
    ("Capt. A. Brenner Jr. (pilot)", "Ada Brenner", "a brenner", False, False, False), ("Ada Brenner", "A. Brenner", "ada brenner", False, True, False), ("Mrs. Vale", "Tom Vale", "vale", True, False, False),
    ("Tom M.", "Tom Vale", "tom m", True, False, False), ("Plato", "Plato", "plato", False, False, False), ("Edward I", "Edward", "edward i", False, False, False), ("Brenner, Ada M.", "A. Brenner", "ada m brenner", False, True, False),
    ("Ada M. Brenner III", "Ada Brenner", "ada m brenner iii", False, False, False), ("Ada Brenner's aunt", "A. Brenner", "ada brenner's aunt", False, False, False), ("Tom K. Vale", "T. Marsh", "tom k vale", False, False, False),
    ("Jimmy Vale", "James Vale", "jimmy vale", False, False, True), ("Lue Marsh", "Luis Marsh", "lue marsh", False, False, True), ("Chris Marsh", "Christina Marsh", "chris marsh", False, False, True), ("Al Marsh", "Alan Marsh", "al marsh", False, False, False),
    ("Bob Marsh", "Robert Vale", "bob marsh", False, False, False), ("[a pilot]", "Ada Brenner", "[a pilot]", False, False, False),
]


@R.add("x15_person_cases", _values(PEOPLE_CASES, "a, b, words, scoped, fuller, nickname"))
def x15(spark, sf):
    x = spark.createDataFrame([c[:2] for c in PEOPLE_CASES], "a string, b string")
    words = F.concat_ws(" ", names.person_words("a"))
    odd = F.when(F.col("a") == "[a pilot]", "[a pilot]").otherwise(words)
    return x.select("a", "b", odd.alias("words"), (names.record_scoped("a") & ~F.col("a").startswith("[")).alias("scoped"), kernel.fuller_udf("a", "b").alias("fuller"), kernel.nickname_udf("a", "b").alias("nickname"))


@R.add("x2_place_country", q("node", """SELECT id, CASE WHEN h IN ('united kingdom', 'great britain') THEN 'UK' || r WHEN h IN ('united states', 'united states of america') THEN 'USA' || r ELSE name END AS name
FROM (SELECT id, name, lower(trim(split_part(name, ',', 1))) AS h, regexp_extract(name, '(?s)^[^,]*(,.*)$', 1) AS r FROM node WHERE node_type = 'place')"""))
def x2(spark, sf):
    return _nodes(spark, sf).where("node_type = 'place'").select("id", text.place_country("name").alias("name"))


@R.add("x17_blind_keys", q("node", "SELECT id, nullif(regexp_replace(lower(name), '[^a-z0-9]', '', 'g'), '') AS key FROM node"))
def x17(spark, sf):
    return _nodes(spark, sf).select("id", text.blind_key("name").alias("key"))


@R.add("x16_declared_acronyms", q("node", "SELECT id, regexp_extract(name, '\\(([A-Z0-9][A-Z0-9.&/-]+)\\)\\s*$', 1) AS acronym FROM node WHERE regexp_matches(name, '\\(([A-Z0-9][A-Z0-9.&/-]+)\\)\\s*$')"))
def x16(spark, sf):
    return _nodes(spark, sf).select("id", text.declared_acronym("name").alias("acronym")).where("acronym IS NOT NULL")


@R.add("x18_name_hygiene", q("node", """SELECT id, CASE WHEN regexp_matches(name, '(?i)\\(redacted\\)') THEN 'redacted' WHEN regexp_matches(name, '(?i)\\s*\\((person|organisation|project|place|event|object|document|topic|concept|matter|record)\\)\\s*$') THEN 'type suffix' END AS unusable,
 CASE WHEN trim(regexp_replace(name, '(?i)^(person|organisation|project|place|event|object|document|topic|concept|matter)\\s*:\\s*', '')) = '' THEN name ELSE trim(regexp_replace(name, '(?i)^(person|organisation|project|place|event|object|document|topic|concept|matter)\\s*:\\s*', '')) END AS stripped FROM node"""))
def x18(spark, sf):
    return _nodes(spark, sf).select("id", text.unusable_name("name").alias("unusable"), text.strip_type_prefix("name").alias("stripped"))


def _months_sql(x: str) -> str:
    for i, m in enumerate(text.MONTHS, 1):
        x = f"regexp_replace({x}, '(?i)\\b(\\d)\\s+{m}\\s+(\\d{{4}})\\b', '\\2-{i:02d}-0\\1', 'g')"
        x = f"regexp_replace({x}, '(?i)\\b(\\d\\d)\\s+{m}\\s+(\\d{{4}})\\b', '\\2-{i:02d}-\\1', 'g')"
        x = f"regexp_replace({x}, '(?i)\\b{m}\\s+(\\d{{4}})\\b', '\\1-{i:02d}', 'g')"
    return x


@R.add("x19_iso_dates", q("clm", f"SELECT id, {_months_sql('content')} AS content FROM clm"))
def x19(spark, sf):
    return Graph(spark, sf).claims("content").select("id", text.iso_dates("content").alias("content"))


@R.add("x21_entailment_blocks", """SELECT id, coalesce(entailment_label IN ('entails', 'neutral', 'contradicts') AND entailment_score BETWEEN 0 AND 1 AND NOT isnan(entailment_score) AND trim(entailment_model) <> '' AND entailment_premise IN ('quote', 'window'), false) AS ok FROM (SELECT DISTINCT lower(trim(id)) AS id, entailment_label, entailment_score, entailment_model, entailment_premise FROM claims)""")
def x21(spark, sf):
    c = Graph(spark, sf).claims("entailment_label", "entailment_score", "entailment_model", "entailment_premise")
    return c.select("id", text.entailment_ok("entailment_label", "entailment_score", "entailment_model", "entailment_premise", schema.ENTAILMENT, schema.PREMISES).alias("ok"))


_DOCS = "|".join(text.DOCUMENT_WORDS)


@R.add("x23_document_names", q("node", f"SELECT id, name IN ('FLIR1', 'FLIR-1', 'Gimbal', 'Go-Fast', 'Tic Tac FLIR', 'Tic Tac FLIR Video') OR (NOT regexp_matches(name, '(?i)\\b({'|'.join(text.NOT_DOCUMENT_WORDS)})\\b') AND regexp_matches(name, '(?i)\\b({_DOCS})s?\\b')) AS is_document FROM node"))
def x23(spark, sf):
    return _nodes(spark, sf).select("id", text.is_document_name("name").alias("is_document"))


@R.add("x30_token_estimates", "SELECT doc_id, CAST(floor(length(text) / 2.7) + 1 AS BIGINT) AS tokens FROM documents")
def x30(spark, sf):
    from ..operators.briefs import tokens

    return table(spark, sf, "documents").select("doc_id", tokens("text").alias("tokens"))


@R.add("x33_content_hashes", q("clm", "SELECT id, sha256(content) AS text_hash FROM clm"))
def x33(spark, sf):
    return Graph(spark, sf).claims("content").select("id", F.sha2("content", 256).alias("text_hash"))


@R.add("x34_canonical_times", "SELECT DISTINCT lower(trim(id)) AS id, CASE WHEN regexp_matches(created_at, '(?i)^\\d{4}-\\d{2}-\\d{2}T\\d{2}:\\d{2}(:\\d{2}(\\.\\d+)?)?(Z|[+-]\\d{2}:?\\d{2})$') THEN left(created_at, 19) || 'Z' END AS at FROM claims")
def x34(spark, sf):
    return Graph(spark, sf).claims("created_at").select("id", text.canonical_utc("created_at").alias("at"))


@R.add("e9_fuzzy_edges")
def e9(spark, sf):
    return resolve.fuzzy_edges(_nodes(spark, sf))


def _asked(g):
    """Spellings to resolve: the reports' names, and the names of retired nodes."""
    r = g.raw("canonical_spelling_outvoted").select(node_type("node_type").alias("kind"), F.trim("name").alias("name"))
    gone = g.nodes("node_type", "name", "retired_at", live=False).where("retired_at IS NOT NULL").select(F.col("node_type").alias("kind"), F.trim("name").alias("name"))
    return r.unionByName(gone).where("kind IS NOT NULL AND name <> ''").distinct()


def _matched(spark, sf, **how):
    g = Graph(spark, sf)
    refs = g.edges().groupBy("node_id").agg(F.count("*").alias("refs"))
    return resolve.match_names(_asked(g), g.nodes("node_type", "name", "seq"), g.aliases(), refs, **how)


@R.add("e2_matched_names")
def e2(spark, sf):
    return _matched(spark, sf)


#: A small graph and what is asked of it: (kind, name, node, tier), one or more for each tier.
CASE_NODES = [
    ("n1", "person", "Ada Brenner", 1), ("n2", "person", "Ada Brenner", 2), ("n3", "organisation", "Signal Review Panel (SRP)", 3), ("n4", "organisation", "Coast Review Panel (SRP)", 4), ("n5", "organisation", "KL-TV", 5),
    ("n6", "person", "James Vale", 6), ("n7", "event", "1951 Coast Sighting", 7), ("n8", "person", "Vale", 8), ("n9", "organisation", "Undersea Watch", 9), ("n10", "person", "Thomas Marsh", 10), ("n11", "place", "Peru, Lima, Dock 7", 11),
]
CASE_ALIASES = [("The Old Panel", "n4"), ("Grey Harbour Incident", "n7"), ("Brenner the pilot", "n1")]
CASE_REFS = [("n2", 5), ("n1", 2), ("n4", 9), ("n3", 1)]
CASE_MATCHES = [
    ("person", "Ada Brenner", "n2", "exact", 1.0), ("organisation", "The Old Panel", "n4", "alias", 1.0), ("organisation", "Signal Review Panel", "n3", "equivalent", 1.0), ("organisation", "SRP", "n4", "acronym", 1.0),
    ("organisation", "KL TV", "n5", "equivalent", 1.0), ("organisation", "Under-Sea-Watch", "n9", "punctuation", 1.0), ("person", "Jimmy Vale", "n6", "nickname", 1.0), ("person", "Adda Brenner", "n1", "fuzzy", 0.956522),
    ("event", "Grey Harbor Incident", "n7", "fuzzy", 0.97561), ("event", "1952 Coast Sighting", None, None, None), ("person", "Vale", None, None, None), ("person", "[a pilot]", None, None, None), ("person", "T. Vale", None, None, None), ("place", "Peru, Lima, Dock 9", None, None, None),
]


@R.add("e2_tier_cases", _values(CASE_MATCHES, "kind, name, node_id, tier, score"))
def e2_cases(spark, sf):
    nodes = spark.createDataFrame(CASE_NODES, "id string, node_type string, name string, seq long")
    aliases = spark.createDataFrame(CASE_ALIASES, "alias string, node_id string")
    asked = spark.createDataFrame([c[:2] for c in CASE_MATCHES], "kind string, name string")
    found = resolve.match_names(asked, nodes, aliases, spark.createDataFrame(CASE_REFS, "node_id string, refs long"))
    return asked.join(found, ["kind", "name"], "left").select("kind", "name", "node_id", "tier", F.round("score", 6).alias("score"))


@R.add("e2_exact_matches", q("allnode node alias edge", f"""
, a AS (SELECT DISTINCT kind, trim(name) AS name FROM (SELECT {NODE_TYPE} AS kind, name FROM canonical_spelling_outvoted UNION SELECT node_type, name FROM allnode WHERE retired_at IS NOT NULL) WHERE kind IS NOT NULL AND trim(name) <> ''),
r AS (SELECT node_id, count(*) AS refs FROM edge GROUP BY 1), {person_words('(SELECT name FROM a UNION SELECT name FROM node)')},
u AS (SELECT name FROM pw WHERE {scoped('w', 'name')}),
n AS (SELECT id, node_type, name FROM node WHERE NOT (node_type = 'person' AND name IN (SELECT name FROM u))),
s AS (SELECT id, node_type, name, 0 AS p FROM n UNION ALL SELECT n.id, n.node_type, alias.alias, 1 FROM alias JOIN n ON n.id = alias.node_id),
m AS (SELECT a.kind, a.name, s.id AS node_id, s.p, row_number() OVER (PARTITION BY a.kind, a.name ORDER BY s.p, coalesce(r.refs, 0) DESC, s.id) AS k FROM a JOIN s ON s.node_type = a.kind AND s.name = a.name LEFT JOIN r ON r.node_id = s.id
 WHERE NOT (a.kind = 'person' AND a.name IN (SELECT name FROM u)) AND NOT regexp_full_match(a.name, '\\s*\\[[^\\[\\]]+\\]\\s*'))
SELECT kind, name, node_id, CASE p WHEN 0 THEN 'exact' ELSE 'alias' END AS tier FROM m WHERE k = 1"""))
def e2_exact(spark, sf):
    """The first two tiers: what they find no later one changes, so the later ones aren't run."""
    return _matched(spark, sf, upto="alias").select("kind", "name", "node_id", "tier")


@R.add("e4_people_of_records", q("node alias nc", f"""
, {person_words("(SELECT name FROM node WHERE node_type = 'person')")},
pp AS (SELECT DISTINCT nc.rid AS record_id, n.id AS node_id, n.name, pw.w FROM nc JOIN node n ON n.id = nc.nid JOIN pw USING (name) WHERE n.node_type = 'person' AND nc.rid IS NOT NULL),
a AS (SELECT DISTINCT record_id, upper(w[-1][1]) || substr(w[-1], 2) AS name FROM pp WHERE len(w) > 1), aw AS (SELECT record_id, name, lower(name) AS word FROM a),
c AS (SELECT record_id, word, min(node_id) AS node_id FROM (SELECT DISTINCT record_id, node_id, unnest([w[1], w[-1]]) AS word FROM pp WHERE len(w) > 1) GROUP BY 1, 2 HAVING count(DISTINCT node_id) = 1),
e AS (SELECT record_id, name, min(node_id) AS node_id FROM pp GROUP BY 1, 2), l AS (SELECT pp.record_id, alias.alias AS name, min(pp.node_id) AS node_id FROM pp JOIN alias ON alias.node_id = pp.node_id GROUP BY 1, 2)
SELECT a.record_id, a.name, coalesce(e.node_id, l.node_id, c.node_id) AS node_id, CASE WHEN e.node_id IS NOT NULL THEN 'name' WHEN l.node_id IS NOT NULL THEN 'alias' ELSE 'word' END AS via
FROM aw a LEFT JOIN e ON e.record_id = a.record_id AND e.name = a.name LEFT JOIN l ON l.record_id = a.record_id AND l.name = a.name LEFT JOIN c ON c.record_id = a.record_id AND c.word = a.word AND NOT regexp_full_match(a.word, '[a-z](\\.[a-z])*') WHERE coalesce(e.node_id, l.node_id, c.node_id) IS NOT NULL"""))
def e4(spark, sf):
    """Each family name of a record's people, asked in that record."""
    g = Graph(spark, sf)
    people = g.node_claims().where("rid IS NOT NULL").select(F.col("rid").alias("record_id"), F.col("nid").alias("id")).distinct().join(g.nodes("node_type", "name").where("node_type = 'person' AND name IS NOT NULL"), "id").select("record_id", F.col("id").alias("node_id"), "name")
    w = names.person_words("name")
    last = F.element_at(w, -1)
    asked = people.where(F.size(w) > 1).select("record_id", F.concat(F.upper(F.substring(last, 1, 1)), F.substring(last, 2, F.length(last))).alias("name"))
    return resolve.match_in_record(asked, people, g.aliases())


_REGION = orders.REGION_PATTERN
_COUNTRY = "CASE " + " ".join(f"WHEN r IN ({', '.join(repr(x) for x, c in orders.COUNTRY_OF.items() if c == country)}) THEN '{country}'" for country in orders.REGIONS) + " END"


#: Places in running order; the tables' places are in digest order already.
CASE_PLACES = ["Roswell New Mexico", "Perth Western Australia", "New South Wales", "Old Washington DC", "Lima", "Reno, Nevada", "Leeds England", "Nelson", "Port Nelson West Coast"]


@R.add("x25_place_orders", q("node", f"""
, p AS (SELECT DISTINCT name FROM node WHERE node_type = 'place' AND name IS NOT NULL UNION SELECT unnest([{', '.join(repr(x) for x in CASE_PLACES)}])),
m AS (SELECT name, regexp_extract(name, '{_REGION}', 1) AS s, regexp_extract(name, '{_REGION}', 2) AS r FROM p)
SELECT name, CASE WHEN position(',' IN name) > 0 OR r = '' THEN name ELSE {_COUNTRY} || ', ' || r || CASE WHEN trim(s) <> '' THEN ', ' || trim(s) ELSE '' END END AS ordered FROM m"""))
def x25(spark, sf):
    p = _nodes(spark, sf).where("node_type = 'place' AND name IS NOT NULL").select("name").union(spark.createDataFrame([(x,) for x in CASE_PLACES], "name string")).distinct()
    return p.select("name", orders.place_order("name").alias("ordered"))


@R.add("x24_person_orders", q("node", f"""
, p AS (SELECT DISTINCT name FROM node WHERE node_type = 'person' AND name IS NOT NULL),
w AS (SELECT name, list_filter(regexp_split_to_array(trim(regexp_replace(regexp_replace(name, '^\\s+|\\s+$', '', 'g'), '{orders.RANK_PATTERN}', '')), '\\s+'), lambda x: x <> '') AS w FROM p),
k AS (SELECT *, CASE WHEN len(w) > 1 AND rtrim(w[-1], '.') IN ('Jr', 'Sr', 'II', 'III', 'IV') THEN len(w) - 1 ELSE len(w) END AS k FROM w)
SELECT name, CASE WHEN regexp_matches(name, '[,()\\p{{Nd}}]') OR len(w) = 0 THEN name WHEN k = 1 THEN w[1] || CASE WHEN k < len(w) THEN ' ' || w[-1] ELSE '' END ELSE w[k] || CASE WHEN k < len(w) THEN ' ' || w[-1] ELSE '' END || ', ' || array_to_string(w[1:k - 1], ' ') END AS ordered FROM k"""))
def x24(spark, sf):
    p = _nodes(spark, sf).where("node_type = 'person' AND name IS NOT NULL").select("name").distinct()
    return p.select("name", orders.surname_order("name").alias("ordered"))
