"""Digests, records, sidecars, ledgers and memos on disk as DataFrames."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from . import yamlish

HEADER_BYTES = 16_384

_NODE = "array<struct<id:string,name:string,node_type:string,aliases:array<string>>>"
_CLAIM = "struct<id:string,content:string,claim_type:string,attestation:string,claim_role:string,original_excerpt:string,speaker:string,node_references:array<string>,location_in_record:string,date:string,date_end:string,confidence:double,origin_kind:string,origin:string,origin_ref:string,relay:array<string>>"
DIGEST = f"struct<header:map<string,string>,nodes:{_NODE},domain_claims:array<{_CLAIM}>,infrastructure_claims:array<{_CLAIM}>,error:string>"


def digest_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, sha256, content) of the canonical digests below root: *.yaml outside variants/ and
    hidden folders, and not of a run kind other than production (none stated counts as production)."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.yaml").load(root)
    f = f.where(~F.col("path").rlike(r"/variants/|/\.[^/]+/|/\.[^/]+$"))
    f = f.select("path", F.sha2("content", 256).alias("sha256"), F.decode("content", "UTF-8").alias("content"))
    kind = F.regexp_extract("content", r"(?m)^\s*run_kind:\s*[\"']?([A-Za-z_-]+)", 1)
    return f.where(kind.isin("", "production"))


def _text(v) -> str | None:
    return None if v is None else str(v)


def _claims(rows) -> list[dict]:
    out = []
    for c in rows or []:
        chain = c.get("provenance_chain") or {}
        out.append({**{k: _text(c.get(k)) for k in ("id", "content", "claim_type", "attestation", "claim_role", "original_excerpt", "speaker", "location_in_record", "date", "date_end")},
                    "node_references": [str(x) for x in c.get("node_references") or []], "confidence": None if c.get("confidence") is None else float(c["confidence"]),
                    "origin_kind": _text(chain.get("origin_kind")), "origin": _text(chain.get("origin")), "origin_ref": _text(chain.get("origin_ref")), "relay": [str(x) for x in chain.get("relay") or []]})
    return out


def parse_digest(text: str) -> dict:
    """A digest's header, nodes and claims; a text that can't be read has an error instead."""
    try:
        docs = [d for d in yamlish.load_all(text) if isinstance(d, dict)]
        d = {k: v for x in docs for k, v in x.items()}
        header = d.get("frontmatter") if isinstance(d.get("frontmatter"), dict) else {k: v for k, v in d.items() if not isinstance(v, (dict, list))}
        nodes = [{"id": _text(n.get("id")), "name": _text(n.get("name")), "node_type": _text(n.get("node_type") or n.get("type")), "aliases": [str(a) for a in (n.get("metadata") or {}).get("aliases") or []]} for n in d.get("nodes") or []]
        return {"header": {k: _text(v) for k, v in header.items() if not isinstance(v, (dict, list))}, "nodes": nodes, "domain_claims": _claims(d.get("domain_claims")), "infrastructure_claims": _claims(d.get("infrastructure_claims")), "error": None}
    except Exception as e:  # noqa: BLE001 - a bad file is a row, not a failed job
        return {"header": {}, "nodes": [], "domain_claims": [], "infrastructure_claims": [], "error": f"{type(e).__name__}: {e}"[:300]}


def digests(spark: SparkSession, root: str) -> DataFrame:
    """(path, sha256, header, nodes, domain_claims, infrastructure_claims, error)."""

    @F.pandas_udf(T.StringType())
    def parse(content: pd.Series) -> pd.Series:
        import json

        return content.map(lambda t: json.dumps(parse_digest(t or "")))

    d = digest_files(spark, root).withColumn("d", F.from_json(parse("content"), DIGEST))
    return d.select("path", "sha256", "d.*")


def digest_headers(spark: SparkSession, root: str) -> DataFrame:
    """(path, header): only the lines before the glossary are read as YAML."""

    @F.pandas_udf(T.MapType(T.StringType(), T.StringType()))
    def parse(head: pd.Series) -> pd.Series:
        return head.map(lambda t: parse_digest(t)["header"])

    head = F.split("content", r"(?m)^terminology:", 2)[0]
    return digest_files(spark, root).select("path", parse(head).alias("header"))


def brief_headers(spark: SparkSession, root: str) -> DataFrame:
    """(path, head): a brief's first 16 KiB, up to its related nodes or claims."""
    f = spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.yaml").withColumn("path", F.input_file_name())
    return f.select("path", F.split(F.substring("value", 1, HEADER_BYTES), r"(?m)^(?:related_nodes|claims):", 2)[0].alias("head"))


def claim_bindings(spark: SparkSession, root: str) -> DataFrame:
    """(path, line, claim_id, record_id): which claim a brief's record lines belong to, by lines."""
    f = spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.yaml").withColumn("path", F.input_file_name())
    lines = f.select("path", F.posexplode(F.split("value", "\n")).alias("line", "text"))
    claim = F.regexp_extract("text", r"^\s*-?\s*claim_id:\s*[\"']?([^\"'\s]+)", 1)
    record = F.regexp_extract("text", r"^\s*-?\s*record_id:\s*[\"']?([^\"'\s]+)", 1)
    w = W.partitionBy("path").orderBy("line").rowsBetween(W.unboundedPreceding, 0)
    x = lines.select("path", "line", F.when(claim != "", claim).alias("c"), F.when(record != "", record).alias("record_id"))
    return x.withColumn("claim_id", F.last("c", ignorenulls=True).over(w)).where("record_id IS NOT NULL AND claim_id IS NOT NULL").select("path", "line", "claim_id", "record_id")


def store_records(spark: SparkSession, root: str) -> DataFrame:
    """(content_hash, path, front, body): records {sha256}.md or .v2.md that nothing supersedes;
    of two forms of one hash the newer wins."""
    from ..functions.text import body

    f = spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.md").withColumn("path", F.input_file_name())
    f = f.withColumn("content_hash", F.regexp_extract("path", r"/([0-9a-f]{64})(?:\.v2)?\.md$", 1)).where("content_hash <> ''")
    front = F.regexp_extract("value", r"(?s)\A---\n(.*?)\n---", 1)
    f = f.withColumn("front", front).where(~F.col("front").rlike(r"(?m)^superseded_by:\s*\S"))
    w = W.partitionBy("content_hash").orderBy(F.desc(F.endswith("path", F.lit(".v2.md"))), "path")
    return f.withColumn("n", F.row_number().over(w)).where("n = 1").select("content_hash", "path", "front", body("value").alias("body"))


def front_matter(texts: DataFrame, text: str = "value") -> DataFrame:
    """texts with fields: the scalars of the front matter between the first two --- lines."""

    @F.pandas_udf(T.MapType(T.StringType(), T.StringType()))
    def parse(front: pd.Series) -> pd.Series:
        return front.map(lambda t: parse_digest(t or "")["header"])

    return texts.withColumn("fields", parse(F.regexp_extract(text, r"(?s)\A---\n(.*?)\n---", 1)))


def sidecars(spark: SparkSession, root: str, kind: str, schema: str | None = None) -> DataFrame:
    """*.{kind}.json below root, one row per file, with its path."""
    r = spark.read.option("multiLine", True).option("recursiveFileLookup", "true").option("pathGlobFilter", f"*.{kind}.json")
    return (r.schema(schema) if schema else r).json(root).withColumn("path", F.input_file_name())


def memo(spark: SparkSession, path: str, schema: str, key: list[str]) -> DataFrame:
    """The last whole line of each key of a JSON-lines memo; broken lines are skipped."""
    fields = T.DataType.fromDDL(schema) if schema.startswith("struct") else T.StructType.fromDDL(schema)
    s = T.StructType([*fields.fields, T.StructField("_corrupt_record", T.StringType())])
    lines = spark.read.text(path).withColumn("_n", F.monotonically_increasing_id()).withColumn("j", F.from_json("value", s, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}))
    x = lines.where("j._corrupt_record IS NULL AND j IS NOT NULL").select("j.*", "_n").drop("_corrupt_record")
    return x.groupBy(*key).agg(*[F.max_by(c, "_n").alias(c) for c in fields.names if c not in key])


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """(seq, event): the events of a YAML ledger, documents parted by ---, in their order, as JSON."""
    f = spark.read.text(path, wholetext=True)

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def parse(text: pd.Series) -> pd.Series:
        import json

        return text.map(lambda t: [json.dumps(d, default=str) for d in yamlish.load_all(t)])

    return f.select(F.posexplode(parse("value")).alias("seq", "event"))
