"""The graph's enumerations, weights and constraints, and a check of rows against them."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The model's enumerations and published weights.
NODE_TYPES = ("person", "organisation", "project", "event", "topic", "place", "object", "document")
ATTESTATION_WEIGHT = {"first_hand": 1.0, "second_hand": 0.6, "third_hand": 0.3}
CLAIM_TYPE_WEIGHT = {"measurement": 0.9, "testimony": 0.8, "observation": 0.75, "administrative": 0.7, "hearsay": 0.4, "opinion": 0.3}
CLAIM_ROLES = ("official_explanation", "witness_testimony", "investigation_finding", "cover_up_evidence")
ORIGIN_KINDS = ("speaker", "unattributed", "anonymous", "named", "document")
SALIENCE = ("mentioned", "setting", "participant", "subject")  # ascending
ENTAILMENT = ("entails", "neutral", "contradicts")
PREMISES = ("quote", "window")
TIER_CUTS = (("strong", 0.85), ("moderate", 0.65), ("weak", 0.40))


@dataclass(frozen=True)
class Spec:
    """What a table must hold: a key, allowed values, references (column, table, column)."""

    key: tuple[str, ...] = ()
    allowed: dict[str, tuple] = field(default_factory=dict)
    references: tuple[tuple[str, str, str], ...] = ()


SPECS = {
    "nodes": Spec(("id",), {"node_type": NODE_TYPES}),
    "records": Spec(("id",)),
    "claims": Spec(("id",), {"claim_type": tuple(CLAIM_TYPE_WEIGHT), "attestation": tuple(ATTESTATION_WEIGHT), "claim_role": CLAIM_ROLES, "origin_kind": ORIGIN_KINDS, "entailment_label": ENTAILMENT}, (("record_id", "records", "id"), ("speaker_id", "nodes", "id"))),
    "edges": Spec(("claim_id", "node_id"), {"salience": SALIENCE}, (("claim_id", "claims", "id"), ("node_id", "nodes", "id"))),
}


def violations(tables: dict[str, DataFrame], specs: dict[str, Spec] = SPECS) -> DataFrame:
    """(table_name, rule, column_name, n): how many rows break each rule that any row breaks.

    Null breaks no rule but that of the key. References are checked by distinct values.
    """
    out = []
    for name, spec in specs.items():
        df = tables[name]
        row = lambda d, rule, c: d.select(F.lit(name).alias("table_name"), F.lit(rule).alias("rule"), F.lit(c).alias("column_name"), F.col("n").cast("bigint").alias("n"))  # noqa: B023,E731
        if spec.key:
            twice = df.groupBy(*spec.key).count().where("count > 1").agg(F.count("*").alias("n"))
            out.append(row(twice, "unique", ",".join(spec.key)))
        for c, values in spec.allowed.items():
            bad = df.where(F.col(c).isNotNull() & ~F.col(c).isin(*values)).agg(F.count("*").alias("n"))
            out.append(row(bad, "allowed", c))
        for c, other, k in spec.references:
            counts = df.where(F.col(c).isNotNull()).groupBy(F.col(c).alias("k")).agg(F.count("*").alias("m"))
            lost = counts.join(tables[other].select(F.col(k).alias("k")), "k", "left_anti").agg(F.coalesce(F.sum("m"), F.lit(0)).alias("n"))
            out.append(row(lost, "reference", c))
    return reduce(DataFrame.unionByName, out).where("n > 0")


#: Columns that tables of an older form lack, with their types, and what fills a new column at once.
ADDED = {
    "nodes": {"retired_at": "string", "metadata": "string"}, "records": {"work_id": "string", "friendly_name": "string", "producer_id": "string", "metadata": "string"},
    "claims": {"claim_role": "string", "claim_hash": "string", "origin_kind": "string", "origin": "string", "origin_ref": "string", "relay": "array<string>", "entailment_label": "string", "entailment_score": "double", "entailment_model": "string", "entailment_premise": "string", "attribution_in_text": "boolean"},
    "edges": {"salience": "string"},
}


def upgraded(df: DataFrame, table: str) -> DataFrame:
    """A table of an older form with the columns it lacks, null: not assessed, never a value.
    A record without a work is a work of its own; a claim without a confidence has 1.0."""
    out = df.withColumns({c: F.lit(None).cast(t) for c, t in ADDED.get(table, {}).items() if c not in df.columns})
    if table == "records":
        out = out.withColumn("work_id", F.coalesce("work_id", "id"))
    if table == "claims":
        out = out.withColumn("confidence", F.coalesce("confidence", F.lit(1.0)) if "confidence" in df.columns else F.lit(1.0))
    return out
