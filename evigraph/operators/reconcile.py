"""Reconciling re-imported rows, upserts, set replacement, cascades, merges of nodes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .graph import salience_rank


def reconcile(existing: DataFrame, incoming: DataFrame, by: list[str], order: str, new_order: str) -> DataFrame:
    """(by..., old, new, action): existing and incoming rows of equal keys paired off as multisets.

    The n-th existing row of a key (by `order`, last first) is carried by the n-th incoming one;
    incoming rows left over are inserted, existing ones left over deleted. Rows with a null
    key never pair: they are inserted or deleted.
    """
    w = lambda o: W.partitionBy(*by).orderBy(o)
    old = existing.select(*by, F.col(order).alias("old")).withColumn("_n", F.row_number().over(w(F.desc("old"))))
    new = incoming.select(*by, F.col(new_order).alias("new")).withColumn("_n", F.row_number().over(w(F.asc("new"))))
    x = old.join(new, [*by, "_n"], "full_outer")
    action = F.when(F.col("old").isNull(), "insert").when(F.col("new").isNull(), "delete").otherwise("carry")
    return x.select(*by, "old", "new", action.alias("action"))


def upsert(current: DataFrame, new: DataFrame, key: list[str], keep: str = "new", order: Column | None = None) -> DataFrame:
    """current with new's rows by key. keep 'new' replaces (the last by order), keep 'old' ignores
    rows whose key is there. Null keys are a key of their own."""
    a = current.withColumn("_side", F.lit(0))
    b = new.select(*current.columns).withColumn("_side", F.lit(1))
    first = F.desc("_side") if keep == "new" else F.asc("_side")
    w = W.partitionBy(*key).orderBy(first, *([order] if order is not None else []))
    return a.unionByName(b).withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n", "_side")


def replace_sets(current: DataFrame, new: DataFrame, by: str) -> DataFrame:
    """current with all rows of a `by` that occurs in new replaced by new's rows."""
    return current.join(new.select(by).distinct(), by, "left_anti").unionByName(new.select(*current.columns))


def cascade(gone: DataFrame, key: str, tables: dict[str, tuple[DataFrame, list[str]]]) -> dict[str, DataFrame]:
    """Each table without the rows that refer to a deleted key in any of the named columns."""
    out = {}
    for name, (df, cols) in tables.items():
        for c in cols:
            df = df.join(gone.select(F.col(key).alias(c)).distinct(), c, "left_anti")
        out[name] = df
    return out


def repoint_edges(edges: DataFrame, survivors: DataFrame) -> DataFrame:
    """(claim_id, node_id, salience) with merged nodes replaced; survivors: (node_id, survivor).

    Edges that fall together keep the strongest salience.
    """
    x = edges.join(survivors, "node_id", "left").select("claim_id", F.coalesce("survivor", "node_id").alias("node_id"), "salience")
    return x.groupBy("claim_id", "node_id").agg(F.max_by("salience", salience_rank("salience")).alias("salience"))


def reversal(edges: DataFrame, survivors: DataFrame) -> DataFrame:
    """(claim_id, node_id, salience): the edges a merge changes or absorbs, to undo it by."""
    touched = survivors.select("node_id").union(survivors.select("survivor")).distinct()
    return edges.join(touched, "node_id", "left_semi").select("claim_id", "node_id", "salience")


def undo_merge(merged: DataFrame, undo: DataFrame, survivors: DataFrame) -> DataFrame:
    """The edges before the merge: those of its nodes come from the reversal, others stay."""
    touched = survivors.select("node_id").union(survivors.select("survivor")).distinct()
    return merged.join(touched, "node_id", "left_anti").select("claim_id", "node_id", "salience").unionByName(undo.select("claim_id", "node_id", "salience"))


def state_hash(df: DataFrame, name: str) -> DataFrame:
    """(table_name, n, digest): a hash of a table's rows whatever their order, repeats included.

    Row hashes are added up in four parts, so it is one aggregation with partial sums.
    """
    h = F.sha2(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}), 256)
    parts = [F.sum(F.conv(F.substring(h, 1 + 8 * i, 8), 16, 10).cast("decimal(20,0)")).cast("string").alias(f"s{i}") for i in range(4)]
    x = df.agg(F.count("*").alias("n"), *parts)
    return x.select(F.lit(name).alias("table_name"), "n", F.sha2(F.concat_ws("|", "n", *[F.coalesce(f"s{i}", F.lit("0")) for i in range(4)]), 256).alias("digest"))


def differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """(side, columns...): rows of one table that the other lacks, as multisets."""
    cols = sorted(a.columns)
    x, y = a.select(*cols), b.select(*cols)
    return x.exceptAll(y).select(F.lit("left").alias("side"), *cols).unionByName(y.exceptAll(x).select(F.lit("right").alias("side"), *cols))
