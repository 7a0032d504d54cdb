"""References to records that do not exist, by as-of matching with runs of parent keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..common import norm_hash, norm_id, parse_utc, salted_semi, utc_month

#: Integer codes in one block; no run crosses a block, so that a window holds at most one block.
INT_BLOCK_BITS = 16
#: Bits of a hashed code below its block number: 60 - 44 leaves 65,536 blocks.
HASH_BLOCK_BITS = 44


def coded(df: DataFrame, key: str) -> DataFrame:
    """df with (space, block, code): the key as an integer.

    A canonical decimal integer is its own code (space i). Any other key gets the first 60
    bits of its MD5 (space h).
    """
    as_int = F.col(key).rlike("^(0|[1-9][0-9]{0,17})$")
    code = F.when(as_int, F.col(key).try_cast("bigint")).otherwise(F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("bigint"))
    return (
        df.withColumn("code", code)
        .withColumn("space", F.when(as_int, "i").otherwise("h"))
        .withColumn("block", F.when(as_int, F.shiftright("code", INT_BLOCK_BITS)).otherwise(F.shiftright("code", HASH_BLOCK_BITS)))
    )


def key_runs(parents: DataFrame) -> DataFrame:
    """(target, space, block, run_start, run_end, ids): maximal runs of consecutive codes.

    parents: (target, key), distinct. ids holds the keys of a run of hashed codes, which is
    almost always one; a run of integers needs none.
    """
    w = W.partitionBy("target", "space", "block").orderBy("code")
    return (
        coded(parents, "key")
        .withColumn("gap", F.when(F.col("code") - F.lag("code").over(w) <= 1, 0).otherwise(1))
        .withColumn("run", F.sum("gap").over(w))
        .groupBy("target", "space", "block", "run")
        .agg(F.min("code").alias("run_start"), F.max("code").alias("run_end"), F.collect_set(F.when(F.col("space") == "h", F.col("key"))).alias("ids"))
        .drop("run")
    )


def missing_keys(parents: DataFrame, refs: DataFrame) -> DataFrame:
    """(target, key): distinct reference keys that no parent has.

    parents and refs: (target, key), any number of rows, null keys left out. Each reference
    takes the run that starts at or before it in its block; beyond that run's end it is
    missing. A hashed code inside a run is checked against the run's ids, so that two keys of
    one code are told apart. Without parents every reference is missing.
    """
    runs = key_runs(parents.where(F.col("key").isNotNull()).distinct())
    asked = coded(refs.where(F.col("key").isNotNull()).distinct(), "key")
    both = runs.select("target", "space", "block", F.col("run_start").alias("code"), F.lit(0).alias("kind"), F.struct("run_end", "ids").alias("run"), F.lit(None).cast("string").alias("key")).unionByName(
        asked.select("target", "space", "block", "code", F.lit(1).alias("kind"), F.lit(None).cast(runs.select(F.struct("run_end", "ids")).schema[0].dataType).alias("run"), "key")
    )
    w = W.partitionBy("target", "space", "block").orderBy("code", "kind").rowsBetween(W.unboundedPreceding, 0)
    held = F.col("run").isNotNull() & (F.col("code") <= F.col("run.run_end")) & ((F.col("space") == "i") | F.array_contains("run.ids", F.col("key")))
    return both.withColumn("run", F.last("run", ignorenulls=True).over(w)).where((F.col("kind") == 1) & ~F.coalesce(held, F.lit(False))).select("target", "key")


def orphan_references(claims: DataFrame, claim_node_refs: DataFrame, receipts: DataFrame, records: DataFrame, nodes: DataFrame) -> DataFrame:
    """(table_name, period, row_key, ref_key): references to no record or live node, distinct.

    Null and blank references are none. A node with retired_at set doesn't count as there;
    one that has a live row does. period is null where the row's time can't be read or, for
    claim_node_refs, the claim isn't there. Reference keys are made distinct before they are
    matched, and rows are joined back with a salt, so a key may hold any share of the rows.
    """
    parents = records.select(F.lit("records").alias("target"), norm_id("id").alias("key")).unionByName(
        nodes.where(F.col("retired_at").isNull()).select(F.lit("nodes").alias("target"), norm_id("id").alias("key"))
    )

    def rows(df: DataFrame, name: str, target: str, row_key: Column, ref: str, at: Column) -> DataFrame:
        out = df.select(F.lit(name).alias("table_name"), F.lit(target).alias("target"), row_key.alias("row_key"), norm_id(ref).alias("key"), at.alias("at"))
        return out.where(F.col("key").isNotNull())

    no_time = F.lit(None).cast("string")
    of_claims = rows(claims, "claims", "records", norm_id("id"), "record_id", F.col("created_at"))
    of_refs = rows(claim_node_refs, "claim_node_refs", "nodes", norm_id("claim_id"), "node_id", no_time)
    of_receipts = rows(receipts, "digest_import_receipts", "records", norm_hash("record_content_hash"), "record_id", F.col("imported_at"))
    every = of_claims.unionByName(of_refs).unionByName(of_receipts)
    missing = missing_keys(parents, every.select("target", "key"))
    found = salted_semi(every, missing, ["target", "key"], F.col("row_key")).drop("target")
    timed = found.where(F.col("table_name") != "claim_node_refs").select("table_name", utc_month("at").alias("period"), "row_key", F.col("key").alias("ref_key"))
    untimed = found.where(F.col("table_name") == "claim_node_refs").select("table_name", "row_key", F.col("key").alias("ref_key")).distinct()
    when = claims.select(norm_id("id").alias("row_key"), utc_month("created_at").alias("period")).groupBy("row_key").agg(F.min("period").alias("period"))
    via = untimed.join(when, "row_key", "left").select("table_name", "period", "row_key", "ref_key")
    return timed.unionByName(via).distinct()


def orphan_summary(orphans: DataFrame) -> DataFrame:
    """(table_name, period, n_rows, n_keys): orphan references per table and month."""
    return orphans.groupBy("table_name", "period").agg(F.count("*").alias("n_rows"), F.countDistinct("ref_key").alias("n_keys"))


def reference_states(claims: DataFrame, claim_node_refs: DataFrame, receipts: DataFrame, records: DataFrame, nodes: DataFrame) -> DataFrame:
    """(table_name, period, state, n_rows): the distinct references of each table and month that
    lead nowhere (missing), to a retired node (deleted), or to what was created after the row
    that refers to it (late: it may have led nowhere once, and does no longer).

    States are told of the orphans and, for late ones, of targets by their first creation; times
    that can't be read make nothing late.
    """
    orphans = orphan_references(claims, claim_node_refs, receipts, records, nodes)
    gone = nodes.where(F.col("retired_at").isNotNull()).select(norm_id("id").alias("ref_key")).where("ref_key IS NOT NULL").distinct().withColumn("was", F.lit(True))
    o = orphans.join(gone, "ref_key", "left").select("table_name", "period", F.when((F.col("table_name") == "claim_node_refs") & F.col("was"), "deleted").otherwise("missing").alias("state"))
    first = lambda df, name: df.groupBy(F.lit(name).alias("target"), norm_id("id").alias("ref_key")).agg(F.min(parse_utc("created_at")).alias("made"))
    made = first(records, "records").unionByName(first(nodes.where(F.col("retired_at").isNull()), "nodes")).where("ref_key IS NOT NULL AND made IS NOT NULL")
    c = claims.select(norm_id("id").alias("row_key"), norm_id("record_id").alias("record"), parse_utc("created_at").alias("at"))
    said = c.groupBy("row_key").agg(F.min("at").alias("at"))
    of = lambda df, name, target, key, at: df.select(F.lit(name).alias("table_name"), F.lit(target).alias("target"), "row_key", F.col(key).alias("ref_key"), F.col(at).alias("at"))
    r = receipts.select(norm_hash("record_content_hash").alias("row_key"), norm_id("record_id").alias("record"), parse_utc("imported_at").alias("at"))
    e = claim_node_refs.select(norm_id("claim_id").alias("row_key"), norm_id("node_id").alias("node")).distinct().join(said, "row_key")
    rows = of(c, "claims", "records", "record", "at").unionByName(of(r, "digest_import_receipts", "records", "record", "at")).unionByName(of(e, "claim_node_refs", "nodes", "node", "at")).where("ref_key IS NOT NULL AND at IS NOT NULL").distinct()
    late = rows.join(made, ["target", "ref_key"]).where("made > at").select("table_name", _month("at").alias("period"), "row_key", "ref_key").distinct().select("table_name", "period", F.lit("late").alias("state"))
    return o.unionByName(late).groupBy("table_name", "period", "state").agg(F.count("*").alias("n_rows"))


def _month(at: str) -> Column:
    return F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), F.floor(F.unix_micros(at) / F.lit(86_400_000_000)).cast("int")), "yyyy-MM")
