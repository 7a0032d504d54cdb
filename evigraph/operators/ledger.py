"""Append-only event ledgers: latest state, compensation, supersession, replay of merges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..session import materialise, remove


def latest(events: DataFrame, key: list[str], order: list[str], value: str) -> DataFrame:
    """(key..., value, n, conflict): the last event's value per key; conflict where events at the
    last instant (the first order column) disagree. Partial aggregation, no list."""
    last = events.groupBy(*key).agg(F.max_by(value, F.struct(*order)).alias(value), F.max(order[0]).alias("_at"), F.count("*").alias("n"))
    same = events.join(last.select(*key, F.col("_at")), key).where(F.col(order[0]) == F.col("_at")).groupBy(*key).agg((F.countDistinct(value) > 1).alias("conflict"))
    return last.join(same, key).select(*key, value, "n", "conflict")


def active(events: DataFrame, ident: str = "id", compensates: str = "compensates", at: str = "at") -> tuple[DataFrame, DataFrame]:
    """(active events, refused compensations).

    A compensation takes back the one event it names, if that is known, no compensation itself,
    earlier, and not taken back before; else it is refused with a reason.
    """
    base = events.where(F.col(compensates).isNull())
    comp = events.where(F.col(compensates).isNotNull()).select(F.col(ident).alias("_c"), F.col(compensates).alias("_of"), F.col(at).alias("_at"))
    known = base.select(F.col(ident).alias("_of"), F.col(at).alias("_base_at"))
    x = comp.join(known, "_of", "left").withColumn("_n", F.row_number().over(W.partitionBy("_of", F.col("_base_at") < F.col("_at")).orderBy("_at", "_c")))
    reason = F.when(F.col("_base_at").isNull(), "unknown event").when(~(F.col("_base_at") < F.col("_at")), "not later").when(F.col("_n") > 1, "already taken back")
    x = x.withColumn("reason", reason)
    gone = x.where("reason IS NULL").select(F.col("_of").alias(ident))
    return base.join(gone, ident, "left_anti"), x.where("reason IS NOT NULL").select(F.col("_c").alias(ident), F.col("_of").alias(compensates), "reason")


def tips(events: DataFrame, ident: str = "id", supersedes: str = "supersedes") -> DataFrame:
    """Events that no other supersedes."""
    older = events.where(F.col(supersedes).isNotNull()).select(F.col(supersedes).alias(ident)).distinct()
    return events.join(older, ident, "left_anti")


def merge_map(merges: DataFrame) -> DataFrame:
    """(node_id, survivor): where each merged node ends after all merges in their order.

    merges: (survivor, victim, at), in the order of at, survivor, victim. A node that was merged
    before stands for the one it went into, on either side; the survivor itself has no row.

    Merges that don't wait for each other are done in one round: one whose victim no earlier
    merge touches, and whose survivor no earlier one takes away. So there are as many rounds as
    merges follow on one another, a survivor of many is one round; a table each.
    """
    order = ["at", "survivor", "victim"]
    m = merges.where("survivor IS NOT NULL AND victim IS NOT NULL AND survivor <> victim").select(*order).distinct()
    left = materialise(m.select(F.struct(*order).alias("o"), F.col("survivor").alias("s"), F.col("victim").alias("v")), "merges")
    ids = left.select(F.col("s").alias("node_id")).unionByName(left.select(F.col("v").alias("node_id"))).distinct()
    roots = materialise(ids.withColumn("root", F.col("node_id")), "roots")
    while not left.isEmpty():
        touched = left.select(F.col("s").alias("n"), "o").unionByName(left.select(F.col("v").alias("n"), "o")).groupBy("n").agg(F.min("o").alias("first"))
        taken = left.groupBy(F.col("v").alias("n")).agg(F.min("o").alias("gone"))
        x = left.join(touched.select(F.col("n").alias("v"), "first"), "v").join(taken.select(F.col("n").alias("s"), "gone"), "s", "left")
        ready = materialise(x.where((F.col("o") == F.col("first")) & (F.col("gone").isNull() | (F.col("o") < F.col("gone")))).select(F.col("v").alias("from"), F.col("s").alias("to"), "o"), "ready")
        moved = ready.select(F.col("from").alias("root"), "to")
        new_roots = materialise(roots.join(moved, "root", "left").select("node_id", F.coalesce("to", "root").alias("root")), "roots")
        rest = left.join(ready.select("o"), "o", "left_anti")
        to = lambda c: ready.select(F.col("from").alias(c), F.col("to").alias(f"_{c}"))  # noqa: B023,E731
        rest = rest.join(to("s"), "s", "left").join(to("v"), "v", "left").select("o", F.coalesce("_s", "s").alias("s"), F.coalesce("_v", "v").alias("v")).where("s <> v")
        new_left = materialise(rest, "merges")
        for old in (left, roots, ready):
            remove(old)
        left, roots = new_left, new_roots
    return roots.where("node_id <> root").select("node_id", F.col("root").alias("survivor"))


def separate_pairs(sets: DataFrame, ids: str) -> DataFrame:
    """(a, b), a < b: pairs inside sets of ids that are kept apart (sets are typed by hand and short)."""
    x = sets.select(F.array_distinct(F.array_compact(ids)).alias("i")).select("i", F.explode("i").alias("a"))
    return x.select("a", F.explode("i").alias("b")).where("a < b").distinct()


def outcome(resolved: Column, wanted: Column, confirmed: Column) -> Column:
    """What replaying an event comes to."""
    return F.when(~F.coalesce(confirmed, F.lit(False)), "unconfirmed").when(resolved == 0, "lost").when(resolved < wanted, "absorbed").otherwise("applied")
