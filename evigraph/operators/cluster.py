"""Connected components by alternating stars, and what is built on them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise, remove


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over directed edges (v, u): link v's neighbourhood to its smallest member.

    Large stars move the larger neighbours, small stars the smaller ones and v itself. The
    minimum comes from partial aggregation; no neighbourhood is collected.
    """
    if large:
        both = edges.select("v", "u").unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
    else:
        both = edges.select(F.greatest("v", "u").alias("v"), F.least("v", "u").alias("u"))
    least = both.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("m"))
    x = both.join(least, "v")
    if large:
        out = x.where(F.col("u") > F.col("v")).select(F.col("u").alias("v"), F.col("m").alias("u"))
    else:
        out = x.select(F.col("u").alias("v"), F.col("m").alias("u")).unionByName(least.select("v", F.col("m").alias("u")))
    return out.where("v <> u").distinct()


def components(edges: DataFrame, vertices: DataFrame | None = None, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): component is the smallest id linked with id.

    Large-star and small-star steps in turn until the edges no longer change (Kiveris et al.,
    Connected Components in MapReduce and Beyond, 2014). Each round is written to the shared
    folder; two sums tell whether it changed anything. Null ends and loops are left out;
    vertices adds ids without edges. No edges give the vertices alone.
    """
    clean = edges.select(F.col(a).alias("v"), F.col(b).alias("u")).where(F.col("v").isNotNull() & F.col("u").isNotNull())
    ids = clean.select(F.col("v").alias("id")).union(clean.select("u"))
    if vertices is not None:
        ids = ids.union(vertices.select("id").where("id IS NOT NULL"))
    ids = ids.distinct()
    e = materialise(clean.where("v <> u").select(F.greatest("v", "u").alias("v"), F.least("v", "u").alias("u")).distinct(), "stars")
    seen = None
    while True:
        mark = e.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("v", "u")).alias("x")).first()
        if (mark["n"], mark["x"]) == seen or not mark["n"]:
            break
        seen = (mark["n"], mark["x"])
        new = materialise(_star(_star(e, True), False), "stars")
        remove(e)
        e = new
    roots = e.groupBy(F.col("v").alias("id")).agg(F.min("u").alias("component"))
    return ids.join(roots, "id", "left").select("id", F.coalesce("component", "id").alias("component"))


def clusters(pairs: DataFrame, a: str = "a", b: str = "b", score: str = "score") -> DataFrame:
    """(component, members, pairs, best): of scored pairs the groups they tie, and the best score inside each."""
    c = components(pairs, a=a, b=b)
    size = c.groupBy("component").agg(F.count("*").alias("members"))
    inside = pairs.join(c.select(F.col("id").alias(a), "component"), a).groupBy("component").agg(F.count("*").alias("pairs"), F.max(score).alias("best"))
    return size.join(inside, "component")
