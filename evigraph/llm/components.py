"""Groups from pairwise matches: minimum labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..common import norm_id
from ..session import materialise, remove


def group_ids(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, group_id): group_id is the smallest id linked with id, directly or indirectly.

    vertices: (id), edges: (a, b), in any direction, with repeats and loops. A vertex without
    an edge is its own group. Null ids are left out; an edge with a null end ties nothing, but
    its other end counts as a vertex, as all ends of edges do. An empty
    input gives an empty result.

    Each round hooks: the label of a component's root sinks to the smallest label that any
    edge brings next to it. Then pointers jump (label := label of label) until every vertex
    points at a root. Rounds grow with the logarithm of the longest chain. Edges are
    rewritten to the labels of their ends and made distinct, so edges inside a component
    vanish and a vertex with any number of edges is reduced by partial aggregation. Each
    round is cut off by a table in the shared folder; only counts come to the driver.
    """
    e = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where(F.col("a").isNotNull() & F.col("b").isNotNull())
    ids = vertices.select("id").unionByName(e.select(F.col("a").alias("id"))).unionByName(e.select(F.col("b").alias("id")))
    ids = ids.where(F.col("id").isNotNull()).distinct()
    labels = materialise(ids.select("id", F.col("id").alias("label")), "labels")
    left = materialise(e.where("a <> b").distinct(), "edges")
    while not left.isEmpty():
        # edges join roots, the smaller end first: each root that has a smaller neighbour takes the smallest
        hook = left.groupBy(F.col("b").alias("id")).agg(F.min("a").alias("to"))
        roots = materialise(hook, "hooks")
        while True:  # jump: to := to of to
            up = roots.select(F.col("id").alias("to"), F.col("to").alias("top"))
            jumped = materialise(roots.join(up, "to", "left").select("id", F.coalesce("top", "to").alias("to"), F.col("top").isNotNull().alias("moved")), "hooks")
            done = jumped.where("moved").isEmpty()
            old, roots = roots, jumped.drop("moved")
            remove(old)
            if done:
                break
        to = roots.select(F.col("id").alias("label"), "to")
        new_labels = materialise(labels.join(to, "label", "left").select("id", F.coalesce("to", "label").alias("label")), "labels")
        ta, tb = to.withColumnsRenamed({"label": "a", "to": "ta"}), to.withColumnsRenamed({"label": "b", "to": "tb"})
        moved = left.join(ta, "a", "left").join(tb, "b", "left").select(F.coalesce("ta", "a").alias("x"), F.coalesce("tb", "b").alias("y"))
        new_left = materialise(moved.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
        for x in (labels, left, roots):
            remove(x)
        labels, left = new_labels, new_left
    return labels.select("id", F.col("label").alias("group_id"))


def proposal_groups(proposals: DataFrame) -> DataFrame:
    """(node_id, group_id) of the ids that confident and flagged proposals tie together.

    All ids of a row's node_ids and suggested_canonical belong together; blanks and nulls in
    them are no ids. Rows of other sections, and rows without ids, add nothing. A row ties
    each of its ids to its smallest one, so a long list gives no pairs.
    """
    rows = proposals.where(F.lower(F.trim("section")).isin("confident", "flagged"))
    listed = F.concat(F.coalesce("node_ids", F.array().cast("array<string>")), F.array("suggested_canonical"))
    ids = rows.select(F.array_distinct(F.array_compact(F.transform(listed, norm_id))).alias("ids")).where(F.size("ids") > 0)
    pairs = ids.select(F.array_min("ids").alias("a"), F.explode("ids").alias("b"))
    return group_ids(pairs.select(F.col("b").alias("id")), pairs).withColumnRenamed("id", "node_id")
