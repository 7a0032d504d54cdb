"""Whether proposals, briefs, articles and the graph agree: seven findings, one row each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .resolve import doubled_places

SHOWN = 5


def findings(proposals: DataFrame, nodes: DataFrame, briefs: DataFrame, articles: DataFrame | None = None, undone: DataFrame | None = None) -> DataFrame:
    """(finding, n, examples): what disagrees, with the first five by name; agreeing checks have no row.

    proposals: (node_id); nodes: live (id, node_type, name, seq, slug); briefs: (reference,
    node_ids, brief_hash, payload_hash), reference being section/slug; articles: (reference,
    brief_hash, payload_hash) of published pages in English; undone: (node_id, veto_id) of
    vetoes taken back. Without articles the two checks that need them are left out.
    """
    live = materialise(nodes.select("id", "node_type", "name", "seq", "slug"), "live")
    ids, p = live.select("id"), proposals.select(F.col("node_id").alias("id")).where("id IS NOT NULL").distinct()
    m = materialise(briefs.select("reference", F.size("node_ids").alias("members"), F.posexplode("node_ids").alias("at", "id")), "members")
    lives = m.join(ids.withColumn("live", F.lit(True)), "id", "left")
    checks = {
        "proposal-points-at-dead-node": p.join(ids, "id", "left_anti").select(F.col("id").alias("x")),
        "brief-for-dead-node": lives.groupBy("reference").agg(F.max("live").alias("l")).where("l IS NULL").select(F.col("reference").alias("x")),
        "brief-stranded-by-rename": m.where("members = 1").join(live.select("id", "slug"), "id").where(F.element_at(F.split("reference", "/"), -1) != F.col("slug")).select(F.col("reference").alias("x")),
        "proposal-without-brief": p.join(live, "id").join(m.select("id").distinct(), "id", "left_anti").select(F.concat("name", F.lit(" ("), F.substring("id", 1, 8), F.lit(")")).alias("x")),
    }
    if articles is not None:
        b = briefs.select("reference", "brief_hash", "payload_hash")
        old = articles.select("reference", F.col("brief_hash").alias("b"), F.col("payload_hash").alias("p"))
        checks["page-trails-its-brief"] = b.join(old, "reference").where(~(F.col("b").eqNullSafe(F.col("brief_hash")) & F.col("p").eqNullSafe(F.col("payload_hash")))).select(F.col("reference").alias("x"))
        if undone is not None:
            first = m.where("at = 0").groupBy("id").agg(F.max("reference").alias("reference"))
            again = p.join(undone.groupBy(F.col("node_id").alias("id")).agg(F.max("veto_id").alias("veto_id")), "id").join(first, "id").join(articles.select("reference").distinct(), "reference", "left_anti")
            checks["veto-undone-page-absent"] = again.select(F.concat("reference", F.lit(" (veto "), F.substring("veto_id", 1, 8), F.lit(")")).alias("x"))
    places = live.where("node_type = 'place'")
    named = lambda i, n: places.select(F.col("id").alias(i), F.col("name").alias(n))
    checks["one-place-two-nodes"] = doubled_places(places).join(named("bare_id", "bare"), "bare_id").join(named("compound_id", "compound"), "compound_id").select(F.concat_ws(" = ", "bare", "compound").alias("x"))
    out = None
    for name, df in checks.items():
        # the first few by name; what is counted isn't gathered
        top = df.orderBy("x").limit(SHOWN).agg(F.sort_array(F.collect_list("x")).alias("examples"))
        row = df.agg(F.count("*").alias("n")).where("n > 0").join(F.broadcast(top)).select(F.lit(name).alias("finding"), "n", "examples")  # one row each
        out = row if out is None else out.unionByName(row)
    return out
