"""python -m evigraph list | COMMAND TABLES [OUT] | run QUERY TABLES OUT | import DIGESTS TABLES OUT
| search TABLES TEXT [hybrid|semantic|keyword] [OUT] | show TABLES NAME

Without OUT the first rows are printed; OUT is a folder for Parquet, which must not exist."""

from __future__ import annotations

import sys

#: What each command runs.
COMMANDS = {
    "stats": "a5_graph_stats", "entailment": "a6_entailment_summary", "propose-pages": "v6_page_proposals", "page-floor": "v7_page_floor_report", "source-spread": "v8_single_source_nodes", "page-set": "b8_page_set", "veto-pages": "m13_vetoes_of_separate_proposals", "apply-pages": "m15_pages_of_confident_proposals",
    "superseded-pages": "m15_superseded_pages", "duplicate-records": "m20_shingle_classes", "link-works": "m22_works", "same-origin": "m21_records_of_one_work", "propose-merges": "e10_merge_proposals", "merge-plan": "e12_merge_plan", "verify-band": "f9_pairs_to_verify", "replay-curation": "m9_merge_replay",
    "apply-renames": "m11_renames", "apply-tags": "m14_tag_outcomes", "belonging": "v17_belonging_standin", "salience": "a7_salience_coverage", "brief-staleness": "v18_page_drift", "briefs": "b1_briefs", "publish-briefs": "s15_published_claims_by_status", "unbuildable-briefs": "b9_unbuildable_briefs", "refile-briefs": "b10_refiled_briefs",
    "export-obsidian": "s16_vault_lines", "doctor": "z12_consistency", "schedule-ingest": "z1_ingest_jobs", "schedule-import": "z2_import_jobs", "schedule-rebuild": "z3_rebuild_jobs", "schedule-digest": "z4_digest_jobs", "review-queue": "z5_review_queue", "schedule-synthesise": "z6_synthesise_jobs",
    "schedule-assemble": "z7_assemble_jobs", "schedule-graph": "z8_graph_jobs", "freshness": "z9_generation_freshness", "duplicate-bindings": "z11_duplicate_bindings", "backfill-claim-hashes": "m25_backfilled_hashes", "embed-missing": "z8_embedding_jobs", "stale-embeddings": "m23_stale_embeddings",
    "similarity-profile": "v14_similarity_profile", "calibrate": "v15_best_cut", "corroborate": "v10_corroboration_candidates", "relate": "l6_record_pairs_to_judge", "reverification": "m18_reverification_inventory", "validate-rebuild": "m19_table_differences", "state-hash": "m19_state_hashes",
    "orphans": "p7_found", "due-records": "p1_found", "normalise-people": "x24_person_orders", "normalise-places": "x25_place_orders", "violations": "u7_constraint_violations", "scores": "v1_evidence_scores", "independence": "a11_node_independence", "demand": "j6_record_demand",
}
SHOWN = 50


def put(df, out: list[str]) -> int:
    """The rows to the folder named, or the first to the screen."""
    if out:
        df.write.mode("errorifexists").parquet(out[0])
    else:
        df.show(SHOWN, truncate=100)
    return 0


def search(tables: str, query: str, mode: str = "hybrid", embed=None):
    """Claims for a query: keyword (IDF), semantic (cosine) or both; semantic needs an embedder of
    one text, without which hybrid searches by keyword."""
    from pyspark.sql import functions as F

    from .common import norm_hash, norm_id
    from .operators import search as S
    from .operators.graph import Graph
    from .session import get_session

    g = Graph(get_session(), tables)
    claims = g.claims("content")
    if mode == "keyword" or embed is None:
        if mode == "semantic":
            raise ValueError("a semantic search needs an embedder")
        return S.keyword_search(claims, query).join(claims, "id").orderBy(F.desc("score"), "id")
    v = g.raw("text_embeddings").select(norm_hash("text_hash").alias("h"), F.trim("model_id").alias("model_id"), "embedding")
    e = g.raw("embedding_model").where("kind = 'claim'").select(norm_id("id").alias("id"), F.trim("model_id").alias("model_id"), norm_hash("text_hash").alias("h"))
    vectors = e.join(v, ["h", "model_id"]).select("id", "embedding")
    asked = [float(x) for x in embed(query)]
    found = S.vector_search(vectors, asked) if mode == "semantic" else S.hybrid_search(claims, vectors, query, asked)
    return found.join(claims, "id").orderBy("distance", "id")


def show(tables: str, name: str):
    """The live nodes of a name or alias with their claims."""
    from pyspark.sql import functions as F

    from .operators.graph import Graph
    from .session import get_session

    g = Graph(get_session(), tables)
    ids = g.nodes("node_type", "name").where(F.col("name") == name).select("id").unionByName(g.aliases().where(F.col("alias") == name).select(F.col("node_id").alias("id"))).distinct()
    n = g.nodes("node_type", "name").join(ids, "id", "left_semi")
    c = g.node_claims().join(ids.withColumnRenamed("id", "nid"), "nid", "left_semi").join(g.claims("content", "claim_type").withColumnRenamed("id", "cid"), "cid")
    return n.join(c.withColumnRenamed("nid", "id"), "id", "left").select("id", "node_type", "name", "cid", "claim_type", "content").orderBy("id", "cid")


def import_digests(digests_dir: str, tables: str, out: str) -> int:
    from pyspark.sql import functions as F

    from .operators.graph import Graph
    from .operators.importing import import_digests as run
    from .session import get_session
    from .sources.files import digests

    spark = get_session()
    g = Graph(spark, tables)
    refs = g.edges().groupBy("node_id").agg(F.count("*").alias("refs"))
    done = run(digests(spark, digests_dir), g.nodes("node_type", "name", "seq"), g.aliases().select("alias", "node_id"), refs, g.claims("record_id", "claim_hash", "seq"))
    for name, df in vars(done).items():
        df.write.mode("errorifexists").parquet(f"{out}/{name}")
    return 0


def main(args: list[str]) -> int:
    from .plans import all_registries
    from .session import get_session

    queries = {k: f for r in all_registries() for k, f in r.queries.items()}
    command, rest = (args or [""])[0], args[1:]
    if command == "list":
        print("\n".join([*(f"{c}  ({q})" for c, q in sorted(COMMANDS.items())), *sorted(queries)]))
        return 0
    if command == "run" and len(rest) == 3 and rest[0] in queries:
        return put(queries[rest[0]](get_session(), rest[1]), rest[2:])
    if command == "import" and len(rest) == 3:
        return import_digests(*rest)
    if command == "search" and 2 <= len(rest) <= 4:
        mode = rest[2] if len(rest) > 2 else "hybrid"
        if mode in ("hybrid", "semantic", "keyword"):
            return put(search(rest[0], rest[1], mode), rest[3:])
    if command == "show" and len(rest) == 2:
        return put(show(*rest), [])
    if command in COMMANDS and 1 <= len(rest) <= 2:
        return put(queries[COMMANDS[command]](get_session(), rest[0]), rest[1:])
    print(__doc__, file=sys.stderr)
    return 2


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
