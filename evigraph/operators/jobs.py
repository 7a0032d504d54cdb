"""What is to be done next: jobs of ingest, digest, rebuild, synthesis and assembly, with why."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What a source's file type is called and where and how it is worked on.
AUDIO, GPU, LOCAL, WRITER = ("opus", "mp3", "wav", "mp4", "m4a", "webm", "mkv"), "gpu", "eager", "claude"
SOURCE_TYPES = {**{x: ("~GPU transcription", "audio/video", GPU) for x in AUDIO}, "html": ("~web extraction", "web page", LOCAL), "pdf": ("~PDF extraction", "document", LOCAL), "epub": ("~ebook extraction", "ebook", LOCAL)}
CONSEQUENCES = ("finish", "verify", "repair")


def _spec(ext: str, at: int, other: Column) -> Column:
    out = other
    for k, v in SOURCE_TYPES.items():
        out = F.when(F.col(ext) == k, F.lit(v[at])).otherwise(out)
    return out


def ingest_jobs(sources: DataFrame, ingested: DataFrame, superseded: DataFrame) -> DataFrame:
    """(id, hash, label, lane, effort): sources whose bytes no record comes from.

    sources: (hash, ext); ingested, superseded: (hash). A source that was taken in again under
    another hash is superseded and no work. A source under several types is one job, of the
    first type by name.
    """
    s = sources.where("hash IS NOT NULL").groupBy("hash").agg(F.min(F.lower("ext")).alias("ext"))
    s = s.join(ingested.select("hash").distinct(), "hash", "left_anti").join(superseded.select("hash").distinct(), "hash", "left_anti")
    kind = _spec("ext", 1, F.coalesce(F.nullif("ext", F.lit("")), F.lit("unknown")))
    return s.select(F.concat(F.lit("ingest:"), "hash").alias("id"), "hash", F.concat_ws(" ", kind, F.substring("hash", 1, 12)).alias("label"), _spec("ext", 2, F.lit(LOCAL)).alias("lane"), _spec("ext", 0, F.lit("~extraction")).alias("effort"))


def rebuild_jobs(imported: DataFrame, digests: DataFrame) -> DataFrame:
    """(id, status, trigger, orphans): one blocked job if the graph holds records whose digest is
    gone, none otherwise. imported, digests: (key). Importing can't take a record out."""
    n = imported.select("key").distinct().join(digests.select("key").distinct(), "key", "left_anti").agg(F.count("*").alias("orphans")).where("orphans > 0")
    return n.select(F.lit("rebuild:graph").alias("id"), F.lit("blocked").alias("status"), F.lit("canonical_set_contraction").alias("trigger"), "orphans")


def digest_jobs(digestible: DataFrame, digested: DataFrame, reasons: DataFrame, demand: DataFrame) -> DataFrame:
    """(id, hash, label, trigger, value, reasons): records without a digest (never_done) and those
    whose digest is stale, that is for which reasons (hash, reason) has rows.

    digestible: (hash, friendly_name, title); digested: (hash); demand: (hash, value), null if unknown.
    """
    r = reasons.where("reason IS NOT NULL").groupBy("hash").agg(F.sort_array(F.collect_set("reason")).alias("reasons"))
    x = digestible.where("hash IS NOT NULL").groupBy("hash").agg(F.min(F.coalesce("friendly_name", "title")).alias("label"))
    x = x.join(digested.select("hash").distinct().withColumn("done", F.lit(True)), "hash", "left").join(r, "hash", "left").join(demand.select("hash", "value"), "hash", "left")
    x = x.where(F.col("done").isNull() | F.col("reasons").isNotNull())
    none = F.array().cast("array<string>")
    return x.select(F.concat(F.lit("digest:"), "hash").alias("id"), "hash", F.coalesce("label", F.concat(F.lit("record "), F.substring("hash", 1, 12))).alias("label"), F.when(F.col("done").isNull(), "never_done").otherwise("stale").alias("trigger"), "value", F.when(F.col("done").isNull(), none).otherwise(F.coalesce("reasons", none)).alias("reasons"))


def selection_changes(recorded: DataFrame, current: DataFrame) -> DataFrame:
    """(reference, recorded, current, removed, added, changed, moved): how the claims of briefs
    differ. Both sides: (reference, place, claim_id, claim_hash); a claim is moved if it is in
    both with one hash at different places."""
    a = recorded.select("reference", "claim_id", F.col("place").alias("p"), F.col("claim_hash").alias("h"), F.lit(1).alias("x"))
    b = current.select("reference", "claim_id", F.col("place").alias("q"), F.col("claim_hash").alias("i"), F.lit(1).alias("y"))
    j = a.join(b, ["reference", "claim_id"], "full_outer")
    both, n = F.col("x").isNotNull() & F.col("y").isNotNull(), lambda c: F.sum(c.cast("int"))
    same = F.col("h").eqNullSafe(F.col("i"))
    return j.groupBy("reference").agg(
        F.count("x").alias("recorded"), F.count("y").alias("current"), n(F.col("y").isNull()).alias("removed"), n(F.col("x").isNull()).alias("added"), n(both & ~same).alias("changed"), n(F.coalesce(both & same & (F.col("p") != F.col("q")), F.lit(False))).alias("moved")
    )


#: What two states of a brief are compared by, beside its hashes, and what a difference is called.
PAGE_FIELDS = {"title": "page_identity_mismatch", "slug": "page_identity_mismatch", "node_type": "page_identity_mismatch", "node_ids": "page_member_mismatch", "listing": "listing_mismatch", "publication": "publication_mismatch"}


def synthesise_jobs(recorded: DataFrame, current: DataFrame, recorded_claims: DataFrame, current_claims: DataFrame) -> DataFrame:
    """(id, reference, trigger, reasons, removed, added, changed, moved): briefs that the writer,
    run again over the graph, would write otherwise.

    recorded, current: (reference, node_id, brief_hash, payload_hash, and PAGE_FIELDS as far as
    both have them). A brief whose hashes and page agree is settled, however the graph changed
    since. A missing brief of a node that another brief covers is stale, else never done.
    """
    fields = [f for f in PAGE_FIELDS if f in recorded.columns and f in current.columns]
    old = recorded.select("reference", *[F.col(c).alias(f"_{c}") for c in ("brief_hash", "payload_hash", *fields)], F.lit(True).alias("_there"))
    x = current.join(old, "reference", "left")
    differs = lambda c: F.col("_there") & ~F.col(c).eqNullSafe(F.col(f"_{c}"))
    why = [F.when(F.col("_there").isNull(), "brief_missing"), F.when(differs("brief_hash"), "selection_hash_mismatch"), F.when(differs("payload_hash"), "payload_hash_mismatch"), *[F.when(differs(f), PAGE_FIELDS[f]) for f in fields]]
    x = x.withColumn("reasons", F.sort_array(F.array_distinct(F.array_compact(F.array(*why))))).where(F.size("reasons") > 0)
    covered = recorded.select("node_id").distinct().withColumn("_covered", F.lit(True))
    x = x.join(covered, "node_id", "left").join(selection_changes(recorded_claims, current_claims), "reference", "left")
    trigger = F.when(F.col("_there") | F.col("_covered"), "stale_brief").otherwise("never_done")
    return x.select(F.concat(F.lit("synthesise:"), "node_id").alias("id"), "reference", trigger.alias("trigger"), "reasons", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("removed", "added", "changed", "moved")])


def assemble_jobs(briefs: DataFrame, brief_claims: DataFrame, articles: DataFrame, citations: DataFrame, generator: dict[str, str] | None = None, inherited: DataFrame | None = None) -> DataFrame:
    """(id, reference, language, status, trigger, reasons, consequence, citations, missing, mismatched):
    articles that don't rest on the brief as it is now.

    briefs: (reference, brief_hash, payload_hash), those without a hash are left out;
    brief_claims: (reference, claim_id, claim_hash); articles: (reference, language, brief_hash,
    payload_hash, built_by map, body_sha256), body_sha256 being that of the text there is now and
    built_by['body_sha256'] that of the text as built; citations: (reference, language, claim_id,
    claim_hash). A brief without article wants one in English. Only those fields of the generator
    are compared that an article states. A citation that the brief lacks or has with another hash
    asks for repair; a body that was edited blocks the job, as do references in inherited.
    """
    b = briefs.where("brief_hash IS NOT NULL AND payload_hash IS NOT NULL").select("reference", "brief_hash", "payload_hash")
    a = articles.select("reference", "language", F.col("brief_hash").alias("_b"), F.col("payload_hash").alias("_p"), "built_by", "body_sha256", F.lit(True).alias("_there"))
    x = b.join(a, "reference", "left").withColumn("language", F.coalesce("language", F.lit("en")))
    c = citations.join(brief_claims.select("reference", "claim_id", F.col("claim_hash").alias("_h"), F.lit(True).alias("_in")), ["reference", "claim_id"], "left")
    c = c.groupBy("reference", "language").agg(F.count("*").alias("citations"), F.sum(F.col("_in").isNull().cast("int")).alias("missing"), F.sum((F.col("_in") & ~F.col("claim_hash").eqNullSafe(F.col("_h"))).cast("int")).alias("mismatched"))
    x = x.join(c, ["reference", "language"], "left").fillna(0, ["citations", "missing", "mismatched"])
    x = x.withColumn("_inherited", F.lit(False)) if inherited is None else x.join(inherited.select("reference").distinct().withColumn("_inherited", F.lit(True)), "reference", "left").fillna(False, ["_inherited"])
    there, no = F.col("_there").isNotNull(), F.lit(False)
    changed = no
    for k, v in (generator or {}).items():
        changed = changed | F.coalesce(F.map_contains_key("built_by", F.lit(k)) & ~F.col("built_by")[k].eqNullSafe(F.lit(v)), no)
    edited = F.coalesce(F.col("built_by")["body_sha256"] != F.col("body_sha256"), no)
    codes = [
        ("article_missing", ~there), ("brief_hash_mismatch", there & ~F.col("_b").eqNullSafe(F.col("brief_hash"))), ("payload_hash_mismatch", there & ~F.col("_p").eqNullSafe(F.col("payload_hash"))), ("citation_missing", there & (F.col("missing") > 0)),
        ("citation_hash_mismatch", there & (F.col("mismatched") > 0)), ("generator_changed", there & changed), ("body_modified", there & edited),
    ]
    x = x.withColumn("reasons", F.array_compact(F.array(*[F.when(cond, F.lit(code)) for code, cond in codes]))).where((F.size("reasons") > 0) | F.col("_inherited"))
    has = lambda code: F.array_contains("reasons", code)
    only = F.size("reasons") == 1
    consequence = F.when(has("citation_missing") | has("citation_hash_mismatch"), "repair").when(only & (has("generator_changed") | has("body_modified")), "verify").otherwise("finish")
    status = F.when(F.col("_inherited") | has("body_modified"), "blocked").otherwise("eligible")
    trigger = F.when(~there, "never_done").when(F.size("reasons") > 0, "stale_brief").otherwise("inherited_freshness")
    ident = F.concat(F.lit("assemble:"), "reference", F.when(F.col("language") != "en", F.concat(F.lit(":"), "language")).otherwise(""))
    return x.select(ident.alias("id"), "reference", "language", status.alias("status"), trigger.alias("trigger"), "reasons", consequence.alias("consequence"), "citations", "missing", "mismatched")


def graph_jobs(gate: DataFrame, proposed: DataFrame, unembedded: DataFrame) -> DataFrame:
    """(id, type, n, minutes): a job to propose pages again if the nodes that pass the gate are
    not those proposed, and one per bucket of claims without a vector.

    gate, proposed: (node_id); unembedded: (bucket, pending).
    """
    a, b = gate.select("node_id").distinct(), proposed.select("node_id").distinct()
    differ = a.join(b, "node_id", "left_anti").unionByName(b.join(a, "node_id", "left_anti")).agg(F.count("*").alias("n")).where("n > 0")
    stale = differ.select(F.lit("propose-pages").alias("id"), F.lit("propose").alias("type"), "n", F.lit(None).cast("int").alias("minutes"))
    minutes = F.greatest(F.bround(F.col("pending") / 4.9 / 60).cast("int"), F.lit(1))
    return stale.unionByName(unembedded.select(F.concat(F.lit("embed:"), F.col("bucket").cast("string")).alias("id"), F.lit("embed").alias("type"), F.col("pending").alias("n"), minutes.alias("minutes")))
