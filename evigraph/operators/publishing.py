"""Publishing briefs: what goes out, what may not be built from, what moves; notes of a vault."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.text import safe_filename
from ..session import materialise

PUBLISHED = "published"


def published(briefs: DataFrame, claims: DataFrame, copyright: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(out, by_status, unreadable) of a publishing run.

    briefs: (file, error, ...), error telling why a brief can't be read; claims: (file,
    claim_id, content_hash); copyright: (content_hash, status) of the store. out has the readable
    briefs with publication = 'published', at their paths; by_status (status, claims) counts
    their claims, whose source the store doesn't know or state as unknown; unreadable (file,
    error) lists the others, which are reported and stop nothing.
    """
    ok = briefs.where("error IS NULL")
    known = copyright.where("content_hash IS NOT NULL").groupBy("content_hash").agg(F.min(F.when(F.trim("status") != "", F.trim("status"))).alias("status"))
    of = claims.join(ok.select("file").distinct(), "file", "left_semi").join(known, "content_hash", "left")
    by_status = of.groupBy(F.coalesce("status", F.lit("unknown")).alias("status")).agg(F.count("*").alias("claims"))
    return ok.drop("error").withColumn("publication", F.lit(PUBLISHED)), by_status, briefs.where("error IS NOT NULL").select("file", "error")


def unbuildable(files: DataFrame, nodes: DataFrame, with_claims: DataFrame, current: DataFrame, pages: DataFrame, members: DataFrame, articles: DataFrame | None) -> DataFrame:
    """(file, why): published briefs that no page may be built from.

    files: (file, node_ids array), the members each brief names; nodes: live (id); with_claims:
    (id); current: (id, file), where a node's own brief belongs; pages: (page_id, name, file),
    where a composed page's brief belongs; members: (page_id, node_id, position); articles:
    (file) of the pages that stand as articles, by their brief's path. In this order: no member
    lives; no living member has claims; the single member belongs to a composed page whose
    article stands; the brief names several members that no page has; it lies elsewhere than it
    should. Without articles nobody can tell whether the composed one stands, so a member's
    brief stays. Briefs without members are left alone.
    """
    f = materialise(files.where("size(node_ids) > 0"), "files")
    m = f.select("file", F.size("node_ids").alias("n"), F.posexplode("node_ids").alias("at", "id"))
    m = m.join(nodes.select("id").distinct().withColumn("live", F.lit(True)), "id", "left").join(with_claims.select("id").distinct().withColumn("used", F.lit(True)), "id", "left")
    usable = F.when(F.col("live") & F.col("used"), F.struct("at", "id"))
    x = m.groupBy("file", "n").agg(F.max(F.coalesce("live", F.lit(False))).alias("any_live"), F.min(usable)["id"].alias("first"))
    page_of = members.groupBy(F.col("node_id").alias("first")).agg(F.min("page_id").alias("page_id")).join(pages.select("page_id", F.col("name").alias("page"), F.col("file").alias("page_file")), "page_id")
    standing = (f.select(F.lit(None).cast("string").alias("page_file")).limit(0) if articles is None else articles.select(F.col("file").alias("page_file")).distinct()).withColumn("stands", F.lit(True))
    sets = members.groupBy("page_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("position", "node_id"))), lambda s: s["node_id"]).alias("node_ids")).join(pages.select("page_id", F.col("file").alias("composed")), "page_id")
    x = x.join(f, "file").join(page_of, "first", "left").join(standing, "page_file", "left").join(sets.groupBy("node_ids").agg(F.min("composed").alias("composed")), "node_ids", "left").join(current.select(F.col("id").alias("first"), F.col("file").alias("own")), "first", "left")
    covered = (F.col("n") == 1) & F.col("page_id").isNotNull()
    belongs = F.coalesce("composed", F.when(F.col("n") == 1, F.col("own")))
    why = (
        F.when(~F.col("any_live"), "node retired or absent")
        .when(F.col("first").isNull(), "node has no claims")
        .when(covered & F.col("stands"), F.concat(F.lit("its subject moved to the composed page "), F.col("page")))
        .when(covered, None)
        .when(F.col("composed").isNull() & (F.col("n") > 1), "the composition it describes is gone")
        .when(F.col("file") != belongs, F.concat(F.lit("stale path; the node's brief is now "), belongs))
    )
    return x.select("file", why.alias("why")).where("why IS NOT NULL")


def refiled(files: DataFrame, renamed: DataFrame, current: DataFrame, pages: DataFrame, members: DataFrame) -> DataFrame:
    """(node_ids, write, prune): for renamed nodes that had a brief, where it is to be written now
    and which of their old files go.

    files: (file, node_ids); renamed: (id); current: (id, file); pages, members as above. A node
    that a composed page covers has that page written; a node without a brief on disk gets none.
    """
    had = files.select("file", F.explode("node_ids").alias("id")).join(renamed.select("id").distinct(), "id", "left_semi")
    page = members.groupBy(F.col("node_id").alias("id")).agg(F.min("page_id").alias("page_id"))
    lists = members.groupBy("page_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("position", "node_id"))), lambda s: s["node_id"]).alias("node_ids"))
    x = had.join(page, "id", "left").join(pages.select("page_id", F.col("file").alias("page_file")), "page_id", "left").join(lists, "page_id", "left").join(current.select("id", F.col("file").alias("own")), "id", "left")
    x = x.select(F.coalesce("node_ids", F.array("id")).alias("node_ids"), F.coalesce("page_file", "own").alias("write"), "file")
    old = F.array_except(F.sort_array(F.collect_set("file")), F.array_compact(F.array(F.first("write"))))
    return x.groupBy("node_ids").agg(F.first("write").alias("write"), old.alias("prune"))


def person_listing(nodes: DataFrame, claims: DataFrame) -> DataFrame:
    """(id, claims, works): what a list of people shows of each. claims: (nid, cid, work)."""
    n = claims.groupBy(F.col("nid").alias("id")).agg(F.countDistinct("cid").alias("claims"), F.countDistinct("work").alias("works"))
    return nodes.where("node_type = 'person'").select("id").join(n, "id", "left").select("id", F.coalesce("claims", F.lit(0)).alias("claims"), F.coalesce("works", F.lit(0)).alias("works"))


def wikilink(c: str):
    """[[name]] without the characters that end a link; an absent name is _."""
    x = F.trim(F.regexp_replace(c, r"[\[\]|#^]", ""))
    return F.when(F.col(c).isNull() | (F.col(c) == ""), "_").otherwise(F.concat(F.lit("[["), x, F.lit("]]")))


def vault_lines(names: DataFrame, edges: DataFrame, claims: DataFrame) -> DataFrame:
    """(folder, file, part, place, line): the claim lines of a vault's notes, one row each.

    names: (id, name, node_type); notes are one per name and type, whatever ids share these;
    edges: (claim_id, node_id); claims: (id, content, record_id, record). A claim that several
    ids of a name refer to, and a repeated content of one record, stands once. Lines link to the
    other nodes of their claim. A note of a hub is in parts of PART lines, so that no note has
    to fit into one row: write_texts() by folder, file and part makes its files.
    """
    n = names.select(F.col("id").alias("node_id"), "name", "node_type").where("name IS NOT NULL")
    e = materialise(edges.select("claim_id", "node_id").distinct().join(n, "node_id"), "named_edges")
    links = e.groupBy("claim_id").agg(F.array_sort(F.collect_set("name")).alias("linked"))
    c = claims.select(F.col("id").alias("claim_id"), "content", "record_id", "record").where("content IS NOT NULL")
    x = e.select("claim_id", "name", "node_type").distinct().join(c, "claim_id")
    x = x.groupBy("node_type", "name", "record_id", "content").agg(F.min("claim_id").alias("claim_id"), F.min("record").alias("record")).join(links, "claim_id")
    others = F.transform(F.filter("linked", lambda o: o != F.col("name")), lambda o: F.concat(F.lit("[["), F.trim(F.regexp_replace(o, r"[\[\]|#^]", "")), F.lit("]]")))
    line = F.concat(F.lit("- "), F.regexp_replace("content", r"\s*\n\s*", " "), F.lit(" ("), F.coalesce("record", F.lit("_")), F.lit(")"), F.when(F.size(others) > 0, F.concat(F.lit(" "), F.array_join(others, ", "))).otherwise(""))
    x = materialise(x.select("node_type", "name", F.coalesce("record_id", F.lit("")).alias("record_id"), "claim_id", line.alias("line")), "vault_lines")
    # a note's lines are numbered record by record, so that no task sorts all lines of a hub
    before = W.partitionBy("node_type", "name").orderBy("record_id").rowsBetween(W.unboundedPreceding, -1)
    sizes = x.groupBy("node_type", "name", "record_id").agg(F.count("*").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    within = F.row_number().over(W.partitionBy("node_type", "name", "record_id").orderBy("claim_id"))
    x = x.withColumn("within", within).join(sizes, ["node_type", "name", "record_id"]).withColumn("place", F.col("before") + F.col("within"))
    return x.select(F.col("node_type").alias("folder"), F.concat(safe_filename("name"), F.lit(".md")).alias("file"), F.floor((F.col("place") - 1) / PART).cast("int").alias("part"), "place", "line")


#: Lines of one part of a note.
PART = 10_000


def vault_notes(lines: DataFrame) -> DataFrame:
    """(folder, file, part, value): the parts of notes as texts, each of at most PART lines."""
    parts = lines.groupBy("folder", "file", "part").agg(F.array_sort(F.collect_list(F.struct("place", "line"))).alias("l"))
    return parts.select("folder", "file", "part", F.array_join(F.transform("l", lambda x: x["line"]), "\n").alias("value"))
