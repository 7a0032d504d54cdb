"""Rewriting digests in their line form: one row per line, all other lines as they are.

    ### <id> <type>: <name>                 a node
    ### <id> [<claim type>] speaker:<name>  a claim
    refs: <name>; <name>                    what the claim refers to

A file's renames come from its own nodes, so each file's map is small and joined by path.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import kernel, orders, text
from ..session import materialise

NODE = r"^### ([a-f0-9-]{36}) (\w+): (.+)$"
CLAIM = r"^(### [a-f0-9-]{36} \[[^\]]+\]) speaker:(.+)$"
REFS = "refs: "


def digest_lines(spark: SparkSession, root: str, pattern: str = "*.extract.md") -> DataFrame:
    """(path, at, line) of the files below root."""
    f = spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter=pattern).withColumn("path", F.input_file_name())
    return f.select("path", F.posexplode(F.split("value", "\n")).alias("at", "line"))


def nodes_of(lines: DataFrame) -> DataFrame:
    """(path, at, id, node_type, name) of the lines that declare a node."""
    part = lambda i: F.regexp_extract("line", NODE, i)
    return lines.select("path", "at", part(1).alias("id"), part(2).alias("node_type"), part(3).alias("name")).where("id <> ''")


def with_documents(lines: DataFrame) -> DataFrame:
    """Objects and matters whose name reads like a document's become documents."""
    name = F.regexp_extract("line", NODE, 3)
    is_doc = F.regexp_extract("line", NODE, 2).isin("object", "matter") & text.is_document_name(name)
    return lines.withColumn("line", F.when(is_doc, F.regexp_replace("line", r"^(### [a-f0-9-]{36}) \w+:", "$1 document:")).otherwise(F.col("line")))


def renames(lines: DataFrame) -> DataFrame:
    """(path, old, new): people and places of a file that get another order."""
    n = nodes_of(lines)
    new = F.when(F.col("node_type") == "person", orders.surname_order("name")).when(F.col("node_type") == "place", orders.place_order("name"))
    return n.select("path", F.col("name").alias("old"), new.alias("new")).where("new <> old").distinct()


def former_names(lines: DataFrame) -> DataFrame:
    """(path, old, new): how references may still call people and places whose nodes were renamed."""
    n = nodes_of(lines)
    old = F.when(F.col("node_type") == "person", orders.natural_person("name")).when(F.col("node_type") == "place", orders.natural_place("name"))
    return n.select("path", old.alias("old"), F.col("name").alias("new")).where("old IS NOT NULL AND old <> new").groupBy("path", "old").agg(F.max("new").alias("new"))


def _refs(line: Column) -> tuple[Column, Column]:
    """(the names of a refs line, their delimiter): semicolons where there is one, else commas."""
    body = F.expr(f"substring(line, {len(REFS) + 1})")
    semi = F.contains("line", F.lit(";"))
    names = F.when(semi, F.split(body, ";")).otherwise(F.split(body, ","))
    return F.transform(names, lambda x: F.trim(x)), F.when(semi, "; ").otherwise(", ")


def renamed(lines: DataFrame, mapping: DataFrame, nodes: bool = True) -> DataFrame:
    """The lines with names replaced by each file's mapping (path, old, new): in references, in
    speakers, and in nodes unless nodes is false. All at once, so that names can be swapped."""
    m = mapping.groupBy("path").agg(F.map_from_entries(F.collect_list(F.struct("old", "new"))).alias("m"))
    x = lines.join(m, "path", "left")
    to = lambda c: F.coalesce(F.try_element_at("m", c), c)
    refs, delimiter = _refs(F.col("line"))
    names = F.transform(refs, lambda r: F.coalesce(F.try_element_at(F.col("m"), r), r))
    new_refs = F.concat(F.lit(REFS), F.when(delimiter == "; ", F.array_join(names, "; ")).otherwise(F.array_join(names, ", ")))
    speaker = F.trim(F.regexp_extract("line", CLAIM, 2))
    name = F.regexp_extract("line", NODE, 3)
    line = F.when(F.startswith("line", F.lit(REFS)), new_refs).when(F.col("line").rlike(CLAIM), F.concat(F.regexp_extract("line", CLAIM, 1), F.lit(" speaker:"), to(speaker)))
    if nodes:
        line = line.when(F.col("line").rlike(NODE), F.concat(F.regexp_extract("line", r"^(### [a-f0-9-]{36} \w+: )", 1), to(name)))
    return x.select("path", "at", F.when(F.col("m").isNull(), F.col("line")).otherwise(F.coalesce(line, F.col("line"))).alias("line"))


def with_semicolons(lines: DataFrame, names: DataFrame) -> DataFrame:
    """Reference lines with commas, rewritten with semicolons: names may hold commas themselves,
    so at each place the longest run of parts that is a known name counts. names: (name).

    Only runs that occur in a line meet the table of names.
    """
    x = materialise(lines, "lines")
    body = F.expr(f"substring(line, {len(REFS) + 1})")
    todo = x.where(F.startswith("line", F.lit(REFS)) & ~F.contains("line", F.lit(";"))).select("path", "at", F.filter(F.transform(F.split(body, ","), lambda w: F.trim(w)), lambda w: w != "").alias("parts")).where("size(parts) > 0")
    spans = todo.select("path", "at", "parts", F.explode(F.sequence(F.lit(1), F.size("parts"))).alias("i")).select("path", "at", "parts", "i", F.explode(F.sequence(F.col("i"), F.size("parts"))).alias("j"))
    known = spans.withColumn("name", F.array_join(F.slice("parts", F.col("i"), F.col("j") - F.col("i") + 1), ", ")).join(names.select("name").distinct(), "name", "left_semi")
    held = known.groupBy("path", "at").agg(F.collect_list("name").alias("known"))

    @F.pandas_udf(T.StringType())
    def joined(parts: pd.Series, known: pd.Series) -> pd.Series:
        return pd.Series(["; ".join(kernel.known_spans(", ".join(p), list(k) if k is not None else [])) for p, k in zip(parts, known, strict=True)], index=parts.index)

    new = todo.join(held, ["path", "at"], "left").select("path", "at", F.concat(F.lit(REFS), joined("parts", "known")).alias("new"))
    return x.join(new, ["path", "at"], "left").select("path", "at", F.coalesce("new", "line").alias("line"))


def texts(lines: DataFrame) -> DataFrame:
    """(path, value): the files again; a file's lines are gathered, never several files'."""
    return lines.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("at", "line"))).alias("l")).select("path", F.array_join(F.transform("l", lambda x: x["line"]), "\n").alias("value"))


# The fields of a digest's record that are filled in, from which field of the
# record's own front matter; and the order in which fields are written.
FILLED = {"publisher": "publisher", "medium": "source_type", "duration": "duration", "content_hash": "content_hash"}
RECORD_ORDER = ("id", "title", "producer", "publisher", "date", "medium", "duration", "content_hash", "reference")


def backfilled(records: DataFrame) -> DataFrame:
    """records (key, record map, front map) with record filled in, its keys in order, and added,
    the names of the fields that were empty and are no longer. Known keys come first, then the
    others as they stood. A null front changes nothing."""
    value = lambda m, k: F.when(F.trim(F.try_element_at(F.col(m), F.lit(k))) != "", F.try_element_at(F.col(m), F.lit(k)))
    new = {k: F.when(value("record", k).isNull(), value("front", f)) for k, f in FILLED.items()}
    added = F.array_compact(F.array(*[F.when(c.isNotNull(), F.lit(k)) for k, c in new.items()]))
    present = lambda k: F.coalesce(F.map_contains_key("record", k), F.lit(False))
    entry = lambda k: F.struct(F.lit(k).alias("key"), (F.coalesce(new[k], F.try_element_at("record", F.lit(k))) if k in new else F.try_element_at("record", F.lit(k))).alias("value"))
    known = F.array_compact(F.array(*[F.when(present(k) | (new[k].isNotNull() if k in new else F.lit(False)), entry(k)) for k in RECORD_ORDER]))
    others = F.filter(F.map_entries("record"), lambda e: ~e["key"].isin(*RECORD_ORDER))
    filled = F.map_from_entries(F.concat(known, others))
    return records.withColumns({"added": added, "record": F.when(F.size(added) > 0, filled).otherwise(F.col("record"))})


def live_records(store: DataFrame, names: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """(live, unreached): the records in play, and those of the store that no name leads to.

    store: (content_hash, path, ...) without superseded ones, as of files.store_records; names:
    (name, content_hash), the targets of the folder of names, null where there is none: then
    the whole store is in play. A name without a file in the store leads nowhere.
    """
    if names is None:
        return store, store.limit(0)
    wanted = names.where("content_hash IS NOT NULL").select("content_hash").distinct()
    return store.join(wanted, "content_hash", "left_semi"), store.join(wanted, "content_hash", "left_anti")
