"""Writing briefs, notes, queues and manifests; caches that fill in what is missing."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import safe_filename
from . import yamlish


def write_queue(df: DataFrame, path: str) -> None:
    """df as JSON lines, nulls kept; the commit protocol makes it all or nothing."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def brief_texts(briefs: DataFrame, section: str, slug: str) -> DataFrame:
    """(section, slug, value): each brief (all other columns) as YAML text."""
    body = F.to_json(F.struct(*[c for c in briefs.columns if c not in (section, slug)]), {"ignoreNullFields": "false"})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import json

        for b in batches:
            yield pd.DataFrame({"section": b["section"], "slug": b["slug"], "value": [yamlish.dump(json.loads(j)) for j in b["body"]]})

    return briefs.select(F.col(section).alias("section"), F.col(slug).alias("slug"), body.alias("body")).mapInPandas(run, "section string, slug string, value string")


def write_texts(texts: DataFrame, path: str, by: list[str]) -> None:
    """(by..., value) as text files in folders by=..."""
    texts.write.mode("overwrite").partitionBy(*by).text(path)


def vault_notes(notes: DataFrame) -> DataFrame:
    """(folder, file, value) of (node_type, name, body): one Markdown note a name."""
    head = F.concat(F.lit("# "), "name", F.lit("\n\n"))
    return notes.select(F.col("node_type").alias("folder"), F.concat(safe_filename("name"), F.lit(".md")).alias("file"), F.concat(head, "body").alias("value"))


def manifest(parts: dict[str, DataFrame], at: str) -> DataFrame:
    """One row: when, and of each part its rows and a digest of its contents."""
    from ..operators.reconcile import state_hash

    out = None
    for name, df in parts.items():
        h = state_hash(df, name)
        out = h if out is None else out.unionByName(h)
    return out.withColumn("at", F.lit(at))


def fresh(df: DataFrame, at: str, now: str, hours: float = 6.0) -> DataFrame:
    """df's rows whose time `at` is at most so many hours before now."""
    from ..common import parse_utc

    age = (F.unix_micros(parse_utc(F.lit(now))) - F.unix_micros(parse_utc(at))) / F.lit(3_600_000_000)
    return df.where(age <= hours)


def fill_cache(texts: DataFrame, cache: DataFrame | None, model: str, embed: Callable[[list[str]], list[list[float]]], batch: int = 64) -> DataFrame:
    """(text_hash, model_id, embedding) of the texts that the cache lacks, by an injected embedder.

    Keyed by text and model, never by text alone; each distinct text is embedded once.
    """
    want = texts.select(F.sha2("text", 256).alias("text_hash"), F.lit(model).alias("model_id"), "text").where("text IS NOT NULL").dropDuplicates(["text_hash"])
    if cache is not None:
        want = want.join(cache.select("text_hash", "model_id"), ["text_hash", "model_id"], "left_anti")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for i in range(0, len(b), batch):
                part = b.iloc[i : i + batch]
                yield pd.DataFrame({"text_hash": part["text_hash"], "model_id": part["model_id"], "embedding": embed(part["text"].tolist())})

    return want.select("text_hash", "model_id", "text").mapInPandas(run, "text_hash string, model_id string, embedding array<float>")


def dequantised(vector: str, low: float, high: float):
    """Byte components as floats between low and high."""
    return F.transform(vector, lambda v: v.cast("float") * F.lit((high - low) / 255).cast("float") + F.lit(low).cast("float"))


class Stale(RuntimeError):
    """A manifest is too old to act on."""


def require_fresh(manifest: DataFrame, now: str, at: str = "at", hours: float = 6.0) -> DataFrame:
    """The manifest, or Stale if it has no row that is fresh()."""
    if fresh(manifest, at, now, hours).isEmpty():
        raise Stale(f"nothing in the manifest is younger than {hours} hours")
    return manifest


def new_events(events: DataFrame, ledger: DataFrame, ident: str = "id") -> tuple[DataFrame, DataFrame]:
    """(to append, collisions): of events those whose id the ledger doesn't hold.

    An event that stands there word by word is left out, so that appending twice adds nothing;
    one whose id stands there, or among the events, with other contents is a collision and
    isn't appended. Both tables have the same columns.
    """
    body = lambda df: df.withColumn("_h", F.sha2(F.to_json(F.struct(*sorted(c for c in df.columns if c != ident)), {"ignoreNullFields": "false"}), 256))
    e, held = body(events.where(F.col(ident).isNotNull())), body(ledger).select(ident, F.col("_h").alias("_was")).distinct()
    several = e.groupBy(ident).agg((F.countDistinct("_h") > 1).alias("_several"))
    x = e.join(held.groupBy(ident).agg(F.collect_set("_was").alias("_was")), ident, "left").join(several, ident)
    clash = F.col("_several") | (F.col("_was").isNotNull() & ~(F.array_contains("_was", F.col("_h")) & (F.size("_was") == 1)))
    fresh_ones = x.where(F.col("_was").isNull() & ~F.col("_several")).dropDuplicates([ident]).select(*events.columns)
    return fresh_ones, x.where(clash).select(*events.columns).distinct()


def append_events(events: DataFrame, path: str, ident: str = "id", order: str = "at") -> DataFrame:
    """Appends to a ledger of YAML documents what new_events() lets through; returns the collisions.

    Each run adds one file, in the order of `order` and id; readers take the files together.
    One writer at a time.
    """
    spark = events.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    ledger = events.limit(0)
    if fs.exists(hadoop):
        from .files import ledger as read

        ledger = read(spark, path).select(F.from_json("event", events.schema).alias("e")).select("e.*")
    add, collisions = new_events(events, ledger, ident)
    from ..session import materialise

    collisions = materialise(collisions, "collisions")
    body = F.to_json(F.struct(*events.columns), {"ignoreNullFields": "false"})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import json

        for b in batches:
            yield pd.DataFrame({"value": ["---\n" + yamlish.dump(json.loads(j)).rstrip("\n") for j in b["body"]]})

    add.orderBy(order, ident).select(body.alias("body")).coalesce(1).mapInPandas(run, "value string").write.mode("append").text(path)
    return collisions
