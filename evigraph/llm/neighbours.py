"""The most similar vectors for every vector, by robust-pruned graphs over shards.

A model's vectors are cut into shards around centroids. Each vector lies in the shard of its
nearest centroid and asks that shard and those of the next nearest centroids, so the cost of a
vector doesn't grow with the number of shards. A shard's graph is built and asked in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..common import norm_hash, norm_id
from ..session import materialise
from . import vectorgraph as vg

#: Vectors in one shard, about, and of how many shards a vector is asked at most.
SHARD_ROWS, PROBES = 4096, 6
#: A shard is asked only if a neighbour as far away as allowed may well lie in it: if the plane
#: between the two centroids is no farther than so many standard deviations of such a
#: neighbour's way in one direction.
MARGIN = 1.5
#: Centroids are fitted to a sample of at most so many vectors of a model, and so many for each
#: centroid; collections beyond have larger shards. Every vector is indexed and asked.
FIT_ROWS, FIT_EACH, FIT_ROUNDS = 262_144, 32, 8
#: A shard that is expected to hold so many times the usual is split by hash; all its parts are asked.
SPLIT = 4
#: Different vectors that a task remembers in order not to send them again.
SEEN = 200_000

_NEAR = "array<struct<vid:string,cosine:double>>"


def model_length(model: Column) -> Column:
    """The vector length that a model id states, as the first number of 2 to 4 digits between hyphens."""
    return F.regexp_extract(model, r"(?:^|-)(\d{2,4})(?:-|$)", 1).try_cast("int")


def usable_vectors(text_embeddings: DataFrame) -> DataFrame:
    """(model, text, vid, embedding): the vectors of texts in a model's space, without those that
    are null, of another length than the model's, all zero, or hold null, NaN or infinity.

    A model id without a length goes by its most frequent length. Equal vectors of a model
    share one vid, a hash of 128 bits.
    """
    e = text_embeddings.select(F.trim("model_id").alias("model"), norm_hash("text_hash").alias("text"), "embedding").where("model IS NOT NULL AND text IS NOT NULL AND embedding IS NOT NULL")
    stated = model_length(F.col("model"))
    lengths = e.where(stated.isNull()).groupBy("model", F.size("embedding").alias("d")).agg(F.count("*").alias("n"))
    lengths = lengths.groupBy("model").agg(F.max(F.struct("n", "d")).alias("m")).select("model", F.col("m.d").alias("d"))
    few = {r["model"]: r["d"] for r in lengths.collect()}  # one row per model that states no length
    wanted = F.coalesce(stated, *[F.when(F.col("model") == m, F.lit(d)) for m, d in few.items()])
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    ok = e.where((F.size("embedding") == wanted) & ~bad & some)
    vid = F.concat(F.lpad(F.hex(F.xxhash64("model", "embedding")), 16, "0"), F.lit("-"), F.hex(F.xxhash64(F.lit(1), F.reverse("embedding"), "model")))
    return ok.withColumn("vid", vid)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    a = column.combine_chunks()
    x = a.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(a), -1)
    x /= np.abs(x).max(axis=1, keepdims=True)  # so that no square overflows
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x


def _near_lists(x: np.ndarray, vids: np.ndarray, q: np.ndarray, ids: np.ndarray, k: int, least: float) -> pa.Array:
    """Of each query the k best of its list with cosines in double precision."""
    ids = ids[:, : k + 3]
    cos = np.full(ids.shape, -2.0)
    for i in range(0, len(q), 8192):
        c = ids[i : i + 8192]
        cos[i : i + 8192] = np.where(c >= 0, np.matmul(x[np.maximum(c, 0)], q[i : i + 8192, :, None])[:, :, 0], -2.0)
    order = np.argsort(-cos, axis=1, kind="stable")[:, :k]
    ids, cos = np.take_along_axis(ids, order, 1), np.take_along_axis(cos, order, 1)
    keep = (cos >= least) & (ids >= 0)
    offsets = np.concatenate(([0], np.cumsum(keep.sum(axis=1)))).astype(np.int32)
    items = pa.StructArray.from_arrays([pa.array(vids[ids[keep]], pa.string()), pa.array(cos[keep], pa.float64())], names=["vid", "cosine"])
    return pa.ListArray.from_arrays(pa.array(offsets), items)


@dataclass
class Routes:
    """A model's centroids (unit rows) and into how many parts each one's shard is split."""

    centroids: np.ndarray
    parts: np.ndarray

    def of(self, x: np.ndarray, probes: int, reach: float | None = None) -> np.ndarray:
        """The nearest centroids of unit rows, nearest first; -1 for those whose side of the
        plane between them and the nearest is farther than reach."""
        n = min(probes, len(self.centroids))
        out = np.empty((len(x), n), np.int64)
        for i in range(0, len(x), 4096):
            s = x[i : i + 4096].astype(np.float32) @ self.centroids.T
            top = np.argpartition(-s, n - 1, axis=1)[:, :n]
            near = np.take_along_axis(s, top, 1)
            order = np.argsort(-near, axis=1, kind="stable")
            top, near = np.take_along_axis(top, order, 1), np.take_along_axis(near, order, 1)
            if reach is not None:
                between = np.linalg.norm(self.centroids[top] - self.centroids[top[:, :1]], axis=2)
                top = np.where(near[:, :1] - near <= reach * between + 1e-9, top, -1)
            out[i : i + 4096] = top
        return out


def fitted(x: np.ndarray, rows: int, shard_rows: int, rounds: int = FIT_ROUNDS) -> Routes:
    """Routes by spherical k-means over a sample x (unit rows) of a collection of so many rows."""
    n = max(1, min(-(-rows // shard_rows), -(-len(x) // FIT_EACH)))
    rng = np.random.default_rng(11)
    x = x.astype(np.float32)
    c = x[rng.choice(len(x), n, replace=False)].copy()
    home = np.zeros(len(x), np.int64)
    for _ in range(rounds if n > 1 else 0):
        for i in range(0, len(x), 4096):
            home[i : i + 4096] = (x[i : i + 4096] @ c.T).argmax(1)
        sums = np.zeros_like(c)
        np.add.at(sums, home, x)
        length = np.sqrt((sums * sums).sum(1, keepdims=True))
        c = np.where(length > 1e-6, sums / np.maximum(length, 1e-6), c)
    share = np.bincount(Routes(c, np.ones(n)).of(x, 1)[:, 0], minlength=n) / len(x)
    return Routes(c, np.maximum(1, np.ceil(share * rows / (SPLIT * max(shard_rows, rows / n)))).astype(np.int64))


def routes(vectors: DataFrame, shard_rows: int) -> dict[str, Routes]:
    """The routes of each model; what comes to the driver is a count and a bounded sample per model."""
    counts = {r["model"]: r["n"] for r in vectors.groupBy("model").agg(F.count("*").alias("n")).collect()}
    wanted = {m: min(FIT_ROWS, FIT_EACH * -(-n // shard_rows)) for m, n in counts.items()}
    cut = F.lit(0)
    for m, n in counts.items():
        cut = F.when(F.col("model") == m, F.lit(min(1 << 20, int(1.2 * (1 << 20) * wanted[m] / n) + 1024))).otherwise(cut)
    sample = vectors.where(F.pmod(F.xxhash64(F.lit(5), "vid"), F.lit(1 << 20)) < cut).select("model", "embedding")
    drawn = sample.toArrow()
    out = {}
    for m in counts:
        rows = drawn.filter(pa.compute.equal(drawn.column("model"), m)).column("embedding")[: FIT_ROWS * 2]
        x = _matrix(rows) if len(rows) else None
        # a model so small that the sample missed it is one shard
        out[m] = fitted(x, counts[m], shard_rows) if x is not None else Routes(np.zeros((1, 1), np.float32), np.ones(1, np.int64))
    return out


def sent(batches: Iterator[pa.RecordBatch], of: dict[str, Routes], probes: int, least: float) -> Iterator[pa.RecordBatch]:
    """(model, cell, part, home, vid, embedding): each vector once for its own shard and once for
    every other that it asks. Equal vectors of a task go once."""
    names = ["model", "cell", "part", "home", "vid", "embedding"]
    seen: set[tuple[str, str]] = set()
    for b in batches:
        models, vids = b.column("model").to_pylist(), b.column("vid").to_pylist()
        fresh: dict[str, list[int]] = {}
        for i, k in enumerate(zip(models, vids, strict=True)):
            if k not in seen:
                if len(seen) < SEEN:
                    seen.add(k)
                fresh.setdefault(k[0], []).append(i)
        for m, rows in fresh.items():
            part_of, row = of[m], np.array(rows)
            if len(part_of.centroids) == 1 and part_of.parts[0] == 1:
                cells = np.zeros((len(row), 1), np.int64)
            else:
                x = _matrix(pa.chunked_array([b.column("embedding").take(pa.array(row))]))
                cells = part_of.of(x, probes, MARGIN * float(np.sqrt(max(2 - 2 * least, 0) / x.shape[1])))
            own = np.array([int(vids[i][:8], 16) for i in rows]) % part_of.parts[cells[:, 0]]
            at, cell, part, home = [row], [cells[:, 0]], [own], [np.ones(len(row), bool)]
            for j in range(cells.shape[1]):
                n = part_of.parts[cells[:, j]]
                for p in range(int(n.max())):
                    to = (cells[:, j] >= 0) & (n > p) & ((own != p) if j == 0 else True)
                    at.append(row[to])
                    cell.append(cells[to, j])
                    part.append(np.full(int(to.sum()), p))
                    home.append(np.zeros(int(to.sum()), bool))
            at = np.concatenate(at)
            cols = [pa.array([m] * len(at), pa.string()), pa.array(np.concatenate(cell), pa.int32()), pa.array(np.concatenate(part), pa.int32()), pa.array(np.concatenate(home)), b.column("vid").take(pa.array(at)), b.column("embedding").take(pa.array(at))]
            yield pa.RecordBatch.from_arrays(cols, names=names)


def _answered(k: int, least: float):
    """Of one shard the graph, built of its own vectors, and the nearest of all that ask it."""
    def run(t: pa.Table) -> pa.Table:
        vids, home = np.array(t.column("vid").to_pylist(), dtype=object), t.column("home").to_numpy(zero_copy_only=False).astype(bool)
        first = lambda rows: rows[np.sort(np.unique(vids[rows].astype(str), return_index=True)[1])] if len(rows) else rows
        own, asking = first(np.flatnonzero(home)), first(np.flatnonzero(~home))
        if not len(own):
            own, asking = own, asking[:0]
        vectors, names, near = t.column("embedding"), [], []
        if len(own):
            x = _matrix(vectors.take(pa.array(own)))
            graph, ids, _, trees = vg.build(x.astype(np.float32))
            names.append(vids[own])
            near.append(_near_lists(x, vids[own], x, ids, k, least))
            if len(asking):
                q = _matrix(vectors.take(pa.array(asking)))
                ids, _ = vg.search(x.astype(np.float32), graph, q.astype(np.float32), trees)
                names.append(vids[asking])
                near.append(_near_lists(x, vids[own], q, ids, k, least))
        flat = np.concatenate(names) if names else np.zeros(0, object)
        kind = pa.list_(pa.struct([("vid", pa.string()), ("cosine", pa.float64())]))
        lists = pa.chunked_array(near, kind) if near else pa.array([], kind)
        out = pa.table({"model": pa.array([t.column("model")[0].as_py()] * len(flat), pa.string()), "vid": pa.array(flat, pa.string()), "near": lists})
        return out.filter(pa.compute.greater(pa.compute.list_value_length(out.column("near")), 0))

    return run


def nearest(vectors: DataFrame, k: int = 5, least: float = -1.0, shard_rows: int = SHARD_ROWS, probes: int = PROBES) -> DataFrame:
    """(model, vid, other, cosine): of every distinct vector the k most similar other distinct
    ones of its model, with a cosine of at least `least`.

    vectors: (model, vid, embedding), vid in hexadecimal. Approximate: a vector asks its own
    shard and those of the next centroids, `probes` in all, in which a neighbour of cosine
    `least` may well lie (see MARGIN); in each, greedy searches propose, robust pruning keeps
    diverse edges and a beam search answers. The same path holds for one shard and for many.
    """
    of = vectors.sparkSession.sparkContext.broadcast(routes(vectors, shard_rows))
    asked = vectors.select("model", "vid", "embedding").mapInArrow(lambda b: sent(b, of.value, probes, least), "model string, cell int, part int, home boolean, vid string, embedding array<float>")
    near = asked.groupBy("model", "cell", "part").applyInArrow(_answered(k, least), f"model string, vid string, near {_NEAR}")
    flat = near.select("model", "vid", F.explode("near").alias("n")).select("model", "vid", F.col("n.vid").alias("other"), F.col("n.cosine").alias("cosine"))
    w = W.partitionBy("model", "vid").orderBy(F.desc("cosine"), "other")
    return flat.withColumn("n", F.row_number().over(w)).where(F.col("n") <= k).drop("n")


def similar_ids(embedding_model: DataFrame, text_embeddings: DataFrame, k: int = 5, least: float = 0.85, shard_rows: int = SHARD_ROWS, probes: int = PROBES) -> DataFrame:
    """(model_id, id, other_id, cosine, place): for every claim or node the k most similar other
    ones of the same model, as far as their cosine is at least `least`.

    Ids whose vector is unusable (see usable_vectors) take no part. Ids of equal vectors have
    the cosine 1 and stand for one vector in the index, so a text may belong to any number of
    ids; of such ids those with the smallest ids are named, k of them for each asker, instead
    of all pairs. Ties go to the smaller id. Repeated rows add nothing; if a text has several
    different vectors in one model's space, each counts and a pair has its greatest cosine.
    """
    named = embedding_model.select(norm_id("id").alias("id"), F.trim("model_id").alias("model"), norm_hash("text_hash").alias("text")).where("id IS NOT NULL")
    # vectors that no id refers to take no places among the nearest
    usable = usable_vectors(text_embeddings).join(named.select("model", "text").distinct(), ["model", "text"], "left_semi")
    usable = materialise(usable.select("model", "text", "vid", "embedding"), "usable")
    near = materialise(nearest(usable, k, least, shard_rows, probes), "near")
    ids = materialise(named.distinct().join(usable.select("model", "text", "vid").distinct(), ["model", "text"]).select("model", "vid", "id").distinct(), "ids")
    # of each vector the k + 1 smallest ids; the limit applies before the shuffle as well
    w = W.partitionBy("model", "vid").orderBy("id")
    heads = ids.withColumn("n", F.row_number().over(w)).where(F.col("n") <= k + 1).drop("n").withColumnRenamed("id", "other_id")
    same = ids.join(heads, ["model", "vid"]).where("id <> other_id").select("model", "id", "other_id", F.lit(1.0).alias("cosine"))
    others = near.join(heads.withColumnRenamed("vid", "other"), ["model", "other"]).select("model", "vid", "other_id", "cosine")
    others = ids.join(others, ["model", "vid"]).where("id <> other_id").select("model", "id", "other_id", "cosine")
    pairs = same.unionByName(others).groupBy("model", "id", "other_id").agg(F.max("cosine").alias("cosine"))
    w = W.partitionBy("model", "id").orderBy(F.desc("cosine"), "other_id")
    best = pairs.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)
    return best.select(F.col("model").alias("model_id"), "id", "other_id", "cosine", "place")


def similar_pairs(similar: DataFrame) -> DataFrame:
    """(id_a, id_b), id_a < id_b, distinct, from similar_ids()."""
    return similar.select(F.least("id", "other_id").alias("id_a"), F.greatest("id", "other_id").alias("id_b")).distinct()
