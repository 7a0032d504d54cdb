"""Pairs: shingle overlap of texts, nearest vectors, similarity profiles and cut calibration."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..session import materialise

SHINGLE, JACCARD, CONTAINMENT = 5, 0.6, 0.9
#: Sets that hold one shingle for which one task is meant, and the most tasks for a shingle.
HOT, MOST_SALTS = 10_000, 256


def text_words(c: str | Column) -> Column:
    x = F.col(c) if isinstance(c, str) else c
    return F.regexp_extract_all(F.lower(x), F.lit(r"(?U)(\w+)"), F.lit(1))


def shingle_set(words: str, size: int = SHINGLE) -> Column:
    """Of a column of words the distinct runs of `size` as hashes; fewer words are one shingle, none is none.

    words must be a column, not an expression: the lambda would compute it for each run.
    """
    w = F.col(words)
    n = F.size(w)
    runs = F.transform(F.sequence(F.lit(1), F.greatest(n - (size - 1), F.lit(1))), lambda i: F.xxhash64(F.concat_ws(" ", F.slice(w, i, size))))
    return F.when(n > 0, F.array_distinct(runs)).otherwise(F.array().cast("array<bigint>"))


def overlapping(texts: DataFrame, jaccard: float = JACCARD, containment: float = CONTAINMENT, key: str = "id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(pairs, membership): near-duplicate texts by shingles.

    membership (key, rep): texts with equal shingle sets are one class, its smallest key stands
    for it. pairs (a, b, jaccard, containment, shared) are between representatives with a
    Jaccard of at least `jaccard` or a containment of at least `containment`. Exact.

    Prefix filter: shingles are ordered from rare to frequent; two sets that overlap as much
    as asked share one of their first few. Containment against a much larger set needs that
    set's whole list on one side, so the larger side keeps all of its rare shingles and the
    smaller side the prefix. Frequent shingles are thus asked by few sets, and spread by those
    that hold them.
    """
    words = texts.where(F.col(key).isNotNull()).select(F.col(key).alias("id"), text_words(text).alias("w"))
    # the filter is on w: one on s would be pushed down and take the lambda's input with it
    sets = words.where(F.size("w") > 0).select("id", shingle_set("w").alias("s"))
    marks = materialise(sets.select("id", F.xxhash64(F.array_sort("s")).alias("sig"), F.size("s").alias("n")), "marks")
    rep = marks.groupBy("sig", "n").agg(F.min("id").alias("rep"))
    membership = marks.join(rep, ["sig", "n"]).select("id", "rep")
    chosen = rep.select(F.col("rep").alias("id"))
    first = texts.join(chosen.withColumnRenamed("id", key), key, "left_semi").dropDuplicates([key]).select(F.col(key).alias("id"), text_words(text).alias("w"))
    reps = materialise(first.where(F.size("w") > 0).select("id", shingle_set("w").alias("s")).withColumn("n", F.size("s")), "sets")
    each = reps.select("id", "n", F.explode("s").alias("h"))
    df = each.groupBy("h").agg(F.count("*").alias("df")).where("df > 1")
    shared = materialise(each.join(df, "h"), "shared")  # shingles of one set alone can't make a pair
    w = W.partitionBy("id").orderBy("df", "h")
    # of n shingles, n - ceil(c n) + 1 rarest must hold one that is shared when c n are; unshared ones come first and cost places
    lone = shared.groupBy("id").agg(F.count("*").alias("kept"))
    placed = shared.join(lone, "id").withColumn("place", F.row_number().over(w) + F.col("n") - F.col("kept"))
    least = min(jaccard, containment)
    prefix = placed.where(F.col("place") <= F.col("n") - F.ceil(F.col("n") * least) + 1)
    # a shingle that many sets hold is spread by the sets that hold it
    salts = F.least(F.ceil(F.col("df") / HOT), F.lit(MOST_SALTS)).cast("int")
    a = prefix.select(F.col("id").alias("p"), F.col("n").alias("pn"), "h", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"))
    b = shared.select(F.col("id").alias("q"), F.col("n").alias("qn"), "h", F.pmod(F.xxhash64("id"), salts).cast("int").alias("salt"))
    candidates = a.join(b, ["h", "salt"]).where("p <> q AND (pn < qn OR (pn = qn AND p < q))").select("p", "q").distinct()
    x = candidates.join(reps.select(F.col("id").alias("p"), F.col("s").alias("ps"), F.col("n").alias("pn")), "p").join(reps.select(F.col("id").alias("q"), F.col("s").alias("qs"), F.col("n").alias("qn")), "q")
    x = x.withColumn("shared", F.size(F.array_intersect("ps", "qs")))
    j, c = F.col("shared") / (F.col("pn") + F.col("qn") - F.col("shared")), F.col("shared") / F.least("pn", "qn")
    pairs = x.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b"), j.alias("jaccard"), c.alias("containment"), "shared").where((F.col("jaccard") >= jaccard) | (F.col("containment") >= containment))
    return pairs, membership


def same_origin(records: DataFrame, key: str = "id", text: str = "text") -> DataFrame:
    """(a, b, field), a < b: records that state one source_url or source_id in their front matter,
    or anywhere if they have none; a stands for all that state the value.

    Values are compared as they are written, without quotes around them. Records that something
    supersedes take no part; null texts state nothing.
    """
    front = F.regexp_extract(F.col(text), r"(?s)\A---\n(.*?)\n---", 1)
    head = records.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(F.col(key).alias("id"), F.when(front != "", front).otherwise(F.col(text)).alias("head")).where(~F.col("head").rlike(r"(?m)^superseded_by:\s*\S"))
    lines = head.select("id", F.explode(F.regexp_extract_all("head", F.lit(r"(?m)^((?:source_url|source_id):\s*.+)$"), F.lit(1))).alias("l"))
    value = F.trim(F.regexp_replace(F.trim(F.regexp_replace("l", r"^\w+:", "")), '^"+|"+$', ""))
    said = lines.select("id", F.substring_index("l", ":", 1).alias("field"), value.alias("value")).where("value <> ''").distinct()
    first = said.groupBy("field", "value").agg(F.min("id").alias("a"), F.count("*").alias("n")).where("n > 1")
    return said.join(first, ["field", "value"]).where("id <> a").select("a", F.col("id").alias("b"), "field").distinct()


def _unit(s: pd.Series) -> np.ndarray:
    m = np.array(s.tolist(), dtype=np.float64)
    norm = np.sqrt((m * m).sum(axis=1, keepdims=True))
    return np.divide(m, norm, out=np.zeros_like(m), where=norm > 0)


def _in_blocks(vectors: DataFrame, work, schema: str, block: int, both_ways: bool) -> DataFrame:
    """work(left, right, cosines of a stripe) over all pairs of blocks; its frames are the result.

    vectors: (id, grp, embedding), equal lengths, any further columns come along. Rows are cut
    into blocks of about `block` by hash; each pair of blocks is one task, so the work is spread
    and nothing is collected. both_ways asks each pair of rows from either side; else a pair of
    rows comes once (left id < right id). Cosines are at 9 decimals, those of a vector without
    length 0, and -2 for a row with itself and for pairs that don't count.
    """
    n = vectors.count()
    parts = max(1, -(-n // block))
    more = [c for c in vectors.columns if c not in ("id", "grp", "embedding")]
    v = vectors.select("id", F.col("grp").cast("string").alias("grp"), F.col("embedding").cast("array<double>").alias("embedding"), *more, F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int").alias("part"))
    v = materialise(v, "vectors")
    upto = lambda low: F.explode(F.sequence(low, F.lit(parts - 1)))
    left = v.withColumnRenamed("part", "x").withColumn("y", upto(F.lit(0) if both_ways else F.col("x")))
    right = v.withColumnRenamed("part", "y").withColumn("x", F.explode(F.sequence(F.lit(0), F.lit(parts - 1) if both_ways else F.col("y"))))
    # columns of their own, so that the two sides of the cogroup aren't mixed up
    right = right.select(F.col("x").alias("x"), F.col("y").alias("y"), *[F.col(c).alias(c) for c in v.columns if c != "part"])
    names = [f.split()[0] for f in schema.split(", ")]

    def run(q: pd.DataFrame, t: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(q) and len(t):
            same = not both_ways and q["x"].iloc[0] == q["y"].iloc[0]
            t = t.sort_values("id", kind="stable").reset_index(drop=True)
            tv, ids = _unit(t["embedding"]), t["id"].to_numpy()
            for i in range(0, len(q), 1024):
                part = q.iloc[i : i + 1024]
                s = np.round(_unit(part["embedding"]) @ tv.T, 9)
                mine = part["id"].to_numpy()[:, None]
                s[(mine >= ids[None, :]) if same else (mine == ids[None, :])] = -2
                out.append(work(part, t, s))
        return pd.concat(out)[names] if out else pd.DataFrame({c: pd.Series(dtype=object) for c in names})

    return left.groupBy("x", "y").cogroup(right.groupBy("x", "y")).applyInPandas(run, schema)


def cosine_pairs(vectors: DataFrame, k: int, least: float = -1.0, block: int = 4096, other_group: bool = False) -> DataFrame:
    """(id, other, cosine, place): exact k nearest of each vector, by blocks of a matrix product.

    vectors: (id, grp, embedding). Of each pair of blocks the k best of a row go on. Vectors
    without length take part with cosine 0. other_group leaves out rows of the query's own grp.
    """
    kind = vectors.schema["id"].dataType.simpleString()

    def work(q: pd.DataFrame, t: pd.DataFrame, s: np.ndarray) -> pd.DataFrame:
        if other_group:
            s[q["grp"].to_numpy()[:, None] == t["grp"].to_numpy()[None, :]] = -2
        top = np.argsort(-s, axis=1, kind="stable")[:, :k]
        sim = np.take_along_axis(s, top, 1)
        r, c = np.nonzero((sim >= least) & (sim > -2))
        return pd.DataFrame({"id": q["id"].to_numpy()[r], "other": t["id"].to_numpy()[top[r, c]], "cosine": sim[r, c]})

    near = _in_blocks(vectors, work, f"id {kind}, other {kind}, cosine double", block, True)
    w = W.partitionBy("id").orderBy(F.desc("cosine"), "other")
    return near.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)


def cosine_histogram(vectors: DataFrame, block: int = 4096) -> DataFrame:
    """(cut, p, n): how many pairs of one grp and of different ones have each cosine at 6 decimals.

    Pairs are counted inside their blocks; at most 2 million rows a pair of blocks go on, not the pairs.
    """
    def work(q: pd.DataFrame, t: pd.DataFrame, s: np.ndarray) -> pd.DataFrame:
        ok = s > -2
        same = (q["grp"].to_numpy()[:, None] == t["grp"].to_numpy()[None, :])[ok]
        cut, at = np.unique(np.round(s[ok], 6), return_inverse=True)
        p = np.bincount(at[same], minlength=len(cut))
        return pd.DataFrame({"cut": cut, "p": p, "n": np.bincount(at, minlength=len(cut)) - p})

    h = _in_blocks(vectors, work, "cut double, p bigint, n bigint", block, False)
    return h.groupBy((F.col("cut") + F.lit(0.0)).alias("cut")).agg(F.sum("p").alias("p"), F.sum("n").alias("n"))


def cut_counts(vectors: DataFrame, cut: float, block: int = 4096) -> DataFrame:
    """cut_report() over all pairs of vectors, as one grp or not; a pair of blocks gives one row a stripe."""
    def work(q: pd.DataFrame, t: pd.DataFrame, s: np.ndarray) -> pd.DataFrame:
        ok = s > -2
        same = q["grp"].to_numpy()[:, None] == t["grp"].to_numpy()[None, :]
        y, f = s[ok & same], s[ok & ~same]
        return pd.DataFrame({"low": [y.min() if len(y) else None], "high": [f.max() if len(f) else None], "kept": [int((y >= cut).sum())], "missed": [int((y < cut).sum())], "false_links": [int((f >= cut).sum())]}).astype({"low": float, "high": float})

    c = _in_blocks(vectors, work, "low double, high double, kept bigint, missed bigint, false_links bigint", block, False)
    number = lambda x: F.when(~F.isnan(x), F.col(x))
    return c.agg(F.round(F.min(number("low")) - F.max(number("high")), 9).alias("separation"), *[F.coalesce(F.sum(x), F.lit(0)).alias(x) for x in ("kept", "missed", "false_links")])


def rank_of_first_match(vectors: DataFrame, block: int = 4096) -> DataFrame:
    """(id, rank): where the nearest vector of the own grp stands among all others: 1 + those nearer.

    Two rounds over the blocks: the best of the own grp, then the count of nearer ones; a row of
    a pair of blocks gives one row each time. Vectors alone in their grp have no row.
    """
    kind = vectors.schema["id"].dataType.simpleString()

    def first(q: pd.DataFrame, t: pd.DataFrame, s: np.ndarray) -> pd.DataFrame:
        best = np.where(q["grp"].to_numpy()[:, None] == t["grp"].to_numpy()[None, :], s, -2).max(axis=1)
        return pd.DataFrame({"id": q["id"].to_numpy()[best > -2], "best": best[best > -2]})

    def nearer(q: pd.DataFrame, t: pd.DataFrame, s: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame({"id": q["id"].to_numpy(), "nearer": (s > q["best"].to_numpy()[:, None]).sum(axis=1)})

    best = _in_blocks(vectors, first, f"id {kind}, best double", block, True).groupBy("id").agg(F.max("best").alias("best"))
    # every vector is compared, those without a match count for others only
    x = vectors.select("id", "grp", "embedding").join(materialise(best, "best"), "id", "left").withColumn("best", F.coalesce("best", F.lit(9.0)))
    n = _in_blocks(x, nearer, f"id {kind}, nearer bigint", block, True).groupBy("id").agg(F.sum("nearer").alias("nearer"))
    return n.join(x.where("best < 9").select("id"), "id", "left_semi").select("id", (1 + F.col("nearer")).alias("rank"))


def similar_groups(vectors: DataFrame, least: float, block: int = 4096) -> DataFrame:
    """(id, component): vectors that chains of cosines of at least `least` tie together.

    Of the pairs inside two blocks only a spanning forest goes on, at most one edge a row.
    """
    from .cluster import components

    kind = vectors.schema["id"].dataType.simpleString()

    def work(q: pd.DataFrame, t: pd.DataFrame, s: np.ndarray) -> pd.DataFrame:
        a, b = q["id"].to_numpy(), t["id"].to_numpy()
        root: dict = {}

        def find(x):
            while root.setdefault(x, x) != x:
                root[x] = x = root[root[x]]
            return x

        edges = []
        for i, j in zip(*np.nonzero(s >= least), strict=True):
            x, y = find(a[i]), find(b[j])
            if x != y:
                root[x] = y
                edges.append((a[i], b[j]))
        return pd.DataFrame(edges, columns=["a", "b"], dtype=object)

    return components(_in_blocks(vectors, work, f"a {kind}, b {kind}", block, False), vectors.select("id"))


def similarity_profile(pairs: DataFrame, cuts: tuple[float, ...], c: str = "cosine") -> DataFrame:
    """One row: n, max, median, min and how many pairs reach each cut."""
    at = [F.sum(F.when(F.col(c) >= x, 1).otherwise(0)).alias(f"at_{int(round(x * 100))}") for x in cuts]
    return pairs.agg(F.count("*").alias("n"), F.max(c).alias("max"), F.median(c).alias("median"), F.min(c).alias("min"), *at)


def score_histogram(scored: DataFrame, score: str = "score", label: str = "same") -> DataFrame:
    """(cut, p, n): how many true and false pairs have each score at 6 decimals."""
    return scored.groupBy(F.round(score, 6).alias("cut")).agg(F.sum(F.col(label).cast("int")).alias("p"), F.sum((~F.col(label)).cast("int")).alias("n"))


def best_cut(histogram: DataFrame) -> DataFrame:
    """(cut, kept, missed, false_links, balanced_accuracy): the score that parts pairs best.

    histogram: (cut, p, n), as of score_histogram() or cosine_histogram(). Every score is a cut
    (score >= cut links); the lowest of equally good ones wins. Counts run over the cuts, of
    which scores between -1 and 1 have 2 million at most.
    """
    g = materialise(histogram, "histogram")
    w = W.orderBy(F.desc("cut")).rowsBetween(W.unboundedPreceding, 0)
    t = g.agg(F.sum("p").alias("tp"), F.sum("n").alias("tn"))
    x = g.withColumns({"kept": F.sum("p").over(w), "false_links": F.sum("n").over(w)}).join(F.broadcast(t))  # one row
    acc = (F.try_divide(F.col("kept"), F.col("tp")) + 1 - F.coalesce(F.try_divide(F.col("false_links"), F.col("tn")), F.lit(0.0))) / 2
    x = x.select("cut", "kept", (F.col("tp") - F.col("kept")).alias("missed"), "false_links", F.round(acc, 9).alias("balanced_accuracy"))
    return x.orderBy(F.desc("balanced_accuracy"), "cut").limit(1)


def record_pairs(near: DataFrame, group_of: DataFrame, top: int = 15) -> DataFrame:
    """(a, b, hits, claims, place): records by how many of their claims are near to another's.

    near: (id, other, ...); group_of: (id, grp). Directed: a's claims that hit b's.
    """
    x = near.join(group_of.select(F.col("id"), F.col("grp").alias("a")), "id").join(group_of.select(F.col("id").alias("other"), F.col("grp").alias("b")), "other").where("a <> b")
    hits = x.groupBy("a", "b").agg(F.count("*").alias("hits"), F.countDistinct("id").alias("claims"))
    w = W.partitionBy("a").orderBy(F.desc("hits"), "b")
    return hits.withColumn("place", F.row_number().over(w)).where(F.col("place") <= top)


def centroids(vectors: DataFrame, by: str = "grp") -> DataFrame:
    """(by, centroid): the mean vector of each group, summed position by position."""
    x = vectors.select(by, F.posexplode("embedding").alias("i", "x")).groupBy(by, "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    return x.groupBy(by).agg(F.array_sort(F.collect_list(F.struct("i", F.round("x", 9).alias("x")))).alias("c")).select(by, F.transform("c", lambda s: s["x"]).alias("centroid"))


def cut_report(scored: DataFrame, cut: float, score: str = "score", label: str = "same") -> DataFrame:
    """One row: separation (least score of true pairs - greatest of false ones), and what a cut
    keeps, misses and links falsely."""
    s, y = F.col(score), F.col(label)
    n = lambda c: F.sum(F.when(c, 1).otherwise(0))
    return scored.agg(
        F.round(F.min(F.when(y, s)) - F.max(F.when(~y, s)), 9).alias("separation"), n(y & (s >= cut)).alias("kept"), n(y & (s < cut)).alias("missed"), n(~y & (s >= cut)).alias("false_links")
    )


def rank_of(near: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, rank): where the best wanted pair of each id stands: 1 + the pairs with a greater cosine.

    near: (id, other, cosine); wanted: (id, other).
    """
    best = near.join(wanted, ["id", "other"]).groupBy("id").agg(F.max("cosine").alias("best"))
    return near.join(best, "id").groupBy("id").agg((1 + F.sum((F.col("cosine") > F.col("best")).cast("int"))).alias("rank"))
