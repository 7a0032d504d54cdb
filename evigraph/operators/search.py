"""Keyword, vector and hybrid search, rank fusion and retrieval metrics."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

RRF_K, KEYWORD_BOOST = 60, 0.25
# Words that a query drops unless it has no others.
STOP_WORDS = frozenset(
    "the is at in on of to for an and or it by do does did was were be been has have had what when where who how which that this with from are not no any all some can will about his her their my its as".split()
)


def query_tokens(query: str) -> list[str]:
    """The query's words of two letters or more in lower case, stop words left out unless there are only those."""
    words = [w.lower() for w in re.split(r"[\"'\s,;:!?.()]+", query) if len(w) > 1]
    return [w for w in words if w not in STOP_WORDS] or words


def idf_weights(texts: DataFrame, tokens: Sequence[str], text: str = "content") -> list[float]:
    """ln(1 + N / (1 + df)) of each token, df by substring; one pass, one row."""
    low = F.lower(text)
    aggs = [F.sum(F.when(low.like(f"%{t}%"), 1).otherwise(0)).alias(f"t{i}") for i, t in enumerate(tokens)]
    row = texts.agg(F.count("*").alias("n"), *aggs).select(*[F.log(1 + F.col("n") / (1 + F.coalesce(F.col(f"t{i}"), F.lit(0)))).alias(f"w{i}") for i in range(len(tokens))]).first()
    return [float(x) for x in row]


def keyword_search(texts: DataFrame, query: str, limit: int | None = 30, key: str = "id", text: str = "content") -> DataFrame:
    """(key, score): the weighted share of the query's tokens that a text contains, best first, ties by key."""
    tokens = query_tokens(query)
    weights = idf_weights(texts, tokens, text) if tokens else []
    low = F.lower(text)
    hit = [low.like(f"%{t}%") for t in tokens]
    if not tokens or not sum(weights):
        return texts.select(key, F.lit(0.0).alias("score")).where(F.lit(False))
    total = F.lit(0.0)
    anyhit = F.lit(False)
    for h, w in zip(hit, weights, strict=True):
        total, anyhit = total + F.when(h, F.lit(w)).otherwise(F.lit(0.0)), anyhit | h
    out = texts.where(anyhit).select(key, F.round(total / F.lit(sum(weights)), 9).alias("score"))
    out = out.orderBy(F.desc("score"), F.asc(key))
    return out.limit(limit) if limit else out


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays, 0 where either has no length."""
    n = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(n == 0, F.lit(0.0)).otherwise(dot(a, b) / n)


def vector_search(vectors: DataFrame, query: Sequence[float], limit: int | None = 10, key: str = "id", vector: str = "embedding") -> DataFrame:
    """(key, distance): the nearest by cosine distance, ties by key; exact, one scan."""
    q = F.array(*[F.lit(float(x)) for x in query])
    out = vectors.where(F.size(vector) == len(query)).select(key, F.round(1 - cosine(F.col(vector), q), 9).alias("distance")).orderBy("distance", key)
    return out.limit(limit) if limit else out


def ranked(df: DataFrame, key: str, order: list[Column], limit: int) -> DataFrame:
    """(key, rank) of the first rows; the input is cut to limit before the window sees it."""
    cut = df.orderBy(*order).limit(limit)
    return cut.withColumn("rank", F.row_number().over(W.orderBy(*order))).select(key, "rank")


def rrf(lists: Sequence[DataFrame], key: str = "id", k: int = RRF_K) -> DataFrame:
    """(key, rrf): the sum of 1 / (k + rank) over ranked lists (key, rank)."""
    out = None
    for x in lists:
        out = x.select(key, "rank") if out is None else out.unionByName(x.select(key, "rank"))
    return out.groupBy(key).agg(F.round(F.sum(1 / (F.lit(float(k)) + F.col("rank"))), 12).alias("rrf"))


def hybrid_search(texts: DataFrame, vectors: DataFrame, query: str, embedding: Sequence[float], limit: int = 10, rerank: Callable[[list[tuple[str, str]]], list[float]] | None = None) -> DataFrame:
    """(id, distance): keyword and vector search fused by reciprocal ranks.

    The fusion chooses the pool; its order is 1 - (cosine + 0.25 x keyword share). A keyword
    hit outside the vector list gets its true cosine, 0 without a vector. Without keyword hits
    the vector list stands. rerank, an injected scorer of (query, text) pairs, reorders a
    larger pool by its logistic score.
    """
    pool = max(2 * limit, 50) if rerank else limit
    sem = vector_search(vectors, embedding, pool)
    kw = keyword_search(texts, query, pool)
    if kw.isEmpty():
        best = sem
    else:
        lists = [ranked(sem, "id", [F.asc("distance"), F.asc("id")], pool), ranked(kw, "id", [F.desc("score"), F.asc("id")], pool)]
        chosen = rrf(lists).orderBy(F.desc("rrf"), "id").limit(pool)
        q = F.array(*[F.lit(float(x)) for x in embedding])
        with_vector = vectors.join(F.broadcast(chosen.select("id")), "id", "left_semi").where(F.size("embedding") == len(embedding)).groupBy("id").agg(F.max(cosine(F.col("embedding"), q)).alias("cos"))
        x = chosen.join(with_vector, "id", "left").join(kw, "id", "left")
        best = x.select("id", F.round(1 - (F.coalesce("cos", F.lit(0.0)) + KEYWORD_BOOST * F.coalesce("score", F.lit(0.0))), 9).alias("distance"))
    if rerank:
        best = rerank_pool(best.join(texts.select("id", "content"), "id"), query, rerank)
    return best.orderBy("distance", "id").limit(limit)


def rerank_pool(pool: DataFrame, query: str, score: Callable[[list[tuple[str, str]]], list[float]]) -> DataFrame:
    """(id, distance) by an injected pair scorer, in Arrow batches: 1 - 1 / (1 + exp(-score))."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            s = pd.Series(score([(query, t) for t in b["content"]]), dtype=float).clip(-700, 700)
            yield pd.DataFrame({"id": b["id"], "distance": (1 - 1 / (1 + (-s).map(__import__("math").exp))).round(9)})

    return pool.select("id", "content").mapInPandas(run, "id string, distance double")


def retrieval_metrics(ranking: DataFrame, relevance: DataFrame, k: int = 10) -> DataFrame:
    """(query, ndcg, mrr, recall) at k. ranking: (query, id, rank); relevance: (query, id, gain > 0)."""
    hits = ranking.where(F.col("rank") <= k).join(relevance, ["query", "id"])
    got = hits.groupBy("query").agg(F.sum(F.col("gain") / F.log2(F.col("rank") + 1.0)).alias("dcg"), (1 / F.min("rank")).alias("mrr"), F.count("*").alias("found"))
    w = W.partitionBy("query").orderBy(F.desc("gain"), "id")
    ideal = relevance.withColumn("r", F.row_number().over(w)).groupBy("query").agg(F.sum(F.when(F.col("r") <= k, F.col("gain") / F.log2(F.col("r") + 1.0))).alias("best"), F.count("*").alias("n"))
    x = ideal.join(got, "query", "left")
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return x.select("query", F.round(zero(F.col("dcg") / F.col("best")), 9).alias("ndcg"), F.round(zero(F.col("mrr")), 9).alias("mrr"), F.round(zero(F.col("found") / F.col("n")), 9).alias("recall"))
