"""One ranking from several scores of different scales, by Gaussian ranks."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..common import broadcast_checked, with_position
from ..session import materialise

# The published coefficients of Acklam's rational approximation of the
# inverse normal distribution (relative error below 1.15e-9).
A = (-3.969683028665376e01, 2.209460984245205e02, -2.759285104469687e02, 1.383577518672690e02, -3.066479806614716e01, 2.506628277459239e00)
B = (-5.447609879822406e01, 1.615858368580409e02, -1.556989798598866e02, 6.680131188771972e01, -1.328068155288572e01)
C = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e00, -2.549732539343734e00, 4.374664141464968e00, 2.938163982698783e00)
D = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e00, 3.754408661907416e00)
#: Below this probability the tail's formula holds.
TAIL = 0.02425


def _poly(x, coefs):
    out = F.lit(coefs[0])
    for c in coefs[1:]:
        out = out * x + F.lit(c)
    return out


def probit(p: Column) -> Column:
    """The inverse of the standard normal distribution for 0 < p < 1."""
    one = F.lit(1.0)
    q = F.sqrt(F.lit(-2.0) * F.log(F.least(p, one - p)))
    tail = _poly(q, C) / (_poly(q, D) * q + one)
    m = p - F.lit(0.5)
    r = m * m
    middle = _poly(r, A) * m / (_poly(r, B) * r + one)
    return F.when(p < TAIL, tail).when(p > 1 - TAIL, -tail).otherwise(middle)


def percentiles(df: DataFrame, score: str, pieces: int | None = None) -> DataFrame:
    """(value, p): of each distinct finite or infinite value its empirical percentile.

    Ties share their average rank: p = (rows below + rows equal / 2) / rows. Null and NaN
    have no percentile. Values are counted before anything is sorted, so a tie may hold any
    share of the rows; the distinct values are ranked in pieces cut at approximate quantiles,
    and a piece's rows below come from the pieces' totals (at most pieces + 1 rows). The number
    of pieces, by default one for half a million distinct values, changes no result.
    """
    v = df.select((F.col(score).cast("double") + F.lit(0.0)).alias("value")).where(F.col("value").isNotNull() & ~F.isnan("value"))
    counts = materialise(v.groupBy("value").agg(F.count("*").alias("n")), "counts")
    pieces = pieces or min(2000, 8 + counts.count() // 500_000)
    cuts = counts.agg(F.percentile_approx("value", [i / pieces for i in range(1, pieces)], 1000).alias("q")).first()["q"] or []
    cuts = sorted({c for c in cuts if math.isfinite(c)})
    piece = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c < F.col("value"))) if cuts else F.lit(0)
    cut = counts.withColumn("piece", piece)
    totals = cut.groupBy("piece").agg(F.sum("n").alias("rows")).orderBy("piece").collect()  # at most pieces + 1 rows
    n, below = 0, []
    for r in totals:
        below.append((r["piece"], n))
        n += r["rows"]
    start = F.broadcast(df.sparkSession.createDataFrame(below, "piece int, start long"))
    w = W.partitionBy("piece").orderBy("value").rowsBetween(W.unboundedPreceding, -1)
    under = F.col("start") + F.coalesce(F.sum("n").over(w), F.lit(0))
    return cut.join(start, "piece").select("value", ((under + F.col("n") / F.lit(2.0)) / F.lit(float(max(n, 1)))).alias("p"))


def gaussian_rank_fusion(df: DataFrame, key: str, weights: dict[str, float]) -> DataFrame:
    """One row per key, best first: key, evidence_rank, fused and z_<score> of each score.

    Each score becomes its percentile (ties averaged), then the standard normal value at that
    percentile; fused is the weighted mean over the scores that a row has, at 9 decimals.
    A null or NaN score takes no part in its row's mean; a row without any score has a null
    fused and comes last. Infinite scores rank as the extremes they are. Ties of fused are
    broken by key, nulls of which are left out; of several rows of one key one counts
    (the greatest scores). Columns beside key and scores are dropped. An empty input gives
    an empty ranking.
    """
    names = list(weights)
    finite = lambda c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double") + F.lit(0.0))
    rows = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(*[F.max(finite(c)).alias(c) for c in names])
    rows = materialise(rows, "scores")
    out = rows
    for c in names:
        z = percentiles(rows, c).select(F.col("value").alias(c), probit(F.col("p")).alias(f"z_{c}"))
        # most rows may share one value: the few values are sent to them where they are few indeed
        out = out.join(broadcast_checked(z), c, "left")
    here = [F.when(F.col(f"z_{c}").isNotNull(), F.lit(float(w))).otherwise(F.lit(0.0)) for c, w in weights.items()]
    parts = [F.coalesce(F.col(f"z_{c}") * F.lit(float(w)), F.lit(0.0)) for c, w in weights.items()]
    total, weight = parts[0], here[0]
    for x, y in zip(parts[1:], here[1:], strict=True):
        total, weight = total + x, weight + y
    fused = F.when(weight > 0, F.round(total / weight, 9))
    out = out.select("_key", fused.alias("fused"), *[F.round(f"z_{c}", 9).alias(f"z_{c}") for c in names])
    placed = with_position(out, [F.col("fused").desc_nulls_last(), F.col("_key").asc()], "evidence_rank")
    return placed.select(F.col("_key").alias(key), "evidence_rank", "fused", *[f"z_{c}" for c in names])


def evidence_ranking(score_breakdown: DataFrame, claims: DataFrame) -> DataFrame:
    """The claims of score_breakdown, ranked by bonus, base weight and confidence in equal parts.

    A claim without a row in claims has no confidence. Repeated rows count once.
    """
    from ..common import norm_id

    s = score_breakdown.select(norm_id("claim_id").alias("claim_id"), "corroboration_bonus", "base_weight")
    c = claims.select(norm_id("id").alias("claim_id"), F.col("confidence")).where(F.col("claim_id").isNotNull())
    ok = F.when(~F.isnan("confidence"), F.col("confidence"))
    c = c.groupBy("claim_id").agg(F.max(ok).alias("confidence"))
    return gaussian_rank_fusion(s.join(c, "claim_id", "left"), "claim_id", {"corroboration_bonus": 1.0, "base_weight": 1.0, "confidence": 1.0})
