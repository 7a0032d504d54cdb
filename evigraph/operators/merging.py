"""Merge proposals: clusters of name edges, pair scores with a memo, plans, verdicts, relations."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..session import materialise
from .cluster import components

#: Names-only score from which a pair is worth a judge's look; pairs put to the judge at a time.
BAND, PAIRS_PER_CALL = 0.9, 20
# What a call is taken to cost.
CHARS_PER_TOKEN, OUTPUT_PER_PAIR, CONTEXT_PER_CALL, USD_PER_CALL = 2.7, 200, 108_000, 0.10
# What a judge may say of two records, and the claims of a record that it is shown.
VERDICTS = ("same_subject", "possibly_related", "unrelated")
MAX_SIDE = 80


def ordered(pairs: DataFrame) -> DataFrame:
    """The pairs with a < b; loops and pairs with a null end are left out."""
    return pairs.where("a <> b").withColumns({"a": F.least("a", "b"), "b": F.greatest("a", "b")})


def standing(nodes: DataFrame, rejected: DataFrame) -> DataFrame:
    """(id, rep): which node stands for a node when clusters are made.

    Of the nodes with one type and name the smallest id, for those that no rejected pair
    touches; a node that one touches stands for itself. So a cluster is made from one node a
    name and from those that somebody has judged, however many nodes share the name, and a
    rejected pair is between nodes that stand for themselves. nodes: (id, name, node_type).
    """
    r = ordered(rejected)
    judged_ = r.select(F.col("a").alias("id")).unionByName(r.select(F.col("b").alias("id"))).distinct().withColumn("_own", F.lit(True))
    n = materialise(nodes.select("id", "name", "node_type").join(judged_, "id", "left"), "standing")
    reps = n.where("_own IS NULL AND name IS NOT NULL").groupBy("node_type", "name").agg(F.min("id").alias("rep"))
    x = n.join(reps, ["node_type", "name"], "left")
    return x.select("id", F.when(F.col("_own").isNull() & F.col("rep").isNotNull(), F.col("rep")).otherwise(F.col("id")).alias("rep"))


def labelled_edges(names: DataFrame, fuzzy: DataFrame | None = None) -> DataFrame:
    """(a, b, score, reason): edges of equal names and of similar ones; of both the name's counts."""
    e = ordered(names).select("a", "b", F.col("score").cast("double").alias("score"), F.lit("name-equivalent").alias("reason"))
    if fuzzy is None:
        return e.distinct()
    f = ordered(fuzzy).select("a", "b", F.col("score").cast("double").alias("score"), F.lit("fuzzy").alias("reason"))
    return e.distinct().unionByName(f.distinct().join(e, ["a", "b"], "left_anti"))


def clusters_of(edges: DataFrame, rejected: DataFrame, nodes: DataFrame, claims: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cards, membership): what the edges tie together without the rejected pairs.

    Taking a rejected pair out may split a cluster. cards: (component, members,
    suggested_canonical, node_type, score, reason): the name and type of the member with the
    most claims (ties: the smaller id), score and reason of the best edge. membership:
    (component, node_id); lists of members don't form, a cluster may be of any size.
    claims: (node_id, claims).
    """
    e = materialise(edges.join(ordered(rejected).select("a", "b").distinct(), ["a", "b"], "left_anti"), "kept_edges")
    m = materialise(components(e).select("component", F.col("id").alias("node_id")), "membership")
    inside = e.join(m.select(F.col("node_id").alias("a"), "component"), "a").groupBy("component").agg(F.max_by(F.struct("score", "reason"), F.struct("score", "reason")).alias("best"))
    n = m.join(nodes.select(F.col("id").alias("node_id"), "name", "node_type"), "node_id").join(claims, "node_id", "left")
    rank = F.struct(-F.coalesce("claims", F.lit(0)), F.col("node_id"))
    top = n.groupBy("component").agg(F.count("*").alias("members"), F.min_by(F.struct("name", "node_type"), rank).alias("top"))
    cards = top.join(inside, "component").select("component", "members", F.col("top.name").alias("suggested_canonical"), "top.node_type", F.col("best.score").alias("score"), F.col("best.reason").alias("reason"))
    return cards, m


def reranked(cards: DataFrame, membership: DataFrame, scores: DataFrame) -> DataFrame:
    """The cards with the best pair score inside each cluster as score, the rules' kept as rule_score.

    scores: (a, b, score) of pairs; a cluster without a scored pair keeps the rules' score.
    """
    of = lambda side: membership.select(F.col("node_id").alias(side), F.col("component").alias(f"c{side}"))
    best = ordered(scores).join(of("a"), "a").join(of("b"), "b").where("ca = cb").groupBy(F.col("ca").alias("component")).agg(F.max("score").alias("_best"))
    return cards.withColumnRenamed("score", "rule_score").join(best, "component", "left").withColumn("score", F.coalesce("_best", "rule_score")).drop("_best")


def score_pairs(pairs: DataFrame, memo: DataFrame, texts: DataFrame, score: Callable[[list[tuple[str, str]]], list[float]], batch: int = 64) -> DataFrame:
    """(a, b, score, new): the pairs with their scores, those that the memo lacks by the injected scorer.

    memo: (a, b, score, seq), the last line of a pair counts. texts: (id, text) is what the
    scorer reads; pairs with an end without text aren't scored.
    """
    wanted = ordered(pairs).select("a", "b").distinct()
    known = ordered(memo).groupBy("a", "b").agg(F.max_by("score", "seq").alias("score"))
    open_ = wanted.join(known, ["a", "b"], "left_anti").join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a").join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b")
    kinds = ", ".join(f"{c} {open_.schema[c].dataType.simpleString()}" for c in ("a", "b"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            s: list[float] = []
            for i in range(0, len(x), batch):
                part = x.iloc[i : i + batch]
                s += list(score(list(zip(part["ta"], part["tb"], strict=True))))
            yield pd.DataFrame({"a": x["a"], "b": x["b"], "score": pd.Series(s, dtype=float, index=x.index)})

    fresh = open_.mapInPandas(run, f"{kinds}, score double").withColumn("new", F.lit(True))
    return wanted.join(known, ["a", "b"]).withColumn("new", F.lit(False)).unionByName(fresh)


def to_verify(pairs: DataFrame, scores: DataFrame, verdicts: DataFrame, types: DataFrame, floor: float = BAND, cross_type: bool = False) -> DataFrame:
    """(a, b, names_only, with_claims): scored pairs in the band that no verdict settles.

    The band is the names-only score alone. Pairs of two types stay out unless cross_type.
    scores: (a, b, names_only, with_claims); types: (id, node_type).
    """
    s = ordered(pairs).select("a", "b").distinct().join(ordered(scores).select("a", "b", "names_only", "with_claims"), ["a", "b"]).where(F.col("names_only") >= floor)
    s = s.join(ordered(verdicts).select("a", "b").distinct(), ["a", "b"], "left_anti")
    s = s.join(types.select(F.col("id").alias("a"), F.col("node_type").alias("ka")), "a", "left").join(types.select(F.col("id").alias("b"), F.col("node_type").alias("kb")), "b", "left")
    return (s if cross_type else s.where(F.col("ka").eqNullSafe(F.col("kb")))).select("a", "b", "names_only", "with_claims")


def plan(pairs: DataFrame, scores: DataFrame, verdicts: DataFrame, types: DataFrame, lengths: DataFrame, floor: float = BAND, cross_type: bool = False) -> DataFrame:
    """One row: what a run over the pairs would do and cost, without doing it.

    lengths: (id, n) characters of each node's text. Columns: shortlist_pairs, new_pairs (to be
    scored), to_verify, verify_calls, input_tokens, output_tokens, cached_context_tokens, usd.
    """
    wanted = ordered(pairs).select("a", "b").distinct()
    new = wanted.join(ordered(scores).select("a", "b").distinct(), ["a", "b"], "left_anti").agg(F.count("*").alias("new_pairs"))
    v = to_verify(wanted, scores, verdicts, types, floor, cross_type)
    chars = v.join(lengths.select(F.col("id").alias("a"), F.col("n").alias("na")), "a", "left").join(lengths.select(F.col("id").alias("b"), F.col("n").alias("nb")), "b", "left")
    cost = chars.agg(F.count("*").alias("to_verify"), F.coalesce(F.sum(F.coalesce("na", F.lit(0)) + F.coalesce("nb", F.lit(0))), F.lit(0)).alias("chars"))
    x = wanted.agg(F.count("*").alias("shortlist_pairs")).join(F.broadcast(new)).join(F.broadcast(cost))  # one row each
    calls = F.ceil(F.col("to_verify") / PAIRS_PER_CALL)
    return x.select("shortlist_pairs", "new_pairs", "to_verify", calls.alias("verify_calls"), F.floor(F.col("chars") / CHARS_PER_TOKEN).alias("input_tokens"), (F.col("to_verify") * OUTPUT_PER_PAIR).alias("output_tokens"), (calls * CONTEXT_PER_CALL).alias("cached_context_tokens"), F.bround(calls * USD_PER_CALL, 2).alias("usd"))


def judged(items: DataFrame, ask: Callable[[list[str]], list[dict | None]], size: int = PAIRS_PER_CALL) -> DataFrame:
    """items (a, b, text) with same and reason, by an injected judge that is shown `size` texts at a time.

    ask gives for each text {'same': bool, 'reason': str}; what it gives for a text counts only
    if same is a boolean, else the pair is unanswered (same null). A call that fails leaves its
    batch unanswered and stops nothing. Reasons are cut to 400 letters, as they are a note.
    """
    kinds = ", ".join(f"{c} {items.schema[c].dataType.simpleString()}" for c in ("a", "b"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            same, why = [], []
            for i in range(0, len(x), size):
                part = x["text"].iloc[i : i + size].tolist()
                try:
                    answers = list(ask(part))
                except Exception as e:  # noqa: BLE001 - one bad reply must not stop the rest
                    answers = [{"reason": f"{type(e).__name__}: {e}"}] * len(part)
                answers = (answers + [None] * len(part))[: len(part)]
                for d in answers:
                    d = d if isinstance(d, dict) else {}
                    same.append(d["same"] if isinstance(d.get("same"), bool) else None)
                    why.append(str(d.get("reason") or "")[:400])
            yield pd.DataFrame({"a": x["a"].tolist(), "b": x["b"].tolist(), "same": pd.Series(same, dtype=object), "reason": why})

    return items.select("a", "b", "text").mapInPandas(run, f"{kinds}, same boolean, reason string")


def land(verdicts: DataFrame, queue: DataFrame, nodes: DataFrame, claims: DataFrame) -> DataFrame:
    """(a, b, suggested_survivor, suggested_canonical, node_type, score): the queue entries that
    the yes-verdicts add.

    verdicts: (a, b, same, names_only, with_claims); queue: (a, b) of pairs that stand there
    already. Pairs with a node that is no longer live add nothing. The survivor suggested is the
    node with more claims (ties: the smaller id), by name; the score is the lesser of the two,
    0.9 where one is missing, at 3 decimals. Nothing merges.
    """
    yes = ordered(verdicts).where("same").groupBy("a", "b").agg(F.max("names_only").alias("names_only"), F.max("with_claims").alias("with_claims"))
    yes = yes.join(ordered(queue).select("a", "b").distinct(), ["a", "b"], "left_anti")
    n = nodes.select("id", "name", "node_type").join(claims.withColumnRenamed("node_id", "id"), "id", "left").select("id", F.struct((-F.coalesce("claims", F.lit(0))).alias("c"), F.col("id").alias("id"), F.col("name").alias("name"), F.col("node_type").alias("node_type")).alias("n"))
    x = yes.join(n.select(F.col("id").alias("a"), F.col("n").alias("x")), "a").join(n.select(F.col("id").alias("b"), F.col("n").alias("y")), "b")
    best = F.least("x", "y")
    score = F.bround(F.least(F.coalesce("names_only", F.lit(0.9)), F.coalesce("with_claims", F.lit(0.9))), 3)
    return x.select("a", "b", best["id"].alias("suggested_survivor"), best["name"].alias("suggested_canonical"), best["node_type"].alias("node_type"), score.alias("score"))


# ---- relations between records


def pairs_to_judge(hits: DataFrame, judged: DataFrame) -> DataFrame:
    """(a, b, hits_ab, hits_ba): record pairs with the hits of each direction, without judged
    ones, the most first. hits: (a, b, hits), directed."""
    x = hits.where("a <> b").select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y"), F.when(F.col("a") < F.col("b"), F.col("hits")).otherwise(0).alias("ab"), F.when(F.col("a") > F.col("b"), F.col("hits")).otherwise(0).alias("ba"))
    s = x.groupBy(F.col("x").alias("a"), F.col("y").alias("b")).agg(F.sum("ab").alias("hits_ab"), F.sum("ba").alias("hits_ba"))
    return s.join(ordered(judged).select("a", "b").distinct(), ["a", "b"], "left_anti").orderBy(F.desc(F.col("hits_ab") + F.col("hits_ba")), "a", "b")


def relations(verdicts: DataFrame, confirmations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(relations, refused): the record relations that judges' verdicts come to.

    verdicts: (a, b, verdict, shared_subject, reason, at), the last of a pair counts;
    confirmations: (a, b, verdict, at), of which the last that isn't earlier than the verdict
    counts. A positive verdict stands only if the second is positive too; else the pair is
    unrelated and keeps both. confirmed is null where nobody confirmed. What is none of
    VERDICTS is refused.
    """
    known = F.col("verdict").isin(*VERDICTS)
    v, c = ordered(verdicts), ordered(confirmations)
    refused = v.where(~F.coalesce(known, F.lit(False))).select("a", "b", "verdict", F.lit("verdict").alias("pass")).unionByName(c.where(~F.coalesce(known, F.lit(False))).select("a", "b", "verdict", F.lit("confirmation").alias("pass")))
    clean = lambda x: F.when(F.trim(x) != "", F.trim(x))
    first = v.where(known).groupBy("a", "b").agg(F.max(F.struct("at", "verdict", clean("shared_subject").alias("shared_subject"), clean("reason").alias("reason"))).alias("f"))
    second = c.where(known).join(first.select("a", "b", F.col("f.at").alias("since")), ["a", "b"]).where(F.col("at") >= F.col("since")).groupBy("a", "b").agg(F.max(F.struct("at", "verdict")).alias("s"))
    x = first.join(second, ["a", "b"], "left")
    asked = F.col("f.verdict") != "unrelated"
    confirm = F.when(asked, F.col("s.verdict"))
    failed = F.coalesce(confirm == "unrelated", F.lit(False))
    out = x.select(
        "a", "b", F.when(failed, "unrelated").otherwise(F.col("f.verdict")).alias("verdict"), F.col("f.shared_subject").alias("shared_subject"),
        F.when(failed, F.concat(F.lit("failed confirmation: "), F.coalesce("f.reason", F.lit("")))).otherwise(F.col("f.reason")).alias("reason"),
        F.col("f.verdict").alias("first_verdict"), confirm.alias("confirm_verdict"), F.when(confirm.isNotNull(), ~failed).alias("confirmed"),
    )
    return out, refused


def claim_lines(claims: DataFrame, keep: DataFrame | None = None, limit: int = MAX_SIDE) -> DataFrame:
    """(record_id, place, line): the claims of a record as a judge is shown them.

    claims: (id, record_id, claim_type, content, location_in_record, seq). A record of more than
    `limit` claims shows of those in keep (id) the first `limit`; one without any of them all.
    """
    order = W.partitionBy("record_id").orderBy(F.col("location_in_record").asc_nulls_first(), "seq", "id")
    c = claims.where("record_id IS NOT NULL")
    if keep is not None:
        c = c.join(keep.select("id").distinct().withColumn("_kept", F.lit(True)), "id", "left")
        n = c.groupBy("record_id").agg(F.count("*").alias("_n"), F.count("_kept").alias("_k"))
        c = c.join(n, "record_id").where((F.col("_n") <= limit) | (F.col("_k") == 0) | F.col("_kept"))
        c = c.withColumn("place", F.row_number().over(order)).where((F.col("_n") <= limit) | (F.col("_k") == 0) | (F.col("place") <= limit))
    else:
        c = c.withColumn("place", F.row_number().over(order))
    line = F.concat(F.lit("["), F.substring("id", 1, 8), F.lit("] ("), F.coalesce("claim_type", F.lit("None")), F.lit(") "), F.trim(F.coalesce("content", F.lit(""))))
    return c.select("record_id", "place", line.alias("line"))


def full_ids(links: DataFrame, claims: DataFrame, prefix: Column | str = "short") -> DataFrame:
    """links (record_id, short, ...) with id: the record's claim whose id begins with the first 8
    letters of short, the first by seq; a prefix that no claim has stays as it is."""
    by = claims.groupBy("record_id", F.substring("id", 1, 8).alias("_p")).agg(F.min_by("id", F.struct("seq", "id")).alias("_id"))
    return links.withColumn("_p", F.substring(prefix, 1, 8)).join(by, ["record_id", "_p"], "left").withColumn("id", F.coalesce("_id", prefix)).drop("_p", "_id")
