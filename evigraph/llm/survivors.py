"""The best representative of each duplicate group, by a two-sided model of source quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..common import norm_id
from ..session import materialise, remove

# Priors of the latent truth model, as pseudo-counts (yes, no).
TRUE_PRIOR, SENSITIVITY_PRIOR, FALSE_ALARM_PRIOR = (2.0, 2.0), (8.0, 2.0), (1.0, 9.0)
#: How near a rate may come to 0 or 1, so that its logarithm is finite whatever the counts.
RATE_MARGIN = 1e-12
#: The model's sources: the columns of a report that count uses.
SOURCES = ("name", "alias")


def spelling(c: str) -> Column:
    """Trimmed, runs of blanks as one blank; blank is null."""
    x = F.regexp_replace(F.regexp_replace(F.col(c), "(?U)[\\s\\u00a0]+", " "), "^ | $", "")
    return F.when(x != "", x)


def latent_truth(observations: DataFrame, iterations: int = 8) -> tuple[DataFrame, DataFrame]:
    """Which values are true and how good the sources are, by expectation-maximisation.

    observations: (entity, value, source, yes double, no double): how often the source, where
    it spoke about the entity, gave the value or gave others. Returns
    (entity, value, p_true, log_odds) and (source, sensitivity, specificity).

    Values are judged one by one, so a field may keep several true values. A source's
    sensitivity is the share of its statements that give a value when it is true, its
    specificity the share that withhold it when it is false; both are kept on the right side
    of chance and off 0 and 1, which makes log_odds grow with yes and fall with no. An
    iteration is two aggregations with partial sums; only the sources' table (rows: sources) is
    joined back, without a hint.
    """
    obs = materialise(observations, "observations")
    total = F.col("yes") + F.col("no")
    # first guess: a value is true as far as statements about its entity give it
    guess = obs.groupBy("entity", "value").agg((F.sum("yes") / F.greatest(F.sum(total), F.lit(1e-9))).alias("p_true"))
    facts = materialise(guess.withColumn("log_odds", F.lit(0.0)), "facts")
    (a1, a0), (s1, s0), (f1, f0) = TRUE_PRIOR, SENSITIVITY_PRIOR, FALSE_ALARM_PRIOR
    quality = None
    for _ in range(iterations):
        p = F.col("p_true")
        sums = obs.join(facts.select("entity", "value", "p_true"), ["entity", "value"]).groupBy("source").agg(
            F.sum(p * F.col("yes")).alias("t1"), F.sum(p * F.col("no")).alias("t0"), F.sum((1 - p) * F.col("yes")).alias("u1"), F.sum((1 - p) * F.col("no")).alias("u0")
        )
        sens = (F.col("t1") + s1) / (F.col("t1") + F.col("t0") + (s1 + s0))
        alarm = (F.col("u1") + f1) / (F.col("u1") + F.col("u0") + (f1 + f0))
        sens = F.greatest(F.least(sens, F.lit(1 - RATE_MARGIN)), F.lit(2 * RATE_MARGIN))
        alarm = F.greatest(F.least(alarm, sens * F.lit(0.95)), F.lit(RATE_MARGIN))
        new_quality = materialise(sums.select("source", sens.alias("sensitivity"), (1 - alarm).alias("specificity")), "quality")
        gain = F.log(F.col("sensitivity") / (1 - F.col("specificity")))
        loss = F.log((1 - F.col("sensitivity")) / F.col("specificity"))
        odds = obs.join(new_quality, "source").groupBy("entity", "value").agg((F.sum(F.col("yes") * gain + F.col("no") * loss) + F.log(F.lit(a1 / a0))).alias("log_odds"))
        new_facts = materialise(odds.select("entity", "value", (1 / (1 + F.exp(-F.greatest(F.least("log_odds", F.lit(700.0)), F.lit(-700.0))))).alias("p_true"), "log_odds"), "facts")
        remove(facts)
        if quality is not None:
            remove(quality)
        facts, quality = new_facts, new_quality
    return facts, quality


def _latest_counts(reports: DataFrame) -> DataFrame:
    """(entity, value, role, uses): of each spelling the count of its latest report that has one.

    In one report the greatest count holds. A spelling that no report counts has null uses.
    """
    rows = reports.select(
        norm_id("node_id").alias("entity"),
        "reported_at",
        F.explode(
            F.array(*(F.struct(spelling(s).alias("value"), F.lit(s).alias("role"), F.col(f"{s}_uses").cast("long").alias("uses")) for s in SOURCES))
        ).alias("s"),
    ).select("entity", "reported_at", "s.*")
    rows = rows.where(F.col("entity").isNotNull() & F.col("value").isNotNull())
    counted = F.when(F.col("uses").isNotNull(), F.struct("reported_at", "uses", "role"))
    best = rows.groupBy("entity", "value").agg(F.max(counted).alias("m"))
    return best.select("entity", "value", F.coalesce("m.role", F.lit("name")).alias("role"), F.col("m.uses").alias("uses"))


def spelling_truth(reports: DataFrame) -> tuple[DataFrame, DataFrame]:
    """latent_truth over the uses of spellings: each use is a statement about its node.

    The sources are the columns that report uses: name and alias. A spelling's yes are its
    own uses, its no the other uses of its node; no count and a count below zero are no uses.
    """
    counts = _latest_counts(reports).withColumn("uses", F.greatest(F.coalesce(F.col("uses").cast("double"), F.lit(0.0)), F.lit(0.0)))
    all_uses = F.sum("uses").over(W.partitionBy("entity"))
    n = counts.withColumn("all", all_uses)
    obs = n.select("entity", "value", F.col("role").alias("source"), F.col("uses").alias("yes"), (F.col("all") - F.col("uses")).alias("no"))
    return latent_truth(obs)


def type_truth(reports: DataFrame) -> DataFrame:
    """(entity, value, at): each type given for a node with the time of its latest report."""
    t = F.when(F.trim("node_type") != "", F.trim("node_type"))
    rows = reports.select(norm_id("node_id").alias("entity"), t.alias("value"), "reported_at").where(F.col("entity").isNotNull() & F.col("value").isNotNull())
    return rows.groupBy("entity", "value").agg(F.max("reported_at").alias("at"))


def judged_names(facts: DataFrame, counts: DataFrame) -> DataFrame:
    """(entity, judged, name, kept): facts as of latent_truth, counts as of _latest_counts.

    Of each source the value of the greatest posterior is a finalist; no other value can be a
    name. The finalist of the greatest posterior is judged. It is the name, unless the other
    finalist has the higher count: a count before none, of equal counts the smaller spelling.
    In one source the posterior never falls as uses grow, and values that it does not tell
    apart go by their counts; so the most used spelling of a node is always a finalist.
    """
    x = facts.join(counts, ["entity", "value"])
    # ~uses turns the order of counts round without overflow
    final = F.struct((-F.round("log_odds", 6)).alias("against"), F.col("uses").isNull().alias("uncounted"), F.bitwise_not("uses").alias("fewer"), "value")
    x = x.groupBy("entity").agg(
        F.array_compact(F.array(*(F.min(F.when(F.col("role") == s, final)) for s in SOURCES))).alias("finalists"),
        F.array_sort(F.array_compact(F.collect_list(F.when(F.col("p_true") >= 0.5, F.col("value"))))).alias("kept"),
    )
    by_count = F.transform("finalists", lambda f: F.struct(f["uncounted"], f["fewer"], f["value"].alias("value")))
    return x.select("entity", F.array_min("finalists")["value"].alias("judged"), F.array_min(by_count)["value"].alias("name"), "kept")


def survivors(reports: DataFrame) -> DataFrame:
    """One row per node: node_id, node_type, name, spellings (all judged in real use), agreed, n_reports.

    The model nominates and judges (judged_names): from each column the value of the greatest
    posterior log odds stands for the name, and every value with p_true of at least a half is
    kept in spellings. An exact check of the judged name against the other column's finalist
    follows, by the counts of the latest reports: the one that is used more often is the name,
    a counted one before one that no report counts, of equal ones the smaller spelling, so that
    the name is the node's most used spelling. agreed says whether the
    judged name stood. node_type is the type of the latest report that has one, of equal times
    the smaller; null if none has. Spellings are compared trimmed with runs of blanks as one,
    otherwise exactly. A node without any spelling has a null name; rows without a node id are
    left out. Repeated rows add nothing.
    """
    facts, _ = spelling_truth(reports)
    name = judged_names(facts, _latest_counts(reports))
    of_type = type_truth(reports).groupBy("entity").agg(F.min_by("value", F.struct(F.col("at").isNull(), -F.unix_micros(F.col("at").cast("timestamp")), F.col("value"))).alias("node_type"))
    used = ("node_type", "name", "name_uses", "alias", "alias_uses", "reported_at")
    nodes = reports.select(norm_id("node_id").alias("entity"), *used).where(F.col("entity").isNotNull()).distinct().groupBy("entity").agg(F.count("*").alias("n_reports"))
    out = nodes.join(name, "entity", "left").join(of_type, "entity", "left")
    kept = F.when(F.col("name").isNotNull(), F.array_sort(F.array_union(F.coalesce("kept", F.array().cast("array<string>")), F.array("name"))))
    return out.select(F.col("entity").alias("node_id"), "node_type", "name", kept.alias("spellings"), (F.col("judged") == F.col("name")).alias("agreed"), "n_reports")
