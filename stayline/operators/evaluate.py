"""Exact evaluation of a score column against a 0/1 label, and the rule score as a baseline scorer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.functions import vocab
from stayline.operators.matrix import LABEL, TARGET
from stayline.operators.ordered import running_totals

SCORE = "score"
THRESHOLD = 0.5  # fixed value
CLASS_NAMES = ("Active", "Churned")  # fixed values, for label 0 and 1


def rule_scores(feature_table: DataFrame) -> DataFrame:
    """The heuristic points as a score in 0..1: a scorer that needs no training."""
    points = F.col("heuristic_churn_risk_score")
    return feature_table.select(
        "customer_id",
        F.col(TARGET).cast("int").alias(LABEL),
        (points / float(vocab.RISK_POINTS_MAX)).alias(SCORE),
        "days_since_last_watch",
        "has_downgraded",
        "heuristic_churn_risk_score",
        "negative_ticket_count",
    )


def predicted(score: str = SCORE, threshold: float = THRESHOLD) -> Column:
    return (F.col(score) >= threshold).cast("int")


def _per_score(scored: DataFrame) -> DataFrame:
    return (
        scored.where(F.col(SCORE).isNotNull() & F.col(LABEL).isNotNull())
        .groupBy(F.col(SCORE).cast("double").alias(SCORE))
        .agg(F.count_if(F.col(LABEL) == 1).alias("pos"), F.count_if(F.col(LABEL) == 0).alias("neg"))
    )


def roc_auc(scored: DataFrame) -> DataFrame:
    """Share of (positive, negative) pairs ranked right, ties counting half; NULL when a class is missing."""
    ranked = running_totals(_per_score(scored), SCORE, ["neg"])
    twice_below = F.col("upto_neg") * 2 - F.col("neg")
    wins = (F.col("pos").cast("decimal(20,0)") * twice_below.cast("decimal(18,0)")).cast("decimal(38,0)")
    totals = ranked.agg(F.sum(wins).alias("w"), F.sum("pos").alias("n_positive"), F.sum("neg").alias("n_negative"))
    pairs = F.nullif(F.col("n_positive").cast("double") * F.col("n_negative"), F.lit(0.0))
    return totals.select("n_positive", "n_negative", (F.col("w").cast("double") / 2 / pairs).alias("roc_auc"))


def average_precision(scored: DataFrame) -> DataFrame:
    """Precision at each distinct score from the top, weighted by the recall gained there."""
    reverse = _per_score(scored).withColumn("_from_top", -F.col(SCORE))
    ranked = running_totals(reverse, "_from_top", ["pos", "neg"])
    precision = F.col("upto_pos") / (F.col("upto_pos") + F.col("upto_neg"))
    return ranked.agg(
        F.sum("pos").alias("n_positive"),
        (F.sum(F.col("pos") * precision) / F.nullif(F.sum("pos"), F.lit(0))).alias("average_precision"),
    )


def _confusion_counts(scored: DataFrame) -> DataFrame:
    actual, guess = F.col(LABEL), predicted()
    return scored.agg(
        *[F.count_if((actual == a) & (guess == g)).alias(f"n{a}{g}") for a in (0, 1) for g in (0, 1)]
    )


def confusion_matrix(scored: DataFrame) -> DataFrame:
    """Rows (actual, predicted, n) for all four combinations."""
    cells = [
        F.struct(F.lit(a).alias("actual"), F.lit(g).alias("predicted"), F.col(f"n{a}{g}").alias("n"))
        for a in (0, 1)
        for g in (0, 1)
    ]
    return _confusion_counts(scored).select(F.inline(F.array(*cells)))


def classification_report(scored: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy and the two averages; 0 where undefined."""
    counts = _confusion_counts(scored)

    def ratio(part: Column, whole: Column) -> Column:
        return F.when(whole == 0, 0.0).otherwise(part / whole)

    for c in (0, 1):
        other = 1 - c
        hits, support = F.col(f"n{c}{c}"), F.col(f"n{c}{c}") + F.col(f"n{c}{other}")
        guessed = hits + F.col(f"n{other}{c}")
        counts = counts.withColumns({f"p{c}": ratio(hits, guessed), f"r{c}": ratio(hits, support), f"s{c}": support})
        counts = counts.withColumn(
            f"f{c}", ratio(F.col(f"p{c}") * F.col(f"r{c}") * 2.0, F.col(f"p{c}") + F.col(f"r{c}"))
        )
    total = F.col("s0") + F.col("s1")
    accuracy = ratio(F.col("n00") + F.col("n11"), total)

    def macro(m: str) -> Column:
        return (F.col(f"{m}0") + F.col(f"{m}1")) / 2.0

    def weighted(m: str) -> Column:
        return ratio(F.col(f"{m}0") * F.col("s0") + F.col(f"{m}1") * F.col("s1"), total)

    def row(name: str, p: Column, r: Column, f1: Column, support: Column):
        return F.struct(
            F.lit(name).alias("class_name"),
            p.alias("precision_score"),
            r.alias("recall_score"),
            f1.alias("f1_score"),
            support.alias("support"),
        )

    lines = [row(CLASS_NAMES[c], F.col(f"p{c}"), F.col(f"r{c}"), F.col(f"f{c}"), F.col(f"s{c}")) for c in (0, 1)]
    lines.append(row("accuracy", accuracy, accuracy, accuracy, total))
    lines.append(row("macro avg", macro("p"), macro("r"), macro("f"), total))
    lines.append(row("weighted avg", weighted("p"), weighted("r"), weighted("f"), total))
    return counts.select(F.inline(F.array(*lines)))


def risk_tier(probability: Column) -> Column:
    """Right-closed tiers over (0, 1]; a probability of exactly 0 belongs to none."""
    low, medium, high = vocab.RISK_TIER_LADDER
    return (
        F.when(probability <= 0.0, F.lit(None))
        .when(probability <= low[0], low[1])
        .when(probability <= medium[0], medium[1])
        .when(probability <= high[0], high[1])
    )


def with_tiers(scored: DataFrame) -> DataFrame:
    return scored.withColumn("predicted", predicted()).withColumn("risk_tier", risk_tier(F.col(SCORE)))


def risk_tier_distribution(tiered: DataFrame) -> DataFrame:
    """Customers per tier, empty tiers included, in tier order."""
    counts = tiered.agg(*[F.count_if(F.col("risk_tier") == tier).alias(tier) for tier in vocab.RISK_TIERS])
    rows = [F.struct(F.lit(tier).alias("risk_tier"), F.col(tier).alias("n")) for tier in vocab.RISK_TIERS]
    return counts.select(F.inline(F.array(*rows)))


def top_risk(tiered: DataFrame, k: int = 10) -> DataFrame:
    """The k customers with the highest score; ties go to the smaller id."""
    return (
        tiered.select(
            "customer_id",
            SCORE,
            "risk_tier",
            "days_since_last_watch",
            "has_downgraded",
            "heuristic_churn_risk_score",
            "negative_ticket_count",
        )
        .orderBy(F.desc(SCORE), "customer_id")
        .limit(k)
    )
