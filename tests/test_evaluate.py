import random

import pytest
from helpers import mapping, tuples
from pyspark.sql import functions as F

from stayline.operators import evaluate


def scored(spark, pairs):
    return spark.createDataFrame(list(pairs), "label int, score double").repartition(4)


def brute_auc(pairs):
    pos = [s for y, s in pairs if y == 1]
    neg = [s for y, s in pairs if y == 0]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def brute_ap(pairs):
    n_pos = sum(y for y, _ in pairs)
    total, gained = 0.0, 0
    for s in sorted({s for _, s in pairs}, reverse=True):
        chosen = [y for y, x in pairs if x >= s]
        total += (sum(chosen) - gained) / n_pos * sum(chosen) / len(chosen)
        gained = sum(chosen)
    return total


RNG = random.Random(3)
CASES = {
    "perfect": [(1, 0.9), (1, 0.8), (0, 0.2), (0, 0.1)],
    "reversed": [(0, 0.9), (0, 0.8), (1, 0.2), (1, 0.1)],
    "tied": [(1, 0.5), (0, 0.5), (0, 0.5)],
    "mixed": [(RNG.randint(0, 1), round(RNG.random(), 2)) for _ in range(400)],
    "distinct": [(int(RNG.random() < 0.15), RNG.random()) for _ in range(400)],
    "concentrated": [(RNG.randint(0, 1), 0.5 + RNG.random() * 1e-9) for _ in range(300)] + [(1, 1.0), (0, 0.0)],
}


@pytest.mark.parametrize("name", CASES)
def test_auc_and_ap_match_brute_force(spark, name):
    pairs = CASES[name]
    df = scored(spark, pairs)
    assert evaluate.roc_auc(df).first().roc_auc == pytest.approx(brute_auc(pairs), abs=1e-12)
    assert evaluate.average_precision(df).first().average_precision == pytest.approx(brute_ap(pairs), abs=1e-12)


def test_auc_agrees_with_the_built_in_evaluator(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    df = scored(spark, CASES["mixed"])
    built_in = BinaryClassificationEvaluator(
        rawPredictionCol="score", labelCol="label", metricName="areaUnderROC", numBins=0
    ).evaluate(df.withColumn("label", F.col("label").cast("double")))
    assert evaluate.roc_auc(df).first().roc_auc == pytest.approx(built_in, abs=1e-9)


def test_a_single_class_has_no_auc(spark):
    assert evaluate.roc_auc(scored(spark, [(0, 0.1), (0, 0.9)])).first().roc_auc is None
    assert evaluate.average_precision(scored(spark, [(0, 0.1)])).first().average_precision is None


def test_confusion_matrix_has_all_four_cells(spark):
    df = scored(spark, [(1, 0.5), (1, 0.49), (1, 0.9)])
    assert tuples(evaluate.confusion_matrix(df)) == [(0, 0, 0), (0, 1, 0), (1, 0, 1), (1, 1, 2)]


def test_classification_report(spark):
    df = scored(spark, [(0, 0.1)] * 5 + [(0, 0.9)] * 1 + [(1, 0.9)] * 2 + [(1, 0.1)] * 2)
    rows = {r.class_name: r for r in evaluate.classification_report(df).collect()}
    assert rows["Active"].precision_score == pytest.approx(5 / 7)
    assert rows["Active"].recall_score == pytest.approx(5 / 6)
    assert rows["Churned"].precision_score == pytest.approx(2 / 3)
    assert rows["Churned"].f1_score == pytest.approx(2 * (2 / 3) * 0.5 / (2 / 3 + 0.5))
    assert rows["accuracy"].f1_score == pytest.approx(0.7)
    assert rows["macro avg"].recall_score == pytest.approx((5 / 6 + 0.5) / 2)
    assert rows["weighted avg"].recall_score == pytest.approx(0.7)
    assert rows["weighted avg"].support == 10


def test_report_without_predicted_positives_is_zero_not_undefined(spark):
    rows = {r.class_name: r for r in evaluate.classification_report(scored(spark, [(0, 0.1), (1, 0.1)])).collect()}
    assert (rows["Churned"].precision_score, rows["Churned"].f1_score) == (0.0, 0.0)


def test_tiers_are_right_closed(spark):
    values = [0.0, 0.0001, 0.3, 0.3001, 0.6, 0.6001, 1.0, 1.1, None]
    df = spark.createDataFrame([(v,) for v in values], "score double")
    got = [row.tier for row in df.select(evaluate.risk_tier(F.col("score")).alias("tier")).collect()]
    assert got == [None, "low", "low", "medium", "medium", "high", "high", None, None]


def test_distribution_lists_empty_tiers(spark):
    df = evaluate.with_tiers(scored(spark, [(0, 0.1), (0, 0.0), (1, 0.9), (1, 0.95)]))
    assert mapping(evaluate.risk_tier_distribution(df), "risk_tier", "n") == {"low": 1, "medium": 0, "high": 2}


def test_top_risk_breaks_ties_by_id(spark):
    rows = [(f"c{i}", 0, 0.5 if i else 0.9, 1, 0, 3, 0) for i in range(20)]
    schema = (
        "customer_id string, label int, score double, days_since_last_watch int, has_downgraded int, "
        "heuristic_churn_risk_score int, negative_ticket_count bigint"
    )
    top = evaluate.top_risk(evaluate.with_tiers(spark.createDataFrame(rows, schema).repartition(4)), 3)
    assert [row.customer_id for row in top.collect()] == ["c0", "c1", "c10"]
