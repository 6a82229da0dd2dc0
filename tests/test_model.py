import random
from dataclasses import asdict

import pytest
from pyspark.sql import functions as F

from stayline.operators import features, matrix, model
from stayline.sources import tables

SMALL = {"n_trees": 5, "max_depth": 2, "learning_rate": 0.3}


@pytest.fixture(scope="module")
def feature_table(spark):
    """A store in which long-away customers churn, with noise and missing values."""
    rng = random.Random(5)
    rows = []
    for i in range(300):
        away = rng.randint(0, 30)
        rows.append((f"k{i}", f"c{i}", away > 20 or rng.random() < 0.05, float(away), rng.choice([None, 0.1, 0.9])))
    df = spark.createDataFrame(
        rows,
        "customer_key string, customer_id string, target_is_churned boolean, days_since_last_watch double, "
        "abandonment_rate double",
    )
    others = {
        f: F.lit(0.0) for f in features.FEATURES if f not in ("days_since_last_watch", "abandonment_rate")
    }
    return df.withColumn("target_churn_date", F.lit(None).cast("date")).withColumns(others)


def test_production_settings():
    assert asdict(model.Settings()) == {
        "n_trees": 300, "max_depth": 4, "learning_rate": 0.05, "subsample": 0.8, "colsample_bytree": 0.8, "min_child_weight": 5.0,
        "gamma": 1.0, "reg_alpha": 0.1, "reg_lambda": 1.0, "scale_pos_weight": 1.0, "seed": 42, "max_bins": 64,
    }
    with pytest.raises(ValueError, match="max_bins"):
        model.Settings(max_bins=300)


def test_training_run(spark, feature_table, tmp_path):
    run = model.train(feature_table, cv_folds=2, **SMALL)
    metrics = {row.metric: row.value for row in run.metrics.collect()}
    assert set(metrics) == {
        "test_auc", "test_avg_precision", "train_size", "test_size", "n_features", "churn_rate", "cv_auc_mean", "cv_auc_std",
    }
    assert metrics["train_size"] + metrics["test_size"] == 300
    assert metrics["n_features"] == 55
    assert metrics["test_auc"] > 0.8
    assert 0.8 < metrics["cv_auc_mean"] <= 1.0
    ranking = model.importance_ranking(spark, run.model).collect()
    assert len(ranking) == 15
    assert ranking[0].feature == "days_since_last_watch"
    tables.write_csv(model.importance_ranking(spark, run.model, top=None), str(tmp_path / "importance"), single_header_file=True)
    files = list((tmp_path / "importance").glob("*.csv"))
    assert len(files) == 1
    lines = files[0].read_text().splitlines()
    assert (lines[0], len(lines)) == ("feature,importance", 56)
    scored = model.score_customers(run.model, feature_table)
    assert scored.count() == 300
    assert {"customer_id", "score", "predicted", "risk_tier"} <= set(scored.columns)
    assert scored.where("score < 0 or score > 1 or score is null").count() == 0


def test_impute_scope_is_checked(feature_table):
    with pytest.raises(ValueError, match="impute_scope"):
        model.train(feature_table, impute_scope="test", **SMALL)


def test_fitting_twice_gives_the_same_scores(feature_table):
    train_part = matrix.feature_matrix(feature_table)
    layouts = train_part.coalesce(1), train_part.repartition(5)
    first, second = (model.fit(rows, **SMALL).score(train_part).orderBy("customer_id").collect() for rows in layouts)
    assert first == second


def test_rows_without_a_label_teach_nothing(feature_table):
    train_part = matrix.feature_matrix(feature_table)
    more = train_part.union(train_part.limit(20).withColumn("label", F.lit(None).cast("int")))
    first, second = (model.fit(rows, **SMALL).score(train_part).orderBy("customer_id").collect() for rows in (train_part, more))
    assert first == second


def test_a_saved_model_scores_as_before_and_as_a_walk_of_its_trees(spark, feature_table, tmp_path):
    whole = matrix.feature_matrix(feature_table)
    first = model.fit(whole, **SMALL)
    first.save(spark, str(tmp_path / "model"))
    again = model.load(spark, str(tmp_path / "model"))
    assert again == first
    scores = {r["customer_id"]: r["score"] for r in again.score(whole).collect()}
    assert {r["customer_id"]: r["score"] for r in model.walked_scores(again, whole).collect()} == scores
    walked = duckdb_scores(first, whole.toPandas())
    assert {c: pytest.approx(s, abs=1e-15) for c, s in walked.items()} == scores


def duckdb_scores(fitted, rows):
    """A recursive query over the ledger, one step down all trees at a time."""
    import duckdb
    import pandas as pd

    rows = rows.fillna(fitted.medians).fillna(0.0)
    cells = rows.melt("customer_id", fitted.features, "feature", "v")  # noqa: F841
    ledger = pd.DataFrame(fitted.nodes, columns=[c.split()[0] for c in model.boosting.NODES.split(", ")])  # noqa: F841
    customers = rows[["customer_id"]]  # noqa: F841
    found = duckdb.sql("""
        with recursive walk as (
            select customer_id, tree, 0 as node from customers, (select distinct tree from ledger)
            union all
            select w.customer_id, w.tree, if(c.v <= l.threshold, l.left_node, l.right_node)
            from walk w join ledger l using (tree, node) join cells c on c.customer_id = w.customer_id and c.feature = l.feature
        )
        select customer_id, 1 / (1 + exp(-sum(l.value))) from walk join ledger l using (tree, node)
        where l.feature is null group by customer_id
    """)
    return dict(found.fetchall())


@pytest.mark.parametrize("kind", list(model.IMPORTANCE_KINDS))
def test_importance_is_read_from_the_ledger(spark, feature_table, kind):
    fitted = model.fit(matrix.feature_matrix(feature_table), **SMALL)
    splits = [(r[3], {"gain": r[8], "total_gain": r[8], "cover": r[9], "weight": 1.0}[kind]) for r in fitted.nodes if r[3]]
    amounts = {f: [a for g, a in splits if g == f] for f in fitted.features}
    whole = {f: (sum(a) / (len(a) if kind in ("gain", "cover") else 1) if a else 0.0) for f, a in amounts.items()}
    got = {r["feature"]: r["importance"] for r in fitted.importance(spark, kind).collect()}
    assert got == {f: pytest.approx(a / sum(whole.values())) for f, a in whole.items()}


def test_a_walk_multiplies_no_rows(feature_table):
    whole = matrix.feature_matrix(feature_table)
    plan = model.walked_scores(model.fit(whole, **SMALL), whole)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "explode" not in plan
