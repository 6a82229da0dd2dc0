"""Gradient-boosted trees on the feature matrix: training, cross-validation, importance, scoring, storage."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field, replace
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.operators import boosting, evaluate, matrix
from stayline.operators.boosting import Settings
from stayline.operators.evaluate import SCORE
from stayline.operators.matrix import LABEL
from stayline.session import cut_lineage

KEY = "customer_id"

# Importance of a feature by what the ledger records of its splits.
IMPORTANCE_KINDS = {"gain": "avg(gain)", "total_gain": "sum(gain)", "cover": "avg(cover)", "weight": "cast(count(*) as double)"}
IMPORTANCE_SQL = """
select feature, sum(amount) / greatest(sum(sum(amount)) over (), 1e-300) as importance from (
    select feature, {amount} as amount from {ledger} where feature is not null group by feature
    union all select feature, 0.0 as amount from {features}
) group by feature
"""


def _expression(nodes: dict[int, tuple], at: int = 0) -> str:
    _, _, _, feature, threshold, left, right, value, _, _ = nodes[at]
    if feature is None:
        return f"{value!r}D"
    return f"if(`{feature}` <= {threshold!r}D, {_expression(nodes, left)}, {_expression(nodes, right)})"


def _total(parts: Sequence[str]) -> str:
    if len(parts) < 2:
        return parts[0] if parts else "0D"
    half = len(parts) // 2
    return f"({_total(parts[:half])} + {_total(parts[half:])})"


@dataclass
class ChurnModel:
    """A fitted model: the ledger of its nodes, and what scoring needs besides: the feature list and the imputation medians."""

    nodes: list[tuple]
    features: list[str]
    medians: dict[str, float]
    settings: Settings = Settings()
    metrics: dict[str, float] = field(default_factory=dict)

    def margin(self) -> Column:
        """The trees as one expression over the imputed features."""
        trees: dict[int, dict[int, tuple]] = {}
        for row in self.nodes:
            trees.setdefault(row[0], {})[row[1]] = row
        return F.expr(_total([_expression(trees[t]) for t in sorted(trees)]))

    def imputed(self, feature_matrix: DataFrame) -> DataFrame:
        # A feature without a single known value has no median either; it is constant for the trees.
        return matrix.impute(feature_matrix, self.medians).fillna(0.0, subset=self.features)

    def score(self, feature_matrix: DataFrame) -> DataFrame:
        """Add ``score``, the probability of churn."""
        margins = self.imputed(feature_matrix).withColumn(SCORE, self.margin())
        scored = margins.withColumn(SCORE, 1.0 / (1.0 + F.exp(-F.col(SCORE))))
        return scored.select(*feature_matrix.columns, SCORE)

    def ledger(self, spark: SparkSession) -> DataFrame:
        """One row per node of every tree: bounded by the settings, whatever the number of rows."""
        return spark.createDataFrame(self.nodes, boosting.NODES)

    def importance(self, spark: SparkSession, kind: str = "gain") -> DataFrame:
        """Share of each feature in the importance, 0 for one that no split uses."""
        features = spark.createDataFrame([(f,) for f in self.features], "feature string")
        return spark.sql(
            IMPORTANCE_SQL.replace("{amount}", IMPORTANCE_KINDS[kind]), ledger=self.ledger(spark), features=features
        )

    def save(self, spark: SparkSession, path: str) -> None:
        """Two small tables: the ledger, and features, medians, settings and metrics."""
        self.ledger(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/ledger")
        facts = {"features": self.features, "medians": self.medians, "settings": asdict(self.settings), "metrics": self.metrics}
        rows = spark.createDataFrame([(name, json.dumps(value)) for name, value in facts.items()], "name string, value string")
        rows.coalesce(1).write.mode("overwrite").parquet(f"{path}/facts")


def load(spark: SparkSession, path: str) -> ChurnModel:
    """A saved model, in any session."""
    facts = {r["name"]: json.loads(r["value"]) for r in spark.read.parquet(f"{path}/facts").collect()}
    nodes = sorted(tuple(r) for r in spark.read.parquet(f"{path}/ledger").collect())
    return ChurnModel(nodes, facts["features"], facts["medians"], Settings(**facts["settings"]), facts["metrics"])


def walked_scores(model: ChurnModel, feature_matrix: DataFrame) -> DataFrame:
    """The scores once more, by walking every tree in the stored ledger node by node: customer id and ``score``.

    The ledger, which the settings bound, is one row of nested arrays that meets every customer in a broadcast join. Each customer
    walks the trees within its row, so rows are neither multiplied by trees nor shuffled with their features. Slow next to the
    compiled expression; it shows that the stored tables alone give the same scores.
    """
    spark = feature_matrix.sparkSession
    numbers = spark.createDataFrame([(f, i) for i, f in enumerate(model.features)], "feature string, place int")
    node = F.struct("node", "place", "threshold", "left_node", "right_node", "value")
    # Nodes are found by their number, in whatever order they are stored.
    trees = (
        model.ledger(spark)
        .join(F.broadcast(numbers), "feature", "left")
        .groupBy("tree")
        .agg(F.map_from_entries(F.collect_list(F.struct("node", node))).alias("nodes"))
        .agg(F.collect_list("nodes").alias("trees"))
    )
    values = F.array(*(F.col(f"`{f}`") for f in model.features)).cast("array<double>")

    def leaf(tree: Column) -> Column:
        def onward(at: Column, _: Column) -> Column:
            left = F.get("known", at["place"]) <= at["threshold"]
            return F.when(at["place"].isNull(), at).otherwise(tree[F.when(left, at["left_node"]).otherwise(at["right_node"])])

        return F.aggregate(F.sequence(F.lit(1), F.lit(model.settings.max_depth)), tree[F.lit(0)], onward)["value"]

    margin = F.aggregate("trees", F.lit(0.0), lambda sum_, tree: sum_ + leaf(tree))
    walked = model.imputed(feature_matrix).select(KEY, values.alias("known")).join(F.broadcast(trees))
    margins = walked.select(KEY, margin.alias("margin")).groupBy(KEY).agg(F.sum("margin").alias(SCORE))
    return margins.withColumn(SCORE, 1.0 / (1.0 + F.exp(-F.col(SCORE))))


def _fit(
    train: DataFrame, medians: dict[str, float] | None, n_folds: int, params: dict
) -> tuple[ChurnModel, boosting.Fitted]:
    """One pass for the model of all rows and one model per held-out fold. Rows without a label teach nothing and are left out."""
    train = train.where(F.col(LABEL).isNotNull())
    features = matrix.feature_columns(train)
    if n_folds:
        train = matrix.stratified_folds(train, k=n_folds)
    train = cut_lineage(train)
    medians = matrix.fit_medians(train) if medians is None else medians
    settings = Settings(**params)
    if "scale_pos_weight" not in params:
        # The positive class is weighted up to balance.
        settings = replace(settings, scale_pos_weight=float(matrix.class_weight(train).first()["positive_weight"] or 1.0))
    # Rows are laid out by id; how many tasks that is follows from their measured size.
    rows = matrix.impute(train, medians).repartition(KEY).sortWithinPartitions(KEY)
    fitted = boosting.fit(rows, features, settings, KEY, LABEL, "fold" if n_folds else None, n_folds)
    return ChurnModel(boosting.node_rows(fitted.trees[-1], fitted.cuts, features), features, medians, settings), fitted


def _fold_scores(fitted: boosting.Fitted, k: int) -> list[float]:
    scored = cut_lineage(fitted.held_out())
    return [evaluate.roc_auc(scored.where(F.col("fold") == fold)).first()["roc_auc"] for fold in range(k)]


def fit(train: DataFrame, medians: dict[str, float] | None = None, **params) -> ChurnModel:
    """Fit on a training matrix. Medians come from it unless given, the weight of the positive class too; ``params`` are those of
    ``Settings``."""
    return _fit(train, medians, 0, params)[0]


def cross_validate(train: DataFrame, k: int = matrix.N_FOLDS, medians: dict[str, float] | None = None, **params) -> list[float]:
    """ROC-AUC of each held-out fold; all folds are trained in one pass, with one set of bins, medians and class weight."""
    return _fold_scores(_fit(train, medians, k, params)[1], k)


def cv_summary(spark, scores: list[float]) -> DataFrame:
    """One row per fold, then the mean and the population standard deviation."""
    mean = sum(scores) / len(scores)
    spread = (sum((s - mean) ** 2 for s in scores) / len(scores)) ** 0.5
    rows = [(f"fold_{i}", s) for i, s in enumerate(scores)] + [("mean", mean), ("std", spread)]
    return spark.createDataFrame(rows, "fold string, auc double")


def importance_ranking(spark, model: ChurnModel, top: int | None = 15, kind: str = "gain") -> DataFrame:
    """Features by falling importance; ``top=None`` keeps all."""
    ranked = model.importance(spark, kind).orderBy(F.desc("importance"), "feature")
    return ranked if top is None else ranked.limit(top)


def run_facts(split_matrix: DataFrame) -> DataFrame:
    """What a training run records about its input, as rows (metric, value)."""
    facts = split_matrix.agg(
        F.count_if(F.col("split") == "train").cast("double").alias("train_size"),
        F.count_if(F.col("split") == "test").cast("double").alias("test_size"),
        F.lit(float(len(matrix.feature_columns(split_matrix)))).alias("n_features"),
        F.avg(LABEL).alias("churn_rate"),
    )
    return facts.unpivot([], facts.columns, "metric", "value")


@dataclass
class TrainingRun:
    model: ChurnModel
    test_scores: DataFrame
    metrics: DataFrame
    folds: list[float]


def train(
    feature_table: DataFrame,
    cv_folds: int = matrix.N_FOLDS,
    impute_scope: str = "train",
    trained_at: datetime | None = None,
    **params,
) -> TrainingRun:
    """Split, cross-validate and fit in one pass, evaluate on the test part, and record the metrics as rows (metric, value).

    ``impute_scope='train'`` learns the medians on the training part only; ``'all'`` on the whole matrix.
    """
    if impute_scope not in ("train", "all"):
        raise ValueError(f"impute_scope must be 'train' or 'all', not {impute_scope!r}")
    spark = feature_table.sparkSession
    whole = cut_lineage(matrix.stratified_split(matrix.feature_matrix(feature_table)))
    train_part = whole.where("split = 'train'").drop("split")
    test_part = whole.where("split = 'test'").drop("split")
    medians = matrix.fit_medians(whole) if impute_scope == "all" else None
    model, fitted = _fit(train_part, medians, cv_folds, params)
    folds = _fold_scores(fitted, cv_folds)
    fitted.blocks.unpersist()
    test_scores = cut_lineage(model.score(test_part).select(KEY, LABEL, SCORE))
    model.metrics = {
        "test_auc": evaluate.roc_auc(test_scores).first()["roc_auc"],
        "test_avg_precision": evaluate.average_precision(test_scores).first()["average_precision"],
    } | {row["metric"]: row["value"] for row in run_facts(whole).collect()}
    if folds:
        mean = sum(folds) / len(folds)
        model.metrics |= {
            "cv_auc_mean": mean,
            "cv_auc_std": (sum((s - mean) ** 2 for s in folds) / len(folds)) ** 0.5,
        }
    metrics = spark.createDataFrame(list(model.metrics.items()), "metric string, value double")
    if trained_at is not None:
        metrics = metrics.withColumn("trained_at", F.lit(trained_at.isoformat(sep=" ")).cast("timestamp"))
    return TrainingRun(model, test_scores, metrics, folds)


def score_customers(model: ChurnModel, feature_table: DataFrame) -> DataFrame:
    """Every customer with probability, prediction, tier and the columns the risk report shows."""
    scored = model.score(matrix.feature_matrix(feature_table))
    shown = ["days_since_last_watch", "has_downgraded", "heuristic_churn_risk_score", "negative_ticket_count"]
    return evaluate.with_tiers(scored.select("customer_id", LABEL, SCORE, *shown))
