"""From the feature table to a numeric matrix: selection, imputation, split and folds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.operators.features import FEATURES, KEY_AND_TARGET
from stayline.operators.ordered import HASH_SEED, exact_medians, hash_cuts, seeded_hash

# Fixed values.
TARGET, LABEL = "target_is_churned", "label"
TEST_FRACTION = Decimal("0.2")
N_FOLDS = 5


def available(df: DataFrame, names: Sequence[str] = FEATURES) -> list[str]:
    """The listed columns the table really has, in list order; keys, target and the leaking churn date never qualify."""
    present = set(df.columns) - set(KEY_AND_TARGET)
    return [name for name in names if name in present]


def feature_matrix(feature_table: DataFrame, names: Sequence[str] = FEATURES) -> DataFrame:
    """Customer id, integer label and the features as doubles; text that is no number becomes NULL."""
    numeric = [F.col(name).try_cast("double").alias(name) for name in available(feature_table, names)]
    return feature_table.select("customer_id", F.col(TARGET).cast("int").alias(LABEL), *numeric)


def feature_columns(matrix: DataFrame) -> list[str]:
    return [name for name in matrix.columns if name in set(FEATURES)]


def fit_medians(matrix: DataFrame) -> dict[str, float]:
    """Median per feature, for ``impute``: one number per feature column reaches the driver."""
    rows = exact_medians(matrix, feature_columns(matrix)).collect()
    return {row["column_name"]: row["median"] for row in rows}


def impute(matrix: DataFrame, medians: Mapping[str, float]) -> DataFrame:
    """Fill NULL features with their medians; a feature without any value stays NULL."""
    known = {name: value for name, value in medians.items() if value is not None}
    return matrix.fillna(known) if known else matrix


def stratified_split(
    df: DataFrame,
    key: str = "customer_id",
    label: str = LABEL,
    fraction: Decimal = TEST_FRACTION,
    seed: int = HASH_SEED,
) -> DataFrame:
    """Add ``split``: exactly ceil(fraction * rows) of each label are 'test', drawn by seeded hash, the rest 'train'.

    A row without a label belongs to neither part: its split is NULL.

    Two passes over (key, label) find one cut hash per label; no row of the table itself is shuffled.
    """
    cuts = hash_cuts(df, key, label, [fraction], seed).select(label, "cut_hash")
    is_test = seeded_hash(key, seed) <= F.col("cut_hash")
    return (
        df.join(F.broadcast(cuts), label, "left")  # one row per label
        .withColumn("split", F.when(F.col(label).isNotNull(), F.when(is_test, "test").otherwise("train")))
        .select(*df.columns, "split")
    )


def stratified_folds(
    df: DataFrame, key: str = "customer_id", label: str = LABEL, k: int = N_FOLDS, seed: int = HASH_SEED
) -> DataFrame:
    """Add ``fold`` 0..k-1, each label spread evenly (sizes differ by at most one) and at random by seeded hash.

    A row without a label has no fold.
    """
    fractions = [Decimal(i) / k for i in range(1, k)]
    cuts = (
        hash_cuts(df, key, label, fractions, seed)
        .groupBy(label)
        .agg(F.collect_list("cut_hash").alias("cuts"))  # k - 1 entries
    )
    fold = F.size(F.filter("cuts", lambda cut: cut < seeded_hash(key, seed)))
    return df.join(F.broadcast(cuts), label, "left").withColumn("fold", F.when(F.col(label).isNotNull(), fold)).select(*df.columns, "fold")


def class_weight(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Negatives per positive: the weight that balances the positive class."""
    positives, negatives = F.count_if(F.col(label) == 1), F.count_if(F.col(label) == 0)
    return df.agg(
        negatives.alias("n_negative"),
        positives.alias("n_positive"),
        (negatives / F.nullif(positives, F.lit(0))).alias("positive_weight"),
    )
