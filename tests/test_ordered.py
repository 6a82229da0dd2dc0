import hashlib
import math
import random
import statistics
from collections import Counter, defaultdict
from decimal import Decimal

import pytest
from helpers import mapping, plan, tuples
from pyspark.sql import functions as F

from stayline.operators import matrix, ordered


def _people(spark, counts):
    rows = [(f"u{label}-{i}", label) for label, n in counts.items() for i in range(n)]
    return spark.createDataFrame(rows, "customer_id string, label int").repartition(4)


def _walk(keys, seed=42):
    return sorted(keys, key=lambda k: hashlib.md5(f"{seed}|{k}".encode()).hexdigest())


@pytest.mark.parametrize("counts", [{0: 853, 1: 147}, {0: 1, 1: 4}, {0: 35, 1: 15}])
def test_split_takes_exactly_the_first_fifth_of_each_label(spark, counts):
    df = _people(spark, counts)
    got = mapping(matrix.stratified_split(df), "customer_id", "split")
    for label, n in counts.items():
        order = _walk([k for k in got if k.startswith(f"u{label}-")])
        n_test = math.ceil(Decimal(n) * Decimal("0.2"))
        assert [got[k] for k in order] == ["test"] * n_test + ["train"] * (n - n_test)


def test_split_depends_on_the_seed_only(spark):
    df = _people(spark, {0: 200, 1: 50})
    again = df.repartition(7, "label")
    assert tuples(matrix.stratified_split(df)) == tuples(matrix.stratified_split(again))
    assert tuples(matrix.stratified_split(df)) != tuples(matrix.stratified_split(df, seed=7))


def test_a_key_with_very_many_copies_stays_in_one_part(spark):
    rows = [("hot", 0)] * 400 + [(f"u{i}", 0) for i in range(600)]
    df = spark.createDataFrame(rows, "customer_id string, label int").repartition(4)
    got = Counter((row.customer_id == "hot", row.split) for row in matrix.stratified_split(df).collect())
    assert sum(got.values()) == 1000
    assert len({part for hot, part in got if hot}) == 1
    assert got[(False, "test")] + got[(True, "test")] >= 200


def test_folds_are_even_within_each_label(spark):
    counts = {0: 502, 1: 48}
    folds = matrix.stratified_folds(_people(spark, counts))
    sizes = Counter((row.label, row.fold) for row in folds.collect())
    for label, n in counts.items():
        per_fold = [sizes[(label, f)] for f in range(5)]
        assert sum(per_fold) == n
        assert max(per_fold) - min(per_fold) <= 1


def test_splitting_does_not_shuffle_the_table(spark):
    wide = _people(spark, {0: 20, 1: 20}).withColumn("payload", F.repeat(F.lit("x"), 100))
    physical = plan(matrix.stratified_split(wide)).split("== Physical Plan ==")[1]
    for line in physical.splitlines():
        if "Exchange hashpartitioning" in line or "Exchange rangepartitioning" in line:
            assert "payload" not in line


def test_numbering_restarts_per_group_and_has_no_gaps(spark):
    rows = [("big" if i % 3 else "small", f"t{i}") for i in range(1000)]
    df = spark.createDataFrame(rows, "g string, id string").withColumn("h", F.md5("id")).repartition(4)
    got = ordered.numbered(df, "g", "h", "pos", digits=1).collect()
    by_group = defaultdict(list)
    for row in sorted(got, key=lambda r: (r.g, r.h)):
        by_group[row.g].append(row.pos)
    assert {g: p == list(range(1, len(p) + 1)) for g, p in by_group.items()} == {"big": True, "small": True}


@pytest.mark.parametrize("buckets", [2, 16, 256])
def test_running_totals_match_a_plain_walk(spark, buckets):
    rng = random.Random(buckets)
    rows = [(x, rng.randint(0, 9)) for x in {round(rng.gauss(0, 1), 3) for _ in range(500)}]
    df = spark.createDataFrame(rows, "x double, n int").repartition(4)
    got = mapping(ordered.running_totals(df, "x", ["n"], buckets), "x", "upto_n")
    total = 0
    for x, n in sorted(rows):
        total += n
        assert got[x] == total


def test_medians(spark):
    rng = random.Random(1)
    columns = {
        "even": [1.0, 2.0, 4.0, 10.0],
        "odd": [5.0, 1.0, 9.0],
        "one": [7.0],
        "ties": [0.0] * 50 + [1.0] * 50,
        "gauss": [rng.gauss(0, 100) for _ in range(3001)],
        "steps": [float(rng.randint(0, 5)) for _ in range(2000)],
        "none": [],
    }
    n = max(map(len, columns.values()))
    rows = [tuple(v[i] if i < len(v) else None for v in columns.values()) for i in range(n)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns)).repartition(8)
    got = mapping(ordered.exact_medians(df, list(columns)), "column_name", "median")
    assert got == {c: statistics.median(v) for c, v in columns.items() if v}


def test_impute_fills_only_what_is_null(spark):
    df = spark.createDataFrame([("a", 0, 1.0, None), ("b", 1, None, None), ("c", 0, 3.0, None)], "customer_id string, label int, age double, tenure_days double")
    medians = matrix.fit_medians(df)
    assert medians == {"age": 2.0}
    assert tuples(matrix.impute(df, medians)) == [("a", 0, 1.0, None), ("b", 1, 2.0, None), ("c", 0, 3.0, None)]


def test_matrix_keeps_known_features_and_drops_text_that_is_no_number(spark):
    df = spark.createDataFrame(
        [("k", "c", True, "31", "basic", 1)],
        "customer_key string, customer_id string, target_is_churned boolean, age string, plan_type string, has_downgraded int",
    )
    out = matrix.feature_matrix(df)
    assert out.columns == ["customer_id", "label", "age", "has_downgraded"]
    assert tuples(out) == [("c", 1, 31.0, 1.0)]
    assert matrix.feature_matrix(df.withColumn("age", F.lit("old"))).first().age is None


def test_class_weight(spark):
    row = matrix.class_weight(_people(spark, {0: 9, 1: 3})).first()
    assert (row.n_negative, row.n_positive, row.positive_weight) == (9, 3, 3.0)
    assert matrix.class_weight(_people(spark, {0: 9})).first().positive_weight is None


def test_rows_without_a_label_belong_to_no_part(spark):
    df = _people(spark, {0: 40, 1: 10}).union(spark.createDataFrame([("x", None), ("y", None)], "customer_id string, label int"))
    assert Counter(r.split for r in matrix.stratified_split(df).collect()) == {"train": 40, "test": 10, None: 2}
    assert Counter(r.fold for r in matrix.stratified_folds(df).collect())[None] == 2


def test_median_of_a_million_different_values(spark):
    df = spark.range(0, 1_000_001, 1, 8).select(((F.col("id") * 7919) % 1_000_003).cast("double").alias("v"))
    values = sorted(i * 7919 % 1_000_003 for i in range(1_000_001))
    result = ordered.exact_medians(df, ["v"])
    assert result.collect()[0].median == values[500_000]
    assert "SinglePartition" not in plan(result)


@pytest.mark.parametrize("longest", [1, 40, 10_000])
def test_previous_values_of_a_long_history_are_carried_from_day_to_day(spark, longest):
    rng = random.Random(8)
    rows = [("hot", rng.choice([1, 1, 2, 5, 9, 30]), rng.randint(0, 10**6), rng.choice([None, 1, 2])) for _ in range(300)]
    rows += [(f"g{i % 7}", rng.randint(0, 4), i, i) for i in range(30)]
    df = spark.createDataFrame(rows, "g string, day int, tie int, v int").repartition(5)
    out = ordered.previous_values(df, "g", "day", [F.col("tie"), F.col("v")], ["v", "day"], longest)
    last, want = {}, []
    for g, day, tie, v in sorted(rows, key=lambda r: (r[0], r[1], r[2], r[3] is not None, r[3] or 0)):
        want.append((g, day, tie, v, *last.get(g, (None, None))))
        last[g] = v, day
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(want, key=repr)


def test_a_long_history_is_ordered_day_by_day_on_several_tasks(spark, conf):
    conf(spark__sql__adaptive__enabled="false", spark__sql__shuffle__partitions="8")
    df = spark.range(200_000).select(F.lit("hot").alias("g"), (F.col("id") % 900).cast("int").alias("day"), F.col("id").alias("tie"))
    out = ordered.previous_values(df, "g", "day", [F.col("tie")], ["tie"], 50_000)
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8
    assert max(sizes) < 2 * 200_000 / 8


def test_values_are_counted_before_they_are_placed(spark):
    """A table of many equal values sends few rows on: cells are counted by value first."""
    df = spark.range(2000).selectExpr("cast(id % 3 as double) a", "cast(id as double) b", "cast(null as double) c")
    medians = ordered.exact_medians(df, ["a", "b", "c"])
    lines = medians._jdf.queryExecution().executedPlan().toString().splitlines()
    for i in (i for i, line in enumerate(lines) if "Generate" in line):
        above = next(line for line in reversed(lines[:i]) if "Join" in line or "HashAggregate" in line)
        assert "HashAggregate" in above
    assert {r.column_name: r.median for r in medians.collect()} == {"a": 1.0, "b": 999.5}
    assert ordered.exact_medians(df, ["c"]).collect() == []
