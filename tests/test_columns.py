import hashlib

import pytest
from helpers import dec, mapping
from pyspark.sql import functions as F

from stayline.functions import columns, vocab
from stayline.functions.keys import NULL_COMPONENT, surrogate_key


def _labels(spark, kind, values, build):
    df = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    by_row = mapping(df.withColumn("label", build(F.col("v"))), "i", "label")
    return [by_row[i] for i in range(len(values))]


def test_surrogate_key_components(spark):
    df = spark.createDataFrame([("a", "b"), ("a-b", None), (None, None), ("", "")], "x string, y string")
    got = [row[0] for row in df.select(surrogate_key("x", "y")).collect()]
    texts = ["a-b", f"a-b-{NULL_COMPONENT}", f"{NULL_COMPONENT}-{NULL_COMPONENT}", "-"]
    assert got == [hashlib.md5(t.encode()).hexdigest() for t in texts]


def test_surrogate_key_of_a_date_hashes_its_text(spark):
    df = spark.sql("select date '2024-01-05' d")
    assert df.select(surrogate_key("d")).first()[0] == hashlib.md5(b"2024-01-05").hexdigest()


@pytest.mark.parametrize(
    ("ladder", "build", "kind", "cases"),
    [
        (
            vocab.AGE_BANDS,
            columns.below,
            "int",
            {24: "18-24", 25: "25-34", 34: "25-34", 35: "35-44", 44: "35-44", 45: "45-54", 54: "45-54", 55: "55+", None: "55+"},
        ),
        (
            vocab.RATING_LADDER,
            columns.at_least,
            "decimal(3,1)",
            {
                dec("8.0"): "highly_rated",
                dec("7.9"): "well_rated",
                dec("6.5"): "well_rated",
                dec("6.4"): "average",
                dec("5.0"): "average",
                dec("4.9"): "below_average",
                None: "below_average",
            },
        ),
        (
            vocab.ENGAGEMENT_LADDER,
            columns.at_least,
            "decimal(5,2)",
            {
                dec("9.99"): "abandoned",
                dec("10.00"): "sampled",
                dec("49.99"): "sampled",
                dec("50.00"): "engaged",
                dec("89.99"): "engaged",
                dec("90.00"): "completed",
                dec("0.95"): "abandoned",
                None: "abandoned",
            },
        ),
        (
            vocab.SESSION_LADDER,
            columns.at_most,
            "int",
            {15: "short", 16: "medium", 60: "medium", 61: "long", 120: "long", 121: "binge", None: "binge"},
        ),
        (
            vocab.RESOLUTION_LADDER,
            columns.at_most,
            "decimal(10,1)",
            {
                dec("4.0"): "quick",
                dec("4.1"): "standard",
                dec("24.0"): "standard",
                dec("24.1"): "slow",
                dec("48.0"): "slow",
                dec("48.1"): "critical",
                None: "critical",
            },
        ),
        (
            vocab.SENTIMENT_LADDER,
            columns.at_least,
            "decimal(5,2)",
            {
                dec("0.30"): "positive",
                dec("0.29"): "neutral",
                dec("-0.30"): "neutral",
                dec("-0.31"): "negative",
                None: "negative",
            },
        ),
        (
            vocab.RECENCY_LADDER,
            columns.at_least,
            "int",
            {-3: 1, 0: 1, 1: 2, 2: 2, 3: 3, 6: 3, 7: 4, 13: 4, 14: 5, 9999: 5},
        ),
    ],
)
def test_ladders_at_their_bounds(spark, ladder, build, kind, cases):
    assert _labels(spark, kind, list(cases), lambda v: build(v, *ladder)) == list(cases.values())


def test_lookup_leaves_unmapped_values_null(spark):
    values = ["basic", "premium", "gold", None]
    assert _labels(spark, "string", values, lambda v: columns.lookup(v, vocab.PLAN_CODES)) == [1, 3, None, None]


def test_lookup_default(spark):
    values = ["cancel", "pause", None]
    got = _labels(spark, "string", values, lambda v: columns.lookup(v, *vocab.REVENUE_CATEGORIES))
    assert got == ["churned", "other", "other"]


def test_share_of_rows_ignores_null_conditions_and_rounds_half_up(spark):
    df = spark.createDataFrame([(True,)] + [(False,)] * 6 + [(None,)], "c boolean")
    assert df.agg(columns.share_of_rows(F.col("c"))).first()[0] == dec("0.13")


def test_packed_keys_stay_apart_and_come_back(spark):
    from stayline.functions.keys import packed, unpacked

    digest = "0123456789abcdef" * 2
    keys = [None, "", "c1", digest, digest.upper(), digest[:-1] + "\n", digest + "\n", "g" * 32, "0123456789abcdef", "\x00" * 17, "é" * 16]
    held = spark.createDataFrame([(k,) for k in keys], "k string").select("k", packed("k").alias("p"))
    rows = held.select("k", "p", unpacked("p").alias("back")).collect()
    assert all(r.back == r.k for r in rows)
    assert len({r.p and bytes(r.p) for r in rows}) == len(keys)
    assert [len(r.p) for r in rows if r.k == digest] == [16]
