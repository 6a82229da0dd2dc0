from datetime import datetime

import pytest
from helpers import AS_OF, mapping, tuples

from stayline.operators import quality
from stayline.plans.checks import CHECKS, count_by_kind


def test_the_declared_checks():
    assert count_by_kind() == {"not_null": 53, "unique": 16, "accepted_values": 12, "relationships": 8}


def test_column_checks(spark):
    df = spark.createDataFrame([(1, "a"), (None, "x"), (None, "x"), (4, "y"), (5, None)], "n int, v string")
    got = tuples(quality.column_checks(df, "t", ["n", "v"], {"v": ["a", "b"], "n": [1, 4, 5]}))
    assert got == [
        ("accepted_values", "t", "n", 0),
        ("accepted_values", "t", "v", 2),
        ("not_null", "t", "n", 2),
        ("not_null", "t", "v", 1),
    ]


def test_unique_counts_repeated_values_and_ignores_null(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, None), (2, None), (3, None)], "n int, v string")
    assert mapping(quality.unique_checks(df, "t", ["n", "v"]), "column_name", "n_failed") == {"n": 2, "v": 1}


def test_relationships_count_child_rows(spark):
    child = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "k string")
    parent = spark.createDataFrame([("a",)], "p string")
    assert quality.relationship_check(child, "t", "k", parent, "p").first().n_failed == 2
    assert quality.relationship_check(child.where("k = 'a'"), "t", "k", parent, "p").first().n_failed == 0


def test_checks_on_an_empty_table_pass(spark):
    empty = spark.createDataFrame([], "k string, v string")
    parts = [
        quality.column_checks(empty, "t", ["k"], {"v": ["a"]}),
        quality.unique_checks(empty, "t", ["k"]),
        quality.relationship_check(empty, "t", "k", empty, "k"),
    ]
    assert {row.status for row in quality.with_status(quality.union_all(parts)).collect()} == {"pass"}


def test_an_all_null_column_fails_not_null_only(spark):
    df = spark.createDataFrame([(None,), (None,)], "k string")
    report = quality.run_checks(
        {"t": df}, {"t": {"not_null": ["k"], "unique": ["k"], "accepted_values": {"k": ["a"]}}}, CHECKS_KINDS
    )
    assert mapping(report, "test", "status") == {"not_null": "fail", "unique": "pass", "accepted_values": "pass"}


CHECKS_KINDS = ("not_null", "unique", "accepted_values", "relationships")


@pytest.mark.parametrize(
    ("loaded", "status"),
    [
        (datetime(2024, 6, 29, 0, 0, 0), "pass"),
        (datetime(2024, 6, 28, 23, 59, 59), "warn"),
        (datetime(2024, 5, 31, 0, 0, 0), "warn"),
        (datetime(2024, 5, 30, 23, 59, 59), "error"),
        (None, "error"),
    ],
)
def test_freshness_at_its_bounds(spark, loaded, status):
    df = spark.createDataFrame([(loaded,)], "_loaded_at timestamp")
    assert quality.source_freshness(df, "t", AS_OF).first().status == status


def test_null_rates_are_sorted_and_flagged_above_the_threshold(spark):
    rows = [(None, 1, None if i == 0 else i) for i in range(5)]
    df = spark.createDataFrame(rows, "a int, b int, c int")
    got = [tuple(r) for r in quality.null_rates(df).collect()]
    assert got == [("a", 1.0, True), ("c", 0.2, False), ("b", 0.0, False)]


def test_value_counts_leave_null_out(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "v string")
    assert tuples(quality.value_counts(df, "v")) == [("a", 2, 2 / 3), ("b", 1, 1 / 3)]


def test_catalog_checks(spark):
    df = spark.createDataFrame([("TMDB_M_1", "movie"), ("X_2", "short")], "content_id string, content_type string")
    report = quality.catalog_checks(df, ["content_id", "content_type", "title"])
    assert mapping(report, "test", "n_failed") == {"not_empty": 0, "has_columns": 1, "accepted_values": 1, "id_prefix": 1}
    assert mapping(quality.catalog_checks(df.limit(0), ["content_id"]), "test", "n_failed")["not_empty"] == 1


def test_every_checked_table_exists_in_the_warehouse(spark):
    from stayline.plans.warehouse import Warehouse
    from stayline.sources.samples import raw_tables

    warehouse = Warehouse(raw_tables(spark, "/root/testdata/sf0.001"), AS_OF)
    for name, declared in CHECKS.items():
        wanted = {c for kind in declared.values() for c in kind}
        assert wanted <= set(warehouse[name].columns), name


def test_values_travel_with_the_number_of_their_check(spark):
    from helpers import plan

    tables = {"t": spark.createDataFrame([("a",), ("a",)], "k string"), "p": spark.createDataFrame([("b",)], "k string")}
    checks = {"t": {"unique": ["k"], "relationships": {"k": ("p", "k")}}, "p": {"unique": ["k"]}}
    report = quality.run_checks(tables, checks, ["unique", "relationships"])
    assert "hashpartitioning(test" not in plan(report)
    found = {(r["test"], r["table_name"]): (r["n_failed"], r["status"]) for r in report.collect()}
    assert found == {("unique", "t"): (1, "fail"), ("unique", "p"): (0, "pass"), ("relationships", "t"): (2, "fail")}


def test_digests_travel_in_their_bytes(spark):
    """A key that only looks like another one in its bytes stays apart."""
    from helpers import plan

    digest = "0123456789abcdef" * 2
    rows = [(digest,), (digest,), (digest.upper(),), ("k",), (None,)]
    tables = {"t": spark.createDataFrame(rows, "k string"), "p": spark.createDataFrame([(digest,)], "k string")}
    report = quality.run_checks(tables, {"t": {"unique": ["k"], "relationships": {"k": ("p", "k")}}, "p": {}}, ["unique", "relationships"])
    assert mapping(report, "test", "n_failed") == {"unique": 1, "relationships": 2}
    assert "unhex" in plan(report)
