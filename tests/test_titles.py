import pytest
from helpers import AS_OF, d, dec, mapping, tuples

from stayline.operators import titles


def test_user_title_summary(spark):
    df = spark.createDataFrame(
        [("c", "t", dec("10.00"), d("2024-01-02")), ("c", "t", dec("90.00"), d("2024-01-01")), ("c", "u", None, None)],
        "customer_id string, content_id string, completion_percentage decimal(5,2), watch_date date",
    )
    assert tuples(titles.user_title_summary(df)) == [("c", "t", dec("90.00"), d("2024-01-02")), ("c", "u", None, None)]


def test_watchlist_flag_ignores_other_customers_and_repeats(spark):
    watches = spark.createDataFrame([("c1", "t1"), ("c1", "t1"), ("c2", "t2")], "customer_id string, content_id string")
    listed = spark.createDataFrame(
        [("w1", "c1", "t1", False), ("w2", "c1", "t2", True), ("w3", "c2", "t2", None), ("w4", None, "t1", None)],
        "watchlist_id string, customer_id string, content_id string, is_watched boolean",
    )
    assert titles.watched_set(watches).count() == 2
    got = mapping(titles.watchlist_watched_flag(listed, watches), "watchlist_id", "has_watched")
    assert got == {"w1": True, "w2": False, "w3": True, "w4": False}


def test_genre_pool_numbers_every_title_once(spark):
    df = spark.createDataFrame(
        [("Drama" if i % 3 else "Comedy", f"t{i}") for i in range(100)] + [(None, "x")],
        "primary_genre string, content_id string",
    )
    got = tuples(titles.genre_pool(df), "primary_genre", "pool_position")
    assert got == sorted([("Comedy", i) for i in range(1, 35)] + [("Drama", i) for i in range(1, 67)], key=repr)


def test_distinct_genres_leave_unknown_out(spark):
    df = spark.createDataFrame([("Drama",), ("Drama",), ("Unknown",), (None,)], "primary_genre string")
    assert tuples(titles.distinct_genres(df)) == [("Drama",)]


def test_preferred_genres(spark):
    df = spark.createDataFrame([("c", "Action|Drama"), ("e", "Comedy")], "customer_id string, preferred_genres string")
    assert tuples(titles.preferred_genres(df)) == [("c", "Action"), ("c", "Drama"), ("e", "Comedy")]


def test_popularity_share(spark):
    df = spark.createDataFrame([("a", dec("1.00")), ("b", dec("3.00")), ("c", None)], "content_id string, popularity decimal(10,2)")
    assert mapping(titles.popularity_share(df), "content_id", "popularity_share") == {"a": 0.25, "b": 0.75, "c": None}


def test_effective_runtime(spark):
    df = spark.createDataFrame(
        [("a", "tv_show", None), ("b", "movie", None), ("c", "tv_show", 0), ("d", "movie", -5), ("e", "movie", 100)],
        "content_id string, content_type string, runtime_minutes int",
    )
    got = mapping(titles.effective_runtime(df), "content_id", "effective_runtime")
    assert got == {"a": 45, "b": 90, "c": 45, "d": 90, "e": 100}


def test_active_span(spark):
    df = spark.createDataFrame(
        [("stays", d("2024-06-01"), False, None), ("left", d("2024-06-01"), True, d("2024-06-11"))],
        "customer_id string, signup_date date, is_churned boolean, churn_date date",
    )
    assert mapping(titles.active_span(df, AS_OF), "customer_id", "active_days") == {"stays": 29, "left": 10}


@pytest.mark.parametrize(("new", "old", "kind"), [(2, 1, "upgrade"), (1, 1, "downgrade"), (1, 2, "downgrade"), (1, None, "downgrade")])
def test_plan_change_type(spark, new, old, kind):
    df = spark.createDataFrame([(new, old)], "new int, old int")
    assert titles.plan_change_type(df, "new", "old").first().plan_change_type == kind
