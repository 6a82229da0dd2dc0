import re
from datetime import timedelta
from decimal import Decimal

import pytest
from helpers import AS_OF, d, dec, plan, tuples
from pyspark.sql import functions as F

from stayline.functions.keys import surrogate_key
from stayline.operators import features
from stayline.plans.warehouse import Warehouse
from stayline.sources.samples import raw_tables
from stayline.sources.tables import parquet_store

FACT = (
    "customer_key string, content_key string, date_day date, session_id string, device_type string, "
    "watch_duration_minutes int, completion_percentage decimal(5,2), is_resumed boolean, engagement_level string, "
    "session_duration_bucket string"
)
TICKET = (
    "customer_key string, date_day date, category string, resolution_time_hours decimal(10,1), is_resolved boolean, "
    "sentiment_score decimal(5,2), resolution_tier string, sentiment_tier string"
)
CUSTOMER = (
    "customer_id string, age int, age_band string, signup_date date, plan_type string, monthly_revenue decimal(10,2), "
    "is_churned boolean, churn_date date, acquisition_channel string, device_type string, activity_level string"
)


def viewing(days_ago, minutes=30, level="engaged", customer="c1", title="t1"):
    day = AS_OF - timedelta(days=days_ago)
    return (customer, title, day, f"s{days_ago}", "mobile", minutes, dec("50.00"), None, level, "medium")


def table(spark, watches=(), subscriptions=(), tickets=(), ratings=(), watchlist=(), people=("c1",)):
    """The feature table over hand-written facts; keys are the hashed ids."""

    def hashed(df):
        return df.withColumn("customer_key", F.md5("customer_key"))

    customers = spark.createDataFrame(
        [(p, 30, "25-34", d("2024-06-01"), "basic", dec("9.99"), False, None, "organic", "watch", "low") for p in people],
        CUSTOMER,
    ).withColumn("customer_key", surrogate_key("customer_id"))
    return features.feature_table(
        customers,
        hashed(spark.createDataFrame(list(watches), FACT)),
        hashed(spark.createDataFrame(list(subscriptions), "customer_key string, event_type string")),
        hashed(spark.createDataFrame(list(tickets), TICKET)),
        spark.createDataFrame(list(ratings), "customer_id string, rating int"),
        spark.createDataFrame(list(watchlist), "customer_id string, is_watched boolean"),
        AS_OF,
    )


def test_registry():
    assert len(features.FEATURES) == len(set(features.FEATURES)) == 55
    assert [len(g) for g in features.FEATURE_GROUPS.values()] == [7, 17, 5, 6, 10, 4, 3, 3]


def test_customer_without_facts_gets_the_defaults(spark):
    row = table(spark).first().asDict()
    assert list(row) == [*features.KEY_AND_TARGET, *features.FEATURES]
    undefined = {
        "avg_watch_duration_min", "max_watch_duration_min", "avg_completion_pct", "completion_rate", "abandonment_rate",
        "resume_rate", "watch_trend_7d_vs_30d", "avg_resolution_hours", "avg_sentiment_score", "min_sentiment_score",
        "negative_ticket_rate", "avg_rating_given", "watchlist_conversion_rate", "target_churn_date", "device_type_encoded",
    }
    assert {name for name, value in row.items() if value is None} == undefined
    assert row["days_since_last_watch"] == 9999
    assert (row["tenure_days"], row["age_band_encoded"], row["plan_type_encoded"]) == (29, 2, 1)
    assert row["recency_risk_score"] == 5
    assert row["heuristic_churn_risk_score"] == 6  # long away and nothing in the last week
    assert row["support_frustration_score"] == 0.0
    assert row["total_watch_events"] == row["total_ratings"] == row["has_downgraded"] == 0


def test_recent_windows_include_their_first_day(spark):
    row = table(spark, [viewing(n, minutes=10 + n) for n in (7, 8, 30, 31)]).first()
    assert (row.watch_events_last_7d, row.watch_minutes_last_7d) == (1, 17)
    assert (row.watch_events_last_30d, row.watch_minutes_last_30d) == (3, 17 + 18 + 40)
    assert row.watch_trend_7d_vs_30d == dec("1.43")  # 1 / (3 / 4.28)
    assert row.total_watch_events == 4


def test_trend_is_undefined_without_recent_viewing(spark):
    assert table(spark, [viewing(31)]).first().watch_trend_7d_vs_30d is None


@pytest.mark.parametrize(
    ("days_ago", "score"), [(-2, 1), (0, 1), (1, 2), (2, 2), (3, 3), (6, 3), (7, 4), (13, 4), (14, 5)]
)
def test_recency_score(spark, days_ago, score):
    row = table(spark, [viewing(days_ago)]).first()
    assert (row.days_since_last_watch, row.recency_risk_score) == (days_ago, score)


def test_distinct_counts_and_rates(spark):
    watches = [viewing(1, level="completed"), viewing(1, level="abandoned"), viewing(2, title="t2", level="abandoned")]
    row = table(spark, watches).first()
    assert (row.total_active_days, row.unique_titles_watched, row.unique_sessions, row.device_count) == (2, 2, 2, 1)
    assert (row.completed_count, row.abandoned_count) == (1, 2)
    assert (row.completion_rate, row.abandonment_rate) == (dec("0.33"), dec("0.67"))


def test_abandonment_points_use_the_rounded_rate(spark):
    # 99 of 199 abandoned: 0.4975 rounds to 0.50 and counts
    watches = [viewing(1, level="abandoned")] * 99 + [viewing(1)] * 100
    row = table(spark, watches).first()
    assert row.abandonment_rate == Decimal("0.50")
    assert row.heuristic_churn_risk_score == 2


def test_heuristic_adds_up_to_twelve(spark):
    bad = ("c1", AS_OF, "billing", dec("50.0"), False, dec("-0.50"), "critical", "negative")
    row = table(
        spark,
        [viewing(40, level="abandoned")],
        [("c1", "downgrade"), ("c1", "subscribe"), ("c1", "upgrade"), ("c1", "downgrade")],
        [bad, bad],
    ).first()
    assert row.heuristic_churn_risk_score == 12
    assert row.support_frustration_score == 3 * 2 + 2 * 2 + 2 * 2
    assert (row.net_plan_changes, row.total_subscription_events, row.has_downgraded) == (-1, 4, 1)


def test_unresolved_counts_only_false(spark):
    rows = [
        ("c1", AS_OF, "content", dec("1.0"), resolved, None, "quick", "negative") for resolved in (True, False, None)
    ]
    row = table(spark, tickets=rows).first()
    assert (row.total_support_tickets, row.unresolved_ticket_count, row.avg_sentiment_score) == (3, 1, None)


def test_ratings_and_watchlist_of_unknown_customers_drop_out(spark):
    out = table(
        spark,
        ratings=[("c1", 1), ("c1", 2), ("c1", 4), ("c1", None), ("nobody", 5)],
        watchlist=[("c1", True), ("c1", None), ("nobody", True)],
        people=("c1", "c2"),
    )
    names = ("customer_id", "total_ratings", "avg_rating_given", "low_ratings_count", "high_ratings_count")
    assert tuples(out, *names) == [("c1", 4, 2.33, 2, 1), ("c2", 0, None, 0, 0)]
    listed = ("customer_id", "total_watchlist_items", "watchlist_watched_count", "watchlist_conversion_rate")
    assert tuples(out, *listed) == [("c1", 2, 1, dec("0.50")), ("c2", 0, 0, None)]


def test_standalone_rating_features_keep_known_customers_only(spark):
    ratings = spark.createDataFrame([("c1", 5), ("nobody", 1)], "customer_id string, rating int")
    known = spark.createDataFrame([("c1",)], "customer_id string").withColumn("customer_key", F.md5("customer_id"))
    assert features.rating_features(ratings, known).count() == 1


def test_one_row_per_customer_and_stable_when_run_twice(spark):
    warehouse = Warehouse(raw_tables(spark, "/root/testdata/sf0.001"), AS_OF)
    store = warehouse["ml_churn_feature_store"]
    first, second = store.collect(), store.collect()
    assert len(first) == warehouse["dim_customer"].count()
    assert sorted(first) == sorted(second)


def test_the_assembly_joins_on_the_grouping_key(spark, conf):
    """Without broadcasts the sides are joined on the key they were grouped by, with no exchange above an aggregate."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    physical = plan(table(spark)).split("== Physical Plan ==")[1]
    # six joins of the domains, two of the distinct counts, and two for the numbers of the titles
    assert physical.count("SortMergeJoin") == 10
    # each side of a join on the customer is shuffled by that key once, where its aggregate gathers it
    assert len(re.findall(r"Exchange hashpartitioning\(customer_key#\d+, \d+\)", physical)) == 9
    assert "Expand" not in physical


def test_the_stored_fact_is_read_by_column(spark, conf, tmp_path):
    """Measures and each kind of distinct count read the columns they need and leave the ids of the fact alone."""
    conf(spark__sql__maxMetadataStringLength="2000", spark__sql__debug__maxToStringFields="200")
    store = parquet_store(str(tmp_path))
    fact = Warehouse(raw_tables(spark, "/root/testdata/sf0.001"), AS_OF, store)["fct_watch_event"]
    physical = plan(features.watch_features(fact, AS_OF)).split("== Physical Plan ==")[1]
    scans = [set(re.findall(r"(\w+):", text)) for text in re.findall(r"ReadSchema: struct<([^>]*)>", physical)]
    assert set.union(*scans) & {"watch_event_key", "watch_event_id", "watch_start_time"} == set()
    for columns in ({"customer_key", "date_day", "content_key"}, {"customer_key", "session_id"}, {"customer_key", "device_type"}):
        assert scans.count(columns) == 1


def test_rows_without_a_customer_id_are_nobodys(spark):
    people = spark.createDataFrame([("c1",), (None,)], "customer_id string")
    known = people.withColumn("customer_key", surrogate_key("customer_id"))
    ratings = spark.createDataFrame([("c1", 5), (None, 1)], "customer_id string, rating int")
    listed = spark.createDataFrame([("c1", True), (None, True)], "customer_id string, is_watched boolean")
    assert features.rating_features(ratings, known).count() == 1
    assert features.watchlist_features(listed, known).count() == 1


def test_distinct_counts_by_bitmaps_equal_plain_ones(spark):
    """Days before 1970, more titles than one bitmap holds, missing values, and no expansion of rows."""
    fact = spark.range(60_000).selectExpr(
        "concat('k', if(id < 45000, 0, id % 50)) customer_key",
        "if(id % 97 = 0, null, date_add(date'1960-01-01', cast(id * 7919 % 30000 as int))) date_day",
        "if(id % 89 = 0, null, md5(cast(id % 41000 as string))) content_key",
        "if(id % 83 = 0, null, concat('s', id div 2)) session_id",
        "if(id % 5 = 0, null, concat('d', id % 7)) device_type",
    )
    names = {"date_day": "total_active_days", "content_key": "unique_titles_watched", "session_id": "unique_sessions", "device_type": "device_count"}
    want = fact.groupBy("customer_key").agg(*(F.count_distinct(c).alias(name) for c, name in names.items()))
    for titles in (None, fact.select("content_key")):
        got = features.watch_variety(fact, titles)
        assert tuples(got, "customer_key", *names.values()) == tuples(want, "customer_key", *names.values())
    assert "Expand" not in plan(features.watch_features(watched_fact(spark), AS_OF))


def watched_fact(spark):
    columns = "customer_key string, date_day date, content_key string, session_id string, device_type string, engagement_level string"
    rest = "watch_duration_minutes int, completion_percentage decimal(5,2), is_resumed boolean, session_duration_bucket string"
    return spark.createDataFrame([], f"{columns}, {rest}")


def test_a_title_is_a_bit_of_a_word_not_of_a_whole_bitmap(spark):
    """A bitmap of 4 KB for each title seen would be most of what is shuffled where titles are many."""
    assert "bitmap" not in plan(features.watch_variety(watched_fact(spark)))


def test_the_fact_is_joined_once_for_all_features(spark):
    from stayline.plans.queries import QUERIES

    physical = plan(QUERIES["feat_watch"](spark, "/root/testdata/sf0.001"))
    assert "l_orderkey" not in physical


def test_gathered_counts_equal_plain_ones(spark):
    """Hot customers beside ordinary ones, keys that are digests and others, missing values."""
    fact = spark.range(20_000).selectExpr(
        "case when id % 3 = 0 then 'hot' when id % 101 = 0 then 'one' else md5(cast(id % 50 as string)) end customer_key",
        "if(id % 97 = 0, null, date_add(date'1960-01-01', cast(id * 7919 % 30000 as int))) date_day",
        "case when id % 89 = 0 then null when id % 5 = 0 then concat('t', id % 700) else md5(cast(id % 4100 as string)) end content_key",
        "if(id % 83 = 0, null, concat('s', id div 2)) session_id",
        "if(id % 5 = 0, null, concat('d', id % 7)) device_type",
    ).unionByName(spark.sql("select 'blank' customer_key, date(null) date_day, string(null) content_key, string(null) session_id, string(null) device_type"))
    want = fact.groupBy("customer_key").agg(*(F.count_distinct(c).alias(name) for c, name in features.VARIETY.items()))
    for longest in (features.LONG_HISTORY, 1_000, 0):
        got = features.gathered_variety(fact, longest)
        assert tuples(got, "customer_key", *features.VARIETY.values()) == tuples(want, "customer_key", *features.VARIETY.values())


def test_a_stored_fact_is_shuffled_once_for_the_distinct_counts(spark, conf, tmp_path):
    """No dictionary of titles is joined, and nothing but hot customers is spread by value."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    warehouse = Warehouse(raw_tables(spark, "/root/testdata/sf0.001"), AS_OF, parquet_store(str(tmp_path)))
    assert warehouse.keeps("fct_watch_event") and not warehouse.keeps("stg_watch_events")
    physical = plan(features.watch_features(warehouse["fct_watch_event"], AS_OF, stored=True)).split("== Physical Plan ==")[1]
    assert physical.count("SortMergeJoin") == 1
    assert len(re.findall(r"hashpartitioning\(customer_key#\d+, \d+\), REPARTITION_BY_COL", physical)) == 1
    assert "Expand" not in physical


def test_a_stored_fact_gives_the_features_of_a_lazy_one(spark):
    """Taken together where a customer's viewings meet, and apart for customers of very many viewings."""
    fact = spark.range(3_000).selectExpr(
        "if(id % 3 = 0, 'hot', md5(cast(id % 50 as string))) customer_key",
        "date_add(date'2024-01-01', cast(id * 7919 % 180 as int)) date_day",
        "if(id % 89 = 0, null, md5(cast(id % 410 as string))) content_key",
        "concat('s', id div 2) session_id",
        "if(id % 5 = 0, null, concat('d', id % 7)) device_type",
        "case id % 3 when 1 then 'completed' when 2 then 'abandoned' end engagement_level",
        "cast(id % 200 as int) watch_duration_minutes",
        "cast(id % 101 as decimal(5,2)) completion_percentage",
        "id % 4 = 0 is_resumed",
        "if(id % 2 = 0, 'binge', 'short') session_duration_bucket",
    )
    want = features.watch_features(fact, AS_OF)
    for longest in (features.LONG_HISTORY, 500, 0):
        got = features.watch_features(fact, AS_OF, stored=True, longest=longest)
        assert got.dtypes == want.dtypes
        assert tuples(got) == tuples(want)


def test_raw_viewings_are_joined_once_for_a_fact_that_is_kept(spark, tmp_path):
    raw = raw_tables(spark, "/root/testdata/sf0.001")
    kept = Warehouse(raw, AS_OF, parquet_store(str(tmp_path)))
    assert "l_orderkey" not in plan(kept["stg_watch_events"])
    assert tuples(kept["stg_watch_events"]) == tuples(Warehouse(raw, AS_OF)["stg_watch_events"])
    assert "l_orderkey" in plan(Warehouse(raw, AS_OF)["stg_watch_events"])
