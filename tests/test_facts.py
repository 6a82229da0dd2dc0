from collections import Counter

import pytest
from helpers import d, dec, plan, tuples
from pyspark.sql import functions as F

from stayline.functions.keys import surrogate_key
from stayline.operators import dims, facts

WATCH = (
    "watch_event_key string, watch_event_id string, customer_id string, content_id string, watch_date date, "
    "watch_start_time string, watch_duration_minutes int, completion_percentage decimal(5,2), device_type string, "
    "session_id string, is_resumed boolean"
)
SUBSCRIPTION = (
    "subscription_event_key string, customer_id string, event_type string, event_date date, plan_type string, "
    "monthly_revenue decimal(10,2), cancellation_reason string"
)


def customers(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "customer_id string").withColumn(
        "customer_key", surrogate_key("customer_id")
    )


def content(spark, *ids):
    return spark.createDataFrame([(i, f"key-{i}") for i in ids], "content_id string, content_key string")


def watch(n, customer="c1", title="t1", day="2024-03-01", minutes=30, completion="50.00", resumed=False):
    return (f"k{n}", f"w{n}", customer, title, d(day), "20:00:00", minutes, dec(completion), "mobile", "s1", resumed)


def sub(customer, kind, day, plan_type="basic", price="9.99", reason=None):
    return (f"{customer}-{kind}-{day}", customer, kind, d(day), plan_type, dec(price), reason)


def test_watch_fact_drops_unknown_keys(spark):
    events = spark.createDataFrame([watch(1), watch(2, customer="nobody"), watch(3, title="nothing")], WATCH)
    out = facts.fct_watch_event(events, customers(spark, "c1"), content(spark, "t1"))
    assert tuples(out, "watch_event_id", "content_key") == [("w1", "key-t1")]
    assert "customer_id" not in out.columns


def test_completion_scale_reads_fractions(spark):
    events = spark.createDataFrame([watch(1, completion="0.95"), watch(2, completion="0.05")], WATCH)
    dim = customers(spark, "c1"), content(spark, "t1")
    as_given = facts.fct_watch_event(events, *dim)
    assert tuples(as_given, "engagement_level") == [("abandoned",), ("abandoned",)]
    scaled = facts.fct_watch_event(events, *dim, completion_scale=100)
    assert tuples(scaled, "engagement_level") == [("abandoned",), ("completed",)]


def test_watch_fact_splits_a_hot_customer(spark, conf):
    """A customer with most of the events: the join reads its partition in pieces."""
    conf(
        spark__sql__shuffle__partitions="16",
        spark__sql__adaptive__coalescePartitions__minPartitionSize="1KB",
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10KB",
    )
    events = (
        spark.range(0, 20_000, 1, 8)
        .select(
            F.concat(F.lit("w"), "id").alias("watch_event_id"),
            F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), (F.col("id") % 500).cast("string"))).alias("customer_id"),
            F.concat(F.lit("t"), (F.col("id") % 50).cast("string")).alias("content_id"),
            F.lit(d("2024-03-01")).alias("watch_date"),
            F.lit("20:00:00").alias("watch_start_time"),
            F.lit(30).alias("watch_duration_minutes"),
            F.lit(50).cast("decimal(5,2)").alias("completion_percentage"),
            F.lit("mobile").alias("device_type"),
            F.col("id").cast("string").alias("session_id"),
            F.lit(False).alias("is_resumed"),
        )
        .withColumn("watch_event_key", F.md5("watch_event_id"))
    )
    dim = customers(spark, "hot", *[f"c{i}" for i in range(500)]), content(spark, *[f"t{i}" for i in range(50)])
    out = facts.fct_watch_event(events, *dim)
    assert len(out.collect()) == 20_000
    assert "skew=true" in plan(out)


def test_support_fact_tiers_and_day(spark):
    tickets = spark.sql(
        "select 'k' interaction_key, 't' ticket_id, 'c1' customer_id, 'billing' category, 'chat' channel, "
        "timestamp '2024-03-01 23:59:59' created_at, 24.1 resolution_time_hours, true is_resolved, -0.31 sentiment_score"
    )
    out = facts.fct_support_interaction(tickets, customers(spark, "c1"))
    assert tuples(out, "date_day", "resolution_tier", "sentiment_tier") == [(d("2024-03-01"), "slow", "negative")]
    assert facts.fct_support_interaction(tickets, customers(spark, "c2")).count() == 0


def daily(spark, watches, ratings=(), watchlist=()):
    return facts.fct_daily_user_activity(
        spark.createDataFrame(list(watches), WATCH),
        spark.createDataFrame(list(ratings), "customer_id string, rating int, rated_at date"),
        spark.createDataFrame(list(watchlist), "customer_id string, added_at date, is_watched boolean"),
        customers(spark, "c1"),
    )


def test_daily_activity_combines_a_day(spark):
    day = d("2024-03-01")
    row = daily(
        spark,
        [watch(1, completion="90.00", resumed=True), watch(2, title="t2", completion="10.00", resumed=None)],
        [("c1", 5, day), ("c1", 4, day)],
        [("c1", day, True), ("c1", day, None)],
    ).first()
    assert (row.sessions_count, row.titles_watched, row.total_watch_minutes) == (2, 2, 60)
    assert (row.avg_completion_pct, row.resumed_sessions, row.completed_titles) == (dec("50.000000"), 1, 1)
    assert (row.ratings_given, row.avg_rating, row.watchlist_adds, row.watchlist_conversions) == (2, 4.5, 2, 1)
    assert row.daily_engagement_score == 2 * 1.0 + 1 * 2.0 + 2 * 1.5 + 2 * 0.5
    assert row.is_binge_day is False


def test_daily_activity_needs_viewing_and_a_known_customer(spark):
    out = daily(
        spark,
        [watch(1), watch(2, customer="nobody"), watch(3, day=None)],
        [("c1", 5, d("2024-03-02"))],
        [("c1", d("2024-03-03"), True)],
    )
    got = tuples(out, "date_day", "ratings_given", "avg_rating", "watchlist_adds")
    assert got == [(None, 0, None, 0), (d("2024-03-01"), 0, None, 0)]


def test_daily_activity_attaches_its_parts_without_further_shuffles(spark, conf):
    """Two exchanges for the distinct titles, one per other aggregate, and two for the customer lookup at the end."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    physical = plan(daily(spark, [watch(1)])).split("== Physical Plan ==")[1]
    assert physical.count("SortMergeJoin") == 3
    assert physical.count("Exchange") == 6


@pytest.mark.parametrize(("titles", "binge"), [(2, False), (3, True)])
def test_binge_day_counts_distinct_titles(spark, titles, binge):
    events = [watch(i, title=f"t{i % titles}") for i in range(6)]
    assert daily(spark, events).first().is_binge_day is binge


def test_lag_follows_the_lifecycle(spark):
    events = spark.createDataFrame(
        [
            sub("c1", "cancel", "2023-05-01", price="0.00"),
            sub("c1", "subscribe", "2023-01-15"),
            sub("c1", "upgrade", "2023-05-01", "premium", "22.99"),
            sub("c1", "subscribe", "2022-12-31"),  # before the calendar: not seen by lag either
            sub("c2", "subscribe", "2023-02-01"),
            sub("nobody", "subscribe", "2023-02-01"),
        ],
        SUBSCRIPTION,
    )
    out = facts.fct_subscription_event(events, customers(spark, "c1", "c2"), dims.dim_date(spark))
    names = ("event_type", "previous_plan_type", "previous_monthly_revenue", "days_since_previous_event")
    assert tuples(out.where(F.col("customer_key") == F.md5(F.lit("c1"))), "date_day", *names) == [
        (d("2023-01-15"), "subscribe", None, None, None),
        (d("2023-05-01"), "cancel", "premium", dec("22.99"), 0),
        (d("2023-05-01"), "upgrade", "basic", dec("9.99"), 106),
    ]
    assert out.count() == 4


@pytest.mark.parametrize("longest", [3, 100_000])
def test_lag_with_copies_equals_the_row_by_row_walk(spark, monkeypatch, longest):
    """One customer holds most rows, most of them copies; small slices force the copies over several tasks, and a small limit cuts
    the history into days."""
    monkeypatch.setattr(facts, "_COPIES_PER_SLICE", 7)
    rows = [sub("hot", "subscribe", "2023-01-15")] * 50 + [sub("hot", "downgrade", "2023-03-01", "basic", "9.99")] * 3
    rows += [sub("hot", "upgrade", "2023-03-01", p, "15.49") for p in ("premium", "standard", "standard")]
    rows += [sub("hot", "cancel", "2023-03-01", "basic", "0.00", r) for r in ("too_expensive", None)]
    rows += [sub("c2", "subscribe", "2023-01-15")]
    order = {"subscribe": 0, "upgrade": 1, "downgrade": 2, "cancel": 3}
    expected, last = Counter(), {}
    for row in sorted(rows, key=lambda r: (r[1], r[3], order[r[2]], r[0], r[4], r[5], r[6] or "")):
        before = last.get(row[1])
        expected[
            (row[0], row[4], row[5], row[6])
            + ((before[4], before[5], (row[3] - before[3]).days) if before else (None, None, None))
        ] += 1
        last[row[1]] = row
    out = facts.fct_subscription_event(
        spark.createDataFrame(rows, SUBSCRIPTION).repartition(4), customers(spark, "hot", "c2"), dims.dim_date(spark), longest
    )
    got = out.select(
        "subscription_event_key",
        "plan_type",
        "monthly_revenue",
        "cancellation_reason",
        "previous_plan_type",
        "previous_monthly_revenue",
        "days_since_previous_event",
    ).collect()
    assert Counter(tuple(row) for row in got) == expected


def test_subscription_events_are_collapsed_once_for_both_branches(spark):
    events = spark.createDataFrame([sub("c1", "subscribe", "2023-02-01")] * 2, SUBSCRIPTION)
    out = facts.fct_subscription_event(events, customers(spark, "c1"), dims.dim_date(spark))
    assert len(out.collect()) == 2
    final = plan(out).split("Final Plan")[1].split("Initial Plan")[0]
    assert final.count("partial_count(1)") == 1


def test_revenue_category_of_an_unknown_event(spark):
    events = spark.createDataFrame([sub("c1", "pause", "2023-02-01")], SUBSCRIPTION)
    out = facts.fct_subscription_event(events, customers(spark, "c1"), dims.dim_date(spark))
    assert out.first().revenue_category == "other"


def test_digests_are_made_behind_the_joins_and_other_keys_are_kept(spark):
    events = spark.createDataFrame([watch(1), watch(2)], WATCH)
    light = events.withColumn("watch_event_key", F.md5("watch_event_id"))
    own = events.withColumn("watch_event_key", F.when(F.col("watch_event_id") == "w1", "own"))
    dim = customers(spark, "c1"), content(spark, "t1")
    digests = facts.fct_watch_event(light, *dim)
    lines = digests._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert "md5" in "".join(lines[: next(i for i, line in enumerate(lines) if "Join" in line)])
    assert tuples(digests, "watch_event_id", "watch_event_key") == tuples(light, "watch_event_id", "watch_event_key")
    assert sorted(tuples(facts.fct_watch_event(own, *dim), "watch_event_id", "watch_event_key")) == [("w1", "own"), ("w2", None)]


def test_the_list_of_unusual_titles_gives_the_rows_of_the_join(spark, conf):
    """Titles that are missing, there twice, there under another key or under none; viewings without a title."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    usual = spark.createDataFrame([("t1",), ("t2",), ("t2",), ("t6",)], "content_id string").withColumn("content_key", surrogate_key("content_id"))
    other = spark.createDataFrame([("t3", "key-t3"), ("t4", None), ("t5", ""), ("t6", "=x"), (None, "k")], "content_id string, content_key string")
    titles = usual.unionByName(other)
    events = spark.createDataFrame([watch(i, title=t) for i, t in enumerate(["t1", "t1", "t2", "t3", "t4", "t5", "t6", "t9", None])], WATCH)
    listed = facts.unusual_titles(events, titles)
    assert Counter(r.content_id for r in listed.collect()) == {"t2": 2, "t3": 1, "t4": 1, "t5": 1, "t6": 2, "t9": 1}
    joined = facts.fct_watch_event(events, customers(spark, "c1"), titles)
    found = facts.fct_watch_event(events, customers(spark, "c1"), titles, unusual=listed)
    assert len(tuples(joined)) == 9 and tuples(found) == tuples(joined)
    assert plan(found).split("== Physical Plan ==")[1].count("BroadcastHashJoin") == 1


def test_a_stored_fact_joins_titles_only_where_many_are_unusual(spark, tmp_path, monkeypatch):
    from helpers import AS_OF

    from stayline.plans import warehouse
    from stayline.sources.samples import raw_tables
    from stayline.sources.tables import parquet_store

    given = []
    plain = facts.fct_watch_event
    monkeypatch.setattr(facts, "fct_watch_event", lambda *a, **k: given.append(k["unusual"]) or plain(*a, **k))
    stored = {}
    for name, most in (("list", warehouse.UNUSUAL_MAX), ("join", -1)):
        monkeypatch.setattr(warehouse, "UNUSUAL_MAX", most)
        store = parquet_store(str(tmp_path / name))
        stored[name] = tuples(warehouse.Warehouse(raw_tables(spark, "/root/testdata/sf0.001"), AS_OF, store)["fct_watch_event"])
    assert stored["list"] == stored["join"]
    assert given[0] is not None and given[1] is None


def test_the_list_of_unusual_customers_gives_the_rows_of_the_join(spark, conf):
    """Customers that are missing, there twice, under a key of their own or under none; viewings without a customer."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    people = customers(spark, "c1", "c2", "c2").unionByName(
        spark.createDataFrame([("c3", "own"), ("c4", None), (None, "k")], "customer_id string, customer_key string")
    )
    titles = spark.createDataFrame([("t1",)], "content_id string").withColumn("content_key", surrogate_key("content_id"))
    events = spark.createDataFrame([watch(i, customer=c) for i, c in enumerate(["c1", "c1", "c2", "c3", "c4", "c9", None])], WATCH)
    listed = facts.unusual_customers(events, people)
    assert Counter(r.customer_id for r in listed.collect()) == {"c2": 2, "c3": 1, "c4": 1, "c9": 1}
    joined = facts.fct_watch_event(events, people, titles)
    found = facts.fct_watch_event(events, people, titles, unusual=facts.unusual_titles(events, titles), unusual_customers=listed)
    assert len(tuples(joined)) == 6 and tuples(found) == tuples(joined)
    assert plan(found).split("== Physical Plan ==")[1].count("BroadcastHashJoin") == 2
