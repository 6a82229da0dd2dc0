"""Fact tables.

Joins carry only the two key columns of a dimension and no broadcast hint: AQE broadcasts a dimension when its measured
size is under the threshold and otherwise sort-merges, splitting the partition of a customer or title that holds a
large share of the rows. Where a step would gather one customer's rows (windows), the rows are collapsed first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.functions import vocab
from stayline.functions.columns import at_least, at_most, count_where, lookup
from stayline.functions.keys import surrogate_key
from stayline.operators.ordered import LONG_HISTORY, previous_values

_COPIES_PER_SLICE = 100_000


def fct_watch_event(
    watches: DataFrame,
    customers: DataFrame,
    content: DataFrame,
    engagement=vocab.ENGAGEMENT_LADDER,
    completion_scale: int = 1,
    unusual: DataFrame | None = None,
    unusual_customers: DataFrame | None = None,
) -> DataFrame:
    """One row per viewing by a known customer of a known title.

    Completion is compared as given, on the ladder's own scale; ``completion_scale=100`` reads values stored as
    fractions. The title is looked up first: it is the smaller dimension, and the one that drops rows earliest. A key that
    is the digest of its id, as staging makes them, does not travel through the joins: it is made again behind them. With the
    ``unusual_titles`` of the same tables, a list short enough to be broadcast, the viewings are not shuffled to look up titles, and
    with ``unusual_customers`` not to look up customers.
    """
    completion = F.col("completion_percentage")
    if completion_scale != 1:
        completion = completion * completion_scale
    viewings = _light_key(watches, "watch_event_key", "watch_event_id")
    if unusual is None:
        of_titles = viewings.join(_title_keys(content), "content_id")
    else:
        of_titles = _with_key(viewings, unusual, "content_id", "content_key")
    if unusual_customers is None:
        of_both = of_titles.join(customers.select("customer_id", "customer_key"), "customer_id")
        customer_key = F.col("customer_key")
    else:
        of_both = _with_key(of_titles, unusual_customers, "customer_id", "customer_key")
        customer_key = _whole_key("customer_key", "customer_id")
    return of_both.select(
        _whole_key("watch_event_key", "watch_event_id"),
        customer_key,
        _whole_key("content_key", "content_id"),
        F.col("watch_date").alias("date_day"),
        "watch_event_id",
        "session_id",
        "device_type",
        "watch_start_time",
        "watch_duration_minutes",
        "completion_percentage",
        "is_resumed",
        at_least(completion, *engagement).alias("engagement_level"),
        at_most(F.col("watch_duration_minutes"), *vocab.SESSION_LADDER).alias("session_duration_bucket"),
    )


def unusual_titles(watches: DataFrame, content: DataFrame) -> DataFrame:
    """The watched titles that are not in ``content`` exactly once under the digest of their id: one row for each time a title is
    there, with its key, and one for a title that is not there. Copies of a title are dropped map-side, so only titles are shuffled."""
    return _unusual(watches, _title_keys(content), "content_id", "content_key")


def unusual_customers(watches: DataFrame, customers: DataFrame) -> DataFrame:
    """The same of the customers who watched."""
    keys = _light_key(customers.select("customer_id", "customer_key"), "customer_key", "customer_id")
    return _unusual(watches, keys, "customer_id", "customer_key")


def _unusual(watches: DataFrame, keys: DataFrame, source: str, key: str) -> DataFrame:
    usual = keys.groupBy(source).agg(
        F.count("*").alias("_n"), F.min(F.col(key).eqNullSafe(_DERIVED)).alias("_derived")
    ).where("_n = 1 and _derived")
    watched = watches.where(F.col(source).isNotNull()).select(source).distinct()
    return watched.join(usual, source, "left_anti").join(keys.withColumn("_found", F.lit(True)), source, "left").select(
        source, key, F.coalesce("_found", F.lit(False)).alias("_found")
    )


def _with_key(viewings: DataFrame, unusual: DataFrame, source: str, key: str) -> DataFrame:
    """The viewings whose id is known, once for each key of it: the list gives the keys of those in it, the others' are derived."""
    listed = viewings.where(F.col(source).isNotNull()).join(F.broadcast(unusual), source, "left")
    derived = F.when(F.col("_found"), F.col(key)).otherwise(F.lit(_DERIVED))
    return listed.where(F.coalesce("_found", F.lit(True))).withColumn(key, derived).drop("_found")


# Stands for a key that is the digest of its id; other keys follow a mark.
_DERIVED = ""


def _light_key(df: DataFrame, key: str, source: str) -> DataFrame:
    other = F.concat(F.lit("="), F.col(key))
    return df.withColumn(key, F.when(F.col(key).eqNullSafe(surrogate_key(source)), _DERIVED).otherwise(other))


def _whole_key(key: str, source: str) -> Column:
    return F.when(F.col(key) == _DERIVED, surrogate_key(source)).otherwise(F.substring(key, 2, 2**31 - 1)).alias(key)


def _title_keys(content: DataFrame) -> DataFrame:
    return _light_key(content.select("content_id", "content_key"), "content_key", "content_id")


def fct_support_interaction(tickets: DataFrame, customers: DataFrame) -> DataFrame:
    """One row per ticket of a known customer, with speed and mood tiers."""
    return tickets.join(customers.select("customer_id", "customer_key"), "customer_id").select(
        "interaction_key",
        "customer_key",
        F.to_date("created_at").alias("date_day"),
        "ticket_id",
        "category",
        "channel",
        "created_at",
        "resolution_time_hours",
        "is_resolved",
        "sentiment_score",
        at_most(F.col("resolution_time_hours"), *vocab.RESOLUTION_LADDER).alias("resolution_tier"),
        at_least(F.col("sentiment_score"), *vocab.SENTIMENT_LADDER).alias("sentiment_tier"),
    )


def watch_days(watches: DataFrame, completed_at: int = vocab.ENGAGEMENT_LADDER[0][0][0]) -> DataFrame:
    """Viewing per customer and day."""
    return watches.groupBy("customer_id", F.col("watch_date").alias("activity_date")).agg(
        F.count("*").alias("sessions_count"),
        F.count_distinct("content_id").alias("titles_watched"),
        F.sum("watch_duration_minutes").alias("total_watch_minutes"),
        F.avg("completion_percentage").alias("avg_completion_pct"),
        count_where(F.col("is_resumed")).alias("resumed_sessions"),
        count_where(F.col("completion_percentage") >= completed_at).alias("completed_titles"),
    )


def rating_days(ratings: DataFrame) -> DataFrame:
    """Ratings per customer and day."""
    return ratings.groupBy("customer_id", F.col("rated_at").alias("activity_date")).agg(
        F.count("*").alias("ratings_given"), F.avg("rating").alias("avg_rating")
    )


def watchlist_days(watchlist: DataFrame) -> DataFrame:
    """Watchlist additions per customer and day."""
    return watchlist.groupBy("customer_id", F.col("added_at").alias("activity_date")).agg(
        F.count("*").alias("watchlist_adds"), count_where(F.col("is_watched")).alias("watchlist_conversions")
    )


def fct_daily_user_activity(
    watches: DataFrame, ratings: DataFrame, watchlist: DataFrame, customers: DataFrame
) -> DataFrame:
    """One row per known customer and day with viewing; ratings and list additions of that day are attached.

    The three aggregates come out partitioned by (customer, day), so attaching them needs no further shuffle. The
    customer lookup goes last, over the aggregated days instead of the raw events.
    """
    on_day = ["customer_id", "activity_date"]
    days = (
        watch_days(watches)
        .join(rating_days(ratings), on_day, "left")
        .join(watchlist_days(watchlist), on_day, "left")
        .join(customers.select("customer_id", "customer_key"), "customer_id")
    )
    ratings_given = F.coalesce("ratings_given", F.lit(0))
    adds = F.coalesce("watchlist_adds", F.lit(0))
    weight = vocab.ENGAGEMENT_WEIGHTS
    score = (
        F.col("sessions_count") * weight["sessions"]
        + F.col("completed_titles") * weight["completed"]
        + ratings_given * weight["ratings"]
        + adds * weight["watchlist"]
    )
    return days.select(
        surrogate_key("customer_id", "activity_date").alias("activity_key"),
        "customer_key",
        F.col("activity_date").alias("date_day"),
        "sessions_count",
        "titles_watched",
        "total_watch_minutes",
        "avg_completion_pct",
        "resumed_sessions",
        "completed_titles",
        ratings_given.alias("ratings_given"),
        "avg_rating",
        adds.alias("watchlist_adds"),
        F.coalesce("watchlist_conversions", F.lit(0)).alias("watchlist_conversions"),
        score.alias("daily_engagement_score"),
        (F.col("titles_watched") >= vocab.BINGE_DAY_TITLES).alias("is_binge_day"),
    )


def fct_subscription_event(
    events: DataFrame, customers: DataFrame, dates: DataFrame, longest: int = LONG_HISTORY
) -> DataFrame:
    """Lifecycle events of known customers on calendar days, each with the plan, price and day of the one before.

    Events of one day are ordered subscribe, upgrade, downgrade, cancel, then by the remaining columns. Three steps keep
    a customer with an extreme number of rows off a single task. Rows equal in every column are first collapsed to one
    row with a count (combined map-side). A history of more than ``longest`` distinct rows is cut into days, and the last
    row of a day is carried to the next (``previous_values``). The copies are then put back by a distributed expansion;
    each copy follows an equal row, so its previous values are its own.
    """
    fields = events.columns
    calendar = dates.select(F.col("date_day").alias("event_date"))
    distinct = (
        events.join(calendar, "event_date", "left_semi")
        .groupBy(*fields)
        .agg(F.count("*").alias("_copies"))
        .join(customers.select("customer_id", "customer_key"), "customer_id")
    )
    lifecycle_rank = lookup(F.col("event_type"), {name: i for i, name in enumerate(vocab.EVENT_TYPES)}, 9)
    ties = [
        lifecycle_rank,
        *(F.col(c) for c in ("subscription_event_key", "plan_type", "monthly_revenue", "cancellation_reason")),
    ]
    # The filter drops nothing. It keeps the count in this branch, so both branches read one and the same exchange.
    chained = previous_values(
        distinct.where("_copies >= 1"), "customer_id", "event_date", ties, ["plan_type", "monthly_revenue", "event_date"], longest
    ).select(
        "*",
        F.datediff("event_date", "previous_event_date").alias("days_since_previous_event"),
    ).drop("previous_event_date")
    further = _repeat(distinct.where("_copies > 1"), F.col("_copies") - 1).select(
        "*",
        F.col("plan_type").alias("previous_plan_type"),
        F.col("monthly_revenue").alias("previous_monthly_revenue"),
        F.lit(0).alias("days_since_previous_event"),
    )
    return chained.unionByName(further).select(
        "subscription_event_key",
        "customer_key",
        F.col("event_date").alias("date_day"),
        "event_type",
        "plan_type",
        "monthly_revenue",
        "cancellation_reason",
        lookup(F.col("event_type"), *vocab.REVENUE_CATEGORIES).alias("revenue_category"),
        "previous_plan_type",
        "previous_monthly_revenue",
        "days_since_previous_event",
    )


def _repeat(df: DataFrame, times) -> DataFrame:
    """Each row ``times`` over; large counts are cut into slices that are spread over the tasks before expanding."""
    whole = df.withColumn("_times", times)
    sliced = whole.withColumn(
        "_slice", F.explode(F.sequence(F.lit(0), F.expr(f"(_times - 1) div {_COPIES_PER_SLICE}")))
    ).repartition("subscription_event_key", "_slice")
    in_slice = F.least(F.lit(_COPIES_PER_SLICE), F.col("_times") - F.col("_slice") * _COPIES_PER_SLICE)
    return sliced.withColumn("_copy", F.explode(F.sequence(F.lit(1), in_slice.cast("int")))).drop(
        "_times", "_slice", "_copy"
    )
