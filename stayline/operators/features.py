"""The customer feature table: seven per-domain aggregates, left-joined to the customers on one key.

Every aggregate is combined map-side, so a customer with an extreme number of rows sends one partial row per task. The
exact distinct counts go through Spark's two-step plan, which spreads a customer's distinct values over all tasks first.
"""

from __future__ import annotations

from datetime import date
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.functions import vocab
from stayline.functions.columns import at_least, count_where, day, lookup, mean2, share_of_rows
from stayline.functions.keys import packed, surrogate_key, unpacked
from stayline.operators.ordered import LONG_HISTORY, numbered

# Feature names by group, in output order.
FEATURE_GROUPS: dict[str, tuple[str, ...]] = {
    "demographic": (
        "tenure_days",
        "age",
        "age_band_encoded",
        "plan_type_encoded",
        "monthly_revenue",
        "acquisition_channel_encoded",
        "device_type_encoded",
    ),
    "watch_behavior": (
        "total_watch_events",
        "total_active_days",
        "unique_titles_watched",
        "unique_sessions",
        "total_watch_minutes",
        "avg_watch_duration_min",
        "max_watch_duration_min",
        "avg_completion_pct",
        "completed_count",
        "abandoned_count",
        "completion_rate",
        "abandonment_rate",
        "resumed_count",
        "resume_rate",
        "binge_session_count",
        "device_count",
        "days_since_last_watch",
    ),
    "recent_activity": (
        "watch_events_last_7d",
        "watch_minutes_last_7d",
        "watch_events_last_30d",
        "watch_minutes_last_30d",
        "watch_trend_7d_vs_30d",
    ),
    "subscription": (
        "total_subscription_events",
        "upgrade_count",
        "downgrade_count",
        "net_plan_changes",
        "has_downgraded",
        "activity_level_encoded",
    ),
    "support": (
        "total_support_tickets",
        "avg_resolution_hours",
        "avg_sentiment_score",
        "min_sentiment_score",
        "negative_ticket_count",
        "negative_ticket_rate",
        "unresolved_ticket_count",
        "billing_tickets",
        "technical_tickets",
        "critical_tickets",
    ),
    "ratings": ("total_ratings", "avg_rating_given", "low_ratings_count", "high_ratings_count"),
    "watchlist": ("total_watchlist_items", "watchlist_watched_count", "watchlist_conversion_rate"),
    "composite_risk": ("recency_risk_score", "support_frustration_score", "heuristic_churn_risk_score"),
}
FEATURES: tuple[str, ...] = tuple(name for group in FEATURE_GROUPS.values() for name in group)
KEY_AND_TARGET = ("customer_key", "customer_id", "target_is_churned", "target_churn_date")

# Averages, extremes and rates stay NULL for a customer without rows in that domain; every other aggregate is zero.
_UNDEFINED_WITHOUT_ROWS = frozenset(
    (
        "avg_watch_duration_min",
        "max_watch_duration_min",
        "avg_completion_pct",
        "completion_rate",
        "abandonment_rate",
        "resume_rate",
        "watch_trend_7d_vs_30d",
        "avg_resolution_hours",
        "avg_sentiment_score",
        "min_sentiment_score",
        "negative_ticket_rate",
        "avg_rating_given",
        "watchlist_conversion_rate",
    )
)


def customer_features(customers: DataFrame, as_of: date) -> DataFrame:
    return customers.select(
        "customer_key",
        "customer_id",
        "is_churned",
        "churn_date",
        F.datediff(day(as_of), "signup_date").alias("tenure_days"),
        "age",
        lookup(F.col("age_band"), vocab.AGE_BAND_CODES).alias("age_band_encoded"),
        lookup(F.col("plan_type"), vocab.PLAN_CODES).alias("plan_type_encoded"),
        "monthly_revenue",
        lookup(F.col("acquisition_channel"), vocab.CHANNEL_CODES).alias("acquisition_channel_encoded"),
        lookup(F.col("device_type"), vocab.DEVICE_CODES).alias("device_type_encoded"),
        lookup(F.col("activity_level"), vocab.ACTIVITY_CODES).alias("activity_level_encoded"),
    )


def _recent(as_of: date, days: int) -> Column:
    return F.col("date_day") >= F.date_sub(day(as_of), days)


def _recent_watch_aggregates(as_of: date) -> list[Column]:
    last_7, last_30 = _recent(as_of, 7), _recent(as_of, 30)
    minutes = F.col("watch_duration_minutes")
    n_7, n_30 = count_where(last_7), count_where(last_30)
    weekly_pace = n_30 / F.lit(Decimal(vocab.WEEKS_IN_30_DAYS))
    return [
        n_7.alias("watch_events_last_7d"),
        F.sum(F.when(last_7, minutes).otherwise(0)).alias("watch_minutes_last_7d"),
        n_30.alias("watch_events_last_30d"),
        F.sum(F.when(last_30, minutes).otherwise(0)).alias("watch_minutes_last_30d"),
        F.round(F.when(n_30 > 0, n_7 * F.lit(Decimal("1.0")) / weekly_pace), 2).alias("watch_trend_7d_vs_30d"),
    ]


# What the viewing features read of the fact.
WATCH_COLUMNS = (
    "customer_key",
    "content_key",
    "date_day",
    "session_id",
    "device_type",
    "watch_duration_minutes",
    "completion_percentage",
    "is_resumed",
    "engagement_level",
    "session_duration_bucket",
)


def _watch_aggregates(as_of: date) -> list[Column]:
    completed = F.col("engagement_level") == "completed"
    abandoned = F.col("engagement_level") == "abandoned"
    bucket = F.col("session_duration_bucket")
    return [
        F.count("*").alias("total_watch_events"),
        F.sum("watch_duration_minutes").alias("total_watch_minutes"),
        mean2("watch_duration_minutes").alias("avg_watch_duration_min"),
        F.max("watch_duration_minutes").alias("max_watch_duration_min"),
        mean2("completion_percentage").alias("avg_completion_pct"),
        count_where(completed).alias("completed_count"),
        count_where(abandoned).alias("abandoned_count"),
        share_of_rows(completed).alias("completion_rate"),
        share_of_rows(abandoned).alias("abandonment_rate"),
        count_where(F.col("is_resumed")).alias("resumed_count"),
        share_of_rows(F.col("is_resumed")).alias("resume_rate"),
        count_where(bucket == "binge").alias("binge_session_count"),
        count_where(bucket == "short").alias("short_session_count"),
        F.datediff(day(as_of), F.max("date_day")).alias("days_since_last_watch"),
        F.datediff(F.max("date_day"), F.min("date_day")).alias("watch_span_days"),
        *_recent_watch_aggregates(as_of),
    ]


def watch_measures(fct_watch_event: DataFrame, as_of: date) -> DataFrame:
    """Lifetime and recent viewing that map tasks can pre-combine: one partial row per customer leaves each task."""
    return fct_watch_event.groupBy("customer_key").agg(*_watch_aggregates(as_of))


# Numbers of one word of bits: a long, without its sign. Division by it is exact for any number of days or titles below 2**53.
WORD_BITS = 62


def dense_numbers(values: DataFrame, column: str, number: str) -> DataFrame:
    """A dictionary of a table's distinct values of a column: each with a number from 1 on without gaps, given by hash order. No
    task sees more than its share of the values."""
    distinct = values.where(F.col(column).isNotNull()).select(column).distinct()
    hashed = distinct.select(column, F.md5(F.col(column).cast("string")).alias("_hash"), F.lit(1).alias("_all"))
    return numbered(hashed, "_all", "_hash", number).select(column, number)


def _pairs_per_customer(fct_watch_event: DataFrame, column: str, name: str) -> DataFrame:
    pairs = fct_watch_event.groupBy("customer_key", column).agg(F.lit(1).alias("_one"))
    return pairs.groupBy("customer_key").agg(F.count(column).alias(name))


def watch_variety(fct_watch_event: DataFrame, dim_content: DataFrame | None = None) -> DataFrame:
    """Exact distinct counts per customer.

    Days and titles are bits of words, which merge: a word holds ``WORD_BITS`` neighbouring numbers, so a customer has a few rows
    for the days and at most one row for each title seen, however many titles there are. The number of a day is its date; that of a
    title comes from a dictionary of ``dim_content``, which has to hold all titles of the fact if it is given. The counts are exact for
    any number of titles. Sessions are hardly ever shared by two viewings, so a dictionary of them would be as long as the fact,
    and devices are few: both are counted as distinct pairs.
    """
    titles = dense_numbers(fct_watch_event if dim_content is None else dim_content, "content_key", "title_no")
    placed = fct_watch_event.join(titles, "content_key", "left").select(
        "customer_key",
        F.datediff("date_day", F.lit("1970-01-01").cast("date")).cast("long").alias("day"),
        F.col("title_no").cast("long").alias("title"),
    )
    kinds = {"day": "total_active_days", "title": "unique_titles_watched"}
    # A missing value has no bit; its customer still has a row.
    each = F.inline(F.array(*(F.struct(F.lit(k).alias("kind"), F.col(k).alias("number")) for k in kinds)))
    words = (
        placed.select("customer_key", each)
        .groupBy("customer_key", "kind", F.floor(F.col("number") / WORD_BITS).alias("word"))
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("number", F.lit(WORD_BITS)).cast("int"))).alias("bits"))
    )
    n_bits = F.coalesce(F.bit_count("bits"), F.lit(0))
    counted = words.groupBy("customer_key").agg(
        *(F.sum(F.when(F.col("kind") == k, n_bits).otherwise(0)).alias(name) for k, name in kinds.items())
    )
    return (
        counted.join(_pairs_per_customer(fct_watch_event, "session_id", "unique_sessions"), "customer_key")
        .join(_pairs_per_customer(fct_watch_event, "device_type", "device_count"), "customer_key")
        .select("customer_key", "total_active_days", "unique_titles_watched", "unique_sessions", "device_count")
    )


VARIETY = {
    "date_day": "total_active_days",
    "content_key": "unique_titles_watched",
    "session_id": "unique_sessions",
    "device_type": "device_count",
}


def _gathered(fct_watch_event: DataFrame, longest: int) -> tuple[DataFrame, DataFrame]:
    """The viewings in two parts, with packed customers: those of ordinary customers, each customer's in one task, and as they lie those
    of customers of more than ``longest``. There is at most one such customer for each ``longest`` rows, so their keys are broadcast."""
    rows = fct_watch_event.withColumn("customer_key", packed("customer_key"))
    per_customer = rows.groupBy("customer_key").agg(F.count("*").alias("_n"))
    many = F.broadcast(per_customer.where(F.col("_n") > longest).select("customer_key"))
    return rows.join(many, "customer_key", "left_anti").repartition("customer_key"), rows.join(many, "customer_key", "left_semi")


def _sets() -> list[Column]:
    """Distinct counts where the viewings of a customer meet; a missing value is in no list. Copies are dropped once, at the end:
    sets would be filled by the partial and by the final aggregate."""
    return [F.size(F.array_distinct(F.collect_list(c))).cast("bigint").alias(name) for c, name in VARIETY.items()]


def _spread_variety(viewings: DataFrame) -> DataFrame:
    """The same counts of customers of very many viewings, spread by value, copies dropped map-side."""
    values = {c: F.col(c).cast("string") for c in VARIETY}
    # A missing value is not counted; its customer still has a row.
    each = F.inline(F.array(*(F.struct(F.lit(c).alias("kind"), v.alias("value")) for c, v in values.items())))
    distinct = viewings.select("customer_key", each).groupBy("customer_key", "kind", "value").agg(F.lit(1).alias("_one"))
    return distinct.groupBy("customer_key").agg(
        *(F.count(F.when(F.col("kind") == c, F.col("value"))).alias(name) for c, name in VARIETY.items())
    )


def gathered_variety(fct_watch_event: DataFrame, longest: int = LONG_HISTORY) -> DataFrame:
    """The same counts from one shuffle of narrow rows, for a stored fact, which may be read more than once.

    The viewings of a customer meet in one task, so nothing is left to add up: distinct pairs that are spread by value come back as
    nearly one partial row each, more of them the more tasks there are. A customer of more than ``longest`` viewings is
    spread by value all the same.
    """
    meeting, spread = _gathered(fct_watch_event, longest)
    counted = meeting.groupBy("customer_key").agg(*_sets()).unionByName(_spread_variety(spread))
    return counted.select(unpacked("customer_key").alias("customer_key"), *VARIETY.values())


def watch_features(
    fct_watch_event: DataFrame,
    as_of: date,
    dim_content: DataFrame | None = None,
    stored: bool = False,
    longest: int = LONG_HISTORY,
) -> DataFrame:
    """Both kinds of viewing features, joined on the key they are grouped by.

    Apart they read nearly disjoint columns of the fact. Both sides have the same customers; as a left join the
    distinct counts are dropped from a plan that does not select them. ``stored`` says that the fact is a stored table: then both are
    taken in one pass where the viewings of a customer meet, and apart only for customers of more than ``longest`` viewings.
    """
    if not stored:
        return watch_measures(fct_watch_event, as_of).join(watch_variety(fct_watch_event, dim_content), "customer_key", "left")
    meeting, spread = _gathered(fct_watch_event, longest)
    apart = watch_measures(spread, as_of).join(_spread_variety(spread), "customer_key", "left")
    both = meeting.groupBy("customer_key").agg(*_watch_aggregates(as_of), *_sets()).unionByName(apart)
    return both.withColumn("customer_key", unpacked("customer_key"))


def watch_recent_features(fct_watch_event: DataFrame, as_of: date) -> DataFrame:
    """Only the 7 and 30 day windows, without the distinct counts."""
    return fct_watch_event.groupBy("customer_key").agg(*_recent_watch_aggregates(as_of))


def subscription_features(fct_subscription_event: DataFrame) -> DataFrame:
    upgrades = count_where(F.col("event_type") == "upgrade")
    downgrades = count_where(F.col("event_type") == "downgrade")
    return fct_subscription_event.groupBy("customer_key").agg(
        F.count("*").alias("total_subscription_events"),
        upgrades.alias("upgrade_count"),
        downgrades.alias("downgrade_count"),
        count_where(F.col("event_type") == "cancel").alias("cancel_count"),
        (upgrades - downgrades).alias("net_plan_changes"),
        F.max(F.when(F.col("event_type") == "downgrade", 1).otherwise(0)).alias("has_downgraded"),
    )


def support_features(fct_support_interaction: DataFrame, as_of: date) -> DataFrame:
    negative = F.col("sentiment_tier") == "negative"
    category = F.col("category")
    return fct_support_interaction.groupBy("customer_key").agg(
        F.count("*").alias("total_support_tickets"),
        mean2("resolution_time_hours").alias("avg_resolution_hours"),
        F.max("resolution_time_hours").alias("max_resolution_hours"),
        mean2("sentiment_score").alias("avg_sentiment_score"),
        F.min("sentiment_score").alias("min_sentiment_score"),
        count_where(negative).alias("negative_ticket_count"),
        share_of_rows(negative).alias("negative_ticket_rate"),
        count_where(~F.col("is_resolved")).alias("unresolved_ticket_count"),
        count_where(category == "billing").alias("billing_tickets"),
        count_where(category == "technical").alias("technical_tickets"),
        count_where(category == "content").alias("content_tickets"),
        count_where(F.col("resolution_tier") == "critical").alias("critical_tickets"),
        F.datediff(day(as_of), F.max("date_day")).alias("days_since_last_ticket"),
    )


def _by_key(events: DataFrame) -> DataFrame:
    """Events that carry the customer id, under the key it hashes to: no lookup is needed to group them.

    Without an id there is no customer: a NULL would hash to a key like any other.
    """
    return events.where(F.col("customer_id").isNotNull()).withColumn("customer_key", surrogate_key("customer_id"))


def _rating_aggregates(ratings: DataFrame) -> DataFrame:
    stars = F.col("rating")
    return _by_key(ratings).groupBy("customer_key").agg(
        F.count("*").alias("total_ratings"),
        mean2("rating").alias("avg_rating_given"),
        F.min("rating").alias("min_rating_given"),
        count_where(stars <= vocab.LOW_RATING_MAX).alias("low_ratings_count"),
        count_where(stars >= vocab.HIGH_RATING_MIN).alias("high_ratings_count"),
    )


def _watchlist_aggregates(watchlist: DataFrame) -> DataFrame:
    return _by_key(watchlist).groupBy("customer_key").agg(
        F.count("*").alias("total_watchlist_items"),
        count_where(F.col("is_watched")).alias("watchlist_watched_count"),
        share_of_rows(F.col("is_watched")).alias("watchlist_conversion_rate"),
    )


def _of_known_customers(aggregates: DataFrame, customers: DataFrame) -> DataFrame:
    return aggregates.join(customers.select("customer_key"), "customer_key", "left_semi")


def rating_features(ratings: DataFrame, customers: DataFrame) -> DataFrame:
    """Aggregated before unknown customers are dropped, so that join sees one row per customer."""
    return _of_known_customers(_rating_aggregates(ratings), customers)


def watchlist_features(watchlist: DataFrame, customers: DataFrame) -> DataFrame:
    return _of_known_customers(_watchlist_aggregates(watchlist), customers)


def feature_table(
    customers: DataFrame,
    fct_watch_event: DataFrame,
    fct_subscription_event: DataFrame,
    fct_support_interaction: DataFrame,
    ratings: DataFrame,
    watchlist: DataFrame,
    as_of: date,
    dim_content: DataFrame | None = None,
    stored: bool = False,
) -> DataFrame:
    """One row per customer: key, target and the 55 features at ``as_of``.

    The aggregates leave their shuffle partitioned by customer key, which is what the left joins need, so each input
    is shuffled once. Ratings and watchlist rows of unknown customers find no partner and drop out by themselves.
    ``stored`` says that the viewing fact is a stored table.
    """
    domains = [
        watch_features(fct_watch_event, as_of, dim_content, stored),
        subscription_features(fct_subscription_event),
        support_features(fct_support_interaction, as_of),
        _rating_aggregates(ratings),
        _watchlist_aggregates(watchlist),
    ]
    joined = reduce(
        lambda left, right: left.join(right, "customer_key", "left"), domains, customer_features(customers, as_of)
    )
    defaults = {name: F.lit(0) for name in FEATURES} | {"days_since_last_watch": F.lit(vocab.NEVER_WATCHED_DAYS)}
    pass_through = _UNDEFINED_WITHOUT_ROWS.union(FEATURE_GROUPS["demographic"], ["activity_level_encoded"])

    def filled(name: str) -> Column:
        return F.col(name) if name in pass_through else F.coalesce(F.col(name), defaults[name])

    measured = [name for name in FEATURES if name not in FEATURE_GROUPS["composite_risk"]]
    table = joined.select(
        "customer_key",
        "customer_id",
        F.col("is_churned").alias("target_is_churned"),
        F.col("churn_date").alias("target_churn_date"),
        *[filled(name).alias(name) for name in measured],
    )
    return table.select("*", *[score.alias(name) for name, score in risk_scores().items()])


def risk_scores() -> dict[str, Column]:
    """The three composite scores over the finished feature columns."""
    days_away = F.col("days_since_last_watch")
    weight = vocab.FRUSTRATION_WEIGHTS

    def points(condition: Column, value: int) -> Column:
        return F.when(condition, value).otherwise(0)

    return {
        "recency_risk_score": at_least(days_away, *vocab.RECENCY_LADDER),
        "support_frustration_score": (
            F.col("negative_ticket_count") * weight["negative"]
            + F.col("unresolved_ticket_count") * weight["unresolved"]
            + F.col("critical_tickets") * weight["critical"]
        ),
        # Points per sign, at most RISK_POINTS_MAX in sum.
        "heuristic_churn_risk_score": (
            points(days_away >= 7, 3)
            + F.col("has_downgraded") * 2
            + points(F.col("negative_ticket_count") >= 2, 2)
            + points(F.col("abandonment_rate") >= Decimal("0.5"), 2)
            + points(F.col("watch_events_last_7d") == 0, 3)
        ),
    }
