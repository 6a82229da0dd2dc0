"""Typed staging: one narrow projection per raw table. Only the catalogue needs a shuffle, to drop repeated titles."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayline.functions.keys import surrogate_key


def _typed(raw: DataFrame, key: str, key_parts: tuple[str, ...], columns: dict[str, str | None]) -> DataFrame:
    """Surrogate key over the uncast parts, then the columns in order, cast where a type is given."""
    picked = [F.col(name) if kind is None else F.col(name).cast(kind).alias(name) for name, kind in columns.items()]
    return raw.select(surrogate_key(*key_parts).alias(key), *picked)


def stg_customers(raw_users: DataFrame) -> DataFrame:
    return _typed(
        raw_users,
        "customer_key",
        ("customer_id",),
        {
            "customer_id": None,
            "email": None,
            "country": None,
            "age": "int",
            "signup_date": "date",
            "plan_type": None,
            "monthly_revenue": "decimal(10,2)",
            "is_churned": "boolean",
            "churn_date": "date",
            "acquisition_channel": None,
            "device_type": None,
            "preferred_genres": None,
            "activity_level": None,
        },
    )


def stg_subscription_events(raw_events: DataFrame) -> DataFrame:
    return _typed(
        raw_events,
        "subscription_event_key",
        ("customer_id", "event_type", "event_date"),
        {
            "customer_id": None,
            "event_type": None,
            "event_date": "date",
            "plan_type": None,
            "monthly_revenue": "decimal(10,2)",
            "cancellation_reason": None,
        },
    )


def stg_support_tickets(raw_tickets: DataFrame) -> DataFrame:
    return _typed(
        raw_tickets,
        "interaction_key",
        ("ticket_id",),
        {
            "ticket_id": None,
            "customer_id": None,
            "category": None,
            "channel": None,
            "created_at": "timestamp",
            "resolution_time_hours": "decimal(10,1)",
            "is_resolved": "boolean",
            "sentiment_score": "decimal(5,2)",
        },
    )


def stg_watch_events(raw_watches: DataFrame) -> DataFrame:
    return _typed(
        raw_watches,
        "watch_event_key",
        ("watch_event_id",),
        {
            "watch_event_id": None,
            "customer_id": None,
            "content_id": None,
            "watch_date": "date",
            "watch_start_time": "string",
            "watch_duration_minutes": "int",
            "completion_percentage": "decimal(5,2)",
            "device_type": None,
            "session_id": None,
            "is_resumed": "boolean",
        },
    )


def stg_user_ratings(raw_ratings: DataFrame) -> DataFrame:
    return _typed(
        raw_ratings,
        "rating_key",
        ("rating_id",),
        {"rating_id": None, "customer_id": None, "content_id": None, "rating": "int", "rated_at": "date"},
    )


def stg_user_watchlist(raw_watchlist: DataFrame) -> DataFrame:
    return _typed(
        raw_watchlist,
        "watchlist_key",
        ("watchlist_id",),
        {"watchlist_id": None, "customer_id": None, "content_id": None, "added_at": "date", "is_watched": "boolean"},
    )


def latest_load(catalog: DataFrame) -> DataFrame:
    """One row per title: the most recently loaded, remaining ties settled by the other columns in order.

    Spark keeps one candidate per title in every map task before the shuffle, so even a title with an extreme number
    of copies sends at most one row per task to its reducer.
    """
    order = [F.col("_loaded_at").desc_nulls_last()] if "_loaded_at" in catalog.columns else []
    order += [F.col(c).asc_nulls_last() for c in catalog.columns if c not in ("content_id", "_loaded_at")]
    newest_first = Window.partitionBy("content_id").orderBy(*order)
    return catalog.withColumn("_copy", F.row_number().over(newest_first)).where("_copy = 1").drop("_copy")


def stg_content_catalog(raw_catalog: DataFrame) -> DataFrame:
    """Deduplicated catalogue; a value that does not fit its type becomes NULL instead of failing the load."""

    def fitted(name: str, kind: str):
        return F.col(name).try_cast(kind).alias(name)

    return latest_load(raw_catalog).select(
        surrogate_key("content_id").alias("content_key"),
        "content_id",
        fitted("tmdb_id", "int"),
        "title",
        "content_type",
        F.col("genres").alias("genre_list"),
        "primary_genre",
        fitted("release_date", "date"),
        fitted("vote_average", "decimal(3,1)"),
        fitted("vote_count", "int"),
        fitted("popularity", "decimal(10,2)"),
        "original_language",
        "overview",
        fitted("runtime_minutes", "int"),
    )
