"""Declared schemas of the raw tables and of the landed catalogue pages."""

from __future__ import annotations

from pyspark.sql import types as T

STRING, INT, LONG, DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
BOOLEAN, DATE, TIMESTAMP, MONEY = T.BooleanType(), T.DateType(), T.TimestampType(), T.DecimalType(10, 2)


def table_schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


RAW_SCHEMAS = {
    "raw_users": table_schema(
        customer_id=STRING,
        email=STRING,
        country=STRING,
        age=INT,
        signup_date=DATE,
        plan_type=STRING,
        monthly_revenue=MONEY,
        is_churned=BOOLEAN,
        churn_date=DATE,
        acquisition_channel=STRING,
        device_type=STRING,
        preferred_genres=STRING,
        activity_level=STRING,
    ),
    "raw_subscription_events": table_schema(
        customer_id=STRING,
        event_type=STRING,
        event_date=DATE,
        plan_type=STRING,
        monthly_revenue=MONEY,
        cancellation_reason=STRING,
    ),
    "raw_watch_events": table_schema(
        watch_event_id=STRING,
        customer_id=STRING,
        content_id=STRING,
        watch_date=DATE,
        watch_start_time=STRING,
        watch_duration_minutes=INT,
        completion_percentage=T.DecimalType(5, 2),
        device_type=STRING,
        session_id=STRING,
        is_resumed=BOOLEAN,
    ),
    "raw_user_ratings": table_schema(
        rating_id=STRING,
        customer_id=STRING,
        content_id=STRING,
        rating=INT,
        rated_at=DATE,
    ),
    "raw_user_watchlist": table_schema(
        watchlist_id=STRING,
        customer_id=STRING,
        content_id=STRING,
        added_at=DATE,
        is_watched=BOOLEAN,
    ),
    "raw_support_tickets": table_schema(
        ticket_id=STRING,
        customer_id=STRING,
        category=STRING,
        channel=STRING,
        created_at=TIMESTAMP,
        resolution_time_hours=T.DecimalType(10, 1),
        is_resolved=BOOLEAN,
        sentiment_score=T.DecimalType(5, 2),
    ),
}

# The catalogue table as the ingest step writes it.
CATALOG_SCHEMA = table_schema(
    content_id=STRING,
    tmdb_id=LONG,
    title=STRING,
    content_type=STRING,
    genres=STRING,
    primary_genre=STRING,
    release_date=STRING,
    vote_average=DOUBLE,
    vote_count=LONG,
    popularity=DOUBLE,
    original_language=STRING,
    overview=STRING,
    runtime_minutes=LONG,
    _loaded_at=TIMESTAMP,
)

# Landed list pages keep each result as a variant: a key that is missing and a key that is null mean different things.
LIST_PAGE_SCHEMA = table_schema(page=LONG, results=T.ArrayType(T.VariantType()))
MOVIE_DETAIL_SCHEMA = table_schema(id=LONG, runtime=STRING)
SHOW_DETAIL_SCHEMA = table_schema(id=LONG, episode_run_time=T.ArrayType(STRING))
