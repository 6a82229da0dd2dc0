"""Title-level operators over viewing, watchlist, catalogue and customers.

Sets and pools are relations, one member per row, not arrays: a heavy customer or a large genre then spreads over tasks
like any other rows, and membership is a join.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.functions import vocab
from stayline.functions.columns import day, lookup
from stayline.functions.keys import surrogate_key
from stayline.operators.ordered import numbered


def user_title_summary(watches: DataFrame) -> DataFrame:
    """Best completion and last viewing day per customer and title."""
    return watches.groupBy("customer_id", "content_id").agg(
        F.max("completion_percentage").alias("max_completion"), F.max("watch_date").alias("last_watch_date")
    )


def watched_set(watches: DataFrame) -> DataFrame:
    """The titles each customer has watched, one pair per row."""
    return watches.select("customer_id", "content_id").distinct()


def watchlist_watched_flag(watchlist: DataFrame, watches: DataFrame) -> DataFrame:
    """Each listed title with whether the customer has watched it, whatever the list itself says."""
    watched = watched_set(watches).withColumn("has_watched", F.lit(True))
    return watchlist.join(watched, ["customer_id", "content_id"], "left").select(
        "watchlist_id",
        "customer_id",
        "content_id",
        "is_watched",
        F.coalesce("has_watched", F.lit(False)).alias("has_watched"),
    )


def distinct_genres(catalog: DataFrame) -> DataFrame:
    """Known primary genres, ``Unknown`` excluded."""
    return (
        catalog.select("primary_genre")
        .where(F.col("primary_genre").isNotNull() & (F.col("primary_genre") != vocab.UNKNOWN_GENRE))
        .distinct()
    )


def genre_pool(catalog: DataFrame) -> DataFrame:
    """The titles of each primary genre, numbered from 1 so that a draw by position is a join."""
    titles = catalog.where(F.col("primary_genre").isNotNull()).select(
        "primary_genre", "content_id", surrogate_key("content_id").alias("_order")
    )
    return numbered(titles, "primary_genre", "_order", "pool_position").drop("_order")


def preferred_genres(customers: DataFrame) -> DataFrame:
    """One row per customer and preferred genre, from the delimited list."""
    return customers.select("customer_id", F.explode(F.split("preferred_genres", r"\|")).alias("genre"))


def popularity_share(catalog: DataFrame) -> DataFrame:
    """Each title's share of the total popularity. The total is one value, computed once as a scalar subquery."""
    total = catalog.agg(F.sum("popularity").cast("double")).scalar()
    return catalog.select(
        "content_id", "popularity", (F.col("popularity").cast("double") / total).alias("popularity_share")
    )


def runtime_or_default() -> Column:
    """Known positive runtime, else the usual length of the content type."""
    runtime = F.col("runtime_minutes")
    fallback = lookup(
        F.col("content_type"), {"tv_show": vocab.DEFAULT_RUNTIME["tv_show"]}, vocab.DEFAULT_RUNTIME["movie"]
    )
    return F.when(runtime > 0, runtime).otherwise(fallback)


def effective_runtime(catalog: DataFrame) -> DataFrame:
    return catalog.select(
        "content_id", "content_type", "runtime_minutes", runtime_or_default().alias("effective_runtime")
    )


def active_span(customers: DataFrame, as_of: date) -> DataFrame:
    """Days from signup to churn, or to ``as_of`` for a customer who stays."""
    end = F.when(F.col("is_churned"), F.col("churn_date")).otherwise(day(as_of))
    return customers.select("customer_id", "signup_date", F.datediff(end, "signup_date").alias("active_days"))


def plan_change_type(changes: DataFrame, new_price: str, old_price: str) -> DataFrame:
    """A change to a higher price is an upgrade; anything else, an equal price included, a downgrade."""
    return changes.withColumn(
        "plan_change_type", F.when(F.col(new_price) > F.col(old_price), "upgrade").otherwise("downgrade")
    )
