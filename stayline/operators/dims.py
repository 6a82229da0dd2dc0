"""Dimensions."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.functions import vocab
from stayline.functions.columns import at_least, below, instant, ladder, years_before


def _insert_after(df: DataFrame, additions: dict) -> DataFrame:
    """Add each column right behind the named one, keeping the others in place."""
    picked = []
    for name in df.columns:
        picked.append(F.col(name))
        if name in additions:
            alias, value = additions[name]
            picked.append(value.alias(alias))
    return df.select(*picked)


def dim_customer(customers: DataFrame) -> DataFrame:
    return _insert_after(customers, {"age": ("age_band", below(F.col("age"), *vocab.AGE_BANDS))})


def dim_content(catalog: DataFrame, as_of: date | datetime) -> DataFrame:
    """Titles with their age at the moment ``as_of`` (midnight for a plain date) and a rating tier."""
    now = instant(as_of)
    age_bucket = ladder(
        F.col("release_date"), *vocab.CONTENT_AGES, lambda released, years: released >= years_before(now, years)
    )
    return _insert_after(
        catalog,
        {
            "release_date": ("content_age_bucket", age_bucket),
            "vote_average": ("rating_tier", at_least(F.col("vote_average"), *vocab.RATING_LADDER)),
        },
    )


def dim_date(
    spark: SparkSession,
    start: str = vocab.CALENDAR_START,
    end: str = vocab.CALENDAR_END,
    week: str = "iso",
) -> DataFrame:
    """Calendar days from ``start`` up to but not including ``end``.

    ``week='iso'`` numbers Monday 1 to Sunday 7. ``week='source'`` puts the same names on Sunday-based numbers, so a
    name is one day off and the weekend falls on Friday and Saturday: the calendar existing reports were built on.
    """
    first = date.fromisoformat(start)
    n_days = (date.fromisoformat(end) - first).days
    the_day = F.col("date_day")
    if week == "iso":
        number, named_day = F.weekday(the_day) + 1, the_day
    elif week == "source":
        number, named_day = F.dayofweek(the_day), F.date_add(the_day, 1)
    else:
        raise ValueError(f"week must be 'iso' or 'source', not {week!r}")
    days = spark.range(0, n_days, 1, 1).select(
        F.date_add(F.lit(first.isoformat()).cast("date"), F.col("id").cast("int")).alias("date_day")
    )
    return days.select(
        "date_day",
        F.year(the_day).alias("year"),
        F.month(the_day).alias("month"),
        F.dayofmonth(the_day).alias("day_of_month"),
        number.alias("day_of_week_num"),
        F.date_format(named_day, "EEEE").alias("day_of_week_name"),
        number.isin(6, 7).alias("is_weekend"),
        F.date_format(the_day, "MMMM").alias("month_name"),
        F.quarter(the_day).alias("quarter"),
        F.year(the_day).alias("fiscal_year"),
    )


def calendar_bounds(start: str = vocab.CALENDAR_START, end: str = vocab.CALENDAR_END) -> tuple[str, str]:
    """First and last day of the calendar, both included."""
    return start, (date.fromisoformat(end) - timedelta(days=1)).isoformat()
