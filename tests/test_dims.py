from datetime import date, datetime

import pytest
from helpers import AS_OF, d, mapping

from stayline.operators import dims

TITLE = "content_id string, release_date date, vote_average decimal(3,1)"


@pytest.mark.parametrize(
    ("released", "bucket"),
    [
        ("2023-06-30", "new_release"),
        ("2023-06-29", "recent"),
        ("2021-06-30", "recent"),
        ("2021-06-29", "catalog"),
        ("2014-06-30", "catalog"),
        ("2014-06-29", "classic"),
        ("2025-01-01", "new_release"),
        (None, "classic"),
    ],
)
def test_content_age_at_its_bounds(spark, released, bucket):
    df = spark.createDataFrame([("t", d(released), None)], TITLE)
    assert dims.dim_content(df, AS_OF).first().content_age_bucket == bucket


def test_content_age_from_a_leap_day_and_a_moment_of_the_day(spark):
    df = spark.createDataFrame([("a", date(2023, 2, 28), None), ("b", date(2023, 2, 27), None)], TITLE)
    midnight = mapping(dims.dim_content(df, date(2024, 2, 29)), "content_id", "content_age_bucket")
    assert midnight == {"a": "new_release", "b": "recent"}
    noon = mapping(dims.dim_content(df, datetime(2024, 2, 29, 12)), "content_id", "content_age_bucket")
    assert noon == {"a": "recent", "b": "recent"}


def test_calendar_span_excludes_the_end(spark):
    days = dims.dim_date(spark)
    assert days.count() == 1825
    assert days.agg({"date_day": "max"}).first()[0] == date(2027, 12, 30)
    assert dims.calendar_bounds() == ("2023-01-01", "2027-12-30")


def test_calendar_attributes(spark):
    row = dims.dim_date(spark).where("date_day = '2024-12-01'").first()
    assert row.asDict() == {
        "date_day": date(2024, 12, 1),
        "year": 2024,
        "month": 12,
        "day_of_month": 1,
        "day_of_week_num": 7,
        "day_of_week_name": "Sunday",
        "is_weekend": True,
        "month_name": "December",
        "quarter": 4,
        "fiscal_year": 2024,
    }


def test_source_week_names_the_sunday_number_monday(spark):
    row = dims.dim_date(spark, week="source").where("date_day = '2024-12-01'").first()
    assert (row.day_of_week_num, row.day_of_week_name, row.is_weekend) == (1, "Monday", False)
    friday = dims.dim_date(spark, week="source").where("date_day = '2024-12-06'").first()
    assert (friday.day_of_week_num, friday.day_of_week_name, friday.is_weekend) == (6, "Saturday", True)


def test_unknown_week_is_refused(spark):
    with pytest.raises(ValueError, match="week"):
        dims.dim_date(spark, week="lunar")
