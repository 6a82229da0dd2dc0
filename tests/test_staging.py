from datetime import datetime

import pytest
from helpers import d, dec, tuples

from stayline.operators import staging
from stayline.schemas import RAW_SCHEMAS

CATALOG = (
    "content_id string, tmdb_id string, title string, content_type string, genres string, primary_genre string, "
    "release_date string, vote_average decimal(10,2), vote_count string, popularity double, original_language string, "
    "overview string, runtime_minutes string, _loaded_at timestamp"
)


def title(content_id="TMDB_M_1", **over):
    row = {
        "content_id": content_id,
        "tmdb_id": "1",
        "title": "One",
        "content_type": "movie",
        "genres": "Drama",
        "primary_genre": "Drama",
        "release_date": "2020-02-29",
        "vote_average": dec("7.50"),
        "vote_count": "10",
        "popularity": 12.345,
        "original_language": "en",
        "overview": "",
        "runtime_minutes": "90",
        "_loaded_at": datetime(2024, 6, 1),
    }
    return tuple({**row, **over}.values())


def test_strict_cast_rejects_a_bad_value(spark):
    raw = spark.createDataFrame([("r", "c", "t", "five", "2024-01-01")], "rating_id string, customer_id string, content_id string, rating string, rated_at string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        staging.stg_user_ratings(raw).collect()


def test_text_input_is_typed(spark):
    raw = spark.createDataFrame(
        [("r", "c", "t", "5", "2024-01-01")],
        "rating_id string, customer_id string, content_id string, rating string, rated_at string",
    )
    assert tuples(staging.stg_user_ratings(raw), "rating", "rated_at") == [(5, d("2024-01-01"))]


def test_every_staging_model_keeps_its_rows_and_leads_with_its_key(spark):
    models = {
        "raw_users": (staging.stg_customers, "customer_key", 14),
        "raw_subscription_events": (staging.stg_subscription_events, "subscription_event_key", 7),
        "raw_watch_events": (staging.stg_watch_events, "watch_event_key", 11),
        "raw_user_ratings": (staging.stg_user_ratings, "rating_key", 6),
        "raw_user_watchlist": (staging.stg_user_watchlist, "watchlist_key", 6),
        "raw_support_tickets": (staging.stg_support_tickets, "interaction_key", 9),
    }
    for name, (model, key, width) in models.items():
        out = model(spark.createDataFrame([], RAW_SCHEMAS[name]))
        assert out.columns[0] == key
        assert len(out.columns) == width
        assert out.count() == 0


def test_safe_casts_turn_unfit_values_into_null(spark):
    raw = spark.createDataFrame(
        [title(release_date="", vote_average=dec("123.40"), vote_count="abc", runtime_minutes="n/a", tmdb_id="x1")], CATALOG
    )
    row = staging.stg_content_catalog(raw).first()
    assert (row.release_date, row.vote_average, row.vote_count, row.runtime_minutes, row.tmdb_id) == (None,) * 5
    assert row.popularity == dec("12.35")
    assert row.genre_list == "Drama"


def test_dedup_keeps_the_latest_load_then_settles_ties(spark):
    raw = spark.createDataFrame(
        [
            title(title="old", _loaded_at=datetime(2024, 6, 1)),
            title(title="new", _loaded_at=datetime(2024, 6, 2)),
            title(title="unstamped", _loaded_at=None),
            title("TMDB_M_2", title="b"),
            title("TMDB_M_2", title="a"),
            title("TMDB_M_3"),
            title("TMDB_M_3"),
        ],
        CATALOG,
    ).repartition(4)
    got = tuples(staging.stg_content_catalog(raw), "content_id", "title")
    assert got == [("TMDB_M_1", "new"), ("TMDB_M_2", "a"), ("TMDB_M_3", "One")]


def test_dedup_without_a_load_stamp(spark):
    raw = spark.createDataFrame([title(title="b"), title(title="a")], CATALOG).drop("_loaded_at")
    assert tuples(staging.stg_content_catalog(raw), "title") == [("a",)]
