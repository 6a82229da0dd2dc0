import json
from datetime import datetime

import pytest
from helpers import tuples
from pyspark.sql import functions as F

from stayline.functions import vocab
from stayline.operators import catalog
from stayline.schemas import CATALOG_SCHEMA
from stayline.sources import tables


@pytest.fixture
def landed(spark, tmp_path):
    """Write JSON lines as an ingest would land them and return the flattened catalogue."""

    def flatten(movies=(), movie_details=(), shows=(), show_details=()):
        folder = tmp_path / "landed"
        for name, docs in {
            "movies": [{"page": 1, "results": list(movies)}],
            "movie_details": movie_details,
            "shows": [{"page": 1, "results": list(shows)}],
            "show_details": show_details,
        }.items():
            (folder / name).mkdir(parents=True, exist_ok=True)
            (folder / name / "part.json").write_text("\n".join(json.dumps(doc) for doc in docs))
        return catalog.flatten_catalog(
            tables.read_pages(spark, str(folder / "movies")),
            tables.read_movie_details(spark, str(folder / "movie_details")),
            tables.read_pages(spark, str(folder / "shows")),
            tables.read_show_details(spark, str(folder / "show_details")),
        )

    return flatten


def test_both_kinds_in_one_schema(landed):
    out = landed(
        [{"id": 1, "title": "M", "genre_ids": [28, 18], "release_date": "2020-01-01", "vote_average": 7.1, "vote_count": 3}],
        [{"id": 1, "runtime": 101}],
        [{"id": 1, "name": "S", "genre_ids": [10765], "first_air_date": "2021-01-01"}],
        [{"id": 1, "episode_run_time": [45, 50]}],
    )
    assert out.columns == [c for c in CATALOG_SCHEMA.names if c != "_loaded_at"]
    assert tuples(out, "content_id", "title", "content_type", "genres", "primary_genre", "release_date", "runtime_minutes") == [
        ("TMDB_M_1", "M", "movie", "Action|Drama", "Action", "2020-01-01", 101),
        ("TMDB_T_1", "S", "tv_show", "Sci-Fi & Fantasy", "Sci-Fi & Fantasy", "2021-01-01", 45),
    ]


def test_a_missing_key_gets_the_default_and_a_null_stays_null(landed):
    nulls = dict.fromkeys(["vote_average", "vote_count", "popularity", "original_language", "overview", "release_date"])
    out = landed([{"id": 1, "title": "missing"}, {"id": 2, "title": "null", **nulls}])
    names = ("title", "vote_average", "vote_count", "popularity", "original_language", "overview", "release_date")
    assert tuples(out, *names) == [
        ("missing", 0.0, 0, 0.0, "en", "", None),
        ("null", None, None, None, None, "", None),
    ]


def test_genres(landed):
    cases = [[], [35], [1, 35], [99999]]
    out = landed([{"id": i, "title": str(i), "genre_ids": ids} for i, ids in enumerate(cases)] + [{"id": 9, "title": "9"}])
    assert tuples(out, "title", "genres", "primary_genre") == [
        ("0", "", "Unknown"),
        ("1", "Comedy", "Comedy"),
        ("2", "Unknown|Comedy", "Unknown"),
        ("3", "Unknown", "Unknown"),
        ("9", "", "Unknown"),
    ]
    assert len(vocab.GENRES) == 27


def test_runtimes(landed):
    out = landed(
        [{"id": i, "title": str(i)} for i in range(4)],
        [{"id": 0, "runtime": 0}, {"id": 1, "runtime": None}, {"id": 2, "runtime": 90}, {"id": 2, "runtime": 90}],
        [{"id": i, "name": f"s{i}"} for i in range(3)],
        [{"id": 0, "episode_run_time": []}, {"id": 1, "episode_run_time": [30]}],
    )
    got = {row.title: row.runtime_minutes for row in out.collect()}
    assert got == {"0": None, "1": None, "2": 90, "3": None, "s0": None, "s1": 30, "s2": None}
    assert out.count() == 7


def test_overview_is_cut(landed):
    out = landed([{"id": 1, "title": "t", "overview": "x" * 500}])
    assert len(out.first().overview) == vocab.OVERVIEW_CHARS


def test_a_title_on_two_pages_stays_twice(landed):
    assert landed([{"id": 1, "title": "t"}] * 2, [{"id": 1, "runtime": 5}] * 2).count() == 2


def test_stamp_and_stored_types(spark, landed):
    out = catalog.stamped(landed([{"id": 1, "title": "t"}]), datetime(2024, 6, 29, 6))
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in CATALOG_SCHEMA]
    assert out.first()._loaded_at == datetime(2024, 6, 29, 6)
    odd = out.withColumns({"runtime_minutes": F.lit("n/a"), "vote_average": F.lit(float("nan"))})
    row = catalog.stamped(odd, datetime(2024, 6, 29)).first()
    assert (row.runtime_minutes, row.vote_average) == (None, None)
