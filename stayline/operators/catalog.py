"""Landed catalogue pages to the raw catalogue table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.functions import vocab
from stayline.functions.columns import instant
from stayline.schemas import CATALOG_SCHEMA


def _field(item: Column, name: str, kind: str, default=None) -> Column:
    """A field of a result object. The default stands in for a missing key only; an explicit null stays NULL."""
    value = F.try_variant_get(item, f"$.{name}", kind)
    if default is None:
        return value
    missing = F.try_variant_get(item, f"$.{name}", "variant").isNull()
    return F.when(missing, F.lit(default)).otherwise(value)


def genre_names(genre_ids: Column) -> Column:
    """Names of an id array; an id nobody knows is ``Unknown``, no array is an empty one."""
    names = F.create_map(*[F.lit(part) for pair in vocab.GENRES.items() for part in pair])
    named = F.transform(genre_ids, lambda g: F.coalesce(F.try_element_at(names, g), F.lit(vocab.UNKNOWN_GENRE)))
    return F.coalesce(named, F.array().cast("array<string>"))


def _titles(pages: DataFrame, kind: str, prefix: str, title: str, released: str) -> DataFrame:
    item = F.col("item")
    item_id = F.col("id")
    return (
        pages.select(F.explode("results").alias("item"))
        .select(
            "item",
            _field(item, "id", "bigint").alias("id"),
            genre_names(_field(item, "genre_ids", "array<int>")).alias("names"),
        )
        .select(
            item_id,
            F.concat(F.lit(prefix), item_id.cast("string")).alias("content_id"),
            item_id.alias("tmdb_id"),
            _field(item, title, "string").alias("title"),
            F.lit(kind).alias("content_type"),
            F.array_join("names", vocab.LIST_SEPARATOR).alias("genres"),
            F.coalesce(F.try_element_at("names", F.lit(1)), F.lit(vocab.UNKNOWN_GENRE)).alias("primary_genre"),
            _field(item, released, "string").alias("release_date"),
            _field(item, "vote_average", "double", 0.0).alias("vote_average"),
            _field(item, "vote_count", "bigint", 0).alias("vote_count"),
            _field(item, "popularity", "double", 0.0).alias("popularity"),
            _field(item, "original_language", "string", vocab.DEFAULT_LANGUAGE).alias("original_language"),
            F.substring(F.coalesce(_field(item, "overview", "string"), F.lit("")), 1, vocab.OVERVIEW_CHARS).alias(
                "overview"
            ),
        )
    )


def _with_runtime(titles: DataFrame, runtimes: DataFrame) -> DataFrame:
    """Attach the runtime by id. A title's detail may have been landed once per page it appeared on, or not at all."""
    one_each = runtimes.groupBy("id").agg(F.max("runtime_minutes").alias("runtime_minutes"))
    return titles.join(one_each, "id", "left").drop("id")


def movie_runtimes(details: DataFrame) -> DataFrame:
    return details.select("id", F.nullif(F.col("runtime").try_cast("bigint"), F.lit(0)).alias("runtime_minutes"))


def show_runtimes(details: DataFrame) -> DataFrame:
    first = F.try_element_at("episode_run_time", F.lit(1))
    return details.select("id", first.try_cast("bigint").alias("runtime_minutes"))


def flatten_catalog(
    movie_pages: DataFrame, movie_details: DataFrame, show_pages: DataFrame, show_details: DataFrame
) -> DataFrame:
    """One row per listed result of both kinds, in one schema. A title listed on two pages stays twice."""
    movies = _with_runtime(
        _titles(movie_pages, "movie", vocab.MOVIE_ID_PREFIX, "title", "release_date"), movie_runtimes(movie_details)
    )
    shows = _with_runtime(
        _titles(show_pages, "tv_show", vocab.SHOW_ID_PREFIX, "name", "first_air_date"), show_runtimes(show_details)
    )
    return movies.unionByName(shows)


def stamped(catalog: DataFrame, loaded_at: datetime) -> DataFrame:
    """Load stamp and the stored column types, ready for a full refresh; NaN and unfit values become NULL."""
    with_stamp = catalog.withColumn("_loaded_at", instant(loaded_at))

    def stored(field) -> Column:
        value = F.col(field.name)
        if field.dataType.typeName() == "double":
            value = value.try_cast("double")
            value = F.when(~F.isnan(value), value)
        elif field.dataType.typeName() == "long":
            value = value.try_cast("bigint")
        return value.alias(field.name)

    return with_stamp.select(*[stored(field) for field in CATALOG_SCHEMA])
