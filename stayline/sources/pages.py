"""Landed catalogue pages derived from the generic ``part`` table, to exercise the catalogue job on given data.

Some fields are left out and some are null: the two read differently. Pages hold at most twenty titles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.schemas import LIST_PAGE_SCHEMA, MOVIE_DETAIL_SCHEMA, SHOW_DETAIL_SCHEMA

TITLES_PER_PAGE = 20


def _nth(n: int, remainder: int = 0) -> Column:
    return F.col("p_partkey") % n == remainder


def _result(title: str, released: str) -> Column:
    genre_ids = (
        F.when(F.col("p_type") == "ECONOMY", F.array(F.lit(28), F.lit(18)))
        .when(F.col("p_type") == "MEDIUM", F.array(F.lit(35)))
        .when(F.col("p_type") == "PROMO", F.array(F.lit(80), F.lit(18), F.lit(99999)))
        .when(_nth(3), F.array().cast("array<int>"))
        .when(~_nth(3, 1), F.array(F.lit(18)))
    )
    item = F.struct(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias(title),
        genre_ids.alias("genre_ids"),
        F.when(~_nth(17), F.expr("date '2010-01-01' + cast(p_partkey * 29 % 5200 as int)")).alias(released),
        F.when(~_nth(7), F.expr("(p_partkey * 7 % 101) / 10.0D")).alias("vote_average"),
        F.when(~_nth(8), F.expr("p_partkey * 13 % 9000")).alias("vote_count"),
        F.when(~_nth(7), F.col("p_retailprice")).alias("popularity"),
        F.when(_nth(9), "fr").when(~_nth(9, 1), "en").alias("original_language"),
        F.when(_nth(4), F.expr("repeat(p_name, 40)")).when(~_nth(5), F.col("p_name")).alias("overview"),
    )
    spelled_out = F.to_json(item, {"ignoreNullFields": "false"})
    return F.when(_nth(11), spelled_out).otherwise(F.to_json(item))


def _pages(parts: DataFrame, title: str, released: str) -> DataFrame:
    page = F.expr(f"p_partkey div {TITLES_PER_PAGE}")
    text = F.concat(F.lit('{"page":'), F.col("page").cast("string"), F.lit(',"results":['), F.col("items"), F.lit("]}"))
    return (
        parts.groupBy(page.alias("page"))
        .agg(F.array_join(F.collect_list(_result(title, released)), ",").alias("items"))
        .select(F.from_json(text, LIST_PAGE_SCHEMA).alias("doc"))
        .select("doc.*")
    )


def landed_pages(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """movie_pages, movie_details, show_pages, show_details."""
    parts = spark.read.parquet(f"{sf_dir}/part.parquet")
    movies, shows = parts.where("p_size % 4 <> 0"), parts.where("p_size % 4 = 0")
    with_detail = ~_nth(10)
    movie_runtime = F.when(_nth(6), 0).otherwise(F.col("p_size") + 60).cast("string")
    episodes = F.when(~_nth(6), F.array((F.col("p_size") + 20).cast("string"), F.lit("5"))).otherwise(
        F.array().cast("array<string>")
    )
    names = {"movie": MOVIE_DETAIL_SCHEMA.names, "show": SHOW_DETAIL_SCHEMA.names}
    return {
        "movie_pages": _pages(movies, "title", "release_date"),
        "movie_details": movies.where(with_detail).select("p_partkey", movie_runtime).toDF(*names["movie"]),
        "show_pages": _pages(shows, "name", "first_air_date"),
        "show_details": shows.where(with_detail).select("p_partkey", episodes).toDF(*names["show"]),
    }
