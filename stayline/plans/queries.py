"""The registered queries: each takes (spark, sf_dir) and returns a DataFrame over the whole tables."""

from __future__ import annotations

import uuid
from collections import ChainMap
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from stayline.operators import boosting, catalog, evaluate, features, matrix, model, ordered, quality, staging, titles
from stayline.plans.checks import CHECKS, KINDS
from stayline.plans.warehouse import MARTS, STAGING, Warehouse
from stayline.schemas import CATALOG_SCHEMA, RAW_SCHEMAS
from stayline.session import cut_lineage, prepare, run_key, scratch_path
from stayline.sources import pages, rejects, samples, tables

Query = Callable[[SparkSession, str], DataFrame]
LOADED_AT = datetime(2024, 6, 29, 6)


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so that two engines print the same value."""
    decimals = {f.name: F.col(f.name).cast("double") for f in df.schema if isinstance(f.dataType, DecimalType)}
    return df.withColumns(decimals) if decimals else df


def warehouse(spark: SparkSession, sf_dir: str, **options) -> Warehouse:
    return Warehouse(samples.raw_tables(prepare(spark), sf_dir), samples.AS_OF, **options)


def _table(name: str, **options) -> Query:
    return lambda spark, sf_dir: comparable(warehouse(spark, sf_dir, **options)[name])


def feature_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """For queries over all features: the measures and each kind of distinct count read the fact, which is joined once."""
    return warehouse(spark, sf_dir, cut={"fct_watch_event": features.WATCH_COLUMNS})


def _on_features(compute: Callable[[Warehouse], DataFrame]) -> Query:
    return lambda spark, sf_dir: comparable(compute(feature_warehouse(spark, sf_dir)))


def _on(compute: Callable[[Warehouse], DataFrame]) -> Query:
    return lambda spark, sf_dir: comparable(compute(warehouse(spark, sf_dir)))


def _fraction_input(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    raw = samples.raw_tables(prepare(spark), sf_dir)
    fraction = (F.col("completion_percentage") / 100).cast("decimal(5,2)")
    watches = {"raw_watch_events": raw["raw_watch_events"].withColumn("completion_percentage", fraction)}
    return comparable(Warehouse(ChainMap(watches, raw), samples.AS_OF, **options)["fct_watch_event"])


def _columns(compute: Callable[[Warehouse], DataFrame], *names: str) -> Query:
    return _on_features(lambda w: compute(w).select(*names))


_STORED: dict[tuple, Warehouse] = {}


def stored_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Each table a query touches is written once under the shared folder and read back, by all queries of the session."""
    key = run_key(spark, sf_dir)
    if key not in _STORED:
        folder = scratch_path(prepare(spark), "run")
        _STORED[key] = warehouse(spark, sf_dir, store=tables.parquet_store(folder))
    return _STORED[key]


def _stored_checks(*kinds: str) -> Query:
    """Checks run over stored tables, as in a daily rebuild: each is scanned once for its columns and once for its keys."""
    return lambda spark, sf_dir: quality.run_checks(stored_warehouse(spark, sf_dir), CHECKS, kinds)


def _stored_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(stored_warehouse(spark, sf_dir)["ml_churn_feature_store"])


def _csv_round_trip(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw = samples.raw_tables(prepare(spark), sf_dir)
        folder = scratch_path(spark, "csv")
        tables.write_seeds(raw, folder)
        return comparable(tables.read_seeds(spark, folder)[name])

    return query


def _faulty_ratings(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The ratings as CSV lines, faults planted by the hash of the id, read by the reader that sets bad records aside."""
    raw = samples.raw_tables(prepare(spark), sf_dir)["raw_user_ratings"]
    kind = F.substring(F.md5("rating_id"), 1, 1)
    fields = F.concat_ws(
        ",",
        "rating_id",
        "customer_id",
        "content_id",
        F.when(kind == "0", "five").when(kind == "4", "n/a").otherwise(F.coalesce(F.col("rating").cast("string"), F.lit(""))),
    )
    day = F.when(kind == "1", "2024-13-45").when(kind == "4", "soon").otherwise(F.coalesce(F.col("rated_at").cast("string"), F.lit("")))
    line = F.when(kind == "2", fields).when(kind == "3", F.concat_ws(",", fields, day, F.lit("x"))).otherwise(F.concat_ws(",", fields, day))
    folder = scratch_path(spark, "faulty")
    raw.select(line.alias("value")).write.text(folder)
    return rejects.read_csv_checked(spark, folder, RAW_SCHEMAS["raw_user_ratings"], header=False)


def _rejected_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = _faulty_ratings(spark, sf_dir)[1]
    return rejected.select("record", F.array_join("reasons", "; ").alias("reasons"), (F.col("line") > 0).alias("has_line"))


def _seeds_to_feature_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seeds written as CSV, the catalogue as a table of the session catalog under its routed name, all read back, and every
    mart stored under its own routed name on the way to the feature table."""
    raw = samples.raw_tables(prepare(spark), sf_dir)
    run, folder = uuid.uuid4().hex, scratch_path(spark, "seeds")
    tables.write_seeds(raw, folder)
    catalog_table = tables.routed_name("prod", "raw", "raw_content_catalog", f"stayline_{run}")
    tables.refresh_catalog(raw["raw_content_catalog"], catalog_table, folder)
    store = tables.table_store("prod", f"stayline_{run}", location=folder)
    built = Warehouse(tables.read_raw(spark, folder, catalog_table), samples.AS_OF, store=store)
    return comparable(built["ml_churn_feature_store"])


def _viewing_by_calendar(w: Warehouse) -> DataFrame:
    """Viewings and minutes by the attributes of their day."""
    watched = w["stg_watch_events"].select(F.col("watch_date").alias("date_day"), "watch_duration_minutes")
    return (
        watched.groupBy("date_day")
        .agg(F.count("*").alias("n"), F.sum("watch_duration_minutes").alias("minutes"))
        .join(w["dim_date"], "date_day")
        .groupBy(
            "year", "fiscal_year", "quarter", "month", "month_name", "day_of_week_num", "day_of_week_name", "is_weekend"
        )
        .agg(F.sum("n").alias("n_viewings"), F.sum("minutes").cast("long").alias("minutes"))
    )


def _flattened(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.flatten_catalog(**pages.landed_pages(prepare(spark), sf_dir))


def _json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages written as JSON lines, read back with the declared schema, flattened and stamped."""
    landed = pages.landed_pages(prepare(spark), sf_dir)
    folder = scratch_path(spark, "json")
    for name, df in landed.items():
        df.write.json(f"{folder}/{name}")
    read_back = catalog.flatten_catalog(
        tables.read_pages(spark, f"{folder}/movie_pages"),
        tables.read_movie_details(spark, f"{folder}/movie_details"),
        tables.read_pages(spark, f"{folder}/show_pages"),
        tables.read_show_details(spark, f"{folder}/show_details"),
    )
    return catalog.stamped(read_back, LOADED_AT)


def _matrix(w: Warehouse) -> DataFrame:
    return matrix.feature_matrix(w["ml_churn_feature_store"])


def _labelled(w: Warehouse) -> DataFrame:
    return w["dim_customer"].select("customer_id", F.col("is_churned").cast("int").alias(matrix.LABEL))


def _rule_scores(w: Warehouse) -> DataFrame:
    return evaluate.rule_scores(w["ml_churn_feature_store"])


def _imputed(w: Warehouse, scope: str) -> DataFrame:
    whole = cut_lineage(matrix.stratified_split(_matrix(w)))
    seen = whole if scope == "all" else whole.where("split = 'train'")
    return matrix.impute(whole, matrix.fit_medians(seen)).select("customer_id", *features.FEATURES)


def _plan_changes(w: Warehouse) -> DataFrame:
    changes = w["fct_subscription_event"].where(F.col("event_type").isin("upgrade", "downgrade"))
    return titles.plan_change_type(changes, "monthly_revenue", "previous_monthly_revenue").select(
        "subscription_event_key", "event_type", "monthly_revenue", "previous_monthly_revenue", "plan_change_type"
    )


def _stored_features(w: Warehouse) -> DataFrame:
    return cut_lineage(w["ml_churn_feature_store"])


# The model queries of a session share one training run by (application, folder): a level of all six models is one job, but
# there are some 1,200 levels.
_RUNS: dict[tuple, tuple[DataFrame, model.TrainingRun]] = {}


def _training_run(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, model.TrainingRun]:
    key = run_key(spark, sf_dir)
    if key not in _RUNS:
        stored = _stored_features(feature_warehouse(spark, sf_dir))
        _RUNS[key] = stored, model.train(stored)
    return _RUNS[key]


def _train_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _training_run(spark, sf_dir)[1].metrics


def _cv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.cv_summary(spark, _training_run(spark, sf_dir)[1].folds)


def _saved_and_loaded(spark: SparkSession, sf_dir: str) -> model.ChurnModel:
    folder = scratch_path(spark, "model")
    _training_run(spark, sf_dir)[1].model.save(spark, folder)
    return model.load(spark, folder)


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored, _ = _training_run(spark, sf_dir)
    return model.score_customers(_saved_and_loaded(spark, sf_dir), stored)


def _score_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the compiled expression of the model read back gives each customer the score that walking its stored trees gives."""
    stored, _ = _training_run(spark, sf_dir)
    fitted, features_ = _saved_and_loaded(spark, sf_dir), matrix.feature_matrix(stored)
    walked = model.walked_scores(fitted, features_).withColumnRenamed(evaluate.SCORE, "walked")
    same = F.col(evaluate.SCORE).eqNullSafe(F.col("walked"))
    return fitted.score(features_).join(walked, "customer_id", "left").select("customer_id", same.alias("score_agrees"))


def _ledger_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of every tree: whether splits have two children, whose covers add up to their own, and gains of at least gamma, whether
    leaves have a value, and whether no node is too deep."""
    fitted = _training_run(spark, sf_dir)[1].model
    ledger, setting = fitted.ledger(spark), fitted.settings
    below = (
        ledger.where("node > 0")
        .select("tree", F.floor((F.col("node") - 1) / 2).cast("int").alias("node"), "cover")
        .groupBy("tree", "node")
        .agg(F.count("*").alias("children"), F.sum("cover").alias("below"))
    )
    is_split = F.col("feature").isNotNull()
    return (
        ledger.join(below, ["tree", "node"], "left")
        .groupBy("tree")
        .agg(
            F.bool_and(F.coalesce("children", F.lit(0)) == F.when(is_split, 2).otherwise(0)).alias("is_binary"),
            F.bool_and(~is_split | (F.abs(F.col("cover") - F.col("below")) < 1e-5)).alias("covers_add_up"),
            F.bool_and(~is_split | (F.col("gain") >= setting.gamma)).alias("gains_enough"),
            F.bool_and(is_split != F.col("value").isNotNull()).alias("leaves_have_values"),
            F.bool_and(F.col("depth") <= setting.max_depth).alias("within_depth"),
        )
    )


def _importance(spark: SparkSession, sf_dir: str, top: int | None = 15) -> DataFrame:
    return model.importance_ranking(spark, _training_run(spark, sf_dir)[1].model, top)


def _importance_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole ranking written as one CSV file and read back."""
    folder = scratch_path(spark, "importance")
    tables.write_csv(_importance(spark, sf_dir, top=None), folder, single_header_file=True)
    ranked = spark.read.schema("feature string, importance double").option("header", "true").csv(folder)
    return ranked.select("feature", F.col("importance").between(0, 1).alias("is_share"))


def _first_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per feature the best split of all rows by the regularised gain, at 256 bins and otherwise the production setting."""
    whole = cut_lineage(_matrix(feature_warehouse(spark, sf_dir)))
    rows = matrix.impute(whole, matrix.fit_medians(whole)).where(F.col(matrix.LABEL).isNotNull())
    weight = matrix.class_weight(rows).first()["positive_weight"] or 1.0
    settings = model.Settings(max_bins=256, scale_pos_weight=weight)
    found = boosting.first_splits(rows, matrix.feature_columns(rows), settings, "customer_id", matrix.LABEL)
    return spark.createDataFrame(
        [(f, threshold, round(gain, 5)) for f, threshold, gain in found], "feature string, threshold double, gain double"
    )


def _published_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the staging models, counted through the views they are published as."""
    tables.publish_views(warehouse(spark, sf_dir), STAGING)
    return spark.sql(" union all ".join(f"select '{name}' as view_name, count(*) as n from {name}" for name in STAGING))


def _agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether prediction and tier of every customer are what the emitted score says."""
    score = F.col(evaluate.SCORE)
    tier = F.expr(
        f"case when {evaluate.SCORE} <= 0 then null when {evaluate.SCORE} <= 0.3 then 'low' "
        f"when {evaluate.SCORE} <= 0.6 then 'medium' when {evaluate.SCORE} <= 1 then 'high' end"
    )
    return _scored(spark, sf_dir).select(
        "customer_id",
        (F.col("predicted") == F.floor(score + 0.5).cast("int")).alias("prediction_agrees"),
        F.col("risk_tier").eqNullSafe(tier).alias("tier_agrees"),
        score.between(0, 1).alias("is_probability"),
    )


WATCH_RECENT = features.FEATURE_GROUPS["recent_activity"]
WATCH = (*features.FEATURE_GROUPS["watch_behavior"], "short_session_count", "watch_span_days")

QUERIES: dict[str, Query] = {
    **{name: _table(name) for name in STAGING},
    **{name: _table(name) for name in MARTS if name not in ("dim_date", "ml_churn_feature_store")},
    "calendar_viewing": lambda spark, sf_dir: _viewing_by_calendar(warehouse(spark, sf_dir)),
    "calendar_viewing_source_week": lambda spark, sf_dir: _viewing_by_calendar(warehouse(spark, sf_dir, week="source")),
    "fct_watch_event_fraction_input": _fraction_input,
    "fct_watch_event_fraction_scaled": lambda spark, sf_dir: _fraction_input(spark, sf_dir, completion_scale=100),
    "feat_customer": _on(lambda w: features.customer_features(w["dim_customer"], w.as_of)),
    "feat_watch": _columns(
        lambda w: features.watch_features(w["fct_watch_event"], w.as_of, stored=True), "customer_key", *WATCH
    ),
    "feat_watch_recent": _on(lambda w: features.watch_recent_features(w["fct_watch_event"], w.as_of)),
    "feat_subscription": _on(lambda w: features.subscription_features(w["fct_subscription_event"])),
    "feat_support": _on(lambda w: features.support_features(w["fct_support_interaction"], w.as_of)),
    "feat_rating": _on(lambda w: features.rating_features(w["stg_user_ratings"], w["dim_customer"])),
    "feat_watchlist": _on(lambda w: features.watchlist_features(w["stg_user_watchlist"], w["dim_customer"])),
    "ml_feature_store": _on_features(lambda w: w["ml_churn_feature_store"]),
    "ml_feature_store_stored": _stored_run,
    **{f"csv_seed_{name.removeprefix('raw_')}": _csv_round_trip(name) for name in RAW_SCHEMAS},
    "csv_checked_kept": lambda spark, sf_dir: _faulty_ratings(spark, sf_dir)[0],
    "csv_checked_rejects": _rejected_ratings,
    "seeds_to_feature_store": _seeds_to_feature_store,
    "dq_not_null": _stored_checks("not_null"),
    "dq_unique": _stored_checks("unique"),
    "dq_accepted_values": _stored_checks("accepted_values"),
    "dq_relationships": _stored_checks("relationships"),
    "dq_report": _stored_checks(*KINDS),
    "dq_relationships_staging": _on(
        lambda w: quality.with_status(
            quality.union_all(
                quality.relationship_check(
                    w[child], child, "customer_id", w["dim_customer"], "customer_id"
                )
                for child in (
                    "stg_watch_events",
                    "stg_subscription_events",
                    "stg_support_tickets",
                    "stg_user_ratings",
                    "stg_user_watchlist",
                )
            )
        )
    ),
    "source_freshness": _on(
        lambda w: quality.source_freshness(w["raw_content_catalog"], "raw_content_catalog", w.as_of)
    ),
    "catalog_checks": _on(lambda w: quality.catalog_checks(w["raw_content_catalog"], CATALOG_SCHEMA.names)),
    "null_rate_profile": _on_features(lambda w: quality.null_rates(w["ml_churn_feature_store"])),
    "class_balance": _on(lambda w: quality.class_balance(w["ml_churn_feature_store"])),
    "catalog_flatten": _flattened,
    "catalog_flatten_json": _json_round_trip,
    "catalog_genres": lambda spark, sf_dir: (
        _flattened(spark, sf_dir)
        .select("content_id", F.explode(F.split("genres", r"\|")).alias("genre"))
        .where("genre <> ''")
    ),
    "catalog_latest_load": _on(lambda w: staging.latest_load(w["raw_content_catalog"])),
    "user_title_summary": _on(lambda w: titles.user_title_summary(w["stg_watch_events"])),
    "watched_set": _on(lambda w: titles.watched_set(w["stg_watch_events"])),
    "watchlist_watched_flag": _on(
        lambda w: titles.watchlist_watched_flag(w["stg_user_watchlist"], w["stg_watch_events"])
    ),
    "distinct_genres": _on(lambda w: titles.distinct_genres(w["stg_content_catalog"])),
    "genre_pool": _on(lambda w: titles.genre_pool(w["stg_content_catalog"])),
    "preferred_genres": _on(lambda w: titles.preferred_genres(w["stg_customers"])),
    "popularity_share": _on(lambda w: titles.popularity_share(w["stg_content_catalog"])),
    "effective_runtime": _on(lambda w: titles.effective_runtime(w["stg_content_catalog"])),
    "active_span": _on(lambda w: titles.active_span(w["dim_customer"], w.as_of)),
    "plan_change_type": _on(_plan_changes),
    "feature_matrix": _on_features(_matrix),
    "feature_medians": _on_features(lambda w: ordered.exact_medians(cut_lineage(_matrix(w)), features.FEATURES)),
    "impute_median": _on_features(lambda w: _imputed(w, "train")),
    "impute_median_all": _on_features(lambda w: _imputed(w, "all")),
    "stratified_split": _on(lambda w: matrix.stratified_split(_labelled(w))),
    "stratified_folds": _on(lambda w: matrix.stratified_folds(_labelled(w))),
    "class_weight": _on(
        lambda w: matrix.class_weight(matrix.stratified_split(_labelled(w)).where("split = 'train'"))
    ),
    "roc_auc": _on(lambda w: evaluate.roc_auc(_rule_scores(w))),
    "average_precision": _on(
        lambda w: evaluate.average_precision(_rule_scores(w)).withColumn(
            "average_precision", F.round("average_precision", 10)
        )
    ),
    "confusion_matrix": _on(lambda w: evaluate.confusion_matrix(_rule_scores(w))),
    "classification_report": _on(lambda w: evaluate.classification_report(_rule_scores(w))),
    "risk_tiers": _on(
        lambda w: evaluate.with_tiers(_rule_scores(w)).select(
            "customer_id", matrix.LABEL, evaluate.SCORE, "predicted", "risk_tier"
        )
    ),
    "risk_tier_distribution": _on(lambda w: evaluate.risk_tier_distribution(evaluate.with_tiers(_rule_scores(w)))),
    "top_risk_customers": _on(lambda w: evaluate.top_risk(evaluate.with_tiers(_rule_scores(w)))),
    "training_facts": _on(lambda w: model.run_facts(matrix.stratified_split(_matrix(w)))),
    "score_agreement": _agreement,
    "importance_names": lambda spark, sf_dir: _importance(spark, sf_dir, top=None).select("feature"),
    "importance_file": _importance_file,
    "published_views": _published_views,
    "first_splits": _first_splits,
    "ledger_checks": _ledger_checks,
    "score_walk": _score_walk,
    "train_gbt": _train_metrics,
    "cv_auc": _cv,
    "score_customers": _scored,
    "feature_importance": _importance,
}
