"""Data-quality operators. Each yields rows (test, table_name, column_name, n_failed); a report is their union."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.functions import vocab
from stayline.functions.columns import count_where, instant
from stayline.functions.keys import packed


def _as_rows(one_row: DataFrame, entries: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """Turn a one-row aggregate into one row per (test, table, column, name of its aggregate)."""
    structs = [
        F.struct(
            F.lit(test).alias("test"),
            F.lit(table).alias("table_name"),
            F.lit(column).alias("column_name"),
            F.col(measure).cast("bigint").alias("n_failed"),
        )
        for test, table, column, measure in entries
    ]
    return one_row.select(F.inline(F.array(*structs)))


def column_checks(
    df: DataFrame, table: str, not_null: Iterable[str] = (), accepted: Mapping[str, Sequence] | None = None
) -> DataFrame:
    """NULL and domain checks of one table in a single scan.

    ``not_null`` counts NULL rows. ``accepted`` counts the different values outside the list; NULL passes.
    """
    measures: list[Column] = []
    entries = []
    for name in not_null:
        alias = f"null_{name}"
        measures.append(count_where(F.col(name).isNull()).alias(alias))
        entries.append(("not_null", table, name, alias))
    for name, values in (accepted or {}).items():
        alias = f"domain_{name}"
        stray = F.when(~F.col(name).isin(*values), F.col(name))
        measures.append(F.count_distinct(stray).alias(alias))
        entries.append(("accepted_values", table, name, alias))
    return _as_rows(df.agg(*measures), entries)


def unique_checks(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Values that occur more than once, per column; NULLs are ignored. One scan and one shuffle for all columns."""
    labelled = df.select(
        F.inline(
            F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns])
        )
    )
    repeated = labelled.where("value is not null").groupBy("column_name", "value").count().where("count > 1")
    found = repeated.agg(*[count_where(F.col("column_name") == c).alias(c) for c in columns])
    return _as_rows(found, [("unique", table, c, c) for c in columns])


def relationship_check(
    child: DataFrame, table: str, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Child rows whose non-NULL key has no parent. Keys are counted first, so a frequent key is looked up once."""
    keys = child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("_key")).agg(F.count("*").alias("_n"))
    orphans = keys.join(parent.select(F.col(parent_column).alias("_key")), "_key", "left_anti")
    total = orphans.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("orphans"))
    return _as_rows(total, [("relationships", table, column, "orphans")])


def with_status(failures: DataFrame) -> DataFrame:
    return failures.withColumn("status", F.when(F.col("n_failed") > 0, "fail").otherwise("pass"))


def union_all(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def run_checks(tables: Mapping[str, DataFrame], checks: Mapping[str, Mapping], kinds: Iterable[str]) -> DataFrame:
    """The declared checks of the given kinds over all tables, as one report.

    ``checks`` maps a table to ``not_null`` and ``unique`` column lists, ``accepted_values`` {column: values} and
    ``relationships`` {column: (parent table, parent column)}.
    """
    wanted = set(kinds)
    parts = []
    keys: dict[str, list[tuple[str, str, str, str, str]]] = {}
    for name, declared in checks.items():
        not_null = declared.get("not_null", ()) if "not_null" in wanted else ()
        accepted = declared.get("accepted_values", {}) if "accepted_values" in wanted else {}
        if not_null or accepted:
            parts.append(column_checks(tables[name], name, not_null, accepted))
        if "unique" in wanted:
            keys.setdefault(name, []).extend(("unique", name, c, "own", c) for c in declared.get("unique", ()))
        if "relationships" in wanted:
            for column, (parent, parent_column) in declared.get("relationships", {}).items():
                keys.setdefault(name, []).append(("relationships", name, column, "own", column))
                keys.setdefault(parent, []).append(("relationships", name, column, "parent", parent_column))
    used = {name: entries for name, entries in keys.items() if entries}
    if used:
        parts.append(key_checks(tables, used))
    return with_status(union_all(parts))


def key_checks(tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[tuple[str, str, str, str, str]]]) -> DataFrame:
    """All uniqueness and relationship checks in one shuffle: one scan of each table turns its keys into rows.

    ``keys`` lists for a table what its columns are needed for: (test, table and column of the check, whether as its own
    or as the parent's key, the column here). Keys are counted map-side, so a frequent one is a single row by task; a value
    is a failure when it is its own more than once (unique) or has no parent (relationships, by its number of rows).
    """
    names = ("test", "table_name", "column_name")
    declared = sorted({tuple(check) for entries in keys.values() for *check, _, _ in entries})
    # A value travels with the number of its check instead of three names, and a digest in its bytes.
    number = {check: i for i, check in enumerate(declared)}
    rows = union_all(
        tables[name]
        .select(
            F.inline(
                F.array(
                    *[
                        F.struct(
                            F.lit(number[tuple(check)]).alias("check"),
                            F.lit(role == "parent").alias("is_parent"),
                            packed(F.col(column).cast("string")).alias("value"),
                        )
                        for *check, role, column in entries
                    ]
                )
            )
        )
        .where("value is not null")
        for name, entries in keys.items()
    )
    own, parents = count_where(~F.col("is_parent")), count_where(F.col("is_parent"))
    by_value = rows.groupBy("check", "value").agg(own.alias("own"), parents.alias("parents"))
    unique = [i for check, i in number.items() if check[0] == "unique"]
    failed = F.when(F.col("check").isin(unique), (F.col("own") > 1).cast("bigint")).otherwise(
        F.when(F.col("parents") == 0, F.col("own")).otherwise(0)
    )
    found = by_value.groupBy("check").agg(F.sum(failed).cast("bigint").alias("n_failed"))
    # A check whose column holds no value at all has no rows to be found in.
    every = [F.struct(F.lit(i).alias("check"), *(F.lit(v).alias(n) for n, v in zip(names, check, strict=True))) for check, i in number.items()]
    return (
        found.sparkSession.range(1)
        .select(F.inline(F.array(*every)))
        .join(found, "check", "left")
        .select(*names, F.coalesce("n_failed", F.lit(0)).cast("bigint").alias("n_failed"))
    )


def source_freshness(
    df: DataFrame,
    table: str,
    as_of: date | datetime,
    loaded_at: str = "_loaded_at",
    warn_days: int = vocab.FRESHNESS_WARN_DAYS,
    error_days: int = vocab.FRESHNESS_ERROR_DAYS,
) -> DataFrame:
    """Age of the newest load. Older than ``warn_days`` warns; older than ``error_days``, or no load, is an error."""
    newest = F.col("max_loaded_at")
    age_days = (F.unix_timestamp(instant(as_of)) - F.unix_timestamp(newest)) / 86400.0
    status = (
        F.when(newest.isNull() | (age_days > error_days), "error").when(age_days > warn_days, "warn").otherwise("pass")
    )
    return df.agg(F.max(loaded_at).alias("max_loaded_at")).select(
        F.lit(table).alias("table_name"), "max_loaded_at", age_days.alias("age_days"), status.alias("status")
    )


def null_rates(df: DataFrame, threshold: float = vocab.HIGH_NULL_RATE) -> DataFrame:
    """Share of NULLs per column from one scan, highest first, flagged above the threshold."""
    rates = df.agg(*[F.avg(F.col(c).isNull().cast("int")).alias(c) for c in df.columns])
    rows = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_rate")) for c in df.columns]
    )
    return (
        rates.select(F.inline(rows))
        .withColumn("is_high", F.col("null_rate") > threshold)
        .orderBy(F.desc("null_rate"), "column_name")
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per non-NULL value and their share."""
    present = df.where(F.col(column).isNotNull())
    total = present.agg(F.count("*")).scalar()
    return present.groupBy(column).agg(F.count("*").alias("n")).withColumn("share", F.col("n") / total)


def class_balance(df: DataFrame, label: str = "target_is_churned") -> DataFrame:
    return value_counts(df, label)


def catalog_checks(catalog: DataFrame, expected: Sequence[str], table: str = "raw_content_catalog") -> DataFrame:
    """Smoke checks of an ingested catalogue: it has rows, all columns, known types and prefixed ids."""
    missing = [c for c in expected if c not in catalog.columns]
    kind = F.col("content_type")
    found = catalog.agg(
        (F.count("*") == 0).cast("int").alias("empty"),
        F.count_distinct(F.when(~kind.isin(*vocab.CONTENT_TYPES), kind)).alias("types"),
        count_where(~F.col("content_id").startswith(vocab.CONTENT_ID_PREFIX)).alias("prefix"),
        F.lit(len(missing)).alias("missing"),
    )
    return with_status(
        _as_rows(
            found,
            [
                ("not_empty", table, "*", "empty"),
                ("has_columns", table, "*", "missing"),
                ("accepted_values", table, "content_type", "types"),
                ("id_prefix", table, "content_id", "prefix"),
            ],
        )
    )
