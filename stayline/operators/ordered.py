"""Order-based operators that never bring one group, or the whole table, onto one task.

The pattern is the same throughout: cut the order into many buckets, aggregate per bucket (combined map-side),
accumulate over the few buckets, and look at single rows only inside a bucket.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from decimal import Decimal

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayline.session import cut_lineage

HASH_SEED = 42


def seeded_hash(key: str | Column, seed: int = HASH_SEED) -> Column:
    """Uniform and reproducible: the order of these hashes is a shuffle of the keys."""
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat_ws("|", F.lit(str(seed)), key.cast("string")))


def hash_cuts(
    df: DataFrame, key: str, label: str, fractions: Sequence[Decimal], seed: int = HASH_SEED, digits: int = 3
) -> DataFrame:
    """Per class label, the hash at or below which exactly ceil(fraction * rows) of its keys lie.

    Yields one row (label, cut_no, cut_hash) per label and fraction. Rows are counted per hash prefix; only the prefix
    holding a cut (one in 16**digits of the class) is ranked.
    """
    hashed = df.select(F.col(label), seeded_hash(key, seed).alias("h"))
    hashed = hashed.withColumn("prefix", F.substring("h", 1, digits))
    in_order = Window.partitionBy(label).orderBy("prefix")
    counted = (
        hashed.groupBy(label, "prefix")
        .agg(F.count("*").alias("n"))
        .withColumn("upto", F.sum("n").over(in_order))
        .withColumn("total", F.sum("n").over(Window.partitionBy(label)))
    )
    targets = F.array(
        *[
            F.struct(F.lit(i).alias("cut_no"), F.ceil(F.col("total") * F.lit(fraction)).cast("bigint").alias("target"))
            for i, fraction in enumerate(fractions)
        ]
    )
    wanted = (
        counted.select(label, "prefix", "n", "upto", F.inline(targets))
        .where("target <= upto and target > upto - n")
        .select(label, "prefix", "cut_no", (F.col("target") - F.col("upto") + F.col("n")).alias("place"))
    )
    # Rows sharing a hash are counted before they are ranked: copies of one key never pile up in a window.
    in_prefix = Window.partitionBy(label, "prefix", "cut_no").orderBy("h")
    return (
        hashed.join(F.broadcast(wanted), [label, "prefix"])  # one row per label and fraction
        .groupBy(label, "prefix", "cut_no", "place", "h")
        .agg(F.count("*").alias("n"))
        .withColumn("upto", F.sum("n").over(in_prefix))
        .where("place <= upto and place > upto - n")
        .select(label, "cut_no", F.col("h").alias("cut_hash"))
    )


def numbered(df: DataFrame, group: str, hash_column: str, number: str, digits: int = 3) -> DataFrame:
    """Number each group's rows 1..n in the order of a uniform hex hash column, different for every row of a group."""
    prefixed = df.withColumn("_prefix", F.substring(hash_column, 1, digits))
    before = (
        prefixed.groupBy(group, "_prefix")
        .agg(F.count("*").alias("_n"))
        .select(
            group,
            "_prefix",
            (F.sum("_n").over(Window.partitionBy(group).orderBy("_prefix")) - F.col("_n")).alias("_before"),
        )
    )
    in_prefix = Window.partitionBy(group, "_prefix").orderBy(hash_column)
    return (
        prefixed.withColumn("_rank", F.row_number().over(in_prefix))
        .join(before, [group, "_prefix"])
        .withColumn(number, (F.col("_before") + F.col("_rank")))
        .drop("_prefix", "_rank", "_before")
    )


def running_totals(
    df: DataFrame, order: str, values: Sequence[str], buckets: int | None = None, stored: bool = False
) -> DataFrame:
    """Add ``upto_<value>``: the sum of the value over all rows up to and including this one, by distinct ``order``.

    Eager: the input is written out, so it is computed once (a ``stored`` frame is used as it is), and its quantiles cut
    the order into buckets of similar size, by default two for each shuffle partition.
    """
    fixed = df if stored else cut_lineage(df)
    buckets = buckets or 2 * max(16, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    quantiles = fixed.approxQuantile(order, [i / buckets for i in range(1, buckets)], 1 / (4 * buckets))
    splits = [float("-inf"), *sorted(set(quantiles)), float("inf")]
    placed = Bucketizer(splits=splits, inputCol=order, outputCol="_bucket").transform(fixed)
    # At most `buckets` rows from here on: one window over all of them is safe, and so is broadcasting them.
    sums = placed.groupBy("_bucket").agg(*[F.sum(v).alias(v) for v in values])
    bucket_order = Window.orderBy("_bucket")
    before = sums.select("_bucket", *[(F.sum(v).over(bucket_order) - F.col(v)).alias(f"_before_{v}") for v in values])
    inside = Window.partitionBy("_bucket").orderBy(order)
    return (
        placed.withColumns({f"upto_{v}": F.sum(v).over(inside) for v in values})
        .join(F.broadcast(before), "_bucket")
        .withColumns({f"upto_{v}": F.col(f"upto_{v}") + F.col(f"_before_{v}") for v in values})
        .drop("_bucket", *[f"_before_{v}" for v in values])
    )


def exact_medians(df: DataFrame, columns: Sequence[str], slices: int = 64) -> DataFrame:
    """Exact median (midpoint for an even count) of each double column: (column_name, median); NULLs are ignored.

    Sketches per column, combined before the shuffle and spread by column, cut the middle two percent into slices; these bounds,
    ``slices + 1`` numbers a column, reach the driver. Values outside are only counted, those inside are counted by value, all
    map-side, and only the values of the one or two slices that hold the middle are ranked, about one in ``slices * 50`` of the
    column. A column without values yields no row.
    """

    def cells(kept: Sequence[str], *more: Callable[[str], Column]) -> DataFrame:
        return df.select(
            F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value"), *(f(c) for f in more)) for c in kept]))
        ).where("value is not null")

    marks = [0.49 + 0.02 * i / slices for i in range(slices + 1)]
    found = cells(columns).groupBy("column_name").agg(F.percentile_approx("value", marks, 2000).alias("bounds")).collect()
    bounds = {row["column_name"]: row["bounds"] for row in found}
    if not bounds:
        return df.sparkSession.createDataFrame([], "column_name string, median double")

    def part(c: str) -> Column:
        """Below the middle, in it or above it."""
        low, high = F.lit(bounds[c][0]), F.lit(bounds[c][-1])
        return F.when(F.col(c) < low, -1).when(F.col(c) > high, 1).otherwise(0).alias("part")

    by_value = (
        cells([c for c in columns if c in bounds], part)
        .groupBy("column_name", "part", F.when(F.col("part") == 0, F.col("value")).alias("value"))
        .agg(F.count("*").alias("n"))
    )
    # The slice of a value: how many bounds lie below it.
    known = df.sparkSession.createDataFrame(list(bounds.items()), "column_name string, bounds array<double>")
    slice_no = F.when(F.col("part") == 0, F.size(F.filter("bounds", lambda bound: bound < F.col("value"))))
    own_slice = F.coalesce(slice_no, F.col("part") * (slices + 2)).alias("slice")
    placed = by_value.join(F.broadcast(known), "column_name").select("column_name", "value", "n", own_slice)
    in_order = Window.partitionBy("column_name").orderBy("slice")
    counted = (
        placed.groupBy("column_name", "slice")
        .agg(F.sum("n").alias("n"))
        .withColumn("before", F.sum("n").over(in_order) - F.col("n"))
        .withColumn("total", F.sum("n").over(Window.partitionBy("column_name")))
    )
    middle = counted.where("before < (total + 2) div 2 and (total + 1) div 2 <= before + n").drop("n")
    by_value = Window.partitionBy("column_name", "slice").orderBy("value")
    ranked = (
        placed.join(F.broadcast(middle), ["column_name", "slice"])  # at most two rows per column
        .withColumn("upto", F.col("before") + F.sum("n").over(by_value))
    )

    def at(rank: str) -> Column:
        return F.max(F.when(F.expr(f"upto - n < {rank} and {rank} <= upto"), F.col("value")))

    return ranked.groupBy("column_name").agg(
        ((at("(total + 1) div 2") + at("(total + 2) div 2")) / 2).alias("median")
    )


# Rows of one group that a single window may order; a longer history is cut into its days.
LONG_HISTORY = 100_000


def previous_values(
    df: DataFrame, group: str, day: str, ties: Sequence[Column], values: Sequence[str], longest: int = LONG_HISTORY
) -> DataFrame:
    """Add ``previous_<value>``: what the row before it in (day, ties) order has, within a group.

    A group of up to ``longest`` rows is one window. The history of a longer one is cut into days, each a window of its own, so
    that it is spread over tasks; the last row of a day is carried to the group's next day with rows by a table of one row for each day,
    which a map-side combined maximum finds. All orders are ascending with nulls first, as structs compare. Groups above the limit are
    at most rows / ``longest``, so the list of them is small.
    """
    long_groups = (
        df.groupBy(group).agg(F.count(day).alias("_n")).where(F.col("_n") > longest).select(group, F.lit(True).alias("_long"))
    )
    ranged = df.join(long_groups, group, "left").withColumns(
        {"_range": F.when(F.col("_long"), F.col(day)), "_own": F.struct(*values)}
    )
    order = [F.col(day), *ties]
    inside = ranged.withColumn("_before", F.lag("_own").over(Window.partitionBy(group, "_range").orderBy(*order)))
    place = F.struct(*(c.alias(f"o{i}") for i, c in enumerate(order)))
    last = ranged.where("_range is not null").groupBy(group, "_range").agg(F.max_by("_own", place).alias("_last"))
    carried = last.withColumn("_carried", F.lag("_last").over(Window.partitionBy(group).orderBy("_range"))).drop("_last")
    before = F.coalesce("_before", "_carried")
    return (
        inside.join(carried, [group, "_range"], "left")
        .withColumns({f"previous_{v}": before[v] for v in values})
        .select(*df.columns, *(f"previous_{v}" for v in values))
    )
