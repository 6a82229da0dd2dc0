"""Loads that set bad records aside instead of failing: every record is kept or rejected, with file, line and reasons.

The strict readers of ``tables`` fail the load at the first bad value. These read the same files line by line, parse every record as
text, cast field by field, and give two tables: the typed rows of the records without fault, and the others as they stand in the file.
Blank lines are no records. Line numbers cost one more pass that counts the lines of each file split; the table of splits is
small (one row per split), records are not shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayline.sources.tables import CSV_OPTIONS

MALFORMED = "malformed record"
_FAULTY = "_faulty"
REJECTS = "file string, line long, reasons array<string>, record string"


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of all files under a path: (file, line, record), lines counted from 1 in each file."""
    lines = spark.read.text(path).select(
        F.col("value").alias("record"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_id"),
    )
    # Ids grow by one within a split. The lines of a split follow those of the splits before it.
    splits = lines.groupBy("file", "_start").agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
    earlier = F.sum("_n").over(Window.partitionBy("file").orderBy("_start")) - F.col("_n")
    offsets = splits.select("file", "_start", (earlier - F.col("_first") + 1).alias("_offset"))
    return lines.join(offsets, ["file", "_start"]).select("file", (F.col("_id") + F.col("_offset")).alias("line"), "record")


def typed(raw: Column, kind: T.DataType) -> Column:
    """A text field as its declared type, as the strict reader takes it; NULL where it is none."""
    if isinstance(kind, T.StringType):
        return raw
    if isinstance(kind, T.IntegralType):
        return F.when(raw.rlike(r"^[+-]?[0-9]+\z"), raw.try_cast(kind))
    if isinstance(kind, T.BooleanType):
        return F.when(F.lower(raw) == "true", F.lit(True)).when(F.lower(raw) == "false", F.lit(False))
    if isinstance(kind, T.DateType):
        return F.try_to_date(raw, CSV_OPTIONS["dateFormat"])
    if isinstance(kind, T.TimestampType):
        return F.try_to_timestamp(raw, F.lit(CSV_OPTIONS["timestampFormat"]))
    return raw.try_cast(kind)


def _split(lines: DataFrame, row: Column, reasons: Column, kept: list[Column]) -> tuple[DataFrame, DataFrame]:
    judged = lines.withColumn("_row", row).withColumn("reasons", reasons)
    return (
        judged.where(F.size("reasons") == 0).select(*kept),
        judged.where(F.size("reasons") > 0).select("file", "line", "reasons", "record"),
    )


def read_csv_checked(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """Typed rows and rejected records of CSV files. Reasons are ``malformed record`` (a wrong number of fields or a broken quote) or,
    for each field that does not fit, ``bad <type>: <column>``. An empty field is NULL and no fault."""
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema] + [T.StructField(_FAULTY, T.StringType())])
    options = {k: v for k, v in CSV_OPTIONS.items() if k != "header"} | {"columnNameOfCorruptRecord": _FAULTY, "mode": "PERMISSIVE"}
    lines = numbered_lines(spark, path).where(F.trim("record") != "")
    if header:
        lines = lines.where("line > 1")
    raw = {f.name: F.nullif(F.col("_row")[f.name], F.lit("")) for f in schema}
    values = {f.name: typed(raw[f.name], f.dataType) for f in schema}
    faults = [
        F.when(raw[f.name].isNotNull() & values[f.name].isNull(), F.lit(f"bad {f.dataType.simpleString()}: {f.name}")) for f in schema
    ]
    malformed = F.col("_row")[_FAULTY].isNotNull()
    reasons = F.when(malformed, F.array(F.lit(MALFORMED))).otherwise(F.array_compact(F.array(*faults)))
    row = F.from_csv("record", F.lit(texts.toDDL()), options)
    return _split(lines, row, reasons, [values[f.name].alias(f.name) for f in schema])


def read_json_checked(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Rows and rejected records of files with one JSON document a line; a document is rejected whole."""
    lines = numbered_lines(spark, path).where(F.trim("record") != "")
    with_fault = T.StructType([*schema, T.StructField(_FAULTY, T.StringType())])
    row = F.from_json("record", with_fault, {"columnNameOfCorruptRecord": _FAULTY, "mode": "PERMISSIVE"})
    reasons = F.when(F.col("_row").isNull() | F.col("_row")[_FAULTY].isNotNull(), F.array(F.lit(MALFORMED))).otherwise(
        F.array().cast("array<string>")
    )
    return _split(lines, row, reasons, [F.col("_row")[f.name].alias(f.name) for f in schema])


def append_rejects(rejected: DataFrame, source: str, table: str) -> None:
    """Adds the rejected records of a load to the reject table, with the name of what was loaded."""
    rejected.withColumn("source", F.lit(source)).write.mode("append").saveAsTable(table)
