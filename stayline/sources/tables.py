"""Reading and writing tables: CSV seeds, stored tables, landed JSON, output routing."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayline.schemas import (
    CATALOG_SCHEMA,
    LIST_PAGE_SCHEMA,
    MOVIE_DETAIL_SCHEMA,
    RAW_SCHEMAS,
    SHOW_DETAIL_SCHEMA,
)

# Fixed values of the output routing.
PROD_CATALOG, RAW_SCHEMA, PROD_SCHEMA = "prod", "dbo_raw", "dbo"

CSV_OPTIONS = {
    "header": "true",
    "dateFormat": "yyyy-MM-dd",
    "timestampFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]",
    "escape": '"',
}


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A header CSV with a declared schema: no inference pass, and a malformed value fails the job.

    An empty field is NULL, as the tools that write these files mean it; text cannot be empty.
    """
    return spark.read.options(**CSV_OPTIONS, mode="FAILFAST").schema(schema).csv(path)


def write_csv(df: DataFrame, path: str, single_header_file: bool = False, compression: str = "none") -> None:
    """Written in parallel, one file per task; a small report may ask for one file."""
    (df.coalesce(1) if single_header_file else df).write.mode("overwrite").options(**CSV_OPTIONS, compression=compression).csv(path)


def read_seeds(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The six raw CSV tables of a folder."""
    return {name: read_csv(spark, f"{folder}/{name}.csv", schema) for name, schema in RAW_SCHEMAS.items()}


def write_seeds(tables: Mapping[str, DataFrame], folder: str) -> None:
    """The six raw tables as CSV, compressed by task: as plain text they are most of what a run from seeds writes."""
    for name, schema in RAW_SCHEMAS.items():
        typed = [F.col(field.name).cast(field.dataType).alias(field.name) for field in schema]
        write_csv(tables[name].select(*typed), f"{folder}/{name}.csv", compression="gzip")


def read_raw(spark: SparkSession, seed_folder: str, catalog_table: str) -> dict[str, DataFrame]:
    """All seven raw tables: the CSV seeds and the stored catalogue."""
    return {**read_seeds(spark, seed_folder), "raw_content_catalog": spark.table(catalog_table)}


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed list pages, one JSON document per line."""
    return spark.read.schema(LIST_PAGE_SCHEMA).json(path)


def read_movie_details(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MOVIE_DETAIL_SCHEMA).json(path)


def read_show_details(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SHOW_DETAIL_SCHEMA).json(path)


def routed_name(
    target: str,
    layer: str | None,
    name: str,
    default_schema: str,
    default_catalog: str | None = None,
    catalog: str | None = None,
) -> str:
    """Where a table of a layer goes.

    Development puts every layer into its one schema, except that raw tables are always the production ones. Elsewhere
    a layer has a schema of its own, ``<default>_<layer>``. Without catalogs the name has two parts.
    """
    if target == "dev":
        schema = RAW_SCHEMA if layer == "raw" else default_schema
    else:
        schema = f"{default_schema}_{layer.strip()}" if layer else default_schema
    if target == "dev" and layer == "raw":
        where = PROD_CATALOG if (catalog or default_catalog) else None
    else:
        where = catalog.strip() if catalog else default_catalog
    return ".".join(part for part in (where, schema, name) if part)


Check = Callable[[DataFrame], None]


def not_empty(df: DataFrame) -> None:
    """A check for a refresh: a table without rows does not become current."""
    if df.isEmpty():
        raise ValueError("the new version has no rows")


def _file_system(spark: SparkSession, path: str):
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(context._jsc.hadoopConfiguration())


def _delete(spark: SparkSession, path: str) -> None:
    place, files = _file_system(spark, path)
    files.delete(place, True)


def _folders(spark: SparkSession, path: str) -> list[str]:
    place, files = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(place) if s.isDirectory()) if files.exists(place) else []


def _new_version() -> str:
    # Names sort by the time they were begun.
    return f"v{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def _expire(spark: SparkSession, folder: str, current: str, keep: int) -> None:
    """Delete versions begun before the last ``keep``, never the current one and never one begun after it."""
    older = [name for name in _folders(spark, folder) if name.startswith("v") and name < current]
    for name in older[: max(0, len(older) - keep + 1)]:
        _delete(spark, f"{folder}/{name}")


def refresh_table(
    df: DataFrame, table: str, location: str | None = None, checks: Iterable[Check] = (), keep: int = 2
) -> DataFrame:
    """Full refresh by version and pointer: write the rows to a folder of their own, check them there, make them current in one
    step, and read the table back. The schema is created when needed, in a folder of ``location`` if one is given.

    Until that step readers see the table as it was, whatever happens to the write or the checks; the folder of a failed
    version is removed. The step is a change of the table's location in the catalog. Where the columns changed, or the table
    was not made this way, the new table takes the old one's name instead. The last ``keep`` versions stay for readers that
    have begun.
    """
    spark = df.sparkSession
    schema, name = table.rsplit(".", 1) if "." in table else (spark.catalog.currentDatabase(), table)
    where = f" LOCATION '{location}/{schema}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}{where}")
    folder = f"{spark.catalog.getDatabase(schema).locationUri}/{name}.versions"
    version = _new_version()
    path, staged = f"{folder}/{version}", f"{schema}.{name}__{version.replace('-', '_')}"
    try:
        df.write.option("path", path).saveAsTable(staged)
        for check in checks:
            check(spark.table(staged))
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {staged}")
        _delete(spark, path)
        raise
    full = f"{schema}.{name}"
    known = spark.catalog.tableExists(full)
    if known and _same_shape(spark, full, staged):
        spark.sql(f"ALTER TABLE {full} SET LOCATION '{path}'")
        spark.sql(f"DROP TABLE {staged}")  # the files stay: the table was made with a path
    else:
        spark.sql(f"DROP TABLE IF EXISTS {full}")
        spark.sql(f"ALTER TABLE {staged} RENAME TO {full}")
    spark.catalog.refreshTable(full)
    _expire(spark, folder, version, keep)
    return spark.table(full)


def _same_shape(spark: SparkSession, table: str, other: str) -> bool:
    """Whether both are tables over a path with the same columns."""
    made_so = spark.catalog.getTable(table).tableType == "EXTERNAL"
    return made_so and spark.table(table).schema == spark.table(other).schema


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """A stored table, such as the feature table for training."""
    return spark.table(table)


def refresh_catalog(catalog: DataFrame, table: str, location: str | None = None) -> DataFrame:
    """Full refresh of the raw catalogue, in its declared column order."""
    return refresh_table(catalog.select(*CATALOG_SCHEMA.names), table, location, checks=[not_empty])


def table_store(
    target: str, default_schema: str, default_catalog: str | None = None, location: str | None = None
):
    """A store for the warehouse that keeps tables in the session catalog under their routed names."""

    def store(layer: str, name: str, df: DataFrame) -> DataFrame:
        return refresh_table(df, routed_name(target, layer, name, default_schema, default_catalog), location)

    return store


_POINTER = "_CURRENT"


def current_version(spark: SparkSession, folder: str) -> str | None:
    """The version a folder's pointer names, if it has one."""
    place, files = _file_system(spark, f"{folder}/{_POINTER}")
    if not files.exists(place):
        return None
    stream = files.open(place)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _point_to(spark: SparkSession, folder: str, version: str) -> None:
    """Replace the pointer by one rename, which no reader can see half done."""
    jvm = spark.sparkContext._jvm
    draft, files = _file_system(spark, f"{folder}/{_POINTER}.{version}")
    out = files.create(draft)
    out.write(bytearray(version.encode()))
    out.close()
    place = jvm.org.apache.hadoop.fs.Path(f"{folder}/{_POINTER}")
    options = jvm.org.apache.hadoop.fs.Options.Rename
    array = spark.sparkContext._gateway.new_array(options, 1)
    array[0] = options.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(files.makeQualified(draft), files.makeQualified(place), array)


def refresh_folder(df: DataFrame, folder: str, checks: Iterable[Check] = (), keep: int = 2) -> DataFrame:
    """The same for a parquet folder without a catalog: a version of its own, checks, then a pointer file replaced by rename."""
    spark, version = df.sparkSession, _new_version()
    path = f"{folder}/{version}"
    try:
        df.write.parquet(path)
        for check in checks:
            check(spark.read.parquet(path))
    except Exception:
        _delete(spark, path)
        raise
    _point_to(spark, folder, version)
    _expire(spark, folder, version, keep)
    return read_folder(spark, folder)


def read_folder(spark: SparkSession, folder: str) -> DataFrame:
    """The current version of a folder kept by ``refresh_folder``."""
    version = current_version(spark, folder)
    if version is None:
        raise FileNotFoundError(f"{folder} has no current version")
    return spark.read.parquet(f"{folder}/{version}")


def parquet_store(folder: str):
    """A store for the warehouse that keeps parquet folders on shared storage, each refreshed by version and pointer."""

    def store(layer: str, name: str, df: DataFrame) -> DataFrame:
        return refresh_folder(df, f"{folder}/{layer}/{name}")

    return store


def publish_views(tables: Mapping[str, DataFrame], names: Iterable[str]) -> None:
    """Expose staging models as views: they are evaluated where they are used."""
    for name in names:
        tables[name].createOrReplaceTempView(name)
