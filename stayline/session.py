"""Session settings and the one place where lineage is cut."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job relies on. AQE re-plans joins from measured sizes: a dimension is broadcast only when
# its real size is under the threshold, and an oversized join partition (one customer or title holding a large share
# of the events) is split across tasks.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",  # a strict cast of a bad value fails the load
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A join whose smaller side has only short partitions hashes them instead of sorting the other side.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.parquet.compression.codec": "zstd",  # keys are digests in hex: half the bytes on disk
}

# Files of a table that is broadcast without being measured. A larger file says little about the rows in it: keys in sequence and
# repeated words take a few bits each, and a table estimated at 10 MB was 100 MB and more in the driver's heap.
UNMEASURED_BROADCAST = 64 * 1024

# Setting for sessions that run Python functions over long texts: what travels to a task at one time is few rows. It holds for the
# whole session and changes no result; the operators work without it and need more memory then.
TEXT_CONF = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}


def prepare_texts(spark: SparkSession) -> SparkSession:
    """Apply ``TEXT_CONF`` to a session."""
    for key, value in TEXT_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "stayline", master: str | None = None, **conf) -> SparkSession:
    """Session for scripts and tests; a cluster job passes its own."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return measure_broadcasts(spark)


def measure_broadcasts(spark: SparkSession) -> SparkSession:
    """Let the session's limit of a broadcast hold for rows that have been counted, and only a few KB of files go unmeasured. A
    session without broadcasts, or with a lower limit, stays as it is."""
    by_files, by_rows = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    limit = spark.conf.get(by_files)
    if not limit.startswith("-") and spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(limit) > UNMEASURED_BROADCAST:
        if spark.conf.get(by_rows, None) is None:
            spark.conf.set(by_rows, limit)
        spark.conf.set(by_files, str(UNMEASURED_BROADCAST))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir``. A local session without it gets a temporary one."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
        context.setCheckpointDir(configured or tempfile.mkdtemp(prefix="stayline-"))
    return context.getCheckpointDir()


# Folders written so far, by application: what remove_intermediates takes away.
_WRITTEN: dict[str, list[str]] = {}
_removals = 0


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A new path under the shared folder for something that is only needed until the caller has its results."""
    path = f"{shared_dir(spark)}/{kind}-{uuid.uuid4().hex}"
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def remove_intermediates(spark: SparkSession) -> int:
    """Delete what this application wrote under the shared folder, through the file system it lives in; the number of paths.

    Frames that still read them stop working: call it when results are written elsewhere or collected.
    """
    global _removals
    _removals += 1
    context = spark.sparkContext
    paths = _WRITTEN.pop(context.applicationId, [])
    for name in paths:
        path = context._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
    return len(paths)


def run_key(spark: SparkSession, folder: str) -> tuple:
    """Names what has been stored for a folder in this application, until intermediates are removed or an entry of the folder
    gets another size or time."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    entries = path.getFileSystem(context._jsc.hadoopConfiguration()).listStatus(path)
    stamps = sorted((e.getPath().getName(), e.getLen(), e.getModificationTime()) for e in entries)
    return context.applicationId, _removals, folder, tuple(stamps)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows once to a parquet table in the shared folder and read them back.

    What follows scans only the columns it needs, and a lost executor never replays the upstream plan. The table stays until
    ``remove_intermediates``.
    """
    path = scratch_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
