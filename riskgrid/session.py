"""Session construction and shared-storage helpers.

Every operator in the package is a ``DataFrame -> DataFrame`` function; the
session is only built here (tests, bench, entry points) and the checkpoint
folder is read from the session so that a cluster's shared folder wins.
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # a broadcast side must be proven small; 64 MB is the ceiling for the
    # planner's own choice and for AQE's run-time choice (measured size),
    # explicit hints go through ``checked_broadcast``
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    # files of checkpoint() calls go with their DataFrames; hand-over tables are
    # deleted by ``drop_table`` and, what is left, when the application ends
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the package defaults.

    On a cluster ``master`` is left to spark-submit; locally it defaults to
    ``local[$BENCH_CPUS]`` or ``local[8]``.
    """
    builder = SparkSession.builder.appName("riskgrid")
    if master is None and not os.environ.get("SPARK_MASTER"):
        master = f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there and it is used as is.  Only when the
    setting is absent (local tests) is a fresh scratch folder created.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    current = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not current:
        if not (spark.sparkContext.master + "[").startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="riskgrid-ckpt-", dir="/tmp")
    spark.sparkContext.setCheckpointDir(current)
    return spark.sparkContext.getCheckpointDir() or current


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


_ENDS: set[str] = set()  # applications whose tables are deleted at the end


def _drop_all(spark: SparkSession, path: str) -> None:
    try:
        drop_table(spark, path)
    except Exception:  # the JVM has ended before: the folder stays, named after the application
        pass


def table_folder(spark: SparkSession) -> str:
    """This application's folder of hand-over tables, deleted when the driver ends."""
    app = spark.sparkContext.applicationId
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{app}"
    if app not in _ENDS:
        _ENDS.add(app)
        atexit.register(_drop_all, spark, path)
    return path


def write_lineage(df) -> str:
    """Write ``df`` as a Parquet table under the shared checkpoint folder and
    return its path (see ``cut_lineage``)."""
    path = f"{table_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return path


def drop_table(spark: SparkSession, path: str) -> None:
    """Delete a hand-over table that nothing reads any more.  Only paths below the
    checkpoint folder are deleted."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    if not path.startswith(f"{root}/tables/"):
        raise ValueError(f"not a hand-over table: {path}")
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def cut_lineage(df):
    """Write ``df`` as a Parquet table under the shared checkpoint folder and
    return the re-read table.

    One job (a reliable ``checkpoint()`` would evaluate its input twice);
    later plans start from the written files, so a lost executor costs a
    re-read, not a re-run of the upstream, and plan-time sampling jobs stop
    repeating it.  Never a machine-local folder: the path is the one the
    session names in ``spark.checkpoint.dir``.
    """
    return df.sparkSession.read.parquet(write_lineage(df))


# rows a hinted broadcast side may hold (narrow parameter rows, a few MB)
BROADCAST_MAX_ROWS = 100_000


def checked_broadcast(df, bound_rows: int | None):
    """Broadcast hint only behind a proven size bound.

    ``bound_rows`` is an upper bound on the rows of ``df`` that follows from
    the query parameters (features, buckets, months, replicates).  Within
    ``BROADCAST_MAX_ROWS`` the side is hinted; when the row count depends on
    the data (one row per user group) pass None: no hint is given, AQE
    measures the materialised side at run time and broadcasts it only below
    ``spark.sql.adaptive.autoBroadcastJoinThreshold``, else keeps the
    shuffled join.
    """
    from pyspark.sql import functions as F
    if bound_rows is not None and int(bound_rows) <= BROADCAST_MAX_ROWS:
        return F.broadcast(df)
    return df


def counted_broadcast(df):
    """``df`` written, counted and hinted for broadcast if it is small.

    For a table with a row per user group that large tables are joined with on the group:
    without the hint all rows of a group would meet, and be sorted, in one task.
    """
    df = cut_lineage(df)
    return checked_broadcast(df, df.count())


_STAGES: dict[tuple, str] = {}


def stage_table(spark: SparkSession, name: str, inputs: str, build):
    """A hand-over table written once per application and input folder.

    The reference runs as steps that exchange Parquet files (cleaned split,
    prepared features, scored sets); ``stage_table`` is that exchange: the
    first query that needs stage ``name`` over ``inputs`` runs ``build()`` and
    writes it under the shared checkpoint folder, later queries of the same
    application read the files.  Inputs are immutable, so the table is valid
    for the life of the application; a lost executor re-reads files instead
    of re-running the stage.
    """
    key = (spark.sparkContext.applicationId, name, inputs.rstrip("/"))
    path = _STAGES.get(key)
    if path is None:
        path = write_lineage(build())
        _STAGES[key] = path
    return spark.read.parquet(path)
