"""Session helpers: a local session for tests/bench, and the shared checkpoint folder."""
from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Filings can be megabytes each: a session that parses them keeps its Arrow batches small
# (spark.sql.execution.arrow.maxRecordsPerBatch, set here and never by an operator).
ARROW_BATCH_ROWS = 64


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "ledgerkit") -> SparkSession:
    """Local session used by tests and bench.py (a cluster brings its own session)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_BATCH_ROWS))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    sc = spark.sparkContext
    if not spark.conf.get("spark.checkpoint.dir", None) and not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerkit-ckpt-"))  # one machine: its own disk is shared
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, or the one the
    session was given with ``setCheckpointDir``.  There is no fallback to a machine's own disk."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        given = spark.sparkContext._jsc.sc().getCheckpointDir()
        d = given.get() if given.isDefined() else None
    if not d:
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return d


def materialise(df):
    """Cut lineage with a written table in the shared checkpoint folder.

    Used where one derived table feeds many branches of a plan (benchmark pools,
    parsed filings read as two tables), so the upstream work runs once.  The table
    is computed in a single job (a reliable ``checkpoint()`` without a persist would
    compute it twice) and re-read as Parquet, so later scans prune columns and a
    lost executor re-reads files instead of recomputing the chain."""
    import uuid
    path = f"{_tables(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def _tables(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/ledgerkit-tables/{spark.sparkContext.applicationId}"


def drop_materialised(spark: SparkSession) -> None:
    """Delete the tables that :func:`materialise` wrote in this application, once the results
    that read them have been saved."""
    remove(spark, _tables(spark))


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the library's own."""
    fs, p = _path(spark, path)
    fs.delete(p, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder, none where it does not exist (metadata only)."""
    fs, p = _path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []
