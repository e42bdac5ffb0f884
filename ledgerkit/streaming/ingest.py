"""Incremental ingest (T1) and latest-per-company state (T2) with Structured Streaming.

A file stream over the archive folder (fixed ``binaryFile`` schema, of which only the
paths are read) with ``trigger(availableNow=True)`` processes only archives not seen
before; the stream checkpoint replaces the "part already exists" check.  A batch's
archives, monthly ones of any size too, are read by ranges of members, each range a
task.  Each micro-batch is parsed once and written as (month, archive) partitions with dynamic overwrite: a
batch that is run again replaces its own archives and no other of the same month.
The latest-record table is kept in hash buckets of the company number.  A batch reads and
rewrites only the buckets of its own companies, into an epoch folder of its own, and then
writes a pointer table (bucket -> epoch that holds it).  The newest committed pointer is the
state: a batch that is lost before it leaves the state before whole, and folders to which
neither the newest pointer nor the one before it points are removed.
"""
from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.sampling import latest_per_company
from ..plans.dataset import parse_month
from ..session import checkpoint_dir, folders, materialise, path_exists, remove
from ..sources.archives import read_archives

BINARY_FILE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()), T.StructField("content", T.BinaryType()),
])


#: Buckets of the latest-record table; a table keeps the number that it was begun with.
BUCKETS = 256


def _pointers(spark: SparkSession, out: str) -> list[int]:
    base = f"{out.rstrip('/')}/latest/pointer"
    return sorted(int(n[6:]) for n in folders(spark, base) if n.startswith("epoch=") and path_exists(spark, f"{base}/{n}/_SUCCESS"))


def _pointer(spark: SparkSession, out: str, epoch: int | None) -> tuple[int, dict[int, int]]:
    """(number of buckets, bucket -> epoch) of an epoch's pointer: one row a bucket."""
    if epoch is None:
        return BUCKETS, {}
    rows = spark.read.parquet(f"{out.rstrip('/')}/latest/pointer/epoch={epoch}").collect()
    return rows[0]["buckets"], {r["bucket"]: r["held_by"] for r in rows if r["bucket"] >= 0}


def _held(spark: SparkSession, out: str, at: dict[int, int]) -> DataFrame | None:
    base = f"{out.rstrip('/')}/latest/state"
    paths = [f"{base}/epoch={e}/bucket={b}" for b, e in sorted(at.items())]
    return spark.read.option("mergeSchema", "true").parquet(*paths) if paths else None


def read_latest(spark: SparkSession, out: str) -> DataFrame | None:
    """The latest record of each company after the newest committed batch, None before the first."""
    done = _pointers(spark, out)
    return _held(spark, out, _pointer(spark, out, done[-1])[1]) if done else None


def update_latest(new: DataFrame, out: str, epoch: int) -> None:
    """Fold a batch's records into the latest-record table (rewrites their companies' buckets).
    An epoch that is run again starts from the state before it."""
    spark, base = new.sparkSession, f"{out.rstrip('/')}/latest"
    done = [e for e in _pointers(spark, out) if e < epoch]
    buckets, at = _pointer(spark, out, done[-1] if done else None)
    bucket = F.pmod(F.xxhash64("company_number"), F.lit(buckets)).cast("int")
    touched = [r[0] for r in new.where("company_number is not null").select(bucket).distinct().collect()]  # at most one a bucket
    old = _held(spark, out, {b: at[b] for b in touched if b in at})
    rows = new if old is None else old.unionByName(new, allowMissingColumns=True)
    (latest_per_company(rows).withColumn("bucket", bucket).repartition("bucket")
     .write.mode("overwrite").partitionBy("bucket").parquet(f"{base}/state/epoch={epoch}"))
    at |= dict.fromkeys(touched, epoch)
    pointer = [(b, e, buckets) for b, e in at.items()] or [(-1, epoch, buckets)]
    (spark.createDataFrame(pointer, "bucket int, held_by int, buckets int").coalesce(1)
     .write.mode("overwrite").parquet(f"{base}/pointer/epoch={epoch}"))
    _tidy(spark, out, done[-1:] + [epoch])


def _tidy(spark: SparkSession, out: str, keep: list[int]) -> None:
    """Remove the buckets and pointers that the pointers in ``keep`` do not need."""
    base = f"{out.rstrip('/')}/latest"
    needed = {(e, b) for p in keep for b, e in _pointer(spark, out, p)[1].items()}
    for name in folders(spark, f"{base}/state"):
        epoch, held = int(name[6:]), folders(spark, f"{base}/state/{name}")
        stale = [b for b in held if b.startswith("bucket=") and (epoch, int(b[7:])) not in needed]
        if epoch < keep[-1] and len(stale) == len([b for b in held if b.startswith("bucket=")]):
            remove(spark, f"{base}/state/{name}")
        elif epoch < keep[-1]:
            for b in stale:
                remove(spark, f"{base}/state/{name}/{b}")
    for e in _pointers(spark, out):
        if e < keep[0]:
            remove(spark, f"{base}/pointer/epoch={e}")


def incremental_ingest(spark: SparkSession, src: str, out: str, name: str = "ingest", glob: str = "*.zip"):
    """T1 + T2: process new archives under ``src`` into ``out``; returns the finished query.
    Each pair of source and output has a stream checkpoint of its own."""
    own = hashlib.sha256(f"{src}\0{out}\0{glob}".encode()).hexdigest()[:16]
    ckpt = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{own}"
    stream = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
              .option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(src))

    def batch(df: DataFrame, epoch: int) -> None:
        archive = F.md5(F.substring_index("filing_id", "!", 1))
        recs = materialise(parse_month(read_archives(df.select("path"))).withColumn("archive_part", archive))
        (recs.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("month", "archive_part").parquet(f"{out}/records"))
        update_latest(recs.drop("month", "archive_part"), out, epoch)

    q = stream.writeStream.foreachBatch(batch).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    q.awaitTermination()
    return q
