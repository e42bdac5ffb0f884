"""Helpers shared by the operators: reading tables, tables written in the shared folder."""
from __future__ import annotations

import gc
import pickle
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a maximal run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str = "ledgerkit-llm") -> str:
    """A folder in the one that the cluster names in ``spark.checkpoint.dir``; every executor and the
    driver reach it.  Without that setting there is no safe place, so this fails."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return f"{folder.rstrip('/')}/{name}"


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back: computed once, its lineage cut,
    and a lost executor's part is read again from the files."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files and broadcasts of results that nothing refers to any more:
    it does so when the driver collects its garbage, which jobs of many small steps seldom force."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def drop_written(spark: SparkSession) -> None:
    """Delete every table that :func:`written` left in the shared folder (after the results
    that read them have been saved)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def ship(spark: SparkSession, value: object) -> Broadcast:
    """``value`` for all tasks, with the classes of its objects, which a plain broadcast would name
    only; :func:`shipped` gives it back inside a task."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def shipped(sent: Broadcast) -> object:
    return pickle.loads(sent.value)


def text_of(col: str | Column = "text") -> Column:
    """The text, empty where null."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def set_aside(docs: DataFrame, used: tuple[str, ...]) -> tuple[DataFrame, list[Column]]:
    """``docs`` with every column but the ``used`` ones under a name that no operator has, and the
    columns that give the first names back."""
    names = {c: c if c in used else f"_kept_{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), [F.col(n).alias(c) for c, n in names.items()]


def crc32_fold(col: Column, modulus: int) -> Column:
    """Remainder of crc32(key as text); a null key counts as the empty string."""
    return F.crc32(F.coalesce(col.cast("string"), F.lit(""))) % F.lit(modulus)


def by_unit(batches: Iterator[pa.RecordBatch], unit: list[str]) -> Iterator[pa.Table]:
    """The rows of each unit of work, one table after the other, from batches sorted by its columns
    (whole numbers); only one unit is held."""
    held: list[pa.RecordBatch] = []
    now = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.stack([batch.column(c).to_numpy() for c in unit])
        starts = np.flatnonzero(np.r_[True, (key[:, 1:] != key[:, :-1]).any(axis=0)])
        for a, b in zip(starts, np.r_[starts[1:], batch.num_rows]):
            one = tuple(key[:, a])
            if one != now and held:
                yield pa.Table.from_batches(held)
                held = []
            now = one
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)
