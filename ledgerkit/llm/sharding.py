"""Operator 3, sharding: fixed virtual slots and a versioned slot-to-shard map.

A record's key is hashed into one of a fixed number of virtual slots; the slot never
changes.  Which shard holds a slot is written in a map table with a version.  Rebalancing
adds up the bytes of every slot (one map-side combined aggregation, at most ``n_slots`` rows)
and edits the map by moving or swapping whole slots between the fullest and the emptiest
shard, so few slots move and every other record stays where it is.

The map of a table is kept in the shared folder, one folder for each version.  A run begins with
the newest version (the dealt one, 0, where there is none) and writes the next one only if it
edits a slot, so a table that has not grown keeps its version.  :func:`map_path` names the map by
job and input folder: a table that grows is to stay in its folder, or to be given its map's path.

Defined results: a null text has no bytes (size 1, crc32 0); a row without an id is hashed by
its text; repeated rows each get a place of their own; an empty table gives no rows and the
unedited map; slots of shards that are no more go to the emptiest ones, largest first; a stored
map with another number of slots is refused; columns of the input are kept, the operator's own columns win over columns of
the same name.
"""
from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read, shared_folder, text_of, written

N_SLOTS = 4096
N_SHARDS = 16
#: Editing stops when the fullest and emptiest shard differ by less than this share of the mean.
TOLERANCE = 0.001
MAP_SCHEMA = "version int, virtual_slot int, shard int"


def size_of(text: str = "text") -> Column:
    """UTF-8 bytes of the text plus 1."""
    return (F.octet_length(text_of(text)) + 1).cast("long")


def virtual_slot(key: str = "doc_id", text: str = "text", n_slots: int = N_SLOTS) -> Column:
    """The slot of a record: a hash of its key, of its text where it has no key."""
    h = F.when(F.col(key).isNull(), F.xxhash64(text_of(text))).otherwise(F.xxhash64(F.col(key)))
    return F.pmod(h, F.lit(n_slots)).cast("int")


def first_map(n_shards: int = N_SHARDS, n_slots: int = N_SLOTS) -> np.ndarray:
    """Version 0: slots dealt out in turn, before any byte has been seen."""
    return np.arange(n_slots) % n_shards


def slot_totals(slotted: DataFrame, n_slots: int = N_SLOTS) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, rows) of each slot; at most ``n_slots`` aggregated rows reach the driver."""
    size, rows = np.zeros(n_slots, np.int64), np.zeros(n_slots, np.int64)
    for r in slotted.groupBy("virtual_slot").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect():
        size[r["virtual_slot"]], rows[r["virtual_slot"]] = r["b"], r["n"]
    return size, rows


def rebalance(shard_of: np.ndarray, size: np.ndarray, n_shards: int, tolerance: float = TOLERANCE) -> np.ndarray:
    """The map edited until no move of a slot, and no swap of two, between the fullest and the
    emptiest shard brings them nearer.  Each edit lowers the sum of squared loads, so it ends."""
    shard_of = shard_of.copy()
    kept = shard_of < n_shards
    load = np.bincount(shard_of[kept], weights=size[kept], minlength=n_shards).astype(np.int64)
    for a in sorted(np.flatnonzero(~kept), key=lambda a: -size[a]):
        shard_of[a] = load.argmin()
        load[shard_of[a]] += size[a]
    while True:
        full, empty = int(load.argmax()), int(load.argmin())
        gap = int(load[full] - load[empty])
        if gap <= tolerance * load.mean():
            return shard_of
        mine, theirs = np.flatnonzero((shard_of == full) & (size > 0)), np.flatnonzero(shard_of == empty)
        lighter = theirs[np.argsort(size[theirs], kind="stable")]
        other = np.r_[0, size[lighter]]
        # for each slot of the full shard, the slot (or none) whose exchange halves the gap best
        want = size[mine] - gap / 2
        at = np.clip(np.searchsorted(other, want), 1, max(1, len(other) - 1)) if len(other) > 1 else np.zeros(len(mine), int)
        best = min(((abs(size[a] - other[j] - gap / 2), int(a), int(j)) for a, k in zip(mine, at) for j in {0, int(k), int(k) - 1} if 0 <= j < len(other) and 0 < size[a] - other[j] < gap), default=None)
        if best is None:
            return shard_of
        _, a, j = best
        moved = int(size[a] - other[j])
        shard_of[a] = empty
        if j:
            shard_of[lighter[j - 1]] = full
        load[full] -= moved
        load[empty] += moved


def save_map(spark: SparkSession, shard_of: np.ndarray, version: int, path: str) -> None:
    """Write one version of the map into the map table at ``path``; a version that is there is replaced."""
    rows = [(i, int(s)) for i, s in enumerate(shard_of)]
    (spark.createDataFrame(rows, "virtual_slot int, shard int").coalesce(1)
     .write.mode("overwrite").parquet(f"{path}/version={version}"))


def load_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One version of the map table, the newest by default."""
    table = spark.read.schema(MAP_SCHEMA).parquet(path).select("version", "virtual_slot", "shard")
    if version is None:
        version = table.agg(F.max("version")).first()[0]
    return table.where(F.col("version") == version)


def map_path(spark: SparkSession, job: str, sf_dir: str) -> str:
    """Where the map of a job over the tables in ``sf_dir`` is kept."""
    own = hashlib.md5(sf_dir.rstrip("/").encode()).hexdigest()
    return f"{shared_folder(spark, 'ledgerkit-shard-maps')}/{job}-{own}"


def newest_map(spark: SparkSession, path: str, n_slots: int = N_SLOTS) -> tuple[int, np.ndarray] | None:
    """(version, shard of each slot) of the newest stored map; ``n_slots`` rows reach the driver."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return None
    rows = load_map(spark, path).orderBy("virtual_slot").collect()
    if not rows:  # the first version was never written to its end
        return None
    if [r["virtual_slot"] for r in rows] != list(range(n_slots)):
        raise ValueError(f"the map at {path} has {len(rows)} rows, not one for each of {n_slots} slots")
    return rows[0]["version"], np.array([r["shard"] for r in rows])


def assign(slotted: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Adds shard and version.  The map is broadcast: one row per virtual slot, a fixed number."""
    return slotted.drop("shard", "version").join(F.broadcast(slot_map), "virtual_slot", "left")


def shard(docs: DataFrame, n_shards: int = N_SHARDS, n_slots: int = N_SLOTS, map_path: str | None = None) -> DataFrame:
    """``docs`` with size, virtual_slot, shard and version of the map.  One pass adds up the slots,
    one assigns; records are not shuffled.  With ``map_path`` the map stored there is edited and the
    edited one stored; without, the dealt one is edited and nothing stored."""
    slotted = docs.drop("size", "virtual_slot").withColumns(
        {"size": size_of(), "virtual_slot": virtual_slot(n_slots=n_slots)})
    size, _ = slot_totals(slotted.select("virtual_slot", "size"), n_slots)
    version, shard_of = _edited(docs.sparkSession, size, n_shards, n_slots, map_path)
    rows = [(version, i, int(s)) for i, s in enumerate(shard_of)]
    return assign(slotted, docs.sparkSession.createDataFrame(rows, MAP_SCHEMA))


def _edited(spark: SparkSession, size: np.ndarray, n_shards: int, n_slots: int, map_path: str | None) -> tuple[int, np.ndarray]:
    """(version, map) after the edits; a version is added only where they change a slot."""
    stored = newest_map(spark, map_path, n_slots) if map_path else None
    version, before = stored or (0, first_map(n_shards, n_slots))
    if map_path and not stored:
        save_map(spark, before, version, map_path)
    after = rebalance(before, size, n_shards)
    if (after != before).any():
        version += 1
        if map_path:
            save_map(spark, after, version, map_path)
    return version, after


def placed(docs: DataFrame, n_shards: int = N_SHARDS, n_slots: int = N_SLOTS, map_path: str | None = None) -> DataFrame:
    """Every record's shard and its place in the shard, gapless from 0.

    A shard is never sorted as a whole: its slots follow one another in a fixed order, so a
    place is the rows of the slots before plus the row's rank in its own slot."""
    spark = docs.sparkSession
    narrow = written(docs.select(
        "doc_id", size_of().alias("size"), F.crc32(text_of()).alias("text_crc32"),
        virtual_slot(n_slots=n_slots).alias("virtual_slot")), "slotted")
    size, rows = slot_totals(narrow, n_slots)
    version, shard_of = _edited(spark, size, n_shards, n_slots, map_path)
    before = np.zeros(n_slots, np.int64)
    for s in range(n_shards):
        own = np.flatnonzero(shard_of == s)
        before[own] = np.r_[0, np.cumsum(rows[own])[:-1]] if len(own) else 0
    start = spark.createDataFrame([(version, i, int(s), int(b)) for i, (s, b) in enumerate(zip(shard_of, before))],
                                  MAP_SCHEMA + ", before long")
    rank = F.row_number().over(Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size"))
    return assign(narrow.withColumn("rank", rank.cast("long")), start).withColumn("slot", F.col("before") + F.col("rank") - 1)


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Law ``bytes``: the shards' sizes are near equal."""
    return placed(read(spark, sf_dir, "documents"), map_path=map_path(spark, "op3", sf_dir)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", F.col("version").alias("map_version"))
