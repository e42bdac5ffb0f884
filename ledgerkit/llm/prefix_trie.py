"""Operator 12, conversation prefix trie: count-min screening before exact grouping.

Every conversation is rebuilt (below), and each sequence of first turns is a node of a trie, from
the textless root.  Most nodes belong to one conversation, so they are not grouped at all:

1. A turn is its MD5; a prefix is two 64-bit hashes, each the exclusive or over its turns of a
   hash of (position, turn).  Only these move, no text.
2. The count-min sketch: ``ROWS`` arrays of counters, at a place by hash of the prefix.  A counter
   stops at two, since only one and more than one differ.  Each task sends the places it has
   counted (two bytes each, by blocks of 65,536 counters), the blocks are added up in streams, and
   what is shipped back is one bit a counter.  The arrays have four counters for each prefix, at
   most ``MAX_COUNTERS``; beyond that the screen lets more through, and the result is the same.
3. A count-min estimate is never too low: where it is one, the prefix has one member, and if its
   parent's is one too, the node is written where it is, without a shuffle.
4. Prefixes that may be shared are grouped exactly, added up before the shuffle.  A node's smallest
   member stands for it; each conversation stands for the nodes of its path from some depth on.
   That depth, one number a conversation, gives sums over subtrees as sums over members: a child
   counts at its smallest member, a leaf at its, and a turn's words at all but its smallest member.
5. Members that end at a shared node are sorted by range over all tasks, which write them as pieces
   of text; a stream of pieces is hashed, with the hash's state alone in memory.

Rebuilding: conversation c becomes the first h turns of conversation c - c % 20, then its own
turns after its first h, with h = crc32(c as text) % 4.

Defined results: turns are ordered by turn, a null turn first, then by their MD5; a null role or
text is empty; repeated rows are repeated turns; rows without conv_id belong to no conversation
and are left out; c % 20 has the sign of c; a table without a conv_id gives no rows; other
columns are ignored.  Nodes are told apart by 128 bits of hashes.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import bytes_np as B
from .common import WORD, read, text_of, written

GROUP, HEADS = 20, 4
ROWS, MAX_COUNTERS = 2, 2 ** 27
BLOCK = 1 << 16
PIECE_CHARS = 1 << 20

_KEY = ["depth", "p1", "p2"]
_UP = ["u1", "u2"]
_NO_MEMBER = hashlib.sha256(b"").hexdigest()


def rebuilt(turns: DataFrame) -> DataFrame:
    """conv_id, depth, turn_hash, words: the turns of every rebuilt conversation, and a row at depth
    0 without a turn for each conversation."""
    role, text = text_of(F.col("role").cast("string")), text_of(F.col("text").cast("string"))
    turn_hash = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    words = F.size(F.regexp_extract_all(text, F.lit(f"({WORD})"))).cast("long")
    said = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long"), "turn", turn_hash.alias("turn_hash"), words.alias("words"))
    said = said.withColumn("base", F.col("conv_id") - F.col("conv_id") % GROUP)
    # a window by (base, conv_id) is met by the one shuffle by base, which the join below uses too
    own = Window.partitionBy("base", "conv_id").orderBy(F.col("turn").asc_nulls_first(), "turn_hash")
    said = said.repartition("base").withColumn("place", F.row_number().over(own))
    said = written(said.withColumn("h", (F.crc32(F.col("conv_id").cast("string")) % HEADS)), "turns")
    head = said.where((F.col("conv_id") == F.col("base")) & (F.col("place") < HEADS)).select("base", "place", "turn_hash", "words")
    heads = head.groupBy("base").agg(F.array_sort(F.collect_list(F.struct("place", "turn_hash", "words"))).alias("heads"))  # three turns at most
    joined = said.join(heads, "base", "left").withColumn(
        "heads", F.when(F.col("h") > 0, F.slice(F.coalesce("heads", F.array().cast(heads.schema["heads"].dataType)), F.lit(1), F.greatest(F.col("h").cast("int"), F.lit(1))))
        .otherwise(F.array().cast(heads.schema["heads"].dataType)))
    after = joined.where("place > h").select("conv_id", (F.size("heads") + F.col("place") - F.col("h")).cast("long").alias("depth"), "turn_hash", "words")
    first = joined.where("place = 1")
    shared = first.select("conv_id", F.explode("heads").alias("t")).select("conv_id", F.col("t.place").cast("long").alias("depth"), "t.turn_hash", "t.words")
    root = first.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("string").alias("turn_hash"), F.lit(0).cast("long").alias("words"))
    return after.unionByName(shared).unionByName(root)


def prefixes(turns: DataFrame) -> DataFrame:
    """conv_id, depth, length, words, and the hashes of the prefix (p1, p2) and of the one above
    (u1, u2) for every rebuilt conversation and depth."""
    at = Window.partitionBy("conv_id").orderBy("depth")
    bound = {f"h{i}": F.when(F.col("depth") > 0, F.xxhash64(F.lit(i), "depth", "turn_hash")).otherwise(F.lit(0).cast("long")) for i in (1, 2)}
    rows = turns.withColumns(bound).withColumns({f"p{i}": F.bit_xor(f"h{i}").over(at) for i in (1, 2)})
    rows = rows.withColumns({f"u{i}": F.col(f"p{i}").bitwiseXOR(F.col(f"h{i}")) for i in (1, 2)})
    return rows.select("conv_id", "depth", F.max("depth").over(Window.partitionBy("conv_id")).alias("length"), "words", "p1", "p2", *_UP)


def _places(depth: np.ndarray, p1: np.ndarray, p2: np.ndarray, row: int, counters: int) -> np.ndarray:
    h = B.mix(p1.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ B.mix(p2.view(np.uint64) + np.uint64(row + 1)) ^ depth.astype(np.uint64))
    return (B.mix(h + np.uint64(row)) & np.uint64(counters - 1)).astype(np.int64)


def _columns(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(n).to_numpy(zero_copy_only=False).astype(np.int64, copy=False) for n in names]


def counters_for(n_prefixes: int) -> int:
    """Counters of each of the sketch's arrays: a power of two, four for each prefix."""
    return min(MAX_COUNTERS, max(BLOCK, 1 << (4 * n_prefixes - 1).bit_length()))


def sketch(rows: DataFrame, counters: int) -> list[np.ndarray]:
    """For each array of the count-min sketch, one bit a counter: whether it has counted two."""
    def count(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            key = _columns(batch, *_KEY)
            for r in range(ROWS):
                place = np.sort(_places(*key, r, counters))
                block = place // BLOCK
                first = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
                cut = np.split((place % BLOCK).astype(np.uint16), first[1:])
                yield pa.RecordBatch.from_arrays([pa.array(block[first] + r * (counters // BLOCK)), pa.array([c.tobytes() for c in cut], pa.binary())],
                                                 ["block", "places"])

    def add(batches):
        now, seen = None, None
        for batch in batches:
            for block, places in zip(batch.column("block").to_pylist(), batch.column("places").to_pylist()):
                if block != now:
                    if now is not None:
                        yield done(now, seen)
                    now, seen = block, np.zeros(BLOCK, np.uint8)
                seen = np.minimum(seen + np.minimum(np.bincount(np.frombuffer(places, np.uint16), minlength=BLOCK), 2), 2).astype(np.uint8)
        if now is not None:
            yield done(now, seen)

    def done(block, seen):
        return pa.RecordBatch.from_arrays([pa.array([block]), pa.array([np.packbits(seen == 2).tobytes()], pa.binary())], ["block", "bits"])

    blocks = (rows.select(*_KEY).mapInArrow(count, "block long, places binary").repartition("block").sortWithinPartitions("block")
              .mapInArrow(add, "block long, bits binary"))
    bits = [np.zeros(counters // 8, np.uint8) for _ in range(ROWS)]
    for row in blocks.toLocalIterator():  # ROWS * counters bits at most
        r, b = divmod(row["block"], counters // BLOCK)
        bits[r][b * BLOCK // 8:(b + 1) * BLOCK // 8] = np.frombuffer(row["bits"], np.uint8)
    return bits


def screened(rows: DataFrame, bits: list[np.ndarray], counters: int) -> DataFrame:
    """``rows`` with ``lone`` (the estimate proves one member) and ``up_lone`` (also of the prefix above)."""
    shipped = rows.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        tables = shipped.value
        for batch in batches:
            depth, p1, p2, u1, u2 = _columns(batch, *_KEY, *_UP)
            flags = []
            for key in ((depth, p1, p2), (np.maximum(depth - 1, 0), u1, u2)):
                many = np.ones(len(depth), bool)
                for r, table in enumerate(tables):
                    at = _places(*key, r, counters)
                    many &= (table[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)
                flags.append(~many)
            flags[1] &= depth > 0
            yield pa.RecordBatch.from_arrays(batch.columns + [pa.array(f) for f in flags], batch.schema.names + ["lone", "up_lone"])

    schema = ", ".join(f"{n} {t}" for n, t in rows.dtypes)
    return rows.mapInArrow(run, f"{schema}, lone boolean, up_lone boolean")


def _digest(conv_id: Column) -> Column:
    return F.sha2(conv_id.cast("string"), 256)


def ends_digests(ends: DataFrame) -> DataFrame:
    """depth, p1, p2, ends_sha256 of the members (conv_id) that end at each node."""
    def pieces(batches):
        """Runs of a node's members, in order, as comma-joined text of bounded length."""
        key, first, text, size = None, 0, [], 0
        out = []
        for batch in batches:
            for *at, conv in zip(*(batch.column(c).to_pylist() for c in (*_KEY, "conv_id"))):
                if at != key or size > PIECE_CHARS:
                    if key is not None:
                        out.append((*key, first, ",".join(text)))
                    key, first, text, size = at, conv, [], 0
                text.append(str(conv))
                size += len(text[-1]) + 1
            if sum(len(o[-1]) for o in out) > PIECE_CHARS or len(out) > 1000:
                yield _piece_batch(out)
                out = []
        if key is not None:
            out.append((*key, first, ",".join(text)))
        if out:
            yield _piece_batch(out)

    def _piece_batch(out):
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in list(zip(*out))[:4]), pa.array([o[4] for o in out], pa.string())], [*_KEY, "first", "piece"])

    def digest(batches):
        key, state = None, None
        for batch in batches:
            out = []
            for *at, piece in zip(*(batch.column(c).to_pylist() for c in (*_KEY, "piece"))):
                if at != key:
                    if key is not None:
                        out.append((*key, state.hexdigest()))
                    key, state = at, hashlib.sha256(piece.encode())
                else:
                    state.update(b"," + piece.encode())
            if out:
                yield _digest_batch(out)
        if key is not None:
            yield _digest_batch([(*key, state.hexdigest())])

    def _digest_batch(out):
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in list(zip(*out))[:3]), pa.array([o[3] for o in out], pa.string())], [*_KEY, "ends_sha256"])

    ordered = ends.repartitionByRange(*_KEY, "conv_id").sortWithinPartitions(*_KEY, "conv_id")
    cut = ordered.select(*_KEY, "conv_id").mapInArrow(pieces, "depth long, p1 long, p2 long, first long, piece string")
    return (cut.repartition(*_KEY).sortWithinPartitions(*_KEY, "first").select(*_KEY, "piece")
            .mapInArrow(digest, "depth long, p1 long, p2 long, ends_sha256 string"))


def trie(turns: DataFrame) -> DataFrame:
    """One row for each node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    all_rows = written(prefixes(rebuilt(turns)), "prefixes")
    counters = counters_for(all_rows.count())
    rows = written(screened(all_rows, sketch(all_rows, counters), counters), "screened")
    lone, several = rows.where("lone"), rows.where("NOT lone")

    # the smallest member of each grouped node, and the depth from which a conversation is that of its path
    found = written(several.groupBy(*_KEY).agg(F.min("conv_id").alias("conv_id"), F.max("length").alias("longest")), "smallest")
    from_found = found.select("conv_id", "depth", (F.col("depth") == F.col("longest")).alias("leaf"))
    from_lone = lone.where("NOT up_lone").select("conv_id", "depth", F.lit(True).alias("leaf"))  # its path ends in a lone node
    stands = from_found.unionByName(from_lone).groupBy("conv_id").agg(F.min("depth").alias("top"), F.max("leaf").alias("leaf"))

    never = F.col("length") + 1
    members = several.join(stands, "conv_id", "left").withColumns({"top": F.coalesce("top", never), "leaf": F.coalesce("leaf", F.lit(False))})
    below = Window.partitionBy("conv_id").orderBy(F.col("depth").desc())
    members = members.withColumn("saved", F.sum(F.when(F.col("depth") < F.col("top"), F.col("words")).otherwise(0)).over(below))
    child = (F.col("depth") < F.col("length")) & (F.col("top") <= F.col("depth") + 1)
    nodes = written(members.groupBy(*_KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.sum(child.cast("long")).alias("n_children"),
        F.sum(F.col("leaf").cast("long")).alias("n_leaves"), F.sum("saved").alias("saved_tokens"),
        F.first("u1").alias("u1"), F.first("u2").alias("u2"), F.max("up_lone").alias("up_lone")), "nodes")

    ends = ends_digests(several.where("depth = length").select(*_KEY, "conv_id"))
    exact = nodes.join(ends, _KEY, "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_NO_MEMBER)))
    ends_here = F.when(F.col("depth") == F.col("length"), _digest(F.col("conv_id"))).otherwise(F.lit(_NO_MEMBER))
    alone = lone.select(*_KEY, "conv_id", F.lit(1).cast("long").alias("n_convs"), (F.col("depth") < F.col("length")).cast("long").alias("n_children"),
                        F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"), *_UP, "up_lone", ends_here.alias("ends_sha256"))

    # a parent that is not proved lone has been grouped; its node tells its smallest member
    asks = exact.unionByName(alone.where("NOT up_lone"))
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("u1"), F.col("p2").alias("u2"), F.col("conv_id").alias("parent_conv_id"))
    told = asks.join(above, ["depth", *_UP], "left").withColumn("parent_conv_id", F.when(F.col("up_lone"), F.col("conv_id")).otherwise(F.col("parent_conv_id")))
    tails = alone.where("up_lone").withColumn("parent_conv_id", F.col("conv_id"))  # written where they are
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return told.select(*out).unionByName(tails.select(*out))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))


ORACLE = rf"""WITH RECURSIVE
bytes(b, k, v) AS (SELECT i, 0, CAST(i AS UBIGINT) FROM range(256) r(i)
  UNION ALL SELECT b, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, CAST(3988292384 AS UBIGINT)) ELSE v >> 1 END FROM bytes WHERE k < 8),
crc_table AS (SELECT list(v ORDER BY b) AS t FROM bytes WHERE k = 8),
said AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || text)) AS place FROM said),
convs AS (SELECT conv_id, conv_id - conv_id % {GROUP} AS base, CAST(xor(list_reduce(
    list_prepend(CAST(4294967295 AS UBIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS UBIGINT))),
    lambda a, c: xor(a >> 8, t[CAST((xor(a, c) & 255) AS BIGINT) + 1])), CAST(4294967295 AS UBIGINT)) % {HEADS} AS BIGINT) AS h
  FROM (SELECT DISTINCT conv_id FROM said), crc_table),
heads AS (SELECT c.conv_id, p.place, p.role, p.text FROM convs c JOIN placed p ON p.conv_id = c.base AND p.place <= c.h),
rebuilt AS (
  SELECT conv_id, place AS depth, role, text FROM heads
  UNION ALL
  SELECT p.conv_id, p.place - c.h + coalesce(n, 0), p.role, p.text FROM placed p JOIN convs c USING (conv_id)
    LEFT JOIN (SELECT conv_id, count(*) AS n FROM heads GROUP BY conv_id) USING (conv_id) WHERE p.place > c.h),
lengths AS (SELECT conv_id, coalesce(max(depth), 0) AS n FROM convs LEFT JOIN rebuilt USING (conv_id) GROUP BY conv_id),
paths AS MATERIALIZED (
  SELECT conv_id, depth, sha256(string_agg(sha256(length(role) || ':' || role || text), '') OVER (PARTITION BY conv_id ORDER BY depth)) AS node,
    len(regexp_extract_all(text, '{WORD}')) AS words FROM rebuilt
  UNION ALL SELECT conv_id, 0, '', 0 FROM convs),
members AS (SELECT p.*, lag(node) OVER (PARTITION BY p.conv_id ORDER BY depth) AS up, l.n AS length FROM paths p JOIN lengths l USING (conv_id)),
nodes AS MATERIALIZED (SELECT depth, node, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
    coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (depth = length), '') AS ends FROM members GROUP BY depth, node),
own AS MATERIALIZED (SELECT n.*, (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND c.up = n.node) AS n_children FROM nodes n),
-- every member of a node has the node's path above it: subtrees by the smallest member's path
subtree AS (SELECT m.depth, m.node, count(*) FILTER (o.n_children = 0) AS n_leaves, sum((o.n_convs - 1) * o.words) AS saved
  FROM own o JOIN members m ON m.conv_id = o.conv_id AND m.depth <= o.depth GROUP BY m.depth, m.node)
SELECT o.conv_id, CAST(o.depth AS BIGINT) AS depth, u.conv_id AS parent_conv_id, o.n_convs, o.n_children, s.n_leaves,
  CAST(s.saved AS BIGINT) AS saved_tokens, sha256(o.ends) AS ends_sha256
FROM own o JOIN subtree s USING (depth, node) LEFT JOIN nodes u ON u.depth = o.depth - 1 AND u.node = o.up"""
