"""Operator 11, embedding near-dedup: randomised-rotation binary codes with stored correction factors.

A unit vector o is turned by a random rotation; its code is the signs of the turned components,
and f = <signs / sqrt(P), turned o> is stored beside it.  For another vector q, turned alike,
<signs / sqrt(P), turned q> / f is an unbiased estimate of <o, q> whose error has a known spread,
sqrt((1 - f^2) / f^2 * (1 - <o, q>^2) / (P - 1)).  The turned q is rounded at random to ``QUERY_BITS``
bits, so that the product is a few AND and bit counts on whole words.  A pair is recomputed exactly,
in double precision, if the upper confidence bound (``SIGMAS`` spreads) reaches the least cosine;
other pairs are settled by their codes.  Rotations are three rounds of random signs and a
Walsh-Hadamard transform on P >= 64 components, P a power of two.

Which pairs are compared: further rotations of the same kind give each vector a place, the largest
component with its sign; ``k`` places make the key of a table.  ``k`` grows with the logarithm of the
number of vectors, so that a table's groups stay about as large as they are, and the number of tables
follows from the chance that two vectors of exactly the least cosine share a place (simulated for
that number of components) such that at least ``RECALL`` of such pairs share a key; nearer pairs more.

1. Equal vectors are one class with a weight; only classes go on.
2. A group of more than ``GROUP_ROWS`` classes is cut into blocks by hash, and each pair of blocks is
   a unit of work of its own, so no group meets in one task.  A unit sends back, for each class, how
   many rows it is linked with and one member of its local component: never pairs.
3. A pair that shares keys of several tables counts in the first of them.

Defined results: a vector that is null, empty, zero or has null or non-finite components has no links
and is a component of its own; vectors of different lengths are not linked; rows that repeat a vector
are linked with each other; a null id counts as a row, is never a component's id while another is
there, and is not kept; an empty table gives no rows; other columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read, written
from .neardup import components

MIN_COSINE = 0.9
RECALL = 0.99
QUERY_BITS, SIGMAS = 6, 4.0
GROUP_AIM = 1024  # vectors that unlike vectors would put in one group, at most
GROUP_ROWS = 2048  # classes of a block
PAIRS = 1 << 18  # compared at a time
SEED = 11

_HASHED = "node long, n long, vector array<{kind}>, keys array<long>, code binary, factor double"


def padded_size(dims: int) -> int:
    return max(64, 1 << (dims - 1).bit_length())


def rotated(x: np.ndarray, which: int) -> np.ndarray:
    """Rows of ``x``, filled up with zeros, after rotation number ``which``."""
    size = padded_size(x.shape[1])
    signs = np.random.default_rng([SEED, size, which]).choice([-1.0, 1.0], (3, size))
    y = np.zeros((len(x), size))
    y[:, :x.shape[1]] = x
    for s in signs:
        y = y * s
        step = 1
        while step < size:
            y = y.reshape(len(x), -1, 2, step)
            y = np.stack((y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]), axis=2)
            step *= 2
        y = y.reshape(len(x), size) / np.sqrt(size)
    return y


def place(turned: np.ndarray) -> np.ndarray:
    """The largest component with its sign, as a number below twice the number of components."""
    at = np.abs(turned).argmax(axis=1)
    return at * 2 + (turned[np.arange(len(turned)), at] < 0)


def shape(n: int, dims: int, least: float = MIN_COSINE, recall: float = RECALL) -> tuple[int, int]:
    """(places of a key, tables) for ``n`` vectors of ``dims`` components."""
    size = padded_size(dims)
    rng = np.random.default_rng(SEED)
    x, noise = (rng.standard_normal((max(4000, 2 ** 21 // size), size)) for _ in range(2))
    x /= np.linalg.norm(x, axis=1)[:, None]
    noise -= (noise * x).sum(1)[:, None] * x
    noise /= np.linalg.norm(noise, axis=1)[:, None]
    chance = float((place(x) == place(least * x + np.sqrt(1 - least ** 2) * noise)).mean())
    k = max(1, int(np.ceil(np.log(max(n / GROUP_AIM, 1)) / np.log(2 * size))))
    return k, int(np.ceil(np.log(1 - recall) / np.log(1 - chance ** k)))


def unit_vectors(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1)[:, None]
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def table_keys(unit: np.ndarray, k: int, tables: int) -> np.ndarray:
    """A key of each table for each row."""
    size = 2 * padded_size(unit.shape[1])
    keys = np.full((len(unit), tables), unit.shape[1], np.int64)
    for t in range(tables):
        for i in range(k):
            keys[:, t] = keys[:, t] * size + place(rotated(unit, 1 + t * k + i))
    return keys


def codes(turned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(signs as whole words, correction factor) of each turned row."""
    words = np.packbits(turned > 0, axis=1).view(np.uint64)
    return words, np.abs(turned).sum(axis=1) / np.sqrt(turned.shape[1])


class _Queries:
    """Turned vectors rounded to whole numbers, as planes of bits."""

    def __init__(self, turned: np.ndarray):
        size = turned.shape[1]
        dither = np.random.default_rng([SEED, size]).random(size)
        self.low = turned.min(axis=1)
        self.step = np.maximum(turned.max(axis=1) - self.low, 1e-300) / (2 ** QUERY_BITS - 1)
        whole = np.clip(np.floor((turned - self.low[:, None]) / self.step[:, None] + dither), 0, 2 ** QUERY_BITS - 1).astype(np.uint8)
        self.planes = [np.packbits(whole >> b & 1, axis=1).view(np.uint64) for b in range(QUERY_BITS)]
        self.total, self.size = turned.sum(axis=1), size

    def may_link(self, a: int, b: int, code: np.ndarray, ones: np.ndarray, factor: np.ndarray, least: float) -> np.ndarray:
        """Whether the bound of each pair of queries a to b and all codes reaches ``least``."""
        shared = np.zeros((b - a, len(code)), np.int32)
        for bit, plane in enumerate(self.planes):
            for w in range(code.shape[1]):
                shared += np.bitwise_count(plane[a:b, None, w] & code[None, :, w]).astype(np.int32) << bit
        step, low = self.step[a:b, None], self.low[a:b, None]
        estimate = (2 * (step * shared + low * ones) - self.total[a:b, None]) / np.sqrt(self.size) / factor
        spread = np.sqrt((1 - factor ** 2) / factor ** 2 * (1 - least ** 2) / (self.size - 1) + (step / 2 / factor) ** 2)
        return estimate + SIGMAS * spread >= least


def linked_pairs(vectors: np.ndarray, code: np.ndarray, factor: np.ndarray, keys: np.ndarray, table: int,
                 left: np.ndarray, right: np.ndarray | None, least: float) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(rows, other rows, pairs recomputed) of the linked pairs of ``left`` and ``right`` (None: of
    ``left`` among themselves) that share no key of an earlier table."""
    unit = unit_vectors(vectors)
    asks = _Queries(rotated(unit[left], 0))
    to = left if right is None else right
    others, factors = code[to], factor[to]
    ones = np.bitwise_count(others).sum(axis=1).astype(np.int64)
    rows = max(1, PAIRS // len(to))
    for a in range(0, len(left), rows):
        b = min(a + rows, len(left))
        i, j = np.nonzero(asks.may_link(a, b, others, ones, factors, least))
        i += a
        if right is None:
            i, j = i[i < j], j[i < j]
        i, j = left[i], to[j]
        new = np.ones(len(i), bool)
        for t in range(table):
            new &= keys[i, t] != keys[j, t]
        i, j = i[new], j[new]
        for lo in range(0, len(i), PAIRS // 16):
            x, y = i[lo:lo + PAIRS // 16], j[lo:lo + PAIRS // 16]
            near = np.einsum("ij,ij->i", unit[x], unit[y]) >= least
            yield x[near], y[near], len(x)


def local_labels(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of ``n`` rows the first row that it reaches over the pairs."""
    label = np.arange(n)
    while True:
        low = label.copy()
        np.minimum.at(low, i, label[j])
        np.minimum.at(low, j, label[i])
        low = low[low]
        if (low == label).all():
            return label
        label = low


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def hashed(classes: DataFrame, k: int, tables: int) -> DataFrame:
    """node, n, vector, a key of each table, code and correction factor of each class."""
    def run(batches):
        for batch in batches:
            column = batch.column("vector")
            size = column.value_lengths().to_numpy(zero_copy_only=False)
            for dims in np.unique(size):
                part = batch.take(pa.array(np.flatnonzero(size == dims)))
                unit = unit_vectors(_matrix(part.column("vector")))
                keys = table_keys(unit, k, tables)
                words, factor = codes(rotated(unit, 0))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1, dtype=np.int32) * tables), pa.array(keys.ravel())),
                     pa.array([w.tobytes() for w in words], pa.binary()), pa.array(factor)], [*part.schema.names, "keys", "code", "factor"])

    kind = classes.schema["vector"].dataType.elementType.simpleString()
    return classes.select("node", "n", "vector").mapInArrow(run, _HASHED.format(kind=kind))


def work_units(rows: DataFrame) -> DataFrame:
    """(place, key, lo, hi, block, node): the units of work that each class takes part in."""
    keyed = rows.select("node", F.posexplode("keys").alias("place", "key"))
    held = keyed.groupBy("place", "key").agg(F.count("*").alias("held")).where("held > 1")
    blocks = F.ceil(F.col("held") / GROUP_ROWS)
    cut = keyed.join(held, ["place", "key"]).withColumn("block", F.pmod(F.xxhash64("node"), blocks))
    each = cut.select("place", "key", "block", "node", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("other"))
    return each.select("place", "key", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "node")


def links(rows: DataFrame, least: float = MIN_COSINE) -> DataFrame:
    """node, n_links (rows of other classes linked with it), label (a class it reaches), n_exact
    (pairs recomputed with it first): a row for each unit of work in which a class has links."""
    unit = ["place", "key", "lo", "hi"]
    rest = ["block", "node", "n", "vector", "keys", "code", "factor"]

    def compare(table: pa.Table) -> pa.RecordBatch | None:
        table = table.combine_chunks()
        node, n, block = (table.column(c).to_numpy() for c in ("node", "n", "block"))
        lo, hi, at = (table.column(c)[0].as_py() for c in ("lo", "hi", "place"))
        vectors, keys = _matrix(table.column("vector").chunk(0)), np.stack(table.column("keys").to_numpy())
        code = np.frombuffer(b"".join(table.column("code").to_pylist()), np.uint64).reshape(len(node), -1)
        left, right = (np.arange(len(node)), None) if lo == hi else (np.flatnonzero(block == lo), np.flatnonzero(block == hi))
        if not len(left) or (right is not None and not len(right)):
            return None
        count, label = np.zeros(len(node), np.int64), np.arange(len(node))
        for i, j, _ in linked_pairs(vectors, code, table.column("factor").to_numpy(), keys, at, left, right, least):
            np.add.at(count, i, n[j])
            np.add.at(count, j, n[i])
            a, b = np.unique(np.c_[label[i], label[j]], axis=0).T  # pairs of what is joined so far
            label = local_labels(len(node), a, b)[label]
        some = np.flatnonzero(count)
        if len(some):
            return pa.RecordBatch.from_arrays([pa.array(node[some]), pa.array(count[some]), pa.array(node[label[some]])], ["node", "n_links", "label"])

    def run(batches):
        held: list[pa.RecordBatch] = []  # of the unit that may go on
        now = None
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(c).to_numpy() for c in unit])
            starts = np.flatnonzero(np.r_[True, (key[:, 1:] != key[:, :-1]).any(axis=0)])
            for a, b in zip(starts, np.r_[starts[1:], batch.num_rows]):
                one = tuple(key[:, a])
                if one != now and held:
                    out = compare(pa.Table.from_batches(held))
                    if out is not None:
                        yield out
                    held = []
                now = one
                held.append(batch.slice(a, b - a))
        if held:
            out = compare(pa.Table.from_batches(held))
            if out is not None:
                yield out

    placed = work_units(rows).join(rows, "node").select(*unit, *rest)
    return placed.repartition(*unit).sortWithinPartitions(*unit).mapInArrow(run, "node long, n_links long, label long")


def near_duplicates(vectors: DataFrame, column: str = "embedding", least: float = MIN_COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row."""
    rows = vectors.select("vec_id", F.col(column).alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0)
    rows = rows.withColumn("sound", F.coalesce(finite, F.lit(False)))
    rows = rows.withColumns({f"k{i}": F.when(F.col("sound"), F.xxhash64(F.lit(i), F.size("vector"), "vector")) for i in (1, 2)})
    classes = written(rows.where("sound").groupBy("k1", "k2").agg(F.count("*").alias("n"), F.min("vec_id").alias("least"), F.first("vector").alias("vector"))
                      .withColumn("node", F.monotonically_increasing_id()), "vector-classes")
    n, dims = classes.agg(F.count("*"), F.max(F.size("vector"))).head()
    coded = written(hashed(classes, *shape(n, dims or 1, least)), "vector-codes")
    found = written(links(coded, least), "vector-links")
    count = found.groupBy("node").agg(F.sum("n_links").alias("others"))
    reach = components(found.where("node != label").select(F.col("node").alias("a"), F.col("label").alias("b")).distinct())
    known = written(classes.select("k1", "k2", "node", "n", "least").join(count, "node", "left").join(reach, "node", "left")
                    .select("k1", "k2", "least", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("label", "node").alias("label")), "vector-labels")
    smallest = written(known.groupBy("label").agg(F.min("least").alias("component_id")), "vector-least")
    of = written(known.join(smallest, "label").select("k1", "k2", "n_links", "component_id"), "vector-components")
    linked = rows.where("sound").select("vec_id", "k1", "k2").join(of, ["k1", "k2"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("NOT sound").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    return linked.unionByName(alone).withColumn("kept", kept)


def op11_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
