"""Operator 13, vector code compression: product codes whose assignments walk a trie of parts.

Vectors are made whole numbers and cut into ``PARTS`` equal consecutive parts; each part position
has a codebook, fitted by ``ROUNDS`` rounds of assigning every part to its nearest entry and
replacing entries by the floor of their parts' mean.  Everything is whole numbers, so the result
does not depend on partitioning.

The parts of a position, sorted by their components, are the leaves of a trie whose levels are
the dimensions.  The walk goes depth first through runs of neighbouring leaves.  At each node the
squared distances to all entries, added up over the dimensions so far, are one vector; it is
computed once and taken over by every leaf below, so that parts with a common prefix of
dimensions share the work of that prefix.  A leaf takes the argmin of its vector, and adds its
components, times the number of rows that have this part, to its entry's sums.

Fitting walks the distinct parts of the whole table: one shuffle by (position, part) with the
counts added up before it, written once sorted by range, so that a task's parts are neighbours in
the trie; copies, however many, are one weighted leaf.  A round sends the codebooks out (at most
PARTS x ENTRIES entries) and gets sums per entry back, added up on the executors.  The final
codes are taken per row, from the trie of each batch's distinct parts, without a shuffle.

Defined results: rows drop whose vector is null or has null or non-finite components, and also
those whose scaled components reach 2^26 in size (squared distances would leave the exact range),
that have no components, or another number of components than the kept row of smallest id; if
that number is no multiple of ``PARTS``, zeros are added at the end.  A null id comes after all
others; rows that repeat an id are taken in the order of their components.  With fewer than
``ENTRIES`` rows the codebooks have as many entries as rows.  An empty table gives no rows; other
columns are ignored.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read, written

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
LARGEST = 2 ** 26
RUN = 512  # leaves walked at a time: a level holds at most that many distance vectors

_SUMS = "position int, entry int, dimension int, total decimal(38,0)"


def whole_numbers(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """``vectors`` with ``whole`` (array of long) instead of ``column``, without the rows that drop."""
    scaled = F.transform(column, lambda x: F.floor(x.cast("double") * SCALE))
    sound = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * SCALE) < LARGEST))
    kept = vectors.where(F.col(column).isNotNull() & (F.size(column) > 0)).where(sound)
    return kept.withColumn("whole", scaled).drop(column)


def part(whole: str | Column, position: Column, size: int) -> Column:
    return F.slice(whole, position * size + 1, F.lit(size))


def walk(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nearest entry, squared distance) of each row of ``parts``: distinct rows in lexicographic
    order, the leaves of the trie.

    A run of leaves is one subtree after the other: at each dimension the prefixes that begin a
    node are found, and a node's accumulated vector is its parent's plus the new dimension's."""
    n, dims = parts.shape
    code, error = np.zeros(n, np.int32), np.zeros(n, np.int64)
    if not n:
        return code, error
    most = int(max(np.abs(parts).max(), np.abs(entries).max()))
    kind = np.int32 if 4 * most * most * dims < 2 ** 31 else np.int64  # whichever holds every distance exactly
    by_dimension = np.ascontiguousarray(entries.T, kind)
    for lo in range(0, n, RUN):
        leaves = parts[lo:lo + RUN].astype(kind)
        differs = leaves[1:] != leaves[:-1]
        opens = np.zeros(len(leaves), bool)  # leaves at which another node of this level begins
        opens[0] = True
        node = np.zeros(len(leaves), np.int64)  # of each leaf, at the level above
        along = np.zeros((1, len(entries)), kind)
        for d in range(dims):
            opens[1:] |= differs[:, d]
            first = np.flatnonzero(opens)
            if len(first) > len(along):  # nodes with several children: each child takes the vector over
                along = along[node[first]]
            step = leaves[first, d][:, None] - by_dimension[d]
            step *= step
            along += step
            node = np.cumsum(opens) - 1
        best = along.argmin(axis=1)  # the lower index of equal ones
        code[lo:lo + RUN] = best[node]
        error[lo:lo + RUN] = along[np.arange(len(along)), best][node]
    return code, error


def _matrix(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths as rows."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    return values.reshape(len(column), -1)


def distinct_parts(rows: DataFrame, size: int, positions: int) -> DataFrame:
    """(position, part, n) in the order of the trie."""
    each = rows.select(F.explode(F.sequence(F.lit(0), F.lit(positions - 1))).alias("position"), "whole")
    counted = each.select("position", part("whole", F.col("position"), size).alias("part")).groupBy("position", "part").agg(F.count("*").alias("n"))
    return counted.repartitionByRange("position", "part").sortWithinPartitions("position", "part")


def entry_sums(parts: DataFrame, codebooks: list[np.ndarray]) -> DataFrame:
    """(position, entry, dimension, total): sums of the parts assigned to each entry; dimension -1
    has their number."""
    shipped = parts.sparkSession.sparkContext.broadcast(codebooks)

    def run(batches):
        books = shipped.value
        sums = [np.zeros((len(b), b.shape[1] + 1), object) for b in books]
        for batch in batches:
            position = batch.column("position").to_numpy()
            weight = batch.column("n").to_numpy()
            if not len(position):
                continue
            for p in np.unique(position):
                at = np.flatnonzero(position == p)
                leaves = _matrix(batch.column("part").take(pa.array(at)))
                code, _ = walk(leaves, books[p])
                order = np.argsort(code, kind="stable")
                first = np.flatnonzero(np.r_[True, code[order][1:] != code[order][:-1]])
                w = weight[at][order].astype(np.int64 if weight[at].sum() < 2 ** 36 else object)  # no product leaves its range
                rows = np.c_[w, leaves[order] * w[:, None]]
                sums[p][code[order][first]] += np.add.reduceat(rows, first, axis=0)
        out = [(p, e, d - 1, int(s[e, d])) for p, s in enumerate(sums) for e in np.flatnonzero(s[:, 0]) for d in range(s.shape[1])]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int32(), pa.int32(), pa.decimal128(38, 0)))],
                                             ["position", "entry", "dimension", "total"])

    return parts.mapInArrow(run, _SUMS).groupBy("position", "entry", "dimension").agg(F.sum("total").alias("total"))


def moved(codebooks: list[np.ndarray], sums: list[tuple[int, int, int, int]]) -> list[np.ndarray]:
    """The codebooks with each used entry at the floor of its parts' mean."""
    totals = {(p, e, d): int(t) for p, e, d, t in sums}
    out = [b.copy() for b in codebooks]
    for (p, e, d), total in totals.items():
        if d >= 0:
            out[p][e, d] = total // totals[p, e, -1]
    return out


def fit(rows: DataFrame, positions: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[np.ndarray]:
    """The codebooks of ``rows`` (vec_id, whole), one matrix of entries for each part position."""
    first = rows.select("vec_id", "whole").orderBy(F.col("vec_id").asc_nulls_last(), "whole").limit(entries).collect()
    if not first:
        return []
    start = np.array([r["whole"] for r in first], np.int64)
    books = [np.ascontiguousarray(b) for b in np.split(start, positions, axis=1)]
    parts = written(distinct_parts(rows, books[0].shape[1], positions), "parts")
    for _ in range(rounds):
        books = moved(books, [tuple(r) for r in entry_sums(parts, books).collect()])  # at most one row for each number of the codebooks
    return books


def coded(rows: DataFrame, codebooks: list[np.ndarray]) -> DataFrame:
    """vec_id, label, code, error of every row, by the trie of each batch's distinct parts."""
    shipped = rows.sparkSession.sparkContext.broadcast(codebooks)

    def run(batches):
        books = shipped.value
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _matrix(batch.column("whole"))
            codes, errors = [], np.zeros(len(vectors), np.int64)
            for parts, book in zip(np.split(vectors, len(books), axis=1), books):
                leaves, leaf = np.unique(parts, axis=0, return_inverse=True)
                code, error = walk(leaves, book)
                codes.append(code[leaf.ravel()])
                errors += error[leaf.ravel()]
            text = ["".join(f"{c:02x}" for c in row) for row in np.stack(codes, axis=1).tolist()]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(text), pa.array(errors)],
                                             ["vec_id", "label", "code", "error"])

    kinds = dict(rows.dtypes)
    return rows.select("vec_id", "label", "whole").mapInArrow(run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long")


def codebook_digest(codebooks: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(x) for b in codebooks for x in b.ravel().tolist()).encode()).hexdigest()


def compress(vectors: DataFrame, column: str = "embedding", positions: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, label, code, error, label_error, codebooks_sha256 for every row that is kept."""
    rows = whole_numbers(vectors.select("vec_id", "label", column), column)
    head = rows.orderBy(F.col("vec_id").asc_nulls_last(), "whole").select(F.size("whole").alias("n")).head()
    n = head["n"] if head else positions
    padded = -n % positions
    rows = rows.where(F.size("whole") == n)
    if padded:
        rows = rows.withColumn("whole", F.concat("whole", F.array_repeat(F.lit(0).cast("long"), padded)))
    books = fit(rows, positions, entries, rounds)
    out = written(coded(rows, books), "codes")
    # written, so the join below reads two plain shuffles and Spark can split the one of a frequent label
    totals = written(out.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of"), "label-errors")
    return (out.join(totals, out["label"].eqNullSafe(totals["of"]))
            .select("vec_id", "label", "code", "error", "label_error", F.lit(codebook_digest(books)).alias("codebooks_sha256")))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = compress(read(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding"))
    return out.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def oracle(positions: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """DuckDB SQL of :func:`op13_vector_codes`: the rounds one after the other, every distance in full."""
    steps = [f"""kept AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * {SCALE}) AS BIGINT)) AS whole
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (SELECT vec_id, label, position, whole[position * (len(whole) // {positions}) + 1 : (position + 1) * (len(whole) // {positions})] AS part
  FROM kept, range({positions}) r(position)),
ranked AS MATERIALIZED (SELECT position, part, row_number() OVER (PARTITION BY position ORDER BY vec_id) AS place FROM parts),
book0 AS MATERIALIZED (SELECT position, place - 1 AS entry, part FROM ranked WHERE place <= {entries})"""]
    for k in range(rounds + 1):
        steps.append(f"""near{k} AS MATERIALIZED (SELECT p.vec_id, p.label, p.position, p.part, min(struct_pack(
    d := CAST(list_sum(list_transform(list_zip(p.part, b.part), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT), e := b.entry)) AS best
  FROM parts p JOIN book{k} b USING (position) GROUP BY ALL)""")
        if k < rounds:
            steps.append(f"""long{k} AS (SELECT position, best.e AS entry, unnest(part) AS x, generate_subscripts(part, 1) AS d FROM near{k}),
mean{k} AS (SELECT position, entry, d, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM long{k} GROUP BY ALL),
used{k} AS (SELECT position, entry, list((s - ((s % n) + n) % n) // n ORDER BY d) AS part FROM mean{k} GROUP BY ALL),
book{k + 1} AS MATERIALIZED (SELECT b.position, b.entry, coalesce(u.part, b.part) AS part FROM book{k} b LEFT JOIN used{k} u USING (position, entry))""")
    return "WITH " + ",\n".join(steps) + f""",
codes AS (SELECT vec_id, label, string_agg(format('{{:02x}}', best.e), '' ORDER BY position) AS code, CAST(sum(best.d) AS BIGINT) AS error
  FROM near{rounds} GROUP BY vec_id, label)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(list_aggregate(part, 'string_agg', ','), ',' ORDER BY position, entry)) FROM book{rounds}) AS codebooks_sha256
FROM codes"""


ORACLE = oracle()
