"""Operator 5, near-duplicates: MinHash with tensored banding, links confirmed on full sets.

Two small collections of ``groups`` band hashes, each over ``half`` minhashes, are computed for
a document: 2 * groups * half minhashes.  A table key is a pair of one band from each
collection, so they serve groups * groups tables of 2 * half minhashes; as many independent
tables would take ``groups`` times the minhashes.  A pair of similarity s shares a table with
probability (1 - (1 - s^half)^groups)^2: 0.9996 at s = 0.85, more above.

1. Documents with equal shingle sets are one class; only classes go on, so copies cost nothing.
2. A band that only one class has cannot be half of a shared key, so a class's keys are formed
   from its shared bands alone (on unlike documents: no key at all).
3. In turns, each class is paired with classes drawn by hash in its tables of one band of the first
   collection, the next one in each turn, and of those the one met in most tables is checked: one
   check a class and turn.  Confirmed links contract components, tables that hold one component
   only are left out, and the turns go on until one finds few links (the next round is exact).  A
   large group of near copies becomes one component here.
4. A last round is exact for what is left: in tables that still hold several components, each
   class outside the table's largest one meets every class of another component.  A table of more
   than ``BLOCK_ROWS`` classes is cut into blocks, and each pair of blocks is a unit of work of its
   own.  A unit compares bands and ``SIGNATURE`` further minhashes of a byte each (made for these
   classes alone): of texts that share much but not enough, such as letters on one form, almost no
   pair passes.  It sends on no pairs but a forest, one row for each component that a passing pair
   joins to another; what the forests join is a cluster, outside which no link is left.  The classes
   of a cluster then meet with their full sets, in blocks of ``BLOCK_MEMBERS`` members, and a pair
   of blocks sends on a forest of the confirmed links.
   Before that, classes go in which too many shingles are in no other class still there: they
   cannot reach the similarity with any (an exact rule), and copies that were edited too much,
   each in its own way, would otherwise meet each other.

A pair is checked only if sizes allow the similarity and MIN_BANDS of the 2 * groups bands agree
(a true pair fails that with probability 1.4e-4 at 0.85), in the last round also if its signatures
agree as far as those of pairs of that similarity do, less ``SIGMAS`` spreads (3e-5), or if other
pairs have brought it into one cluster.  A check intersects the full sets.  There is no cap on partners: no link that the tables hold between
components is lost but by these chances.

Defined results: null and empty texts have empty sets, are linked with nothing and are kept;
rows that repeat an id or a text are of one class; a class without any id has a null
component, and a row without id is not ``kept`` by :func:`near_duplicates` (the pipeline's stage
keeps one row of each group, with or without id); an empty table gives no rows; other columns
are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bytes_np as B
from .common import by_unit, read, release, set_aside, text_of, written

WIDTH = 5
MIN_PERCENT = 85
HALF, GROUPS = 3, 9
MIN_BANDS = 4
#: Turns of drawn pairs end with one that finds less than this part of the first turn's links.
TURNS_END = 2
#: Classes of a block of the last round, and its pairs compared at a time.
BLOCK_ROWS, PAIRS = 1024, 1 << 18
#: Members of the full sets of a block of a cluster.
BLOCK_MEMBERS = 1 << 19
SIGNATURE, SIGMAS = 256, 4.0
SEED = 7

_SET = ["n_shingles", "k1", "k2"]


def _shingle_sets(text: pa.Array, width: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, distinct shingle hashes by row, their rows) in runs of bounded bytes."""
    for a, b, buf, offs in B.chunks(text):
        buf = B.LOWER[buf]
        s, e, doc = B.words(buf, offs)
        h, doc = B.shingles(B.word_hashes(buf, s, e), doc, width)
        yield (a, b, *B.distinct_by_doc(h, doc))


def _per_row(values: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, np.uint64)
    out[rows] = values
    return out.view(np.int64)


def sketch(docs: DataFrame, keys: list[str], width: int = WIDTH, half: int = HALF, groups: int = GROUPS) -> DataFrame:
    """keys, text_hash, n_shingles, two 64-bit hashes of the set (k1, k2), band hashes g0, g1, ..."""
    bands = [f"g{i}" for i in range(2 * groups)]
    rng = np.random.default_rng(SEED)
    xor = rng.integers(0, 2 ** 63, 2 * groups * half, dtype=np.uint64)
    mul = rng.integers(0, 2 ** 63, 2 * groups * half, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def run(batches):
        for batch in batches:
            rest = batch.select(batch.schema.names[:-1])
            for a, b, h, doc in _shingle_sets(batch.column(batch.num_columns - 1), width):
                n = b - a
                first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]]) if len(doc) else np.zeros(0, np.int64)
                row = doc[first]
                cols = [np.bincount(doc, minlength=n).astype(np.int64)]
                for hashed, ufunc in ((B.mix(h), np.add), (B.mix(h * np.uint64(0xA24BAED4963EE407)), np.bitwise_xor)):
                    cols.append(_per_row(ufunc.reduceat(hashed, first) if len(first) else hashed, row, n))
                for g in range(2 * groups):
                    band = np.full(len(first), g, np.uint64)
                    for j in range(g * half, (g + 1) * half):
                        if len(first):
                            band = B.mix(band * np.uint64(31) + np.minimum.reduceat((h ^ xor[j]) * mul[j], first))
                    cols.append(_per_row(band, row, n))
                yield pa.RecordBatch.from_arrays(rest.slice(a, n).columns + [pa.array(c) for c in cols],
                                                 rest.schema.names + _SET + bands)

    source = docs.select(*keys, F.xxhash64(text_of()).alias("text_hash"), "text")
    schema = source.drop("text").schema
    for c in _SET + bands:
        schema = schema.add(c, "long")
    return source.mapInArrow(run, schema)


def shingle_sets(texts: DataFrame, width: int = WIDTH) -> DataFrame:
    """(node, members): the full set of each text, sorted."""
    def run(batches):
        for batch in batches:
            for a, b, h, doc in _shingle_sets(batch.column("text"), width):
                offs = np.searchsorted(doc, np.arange(b - a + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("node").slice(a, b - a), pa.ListArray.from_arrays(pa.array(offs), pa.array(h.view(np.int64)))],
                    ["node", "members"])
    return texts.select("node", "text").mapInArrow(run, "node long, members array<long>")


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node that each node of ``edges`` (a, b) reaches.

    Each step takes the smallest label among a node, its neighbours and its label's own label;
    every step is a written table, the minimum over neighbours is combined before the shuffle,
    and only a flag reaches the driver, which drops what a step leaves behind before the next."""
    both = written(edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
                   .union(edges.select("b", "a")).distinct(), "edges")
    labels = written(both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("v"))
                     .select("node", F.least("node", "v").alias("label"), F.lit(True).alias("changed")), "labels")
    while not labels.where("changed").isEmpty():
        known = labels.select("node", "label")
        near = (both.join(known.select(F.col("node").alias("v"), F.col("label").alias("near")), "v")
                .groupBy(F.col("u").alias("node")).agg(F.min("near").alias("near")))
        jump = known.select(F.col("node").alias("label"), F.col("label").alias("jump"))
        best = F.least("label", "near", "jump")
        labels = written(known.join(near, "node").join(jump, "label")
                         .select("node", best.alias("label"), (best < F.col("label")).alias("changed")), "labels")
        release(labels.sparkSession)
    return labels.select("node", "label")


def _may_link(groups: int, percent: int, x: str, y: str) -> Column:
    """Sizes and bands of two classes of one table allow the similarity."""
    count = reduce(lambda p, q: p + q, [(F.col(f"{x}.g{i}") == F.col(f"{y}.g{i}")).cast("int") for i in range(2 * groups)])
    small, large = F.least(f"{x}.n_shingles", f"{y}.n_shingles"), F.greatest(f"{x}.n_shingles", f"{y}.n_shingles")
    return (small * 100 >= large * percent) & (count >= MIN_BANDS)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity."""
    x, y = (sets.select(F.col("node").alias(c), F.col("members").alias(f"m{c}")) for c in "ab")
    both = F.size(F.array_intersect("ma", "mb"))
    return (pairs.join(x, "a").join(y, "b").select("a", "b", both.alias("both"), (F.size("ma") + F.size("mb")).alias("total"))
            .where(F.col("both") * 100 >= (F.col("total") - F.col("both")) * percent).select("a", "b"))


def can_link(sets: DataFrame, percent: int) -> DataFrame:
    """The nodes that may reach the similarity with another node of ``sets``: a link needs at least
    that share of the smaller and of the larger set in common, so a set in which more members are
    in no other set has no link at all."""
    alone = (sets.select("node", F.explode("members").alias("member")).groupBy("member")
             .agg(F.count("*").alias("n"), F.min("node").alias("node")).where("n = 1").groupBy("node").agg(F.count("*").alias("alone")))
    size = F.size("members")
    return (sets.join(alone, "node", "left")
            .where((size - F.coalesce("alone", F.lit(0))) * 100 >= size * percent).select("node"))


def table_keys(classes: DataFrame, groups: int = GROUPS) -> DataFrame:
    """(key, i, j, node): the table keys that at least two classes share, formed from shared bands."""
    bands = classes.where("n_shingles > 0").select("node", F.posexplode(F.array(*[f"g{i}" for i in range(2 * groups)])).alias("i", "band"))
    shared = bands.groupBy("i", "band").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi").select("i", "band")
    own = bands.join(shared, ["i", "band"]).groupBy("node").agg(F.collect_list(F.struct("i", "band")).alias("bands"))
    left, right = F.filter("bands", lambda s: s["i"] < groups), F.filter("bands", lambda s: s["i"] >= groups)
    keyed = (own.select("node", left.alias("l"), right.alias("r")).select("node", "r", F.explode("l").alias("l"))
             .select("node", "l", F.explode("r").alias("r"))
             .select(F.xxhash64("l.i", "l.band", "r.i", "r.band").alias("key"), F.col("l.i").alias("i"), F.col("r.i").alias("j"), "node"))
    keyed = written(keyed, "keys")
    held = keyed.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi").select("key")
    return keyed.join(held, "key")


def link_classes(classes: DataFrame, texts: DataFrame, width: int = WIDTH, percent: int = MIN_PERCENT, groups: int = GROUPS) -> DataFrame:
    """(node, label) for the classes that are linked with another; ``texts`` has (text_hash, text)."""
    bands = [f"g{i}" for i in range(2 * groups)]
    keys = written(table_keys(classes, groups), "shared-keys")
    nodes = keys.select("node").distinct()
    full = classes.join(nodes, "node", "left_semi")
    release(classes.sparkSession)
    one_text = texts.join(full.select("text_hash", "node"), "text_hash").groupBy("node").agg(F.first("text").alias("text"))
    sets = written(shingle_sets(one_text, width), "sets")
    sketches = written(full.select("node", "n_shingles", *bands), "sketches")

    at = written(nodes.withColumn("label", F.col("node")), "labels")
    open_keys, turn = written(keys.withColumn("label", F.col("node")), "open-keys"), 0
    release(at.sparkSession)
    first = found = 0
    while found * TURNS_END >= first:  # the exact round below finds what the turns leave
        links = written(confirmed(drawn_pairs(open_keys, sketches, turn, groups, percent), sets, percent), "links")
        found = links.count()
        if not found:
            break
        first = first or found
        at = merged(at, links)
        release(at.sparkSession)
        open_keys, turn = written(still_open(open_keys, at), "open-keys"), turn + 1
        release(at.sparkSession)

    able = can_link(sets.join(open_keys.select("node").distinct(), "node", "left_semi"), percent)
    left = written(open_keys.join(able, "node"), "able-keys")
    last = sets.join(left.select("node").distinct(), "node", "left_semi")
    release(at.sparkSession)
    near = written(last_pairs(left, sketches, last, groups, percent).distinct(), "near")
    release(at.sparkSession)
    if near.isEmpty():
        return at
    clusters = components(near).select(F.col("node").alias("label"), F.col("label").alias("cluster"))
    placed = left.select("node", "label").distinct().join(clusters, "label")
    links = written(cluster_links(placed, last, percent), "links")
    release(at.sparkSession)
    return at if links.isEmpty() else merged(at, links)


def drawn_pairs(open_keys: DataFrame, sketches: DataFrame, turn: int, groups: int, percent: int) -> DataFrame:
    """Pairs (a, b) of different components, at most one for each class: in each table of the turn's
    band two classes are drawn by hash, and of those a class meets in its tables the one is taken
    that it meets in most."""
    drawn = open_keys.where(F.col("i") == turn % groups).withColumn("draw", F.xxhash64("node", "key", F.lit(turn)))
    ends = drawn.groupBy("key").agg(F.min("draw").alias("lo"), F.max("draw").alias("hi")).select("key", F.explode(F.array("lo", "hi")).alias("draw"))
    lead = drawn.join(ends, ["key", "draw"]).select("key", F.col("node").alias("lead"), F.col("label").alias("lead_label"))
    met = drawn.select("key", "node", "label").join(lead, "key").where("label != lead_label").groupBy("node", "lead").agg(F.count("*").alias("tables"))
    one = met.groupBy("node").agg(F.max_by("lead", F.struct("tables", "lead")).alias("lead"))
    return (one.join(sketches.alias("x"), F.col("x.node") == one["node"]).join(sketches.alias("y"), F.col("y.node") == one["lead"])
            .where(_may_link(groups, percent, "x", "y"))
            .select(F.least(one["node"], "lead").alias("a"), F.greatest(one["node"], "lead").alias("b")).distinct())


class Forest:
    """The components of a unit's rows and the pairs of them that joined two trees."""

    def __init__(self, labels: np.ndarray):
        self.names, self.at = np.unique(labels, return_inverse=True)
        self.root = np.arange(len(self.names))
        self.joined: list[tuple[int, int]] = []

    def of(self, rows: np.ndarray | int) -> np.ndarray:
        return self.root[self.at[rows]]

    def join(self, u: np.ndarray, v: np.ndarray) -> None:
        for p, q in np.unique(np.stack([self.of(u), self.of(v)], axis=1), axis=0):
            p, q = sorted((self.root[p], self.root[q]))
            if p != q:
                self.root[self.root == q] = p
                self.joined.append((p, q))

    def rows(self) -> pa.RecordBatch:
        pairs = self.names[np.array(self.joined, np.int64).reshape(-1, 2)]
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])


def signatures(sets: DataFrame) -> DataFrame:
    """(node, signature): a byte of each of ``SIGNATURE`` minhashes of the full set."""
    rng = np.random.default_rng(SEED + 1)
    xor = rng.integers(0, 2 ** 63, SIGNATURE, dtype=np.uint64)
    mul = rng.integers(0, 2 ** 63, SIGNATURE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def run(batches):
        for batch in batches:
            out = []
            for members in batch.column("members"):
                h = B.mix(members.values.to_numpy().view(np.uint64))
                out.append(B.mix(np.array([((h ^ x) * m).min() for x, m in zip(xor, mul)], np.uint64)).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(out, pa.binary())], ["node", "signature"])

    return sets.select("node", "members").mapInArrow(run, "node long, signature binary")


def last_pairs(keys: DataFrame, sketches: DataFrame, sets: DataFrame, groups: int, percent: int) -> DataFrame:
    """Pairs (a, b) of components that hold classes of one table that may reach the similarity, as many
    of a unit as join what such pairs join there; each pair of classes counts in the first table that
    it shares; ``keys`` has (key, i, j, node, label)."""
    most = keys.groupBy("key", "label").agg(F.count("*").alias("n")).groupBy("key").agg(F.max_by("label", F.struct("n", "label")).alias("most"), F.sum("n").alias("held"), F.max("n").alias("n"))
    blocks = {"x_blocks": F.ceil((F.col("held") - F.col("n")) / BLOCK_ROWS), "y_blocks": F.ceil(F.col("held") / BLOCK_ROWS)}
    rows = keys.join(most.where("held > n").withColumns(blocks), "key")
    own = {c: F.pmod(F.xxhash64("node"), F.col(f"{c}_blocks")) for c in "xy"}
    upto = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"{c}_blocks") - 1)).alias(c)
    rest = ["key", "i", "j", "node", "label", (F.col("label") == F.col("most")).alias("in_most")]
    x = rows.where("label != most").select(*rest, own["x"].alias("x"), upto("y"), F.lit(True).alias("asks"))
    y = rows.select(*rest, upto("x"), own["y"].alias("y"), F.lit(False).alias("asks"))
    unit = ["key", "i", "j", "x", "y"]
    bands = [f"g{k}" for k in range(2 * groups)]
    placed = x.unionByName(y).join(sketches, "node").join(signatures(sets), "node").select(*unit, "asks", "node", "label", "in_most", "n_shingles", "signature", *bands)
    share = percent / 100
    least = SIGNATURE * share - SIGMAS * np.sqrt(SIGNATURE * share * (1 - share))

    def compare(t: pa.Table) -> Iterator[pa.RecordBatch]:
        column = {c: t.column(c).to_numpy() for c in ("asks", "node", "label", "in_most", "n_shingles")}
        band = np.stack([t.column(c).to_numpy() for c in bands], axis=1)
        first = t.column("i")[0].as_py(), t.column("j")[0].as_py()
        byte = np.frombuffer(b"".join(t.column("signature").to_pylist()), np.uint8).reshape(len(band), SIGNATURE)
        to, ask = np.flatnonzero(~column["asks"]), np.flatnonzero(column["asks"])
        if not len(to):
            return
        forest = Forest(column["label"])
        step = max(1, PAIRS // len(to))
        for lo in range(0, len(ask), step):
            of = ask[lo:lo + step]
            two = lambda c: (column[c][of, None], column[c][to][None])
            (a, b), (m, n) = two("node"), two("n_shingles")
            ok = (forest.of(of)[:, None] != forest.of(to)[None]) & (column["in_most"][to][None] | (a < b)) & (np.minimum(m, n) * 100 >= np.maximum(m, n) * percent)
            agree = np.zeros(ok.shape, np.int8)
            for k in range(2 * groups):
                same = band[of, k][:, None] == band[to, k][None]
                if k in (first[0], first[1]):
                    ok &= same
                elif k < first[0] or groups <= k < first[1]:
                    ok &= ~same  # the pair meets in an earlier table
                agree += same
            i, j = np.nonzero(ok & (agree >= MIN_BANDS))
            for cut in range(0, len(i), PAIRS // SIGNATURE):
                u, v = of[i[cut:cut + PAIRS // SIGNATURE]], to[j[cut:cut + PAIRS // SIGNATURE]]
                near = (byte[u] == byte[v]).sum(axis=1) >= least
                forest.join(u[near], v[near])
        yield forest.rows()

    def run(batches):
        for t in by_unit(batches, unit):
            yield from compare(t)

    return placed.repartition(*unit).sortWithinPartitions(*unit).mapInArrow(run, "a long, b long")


def cluster_links(placed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of components that confirmed links between classes of a cluster join, as many of a
    unit as join what is linked there; ``placed`` has (node, label, cluster)."""
    rows = placed.join(sets, "node").withColumn("size", F.size("members").cast("long"))
    most = (rows.groupBy("cluster", "label").agg(F.sum("size").alias("n")).groupBy("cluster")
            .agg(F.max_by("label", F.struct("n", "label")).alias("most"), F.sum("n").alias("held"), F.max("n").alias("n")))
    blocks = {"x_blocks": F.ceil((F.col("held") - F.col("n")) / BLOCK_MEMBERS), "y_blocks": F.ceil(F.col("held") / BLOCK_MEMBERS)}
    rows = rows.join(most.where("held > n").withColumns(blocks), "cluster")
    own = {c: F.pmod(F.xxhash64("node"), F.col(f"{c}_blocks")) for c in "xy"}
    upto = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"{c}_blocks") - 1)).alias(c)
    x = rows.where("label != most").select("cluster", "label", "members", own["x"].alias("x"), upto("y"), F.lit(True).alias("asks"))
    y = rows.select("cluster", "label", "members", upto("x"), own["y"].alias("y"), F.lit(False).alias("asks"))
    unit = ["cluster", "x", "y"]

    def compare(t: pa.Table) -> pa.RecordBatch:
        asks, lists = t.column("asks").to_numpy(), t.column("members").combine_chunks()
        forest = Forest(t.column("label").to_numpy())
        offs = lists.offsets.to_numpy()
        known, member = np.unique(lists.values.to_numpy()[offs[0]:offs[-1]], return_inverse=True)
        offs = offs - offs[0]
        size, to = np.diff(offs), np.flatnonzero(~asks)
        if len(to):
            theirs = member[np.repeat(~asks, size)]
            starts = np.r_[0, np.cumsum(size[to])[:-1]]
            mine = np.zeros(len(known), bool)
            for u in np.flatnonzero(asks):
                apart = forest.of(to) != forest.of(u)
                if apart.any():
                    own = member[offs[u]:offs[u + 1]]
                    mine[own] = True
                    both = np.add.reduceat(mine[theirs], starts, dtype=np.int64)
                    mine[own] = False
                    v = to[apart & (both * 100 >= (size[u] + size[to] - both) * percent)]
                    forest.join(np.full(len(v), u), v)
        return forest.rows()

    def run(batches):
        for t in by_unit(batches, unit):
            yield compare(t)

    placed = x.unionByName(y).select(*unit, "asks", "label", "members")
    return placed.repartition(*unit).sortWithinPartitions(*unit).mapInArrow(run, "a long, b long")


def merged(at: DataFrame, links: DataFrame) -> DataFrame:
    """(node, label) after ``links`` between classes have joined their components."""
    a, b = (at.select(F.col("node").alias(c), F.col("label").alias(f"l{c}")) for c in "ab")
    edges = links.join(a, "a").join(b, "b").select(F.col("la").alias("a"), F.col("lb").alias("b")).where("a != b").distinct()
    to = components(edges).select(F.col("node").alias("label"), F.col("label").alias("to"))
    return written(at.join(to, "label", "left").select("node", F.coalesce("to", "label").alias("label")), "labels")


def still_open(keys: DataFrame, at: DataFrame) -> DataFrame:
    """The rows of tables that hold more than one component."""
    placed = keys.drop("label").join(at, "node")
    several = placed.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("key")
    return placed.join(several, "key")


def grouped(docs: DataFrame, keys: list[str], width: int = WIDTH, percent: int = MIN_PERCENT,
            half: int = HALF, groups: int = GROUPS) -> DataFrame:
    """keys, n_shingles, ``node`` (the row's class) and ``group`` (its component's smallest class);
    both are null for rows with an empty set."""
    bands = [f"g{i}" for i in range(2 * groups)]
    release(docs.sparkSession)
    rows = written(sketch(docs, keys, width, half, groups), "sketch")
    classes = written(rows.where("n_shingles > 0").groupBy(*_SET).agg(F.min("text_hash").alias("text_hash"), *[F.first(g).alias(g) for g in bands])
                      .withColumn("node", F.monotonically_increasing_id()), "classes")
    labels = link_classes(classes, docs.select(F.xxhash64(text_of()).alias("text_hash"), text_of().alias("text")), width, percent, groups)
    of = classes.join(labels, "node", "left").select(*_SET, "node", F.coalesce("label", "node").alias("group"))
    some = rows.where("n_shingles > 0").select(*keys, *_SET).join(of, _SET).select(*keys, "n_shingles", "node", "group")
    none = rows.where("n_shingles = 0").select(*keys, "n_shingles", F.lit(None).cast("long").alias("node"), F.lit(None).cast("long").alias("group"))
    return some.unionByName(none)


def near_duplicates(docs: DataFrame, width: int = WIDTH, percent: int = MIN_PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs`` (doc_id, text)."""
    rows = written(grouped(docs, ["doc_id"], width, percent), "groups")
    # written, so the join below reads two plain shuffles and Spark can split the one of a large group
    least = written(rows.where(F.col("group").isNotNull()).groupBy("group").agg(F.min("doc_id").alias("component_id")), "least")
    linked = rows.where(F.col("group").isNotNull()).join(least, "group")
    alone = rows.where(F.col("group").isNull()).withColumn("component_id", F.col("doc_id"))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    out = ["doc_id", "n_shingles", "component_id"]
    return linked.select(*out, kept.alias("kept")).unionByName(alone.select(*out, kept.alias("kept")))


def one_of_each(docs: DataFrame, width: int = WIDTH, percent: int = MIN_PERCENT) -> DataFrame:
    """``docs`` with one row left of each group: the smallest id, rows without id last."""
    docs, back = set_aside(docs, ("doc_id", "text"))
    base = written(docs.withColumn("_row", F.monotonically_increasing_id()), "rows")
    rows = written(grouped(base, ["doc_id", "_row"], width, percent).where(F.col("group").isNotNull()), "groups")
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("_row"))
    best = written(rows.groupBy("group").agg(F.min_by("_row", order).alias("best")), "best")
    dropped = rows.join(best, "group").where("_row != best").select("_row")
    return base.join(dropped, "_row", "left_anti").select(*back)


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text"))
