"""Operators 11 to 13 against plain versions of their contracts."""
import hashlib
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerkit.llm import embedding_dedup as dedup
from ledgerkit.llm import prefix_trie, vector_codes

VECTORS = "vec_id long, embedding array<double>, label int"


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is None, str(type(x)), x) for x in r))


# --- operator 11 -----------------------------------------------------------------------------

def _links(rows):
    """{position: (links, smallest id reached)} by comparing all pairs."""
    sound = [i for i, (_, v) in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    near = {i: set() for i in range(len(rows))}
    for i in sound:
        for j in sound:
            a, b = rows[i][1], rows[j][1]
            if i != j and len(a) == len(b):
                a, b = (np.array(v) / max(map(abs, v)) for v in (a, b))
                if a @ b / np.sqrt(a @ a) / np.sqrt(b @ b) >= 0.9:
                    near[i].add(j)
    out = {}
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            todo += [j for j in near[todo.pop()] if j not in seen and not seen.add(j)]
        out[i] = (len(near[i]), min((rows[j][0] for j in seen if rows[j][0] is not None), default=None))
    return out


def _compare(spark, rows):
    df = spark.createDataFrame([(i, v) for i, v in rows], "vec_id long, embedding array<double>")
    got = sorted(map(tuple, dedup.near_duplicates(df).collect()), key=str)
    want = [(rows[i][0], n, c, rows[i][0] is not None and rows[i][0] == c) for i, (n, c) in _links(rows).items()]
    assert got == sorted(want, key=str)


def test_dedup_equals_all_pairs_where_pairs_are_near(spark):
    rng = np.random.default_rng(1)
    rows = []
    for g in range(12):
        centre = rng.standard_normal(48)
        rows += [(int(rng.integers(10_000)), (centre + 0.1 * rng.standard_normal(48)).tolist()) for _ in range(g)]
    rows += [(20_000 + i, rng.standard_normal(48).tolist()) for i in range(60)]
    _compare(spark, rows)


def test_dedup_defined_results(spark):
    v = [1.0, 2.0, -1.0]
    rows = [(5, v), (3, v), (3, v), (None, v), (7, [2.0, 4.0, -2.0]), (1, [-1.0, -2.0, 1.0]), (8, [1.0, 2.0]), (9, None), (10, []),
            (11, [0.0, 0.0, 0.0]), (12, [1.0, None, 2.0]), (13, [float("nan"), 1.0, 1.0]), (14, [float("inf"), 1.0, 1.0]),
            (15, [1e300, 2e300, -1e300]), (16, [1e-300, 2e-300, -1e-300]), (None, None), (17, [-0.0, 0.0, 1.0]), (18, [0.0, -0.0, 1.0])]
    _compare(spark, rows)
    clash = spark.createDataFrame([(i, x) for i, x in rows], "vec_id long, embedding array<double>").withColumns(
        {c: F.lit("own") for c in ("node", "label", "n", "vector", "keys", "code", "factor", "k1", "k2", "n_links", "kept", "sound", "least")})
    assert dedup.near_duplicates(clash).count() == len(rows)
    assert dedup.near_duplicates(clash.where("vec_id > 99")).count() == 0


def test_dedup_blocks_of_a_large_group_lose_no_pair(spark, monkeypatch):
    monkeypatch.setattr(dedup, "GROUP_ROWS", 16)
    rng = np.random.default_rng(2)
    centre = rng.standard_normal(64)
    _compare(spark, [(i, (centre + 0.12 * rng.standard_normal(64)).tolist()) for i in range(150)])


@pytest.mark.parametrize("n", [1_000, 2_000_000])
def test_dedup_recall_of_pairs_just_above_the_least_cosine(n):
    """Keys and bounds, on pairs at exactly cosine 0.9001, with the tables that ``n`` vectors get."""
    rng = np.random.default_rng(3)
    x, noise = (rng.standard_normal((3000, 64)) for _ in range(2))
    x = dedup.unit_vectors(x)
    noise = dedup.unit_vectors(noise - (noise * x).sum(1)[:, None] * x)
    y = 0.9001 * x + np.sqrt(1 - 0.9001 ** 2) * noise
    k, tables = dedup.shape(n, 64)
    shared = (dedup.table_keys(x, k, tables) == dedup.table_keys(y, k, tables)).any(axis=1)
    assert shared.mean() > 0.975
    code, factor = dedup.codes(dedup.rotated(x, 0))
    asks = dedup._Queries(dedup.rotated(y, 0))
    ones = np.bitwise_count(code).sum(axis=1).astype(np.int64)
    kept = np.array([asks.may_link(i, i + 1, code, ones, factor, 0.9)[0] for i in range(500)])
    assert kept[np.arange(500), np.arange(500)].mean() > 0.995
    kept[np.arange(500), np.arange(500)] = False
    assert kept.mean() < 0.001  # pairs of unlike vectors are settled by their codes


def test_estimates_are_unbiased():
    rng = np.random.default_rng(4)
    x = dedup.unit_vectors(rng.standard_normal((1, 64)))
    other = dedup.unit_vectors(rng.standard_normal((1, 64)))
    found = []
    for which in range(400):
        a, b = dedup.rotated(x, which), dedup.rotated(other, which)
        signs = np.where(a > 0, 1, -1) / 8
        found.append(float((signs * b).sum() / dedup.codes(a)[1][0]))
    assert abs(np.mean(found) - float((x * other).sum())) < 4 * np.std(found) / 20


# --- operator 12 -----------------------------------------------------------------------------

def _trie(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            convs.setdefault(c, []).append((turn is not None, turn or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest(), role, text))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in convs.items()}
    paths = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        paths[c] = own.get(c - int(np.fmod(c, 20)), [])[:h] + ts[h:]
    members = {}
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members.setdefault(tuple(p[:d]), []).append(c)
    blank = set(" \t\n\v\f\r")
    out = []
    for node, cs in members.items():
        below = [x for x in members if x[:len(node)] == node]
        children = [x for x in below if len(x) == len(node) + 1]
        leaves = [x for x in below if not any(y[:len(x)] == x and len(y) > len(x) for y in below)]
        words = lambda x: len("".join(" " if ch in blank else ch for ch in x[-1][1]).split(" ")) - ("".join(" " if ch in blank else ch for ch in x[-1][1]).split(" ").count("")) if x else 0
        ends = ",".join(str(c) for c in sorted(cs) if len(paths[c]) == len(node))
        out.append((min(cs), len(node), min(members[node[:-1]]) if node else None, len(cs), len(children), len(leaves),
                    sum((len(members[x]) - 1) * words(x) for x in below), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


TURNS = "conv_id long, turn long, role string, text string"


def _talks():
    rng = np.random.default_rng(5)
    rows = []
    for c in [*range(0, 45), 100, 101, 119, -1, -20, -39]:
        for t in range(int(rng.integers(1, 7))):
            rows.append((c, t, ["user", "assistant"][t % 2], ["hi", "two words", "a  b\tc", ""][int(rng.integers(4))] if t < 4 else f"own {c} {t}"))
    rows += [(7, None, "user", "before"), (7, 1, "user", "a tie"), (7, 1, "user", "a tie"), (8, 0, None, None), (9, 2, "user", "x" * 100_000 + " y"),
             (None, 0, "user", "nobody's"), (None, None, None, None), (41, 3, "a", "b:c"), (42, 3, "ab", ":c"), (60, 0, "user", "only")]
    return rows


def test_trie_equals_plain_trie(spark):
    rows = _talks()
    df = spark.createDataFrame(rows, TURNS).withColumns({c: F.lit("own") for c in ("base", "h", "place", "depth", "p1", "lone", "heads", "length", "top", "leaf")})
    assert sorted(map(tuple, prefix_trie.trie(df).collect()), key=str) == _trie(rows)
    assert prefix_trie.trie(df.where("conv_id > 999")).count() == 0


def test_trie_is_the_same_however_weak_the_screen(spark, monkeypatch):
    rows = _talks()
    df = spark.createDataFrame(rows, TURNS)
    for lone in (False, True):  # a screen that proves nothing, and one that proves nothing at odd depths
        monkeypatch.setattr(prefix_trie, "screened", lambda r, bits, n, lone=lone: r.withColumns(
            {"lone": F.lit(False), "up_lone": F.lit(False)}) if not lone else _exact_at_even_depths(r))
        assert sorted(map(tuple, prefix_trie.trie(df).collect()), key=str) == _trie(rows)


def _exact_at_even_depths(rows):
    n = rows.groupBy("depth", "p1", "p2").count()
    one = n.where("count = 1 AND depth % 2 = 0").select("depth", "p1", "p2", F.lit(True).alias("lone"))
    up = one.select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("u1"), F.col("p2").alias("u2"), F.lit(True).alias("up_lone"))
    return (rows.join(one, ["depth", "p1", "p2"], "left").join(up, ["depth", "u1", "u2"], "left").fillna(False, ["lone", "up_lone"]))


def test_count_min_never_estimates_too_low(spark):
    rows = prefix_trie.prefixes(prefix_trie.rebuilt(spark.createDataFrame(_talks(), TURNS))).cache()
    for counters in (prefix_trie.BLOCK, 2 * prefix_trie.BLOCK):
        got = prefix_trie.screened(rows, prefix_trie.sketch(rows, counters), counters)
        n = rows.groupBy("depth", "p1", "p2").count()
        assert got.join(n, ["depth", "p1", "p2"]).where("lone AND count > 1").count() == 0
        assert got.join(n, ["depth", "p1", "p2"]).where("NOT lone AND count = 1").count() <= 2
    rows.unpersist()


def test_ends_of_a_large_node_are_hashed_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE_CHARS", 50)
    ends = spark.range(1000).select(F.lit(3).cast("long").alias("depth"), (F.col("id") % 2).alias("p1"), F.lit(0).cast("long").alias("p2"), (999 - F.col("id")).alias("conv_id"))
    got = {r["p1"]: r["ends_sha256"] for r in prefix_trie.ends_digests(ends).collect()}
    want = {p: hashlib.sha256(",".join(str(c) for c in range(1000) if (999 - c) % 2 == p).encode()).hexdigest() for p in (0, 1)}
    assert got == want


# --- operator 13 -----------------------------------------------------------------------------

def _codes(rows, entries, rounds):
    def sound(v):
        return v and all(x is not None and np.isfinite(x) and abs(x * 1024) < 2 ** 26 for x in v)
    kept = [(i, [int(np.floor(1024 * x)) for x in v], lab) for i, v, lab in rows if sound(v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    kept = [(i, v + [0] * (-len(v) % 4), lab) for i, v, lab in kept]
    size = len(kept[0][1]) // 4
    cut = [[tuple(v[p * size:(p + 1) * size]) for _, v, _ in kept] for p in range(4)]
    books = [[list(x) for x in c[:entries]] for c in cut]
    def nearest(p, x):
        d = [sum((a - b) ** 2 for a, b in zip(x, e)) for e in books[p]]
        return min(d), d.index(min(d))
    for _ in range(rounds):
        for p in range(4):
            use = {}
            for x in cut[p]:
                use.setdefault(nearest(p, x)[1], []).append(x)
            for e, xs in use.items():
                books[p][e] = [sum(c) // len(xs) for c in zip(*xs)]
    out = []
    for k, (i, _, lab) in enumerate(kept):
        best = [nearest(p, cut[p][k]) for p in range(4)]
        out.append((i, lab, "".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best)))
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    total = {}
    for _, lab, _, d in out:
        total[lab] = total.get(lab, 0) + d
    return sorted(((i, lab, c, d, total[lab], sha) for i, lab, c, d in out), key=str)


@pytest.mark.parametrize("dims", [8, 10])
def test_codes_equal_plain_rounds(spark, dims):
    rng = np.random.default_rng(6)
    rows = [(int(i), [float(x) for x in rng.normal(0, 0.02, dims)], int(i) % 3 or None) for i in rng.permutation(300)]
    rows += [(5, rows[0][1], None), (None, rows[1][1], 9), (400, rows[2][1], 1), (401, rows[2][1], 1), (402, None, 1), (403, [None] * dims, 1), (404, [], 1),
             (405, [1.0], 2), (406, [float("nan")] * dims, 2), (407, [float("-inf")] * dims, 2), (408, [1e9] * dims, 2), (409, [-0.5] * dims, 2)]
    df = spark.createDataFrame(rows, VECTORS).withColumns({c: F.lit("own") for c in ("whole", "code", "error", "label_error", "position", "part", "n", "of")})
    got = vector_codes.compress(df, entries=20)
    assert sorted(map(tuple, got.collect()), key=str) == _codes(rows, 20, 4)


def test_codes_of_few_and_no_rows(spark):
    rows = [(2, [1.0, 2.0, 3.0, 4.0], None), (1, [1.0, 2.0, 3.0, -4.0], None)]
    df = spark.createDataFrame(rows, VECTORS)
    assert sorted(map(tuple, vector_codes.compress(df).collect()), key=str) == _codes(rows, 256, 4)
    assert vector_codes.compress(df.where("vec_id > 9")).count() == 0


def test_walk_is_the_nearest_entry():
    rng = np.random.default_rng(7)
    parts = np.unique(rng.integers(-3, 3, (3000, 5)), axis=0)
    entries = rng.integers(-3, 3, (40, 5))
    entries[7] = entries[3]
    d = ((parts[:, None] - entries[None]) ** 2).sum(2)
    code, error = vector_codes.walk(parts, entries)
    assert (code == d.argmin(1)).all() and (error == d.min(1)).all()


def test_sql_of_trie_and_codes(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    for query, sql in ((prefix_trie.op12_prefix_trie, prefix_trie.ORACLE), (vector_codes.op13_vector_codes, vector_codes.ORACLE)):
        df = query(spark, sf)
        cur = con.execute(sql)
        assert df.columns == [d[0] for d in cur.description]
        assert sorted(map(tuple, df.collect()), key=str) == sorted(cur.fetchall(), key=str)
