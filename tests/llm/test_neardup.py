"""Operator 5 against brute force, and its edge cases."""
import random
import re

import numpy as np

from ledgerkit.llm import bytes_np as B
from ledgerkit.llm import neardup


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_components(rows, percent=85):
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            n = len(a & sets[j])
            if n and 100 * n >= percent * (len(a) + len(sets[j]) - n):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    return {d: (len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows)}


def near_copies(seed, bases=12, copies=12):
    """Groups of copies edited at 0 to 12 places, so similarities lie on both sides of the limit."""
    rng = random.Random(seed)
    rows = []
    for b in range(bases):
        base = [f"t{rng.randrange(10 ** 6)}" for _ in range(rng.choice([3, 4, 5, 6, 60, 150]))]
        for _ in range(copies):
            words = list(base)
            for _ in range(rng.randrange(13)):
                words[rng.randrange(len(words))] = f"e{rng.randrange(10 ** 6)}"
            rows.append((len(rows) + 1, rng.choice([" ", "  ", "\n"]).join(words).upper() if rng.random() < 0.3 else " ".join(words)))
    return rows


def test_same_rows_as_brute_force(spark):
    rows = near_copies(3)
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = brute_components(rows)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_edges(spark, edge_docs, no_docs):
    got = neardup.near_duplicates(edge_docs).collect()
    by_id = {r["doc_id"]: r for r in got if r["doc_id"]}
    assert len(got) == edge_docs.count()
    assert (by_id[10]["component_id"], by_id[1]["component_id"]) == (1, 1) and not by_id[10]["kept"]
    assert (by_id[9]["component_id"], by_id[9]["n_shingles"]) == (8, 1)
    for empty in (2, 3, 6):
        assert by_id[empty]["n_shingles"] == 0 and by_id[empty]["kept"]
    assert neardup.near_duplicates(no_docs).count() == 0


def test_one_row_of_each_group_stays(spark, edge_docs, no_docs):
    left = neardup.one_of_each(edge_docs)
    assert left.columns == edge_docs.columns and left.first()["score"] == "own score"
    ids = sorted(str(r["doc_id"]) for r in left.collect())
    assert ids == sorted(["1", "2", "3", "None", "None", "5", "6", "7", "8", "11"])
    assert neardup.one_of_each(no_docs).count() == 0


def test_a_class_that_cannot_link_is_told(spark):
    sets = spark.createDataFrame([(1, list(range(100))), (2, list(range(80)) + [1000 + i for i in range(20)]), (3, list(range(95)) + [5000 + i for i in range(5)])],
                                 "node long, members array<long>")
    assert {r["node"] for r in neardup.can_link(sets, 85).collect()} == {1, 3}


def test_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a long, b long")
    got = {r["node"]: r["label"] for r in neardup.components(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


def test_word_hashes_tell_ranges_apart():
    text = "a b ab ab a\tb " + "x" * 70 + " " + "x" * 71 + " " + "x" * 70
    raw = np.frombuffer(text.encode(), np.uint8)
    s, e, _ = B.words(raw, np.array([0, len(raw)]))
    words = text.split()
    h = B.word_hashes(raw, s, e)
    assert len(words) == len(h) == len(s)
    assert all((words[i] == words[j]) == (h[i] == h[j]) for i in range(len(h)) for j in range(len(h)))


def test_last_round_sends_on_no_pairs(spark):
    """Copies of one base, each edited in its own way so that their signatures pass and few pairs link."""
    rng = random.Random(5)
    base, rows = [f"w{i}" for i in range(400)], []
    for n in range(90):
        words = list(base)
        for at in rng.sample(range(400), rng.choice([5, 6, 7, 8])):
            words[at] = f"e{n}x{at}"
        rows.append((n + 1, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    classes = neardup.sketch(docs, ["doc_id"]).withColumnRenamed("doc_id", "node").cache()
    keys = neardup.table_keys(classes).selectExpr("*", "node AS label").cache()
    sets = neardup.shingle_sets(docs.withColumnRenamed("doc_id", "node")).cache()
    near = neardup.last_pairs(keys, classes, sets, neardup.GROUPS, 85).distinct().collect()
    assert 0 < len(near) < 6 * len(rows)  # of 4,005 pairs
    placed = spark.createDataFrame([(r[0], r[0], 0) for r in rows], "node long, label long, cluster long")
    want = brute_components(rows)
    for members in (neardup.BLOCK_MEMBERS, 2000):
        neardup.BLOCK_MEMBERS, kept = members, neardup.BLOCK_MEMBERS
        try:
            links = neardup.cluster_links(placed, sets, 85).collect()
        finally:
            neardup.BLOCK_MEMBERS = kept
        label = {d: d for d in want}
        for r in links:
            p, q = sorted((label[r["a"]], label[r["b"]]))
            label = {d: p if x == q else x for d, x in label.items()}
        assert label == {d: c for d, (_, c) in want.items()}
        assert len(links) < len(rows) or members == 2000


def test_each_step_of_components_is_released(spark, monkeypatch):
    steps, freed = [], []
    written, release = neardup.written, neardup.release
    monkeypatch.setattr(neardup, "written", lambda df, name="table": steps.append(name) or written(df, name))
    monkeypatch.setattr(neardup, "release", lambda session: freed.append(len(steps)) or release(session))
    chain = [(k, k + 1) for k in range(1, 12)] + [(20, 21)]
    got = {r["node"]: r["label"] for r in neardup.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {k: 1 for k in range(1, 13)} | {20: 20, 21: 20}
    assert len(steps) > 3 and freed == [*range(3, len(steps) + 1)]
