"""Operators 1, 3, 6 and 7, the registered queries and the pipeline."""
import zlib

import duckdb
import numpy as np
import pytest

from ledgerkit.llm import mixing, quality_model, registry, sharding, toxicity
from ledgerkit.llm.common import read

SF = "/root/testdata/sf0.001"


# -- 1, mixing --------------------------------------------------------------------------------

def test_shortage_goes_to_siblings_before_ancestors(spark):
    rows = [("web", "en", "a", 10), ("web", "en", "b", 1000), ("web", "de", "c", 1000), ("books", "en", "d", 1000)]
    leaves = spark.createDataFrame([(*r, 1) for r in rows], "domain string, lang string, source string, supply long, n_rows long")
    weights = {"domain": {"web": 1, "books": 1}, "lang": {"en": 1, "de": 1}, "source": {"a": 1, "b": 1}}
    got = {r["source"]: r["budget"] for r in mixing.leaf_budgets(leaves, mixing.LEVELS, weights, 30, 1).collect()}
    total = 3010 * 30 // 100
    assert got["d"] == total // 2  # the other domain gets nothing of a's shortage
    assert got["c"] == total // 4  # nor the other language
    assert got["a"] == 10 and abs(got["b"] - (total / 4 - 10)) <= 1  # b takes it
    short = leaves.where("source != 'b'")
    got = {r["source"]: r["budget"] for r in mixing.leaf_budgets(short, mixing.LEVELS, weights, 30, 1).collect()}
    total = 2010 * 30 // 100
    assert got["a"] == 10 and got["d"] == total // 2 and got["c"] == total // 2 - 10


def test_epochs_and_prefix(spark):
    docs = spark.createDataFrame([(i, "w " * (1 + i % 7), "en", "s1", "x") for i in range(500)], "doc_id long, text string, lang string, source string, domain string")
    got = mixing.mix(docs, weights={}, budget_percent=150, max_epochs=3).collect()
    supply = sum(1 + i % 7 for i in range(500))
    taken = sum(r["n_tokens"] for r in got)
    assert supply * 150 // 100 - 7 <= taken <= supply * 150 // 100
    first, last = ({r["doc_id"] for r in got if r["epoch"] == e} for e in (0, 1))
    assert len(first) == 500 and len(got) == 500 + len(last)
    # the last epoch is a prefix of its order
    order = sorted(range(500), key=lambda i: __import__("hashlib").md5(f"{mixing.SEED}:1:{i}".encode()).hexdigest())
    assert set(order[:len(last)]) == last


def test_mixing_edges(spark, edge_docs, no_docs):
    got = mixing.mixed(edge_docs)
    assert got.columns == edge_docs.columns
    rows = got.collect()
    assert rows and all((r["text"] or "").split() and r["n_tokens"] == "own n_tokens" for r in rows)
    assert mixing.mixed(no_docs).count() == 0


# -- 3, sharding ------------------------------------------------------------------------------

def test_places_and_sizes(spark, edge_docs, no_docs):
    rows = sharding.op3_sharding(spark, SF).collect()
    texts = {r["doc_id"]: r["text"] for r in read(spark, SF, "documents").collect()}
    places = {}
    for r in rows:
        raw = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 1, zlib.crc32(raw))
        places.setdefault(r["shard"], []).append((r["slot"], r["size"]))
    assert len(rows) == len(texts) and set(places) == set(range(16))
    assert all(sorted(s for s, _ in p) == list(range(len(p))) for p in places.values())
    loads = [sum(b for _, b in p) for p in places.values()]
    assert max(loads) - min(loads) <= max(r["size"] for r in rows)
    got = sharding.placed(edge_docs).collect()
    assert len(got) == edge_docs.count() and len({(r["shard"], r["slot"]) for r in got}) == len(got)
    assert sharding.placed(no_docs).count() == 0
    whole = sharding.shard(edge_docs)
    assert whole.count() == edge_docs.count() and set(whole.columns) == set(edge_docs.columns)


def test_edits_move_few_slots_and_are_stored(spark, tmp_path):
    rng = np.random.default_rng(1)
    size = rng.integers(1, 1000, 4096)
    size[7] = 40_000
    before = sharding.first_map()
    after = sharding.rebalance(before, size, 16)
    load = np.bincount(after, weights=size, minlength=16)
    assert load.max() - load.min() <= sharding.TOLERANCE * load.mean() and (before != after).sum() < 400
    grown = sharding.rebalance(after, size, 17)
    assert (after != grown).sum() < 600 and np.bincount(grown, weights=size).max() < load.max()
    path = str(tmp_path / "map")
    sharding.save_map(spark, before, 0, path)
    sharding.save_map(spark, after, 1, path)
    assert [r["shard"] for r in sharding.load_map(spark, path).orderBy("virtual_slot").collect()] == after.tolist()
    assert [r["shard"] for r in sharding.load_map(spark, path, 0).orderBy("virtual_slot").collect()] == before.tolist()


def test_runs_on_a_grown_table_edit_the_stored_map(spark, tmp_path):
    import corpus_pipeline as p
    sf, schema = str(tmp_path), "doc_id long, text string"
    grow = lambda lo, hi: spark.createDataFrame([(i, "x" * (i * 7919 % 3000)) for i in range(lo, hi)], schema).coalesce(1).write.mode("append").parquet(f"{sf}/documents.parquet")
    own = {"op3": lambda: sharding.op3_sharding(spark, sf).withColumnRenamed("map_version", "version"),
           "pipeline": lambda: p.stage_sharding(spark, read(spark, sf, "documents"), sf)}
    runs = {name: [] for name in own}
    for lo, hi in ((0, 2000), (2000, 2000), (2000, 3000)):
        if lo < hi:
            grow(lo, hi)
        for name, run in own.items():
            rows = run().select("doc_id", "shard", "virtual_slot", "version", "size").collect()
            assert len(rows) == len({r["doc_id"] for r in rows}) == hi
            runs[name].append(rows)
    for name, (first, again, grown) in runs.items():
        assert [{r["version"] for r in x} for x in (first, again, grown)] == [{1}, {1}, {2}]
        assert sorted(first) == sorted(again)
        path, size = sharding.map_path(spark, name, sf), np.zeros(sharding.N_SLOTS, int)
        for r in grown:
            size[r["virtual_slot"]] += r["size"]
        maps = [sharding.load_map(spark, path, v).orderBy("virtual_slot").collect() for v in range(3)]
        assert [len(m) for m in maps] == [sharding.N_SLOTS] * 3
        one, two = (np.array([r["shard"] for r in m]) for m in maps[1:])
        assert (two == sharding.rebalance(one, size, 16)).all() and all(two[r["virtual_slot"]] == r["shard"] for r in grown)
        dealt = sharding.rebalance(sharding.first_map(), size, 16)
        assert 0 < (one != two).sum() < (one != dealt).sum()
    fewer = sharding.rebalance(two, size, 12)
    assert fewer.max() == 11 and (fewer[two < 12] != two[two < 12]).sum() < 400


# -- 6, toxicity ------------------------------------------------------------------------------

def sentences(rng, n, bad):
    words = ["render", "thone", "andre", "stion", "ofer", "whel", "inger", "hatan", "mesel", "dorin"]
    out = []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.integers(20, 60))]
        if bad[i]:
            for _ in range(2):
                text[rng.integers(len(text))] = rng.choice(["grubzek", "Vulkop"])
        out.append(". ".join(" ".join(text[k:k + 8]) for k in range(0, len(text), 8)))
    return out


def test_gapped_and_inserted_letters_are_tolerated():
    rng = np.random.default_rng(3)
    bad = np.arange(240) % 3 == 0
    model = toxicity.fit(sentences(rng, 240, bad), bad.astype(int))

    def score(text):
        import pyarrow as pa
        (_, _, buf, offs), = toxicity.B.chunks(pa.array([text]))
        seq, start, size, _ = toxicity.letters(buf, offs)
        m = max(toxicity.sentence_margins(seq, start, size, model["weights"]) + model["bias"]) if len(start) else model["bias"]
        return 1 / (1 + np.exp(-(model["slope"] * m + model["offset"])))

    held = np.arange(200) % 2 == 0
    scores = np.array([score(t) for t in sentences(np.random.default_rng(4), 200, held)])
    assert (scores[held] >= 0.7).mean() > 0.95 and (scores[~held] >= 0.7).mean() < 0.05
    clean = score("render thone andre stion")
    for written in ("GRUBZEK", "g r u b z e k", "grub*zek", "g.r.u.b.z.e.k", "grúbzek", "grubxzek"):
        assert score(f"thone {written} andre") > max(0.5, clean), written
    assert score("") == score("!!") <= 0.5


def test_insults_in_pieces_are_found_at_every_word():
    rng = np.random.default_rng(3)
    bad = np.arange(240) % 3 == 0
    model = toxicity.fit(sentences(rng, 240, bad), bad.astype(int))

    def margin(text):
        import pyarrow as pa
        (_, _, buf, offs), = toxicity.B.chunks(pa.array([text]))
        return max(toxicity.sentence_margins(*toxicity.letters(buf, offs)[:3], model["weights"]))

    words = "render thone andre stion ofer whel inger hatan mesel dorin render ofer stion thone".split()
    clean = margin(" ".join(words))
    for at in range(len(words) + 1):
        texts = [" ".join(words[:at] + ["grub", "zek"] + words[at:])]
        texts += [f"{w} {texts[0]}" for w in ("whel", "whel thone", "whel thone ofer")]
        own = [margin(t) for t in texts]
        assert min(own) > clean + 0.5, at
        assert min(own) == own[0], at  # words in front take nothing away


def test_kernel_table_is_the_kernel():
    """The table of weights gives the same margin as the Nyström features of a sentence."""
    marks = toxicity._Landmarks(["grubzek", "render", "stion", "whel"])
    encoded = toxicity._encoded(["a grub zek renders. the stion whel", "vulkop"])
    chosen = [np.arange(len(e[2])) for e in encoded]
    w = np.random.default_rng(0).normal(size=marks.root.shape[1])
    table = marks.table(w)
    direct = marks.features(encoded, chosen) @ w
    looked_up = np.concatenate([toxicity.sentence_margins(s, a, n, table) for _, s, a, n, _ in encoded])
    assert np.allclose(direct, looked_up, atol=1e-4)


def test_toxicity_edges(spark, edge_docs, no_docs):
    none = toxicity.fit([], np.array([]))
    labels = spark.createDataFrame([(1, None, None), (None, 1, 1), (5, 1, 1), (7, 1, 0), (99, 0, 1)], "doc_id long, quality long, toxic long")
    for model in (none, toxicity.fit_table(edge_docs, labels)):
        left = toxicity.not_toxic(edge_docs, model)
        assert left.columns == edge_docs.columns
        assert left.where("doc_id in (2, 3, 6)").count() == 3
        assert toxicity.scored(no_docs, model).count() == 0
    assert toxicity.scored(edge_docs, none).agg({"score": "max"}).first()[0] < 1e-9


# -- 7, quality classifier --------------------------------------------------------------------

def auc(score, label):
    rank = np.argsort(np.argsort(score)) + 1
    n1, n0 = (label == 1).sum(), (label == 0).sum()
    return (rank[label == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * n0)


def test_interaction_is_learned():
    rng = np.random.default_rng(0)
    x = rng.random((4000, len(quality_model.FEATURES)))
    y = ((x[:, 2] > 0.5) ^ (x[:, 5] > 0.5)).astype(int)
    model = quality_model.fit(x[:3000], y[:3000])
    assert {2, 5} in [{i, j} for i, j, _ in model["pairs"]]
    assert auc(quality_model.scores(model, x[3000:]), y[3000:]) > 0.95


@pytest.mark.parametrize("name,label,fold,held", [("op7_quality_model", "quality", 4, 2), ("op6_toxicity", "toxic", 3, 1)])
def test_held_out_accuracy(spark, name, label, fold, held):
    sf = "/root/testdata/sf0.01"
    rows = {r["doc_id"]: r for r in registry.QUERIES[name](spark, sf).collect()}
    assert len(rows) == read(spark, sf, "documents").count()
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % fold == held) and r["predicted"] == (r["score"] >= 0.7) for d, r in rows.items())
    known = [(rows[r["doc_id"]], r[label]) for r in read(spark, sf, "labels").collect()]
    known = [(r["score"], y) for r, y in known if r["held_out"]]
    assert auc(np.array([s for s, _ in known]), np.array([y for _, y in known])) > (0.95 if label == "quality" else 0.6)


def test_quality_edges(spark, edge_docs, no_docs):
    none = quality_model.fit(np.zeros((0, len(quality_model.FEATURES))), np.array([]))
    labels = spark.createDataFrame([(1, None, None), (None, 1, 1), (5, 1, 1), (7, 0, 0)], "doc_id long, quality long, toxic long")
    for model in (none, quality_model.fit_table(edge_docs, labels)):
        got = quality_model.scored(edge_docs, model)
        assert got.count() == edge_docs.count() and got.where("score is null or score < 0 or score > 1").count() == 0
        assert quality_model.scored(no_docs, model).count() == 0


# -- queries and pipeline ---------------------------------------------------------------------

def test_every_query_runs_on_empty_tables(spark, empty_sf):
    for name, query in registry.QUERIES.items():
        assert query(spark, empty_sf).count() == (1 if name.startswith("op2") else 0), name


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_sql_agrees(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = registry.QUERIES[name](spark, SF)
    want = con.execute(registry.ORACLE_SQL[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(str, map(tuple, got.select(*columns).collect()))) == sorted(map(str, want.fetchall()))


def test_pipeline_against_its_parts(spark):
    """Each stage on its own input, compared with what the operator's query or brute force says."""
    import corpus_pipeline as p
    from test_neardup import brute_components
    docs = read(spark, SF, "documents")
    assert [n for n, _ in p.STAGES] == ["toxicity", "near_duplicates", "decontamination", "mixing", "sharding"]
    model = toxicity.fit_table(docs, read(spark, SF, "labels"))
    rejected = {r["doc_id"] for r in toxicity.scored(docs.select("doc_id", "text"), model).where("predicted = 1").collect()}
    kept = p.written(p.stage_toxicity(spark, docs, SF), "t")
    ids = {r["doc_id"] for r in kept.collect()}
    assert ids == {r["doc_id"] for r in docs.collect()} - rejected and kept.columns == docs.columns
    rows = [(r["doc_id"], r["text"]) for r in kept.collect()]
    one = p.written(p.stage_near_duplicates(spark, kept, SF), "t")
    assert {r["doc_id"] for r in one.collect()} == {d for d, (_, least) in brute_components(rows).items() if d == least}
    clean = p.written(p.stage_decontamination(spark, one, SF), "t")
    assert clean.columns == docs.columns
    items = [r["text"].lower() for r in read(spark, SF, "benchmark").collect()]
    assert not [r for r in clean.collect() if any(i in r["text"].lower() for i in items)]
    mixed = p.written(p.stage_mixing(spark, clean, SF), "t")
    assert mixed.columns == docs.columns and {r["doc_id"] for r in mixed.collect()} <= {r["doc_id"] for r in clean.collect()}
    shards = p.stage_sharding(spark, mixed, SF)
    assert shards.count() == mixed.count() and p.run(spark, SF).count() == shards.count()


def test_pipeline_edges(spark, edge_docs, no_docs, empty_sf, tmp_path):
    import corpus_pipeline as p
    for docs in (edge_docs, no_docs):
        for name, stage in p.STAGES:
            columns = docs.columns
            docs = p.written(stage(spark, docs, empty_sf), "t")
            assert name == "sharding" or docs.columns == columns
