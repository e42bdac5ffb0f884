"""Operator 7, quality classifier: a generalised additive model with pairwise interactions.

A document is described by a few numbers of its whole text.  Each is cut into bins; the model is
one table of bin values for each number and for a few pairs of numbers.  The tables are learned by
cyclic boosting: in every round each feature in turn fits a tree of two levels to the gradient of
the logistic loss, shrunk and added to its table, so no feature explains another's share away.
Then the pairs with most gradient left in their common bins get tables in the same way.  A score
is the logistic function of the sum of looked-up bin values.

Training rows: at most ``MAX_ROWS`` labelled documents, those first in the order of a hash of
their id; only their numbers reach the driver.  Every document's whole text is scored.

Defined results: a null text is empty, an empty text is described by zeros and scored like any
other; rows that repeat are scored alike; an empty table gives no rows; without training rows of
both labels every score is the share of label 1 (one half without any); columns of the documents
are kept, ``score`` and ``predicted`` win over equal names.
"""
from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bytes_np as B
from .common import crc32_fold, read, text_of

FEATURES = ("log_words", "word_bytes", "symbols", "punctuation", "capitals", "digits", "exclamations", "bars",
            "distinct_words", "repeated_windows", "repeated_next", "top_word", "line_feeds", "longest_word", "single_letters", "high_bytes")
MAX_ROWS = 20_000
BINS, PAIR_BINS, PAIRS = 32, 8, 6
ROUNDS, PAIR_ROUNDS, RATE = 150, 60, 0.1
MIN_LEAF = 10
MIN_SCORE = 0.7
WINDOW = 5

_KINDS = {"symbols": b"#*$%&|<>", "punctuation": b".,;:", "exclamations": b"!", "bars": b"|", "digits": b"0123456789", "line_feeds": b"\n"}


def describe(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """One row of FEATURES for each text."""
    n = len(offs) - 1
    x = {f: np.zeros(n) for f in FEATURES}
    size = np.maximum(np.diff(offs), 1)

    def count(flag: np.ndarray) -> np.ndarray:
        return np.diff(np.r_[0, np.cumsum(flag)][offs])

    for name, kinds in _KINDS.items():
        own = np.zeros(256, bool)
        own[list(kinds)] = True
        x[name] = count(own[buf]) / size
    upper = (buf >= 0x41) & (buf <= 0x5A)
    lower = (buf >= 0x61) & (buf <= 0x7A)
    x["capitals"] = count(upper) / np.maximum(count(upper | lower), 1)
    x["high_bytes"] = count(buf >= 0x80) / size
    s, e, doc = B.words(buf, offs)
    words = np.bincount(doc, minlength=n)
    some = np.maximum(words, 1)
    x["log_words"] = np.log1p(words)
    x["word_bytes"] = np.bincount(doc, e - s, n) / some
    x["single_letters"] = np.bincount(doc, e - s == 1, n) / some
    np.maximum.at(x["longest_word"], doc, np.log1p(e - s))
    h = B.word_hashes(B.LOWER[buf], s, e)
    if len(h):
        same = np.r_[False, (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])]
        x["repeated_next"] = np.bincount(doc, same, n) / some
        windows, of = B.shingles(h, doc, WINDOW)
        _, one = B.distinct_by_doc(windows, of)
        x["repeated_windows"] = 1 - np.bincount(one, minlength=n) / np.maximum(np.bincount(of, minlength=n), 1)
        x["repeated_windows"][words == 0] = 0
        order = np.lexsort((h, doc))
        h, doc = h[order], doc[order]
        first = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])])
        run = np.diff(np.r_[first, len(h)])
        x["distinct_words"] = np.bincount(doc[first], minlength=n) / some
        top = np.zeros(n)
        np.maximum.at(top, doc[first], run)
        x["top_word"] = top / some
    return np.stack([x[f] for f in FEATURES], 1)


def _tree(g: np.ndarray, h: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Values of a two-level tree over bins with gradient sums g, hessian sums h, counts c."""
    out = np.zeros(len(g))

    def cut(lo: int, hi: int) -> int | None:
        gs, hs, cs = (np.cumsum(v[lo:hi])[:-1] for v in (g, h, c))
        if not len(gs):
            return None
        total_g, total_h, total_c = g[lo:hi].sum(), h[lo:hi].sum(), c[lo:hi].sum()
        gain = gs ** 2 / (hs + 1) + (total_g - gs) ** 2 / (total_h - hs + 1) - total_g ** 2 / (total_h + 1)
        gain[(cs < MIN_LEAF) | (total_c - cs < MIN_LEAF)] = -1
        best = int(gain.argmax())
        return lo + best + 1 if gain[best] > 1e-9 else None

    parts = [(0, len(g))]
    for _ in range(2):
        cuts = [(lo, cut(lo, hi), hi) for lo, hi in parts]
        parts = [p for lo, m, hi in cuts for p in (((lo, m), (m, hi)) if m else ((lo, hi),))]
    for lo, hi in parts:
        out[lo:hi] = g[lo:hi].sum() / (h[lo:hi].sum() + 1)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray, c: np.ndarray) -> tuple[float, np.ndarray]:
    """(gain, values) of the best tree that cuts a table of two features once in each."""
    corner = [np.pad(v.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for v in (g, h, c)]
    best, out = 0.0, np.zeros_like(g)
    base = corner[0][-1, -1] ** 2 / (corner[1][-1, -1] + 1)
    for i in range(1, g.shape[0]):
        for j in range(1, g.shape[1]):
            parts = []
            for a, b in ((0, i), (i, g.shape[0])):
                for p, q in ((0, j), (j, g.shape[1])):
                    parts.append(((a, b, p, q), *(t[b, q] - t[a, q] - t[b, p] + t[a, p] for t in corner)))
            if min(x[3] for x in parts) < MIN_LEAF:
                continue
            gain = sum(x[1] ** 2 / (x[2] + 1) for x in parts) - base
            if gain > best:
                best, out = gain, np.zeros_like(g)
                for (a, b, p, q), gs, hs, _ in parts:
                    out[a:b, p:q] = gs / (hs + 1)
    return best, out


def fit(x: np.ndarray, y: np.ndarray) -> dict:
    """The model: offset, cut points and table of each feature, tables of the chosen pairs."""
    x, y = np.asarray(x, float).reshape(-1, len(FEATURES)), np.asarray(y, float)
    share = (y.sum() + 0.5) / (len(y) + 1)
    model = {"offset": float(np.log(share / (1 - share))), "cuts": [], "tables": [], "pair_cuts": [], "pairs": []}
    if not len(y) or y.min() == y.max():
        return model
    quantiles = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    coarse = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, PAIR_BINS + 1)[1:-1])) for f in range(x.shape[1])]
    bins = [np.searchsorted(c, x[:, f], "right") for f, c in enumerate(quantiles)]
    wide = [np.searchsorted(c, x[:, f], "right") for f, c in enumerate(coarse)]
    tables = [np.zeros(len(c) + 1) for c in quantiles]
    counts = [np.bincount(b, minlength=len(t)) for b, t in zip(bins, tables)]
    margin = np.full(len(y), model["offset"])

    def slope() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for b, t, c in zip(bins, tables, counts):
            g, h = slope()
            step = RATE * _tree(np.bincount(b, g, len(t)), np.bincount(b, h, len(t)), c)
            t += step
            margin += step[b]
    g, h = slope()

    def grid(i: int, j: int, v: np.ndarray | None = None) -> np.ndarray:
        rows, cols = len(coarse[i]) + 1, len(coarse[j]) + 1
        return np.bincount(wide[i] * cols + wide[j], v, rows * cols).reshape(rows, cols)

    gains = sorted(((_quadrants(grid(i, j, g), grid(i, j, h), grid(i, j))[0], i, j) for i, j in combinations(range(x.shape[1]), 2)), reverse=True)
    pairs = [(i, j, np.zeros_like(grid(i, j), float)) for gain, i, j in gains[:PAIRS] if gain > 0]
    for _ in range(PAIR_ROUNDS):
        for i, j, t in pairs:
            g, h = slope()
            step = RATE * _quadrants(grid(i, j, g), grid(i, j, h), grid(i, j))[1]
            t += step
            margin += step[wide[i], wide[j]]
    return model | {"cuts": quantiles, "tables": tables, "pair_cuts": coarse, "pairs": pairs}


def scores(model: dict, x: np.ndarray) -> np.ndarray:
    margin = np.full(len(x), model["offset"])
    for f, (cuts, table) in enumerate(zip(model["cuts"], model["tables"])):
        margin += table[np.searchsorted(cuts, x[:, f], "right")]
    for i, j, table in model["pairs"]:
        margin += table[tuple(np.searchsorted(model["pair_cuts"][f], x[:, f], "right") for f in (i, j))]
    return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def _described(batches):
    for batch in batches:
        for a, b, buf, offs in B.chunks(batch.column("text")):
            x = describe(buf, offs)
            yield pa.RecordBatch.from_arrays([batch.column(c).slice(a, b - a) for c in ("draw", "quality")] + [pa.array(list(x), pa.list_(pa.float64()))],
                                             ["draw", "quality", "x"])


def training_rows(docs: DataFrame, labels: DataFrame, fold: int = 4, held_out: int = 2) -> DataFrame:
    """(draw, quality, x) of the bounded sample of labelled rows outside the held-out fold."""
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & (crc32_fold(F.col("doc_id"), fold) != held_out))
    ids = known.select("doc_id", F.col("quality").cast("int"), F.xxhash64("doc_id").alias("draw")).orderBy("draw", "doc_id", "quality").limit(MAX_ROWS)
    rows = docs.select("doc_id", text_of().alias("text")).join(F.broadcast(ids), "doc_id")  # at most MAX_ROWS ids
    return rows.select("draw", "quality", "text").mapInArrow(_described, "draw long, quality int, x array<double>")


def fit_table(docs: DataFrame, labels: DataFrame) -> dict:
    rows = sorted((r["draw"], r["quality"], r["x"]) for r in training_rows(docs, labels).toLocalIterator())
    return fit(np.array([x for *_, x in rows]), np.array([y for _, y, _ in rows]))


def scored(docs: DataFrame, model: dict, min_score: float = MIN_SCORE) -> DataFrame:
    """``docs`` with score and predicted."""
    docs = docs.drop("score", "predicted")
    at = docs.columns.index("text")
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        own = shipped.value
        for batch in batches:
            for a, b, buf, offs in B.chunks(batch.column(at)):
                score = scores(own, describe(buf, offs))
                yield pa.RecordBatch.from_arrays(batch.slice(a, b - a).columns + [pa.array(score)], batch.schema.names + ["score"])

    schema = ", ".join(f"`{n}` {t}" for n, t in docs.dtypes)
    return docs.mapInArrow(run, f"{schema}, score double").withColumn("predicted", (F.col("score") >= min_score).cast("int"))


def op7_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_table(docs, read(spark, sf_dir, "labels"))
    held_out = crc32_fold(F.col("doc_id"), 4) == 2
    return scored(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")
