"""Operator 6, toxicity: a support vector machine on a subsequence string kernel, with Nyström landmarks.

Two strings are alike as far as they share subsequences of four letters that lie at most
``SPAN`` letters apart; each skipped letter costs a factor ``DECAY``.  A written-over insult
(``idxiot``, ``id*iot``, ``i d i o t``) keeps most of its subsequences: separators between single
letters are dropped, other separators are one letter of their own, accents are folded.

The machine judges sentences; of one of more than ``RUN`` words, each run of ``RUN`` words that
follow one another, from every word on: a document is as toxic as its worst run.  No pattern
reaches over more than three words, so each lies whole in a run, wherever the sentence begins.
Sums are of whole numbers, so a run's margin does not depend on what stands around it.  Labels
are on documents, so training alternates between choosing the runs of toxic documents that carry
the label (of runs that overlap, the highest one) and fitting the machine.  Landmarks are the
words that set toxic documents apart, and the most common words.  The Nyström map of a sentence s
is K(s, landmarks) K(landmarks, landmarks)^(-1/2); a linear machine on it is a weighted sum of the
landmarks' subsequences, so scoring needs one table of weights by subsequence (2^20 numbers) and
no kernel at all: one lookup for each pattern of gaps at each letter of the text.

Training rows: at most ``MAX_TOXIC`` toxic and ``MAX_CLEAN`` clean labelled documents, those first
in the order of a hash of their id; of their runs those that carry the label, the worst one of each
clean row and a share of ``CLEAN_RUNS`` of the other clean runs, drawn by hash.  Each step of the fit
is a pass over them on the executors, which sends counts or features back, no text.  Every document's
whole text is scored.  Letters beyond Latin-1 are all one letter, so words of other scripts differ
by their lengths only.

Defined results: null and empty texts, and texts without a letter, score as a sentence without
subsequences; rows that repeat are scored alike, and a label row that repeats counts once; a document
with both labels is a row of each; an empty table gives no rows; without a toxic or
without a clean training row every score is 0; columns of the documents are kept, ``score`` and
``predicted`` win over equal names.
"""
from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import bytes_np as B
from .common import crc32_fold, read, release, set_aside, ship, shipped, text_of, written

SPAN, DECAY, RUN = 6, 0.5, 4
N_LANDMARKS = 400
MAX_TOXIC, MAX_CLEAN = 1500, 3000
ROUNDS, COST = 3, 1.0
CLEAN_RUNS = 0.0025  # share of a clean row's runs, besides its worst one, that the machine is fitted on
FIT_TEXTS, FIT_BYTES = 100, 200_000  # at a time while fitting
SCORE_BYTES = 500_000  # of text at a time while scoring: some 25 arrays of that length are alive
MIN_SCORE = 0.7

_BREAK, _DIGIT, _OTHER, _END, _SKIP = 31, 27, 28, 30, 255
_CODE = np.zeros(256, np.uint8)
_CODE[ord("a"):ord("z") + 1] = np.arange(1, 27)
_CODE[ord("A"):ord("Z") + 1] = np.arange(1, 27)
_CODE[ord("0"):ord("9") + 1] = _DIGIT
_CODE[0x80:0xC0] = _SKIP
_CODE[0xC0:] = _OTHER
# second byte of the Latin-1 letters (lead byte C3) to the letter under the accent
_FOLD = np.full(256, _OTHER, np.uint8)
for _base, _second in {"a": [0, 1, 2, 3, 4, 5, 6], "c": [7], "e": [8, 9, 10, 11], "i": [12, 13, 14, 15], "n": [17],
                       "o": [18, 19, 20, 21, 22, 24], "u": [25, 26, 27, 28], "y": [29, 63], "s": [31]}.items():
    for _x in _second:
        _FOLD[0x80 + _x] = ord(_base) - 96
        if _base != "s" and _x < 32:
            _FOLD[0xA0 + _x] = ord(_base) - 96
PATTERNS = [((*gaps, last), DECAY ** (last - 3)) for last in range(3, SPAN) for gaps in combinations(range(1, last), 2)]


def letters(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(letter codes of all sentences with separators, start of each run of words, its letters, its document).
    Three breaks lie between sentences, more than any pattern can skip; runs of a sentence overlap."""
    code = _CODE[buf]
    lead = np.flatnonzero(buf[:-1] == 0xC3)
    code[lead] = _FOLD[buf[lead + 1]]
    ender = (buf == 0x2E) | (buf == 0x21) | (buf == 0x3F)
    after = np.ones(len(buf), bool)
    after[:-1] = B.SPACE[buf[1:]]
    code[(ender & after) | (buf == 0x0A)] = _END
    kept = np.flatnonzero(code != _SKIP)
    seq, first = code[kept], np.searchsorted(kept, offs)
    at = np.flatnonzero((seq != 0) & (seq != _END))
    if not len(at):
        z = np.zeros(0, np.int64)
        return np.zeros(0, np.uint8), z, z, z
    doc = np.searchsorted(first, at, "right") - 1
    begins = np.ones(len(at), bool)
    begins[1:] = (at[1:] != at[:-1] + 1) | (doc[1:] != doc[:-1])
    word = np.flatnonzero(begins)
    size = np.diff(np.r_[word, len(at)])
    ends = np.cumsum(seq == _END)
    new = np.ones(len(word), bool)
    new[1:] = (doc[word[1:]] != doc[word[:-1]]) | (ends[at[word[1:]]] != ends[at[word[1:] - 1]])
    joined = np.zeros(len(word), bool)
    joined[1:] = ~new[1:] & (size[1:] == 1) & (size[:-1] == 1)
    before = np.where(new, 5, np.where(joined, 0, 1))
    extra = np.zeros(len(at), np.int64)
    extra[word] = before
    place = np.arange(len(at)) + np.cumsum(extra)
    out = np.zeros(int(place[-1]) + 5, np.uint8)
    out[place] = seq[at]
    for k in (2, 3, 4):
        out[place[word[new]] - k] = _BREAK
    out[-3:] = _BREAK
    # a run from each word (joined letters are one) that has RUN words to the sentence's end, or is its first
    group, opens = word[~joined], np.flatnonzero(new[~joined])
    past = np.repeat(np.r_[opens[1:], len(group)], np.diff(np.r_[opens, len(group)]))
    run = np.flatnonzero(new[~joined] | (np.arange(len(group)) + RUN <= past))
    first, last = group[run], np.r_[group, len(at)][np.minimum(run + RUN, past[run])]
    return out, place[first] - 1, last - first, doc[first]


def subsequences(seq: np.ndarray):
    """For each pattern of gaps: (code of the subsequence from each place on, its weight)."""
    c = seq.astype(np.int32)
    a, b, d = c << 15, c << 10, c << 5
    for (i, j, k), weight in PATTERNS:
        n = len(c) - k
        if n > 0:
            yield a[:n] | b[i:n + i] | d[j:n + j] | c[k:], weight


def _past(seq: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """End of each run, after the separator that follows its last letter."""
    place = np.flatnonzero((seq != 0) & (seq != _BREAK))
    return place[np.searchsorted(place, start) + size - 1] + 2


def sentence_margins(seq: np.ndarray, start: np.ndarray, size: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The machine's sum over each run, without the bias: patterns from its first place to its last."""
    if not len(start):
        return np.zeros(0)
    scale = 2.0 ** 27 / max(float(np.abs(weights).max()), 1e-9)
    whole = np.rint(weights * scale).astype(np.int32)
    past, margin = _past(seq, start, size), np.zeros(len(start))
    totals: dict[int, np.ndarray] = {}
    for code, _ in subsequences(seq):
        reach = len(seq) - len(code)
        totals[reach] = totals.get(reach, 0) + whole[code]
    for reach, total in totals.items():
        upto = np.r_[0, np.cumsum(total, dtype=np.int64)]
        margin += DECAY ** (reach - 3) * (upto[np.maximum(past - reach, start)] - upto[start])
    return margin / scale / np.sqrt(size)


def _encoded(texts: list[str]) -> list[tuple]:
    """(first row, letters, sentence starts, sizes, rows) of runs of a few texts; small arrays only."""
    out = []
    for lo in range(0, len(texts), FIT_TEXTS):
        for a, _, buf, offs in B.chunks(pa.array(texts[lo:lo + FIT_TEXTS], pa.string()), FIT_BYTES):
            seq, *rest = letters(buf, offs)
            out.append((lo + a, seq, *(x.astype(np.int32) for x in rest)))
    return out


class _Landmarks:
    """Landmark words, their subsequences and the Nyström map."""

    def __init__(self, words: list[str]):
        found: list[dict[int, float]] = []
        for w in words:
            own: dict[int, float] = {}
            for _, seq, *_ in _encoded([w]):
                for code, weight in subsequences(seq):
                    for c in code.tolist():
                        if not any(x == _BREAK for x in (c >> 15, c >> 10 & 31, c >> 5 & 31, c & 31)):
                            own[c] = own.get(c, 0.0) + weight
            found.append({c: v / np.sqrt(len(w)) for c, v in own.items()})
        self.codes = np.array(sorted({c for f in found for c in f}), np.int64)
        self.column = np.full(1 << 20, -1, np.int32)
        self.column[self.codes] = np.arange(len(self.codes))
        self.vectors = np.zeros((len(words), len(self.codes)), np.float32)
        for i, f in enumerate(found):
            self.vectors[i, self.column[list(f)]] = list(f.values())
        values, basis = np.linalg.eigh((self.vectors @ self.vectors.T).astype(np.float64))
        self.by_code = np.ascontiguousarray(self.vectors.T)
        good = values > 1e-6 * values.max()
        self.root = basis[:, good] / np.sqrt(values[good])

    def features(self, encoded: list[tuple], chosen: list[np.ndarray]) -> np.ndarray:
        """Nyström features of the chosen runs of words of each part of the texts."""
        out = []
        for (_, seq, start, size, _), pick in zip(encoded, chosen):
            if not len(pick):
                continue
            # only the chosen runs, each with breaks after it
            long = _past(seq, start, size)[pick] - start[pick] + 3
            opens = np.cumsum(long) - long
            row_of = np.repeat(np.arange(len(pick)), long)
            within = np.arange(len(row_of)) - opens[row_of]
            seq = np.where(within < long[row_of] - 3, seq[np.minimum(start[pick][row_of] + within, len(seq) - 1)], _BREAK).astype(np.uint8)
            parts = []
            for code, w in subsequences(seq):
                col, row = self.column[code], row_of[:len(code)]
                ok = col >= 0
                parts.append((row[ok], col[ok], np.full(int(ok.sum()), w, np.float32)))
            row, col, w = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(row, kind="stable")
            row, col, w = row[order], col[order], w[order]
            for lo in range(0, len(pick), 25):
                hi = min(lo + 25, len(pick))
                x, y = np.searchsorted(row, [lo, hi])
                k = np.zeros((hi - lo, len(self.vectors)), np.float32)
                if x < y:
                    first = np.flatnonzero(np.r_[True, row[x + 1:y] != row[x:y - 1]])
                    k[row[x:y][first] - lo] = np.add.reduceat(self.by_code[col[x:y]] * w[x:y, None], first)
                out.append((k / np.sqrt(size[pick[lo:hi]])[:, None] @ self.root).astype(np.float32))
        return np.concatenate(out) if out else np.zeros((0, self.root.shape[1]), np.float32)

    def table(self, weights: np.ndarray) -> np.ndarray:
        """Weights of the linear machine as one number for each subsequence."""
        out = np.zeros(1 << 20, np.float32)
        out[self.codes] = (self.root @ weights) @ self.vectors
        return out


def _machine(x: np.ndarray, y: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """Linear support vector machine with squared hinge loss by Newton steps; the last weight is the bias."""
    w = np.zeros(x.shape[1] + 1)
    ridge = np.ones(len(w))
    ridge[-1] = 1e-3
    for _ in range(30):
        miss = 1 - y * (x @ w[:-1].astype(np.float32) + w[-1])
        active = miss > 0
        curve, grad = np.diag(ridge), ridge * w
        for lo in range(0, len(x), 1024):  # in blocks: no copy of all active rows
            on = np.flatnonzero(active[lo:lo + 1024]) + lo
            xa = np.c_[x[on].astype(np.float64), np.ones(len(on))]
            grad -= xa.T @ (cost[on] * y[on] * miss[on])
            curve = curve + (xa * cost[on, None]).T @ xa
        step = np.linalg.solve(curve, grad)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _logistic(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the score over the margin, with smoothed labels."""
    pos, neg = y.sum(), (1 - y).sum()
    target = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x, w = np.c_[margin, np.ones(len(margin))], np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-6 * np.eye(2), x.T @ (p - target) + 1e-6 * w)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def _peaks(margin: np.ndarray, start: np.ndarray, past: np.ndarray) -> np.ndarray:
    """Runs whose margin no run that shares a word with them exceeds; the first of equal ones."""
    peak = np.ones(len(margin), bool)
    for k in range(1, RUN):
        shared = start[k:] < past[:-k]
        peak[:-k] &= ~(shared & (margin[k:] > margin[:-k]))
        peak[k:] &= ~(shared & (margin[:-k] >= margin[k:]))
    return peak


class Part(NamedTuple):
    """Some training rows: their numbers and labels, and the runs of words of their texts."""
    row: np.ndarray
    toxic: np.ndarray
    held: np.ndarray
    seq: np.ndarray
    start: np.ndarray
    size: np.ndarray
    doc: np.ndarray


def _parts(row: np.ndarray, toxic: np.ndarray, texts: pa.Array) -> Iterator[Part]:
    for lo in range(0, len(row), FIT_TEXTS):
        for a, b, buf, offs in B.chunks(texts.slice(lo, FIT_TEXTS), FIT_BYTES):
            at = slice(lo + a, lo + b)
            seq, *rest = letters(buf, offs)
            yield Part(row[at], toxic[at], row[at] % 4 == 3, seq, *(x.astype(np.int32) for x in rest))


def _table_runner(rows: DataFrame) -> Callable:
    """Runs a step over the parts of a table (row, toxic, text) on the executors; what it returns, a
    few arrays, comes to the driver, the texts do not."""
    def over(step: Callable, value: object) -> Iterator:
        sent = ship(rows.sparkSession, value)

        def run(batches):
            own = shipped(sent)
            for batch in batches:
                row, toxic = (batch.column(c).to_numpy() for c in ("row", "toxic"))
                out = [pickle.dumps(step(part, own)) for part in _parts(row, toxic, batch.column("text"))]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["out"])

        for r in rows.select("row", "toxic", "text").mapInArrow(run, "out binary").toLocalIterator():
            yield pickle.loads(r["out"])
        sent.destroy()

    return over


def fit(texts: list[str], toxic: np.ndarray) -> dict:
    """The model of a few rows that are here already; :func:`fit_table` fits a table."""
    toxic = np.asarray(toxic, np.int64)
    row, column = np.arange(len(toxic)), pa.array(texts, pa.string())
    return _fit(toxic, lambda step, value: (step(part, value) for part in _parts(row, toxic, column)))


def _fit(toxic: np.ndarray, over: Callable) -> dict:
    """The model: weights by subsequence, bias, slope and offset of the score; ``toxic`` has the
    labels by row number, ``over(step, value)`` runs a step over all parts.

    Every fourth row is kept from the machine and sets the score's slope and offset."""
    if not len(toxic) or toxic.min() == toxic.max():
        return {"weights": np.zeros(1 << 20, np.float32), "bias": 0.0, "slope": 0.0, "offset": -30.0}
    held = np.arange(len(toxic)) % 4 == 3
    telling, common = _landmark_words(toxic, held, over)
    marks = _Landmarks(telling + common or ["none"])
    table, bias = marks.table(marks.root.T @ np.r_[np.ones(len(telling)), -np.ones(len(marks.vectors) - len(telling))]), 0.0
    for step in range(ROUNDS):
        row, y, x = (np.concatenate(c) for c in zip(*over(_chosen_runs, (marks, table, bias, step))))
        order = np.argsort(row, kind="stable")  # sums do not depend on how the rows are spread
        x, y = x[order], y[order]
        if len(np.unique(y)) < 2:
            break
        cost = COST * np.where(y > 0, len(y) / (2 * max(1, (y > 0).sum())), len(y) / (2 * max(1, (y < 0).sum())))
        w = _machine(x, y, cost)
        table, bias = marks.table(w[:-1]), float(w[-1])
    worst = np.full(len(toxic), bias)
    for row, margin in over(_worst_runs, (table, bias)):
        worst[row] = margin
    slope, offset = _logistic(worst[held], toxic[held]) if 0 < toxic[held].sum() < held.sum() else (1.0, 0.0)
    return {"weights": table, "bias": bias, "slope": max(slope, 0.0), "offset": offset}


def _chosen_runs(part: Part, value: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, label, Nyström features) of the runs that the machine is fitted on: those of toxic rows
    that carry the label; of clean rows the worst one and, by hash, a share of ``CLEAN_RUNS``."""
    marks, table, bias, step = value
    d = part.doc
    margin = sentence_margins(part.seq, part.start, part.size, table) + bias
    worst = np.full(len(part.row), -np.inf)
    np.maximum.at(worst, d, margin)
    top = margin >= (worst[d] - 1e-6 if step == 0 else np.minimum(worst[d] - 1e-6, np.float32(1)))
    fitted = ~part.held[d]
    carry = fitted & (part.toxic[d] == 1) & top & _peaks(margin, part.start, _past(part.seq, part.start, part.size) if len(d) else part.start)
    nth = np.arange(len(d)) - np.searchsorted(d, d)
    draw = B.mix(B.mix(part.row[d].astype(np.uint64)) + (nth * (ROUNDS + 1) + step).astype(np.uint64))
    rest = fitted & (part.toxic[d] == 0) & ((margin >= worst[d] - 1e-6) | (draw < np.uint64(CLEAN_RUNS * 2.0 ** 64)))
    pick = np.flatnonzero(carry | rest)
    x = marks.features([(0, part.seq, part.start, part.size, d)], [pick])
    return part.row[d[pick]], np.where(carry[pick], 1.0, -1.0), x


def _worst_runs(part: Part, value: tuple) -> tuple[np.ndarray, np.ndarray]:
    """(row, margin of its worst run); a row without runs has the bias."""
    table, bias = value
    worst, d = np.full(len(part.row), bias), part.doc
    if len(d):
        first = np.flatnonzero(np.r_[True, d[1:] != d[:-1]])
        worst[d[first]] = np.maximum.reduceat(sentence_margins(part.seq, part.start, part.size, table) + bias, first)
    return part.row, worst


_PLAIN = np.full(32, ord("#"), np.uint8)
_PLAIN[1:27] = np.arange(ord("a"), ord("z") + 1)
_PLAIN[[0, _BREAK]] = ord(" ")
_PLAIN[_DIGIT] = ord("0")


def _words(part: Part) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(plain letters, starts, ends, hashes) of the words of a part's runs."""
    plain = _PLAIN[part.seq]
    s, e, _ = B.words(plain, np.array([0, len(plain)]))
    fits = (e - s >= 3) & (e - s <= 24)
    s, e = s[fits], e[fits]
    return plain, s, e, B.word_hashes(plain, s, e)


def _rows_of_words(part: Part, toxic: int) -> tuple[np.ndarray, np.ndarray]:
    """(words by hash, number of fitted rows of that label that hold them)."""
    _, s, _, h = _words(part)
    at = part.doc[np.searchsorted(part.start, s, "right") - 1] if len(s) else np.zeros(0, np.int32)
    one, row = B.distinct_by_doc(h.copy(), at)
    return np.unique(one[(part.toxic[row] == toxic) & ~part.held[row]], return_counts=True)


def _known_words(part: Part, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places in ``own``, number of fitted clean rows) of the words that are there."""
    h, n = _rows_of_words(part, 0)
    at = np.minimum(np.searchsorted(own, h), len(own) - 1)
    known = own[at] == h
    return at[known], n[known]


def _spelt(part: Part, wanted: np.ndarray) -> dict[int, str]:
    plain, s, e, h = _words(part)
    return {int(h[i]): plain[s[i]:e[i]].tobytes().decode() for i in np.flatnonzero(np.isin(h, wanted))}


def _landmark_words(toxic: np.ndarray, held: np.ndarray, over: Callable) -> tuple[list[str], list[str]]:
    """(words that set toxic rows apart, most common other words), folded; words are counted by hash."""
    # words of toxic rows first: no other word can be telling, and common ones occur there too
    own, c1 = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for h, n in over(_rows_of_words, 1):
        all_words, place = np.unique(np.r_[own, h], return_inverse=True)
        own, c1 = all_words, np.bincount(place, np.r_[c1, n], len(all_words)).astype(np.int64)
    own, c1 = own[c1 > 1], c1[c1 > 1]
    if not len(own):
        return [], []
    c0 = np.zeros(len(own), np.int64)
    for at, n in over(_known_words, own):
        c0[at] += n
    n = [max(1, int(((toxic == c) & ~held).sum())) for c in (0, 1)]
    # log odds of a word's rows less one standard error
    contrast = np.log((c1 + 0.5) / (c0 + 0.5) * n[0] / n[1]) - np.sqrt(1 / (c1 + 0.5) + 1 / (c0 + 0.5))
    best = np.lexsort((own, -contrast))[:N_LANDMARKS * 3 // 4]
    best = best[contrast[best] > 0]
    rest = np.lexsort((own, -(c0 + c1)))
    rest = rest[~np.isin(rest, best)][:N_LANDMARKS - len(best)]
    found: dict[int, str] = {}
    for some in over(_spelt, np.sort(own[np.r_[best, rest]])):
        found |= some
    return [found[int(own[i])] for i in best], [found[int(own[i])] for i in rest]


def training_rows(docs: DataFrame, labels: DataFrame, fold: int = 3, held_out: int = 1) -> DataFrame:
    """(row, toxic, text) of the bounded sample of labelled rows outside the held-out fold, numbered
    in the order of a hash of their id; of rows that repeat an id, the smallest text counts."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & (crc32_fold(F.col("doc_id"), fold) != held_out))
    known = known.select("doc_id", F.col("toxic").cast("long").alias("toxic"), F.xxhash64("doc_id").alias("draw")).distinct()
    some = [known.where(F.col("toxic") == c).orderBy("draw", "doc_id").limit(n) for c, n in ((1, MAX_TOXIC), (0, MAX_CLEAN))]
    ids = some[0].union(some[1])  # at most MAX_TOXIC + MAX_CLEAN rows
    texts = docs.select("doc_id", text_of().alias("text")).join(F.broadcast(ids.select("doc_id").distinct()), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"))
    found = written(texts, "toxicity-texts")
    number = F.row_number().over(Window.orderBy("draw", "doc_id", "toxic")).cast("long") - 1  # of the sample's ids alone
    rows = ids.join(F.broadcast(found.select("doc_id")), "doc_id", "left_semi").select(number.alias("row"), "doc_id", "toxic")
    return found.join(F.broadcast(rows), "doc_id").select("row", "toxic", "text")


def fit_table(docs: DataFrame, labels: DataFrame) -> dict:
    """The model of a table; texts stay on the executors, the driver gets labels, counts of words by
    hash, the features of the chosen runs and a margin for each row of the sample."""
    rows = written(training_rows(docs, labels), "toxicity-rows")
    toxic = np.zeros(rows.count(), np.int64)
    for r in rows.select("row", "toxic").toLocalIterator():
        toxic[r["row"]] = r["toxic"]
    model = _fit(toxic, _table_runner(rows))
    release(docs.sparkSession)
    return model


def scored(docs: DataFrame, model: dict, min_score: float = MIN_SCORE) -> DataFrame:
    """``docs`` with score and predicted."""
    docs = docs.drop("score", "predicted")
    at = docs.columns.index("text")
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = sent.value
        for batch in batches:
            for a, b, buf, offs in B.chunks(batch.column(at), SCORE_BYTES):
                worst = np.full(b - a, m["bias"])
                seq, start, size, doc = letters(buf, offs)
                if len(start):
                    first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
                    worst[doc[first]] = np.maximum.reduceat(sentence_margins(seq, start, size, m["weights"]) + m["bias"], first)
                score = 1 / (1 + np.exp(-np.clip(m["slope"] * worst + m["offset"], -30, 30)))
                yield pa.RecordBatch.from_arrays(batch.slice(a, b - a).columns + [pa.array(score)], batch.schema.names + ["score"])

    schema = ", ".join(f"`{n}` {t}" for n, t in docs.dtypes)
    return docs.mapInArrow(run, f"{schema}, score double").withColumn("predicted", (F.col("score") >= min_score).cast("int"))


def not_toxic(docs: DataFrame, model: dict, min_score: float = MIN_SCORE) -> DataFrame:
    """The documents that the machine does not reject."""
    inner, back = set_aside(docs, ("text",))
    return scored(inner, model, min_score).where("predicted = 0").select(*back)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_table(docs, read(spark, sf_dir, "labels"))
    held_out = crc32_fold(F.col("doc_id"), 3) == 1
    return scored(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")
