"""Vectorised work on the UTF-8 bytes of many texts at once (numpy, inside Spark tasks)."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
CHUNK_BYTES = 2_000_000
_LONG_WORD = 64


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows of about ``limit`` bytes; a longer
    text is a run of its own.  Null counts as empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    n = len(texts)
    if not n:
        return
    offs = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + n + 1]
    data = texts.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offs, offs[a] + limit, "right")) - 1)
        b = min(b, n)
        yield a, b, buf[offs[a]:offs[b]], offs[a:b + 1] - offs[a]
        a = b


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, document of each word) for white-space separated words; none spans two texts."""
    if not len(buf):
        z = np.zeros(0, np.int64)
        return z, z, z
    space = SPACE[buf]
    edge = np.zeros(len(buf) + 1, bool)
    edge[offs] = True
    before = np.empty(len(buf), bool)
    before[0], before[1:] = True, space[:-1]
    starts = np.flatnonzero(~space & (before | edge[:-1]))
    after = np.empty(len(buf), bool)
    after[-1], after[:-1] = True, space[1:]
    ends = np.flatnonzero(~space & (after | edge[1:])) + 1
    doc = np.searchsorted(offs, starts, "right") - 1
    return starts, ends, doc


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range; ranges of equal bytes have equal hashes."""
    size = ends - starts
    if not len(size):
        return np.zeros(0, np.uint64)
    order = np.argsort(-np.minimum(size, _LONG_WORD + 1).astype(np.int16), kind="stable")
    s, n = starts[order], size[order]
    h = np.full(len(s), 0x9E3779B97F4A7C15, np.uint64)
    more = len(s) - np.cumsum(np.bincount(np.minimum(n, _LONG_WORD), minlength=_LONG_WORD + 1))
    for k in range(_LONG_WORD):
        m = int(more[k])
        if not m:
            break
        h[:m] = (h[:m] ^ buf[s[:m] + k]) * np.uint64(0xFF51AFD7ED558CCD)
        h[:m] ^= h[:m] >> np.uint64(29)
    for i in np.flatnonzero(n > _LONG_WORD):
        h[i] = xxhash.xxh3_64_intdigest(buf[s[i]:s[i] + n[i]].tobytes(), 7)
    out = np.empty_like(h)
    out[order] = h
    return mix(out)


def shingles(word: np.ndarray, doc: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of every run of ``width`` words of a document; a document of fewer words
    is one run.  Not distinct."""
    mul = [np.uint64(0x9E3779B97F4A7C15 + 2 * 0x632BE59BD9B4E019 * i & 0xFFFFFFFFFFFFFFFF | 1) for i in range(width)]
    rot = [np.uint64(0xD6E8FEB86659FD93 * (i + 1) & 0xFFFFFFFFFFFFFFFF) for i in range(width)]

    def run(at: np.ndarray, length: int) -> np.ndarray:
        h = np.full(len(at), length, np.uint64)
        for i in range(length):
            h = mix(h * mul[i] + word[at + i] + rot[i])
        return h

    n = len(word)
    full = np.flatnonzero(doc[:n - width + 1] == doc[width - 1:]) if n >= width else np.zeros(0, np.int64)
    out, of = [run(full, width)], [doc[full]]
    if n:
        first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
        count = np.diff(np.r_[first, n])
        for length in range(1, width):
            at = first[count == length]
            out.append(run(at, length))
            of.append(doc[at])
    return np.concatenate(out), np.concatenate(of)


def distinct_by_doc(h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (document, hash) pairs, sorted by document, then hash."""
    order = np.argsort(doc, kind="stable")  # runs by document: a merge, no comparison sort
    h, doc = h[order], doc[order]
    edges = np.r_[np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]]), len(doc)] if len(doc) else []
    for a, b in zip(edges[:-1], edges[1:]):
        h[a:b].sort()
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return h[keep], doc[keep]
