"""Operator 8, benchmark decontamination: pigeonhole edit matching.

Both sides are normalised alike: ASCII and Latin-1 letters to lower case, runs of ASCII characters
that are neither letters nor digits, and of Unicode's spaces, punctuation, control and format
characters, to one space.  Other characters beyond ASCII, symbols too, stay as they are.  An item of n bytes may be found with up to k = n // 20 edited bytes.
Cut into k + 1 pieces, at least one piece of every such occurrence is unedited, so exact piece
hits find all candidates: each piece is looked up by a hash of its first bytes (the largest power
of two that fits, at most 16) at every byte of a document, vectorised.  A hit whose whole piece
agrees is verified with Myers' bit-parallel distance on the window that its place in the item
leaves.

The items are a stated query set: they are read in blocks of at most BLOCK_BYTES, each block is
shipped to the tasks once and run against all documents, which are neither shuffled nor split.

Defined results: a null text is empty; an empty document has no hits; items whose normalised
text is empty are left out, items of equal text are found together, each id once; an item without
an id is found with a null ``item_id``; repeated documents are each
searched; an empty table on either side gives no hits; columns of the documents are kept (a
column ``hits`` of the input is replaced).
"""
from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bytes_np as B
from .common import read, set_aside, ship, shipped

#: One edited byte is allowed for so many bytes of an item.
BYTES_PER_EDIT = 20
BLOCK_BYTES = 8_000_000
HITS = "array<struct<item_id:bigint,distance:int,first:int,past:int>>"

_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

#: Code points beyond ASCII that are no part of a word.
_GAPS = np.array([c for c in range(0x80, sys.maxunicode + 1)
                  if (kind := unicodedata.category(chr(c)))[0] in "ZP" or kind in ("Cc", "Cf")], np.int32)


def gap_bytes(buf: np.ndarray) -> np.ndarray:
    """Places of all bytes of the characters in ``_GAPS``."""
    is_gap = np.zeros(sys.maxunicode + 1, bool)
    is_gap[_GAPS] = True
    out = []
    for least, past, n in ((0xC2, 0xE0, 2), (0xE0, 0xF0, 3), (0xF0, 0xF8, 4)):
        lead = np.flatnonzero((buf >= least) & (buf < past))
        code = buf[lead].astype(np.int32) & (0x7F >> n)
        for k in range(1, n):
            code = code << 6 | buf[lead + k] & 0x3F
        out += [lead[is_gap[code]] + k for k in range(n)]
    return np.concatenate(out)


def normalised(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, offsets, place of each byte in ``buf``) with one space between and after words."""
    low = B.LOWER[buf]
    if len(low) > 1:
        upper = (buf[:-1] == 0xC3) & (buf[1:] >= 0x80) & (buf[1:] <= 0x9E) & (buf[1:] != 0x97)
        low[1:][upper] += 0x20
    letter = _LETTER[low]
    letter[gap_bytes(buf)] = False
    low[~letter] = 0x20
    before = np.zeros(len(low), bool)
    before[1:] = letter[:-1]
    inner = offs[:-1][offs[:-1] < offs[1:]]
    before[inner] = False
    place = np.flatnonzero(letter | before)
    return low[place], np.searchsorted(place, offs), place


def edged(buf: np.ndarray, offs: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Normalised texts with one more space on either side (its place is -1)."""
    at = np.stack([offs[:-1], offs[1:]], 1).ravel()
    return np.insert(buf, at, 0x20), offs + 2 * np.arange(len(offs)), np.insert(place, at, -1)


def gram_hashes(buf: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` (a power of two) bytes from each place on."""
    h, step = buf.astype(np.uint64) + np.uint64(1), 1
    while step < width:
        h = h[:-step] * np.uint64(0x9E3779B97F4A7C15) + (h[step:] ^ (h[step:] >> np.uint64(31)))
        step *= 2
    return h * np.uint64(0xD6E8FEB86659FD93) if len(h) else h


def myers(pattern: bytes, text: bytes) -> tuple[int, int]:
    """(least edit distance of the pattern to a part of the text, first end of such a part)."""
    m, eq = len(pattern), {}
    for i, c in enumerate(pattern):
        eq[c] = eq.get(c, 0) | 1 << i
    ones, top = (1 << m) - 1, 1 << m - 1
    up, down, score = ones, 0, m
    best, end = m, 0
    for i, c in enumerate(text, 1):
        e = eq.get(c, 0)
        d = (((e & up) + up) ^ up) | e | down
        more = down | ~(d | up) & ones
        less = up & d
        score += bool(more & top) - bool(less & top)
        more, less = more << 1 & ones, less << 1 & ones
        up = less | ~(d | more) & ones
        down = more & d
        if score < best:
            best, end = score, i
    return best, end


class Pieces:
    """The pieces of a block of items, by a hash of their first bytes."""

    def __init__(self, items: list[tuple[bytes, list[int | None]]], bytes_per_edit: int):
        self.items = items
        self.edits = [(len(t) - 2) // bytes_per_edit for t, _ in items]  # the spaces on either side do not count
        found: dict[int, dict[int, list[tuple[int, int, int]]]] = {}
        for n, (t, _) in enumerate(items):
            cuts = np.linspace(0, len(t), self.edits[n] + 2).astype(int)
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                width = 1 << min(4, int(hi - lo).bit_length() - 1)
                h = int(gram_hashes(np.frombuffer(t[lo:lo + width], np.uint8), width)[0])
                found.setdefault(width, {}).setdefault(h, []).append((n, int(lo), int(hi)))
        self.by_width = {}
        for width, of in found.items():
            keys = np.array(sorted(of), np.uint64)
            seen = np.zeros(1 << 20, bool)
            seen[(keys >> np.uint64(44)).astype(np.int64)] = True
            self.by_width[width] = (keys, seen, [of[int(k)] for k in keys])

    def hits(self, buf: np.ndarray) -> Iterator[tuple[int, list[tuple[int, int, int]]]]:
        """(place, pieces that may begin there)."""
        for width, (keys, seen, pieces) in self.by_width.items():
            if len(buf) < width:
                continue
            h = gram_hashes(buf, width)
            at = np.flatnonzero(seen[(h >> np.uint64(44)).astype(np.int64)])
            k = np.minimum(np.searchsorted(keys, h[at]), len(keys) - 1)
            ok = keys[k] == h[at]
            yield from zip(at[ok].tolist(), (pieces[i] for i in k[ok]))


def occurrences(pieces: Pieces, buf: np.ndarray, offs: np.ndarray) -> dict[int, list[tuple[int, int, int, int]]]:
    """By document: (item number, distance, first, past) of the verified occurrences, best first."""
    out: dict[int, list[tuple[int, int, int, int]]] = {}
    raw = buf.tobytes()
    for at, starts in pieces.hits(buf):
        doc = int(np.searchsorted(offs, at, "right")) - 1
        lo, hi = int(offs[doc]), int(offs[doc + 1])
        for n, p, q in starts:
            text, k = pieces.items[n][0], pieces.edits[n]
            if at + q - p > hi or raw[at:at + q - p] != text[p:q]:
                continue
            mine = out.setdefault(doc, [])
            if any(x[0] == n and x[2] <= at - lo < x[3] for x in mine):
                continue
            a, b = max(lo, at - p - k), min(hi, at - p + len(text) + k)
            distance, end = myers(text, raw[a:b])
            if distance <= k:
                back = myers(text[::-1], raw[a:a + end][::-1])[1]
                mine.append((n, distance, a + end - back - lo, a + end - lo))
    return {d: x for d, x in out.items() if x}


def item_blocks(items: DataFrame, bytes_per_edit: int = BYTES_PER_EDIT, block_bytes: int = BLOCK_BYTES) -> Iterator[Pieces]:
    """The items in blocks of bounded bytes, as they come from the executors."""
    def block() -> Pieces:
        return Pieces(sorted((t, sorted(i, key=lambda x: (x is not None, x))) for t, i in known.items()), bytes_per_edit)

    known, size = {}, 0
    for r in items.where("text is not null").groupBy("text").agg(F.collect_set(F.struct("item_id")).alias("ids")).toLocalIterator():
        arr = pa.array([r["text"]])
        for _, _, buf, offs in B.chunks(arr):
            text = normalised(buf, offs)[0].tobytes().strip()
            if text:
                known.setdefault(b" " + text + b" ", set()).update(x["item_id"] for x in r["ids"])
                size += len(text)
        if size >= block_bytes:
            yield block()
            known, size = {}, 0
    if known:
        yield block()


def _with_hits(docs: DataFrame, pieces: Pieces) -> DataFrame:
    sent = ship(docs.sparkSession, pieces)
    at, new = docs.columns.index("text"), "_new"
    while new in docs.columns:
        new += "_"

    def run(batches):
        own = shipped(sent)
        for batch in batches:
            for a, b, buf, offs in B.chunks(batch.column(at)):
                norm, noffs, place = edged(*normalised(buf, offs))
                found = occurrences(own, norm, noffs)
                points = np.cumsum((buf & 0xC0) != 0x80) if found else None
                rows = []
                for i in range(b - a):
                    rows.append([])
                    for n, distance, first, past in found.get(i, ()):
                        base = points[offs[i] - 1] if offs[i] else 0
                        inside = np.flatnonzero(norm[noffs[i] + first:noffs[i] + past] != 0x20)  # without the spaces about it
                        span = [int(points[place[noffs[i] + first + x]] - base) for x in (inside[0], inside[-1])]
                        rows[-1] += [{"item_id": item, "distance": distance, "first": span[0] - 1, "past": span[1]}
                                     for item in own.items[n][1]]
                kind = pa.list_(pa.struct([("item_id", pa.int64()), ("distance", pa.int32()), ("first", pa.int32()), ("past", pa.int32())]))
                yield pa.RecordBatch.from_arrays(batch.slice(a, b - a).columns + [pa.array(rows, kind)], batch.schema.names + [new])

    schema = ", ".join(f"`{n}` {t}" for n, t in docs.dtypes)
    return (docs.mapInArrow(run, f"{schema}, `{new}` {HITS}")
            .withColumn("hits", F.concat("hits", new)).drop(new))


def find_items(docs: DataFrame, items: DataFrame, bytes_per_edit: int = BYTES_PER_EDIT) -> DataFrame:
    """``docs`` (with text) plus ``hits``: item_id, distance in bytes, span in code points."""
    out = docs.withColumn("hits", F.array().cast(HITS))
    for pieces in item_blocks(items, bytes_per_edit):
        out = _with_hits(out, pieces)
    return out


def decontaminated(docs: DataFrame, items: DataFrame, bytes_per_edit: int = BYTES_PER_EDIT) -> DataFrame:
    """The documents in which no item occurs."""
    inner, back = set_aside(docs, ("text",))
    return find_items(inner, items, bytes_per_edit).where(F.size("hits") == 0).select(*back)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_items(docs, read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", (F.size("hits") > 0).alias("contaminated"), (F.size("hits") == 0).alias("kept"),
        F.sort_array(F.array_distinct(F.transform("hits", lambda h: h["item_id"]))).alias("item_ids"),
        F.array_min(F.transform("hits", lambda h: h["distance"])).alias("least_distance"),
        F.sort_array("hits").alias("hits"))
