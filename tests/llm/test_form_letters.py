"""Operator 5 on texts that share much but not enough, and in blocks."""
import itertools
import random

import pytest

from ledgerkit.llm import neardup
from test_neardup import brute_components, shingle_set


def form_letters(n, fields=24, seed=1):
    """Letters on one form, each field with one of two values; a few are copies with one field changed."""
    rng = random.Random(seed)
    parts = [[f"p{f}w{k}" for k in range(12)] for f in range(fields + 1)]
    rows, chosen = [], []
    for i in range(n):
        if chosen and rng.random() < 0.05:
            pick = list(rng.choice(chosen))
            pick[rng.randrange(fields)] ^= 1
        else:
            pick = [rng.randrange(2) for _ in range(fields)]
        chosen.append(pick)
        words = list(itertools.chain.from_iterable(p + ([f"v{f}x{pick[f]}"] if f < fields else []) for f, p in enumerate(parts)))
        rows.append((i + 1, " ".join(words)))
    return rows


def checked(spark, monkeypatch, rows):
    """(result, pairs checked on full sets)."""
    counts = []
    plain = neardup.confirmed
    monkeypatch.setattr(neardup, "confirmed", lambda pairs, *rest: (counts.append(pairs.count()), plain(pairs, *rest))[1])
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    monkeypatch.setattr(neardup, "confirmed", plain)
    return got, sum(counts)


@pytest.mark.parametrize("n", [300])
def test_form_letters_are_told_apart_without_checking_all_pairs(spark, monkeypatch, n):
    rows = form_letters(n)
    got, pairs = checked(spark, monkeypatch, rows)
    want = {d: c for d, (_, c) in brute_components(rows).items()}
    sets = [shingle_set(t) for _, t in rows]
    near = sum(100 * len(a & b) >= 72 * len(a | b) for a, b in itertools.combinations(sets, 2))
    assert got == want
    assert pairs <= 4 * n + near  # one a class and turn, and those whose signatures may belong to a link


def test_blocks_of_the_last_round_lose_no_pair(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK_ROWS", 8)
    monkeypatch.setattr(neardup, "drawn_pairs", lambda keys, *rest: keys.select(neardup.F.col("node").alias("a"), neardup.F.col("node").alias("b")).limit(0))
    rows = form_letters(120, fields=6)
    got, _ = checked(spark, monkeypatch, rows)
    assert got == {d: c for d, (_, c) in brute_components(rows).items()}
