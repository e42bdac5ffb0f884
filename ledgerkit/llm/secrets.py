"""Operator 9, secret scans: one deterministic automaton for all rules.

Each rule is a regular expression in a small notation (literals, classes, groups, alternation,
``? * + {n,}``).  Subset construction runs over all rules at once; a state holds, for each rule,
its threads in the order of preference of a leftmost search: a younger thread is dropped once an
older one has matched, and when a rule's threads die after a match the rule starts anew on the
same byte.  So the automaton itself yields leftmost, non-overlapping matches of every rule, and
one pass over the bytes serves all rules.  Minimisation merges equal states; the result is one
transition array over classes of bytes.

The pass is vectorised: a batch is cut into lanes that advance together, each from the start
state; a lane whose true state at its first byte is another is run again from there until both
agree, mostly after a few bytes.  A match ends where a rule's accepting run ends; its start is
found by the automaton of the reversed rule, back from the end.

Rules must stay matched until their threads die (a class with ``+`` at the end does); this is
checked.  A length below a rule's least drops the match after it has been consumed.

Defined results: a null text is empty and an empty text has no spans; rows that repeat are
scanned alike; an empty table gives no rows; columns of the documents are kept (``found`` wins
over an equal name).
"""
from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bytes_np as B
from .common import read, text_of

_VALUE = r"[A-Za-z0-9+/_.=\-]"
#: kind, expression, letters in either case, least length in bytes, the tail class whose run has that length (or none: all).
RULES = (
    ("assign", r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?" + _VALUE + "+", True, 8, _VALUE),
    ("access", r"AKIA[A-Z0-9]+", False, 16, None),
    ("hex", r"[0-9a-f]{32,}", False, 32, None),
    ("github", r"gh[pousr]_[A-Za-z0-9]+", False, 40, None),
    ("pem", r"-----BEGIN\x20[A-Z\x20]*PRIVATE\x20KEY-----", False, 27, None),
)
BASE = ("assign", "access", "hex")
SPANS = "array<struct<first:int,past:int,kind:string>>"


# -- expressions to threads -------------------------------------------------------------------

class _Program:
    """Thread program of one rule: lists of (set of bytes, next) and of preferred jumps."""

    def __init__(self, expression: str, any_case: bool, backwards: bool = False):
        self.text, self.at, self.any_case = expression, 0, any_case
        tree = self._choice()
        assert self.at == len(expression), expression
        self.step: list[frozenset[int] | None] = []
        self.to: list[list[int]] = []
        self.end = self._node(None, [])
        self.begin = self._build(_reversed(tree) if backwards else tree, self.end)

    def _choice(self):
        parts = [self._sequence()]
        while self.at < len(self.text) and self.text[self.at] == "|":
            self.at += 1
            parts.append(self._sequence())
        return ("or", parts) if len(parts) > 1 else parts[0]

    def _sequence(self):
        parts = []
        while self.at < len(self.text) and self.text[self.at] not in "|)":
            atom = self._atom()
            while self.at < len(self.text) and self.text[self.at] in "?*+{":
                c = self.text[self.at]
                self.at += 1
                if c == "{":
                    close = self.text.index(",}", self.at)
                    n, self.at = int(self.text[self.at:close]), close + 2
                    atom = ("and", [atom] * n + [("*", atom)])
                else:
                    atom = ("and", [atom, ("*", atom)]) if c == "+" else (c, atom)
            parts.append(atom)
        return ("and", parts)

    def _byte(self) -> int:
        c = self.text[self.at]
        self.at += 1
        if c != "\\":
            return ord(c)
        c = self.text[self.at]
        self.at += 1
        if c == "x":
            self.at += 2
            return int(self.text[self.at - 2:self.at], 16)
        return ord(c)

    def _atom(self):
        if self.text[self.at] == "(":
            self.at += 1
            inner = self._choice()
            self.at += 1
            return inner
        if self.text[self.at] != "[":
            b = self._byte()
            both = {b, ord(chr(b).swapcase())} if self.any_case and chr(b).isalpha() else {b}
            return ("set", frozenset(both))
        self.at += 1
        own = set()
        while self.text[self.at] != "]":
            lo = hi = self._byte()
            if self.text[self.at] == "-":
                self.at += 1
                hi = self._byte()
            own |= set(range(lo, hi + 1))
        self.at += 1
        return ("set", frozenset(own))

    def _node(self, step, to) -> int:
        self.step.append(step)
        self.to.append(to)
        return len(self.step) - 1

    def _build(self, tree, after: int) -> int:
        kind, arg = tree
        if kind == "set":
            return self._node(arg, [after])
        if kind == "and":
            for part in reversed(arg):
                after = self._build(part, after)
            return after
        if kind == "or":
            return self._node(None, [self._build(part, after) for part in arg])
        loop = self._node(None, [])
        self.to[loop] = [self._build(arg, loop if kind == "*" else after), after]
        return loop

    def threads(self, starts: list[int]) -> tuple[int, ...]:
        """The threads that wait for a byte (or have matched) from the starts, preferred first."""
        seen, out, stack = set(), [], list(reversed(starts))
        while stack:
            n = stack.pop()
            if n in seen:
                continue
            seen.add(n)
            if self.step[n] is not None or n == self.end:
                out.append(n)
            else:
                stack.extend(reversed(self.to[n]))
        return tuple(out)


def _reversed(tree):
    kind, arg = tree
    if kind == "and":
        return (kind, [_reversed(x) for x in reversed(arg)])
    if kind == "or":
        return (kind, [_reversed(x) for x in arg])
    return tree if kind == "set" else (kind, _reversed(arg))


def _classes(programs: list[_Program]) -> tuple[np.ndarray, list[int]]:
    """(class of each byte, one byte of each class): bytes that no rule tells apart are one class."""
    sets = sorted({s for p in programs for s in p.step if s is not None}, key=sorted)
    sign = [tuple(b in s for s in sets) for b in range(256)]
    order = {x: i for i, x in enumerate(dict.fromkeys(sign))}
    return np.array([order[x] for x in sign], np.uint8), [sign.index(x) for x in order]


# -- subset construction and minimisation -----------------------------------------------------

def _search_step(p: _Program, state: tuple, byte: int) -> tuple:
    """A rule's state is (threads, matched): threads of a leftmost search after each byte."""
    threads, matched = state
    moved = [p.to[t][0] for t in threads if t != p.end and byte in p.step[t]]
    alive = p.threads(moved)
    if matched and not alive:  # the match ended before this byte; the rule starts anew on it
        return _search_step(p, (p.threads([p.begin]), False), byte)
    if not matched:
        alive = p.threads(moved + [p.begin])
    if p.end in alive:
        return alive[:alive.index(p.end) + 1], True
    if matched:
        raise ValueError("a rule must stay matched until its threads die")
    return alive, False


def _minimised(table: np.ndarray, mark: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(table, marks) with equal states merged (partition refinement); the start state stays first."""
    group = np.unique(mark, axis=0, return_inverse=True)[1].ravel()
    while True:
        finer = np.unique(np.c_[group, group[table]], axis=0, return_inverse=True)[1].ravel()
        if finer.max() == group.max():
            break
        group = finer
    _, first = np.unique(group, return_index=True)
    order = np.argsort(first, kind="stable")
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    keep = np.sort(first)
    return rank[group[table[keep]]], mark[keep]


@lru_cache
def automaton(rules: tuple = RULES) -> dict:
    """Transition array of the combined search, marks of the states, automata of the reversed rules."""
    programs = [_Program(e, c) for _, e, c, _, _ in rules]
    of_byte, byte_of = _classes(programs)
    start = tuple((p.threads([p.begin]), False) for p in programs)
    number, todo, rows = {start: 0}, [start], []
    steps: list[dict] = [{} for _ in programs]
    while todo:
        state, todo = todo[0], todo[1:]
        row = []
        for b in byte_of:
            to = []
            for p, known, s in zip(programs, steps, state):
                if (s, b) not in known:
                    known[s, b] = _search_step(p, s, b)
                to.append(known[s, b])
            to = tuple(to)
            if to not in number:
                number[to] = len(number)
                todo.append(to)
            row.append(number[to])
        rows.append(row)
    mark = np.array([[m for _, m in s] for s in number])
    table, mark = _minimised(np.array(rows), mark)
    back = []
    for _, expression, any_case, _, _ in rules:
        p = _Program(expression, any_case, backwards=True)
        first = p.threads([p.begin])
        number, todo, rows = {first: 0}, [first], []
        while todo:
            state, todo = todo[0], todo[1:]
            row = []
            for b in byte_of:
                to = p.threads([p.to[t][0] for t in state if t != p.end and b in p.step[t]])
                if to not in number:
                    number[to] = len(number)
                    todo.append(to)
                row.append(number[to] if to else -1)
            rows.append(row)
        back.append((rows, [p.end in s for s in number]))
    return {"class": of_byte, "table": table.astype(np.int32), "mark": mark, "back": back, "tails": {tail: _members(tail) for *_, tail in rules if tail is not None}}


# -- the pass ---------------------------------------------------------------------------------

LANE = 2048


def _states(auto: dict, cls: np.ndarray) -> np.ndarray:
    """The state after each byte, over the whole buffer from the start state."""
    table, n = auto["table"], len(cls)
    width = table.shape[1]
    flat = (table * width).ravel()  # states scaled by the width, so a step is one addition and lookup
    lanes = max(1, -(-n // LANE))
    grid = np.zeros((lanes, LANE), np.int32)
    grid.ravel()[:n] = cls
    grid = np.ascontiguousarray(grid.T)
    out = np.empty_like(grid)
    state = np.zeros(lanes, np.int32)
    for t in range(LANE):
        state = flat[state + grid[t]]
        out[t] = state
    for lane in range(1, lanes):
        s = int(out[-1, lane - 1])
        t = 0
        if s:
            while t < LANE:
                s = int(flat[s + grid[t, lane]])
                if s == out[t, lane]:
                    break
                out[t, lane] = s
                t += 1
    return (out.T.ravel()[:n] // width)


def scan(buf: np.ndarray, offs: np.ndarray, rules: tuple, auto: dict) -> list[tuple[int, int, int, int]]:
    """(document, rule number, first byte, past byte) of all matches, in bytes of ``buf``."""
    # a line feed after each document: no rule has it, so no match goes on and every search starts anew
    n, k = len(buf), len(offs) - 1
    joined = np.full(n + k, 0x0A, np.uint8)
    doc = np.repeat(np.arange(k), np.diff(offs))
    joined[np.arange(n) + doc] = buf
    cls = auto["class"][joined]
    state = _states(auto, cls)
    hit = np.flatnonzero(auto["mark"].any(1)[state])
    found, starts = [], offs[:-1] + np.arange(k)
    for r, (_, _, _, least, tail) in enumerate(rules):
        on = hit[auto["mark"][state[hit], r]]
        past_all = on[np.diff(on, append=-1) != 1] + 1
        rows, ends = auto["back"][r]
        before = -1
        for past in past_all.tolist():
            d = int(np.searchsorted(starts, past - 1, "right")) - 1
            low = max(int(starts[d]), before)
            s, at, first = 0, past, -1
            while at > low:
                s = rows[s][cls[at - 1]]
                if s < 0:
                    break
                at -= 1
                if ends[s]:
                    first = at
            before = past
            if first < 0:
                continue
            size = past - first
            if tail is not None:
                size = _run_length(joined[first:past], auto["tails"][tail])
            if size >= least:
                found.append((d, r, first - d, past - d))
    return found


def _members(tail: str) -> np.ndarray:
    own = np.zeros(256, bool)
    own[list(_Program(tail, False).step[1])] = True
    return own


def _run_length(match: np.ndarray, members: np.ndarray) -> int:
    """Bytes of the value: after the first ``:`` or ``=`` and the blanks and quotes that follow it."""
    at = int(np.flatnonzero((match == 0x3A) | (match == 0x3D))[0]) + 1
    while at < len(match) and match[at] == 0x20:
        at += 1
    if at < len(match) and match[at] in (0x22, 0x27):
        at += 1
    return int(members[match[at:]].sum())


def with_spans(docs: DataFrame, rules: tuple = RULES) -> DataFrame:
    """``docs`` plus ``found``: spans in code points with their kind, by start, then as listed."""
    docs = docs.drop("found")
    at = docs.columns.index("text")
    shipped = docs.sparkSession.sparkContext.broadcast((rules, automaton(rules)))

    def run(batches):
        own, auto = shipped.value
        kind = pa.list_(pa.struct([("first", pa.int32()), ("past", pa.int32()), ("kind", pa.string())]))
        for batch in batches:
            for a, b, buf, offs in B.chunks(batch.column(at)):
                rows: list[list] = [[] for _ in range(b - a)]
                found = scan(buf, offs, own, auto)
                points = np.r_[0, np.cumsum((buf & 0xC0) != 0x80)] if found else None
                for d, r, first, past in sorted(found, key=lambda x: (x[0], x[2], x[1])):
                    base = points[offs[d]]
                    rows[d].append({"first": int(points[first] - base), "past": int(points[past] - base), "kind": own[r][0]})
                yield pa.RecordBatch.from_arrays(batch.slice(a, b - a).columns + [pa.array(rows, kind)], batch.schema.names + ["found"])

    schema = ", ".join(f"`{n}` {t}" for n, t in docs.dtypes)
    return docs.mapInArrow(run, f"{schema}, found {SPANS}")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_spans(read(spark, sf_dir, "documents").select("doc_id", text_of().alias("text")))

    def told(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["first"].cast("string"), s["past"].cast("string"))))

    def count(kind):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("found", lambda s: s["kind"].isin(*BASE))
    return docs.select("doc_id", *[count(k) for k in BASE], F.sha2(told(base), 256).alias("base_sha256"), told(F.col("found")).alias("spans"))
