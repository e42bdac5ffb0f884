"""Operator 4, personal data: keyed surrogates of the same type, format, script and gender.

Found are e-mail addresses, phone numbers, payment card numbers, IPv4 addresses, social security
numbers, valid account numbers (IBAN) and names after a title, with every other mention of such a
name in its text.  An entity is reduced to its canonical value (letters folded to
lower case, digits without separators), the value is replaced by a keyed permutation of all values
of its format (a Feistel network with cycle walking), and the result is written in the format of
the place where it was found.  So a value has the same surrogate everywhere, in any notation, and
two values of one format never share one.  Kept are: the country code, separators and length of a
phone number; issuer digit, length and checksum validity of a card; the pattern of letters and
digits and the last label of an address; title, gender, script and letter case of a name (a given
name and a surname are replaced each for itself, so "Mr Ada Byron" and "Mr Byron" stay together; under
a title without gender a given name has the gender that other titles tell for it, in its text or else anywhere).

Names are drawn by hash from a large set and could meet, and any surrogate could be a real value
of the corpus.  Both are checked over the table of all distinct values: a value whose surrogate is
taken or real gets its next attempt, until none is left.  From the fifth further attempt on a name has
one syllable more each time, so the names never run out, however many a corpus holds.  Only values with a later attempt (few or
none) are carried back to the texts that hold them; everything else follows from the key.

Defined results: a null text stays null, an empty one empty; a text without entities is unchanged;
repeated rows are replaced alike; an empty table gives no rows; columns of the documents are kept
(``entities`` wins over an equal name).
"""
from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache, reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read, set_aside, text_of, written

KEY_CONF, TRIAL_KEY = "spark.ledgerkit.pii.key", "replace this key"
ENTITIES = "array<struct<kind:string,first:int,past:int,surrogate:string>>"
MAX_ATTEMPTS = 40
NARROW_ATTEMPTS = 5  # with the first format of an e-mail address or name; later ones are wider
ROUNDS = 8

_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}")
_NUMERIC = re.compile(r"[\d+(][\d .()+-]*\d")
_NUMBERS = re.compile(
    r"(?P<ip>(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?!\.?\d|\w))"
    r"|(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))"
    r"|(?P<card>(?<![\w+])(?:\d{13,19}|\d{4}(?P<gap>[ -])\d{4}(?P=gap)\d{4}(?P=gap)\d{4}|\d{4}[ -]\d{6}[ -]\d{5})(?!\w))"
    r"|(?P<phone>(?<![\w.])(?:\+\d{1,3}[ .-]?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]\d{3,4}|\(\d{2,4}\)[ -]?\d{3,4}[ -]\d{3,4}|\d{3}-\d{3}-\d{4})(?![\w-]))"
    r"|(?P<abroad>\+\d{1,3}(?:(?P<a>[ .-])\d{1,3}(?:(?P=a)\d{2,3}){3,4}|[ .-]\d{1,4}[ .-]\d{5,9})(?![\w-]))"
    r"|(?P<inland>(?<![\w.+-])(?:0\d(?P<b>[ .-])\d{2}(?:(?P=b)\d{2}){3}|0\d{1,4}[ -]\d{5,9}|\d{3}\.\d{3}\.\d{4})(?![\w-]|\.\d))"
    r"|(?P<wire>\+\d{8,15}(?!\w))")
_IBAN = re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,4})?)(?!\w)")
#: Titles with the gender they tell (none: n).
TITLES = {"Mr": "m", "Mister": "m", "Herr": "m", "Monsieur": "m", "Señor": "m", "Sr": "m", "Г-н": "m", "господин": "m",
          "Mrs": "f", "Ms": "f", "Miss": "f", "Frau": "f", "Madame": "f", "Mme": "f", "Señora": "f", "Sra": "f", "Г-жа": "f", "госпожа": "f",
          "Dr": "n", "Prof": "n"}
_CAPITAL = "A-ZÀ-ÖØ-ÞА-ЯЁ"
_PERSON = re.compile(r"(?<!\w)(?P<title>" + "|".join(sorted(TITLES, key=len, reverse=True)) + rf")(?P<dot>\.? )(?P<names>[{_CAPITAL}][\w'’-]+(?: [{_CAPITAL}][\w'’-]+)?)")
_MENTION = re.compile(rf"(?<!\w)[{_CAPITAL}][\w'’-]+")
_SYLLABLES = {"latin": (list("bdfgklmnprstvz"), list("aeiou")), "cyrillic": (list("бвгдклмнпрстз"), list("аеиоу"))}
_ENDING = {("latin", "m"): "n", ("latin", "f"): "na", ("latin", "n"): "s", ("latin", "s"): "rt",
           ("cyrillic", "m"): "н", ("cyrillic", "f"): "на", ("cyrillic", "n"): "с", ("cyrillic", "s"): "рт"}


# -- the keyed permutation --------------------------------------------------------------------

def permuted(key: str, tweak: str, value: int, size: int) -> int:
    """A keyed permutation of range(size), another one for each tweak."""
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    while True:
        left, right = value >> half, value & mask
        for r in range(ROUNDS):
            told = f"{key}\0{tweak}\0{size}\0{r}\0{right}".encode()
            f = int.from_bytes(hashlib.shake_256(told).digest((half + 7) // 8), "big") & mask
            left, right = right, left ^ f
        value = left << half | right
        if value < size:
            return value


def _walk(key: str, tweak: str, digits: str, allowed) -> str:
    """The digits permuted among the strings of their length that are ``allowed`` (as they are)."""
    n, value = len(digits), int(digits)
    while True:
        value = permuted(key, f"{tweak}:{n}", value, 10 ** n)
        if allowed(out := f"{value:0{n}d}"):
            return out


def _same_pattern(key: str, tweak: str, text: str) -> str:
    """Letters become letters, digits digits, all else stays; a permutation of each pattern."""
    radix = [26 if c.isalpha() else 10 if c.isdigit() else 1 for c in text]
    size = reduce(lambda a, b: a * b, radix, 1)
    if size == 1:
        return text
    value = 0
    for c, r in zip(text, radix):
        value = value * r + (ord(c) - 97 if r == 26 else int(c) if r == 10 else 0)
    pattern = "".join("a" if r == 26 else "0" if r == 10 else c for c, r in zip(text, radix))
    value = permuted(key, f"{tweak}:{pattern}", value, size)
    out = []
    for c, r in zip(reversed(text), reversed(radix)):
        value, digit = divmod(value, r)
        out.append(chr(97 + digit) if r == 26 else str(digit) if r == 10 else c)
    return "".join(reversed(out))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def surrogate(key: str, kind: str, value: str, attempt: int = 0) -> str:
    """The canonical surrogate of a canonical value."""
    tweak = f"{kind}:{attempt}"
    if kind == "email":
        local, _, host = value.partition("@")
        *labels, last = host.split(".")
        wider = f"{int.from_bytes(hashlib.shake_256(f'{key}{tweak}{value}'.encode()).digest(4), 'big') % 10000:04d}" if attempt >= NARROW_ATTEMPTS else ""
        return _same_pattern(key, tweak, local) + wider + "@" + ".".join([_same_pattern(key, f"{tweak}:host", x) for x in labels] + [last])
    if kind == "phone":
        lead = value[0] >= "2"
        return _walk(key, tweak, value, lambda x: (x[0] >= "2") == lead)
    if kind == "card":
        return _walk(key, tweak, value, lambda x: x[0] == value[0] and luhn(x) == luhn(value))
    if kind == "ssn":
        fine = lambda x: x[:3] not in ("000", "666") and x[0] != "9"
        return _walk(key, tweak, value, lambda x: fine(x) == fine(value))
    if kind == "ip":
        number = reduce(lambda a, b: a * 256 + int(b), value.split("."), 0)
        public = lambda x: 0 < x >> 24 < 224
        wanted = public(number)
        while True:
            number = permuted(key, tweak, number, 2 ** 32)
            if public(number) == wanted:
                return ".".join(str(number >> s & 255) for s in (24, 16, 8, 0))
    if kind == "iban":
        return _walk_iban(key, tweak, value)
    _, script, gender = kind.split("-")
    consonants, vowels = _SYLLABLES[script]
    syllables = 3 + max(0, attempt - NARROW_ATTEMPTS + 1)
    draw = int.from_bytes(hashlib.shake_256(f"{key}\0{tweak}\0{value}".encode()).digest(5 + syllables), "big")
    out = ""
    for _ in range(syllables):
        draw, c = divmod(draw, len(consonants))
        draw, v = divmod(draw, len(vowels))
        out += consonants[c] + vowels[v]
    return out + _ENDING[script, gender]


# -- finding and writing ----------------------------------------------------------------------

def _cased(like: str, text: str) -> str:
    if len(like) > 1 and like.isupper():
        return text.upper()
    return text[:1].upper() + text[1:] if like[:1].isupper() else text


def _digits_into(place: str, digits: str) -> str:
    """The digits written over the last digits of ``place``; separators and leading digits stay."""
    out, left = [], list(digits)
    for c in reversed(place):
        out.append(left.pop() if c.isdigit() and left else c)
    return "".join(reversed(out))


def _iban_number(value: str) -> int:
    """The number whose remainder by 97 tells whether an account number is valid."""
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4]))


def _walk_iban(key: str, tweak: str, value: str) -> str:
    """Country and pattern stay; the check digits fit the new number."""
    body = _same_pattern(key, tweak, value[4:].lower()).upper()
    return f"{value[:2]}{98 - _iban_number(value[:2] + '00' + body) % 97:02d}{body}"


def _letters_into(place: str, value: str) -> str:
    """The characters of a value over those of ``place``; its blanks stay."""
    left = iter(value)
    return "".join(c if c == " " else next(left) for c in place)


def _script(name: str) -> str:
    return "cyrillic" if re.search("[А-яЁё]", name) else "latin"


def _ibans(text: str) -> Iterator[tuple[int, int, str, str]]:
    for m in _IBAN.finditer(text):
        said = m[0]
        while said:  # words in capitals may follow
            value = said.replace(" ", "")
            if 15 <= len(value) <= 34 and _iban_number(value) % 97 == 1:
                yield m.start(), m.start() + len(said), "iban", value
                break
            said = said.rpartition(" ")[0]


def _name(said: str) -> str:
    """A name without the ending of a genitive and without marks at its end."""
    return re.sub(r"(?:['’]s|['’-]+)$", "", said)


def _names(text: str) -> list[tuple[int, int, str, str]]:
    """Names after a title, and every other mention of them in the text.

    A given name has the gender that titles of the text tell for it, also where its own tells none;
    two genders told for one name (two people) keep theirs, and a third mention has the first."""
    titled = []
    for m in _PERSON.finditer(text):
        at, names = m.start("names"), m["names"].split(" ")
        for i, said in enumerate(names):
            name = _name(said)
            titled.append((at, name, "s" if i == len(names) - 1 else TITLES[m["title"]]))
            at += len(said) + 1
    if not titled:
        return []
    given, surnames = {}, set()
    for _, name, role in titled:
        if role == "s":
            surnames.add(name.lower())
        elif given.get(name.lower(), "n") == "n":
            given[name.lower()] = role
    out, seen = [], set()

    def add(at: int, name: str, role: str) -> None:
        seen.add(at)
        out.append((at, at + len(name), f"name-{_script(name)}-{role}", name.lower()))

    for at, name, role in titled:
        add(at, name, given[name.lower()] if role == "n" else role)
    words = [(m.start(), _name(m[0])) for m in _MENTION.finditer(text)]
    for k, (at, name) in enumerate(words):
        value = name.lower()
        if at in seen or value not in given and value not in surnames:
            continue
        then = k + 1 < len(words) and words[k + 1][0] == at + len(name) + 1 and words[k + 1][1].lower() in surnames
        add(at, name, given[value] if value in given and (then or value not in surnames) else "s")
    return out


def find(text: str) -> list[tuple[int, int, str, str]]:
    """(first, past, kind, canonical value) of all entities, by place; of two that overlap the first counts."""
    out = list(_ibans(text))
    if "@" in text:
        out += [(m.start(), m.end(), "email", m[0].lower()) for m in _EMAIL.finditer(text)]
    taken = [(a, b) for a, b, *_ in out]
    for run in _NUMERIC.finditer(text):
        if run.end() - run.start() < 7:
            continue
        for m in _NUMBERS.finditer(text, run.start(), run.end()):
            if any(a < m.end() and m.start() < b for a, b in taken):
                continue
            kind, digits = next(k for k in ("ip", "ssn", "card", "phone", "abroad", "inland", "wire") if m[k]), re.sub(r"\D", "", m[0])
            if kind == "ip":
                parts = m[0].split(".")
                if max(map(int, parts)) > 255:
                    continue
                out.append((m.start(), m.end(), "ip", ".".join(str(int(p)) for p in parts)))
            elif kind in ("phone", "abroad", "inland", "wire"):
                if kind == "abroad":  # so that +49 30 123456 and 030 123456 are one number
                    digits = re.sub(r"\D", "", re.split("[ .-]", m[0], maxsplit=1)[1])
                elif kind == "inland":
                    digits = digits.removeprefix("0")
                if len(digits) >= 7:  # else a country code of up to three digits stays
                    out.append((m.start(), m.end(), "phone", digits[-max(10, len(digits) - 3):]))
            else:
                out.append((m.start(), m.end(), kind, digits))
    return sorted(out + _names(text))


def written_as(place: str, kind: str, value: str) -> str:
    """A canonical surrogate in the notation of the place that it goes to."""
    if kind in ("phone", "card", "ssn"):
        return _digits_into(place, value)
    if kind == "iban":
        return _letters_into(place, value)
    return _cased(place, value)


def replaced(text: str, key: str, later: dict[tuple[str, str], tuple[str, int]], of: Callable = surrogate) -> tuple[str, list[dict]]:
    """The text with surrogates (as ``of`` gives them) and the entities' spans in it.  ``later`` holds
    the kind and attempt of values that do not have their own kind and the first attempt."""
    out, at, size, spans = [], 0, 0, []
    for first, past, kind, value in find(text):
        if first < at:
            continue
        kind, attempt = later.get((kind, value), (kind, 0))
        new = written_as(text[first:past], kind, of(key, kind, value, attempt))
        size += first - at
        spans.append({"kind": kind, "first": size, "past": size + len(new), "surrogate": new})
        size += len(new)
        out += [text[at:first], new]
        at = past
    return "".join(out) + text[at:], spans


# -- over all documents -----------------------------------------------------------------------

def entities(docs: DataFrame) -> DataFrame:
    """(text_hash, kind, value): the canonical values of each text, each once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, kinds, values = [], [], []
            for t, text in zip(batch.column("text_hash").to_pylist(), batch.column("text")):
                for kind, value in sorted({x[2:] for x in find(text.as_py())}):
                    h.append(t)
                    kinds.append(kind)
                    values.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), pa.array(kinds, pa.string()), pa.array(values, pa.string())], ["text_hash", "kind", "value"])
    return docs.select(F.xxhash64(text_of()).alias("text_hash"), text_of().alias("text")).mapInArrow(run, "text_hash long, kind string, value string")


def _attempted(values: DataFrame, key: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("kind", "value", "attempt")]
            yield pa.RecordBatch.from_arrays(batch.columns + [pa.array([surrogate(key, *x) for x in zip(*cols)], pa.string())], ["kind", "value", "attempt", "surrogate"])
    # by rows, not bytes: many values are few bytes, and Spark would pack them into one task (by another
    # expression than the distinct values lie by, else Spark takes their partitions for these)
    tasks = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = values.select("kind", "value", "attempt").repartition(tasks, F.xxhash64("kind", "value"))
    return spread.mapInArrow(run, "kind string, value string, attempt int, surrogate string")


def surrogate_table(values: DataFrame, key: str) -> DataFrame:
    """(kind, value, attempt, surrogate): surrogates that are distinct and no value of the corpus.

    An attempt has its turn's number, not the value's own count: a value that gives way late goes
    straight to the wider formats, else each would push another out of the narrow one."""
    table = written(_attempted(values.select("kind", "value").distinct().withColumn("attempt", F.lit(0)), key), "surrogates")
    for turn in range(1, MAX_ATTEMPTS + 1):
        real = table.select("kind", F.col("value").alias("surrogate"))
        meets = table.join(real, ["kind", "surrogate"], "left_semi").select("kind", "value")
        holder = (table.groupBy("kind", "surrogate").agg(F.count("*").alias("n"), F.min_by("value", F.struct(-F.col("attempt"), F.col("value"))).alias("holder"))
                  .where("n > 1").drop("n"))
        shared = table.join(holder, ["kind", "surrogate"]).where("value != holder").select("kind", "value")
        again = written(meets.union(shared).distinct().withColumn("again", F.lit(1)), "again")
        if again.isEmpty():
            return table
        tried = table.join(again, ["kind", "value"], "left")
        stay = tried.where("again is null").select("kind", "value", "attempt", "surrogate")
        move = tried.where("again = 1").select("kind", "value", F.lit(turn).alias("attempt"))
        table = written(stay.unionByName(_attempted(move, key)), "surrogates")
    raise ValueError(f"no distinct surrogates after {MAX_ATTEMPTS} attempts: a format has too few values")


def told_genders(found: DataFrame) -> DataFrame:
    """(kind, value, told): given names under titles without a gender that others tell (told both: female),
    with the kind that they then have."""
    names = found.where("kind like 'name-%' and kind not like '%-s'").select("kind", "value").distinct()
    stem = F.substring_index("kind", "-", 2)
    told = names.where("kind not like '%-n'").groupBy(stem.alias("stem"), "value").agg(F.min("kind").alias("told"))
    return names.where("kind like '%-n'").withColumn("stem", stem).join(told, ["stem", "value"]).select("kind", "value", "told")


def with_surrogates(docs: DataFrame, key: str | None = None) -> DataFrame:
    """``docs`` with text replaced, plus ``entities``: kind, span in the new text, surrogate.  Without a
    key the session's ``spark.ledgerkit.pii.key`` is taken."""
    spark = docs.sparkSession
    key = key or spark.conf.get(KEY_CONF, None)
    if not key:
        raise ValueError(f"no key: give one, or set {KEY_CONF}")
    docs, back = set_aside(docs.drop("entities"), ("text",))
    found = written(entities(docs), "entities")
    as_kind = written(told_genders(found), "genders")
    values = found.select("kind", "value").distinct().join(as_kind, ["kind", "value"], "left")
    values = written(values.select("kind", "value", F.coalesce("told", "kind").alias("as_kind")), "values")
    table = surrogate_table(values.select(F.col("as_kind").alias("kind"), "value"), key)
    tried = table.select(F.col("kind").alias("as_kind"), "value", "attempt")
    later = values.join(tried, ["as_kind", "value"]).where("attempt > 0 or as_kind != kind")
    none = F.lit(None).cast("array<struct<kind:string,value:string,as_kind:string,attempt:int>>")
    if later.isEmpty():
        rows = docs.withColumn("_later", none)
    else:  # Spark sees the size of this table and joins accordingly
        by_text = written(found.join(later, ["kind", "value"]).groupBy("text_hash")
                          .agg(F.collect_list(F.struct("kind", "value", "as_kind", "attempt")).alias("_later")), "later")
        rows = docs.withColumn("text_hash", F.xxhash64(text_of())).join(by_text, "text_hash", "left").drop("text_hash")
    columns = docs.columns
    at = columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = lru_cache(100_000)(surrogate)  # made here: a cache in the module would tie the task to the module
        kind = pa.list_(pa.struct([("kind", pa.string()), ("first", pa.int32()), ("past", pa.int32()), ("surrogate", pa.string())]))
        for batch in batches:
            texts, spans = [], []
            for text, later in zip(batch.column(at), batch.column("_later")):
                own = {(x["kind"], x["value"]): (x["as_kind"], x["attempt"]) for x in later.as_py() or []}
                new, where = (None, []) if not text.is_valid else replaced(text.as_py(), key, own, known)
                texts.append(new)
                spans.append(where)
            cols = [batch.column(c) for c in columns]
            cols[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(cols + [pa.array(spans, kind)], columns + ["entities"])

    schema = ", ".join(f"`{n}` {t}" for n, t in docs.dtypes)
    return rows.select(*columns, "_later").mapInArrow(run, f"{schema}, entities {ENTITIES}").select(*back, "entities")


def op4_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key is the session's ``spark.ledgerkit.pii.key``; trial runs without one take a placeholder."""
    out = with_surrogates(read(spark, sf_dir, "documents").select("doc_id", "text"), spark.conf.get(KEY_CONF, None) or TRIAL_KEY)
    count = lambda kind: F.size(F.filter("entities", lambda e: e["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return out.select("doc_id", "text", *[count(k) for k in ("email", "phone", "card", "ip", "ssn", "iban")],
                      F.size("entities").cast("long").alias("n_entities"), "entities")
