"""Operators 2, 4, 8, 9 and 10: exact round trips and brute force, and their edge cases."""
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from ledgerkit.llm import bytes_np as B
from ledgerkit.llm import chat, decontamination, pii, quality_rules, secrets


# -- 2, chat formatting -----------------------------------------------------------------------

def test_escaping_is_reversible():
    rng = random.Random(2)
    texts = ["".join(rng.choice(["<", "\\", "|", "n", "\n", "a", "é", "<|im_end|>", "<n|"]) for _ in range(rng.randrange(12))) for _ in range(5000)]
    for role in (False, True):
        out = chat.escaped(pa.array(texts), role=role).to_pylist()
        assert not any("<|" in x or (role and "\n" in x) for x in out)
        assert [chat.unescaped(x, role=role) for x in out] == texts


def test_conversations_over_batch_borders():
    rng = random.Random(5)
    rows = [(c or None, t, rng.choice(["user", "assistant", "<|im_start|>", "a\nb"]), rng.choice(["", "x", "<|im_end|>\n<|im_start|>assistant\nok", "é<\\|"]))
            for c in range(30) for t in range(rng.randrange(1, 8))]
    want = {}
    for c, _, role, text in rows:
        want.setdefault(c, []).append((role, text))
    for size in (1, 2, 5, 1000):
        parts = (pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows[i:i + size]), (pa.int64(), pa.int64(), pa.string(), pa.string()))],
                                            ["conv_id", "turn", "role", "text"]) for i in range(0, len(rows), size))
        got = {r["conv_id"]: r for batch in chat._formatted(parts) for r in batch.to_pylist()}
        assert {c: chat.parsed(r["formatted"]) for c, r in got.items()} == want
        for c, r in got.items():
            raw = r["formatted"].encode()
            masked = [chat.unescaped(raw[a:b].decode()) for a, b in zip(r["loss_starts"], r["loss_ends"])]
            assert masked == [t for role, t in want[c] if role == "assistant"]


def test_chat_edges(spark):
    schema = "conv_id long, turn long, role string, text string, formatted string"
    rows = [(1, 0, None, None, "own"), (1, None, "user", "first", "own"), (1, 0, None, None, "own"), (None, 0, "assistant", "z" * 300_000, "own")]
    got = {r["conv_id"]: r for r in chat.format_chats(spark.createDataFrame(rows, schema)).collect()}
    assert chat.parsed(got[1]["formatted"]) == [("user", "first"), ("", ""), ("", "")]
    assert chat.parsed(got[None]["formatted"]) == [("assistant", "z" * 300_000)]
    assert chat.format_chats(spark.createDataFrame([], schema)).count() == 0


# -- 4, personal data -------------------------------------------------------------------------

SAMPLE = ("Call +1 (988) 555-2485 or (988) 555-2485, mail Bob.42@mail8.example.com. Mr Ada Byron met Mrs Byron. Г-жа Иванова: 42.144.35.254, "
          "card 4111 1111 1111 1111 and 4111111111111111, ssn 078-05-1120.")


def test_surrogates_keep_type_format_and_coreference():
    new, spans = pii.replaced(SAMPLE, "key", {})
    for kept in ("988", "Bob", "Byron", "Ada", "Иванова", "42.144", "4111", "078-05"):
        assert kept not in new
    by_kind = {}
    for s in spans:
        assert new[s["first"]:s["past"]] == s["surrogate"]
        by_kind.setdefault(s["kind"], []).append(s["surrogate"])
    a, b = by_kind["phone"]
    assert re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", a) and a.removeprefix("+1 ") == b
    a, b = by_kind["card"]
    assert re.fullmatch(r"(\d{4} ){3}\d{4}", a) and a.replace(" ", "") == b and pii.luhn(b) and b[0] == "4"
    assert re.fullmatch(r"[A-Z][a-z]{2}\.\d\d@[a-z]{4}\d\.[a-z]{7}\.com", by_kind["email"][0])
    assert len(set(by_kind["name-latin-s"])) == 1 and re.fullmatch("[А-Я][а-я]+", by_kind["name-cyrillic-s"][0])
    assert pii.replaced(SAMPLE, "key", {})[0] == new != pii.replaced(SAMPLE, "other", {})[0]
    assert [k for *_, k, _ in pii.find(new)] == [k for *_, k, _ in pii.find(SAMPLE)]


def test_permutation_and_plain_texts():
    for size in (2, 10, 26, 1000, 4097):
        assert sorted(pii.permuted("k", "t", i, size) for i in range(size)) == list(range(size))
    for text in ("", "no entities here, 3.14 and 2020-01-02 or v1.2.3", "a@b", "1234567"):
        assert pii.replaced(text, "k", {}) == (text, [])


def test_collisions_get_another_attempt(spark, monkeypatch):
    """Two names that draw the same surrogate, and one whose surrogate is a real name."""
    first = {s: pii.surrogate("k", "name-latin-s", s) for s in ("byron", "keller")}
    values = [("name-latin-s", v) for v in ("byron", "keller", first["byron"])]
    table = pii.surrogate_table(spark.createDataFrame(values, "kind string, value string"), "k").collect()
    out = {r["value"]: (r["attempt"], r["surrogate"]) for r in table}
    assert out["byron"][0] == 1 and out["keller"] == (0, first["keller"])
    assert len({s for _, s in out.values()}) == 3 and not {s for _, s in out.values()} & set(out)
    many = spark.createDataFrame([("email", f"{c}@{d}.com") for c in "abcdefghijklmnopqrstuvwxyz" for d in "xyz"], "kind string, value string")
    got = pii.surrogate_table(many, "k").collect()
    assert len({r["surrogate"] for r in got}) == 78 and not {r["surrogate"] for r in got} & {r["value"] for r in got}


def test_more_names_than_three_syllables_give(spark):
    """280,000 Cyrillic surnames; there are 65 ** 3 = 274,625 of three syllables."""
    n = 280_000
    names = spark.range(n).selectExpr("'name-cyrillic-s' AS kind", "concat('ж', id) AS value")
    table = pii.surrogate_table(names, "k")
    assert table.count() == table.select("value").distinct().count() == table.select("surrogate").distinct().count() == n
    last = table.orderBy("attempt", ascending=False).first()
    assert last["attempt"] > 4 and last["surrogate"] == pii.surrogate("k", *last[:3])
    assert [len(pii.surrogate("k", "name-latin-m", "ada", a)) for a in (0, 4, 5, 6, 12)] == [7, 7, 9, 11, 23]


def test_later_attempts_reach_the_texts(spark):
    real = pii.surrogate("k", "name-latin-s", "byron")
    docs = spark.createDataFrame([(1, "Mr Byron"), (2, f"Mrs {real.capitalize()}")], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in pii.with_surrogates(docs, "k").collect()}
    assert got[1] == f"Mr {pii.surrogate('k', 'name-latin-s', 'byron', 1).capitalize()}" != f"Mr {real.capitalize()}"


def test_all_mentions_of_a_name_and_numbers_of_other_countries():
    text = "Ms Ada Byron met Dr Ada Byron. Later Ada Byron left; Byron’s hat, Ada too. Adam stays, as byron does"
    new, spans = pii.replaced(text, "k", {})
    given, last = spans[0]["surrogate"], spans[1]["surrogate"]
    assert new == text.replace("Byron", last).replace("Ada ", f"{given} ").replace("Ada.", f"{given}.")
    assert given.endswith("na") and {s["kind"] for s in spans} == {"name-latin-f", "name-latin-s"}
    numbers = ["+49 30 123456", "030 123456", "+49 151 23456789", "+33 6 12 34 56 78", "06 12 34 56 78", "0171 2345678", "+34 612 34 56 78", "555.123.4567", "+493012345678901"]
    new, spans = pii.replaced("; ".join(numbers), "k", {})
    out = new.split("; ")
    assert len(spans) == len(numbers) and {s["kind"] for s in spans} == {"phone"}
    for a, b in zip(numbers, out):
        assert a != b and re.sub(r"\d", "0", a) == re.sub(r"\d", "0", b) and (a[0] != "+" or a[:3] == b[:3])
    assert out[0].removeprefix("+49 ") == out[1].removeprefix("0") and out[3].removeprefix("+33 ") == out[4].removeprefix("0")
    text = "on 01.02.2020 12:30 and 2020-01-02, 01-02-2020, DE00370400440532013000"
    assert pii.replaced(text, "k", {}) == (text, [])
    text = "DE89 3704 0044 0532 0130 00 THIS or DE89370400440532013000, GB29NWBK60161331926819."
    new, spans = pii.replaced(text, "k", {})
    assert [s["kind"] for s in spans] == ["iban"] * 3 and [k for *_, k, _ in pii.find(new)] == ["iban"] * 3
    a, b, c = [s["surrogate"] for s in spans]
    assert a.replace(" ", "") == b and a[:2] == "DE" and re.fullmatch(r"GB\d\d[A-Z]{4}\d{14}", c) and not {a, c} & {text[:27], "GB29NWBK60161331926819"}


def test_the_query_against_a_plain_version(spark, tmp_path):
    """Planted entities of all kinds; the plain version works in lists, without hashes of texts or joins."""
    rng = random.Random(11)
    people = [("Mr", "Ada"), ("Ms", "Robin"), ("Dr", "Robin"), ("Prof", "Kim"), ("Herr", "Jürgen"), ("Г-жа", "Анна")]
    rows = []
    for d in range(120):
        title, first = rng.choice(people)
        last = rng.choice(["Byron", "Keller", "Иванова", "O'Neil"])
        rows.append((d, rng.choice([
            f"{title} {first} {last} wrote; {first} {last} and {last} again", f"{title} {last} at {rng.randrange(20)}x@mail.example.com",
            f"call +49 30 {rng.randrange(10):06d} or 030 {rng.randrange(10):06d}", f"card 4111 1111 1111 {rng.randrange(30):04d}, ip 10.0.0.{rng.randrange(20)}",
            "DE89 3704 0044 0532 0130 00", "", "nothing here"])))
    rows += [(None, rows[0][1]), (7, rows[7][1]), (200, None), (201, "Mr Byron " * 2000), (202, "Dr Robin Keller"), (203, "Ms Robin Byron")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    values = {x[2:] for _, t in rows for x in pii.find(t or "")}
    told = {}
    for kind, value in sorted(values, reverse=True):
        if kind.startswith("name") and kind[-1] in "mf":
            told[kind[:-2], value] = kind
    as_kind = {(k, v): told.get((k[:-2], v), k) if k.startswith("name") and k[-1] == "n" else k for k, v in values}
    attempts, own = dict.fromkeys({(as_kind[x], x[1]) for x in values}, 0), {}
    for turn in range(1, 40):
        own = {x: pii.surrogate("k", *x, a) for x, a in attempts.items()}
        again = {x for x, s in own.items() if (x[0], s) in own}
        for x in own:
            same = sorted((y for y in own if y[0] == x[0] and own[y] == own[x]), key=lambda y: (-attempts[y], y[1]))
            again |= set(same[1:])
        if not again:
            break
        attempts |= dict.fromkeys(again, turn)

    def plain(text):
        out, at = "", 0
        for a, b, kind, value in pii.find(text):
            if a >= at:
                out += text[at:a] + pii.written_as(text[a:b], kind, own[as_kind[kind, value], value])
                at = b
        return out + text[at:]
    spark.conf.set(pii.KEY_CONF, "k")
    try:
        got = pii.op4_pii_surrogates(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset(pii.KEY_CONF)
    key = lambda r: (str(r[0]), str(r[1]))
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=key) == sorted(((d, t if t is None else plain(t)) for d, t in rows), key=key)
    assert len(set(own.values())) == len(own) and any(k != a for (k, _), a in as_kind.items())
    assert all(r["text"][e["first"]:e["past"]] == e["surrogate"] for r in got for e in r["entities"] or [])


def test_draws_are_spread_over_tasks(spark):
    from pyspark.sql import functions as F
    values = spark.range(5000).selectExpr("'name-latin-s' AS kind", "concat('x', id) AS value").distinct().withColumn("attempt", F.lit(0))
    drawn = pii._attempted(values, "k")
    assert drawn.groupBy(F.spark_partition_id()).count().count() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_no_key_no_surrogates(spark):
    with pytest.raises(ValueError, match="no key"):
        pii.with_surrogates(spark.createDataFrame([(1, "Mr Byron")], "doc_id long, text string"))


def test_items_are_found_at_word_edges(spark):
    docs = spark.createDataFrame([(1, "Lyon is a city", "x"), (2, "the bone twofold", "x"), (3, "On, and on", "x"), (4, "one two", "x")], "doc_id long, text string, _new string")
    items = spark.createDataFrame([(1, "on"), (2, "one two"), (3, "y")], "item_id long, text string")
    found = decontamination.find_items(docs, items)
    assert found.columns == ["doc_id", "text", "_new", "hits"]
    got = {r["doc_id"]: [(h["item_id"], r["text"][h["first"]:h["past"]]) for h in r["hits"]] for r in found.collect()}
    assert got == {1: [], 2: [], 3: [(1, "On"), (1, "on")], 4: [(2, "one two")]}


def test_pii_edges(spark, edge_docs, no_docs):
    clash = edge_docs.withColumns({"text_hash": edge_docs["lang"], "_later": edge_docs["lang"]})
    assert set(pii.with_surrogates(clash, "key").columns) == set(clash.columns)
    real = pii.surrogate("key", "name-latin-s", "byron")
    again = spark.createDataFrame([(1, "Mr Byron", "own", "own"), (2, f"Mr {real.capitalize()}", "own", "own")], "doc_id long, text string, text_hash string, _later string")
    assert {(r["text_hash"], r["_later"]) for r in pii.with_surrogates(again, "key").collect()} == {("own", "own")}
    got = pii.with_surrogates(edge_docs, "key")
    assert got.count() == edge_docs.count() and set(got.columns) == set(edge_docs.columns)
    same = [(r["doc_id"], r["text"]) for r in got.select("doc_id", "text").collect()]
    assert sorted(map(str, same)) == sorted(str((r["doc_id"], r["text"])) for r in edge_docs.select("doc_id", "text").collect())
    assert pii.with_surrogates(no_docs, "key").count() == 0


# -- 8, benchmark decontamination -------------------------------------------------------------

def edit_distance_in(pattern, text):
    """Least distance of the pattern to a part of the text, the quadratic way."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        left, row[0] = row[0], i
        for j, c in enumerate(text, 1):
            left, row[j] = row[j], min(left + (p != c), row[j] + 1, row[j - 1] + 1)
    return min(row)


def test_myers_is_the_edit_distance():
    rng = random.Random(4)
    for _ in range(300):
        p = bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 90)))
        t = bytes(rng.choice(b"abc") for _ in range(rng.randrange(0, 120)))
        assert decontamination.myers(p, t)[0] == edit_distance_in(p, t)


def test_items_within_the_budget_are_found(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9)))
    items = [(i, " ".join(word() for _ in range(rng.randrange(4, 40)))) for i in range(12)]
    docs, norm = [], lambda t: re.sub(r"[^0-9a-z\x80-\U0010ffff]+", " ", t.lower()).strip()
    for d in range(90):
        text = list(items[d % 12][1])
        for _ in range(rng.randrange(0, 2 + 2 * (len(text) // 20))):
            at = rng.randrange(len(text))
            text[at:at + rng.randrange(2)] = rng.choice(["", "x", "yz"])
        said = "".join(text)
        docs.append((d, " ".join(word() for _ in range(20)) + ". " + (said.upper() if d % 3 else said.replace(" ", ",  ")) + " " + word()))
    got = decontamination.find_items(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    found = {(r["doc_id"], h["item_id"]): h["distance"] for r in got.collect() for h in r["hits"]}
    want = {}
    for d, t in docs:
        for i, x in items:
            distance = edit_distance_in(f" {norm(x)} ", f" {norm(t)} ")
            if distance <= len(norm(x)) // decontamination.BYTES_PER_EDIT:
                want[d, i] = distance
    assert set(found) == set(want) and 20 < len(want) < 90
    assert all(found[k] >= want[k] for k in want)


def test_decontamination_edges(spark, edge_docs, no_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    items = spark.createDataFrame([(1, None), (2, ""), (3, "..."), (4, "one two"), (None, "ONE  two"), (5, "é" * 40)], "item_id long, text string")
    assert decontamination.decontaminated(edge_docs, none).count() == edge_docs.count()
    left = decontamination.decontaminated(edge_docs, items)
    assert left.columns == edge_docs.columns and left.first()["hits"] == "own hits"
    assert {r["doc_id"] for r in edge_docs.select("doc_id").subtract(left.select("doc_id")).collect()} == {8, 9, 11}
    assert decontamination.decontaminated(no_docs, items).count() == 0


def test_items_without_an_id_are_found(spark):
    schema = "item_id long, text string"
    items = spark.createDataFrame([(None, "gamma delta epsilon"), (None, "Gamma  delta epsilon"), (3, "one two three"), (None, "ONE two three")], schema)
    docs = spark.createDataFrame([(1, "Alpha, gamma delta epsilon."), (2, "one two three"), (3, "nothing of it")], "doc_id long, text string")
    got = {r["doc_id"]: [h["item_id"] for h in r["hits"]] for r in decontamination.find_items(docs, items).collect()}
    assert got == {1: [None], 2: [None, 3], 3: []}
    assert [r["doc_id"] for r in decontamination.decontaminated(docs, items).collect()] == [3]


def test_spans_are_places_in_the_text(spark):
    docs = spark.createDataFrame([(1, "Überall É steht: «Alpha beta, GAMMA delta epsilon» hier")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "alpha beta gamma delta epsilon")], "item_id long, text string")
    row = decontamination.find_items(docs, items).first()
    h, = row["hits"]
    assert row["text"][h["first"]:h["past"]] == "Alpha beta, GAMMA delta epsilon" and h["distance"] == 0


def test_spaces_and_punctuation_beyond_ascii(spark):
    """A copy that was typed anew, with no-break spaces, curly quotes and dashes."""
    said = "the \"old\" mill - built in 1790 - it stands by the river's upper bend, as the écluse and 数 学 do"
    anew = "“" + said.replace(" ", "\u00a0").replace('"', "”").replace("-", "—").replace("'", "’") + "”\u2003…"
    docs = spark.createDataFrame([(1, f"¿{anew} 😀"), (2, said), (3, "nothing of it")], "doc_id long, text string")
    for item in (said, anew):
        items = spark.createDataFrame([(7, item)], "item_id long, text string")
        got = {r["doc_id"]: (r["text"], r["hits"]) for r in decontamination.find_items(docs, items).collect()}
        assert [[h["distance"] for h in got[d][1]] for d in (1, 2, 3)] == [[0], [0], []]
        text, (h,) = got[1]
        assert text[h["first"]:h["past"]] == anew.strip("“”\u2003…")
    every = "".join(chr(c) for c in range(0x80, 0x110000) if not 0xD800 <= c < 0xE000).encode()
    gaps = np.zeros(len(every), bool)
    gaps[decontamination.gap_bytes(np.frombuffer(every, np.uint8))] = True
    assert gaps.sum() == sum(len(chr(c).encode()) for c in decontamination._GAPS.tolist())
    assert set(np.frombuffer(every, np.uint8)[gaps].tobytes().decode()) == {chr(c) for c in decontamination._GAPS.tolist()}


# -- 9, secret scans --------------------------------------------------------------------------

def brute_spans(text):
    least = {k: n for k, _, _, n, _ in secrets.RULES}
    out = []
    for kind, expression, any_case, *_ in secrets.RULES:
        expression = r"([0-9a-f]+)" if kind == "hex" else expression
        for m in re.finditer(expression, text, (re.I | re.A) if any_case else 0):
            size = len(re.search(r"[:=]\x20*[\"']?(.*)$", m[0], re.S)[1]) if kind == "assign" else len(m[0])
            if size >= least[kind]:
                out.append((m.start(), m.end(), kind))
    return sorted(out)


def test_one_pass_finds_what_each_rule_finds():
    rng = random.Random(1)
    parts = ["password", "Passwd", "secret", "TOKEN", "api_key", "apikey", '"', "'", " ", "  ", ":", "=", "abcdefgh", "AKIA", "ABCD1234EFGH5678",
             "0123456789abcdef", "deadbeef", "\n", "é", "token=", "-----BEGIN RSA PRIVATE KEY-----", "ghp_", "x" * 36, ".", "_", "PRIVATE KEY", "-----"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(60))) for _ in range(1500)]
    texts += ["", "a" * 5000 + "f" * 40 + " password=" + "Z" * 3000, "ab" * 3000, "password: token: abcdefghijk"]
    auto, got = secrets.automaton(), [[] for _ in texts]
    for a, _, buf, offs in B.chunks(pa.array(texts)):
        for d, r, first, past in secrets.scan(buf, offs, secrets.RULES, auto):
            raw = buf[offs[d]:offs[d + 1]].tobytes()
            got[a + d].append((len(raw[:first - offs[d]].decode()), len(raw[:past - offs[d]].decode()), secrets.RULES[r][0]))
    assert [sorted(x) for x in got] == [brute_spans(t) for t in texts]
    assert sum(map(len, got)) > 1000


def test_minimised_and_checked():
    table = secrets.automaton()["table"]
    assert len(np.unique(np.c_[table, secrets.automaton()["mark"]], axis=0)) == len(table)
    try:
        secrets.automaton((("x", "ab(c)?d(ef)?", False, 1, None),))
    except ValueError:
        return
    raise AssertionError("a rule that can lose its match must be refused")


def test_secret_edges(spark, edge_docs, no_docs):
    got = secrets.with_spans(edge_docs)
    assert got.count() == edge_docs.count() and set(got.columns) == set(edge_docs.columns)
    assert all(not r["found"] for r in got.select("found").collect())
    assert secrets.with_spans(no_docs).count() == 0


# -- 10, quality rules ------------------------------------------------------------------------

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    n, covered, seen, lines = Counter(windows), set(), set(), 0
    for i, w in enumerate(windows):
        if n[w] > 1:
            covered.update(range(i, i + 5))
    for line in text.split("\n"):
        if WORD.search(line):
            lines += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), lines, len(covered)


def test_base_rules_and_score(spark, edge_docs):
    rng = random.Random(6)
    texts = ["".join(rng.choice(["a ", "b ", "c\n", "#", "é\t", "|", "a b c d e f\n", "  "]) for _ in range(rng.randrange(80))) for _ in range(200)]
    docs = edge_docs.select("doc_id", "text").union(spark.createDataFrame([(100 + i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    trusted = spark.createDataFrame([("a b a b c",), ("b a",), (None,)], "text string")
    rows = quality_rules.judged(docs, docs, trusted).collect()
    assert len(rows) == docs.count()
    for r in rows:
        base = brute_base(r["text"])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == base
        assert r["base_failed"] == (base[0] < 10 or 100 * base[4] > 20 * base[0])
        assert r["kept"] == (not r["base_failed"] and r["score"] is not None and r["score"] >= quality_rules.MIN_SCORE)
        assert (r["score"] is None) == (base[0] == 0)


def test_score_is_the_mean_log_ratio(spark):
    raw = spark.createDataFrame([(1, "x y x"), (2, "y z")], "doc_id long, text string")
    good = spark.createDataFrame([("X y",)], "text string")
    ratios = quality_rules.log_ratios(raw, good).first()["ratios"]
    buckets = {r["doc_id"]: r["b"] for r in raw.select("doc_id", quality_rules.gram_buckets(
        quality_rules.F.split("text", " ")).alias("b")).collect()}
    n_raw, n_good = Counter(buckets[1] + buckets[2]), Counter([buckets[1][0], buckets[1][1], buckets[1][3]])
    size, smooth = quality_rules.BUCKETS, quality_rules.SMOOTH_PERCENT / 100
    for b in (buckets[1][0], buckets[2][1], 5):
        p, q = ((c[b] + smooth * t / size) / (t + smooth * t) for c, t in ((n_good, 3), (n_raw, 8)))
        assert abs(ratios[b] - np.log(p / q)) < 1e-9
    score = {r["doc_id"]: r["score"] for r in quality_rules.judged(raw, raw, good).collect()}
    assert all(abs(score[d] - np.mean([ratios[b] for b in buckets[d]])) < 1e-9 for d in buckets)


def test_quality_edges(spark, no_docs):
    assert quality_rules.judged(no_docs, no_docs, no_docs.select("text")).count() == 0
