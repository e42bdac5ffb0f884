import io
import os
import tempfile
import zipfile

from fixtures import full_filing, micro_filing


def _zip(members):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        for n, data in members.items():
            z.writestr(n, data)
    return buf.getvalue()


def test_archive_scan_with_inner_zip(spark):
    from ledgerkit.sources.archives import archive_members, scan_archives
    d = tempfile.mkdtemp(prefix="lk-arch-")
    inner = _zip({"a/Prod_1_87654321_20241231.html": micro_filing()})
    outer = _zip({"Prod_1_12345678_20241231.HTML": full_filing(), "inner.zip": inner, "bad.zip": b"nope",
                  "readme.txt": "x"})
    with open(os.path.join(d, "Accounts_Bulk_Data-2025-01-02.zip"), "wb") as f:
        f.write(outer)
    filings = scan_archives(spark, d)
    rows = filings.select("archive", "member", "source_file", "published").collect()
    assert len(rows) == 2
    assert {r.source_file for r in rows} == {"Prod_1_12345678_20241231.HTML", "Prod_1_87654321_20241231.html"}
    assert all(str(r.published) == "2025-01-02" for r in rows)
    assert archive_members(filings).count() == 2


def test_incremental_ingest_processes_new_archives_once(spark):
    from ledgerkit.streaming.ingest import incremental_ingest
    src, out = tempfile.mkdtemp(prefix="lk-src-"), tempfile.mkdtemp(prefix="lk-out-")
    with open(os.path.join(src, "Accounts_Bulk_Data-2025-01-02.zip"), "wb") as f:
        f.write(_zip({"a.html": full_filing()}))
    incremental_ingest(spark, src, out, name=os.path.basename(out))
    assert spark.read.parquet(f"{out}/records").count() == 1
    with open(os.path.join(src, "Accounts_Bulk_Data-2025-02-03.zip"), "wb") as f:
        f.write(_zip({"b.html": micro_filing()}))
    incremental_ingest(spark, src, out, name=os.path.basename(out))
    recs = spark.read.parquet(f"{out}/records")
    assert recs.count() == 2
    from ledgerkit.streaming.ingest import read_latest
    assert read_latest(spark, out).count() == 2


def test_archive_data_source_splits_members(spark):
    from ledgerkit.sources.archives import list_archives, read_archives
    d = tempfile.mkdtemp(prefix="lk-ds-")
    members = {f"m{i}.html": full_filing() for i in range(5)}
    members["inner.zip"] = _zip({"x/deep.xml": micro_filing()})
    members["notes.txt"] = "skip"
    with open(os.path.join(d, "Accounts_Bulk_Data-2025-03-04.zip"), "wb") as f:
        f.write(_zip(members))
    df = read_archives(list_archives(spark, d), most=2)
    assert df.rdd.getNumPartitions() == 4
    rows = df.select("filing_id", "source_file", "published").collect()
    assert len(rows) == 6 and len({r.filing_id for r in rows}) == 6
    assert {str(r.published) for r in rows} == {"2025-03-04"}
    from ledgerkit.operators.extract import parse_filings, rejects
    assert rejects(parse_filings(df)).count() == 0


def _archive_with_two_inner_ones(folder, name="Accounts_Monthly_Data-March2025.zip"):
    members = {f"m{i}.html": full_filing() for i in range(6)} | {"notes.txt": "x", "odd.zip!.html": micro_filing()}
    members |= {f"in{k}.zip": _zip({f"x/d{i}.xml": micro_filing() for i in range(5)} | {"deep.zip": _zip({"no.html": "x"})}) for k in (1, 2)}
    with open(os.path.join(folder, name), "wb") as f:
        f.write(_zip(members))


def test_ranges_split_archives_and_inner_ones_and_no_cell_holds_an_archive(spark):
    from ledgerkit.sources.archives import list_archives, list_filings, member_ranges, read_archives
    d = tempfile.mkdtemp(prefix="lk ranges-")
    _archive_with_two_inner_ones(d)
    with open(os.path.join(d, "none.zip"), "wb") as f:
        f.write(b"no archive")
    archives = list_archives(spark, d)
    assert archives.columns == ["path", "length"]
    ranges = sorted((r.inner or "", r.first, r.past) for r in member_ranges(archives, most=4).collect())
    assert ranges == [("", 0, 4), ("", 4, 8), ("in1.zip", 0, 4), ("in1.zip", 4, 5), ("in2.zip", 0, 4), ("in2.zip", 4, 5)]
    assert len(member_ranges(archives, most_bytes=1).collect()) == 17
    whole, cut = read_archives(archives), read_archives(archives, most=4)
    assert (whole.rdd.getNumPartitions(), cut.rdd.getNumPartitions()) == (3, 6)
    rows = sorted(map(tuple, cut.collect()))
    assert rows == sorted(map(tuple, whole.collect())) and len(rows) == 17
    assert not any(bytes(r[-1]).startswith(b"PK") for r in rows)
    assert sorted(map(tuple, list_filings(archives).collect())) == [r[:-1] for r in rows]


def test_late_reading_opens_wanted_members_only(spark, monkeypatch):
    from ledgerkit.sources import archives as A
    d = tempfile.mkdtemp(prefix="lk-late-")
    _archive_with_two_inner_ones(d)
    path = A.list_archives(spark, d).first()["path"]
    keys = ["m1.html", "in2.zip!x/d3.xml", "odd.zip!.html", "gone.html", "in1.zip!x/gone.xml"]
    got = A.read_members(spark.createDataFrame([(f"{path}!{k}",) for k in keys] * 2 + [("elsewhere",), (None,)], "filing_id string")).collect()
    whole = {r.filing_id: tuple(r) for r in A.scan_archives(spark, d).collect()}
    assert {r.filing_id: tuple(r) for r in got} == {f"{path}!{k}": whole[f"{path}!{k}"] for k in keys[:3]} and len(got) == 3
    opened, read = [], A._content
    monkeypatch.setattr(A, "_content", lambda z, info: (opened.append(info.filename), read(z, info))[1])
    assert len(list(A.wanted_filings(path, A._opened(path), keys))) == 3
    assert sorted(opened) == ["m1.html", "odd.zip!.html", "x/d3.xml"]


def test_raw_benchmark_reads_its_texts_out_of_the_archives(spark):
    from pyspark.sql import functions as F

    from ledgerkit.plans.dataset import parse_month
    from ledgerkit.plans.raw_benchmark import build_raw_benchmark, newest_archive_members
    from ledgerkit.sources.archives import list_archives, list_filings, read_members, scan_archives
    d = tempfile.mkdtemp(prefix="lk-raw-")
    _archive_with_two_inner_ones(d)
    latest = parse_month(scan_archives(spark, d)).withColumn("company_name", F.lit("A"))
    members = newest_archive_members(list_filings(list_archives(spark, d)))
    late = build_raw_benchmark(latest, read_members, members).collect()
    assert late and late == build_raw_benchmark(latest, scan_archives(spark, d)).collect()


def test_provenance_of_an_archive_beyond_two_gigabytes(spark):
    import hashlib

    from ledgerkit.operators.aggregates import archive_provenance
    from ledgerkit.sources.archives import list_archives
    d = tempfile.mkdtemp(prefix="lk-sparse-")
    size = 2 ** 31 + 12345
    with open(os.path.join(d, "big.zip"), "wb") as f:
        f.truncate(size)  # takes no disk
    state, block = hashlib.sha256(), bytes(1 << 24)
    for _ in range(size >> 24):
        state.update(block)
    state.update(bytes(size % (1 << 24)))
    sampled = spark.createDataFrame([("big.zip", 1), ("big.zip", 2), ("other.zip", 3)], "archive string, k long")
    got = {r.archive: (r.sampled, r.sha256) for r in archive_provenance(sampled, list_archives(spark, d)).collect()}
    assert got == {"big.zip": (2, state.hexdigest()), "other.zip": (1, None)}


def test_two_daily_archives_of_one_month_both_stay(spark):
    from ledgerkit.streaming.ingest import incremental_ingest, read_latest
    src, out = tempfile.mkdtemp(prefix="lk-src-"), tempfile.mkdtemp(prefix="lk-out-")
    for day, make in (("02", full_filing), ("03", micro_filing)):
        with open(os.path.join(src, f"Accounts_Bulk_Data-2025-01-{day}.zip"), "wb") as f:
            f.write(_zip({"a.html": make()}))
        incremental_ingest(spark, src, out)
    assert spark.read.parquet(f"{out}/records").count() == 2
    assert read_latest(spark, out).count() == 2


def test_monthly_names_same_names_and_rejects(spark):
    from ledgerkit.operators.extract import parse_filings, rejects
    from ledgerkit.operators.normalise import normalise
    from ledgerkit.sources.archives import list_archives, read_archives, scan_archives
    d = tempfile.mkdtemp(prefix="lk-month-")
    for folder in ("one", "two"):
        os.mkdir(os.path.join(d, folder))
        with open(os.path.join(d, folder, "Accounts_Monthly_Data-January2025.zip"), "wb") as f:
            f.write(_zip({"a.html": full_filing(), "empty.html": b"", "text.html": b"no markup"}))
    for filings in (scan_archives(spark, d), read_archives(list_archives(spark, d), most=2)):
        rows = filings.select("filing_id", "published").collect()
        assert len({r.filing_id for r in rows}) == 6 and {str(r.published) for r in rows} == {"2025-01-01"}
        parsed = parse_filings(filings)
        assert {r.filing_id.rpartition("!")[2] for r in rejects(parsed).collect()} == {"empty.html", "text.html"}
        assert normalise(parsed).count() == 2


def test_of_equal_members_the_last_counts(spark):
    import warnings

    from ledgerkit.sources.archives import scan_archives
    d = tempfile.mkdtemp(prefix="lk-dup-")
    with warnings.catch_warnings(), zipfile.ZipFile(os.path.join(d, "Accounts_Bulk_Data-2025-01-02.zip"), "w") as z:
        warnings.simplefilter("ignore")
        z.writestr("a.html", "first")
        z.writestr("a.html", "second")
    assert [bytes(r.content) for r in scan_archives(spark, d).collect()] == [b"second"]


def test_build_product_of_a_monthly_archive_resumes(spark):
    from ledgerkit.plans.dataset import build_product
    from ledgerkit.sources.archives import scan_archives
    d, out = tempfile.mkdtemp(prefix="lk-bp-"), tempfile.mkdtemp(prefix="lk-bpo-")
    with open(os.path.join(d, "Accounts_Monthly_Data-January2025.zip"), "wb") as f:
        f.write(_zip({"a.html": full_filing(), "b.html": micro_filing()}))
    first = build_product(scan_archives(spark, d), None, out, "1", sources=["archives"], licence="open")["version"]
    assert spark.read.parquet(first).count() == 2
    told, = spark.read.json(f"{first}/_manifest/*.json").collect()
    assert (told["version"], told["sources"], told["licence"]) == ("1", ["archives"], "open") and len(told["processing_steps"]) == 4
    assert spark.read.json(f"{first}/_coverage/*.json").count() == 1
    part, = [p for p in os.listdir(f"{out}/_parts") if p.startswith("month=")]
    inner, = [p for p in os.listdir(f"{out}/_parts/{part}") if p.startswith("archive_part=")]
    part = f"{part}/{inner}"
    stamp = sorted(os.listdir(f"{out}/_parts/{part}"))
    with open(os.path.join(d, "Accounts_Monthly_Data-February2025.zip"), "wb") as f:
        f.write(_zip({"c.html": full_filing()}))
    second = build_product(scan_archives(spark, d), None, out, "2")["version"]
    assert spark.read.parquet(second).count() == 3
    assert sorted(os.listdir(f"{out}/_parts/{part}")) == stamp  # January was not built again
    trial = build_product(scan_archives(spark, d), None, out, "3", trial=True)["version"]
    assert spark.read.parquet(trial).select("month").distinct().count() == 1


def test_a_batch_rewrites_only_its_own_buckets(spark, monkeypatch):
    import pytest

    from ledgerkit.operators.sampling import latest_per_company
    from ledgerkit.streaming import ingest as I
    out = tempfile.mkdtemp(prefix="lk-state-")
    schema = "company_number string, period_end string, source_file string, filing_id string"

    def batch(rows):
        return spark.createDataFrame(rows, schema)

    def files():
        return {os.path.join(p, n) for p, _, names in os.walk(f"{out}/latest/state") for n in names if n.endswith(".parquet")}

    first = [(str(k), "2024-12-31", "a", f"f{k}") for k in range(400)] + [(None, "2024-12-31", "a", "f")]
    assert I.read_latest(spark, out) is None
    I.update_latest(batch(first), out, 0)
    before = files()
    assert len(before) > 150 and I.read_latest(spark, out).count() == 400
    second = [("7", "2025-12-31", "b", "g7"), ("8", "2023-12-31", "b", "g8"), ("new", "2025-12-31", "b", "g9")]
    I.update_latest(batch(second), out, 1)
    assert 1 <= len(files() - before) <= 3 and files() >= before
    want = sorted(map(tuple, latest_per_company(batch(first + second)).collect()))
    rows = lambda: sorted(map(tuple, I.read_latest(spark, out).select(*schema.replace(" string", "").split(", ")).collect()))
    assert rows() == want
    I.update_latest(batch(second), out, 1)  # run again
    assert rows() == want
    with monkeypatch.context() as m:  # lost before its pointer
        m.setattr(type(spark), "createDataFrame", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        extra = spark.read.schema(schema).json(spark.sparkContext.parallelize(['{"company_number": "7", "period_end": "2030-12-31"}']))
        with pytest.raises(RuntimeError, match="lost"):
            I.update_latest(extra, out, 2)
    assert rows() == want
    I.update_latest(batch([]), out, 2)
    I.update_latest(batch([("8", "2026-12-31", "c", "h8")]), out, 3)
    assert {r[0]: r[3] for r in rows()}["8"] == "h8" and len(rows()) == 401
    assert len(files()) <= len(before) + 4  # what no pointer needs is gone


def test_a_late_archive_a_dead_build_and_undated_names(spark, monkeypatch):
    from pyspark.sql import functions as F

    import pytest

    from ledgerkit.plans import dataset as D
    from ledgerkit.sinks import writers as K
    from ledgerkit.sources.archives import list_archives
    d, out = tempfile.mkdtemp(prefix="lk-led-"), tempfile.mkdtemp(prefix="lk-ledo-")

    def put(name, members):
        with open(os.path.join(d, name), "wb") as f:
            f.write(_zip(members))

    def version(v, **kw):
        path = D.build_from_archives(list_archives(spark, d), None, out, v, **kw)["version"]
        return path, {r.source_file: r.accounts_type for r in spark.read.parquet(path).select("source_file", "accounts_type").collect()}

    put("Accounts_Bulk_Data-2025-01-02.zip", {"a.html": full_filing()})
    put("undated.zip", {"n.html": full_filing()})
    path, rows = version("1")
    assert set(rows) == {"a.html"}
    assert [r.archive.rpartition("/")[2] for r in spark.read.json(f"{path}/_undated").collect()] == ["undated.zip"]
    put("Accounts_Bulk_Data-2025-01-03.zip", {"b.html": micro_filing()})  # late: its month has a part
    opened, read = [], D.read_archives
    monkeypatch.setattr(D, "read_archives", lambda a: (opened.extend(sorted(r.path.rpartition("/")[2] for r in a.collect())), read(a))[1])
    assert set(version("2")[1]) == {"a.html", "b.html"} and opened == ["Accounts_Bulk_Data-2025-01-03.zip"]
    # a build that dies after its parts and before the ledger is repeated
    put("Accounts_Bulk_Data-2025-02-03.zip", {"c.html": micro_filing()})
    with monkeypatch.context() as m:
        m.setattr(K, "append_ledger", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            version("3")
    del opened[:]
    assert set(version("3")[1]) == {"a.html", "b.html", "c.html"} and opened == ["Accounts_Bulk_Data-2025-02-03.zip"]
    # an archive that was replaced is built anew, its old part does not count
    put("Accounts_Bulk_Data-2025-01-03.zip", {"e.html": b"no markup at all", "f.txt": "x" * 999})
    del opened[:]
    assert set(version("4")[1]) == {"a.html", "c.html"} and opened == ["Accounts_Bulk_Data-2025-01-03.zip"]
    assert set(version("5", months=1)[1]) == {"c.html"}
    ledger = K.read_ledger(spark, f"{out}/_ledger")
    assert {(r.month, r.records) for r in ledger.collect()} == {("2025-01", 1), ("2025-01", 0), ("2025-02", 1)}
    assert ledger.where(F.col("month").isNull()).isEmpty()


def test_latest_takes_iso_dates_before_others_and_leaves_null_numbers_out(spark):
    from ledgerkit.operators.sampling import latest_per_company
    rows = [("1", "31 December 2020", "a", "f1"), ("1", "2024-12-31", "b", "f2"), ("2", None, "c", "f3"),
            ("2", "x", "a", "f4"), (None, "2024-12-31", "d", "f5"), (None, "2024-12-31", "e", "f6")]
    df = spark.createDataFrame(rows, "company_number string, period_end string, source_file string, filing_id string")
    latest = latest_per_company(df)
    assert {r.company_number: r.filing_id for r in latest.collect()} == {"1": "f2", "2": "f4"}
    assert "WindowGroupLimit" in latest._jdf.queryExecution().executedPlan().toString()


def test_draws_hold_five_different_rows_whatever_the_pool(spark):
    from ledgerkit.operators.sampling import groups_of_draws
    for n, size in ((3, 3), (5, 5), (6, 5), (4000, 5)):
        got = groups_of_draws(spark.range(n), "id", 200, 5, 42).collect()
        members = {}
        for r in got:
            members.setdefault(r.draw, set()).add(r.id)
        assert len(members) == 200 and {len(m) for m in members.values()} == {size} and len(got) == 200 * size


def test_markup_is_one_linear_pass():
    import time

    from ledgerkit.functions.markup import parse_filing, render_text
    head = '<html xmlns="http://www.w3.org/1999/xhtml" xmlns:ix="http://www.xbrl.org/2013/inlineXBRL" xmlns:u="u">'
    fact = '( <ix:nonFraction name="u:A" contextRef="c">1</ix:nonFraction> )'
    took = []
    for n in (4000, 16000):
        t = time.process_time()
        facts = parse_filing(f"{head}<p>{fact * n}</p></html>")["facts"]
        took.append(time.process_time() - t)
        assert len(facts) == n and {(f["mark_before"], f["mark_after"]) for f in facts} == {("(", ")")}
    assert took[1] < 12 * took[0] + 0.1
    assert render_text("<p>x" * 1500, ()).count("x") == 1500
    assert len(parse_filing(f"{head}{'<p><b>' * 1500}{fact}")["facts"]) == 1
