import json
import os
import tempfile

from pyspark.sql import functions as F

from fixtures import full_filing, micro_filing


def _filings(spark):
    rows = [("a!1", "Accounts_Bulk_Data-2025-01-02.zip", "m1.html", 0, "m1.html", full_filing().encode()),
            ("a!2", "Accounts_Bulk_Data-2025-01-02.zip", "m2.html", 1, "m2.html", micro_filing().encode())]
    df = spark.createDataFrame(rows, "filing_id string, archive string, member string, member_ord int, "
                                     "source_file string, content binary")
    return df.withColumn("published", F.to_date(F.lit("2025-01-02")))


def test_build_sample_writes_records_csv_and_manifest(spark):
    from ledgerkit.plans.dataset import build_sample
    out = tempfile.mkdtemp(prefix="lk-sample-")
    build_sample(_filings(spark), None, out)
    recs = spark.read.parquet(f"{out}/records")
    assert recs.count() == 2
    assert "f_within_bank_loans" in recs.columns and "provenance" in recs.columns
    m = spark.read.json(f"{out}/manifest").collect()[0]
    assert m.record_count == 2 and m.unique_companies == 2
    assert dict(m.taxonomy_distribution.asDict()) == {"FRS-102": 1, "FRS-105": 1}


def test_month_parts_are_replaced_per_month(spark):
    from ledgerkit.sinks.writers import pending_months, write_month_parts
    out = tempfile.mkdtemp(prefix="lk-parts-")
    a = spark.createDataFrame([("2025-01", 1), ("2025-02", 2)], "month string, v int")
    write_month_parts(a, out)
    write_month_parts(spark.createDataFrame([("2025-02", 3)], "month string, v int"), out)
    got = {(r.month, r.v) for r in spark.read.parquet(out).collect()}
    assert got == {("2025-01", 1), ("2025-02", 3)}
    todo = pending_months(spark.createDataFrame([("2025-01",), ("2025-03",)], "month string"),
                          spark.read.parquet(out))
    assert [r.month for r in todo.collect()] == ["2025-03"]


def test_cutoffs_agreement_and_items_roundtrip(spark):
    from ledgerkit.sinks.writers import write_jsonl
    from ledgerkit.sources.inputs import read_cutoffs, read_items
    d = tempfile.mkdtemp(prefix="lk-in-")
    with open(os.path.join(d, "cut.json"), "w") as f:
        json.dump({"threshold_date": "2026-06-17", "models": [
            {"name": "a", "provider": "x", "released": "2026-06-16", "source": "s"},
            {"name": "b", "provider": "y", "released": "2025-03-25", "source": "s"}]}, f)
    models, check = read_cutoffs(spark, os.path.join(d, "cut.json"))
    assert models.count() == 2 and check.collect()[0].agrees is True
    items = spark.createDataFrame([("q0001", "ratio", "numeric", "Q?", 1.5, None, None, 0.02, 0.05)],
                                  "id string, category string, answer_type string, question string, "
                                  "answer_num double, answer_text string, answer_bool boolean, rel_tol double, "
                                  "abs_tol double")
    write_jsonl(items, os.path.join(d, "items"))
    back = read_items(spark, os.path.join(d, "items")).collect()
    assert back[0].id == "q0001" and back[0].answer_num == 1.5 and back[0].meta is None


def test_terms_match_inside_words_without_a_nested_loop(spark):
    from ledgerkit.operators import entities as E
    comps = spark.createDataFrame([("1", "ACME FUNDING PLC", "plc"), ("2", "RED BOLT LTD", "ltd"),
                                   ("3", "HUNDRED HOLDINGS", "ltd")], "company_number string, company_name string, "
                                                                   "company_type string")
    terms = E.rank_terms(spark.createDataFrame([("funding", "spv", "a"), ("red", "lender", "b"), ("x", "spv", "c"), ("ed", "spv", "d")],
                                               "term string, category string, rank string"))
    got = E.match_terms(comps, terms)
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()
    assert {(r.company_number, r.term) for r in got.collect()} == {("1", "funding"), ("2", "red"), ("3", "red"), ("2", "ed"), ("3", "ed")}


def test_verify_suspects_and_archive_provenance(spark):
    from ledgerkit.operators.aggregates import archive_provenance
    from ledgerkit.plans.raw_benchmark import verify_items
    f = _filings(spark).withColumn("member", F.concat(F.lit("Prod_"), F.col("filing_id"), F.lit(
        "_"), F.when(F.col("filing_id") == "a!1", F.lit("12345678")).otherwise(F.lit("87654321")), F.lit(".html")))
    suspects = spark.createDataFrame([("12345678", "net_assets", 1350.0), ("87654321", "current_assets", 45000.0),
                                      ("99999999", "cash", 1.0)], "company_number string, field string, expected double")
    got = {r.company_number: r.passed for r in verify_items(suspects, f).collect()}
    # 1,350 is shown in thousands (scale 3) and is visible; 45,000 is visible; no filing -> fails
    assert got == {"12345678": True, "87654321": True, "99999999": False}
    archives = spark.createDataFrame([("file:/x/Accounts_Bulk_Data-2025-01-02.zip", b"zipbytes")],
                                     "path string, content binary")
    prov = archive_provenance(f, archives).collect()[0]
    assert prov.sampled == 2 and len(prov.sha256) == 64


def test_publish_joins_observes_and_refuses_a_doubled_register(spark):
    import pytest

    from ledgerkit.operators.aggregates import field_coverage
    from ledgerkit.plans.dataset import parse_month, publish, read_dataset
    recs = parse_month(_filings(spark))
    numbers = sorted(r[0] for r in recs.select("company_number").collect())
    register = spark.createDataFrame([(numbers[0], "ACME LTD", ["1 - A", "2 - B"]), (None, "NOBODY", []), (None, "NONE", [])],
                                     "company_number string, company_name string, sic_codes array<string>")
    base = tempfile.mkdtemp(prefix="lk-pub-")
    out = publish(recs, register, base, "1", sources=["register"])["version"]
    rows = {r.company_number: (r.company_name, r.sic_codes) for r in read_dataset(spark, base, ["company_number", "company_name", "sic_codes"]).collect()}
    assert rows[numbers[0]] == ("ACME LTD", "1 - A; 2 - B") and rows[numbers[1]][0] is None
    told, = spark.read.json(f"{out}/_coverage").collect()
    want, = field_coverage(spark.read.parquet(out)).collect()
    assert (told.matched, told.match_rate) == (1, 0.5) and {c: told[c] for c in want.asDict()} == want.asDict()
    with pytest.raises(ValueError, match="duplicate company_number"):
        publish(recs, register.union(register.limit(1)), base, "2")
    assert not os.path.exists(f"{base}/version=2")


def test_readers_of_lists_registers_and_loose_filings(spark):
    from ledgerkit.operators.entities import rank_terms, read_terms
    from ledgerkit.operators.metadata import read_company_csv
    from ledgerkit.sources.archives import scan_filings
    d = tempfile.mkdtemp(prefix="lk-read-")
    with open(f"{d}/terms.txt", "w") as f:
        f.write("# lenders\nred\n\n  blue bolt \n#x\n")
    got = rank_terms(read_terms(spark, f"{d}/terms.txt", "lender")).orderBy("rank").collect()
    assert [(r.term, r.category, r["rank"], r.cat_rank) for r in got] == [("red", "lender", 1, 0), ("blue bolt", "lender", 2, 0)]
    with open(f"{d}/register.csv", "w") as f:
        f.write('CompanyName, CompanyNumber,RegAddress.PostTown\n"ACME, LTD",00000001,LEEDS\n')
    row, = read_company_csv(spark, f"{d}/register.csv").collect()
    assert {c.strip(): v for c, v in row.asDict().items()}["CompanyName"] == "ACME, LTD"
    os.makedirs(f"{d}/loose/2025-03-04")
    for name in ("a.HTML", "b.txt"):
        with open(f"{d}/loose/2025-03-04/{name}", "w") as f:
            f.write(full_filing())
    row, = scan_filings(spark, f"{d}/loose").collect()
    assert (row.source_file, row.archive, str(row.published)) == ("a.HTML", None, "2025-03-04") and bytes(row.content) == full_filing().encode()


def test_read_dataset_takes_newest_version_and_existing_columns(spark):
    from ledgerkit.plans.dataset import read_dataset
    from ledgerkit.sinks.writers import write_version
    base = tempfile.mkdtemp(prefix="lk-ver-")
    df = spark.createDataFrame([("2025-01", "A", 1.0)], "month string, company_number string, net_assets double")
    write_version(df, base, "2025-01-01")
    write_version(df.withColumn("net_assets", F.lit(2.0)), base, "2025-02-01")
    got = read_dataset(spark, base, ["company_number", "net_assets", "no_such_column"]).collect()
    assert [tuple(r) for r in got] == [("A", 2.0)]


def test_quota_is_filled_however_many_texts_the_guard_rejects(spark):
    from ledgerkit.plans.raw_benchmark import _take_first_valid
    cands = spark.createDataFrame([(f"f{i}", "turnover", "turnover_trap", f"{i:04d}") for i in range(60)]
                                  + [(f"f{i}", "cash", "extraction", f"{i:04d}") for i in range(3)],
                                  "filing_id string, field string, category string, _h string")
    filings = spark.createDataFrame([(f"f{i}", f"<p>{'Revenue was' if i < 50 else 'Cash is'} {i}</p>".encode()) for i in range(60)],
                                    "filing_id string, content binary")
    got = _take_first_valid(cands, filings, {"turnover": 5, "cash": 4, "employees": 2}, trap_guard=True).collect()
    assert sorted(r.filing_id for r in got if r.field == "turnover") == [f"f{i}" for i in range(50, 55)]
    assert sorted(r.filing_id for r in got if r.field == "cash") == ["f0", "f1", "f2"]


def test_a_model_whose_answers_all_errored_is_named(spark):
    from ledgerkit.operators.grading import accuracy
    rows = [("p", "good", "a", True, False), ("p", "good", "b", False, True), ("p", "bad", "a", False, True)]
    got = {(r.model, r.category): (r.scored, r.accuracy, r.errors) for r in accuracy(spark.createDataFrame(
        rows, "provider string, model string, category string, correct boolean, errored boolean")).collect()}
    assert got == {("good", None): (1, 1.0, 1), ("good", "a"): (1, 1.0, 1), ("bad", None): (0, None, 1)}


def test_results_are_saved_read_and_regraded(spark):
    from ledgerkit.operators.grading import accuracy, from_saved, regrade, sign_flips
    from ledgerkit.sinks.writers import write_results
    from ledgerkit.sources.inputs import read_items, read_results
    d = tempfile.mkdtemp(prefix="lk-res-")
    schema = ("item_id string, provider string, model string, category string, field string, company_number string, "
              "model_answer string, correct boolean, errored boolean, answer_num double")
    rows = [("h1", "p", m, "extraction", "net_assets", "1", "100", False, False, -100.0) for m in ("a", "b")]
    rows += [("h2", "p", m, "turnover_trap", "turnover", "2", "50", False, False, None) for m in ("a", "b")]
    rows += [("h3", "p", "a", "turnover_trap", "turnover", "3", "none", True, False, None)]
    graded = spark.createDataFrame(rows, schema)
    write_results(graded, accuracy(graded), os.path.join(d, "results"))
    items = spark.createDataFrame([(f"h{i}", (str(i),)) for i in (1, 2, 3)], "id string, meta struct<company_number:string>")
    items.write.json(os.path.join(d, "items"))
    saved = read_results(spark, os.path.join(d, "results"))
    assert saved.count() == 5
    back = from_saved(saved, read_items(spark, os.path.join(d, "items")))
    latest = spark.createDataFrame([("2", True), ("3", None)], "company_number string, dormant boolean")
    got = {(r.model, r.category): (r.scored, r.accuracy) for r in regrade(back, latest).collect()}
    assert got[("a", None)] == (2, 0.5) and got[("b", None)] == (1, 0.0) and ("b", "turnover_trap") not in got
    assert {r.model: r.sign_flips for r in sign_flips(back).collect()} == {"a": 1, "b": 1}
