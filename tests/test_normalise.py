from pyspark.sql import functions as F

from fixtures import full_filing, micro_filing, net_cash_filing


def _records(spark, docs):
    from ledgerkit.operators.extract import parse_filings
    from ledgerkit.operators.normalise import normalise
    df = spark.createDataFrame([(f"f{i}", d.encode()) for i, d in enumerate(docs)], "filing_id string, content binary")
    parsed = parse_filings(df)
    return {r["filing_id"]: r for r in normalise(parsed).collect()}, parsed


def test_full_filing_golden(spark):
    from ledgerkit.operators.extract import facts
    recs, parsed = _records(spark, [full_filing()])
    r = recs["f0"]
    assert facts(parsed).count() == 20
    assert r.company_number == "12345678"
    assert r.turnover == 5_000_000
    assert r.total_assets == 2_700_000 and r.provenance["total_assets"] == "summed(fixed+current)"
    assert r.net_assets == 1_350_000 and r.provenance["net_assets"] == "reported"
    assert r.total_liabilities == 1_350_000 and r.provenance["total_liabilities"] == "derived(assets-net_assets)"
    assert r.cash == 500_000
    assert r.net_debt == 350_000 and r.provenance["net_debt"] == "derived(debt-cash)"
    assert r.employees == 42
    assert (r.taxonomy, r.taxonomy_version, r.currency) == ("FRS-102", "2024-01-01", "GBP")
    assert r.period_length_days == 365
    assert r.accounts_type == "full_or_small_with_pl" and r.filleted is False
    assert r.audited is None and r.dormant is None
    assert r.completeness_score == 1.0
    assert r.funding_within_one_year["bank_loans"] == 300_000
    assert r.funding_after_one_year["bank_loans"] == 400_000
    assert r.funding_within_one_year["creditors_total"] == 600_000
    assert r.funding_after_one_year["intercompany"] == 200_000


def test_micro_filing_golden(spark):
    from ledgerkit.operators.extract import facts
    recs, parsed = _records(spark, [micro_filing()])
    r = recs["f0"]
    assert facts(parsed).count() == 7
    assert r.total_assets == 125_000 and r.total_liabilities == 65_000
    assert r.turnover is None and r.cash is None and r.net_debt is None
    assert r.accounts_type == "micro" and r.filleted is False
    assert r.completeness_score == 0.44


def test_net_cash(spark):
    recs, _ = _records(spark, [net_cash_filing()])
    r = recs["f0"]
    assert r.net_debt == -10_000
    assert r.provenance["net_debt"] == "derived(net cash; no debt tagged)"


def test_no_personal_columns(spark):
    import pytest
    from ledgerkit.operators.normalise import assert_no_personal_columns
    recs, parsed = _records(spark, [micro_filing()])
    with pytest.raises(ValueError):
        assert_no_personal_columns(spark.range(1).withColumnRenamed("id", "NameEntityOfficer"))


def test_slot_totals(spark):
    from ledgerkit.operators.normalise import slot_total
    df = spark.createDataFrame([(100.0, 50.0, 150.0), (None, None, 80.0), (100.0, None, None)], "w double, a double, p double")
    out = [r[0] for r in df.select(slot_total(F.col("w"), F.col("a"), F.col("p"))).collect()]
    assert out == [150.0, 80.0, 100.0]


def test_bad_filing_goes_to_rejects(spark):
    from ledgerkit.operators.extract import parse_filings, rejects
    df = spark.createDataFrame([("bad", None)], "filing_id string, content binary")
    assert parse_filings(df).count() == 1
    assert rejects(parse_filings(spark.createDataFrame([("ok", b"<html></html>")], "filing_id string, content binary"))).count() == 0


def _large_filing(facts, contexts):
    """A filing of many contexts, each fact in one of them; the last fact is the turnover's."""
    ctx = "".join(f'<xbrli:context id="c{i}"><xbrli:entity><xbrli:identifier scheme="s">12345678</xbrli:identifier></xbrli:entity><xbrli:period>'
                  f"<xbrli:startDate>2024-01-01</xbrli:startDate><xbrli:endDate>2024-12-31</xbrli:endDate></xbrli:period></xbrli:context>" for i in range(contexts))
    body = "".join(f'<p><ix:nonFraction name="c:{"TurnoverRevenue" if i == facts - 1 else "Other"}" contextRef="c{i % contexts}" unitRef="GBP">{i}</ix:nonFraction></p>' for i in range(facts))
    return (f'<html xmlns:ix="http://www.xbrl.org/2013/inlineXBRL" xmlns:xbrli="http://www.xbrl.org/2003/instance"><ix:resources>{ctx}</ix:resources>{body}</html>').encode()


def test_a_filing_of_many_facts_costs_in_proportion(spark):
    import time
    from ledgerkit.operators.extract import parse_filings
    from ledgerkit.operators.normalise import normalise
    schema = "filing_id string, content binary"

    def seconds(n):
        parsed = parse_filings(spark.createDataFrame([("f", _large_filing(n, n // 10))], schema)).cache()
        parsed.count()
        took = []
        for _ in range(3):
            t0 = time.time()
            row = normalise(parsed).collect()[0]
            took.append(time.time() - t0)
        parsed.unpersist()
        assert row["company_number"] == "12345678" and row["period_end"] == "2024-12-31"
        return min(took)

    small, large = seconds(2_000), seconds(20_000)
    assert large < 20 * small + 2


def test_of_contexts_with_one_id_the_last_counts(spark):
    from ledgerkit.functions.markup import parse_filing
    text = ('<html xmlns:ix="http://www.xbrl.org/2013/inlineXBRL" xmlns:xbrli="http://www.xbrl.org/2003/instance">'
            '<xbrli:context id="a"/><xbrli:context id="b"/><xbrli:context id="a"/><xbrli:context/>'
            '<ix:nonFraction name="c:X" contextRef="a">1</ix:nonFraction><ix:nonFraction name="c:X" contextRef="z">1</ix:nonFraction>'
            '<ix:nonFraction name="c:X">1</ix:nonFraction></html>')
    assert [f["context_at"] for f in parse_filing(text)["facts"]] == [2, None, None]


def test_a_record_walks_the_facts_a_few_times_not_once_for_each_field(spark):
    from ledgerkit.operators.extract import parse_filings
    from ledgerkit.operators.normalise import normalise
    parsed = parse_filings(spark.createDataFrame([("f", micro_filing().encode())], "filing_id string, content binary"))
    spark.conf.set("spark.sql.debug.maxToStringFields", 10_000)
    try:
        plan = normalise(parsed)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    assert plan.count("lambdafunction(") < 60


def test_synonyms_are_pooled_and_slots_are_summed(spark):
    def fact(concept, context, text):
        return f'<p><ix:nonFraction name="c:{concept}" contextRef="{context}">{text}</ix:nonFraction></p>'

    def context(cid, period, member=""):
        member = f'<xbrli:segment><xbrldi:explicitMember dimension="c:M">c:{member}</xbrldi:explicitMember></xbrli:segment>' if member else ""
        return f'<xbrli:context id="{cid}"><xbrli:entity>{member}</xbrli:entity><xbrli:period>{period}</xbrli:period></xbrli:context>'

    now, before = "<xbrli:instant>2024-12-31</xbrli:instant>", "<xbrli:instant>2023-12-31</xbrli:instant>"
    text = ('<html xmlns:ix="http://www.xbrl.org/2013/inlineXBRL" xmlns:xbrli="http://www.xbrl.org/2003/instance" xmlns:xbrldi="http://xbrl.org/2006/xbrldi">'
            + context("n", now) + context("b", before) + context("w", now, "WithinOneYear") + context("a", now, "AfterOneYear")
            + fact("CashBankOnHand", "b", "900") + fact("CashBankInHand", "n", "(70)") + fact("CashCashEquivalents", "n", "70")
            + fact("BankLoans", "w", "1.10") + fact("BankOverdrafts", "w", "2.20") + fact("BankLoans", "b", "5") + fact("OtherLoans", "a", "x")
            + fact("Creditors", "a", "8") + fact("Creditors", "a", "6") + fact("Equity", "b", "4") + fact("NumberEmployees", "z", "(3)") + "</html>")
    r = _records(spark, [text])[0]["f0"]
    assert (r.cash, r.net_assets, r.employees) == (-70.0, 4.0, 3.0) and sorted(r.out_of_period) == ["employees", "equity"]
    assert r.funding_within_one_year["bank_loans"] == 3.3 and r.funding_after_one_year["bank_loans"] is None
    assert r.funding_after_one_year["other_loans"] is None and r.funding_after_one_year["creditors_total"] == 6.0
    assert r.net_debt == 73.3 and r.provenance["net_debt"] == "derived(debt-cash)" and r.provenance["cash"] == "reported"
