"""Registered queries: each is ``(spark, sf_dir) -> DataFrame`` over the whole tables."""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import answer_number, displayed_number, raw_number
from ..operators import aggregates as A
from ..operators import benchmark as B
from ..operators import entities as E
from ..operators import extract as X
from ..operators import grading as G
from ..operators import metadata as M
from ..operators import render as R
from ..operators import sampling as W
from ..operators.normalise import flatten_record, normalise
from ..session import checkpoint_dir, materialise
from ..sinks import writers as K
from ..sources import catalogs as C
from ..sources.tables import table
from . import raw_benchmark as RB
from .dataset import build_product, read_dataset
from .entity_dataset import build_entity_dataset
from .virtual import virtual_filings

def filings(spark: SparkSession, sf: str) -> DataFrame:
    return virtual_filings(table(spark, sf, "orders"), table(spark, sf, "lineitem"))


def filings_of(spark: SparkSession, sf: str, ids: DataFrame) -> DataFrame:
    """The filings of these ids (filing_id); no other filing's markup is written."""
    keys = ids.select(F.substring("filing_id", 2, 30).cast("long").alias("_key")).distinct()
    orders, lines = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    return virtual_filings(orders.join(keys, orders["o_orderkey"] == keys["_key"], "left_semi"),
                           lines.join(keys, lines["l_orderkey"] == keys["_key"], "left_semi"))


def parsed(spark: SparkSession, sf: str) -> DataFrame:
    return X.parse_filings(filings(spark, sf))


def records(spark: SparkSession, sf: str) -> DataFrame:
    return normalise(parsed(spark, sf))


RECORD_COLUMNS = [
    "filing_id", "company_number", "taxonomy", "taxonomy_version", "accounting_standard", "currency",
    "period_start", "period_end", "period_length_days", "turnover", "total_assets", "total_liabilities",
    "net_assets", "employees", "operating_profit", "current_assets", "net_current_assets",
    "total_assets_less_current_liabilities", "cash", "net_debt",
    "f_within_bank_loans", "f_after_bank_loans", "f_within_finance_leases", "f_after_finance_leases",
    "f_within_trade_creditors", "f_after_trade_creditors", "f_within_creditors_total", "f_after_creditors_total",
    "accounts_type", "filleted", "audited", "dormant", "completeness_score", "provenance",
]


def q_records(spark, sf):
    """Flagship: one normalised record per filing (X1-X11 -> N1-N29 -> N28)."""
    return flatten_record(records(spark, sf)).select(*RECORD_COLUMNS)


def q_extract_facts_roundtrip(spark, sf):
    return X.facts(parsed(spark, sf)).select(
        "filing_id", "ord", "kind", "concept", "namespace", "value", "scale", "sign", "context_ref", "unit_ref")


def q_parse_displayed_number(spark, sf):
    """X7 over every number-looking token of every document."""
    d = table(spark, sf, "documents").select("doc_id", F.explode(
        F.regexp_extract_all("text", F.lit("\\(?-?[0-9][0-9,.]*\\)?"), 0)).alias("token"))
    return (d.groupBy("doc_id", "token").agg(F.count(F.lit(1)).alias("n"))
            .select("doc_id", "token", "n", displayed_number(F.col("token")).alias("value"),
                    displayed_number(F.col("token"), F.lit("3")).alias("value_thousands"),
                    displayed_number(F.col("token"), F.lit("x"), F.lit("-")).alias("value_signed")))


def q_primary_period(spark, sf):
    return records(spark, sf).select("filing_id", "company_number", "period_start", "period_end",
                                     "period_length_days")


def q_pick_values(spark, sf):
    r = records(spark, sf)
    oop = F.col("out_of_period")
    flags = {f"{f}_in_period": F.when(F.col(f).isNotNull(), ~F.array_contains(oop, f))
             for f in ("current_assets", "cash", "turnover", "operating_profit", "employees")}
    na_src = F.col("provenance")["net_assets"]
    flags["net_assets_in_period"] = (F.when(na_src == "reported", ~F.array_contains(oop, "net_assets"))
                                     .when(na_src == "reported(equity)", ~F.array_contains(oop, "equity")))
    return r.select("filing_id", "current_assets", "cash", "net_current_assets",
                    F.col("total_assets_less_current_liabilities").alias("talcl"), "net_assets",
                    "turnover", "operating_profit", "employees", *[c.alias(k) for k, c in flags.items()])


def q_employees(spark, sf):
    """N6 + V5: employee facts, raw displayed number vs scaled value."""
    f = X.facts(parsed(spark, sf)).filter(F.col("concept") == "AverageNumberEmployeesDuringPeriod")
    return f.select("filing_id", "ord", raw_number(F.col("raw_text")).alias("employees_raw"),
                    F.col("value").alias("employees_scaled"),
                    (F.abs(raw_number(F.col("raw_text"))) != F.abs(F.col("value"))).alias("scale_anomaly"))


def q_funding_breakdown(spark, sf):
    r = records(spark, sf)
    fw, fa = F.col("funding_within_one_year"), F.col("funding_after_one_year")
    return r.select(
        "filing_id",
        fw["bank_loans"].alias("f_within_bank_loans"), fa["bank_loans"].alias("f_after_bank_loans"),
        fw["finance_leases"].alias("f_within_finance_leases"), fa["finance_leases"].alias("f_after_finance_leases"),
        fw["trade_creditors"].alias("f_within_trade_creditors"),
        fa["trade_creditors"].alias("f_after_trade_creditors"),
        fw["creditors_total"].alias("f_within_creditors_total"),
        fa["creditors_total"].alias("f_after_creditors_total"))


def q_net_debt(spark, sf):
    r = records(spark, sf)
    return r.select("filing_id", "cash", "net_debt", F.col("provenance")["net_debt"].alias("net_debt_prov"))


def q_derive_totals(spark, sf):
    r = records(spark, sf)
    p = F.col("provenance")
    return r.select("filing_id", "total_assets", p["total_assets"].alias("total_assets_prov"),
                    "net_assets", p["net_assets"].alias("net_assets_prov"),
                    "total_liabilities", p["total_liabilities"].alias("total_liabilities_prov"))


def q_classify_filing(spark, sf):
    return records(spark, sf).select(
        "filing_id", "taxonomy", "taxonomy_version", "accounting_standard", "currency", "accounts_type",
        "filleted", "audited", "dormant", "period_length_days", "completeness_score")


QUERIES = {
    "records": q_records,
    "extract_facts_roundtrip": q_extract_facts_roundtrip,
    "parse_displayed_number": q_parse_displayed_number,
    "primary_period": q_primary_period,
    "pick_values": q_pick_values,
    "employees": q_employees,
    "funding_breakdown": q_funding_breakdown,
    "net_debt": q_net_debt,
    "derive_totals": q_derive_totals,
    "classify_filing": q_classify_filing,
}


# ---- aggregates, metadata, sampling, benchmark items -----------------------------------


def companies(spark, sf):
    return M.company_rows(table(spark, sf, "customer"), table(spark, sf, "nation"), table(spark, sf, "region"))


def meta(spark, sf):
    return M.metadata_projection(companies(spark, sf))


def product(spark, sf):
    """Published dataset rows (D2): flat records with company metadata."""
    return flatten_record(M.join_metadata(records(spark, sf), meta(spark, sf)))


def latest(spark, sf):
    return W.latest_per_company(product(spark, sf))


def latest_table(spark, sf):
    """``latest`` written once (a table in the checkpoint folder) for jobs that read it
    many times."""
    return materialise(latest(spark, sf))


def q_coverage(spark, sf):
    return A.field_coverage(product(spark, sf))


def q_distribution(spark, sf):
    p = materialise(product(spark, sf).select("taxonomy", "accounts_type"))  # read twice, parsed once
    t = A.distribution(p, "taxonomy").select(F.lit("taxonomy").alias("dimension"),
                                             F.col("taxonomy").alias("value"), "n")
    a = A.distribution(p, "accounts_type").select(F.lit("accounts_type").alias("dimension"),
                                                  F.col("accounts_type").alias("value"), "n")
    return t.unionByName(a)


def q_top_concepts(spark, sf):
    return A.top_concepts(X.facts(parsed(spark, sf)))


def q_unique_companies(spark, sf):
    return A.unique_companies(records(spark, sf))


def q_metadata_join(spark, sf):
    return product(spark, sf).select("filing_id", "company_number", "company_name", "company_type",
                                     "company_status", "accounts_category", "sic_codes", "region_outcode",
                                     "post_town", "country")


def q_wanted_companies(spark, sf):
    return M.wanted_companies(meta(spark, sf), records(spark, sf)).select("company_number", "company_name")


def q_match_rate(spark, sf):
    return M.match_rate(product(spark, sf))


def q_key_format_probe(spark, sf):
    return M.key_format_probe(records(spark, sf), "company_number", companies(spark, sf), "CompanyNumber")


def q_latest_per_company(spark, sf):
    return latest(spark, sf).select("company_number", "filing_id", "period_end", "net_assets")


def q_sample_n(spark, sf):
    c = table(spark, sf, "customer")
    return W.sample_n(c, 100, 42, F.col("c_custkey").cast("string")).select("c_custkey", "c_name")


def q_sample_per_archive(spark, sf):
    d = table(spark, sf, "documents")
    return W.sample_per_group(d, "source", 5, 11, F.col("doc_id").cast("string")).select("doc_id", "source")


def q_shuffle_number(spark, sf):
    c = W.sample_n(table(spark, sf, "customer"), 100, 42, F.col("c_custkey").cast("string"))
    return W.shuffle_and_number(c, "q", 42, F.col("c_custkey").cast("string")).select("id", "c_custkey")


def q_groups_of_five(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    g = W.groups_of_draws(c, "c_custkey", 200, 5, 42)
    return W.winner_of(g, "c_acctbal", "c_name")


def q_items_extraction(spark, sf):
    return B.items_extraction(latest_table(spark, sf))


def q_items_not_disclosed(spark, sf):
    return B.items_not_disclosed(latest_table(spark, sf))


def q_items_comparison(spark, sf):
    return B.items_comparison(latest_table(spark, sf))


def q_items_ratio(spark, sf):
    return B.items_ratio(latest_table(spark, sf))


def q_items_boolean(spark, sf):
    return B.items_boolean(latest_table(spark, sf))


def q_benchmark_table(spark, sf):
    return B.benchmark_table(latest_table(spark, sf))


QUERIES.update({
    "coverage": q_coverage,
    "distribution": q_distribution,
    "top_concepts": q_top_concepts,
    "unique_companies": q_unique_companies,
    "metadata_join": q_metadata_join,
    "wanted_companies": q_wanted_companies,
    "match_rate": q_match_rate,
    "key_format_probe": q_key_format_probe,
    "latest_per_company": q_latest_per_company,
    "sample_n": q_sample_n,
    "sample_per_archive": q_sample_per_archive,
    "shuffle_number": q_shuffle_number,
    "groups_of_five": q_groups_of_five,
    "items_extraction": q_items_extraction,
    "items_not_disclosed": q_items_not_disclosed,
    "items_comparison": q_items_comparison,
    "items_ratio": q_items_ratio,
    "items_boolean": q_items_boolean,
    "benchmark_table": q_benchmark_table,
})


# ---- grading ------------------------------------------------------------------------------


def numeric_answers(spark, sf):
    """Free-text numeric answers written from lineitem (one per line, many styles)."""
    li = table(spark, sf, "lineitem")
    p, q = F.col("l_extendedprice"), F.col("l_quantity")
    style = F.col("l_linenumber")
    text = (F.when(style == 1, F.concat(F.lit("£"), F.format_number(p, 0)))
            .when(style == 2, F.concat(F.lit("about "), F.format_number(q, 0), F.lit("k")))
            .when(style == 3, F.concat(F.lit("("), F.format_number(p, 2), F.lit(")")))
            .when(style == 4, F.concat(F.lit("roughly £"), F.format_number(p / 1e6, 3), F.lit(" million")))
            .when(style == 5, F.concat(F.format_number(p, 2), F.lit(" / 1 = "), F.format_number(p, 2)))
            .when(style == 6, F.lit("The figure is not disclosed."))
            .otherwise(F.concat(F.lit("It was "), F.format_number(p * (1 + F.col("l_discount")), 2), F.lit("."))))
    truth = F.when(style == 2, q * 1000).otherwise(p)
    return li.select("l_orderkey", "l_linenumber", text.alias("model_text"), truth.alias("truth"))


def q_grade_numeric(spark, sf):
    a = numeric_answers(spark, sf)
    return a.select("l_orderkey", "l_linenumber", "model_text", answer_number(F.col("model_text")).alias("parsed"),
                    G.grade_numeric(F.col("model_text"), F.col("truth")).alias("correct"))


def q_grade_choice(spark, sf):
    c = table(spark, sf, "customer")
    k = F.col("c_custkey") % 5
    other = F.concat(F.lit("Customer#"), F.lpad((F.col("c_custkey") + 1).cast("string"), 9, "0"))
    text = (F.when(k == 0, F.concat(F.lower("c_name"), F.lit(" ltd")))
            .when(k == 1, F.concat(F.lit("The "), F.col("c_name"), F.lit(" Limited")))
            .when(k == 2, other).when(k == 3, F.lit("Ltd"))
            .otherwise(F.regexp_replace("c_name", "#", " & ")))
    return c.select("c_custkey", text.alias("model_text"), G.grade_choice(text, F.col("c_name")).alias("correct"))


def q_grade_boolean(spark, sf):
    c = table(spark, sf, "conversations")
    truth = F.col("turn") % 2 == 0
    return c.select("conv_id", "turn", G.grade_boolean(F.col("text"), truth).alias("correct"))


def q_grade_not_disclosed(spark, sf):
    c = table(spark, sf, "conversations")
    return c.select("conv_id", "turn", G.grade_not_disclosed(F.col("text")).alias("correct"))


def item_answers(items):
    """Answers table for two pretend models, written from each item by hash
    (right, wrong, negated, errored), so grading has every branch to walk."""
    def one(provider, model, salt):
        h = F.conv(F.substring(F.md5(F.concat(F.lit(salt), F.col("id"))), 1, 2), 16, 10).cast("int") % 10
        good = (F.when(F.col("answer_type") == "numeric", F.format_number("answer_num", 2))
                .when(F.col("answer_type") == "choice", F.col("answer_text"))
                .when(F.col("answer_type") == "boolean",
                      F.when(F.col("answer_bool"), F.lit("Yes, it is.")).otherwise(F.lit("No.")))
                .otherwise(F.lit("That figure is not disclosed in these accounts.")))
        text = (F.when(h == 0, F.lit("<error: timeout>"))
                .when(h <= 6, good)
                .when(h == 7, F.when(F.col("answer_type") == "numeric",
                                     F.concat(F.lit("-"), F.format_number("answer_num", 2))).otherwise(F.lit("Ltd")))
                .when(h == 8, F.lit("I am not sure."))
                .otherwise(F.lit("Approximately £1.2 million")))
        return items.select(F.col("id").alias("item_id"), F.lit(provider).alias("provider"),
                            F.lit(model).alias("model"), text.alias("model_answer"))
    return one("p1", "m1", "a:").unionByName(one("p2", "m2", "b:"))


def graded(spark, sf, lat=None):
    lat = lat if lat is not None else latest_table(spark, sf)
    items = materialise(B.benchmark_table(lat))
    return G.score(items, item_answers(items))


def q_accuracy(spark, sf):
    return G.accuracy(graded(spark, sf))


def q_regrade(spark, sf):
    lat = latest_table(spark, sf)
    return G.regrade(graded(spark, sf, lat), lat, trap_category="not_disclosed")


def q_sign_flips(spark, sf):
    return G.sign_flips(graded(spark, sf))


QUERIES.update({
    "grade_numeric": q_grade_numeric,
    "grade_choice": q_grade_choice,
    "grade_boolean": q_grade_boolean,
    "grade_not_disclosed": q_grade_not_disclosed,
    "accuracy": q_accuracy,
    "regrade": q_regrade,
    "sign_flips": q_sign_flips,
})


# ---- entities, charges, catalogs ------------------------------------------------------------


def part_companies(spark, sf):
    """Company rows for term matching: one per part (name from part name and brand)."""
    p = table(spark, sf, "part")
    plc = F.col("p_size") % 3 == 0
    return p.select(F.col("p_partkey").cast("string").alias("company_number"),
                    F.concat(F.upper("p_name"), F.lit(" "), F.upper("p_brand"),
                             F.when(plc, F.lit(" PLC")).otherwise(F.lit(" LIMITED"))).alias("company_name"),
                    F.when(plc, F.lit("plc")).otherwise(F.lit("ltd")).alias("company_type"))


def part_terms(spark, sf):
    """Seed terms: the distinct words of part names; even length -> lender list."""
    w = table(spark, sf, "part").select(F.explode(F.split("p_name", " ")).alias("term")).distinct()
    w = w.withColumn("category", F.when(F.length("term") % 2 == 0, F.lit("lender")).otherwise(F.lit("spv")))
    return E.rank_terms(w.withColumn("rank", F.col("term")))


def supplier_targets(spark, sf):
    s = table(spark, sf, "supplier")
    spv = F.col("s_suppkey") % 2 == 0
    return s.select(
        F.col("s_suppkey").cast("string").alias("company_number"),
        F.format_string("SUPPLIER %d FUNDING 20%02d-1 PLC", F.col("s_suppkey"), F.col("s_nationkey")).alias(
            "company_name"),
        F.lit("active").alias("company_status"), F.lit("plc").alias("company_type"),
        F.lit("2020-01-01").alias("date_of_creation"),
        F.when(spv, F.lit("spv")).otherwise(F.lit("lender")).alias("category"),
        F.when(spv, F.lit("securitisation vehicle")).otherwise(F.lit("non-bank lender")).alias("refined_entity_type"),
        F.when(F.col("s_nationkey") % 3 == 0, F.lit("auto")).when(F.col("s_nationkey") % 3 == 1, F.lit("mortgage"))
        .otherwise(F.lit("consumer")).alias("asset_class_guess"),
        (F.col("s_acctbal") > 0).cast("string").alias("strict_non_bank_lender_scope"))


def event_charges(spark, sf):
    """Charges register rows from events: JSON props parsed with a declared schema."""
    e = table(spark, sf, "events")
    k = F.from_json("props", "k INT")["k"]
    person = lambda n: F.struct(F.lit(n).alias("name"))
    persons = (F.when(k % 3 == 0, F.array(person("GLAS TRUST CORPORATION LIMITED")))
               .when(k % 3 == 1, F.array(person("Jane Doe")))
               .otherwise(F.array(person("HSBC BANK PLC"), person("John Smith"))))
    status = (F.when(F.col("event_type") == "purchase", F.lit("satisfied"))
              .when(F.col("event_type") == "error", F.lit("part-satisfied")).otherwise(F.lit("outstanding")))
    day = F.date_format("ts", "yyyy-MM-dd")
    ch = F.struct(
        F.concat(F.lit("C"), F.col("event_id").cast("string")).alias("charge_code"),
        F.col("event_id").alias("charge_number"), status.alias("status"), day.alias("created_on"),
        day.alias("delivered_on"), F.when(status == "satisfied", day).alias("satisfied_on"),
        F.struct(F.concat(F.lit("Charge of type "), F.col("event_type")).alias("description")).alias("classification"),
        F.struct(F.lit("All monies due").alias("description")).alias("secured_details"),
        F.struct(F.lit("Fixed and floating charge").alias("description"),
                 (F.col("value") > 50).alias("contains_fixed_charge"),
                 (F.col("value") <= 50).alias("contains_floating_charge"),
                 (k % 2 == 0).alias("contains_negative_pledge")).alias("particulars"),
        persons.alias("persons_entitled"))
    return e.select(F.col("user_id").cast("string").alias("company_number"), ch.alias("ch"))


def q_match_terms(spark, sf):
    return E.match_terms(part_companies(spark, sf), part_terms(spark, sf)).select("company_number", "term")


def q_find_entities(spark, sf):
    return E.find_entities(part_companies(spark, sf), part_terms(spark, sf)).select(
        "company_number", "company_name", "category", "matched_terms")


def q_term_hits(spark, sf):
    return E.term_hit_counts(part_companies(spark, sf), part_terms(spark, sf))


def q_shelf_of(spark, sf):
    p = table(spark, sf, "part")
    name = F.concat(F.upper("p_name"), F.lit(" FUNDING "), (F.col("p_size") % 30 + 2000).cast("string"),
                    F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("-"), (F.col("p_size") % 5).cast("string")))
                    .otherwise(F.lit("")), F.lit(" NO."), (F.col("p_size") % 7).cast("string"), F.lit(" PLC"))
    return p.select("p_partkey", name.alias("name"), E.shelf_of(name).alias("shelf"))


def q_charge_rows(spark, sf):
    return E.charge_rows(event_charges(spark, sf), supplier_targets(spark, sf)).select(
        "company_number", "charge_code", "status", "category", "shelf", "persons_entitled",
        "persons_entitled_has_individual", "contains_negative_pledge")


def q_charge_summary(spark, sf):
    return E.charge_summary(event_charges(spark, sf))


def q_entities(spark, sf):
    return E.entity_rows(supplier_targets(spark, sf), event_charges(spark, sf))


def index_pages(spark, sf):
    """Archive index text, one page per order (daily archive, company snapshot, month)."""
    o = table(spark, sf, "orders")
    d = F.date_format("o_orderdate", "yyyy-MM-dd")
    daily = F.concat(F.lit('<li><a href="Accounts_Bulk_Data-'), d, F.lit('.zip">Accounts_Bulk_Data-'), d,
                     F.lit(".zip"),
                     F.when(F.col("o_orderkey") % 3 != 0, F.concat(F.lit(" ("), F.format_number(
                         F.col("o_totalprice") / 1e4, 1), F.lit(" MiB)"))).otherwise(F.lit("")), F.lit("</a></li>"))
    company = F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("<li>BasicCompanyDataAsOneFile-"), d,
                                                             F.lit(".zip</li>"))).otherwise(F.lit(""))
    monthly = F.concat(F.lit("<li>Accounts_Monthly_Data-"), F.date_format("o_orderdate", "MMMM"),
                       F.date_format("o_orderdate", "yyyy"), F.lit(".zip</li>"))
    return o.select(F.col("o_orderkey").alias("page_id"), F.concat(daily, company, monthly).alias("html"))


def q_archive_catalog(spark, sf):
    return C.archive_catalog(index_pages(spark, sf))


def q_company_catalog(spark, sf):
    return C.company_catalog(index_pages(spark, sf))


def q_monthly_catalog(spark, sf):
    return C.monthly_catalog(index_pages(spark, sf))


def q_trailing_months(spark, sf):
    return C.trailing_months(C.monthly_catalog(index_pages(spark, sf)), 12)


def q_smallest_recent(spark, sf):
    return C.smallest_recent(C.archive_catalog(index_pages(spark, sf)), 15)


QUERIES.update({
    "match_terms": q_match_terms,
    "find_entities": q_find_entities,
    "term_hits": q_term_hits,
    "shelf_of": q_shelf_of,
    "charge_rows": q_charge_rows,
    "charge_summary": q_charge_summary,
    "entities": q_entities,
    "archive_catalog": q_archive_catalog,
    "company_catalog": q_company_catalog,
    "monthly_catalog": q_monthly_catalog,
    "trailing_months": q_trailing_months,
    "smallest_recent": q_smallest_recent,
})


# ---- rendering and text checks (rows-only: the oracle has no markup renderer) -------------


def q_render_redacted(spark, sf):
    p = table(spark, sf, "pages")
    t = R.render_redacted(F.col("html"))
    return p.select("page_id", t.alias("text")).select(
        "page_id", F.length("text").alias("n_chars"), R.css_leak(F.col("text")).alias("css_leak"),
        (F.length("text") - F.length(F.replace("text", F.lit("[redacted]"), F.lit("")))).alias("redacted_chars"))


def q_render_filings(spark, sf):
    """E14 over the virtual filings: length and digest of the exact text."""
    t = filings(spark, sf).select("filing_id", R.render_redacted(F.col("content")).alias("text"))
    return t.select("filing_id", F.char_length("text").alias("n_chars"), F.md5("text").alias("text_md5"),
                    R.css_leak(F.col("text")).alias("css_leak"))


def q_figure_visible(spark, sf):
    """V1 + V2 over rendered virtual filings, for the net-assets figure of each record.

    Each filing's markup stays beside its record, so it is written once and moves in no join.  Of
    orders whose key comes more than once, every text is checked for every figure of the key."""
    orders, lines = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    often = materialise(orders.groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("o_orderkey"))

    def with_figure(f, keep):
        return normalise(X.parse_filings(f), keep=keep).filter(F.col("net_assets").isNotNull())

    once = virtual_filings(orders.join(often, "o_orderkey", "left_anti"), lines).filter(F.col("filing_id").isNotNull())
    hit = with_figure(once.withColumn("markup", F.col("content")), ("markup",)).select("filing_id", "net_assets", "markup")
    if not often.isEmpty():
        f = virtual_filings(orders.join(often, "o_orderkey", "left_semi"),
                            lines.join(often, lines["l_orderkey"] == often["o_orderkey"], "left_semi"))
        r = with_figure(f, ()).select("filing_id", "net_assets")
        hit = hit.unionByName(f.join(r, "filing_id").select("filing_id", "net_assets", F.col("content").alias("markup")))
    t = hit.select("filing_id", "net_assets", R.render_redacted(F.col("markup")).alias("text"))
    return t.select("filing_id", R.figure_visible(F.col("text"), F.abs("net_assets")).alias("visible"),
                    R.css_leak(F.col("text")).alias("css_leak"),
                    (F.instr("text", "[redacted]") > 0).alias("officer_redacted"))


QUERIES.update({
    "render_redacted": q_render_redacted,
    "figure_visible": q_figure_visible,
    "render_filings": q_render_filings,
})


# ---- raw-filing benchmarks (D5 = B6 + B7) and the post-cut-off slice (B8) --------------------

RAW_OUT = ["id", "category", "answer_type", "field", "company_number", "filing_id", "period_end",
           "answer_num", "answer_text"]


def q_raw_benchmark(spark, sf):
    """D5 over every archive of the data set (members = all filings); the markup of a round's
    filings is written for that round."""
    members = filings(spark, sf).select("filing_id", "source_file")
    return RB.build_raw_benchmark(latest_table(spark, sf), lambda ids: filings_of(spark, sf, ids), members=members
                                  ).select(*RAW_OUT)


def q_latest_in_archive(spark, sf):
    """Companies whose latest filing is in the newest archive month."""
    f = filings(spark, sf)
    return RB.latest_in_archive(latest(spark, sf), RB.newest_archive_members(f)).select(
        "company_number", "filing_id", "source_file")


def cutoff_models(spark, sf):
    """Model release list (S11 shape) derived from all orders: one 'model' per order
    priority, released 30 days times its number after its first order."""
    first = table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("name")).agg(F.min(F.to_date("o_orderdate")).alias("first"))
    return first.select("name", F.date_add("first", F.substring("name", 1, 1).cast("int") * 30).alias("released"))


def q_contamination_threshold(spark, sf):
    return RB.contamination_threshold(cutoff_models(spark, sf))


def q_post_cutoff(spark, sf):
    """B8 over all filings after the threshold; the markup of a round's filings is written for that round."""
    thr = RB.contamination_threshold(cutoff_models(spark, sf)).first()["threshold"]  # one scalar
    sampled = RB.post_cutoff_filings(filings(spark, sf), thr)
    recs = materialise(flatten_record(M.join_metadata(normalise(X.parse_filings(sampled)), meta(spark, sf))))
    return RB.build_post_cutoff(recs, lambda ids: RB.post_cutoff_filings(filings_of(spark, sf, ids), thr)).select(*RAW_OUT)


QUERIES.update({
    "raw_benchmark": q_raw_benchmark,
    "latest_in_archive": q_latest_in_archive,
    "contamination_threshold": q_contamination_threshold,
    "post_cutoff": q_post_cutoff,
})


# ---- further operators on the same tables ----------------------------------------------------


def q_facts_with_context(spark, sf):
    """J3 / N3 in table form: each fact with its context's period and dimension count.
    The parsed filings are written once and read as two tables (one parse)."""
    p = materialise(parsed(spark, sf))
    fc = X.facts_with_context(X.facts(p), X.contexts(p))
    return fc.select("filing_id", "ord", "concept", "context_ref", "period_type", "period_end",
                     F.size("dimensions").alias("n_dimensions"))


def q_rejects(spark, sf):
    """X11 over virtual filings some of which are broken: every tenth customer's filings are
    empty, the next tenth's are missing, the next one's hold no markup."""
    f = filings(spark, sf).join(table(spark, sf, "orders").select(
        F.concat(F.lit("F"), F.col("o_orderkey")).alias("filing_id"), (F.col("o_custkey") % 10).alias("_k")), "filing_id")
    broken = F.when(F.col("_k") == 0, F.encode(F.lit(""), "UTF-8")).when(F.col("_k") == 2, F.encode(F.lit("no markup"), "UTF-8"))
    return X.rejects(X.parse_filings(f.withColumn("content", F.when(F.col("_k") <= 2, broken).otherwise(F.col("content"))).drop("_k")))


def q_distinct_numbers(spark, sf):
    return A.distinct_numbers(records(spark, sf))


def q_cap_filings(spark, sf):
    """A trial build's cap, three filings per daily archive."""
    return W.cap_per_group(filings(spark, sf).drop("content"), "archive", 3, "filing_id").select(
        "archive", "filing_id")


def q_items_by_category(spark, sf):
    return B.items_by_category(B.benchmark_table(latest_table(spark, sf)))


def q_candidate_counts(spark, sf):
    return E.candidate_counts(E.find_entities(part_companies(spark, sf), part_terms(spark, sf)))


def q_targets_in_dataset(spark, sf):
    return E.targets_in_dataset(supplier_targets(spark, sf), records(spark, sf))


def q_first_wrong_answers(spark, sf):
    return G.first_wrong_answers(graded(spark, sf)).select("provider", "model", "item_id", "category",
                                                          "model_answer")


def q_item_sample(spark, sf):
    """K9: the public sample of the first items (raw-filing variant shows only the question)."""
    return K.item_sample(B.benchmark_table(latest_table(spark, sf)), 12, private_context=True)


def q_manifest(spark, sf):
    """One manifest row (coverage, companies, distributions as JSON text)."""
    m = A.manifest(materialise(product(spark, sf)))  # several aggregates, one parse
    return m.select(*[c for c in m.columns if not c.endswith("_distribution")],
                    F.to_json("taxonomy_distribution").alias("taxonomy_distribution"),
                    F.to_json("accounts_type_distribution").alias("accounts_type_distribution"))


def _own_folder(spark, name):
    return f"{checkpoint_dir(spark).rstrip('/')}/ledgerkit-{name}/{uuid.uuid4().hex}"


#: Charges of one file of the register, which one task reads.
REGISTER_FILE_CHARGES = 25_000


def register_charges(spark, sf):
    """The charges register as JSON documents in text files (one event a document), read back."""
    folder = _own_folder(spark, "register")
    texts = event_charges(spark, sf).select(F.to_json(F.create_map("company_number", F.array("ch"))))
    texts.write.option("maxRecordsPerFile", REGISTER_FILE_CHARGES).text(folder)
    return E.read_charges(spark, folder)


def q_register_charges(spark, sf):
    """S8 -> P2: annotated charges out of the register's files."""
    return E.charge_rows(register_charges(spark, sf), supplier_targets(spark, sf)).select(
        "company_number", "charge_code", "status", "category", "shelf", "persons_entitled",
        "persons_entitled_has_individual", "contains_negative_pledge")


def q_entity_dataset(spark, sf):
    """The job writes entities, charges and manifest; its entities file is read back."""
    targets, charges = supplier_targets(spark, sf), register_charges(spark, sf)
    made = build_entity_dataset(targets, charges, _own_folder(spark, "entities"), "1")
    back = spark.read.schema(E.entity_rows(targets, charges).schema).option("header", True).csv(made["entities"])
    return back.fillna("", ["shelf"])


def q_build_product(spark, sf):
    """D3: the trailing twelve months are built, published with metadata and read back, by month."""
    base = _own_folder(spark, "product")
    build_product(filings(spark, sf), meta(spark, sf), base, "1")
    return read_dataset(spark, base).groupBy(F.col("month").cast("string").alias("month")).agg(
        F.count(F.lit(1)).alias("filings"), F.countDistinct("company_number").alias("companies"),
        F.count("company_name").alias("matched"), F.count("net_assets").alias("with_net_assets"))


QUERIES.update({
    "register_charges": q_register_charges,
    "entity_dataset": q_entity_dataset,
    "build_product": q_build_product,
    "facts_with_context": q_facts_with_context,
    "distinct_numbers": q_distinct_numbers,
    "rejects": q_rejects,
    "cap_filings": q_cap_filings,
    "items_by_category": q_items_by_category,
    "candidate_counts": q_candidate_counts,
    "targets_in_dataset": q_targets_in_dataset,
    "first_wrong_answers": q_first_wrong_answers,
    "item_sample": q_item_sample,
    "manifest": q_manifest,
})
