"""Virtual filings: one inline-XBRL document per order, written by native Spark.

The test tables hold no filings, so each order becomes one filing whose facts
are its lineitems (mapping below).  The markup is produced with column
expressions only; the extraction operators then read it back, and the DuckDB
oracle computes the same answers straight from ``orders``/``lineitem``.

Mapping (fixed rule, shared with the oracle SQL):
* filing_id ``F<o_orderkey>``; company number = ``o_custkey`` as text (unpadded);
  archive = ``Accounts_Bulk_Data-<o_orderdate>.zip``; published = ``o_orderdate``.
* period end = 31 Dec of the order year; closed lines (``l_linestatus='F'``) sit in
  the current period, open lines (``'O'``) in the prior year.
* concept = ``l_linenumber`` 1-7, even / odd ``l_suppkey`` (see CONCEPT_BY_LINE).
* context slot = ``l_returnflag``: A plain, N within one year, R after one year.
* displayed number: ``l_tax > 0.04`` -> quantity shown in thousands (scale 3),
  else extended price with two decimals (scale 0).
* sign style by ``l_discount``: < .03 plain, < .05 brackets in the tag text,
  < .07 brackets in the surrounding text, < .08 brackets in neighbour spans,
  else ``sign="-"``.
* taxonomy by ``o_orderpriority``; currency EUR for status O, else GBP;
  dormant / audit / accounts-type / officer tags from status, customer and price.
* document order of the facts = lineitems sorted by every lineitem column.
"""
from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import normalise_number

# ---- fixed values of the mapping ------------------------------------------------
CONCEPT_BY_LINE = {  # l_linenumber -> (even l_suppkey, odd l_suppkey)
    1: ("FixedAssets", "TotalAssetsLessCurrentLiabilities"),
    2: ("CurrentAssets", "NetCurrentAssetsLiabilities"),
    3: ("NetAssetsLiabilities", "Equity"),
    4: ("CashBankOnHand", "Turnover"),
    5: ("BankBorrowings", "NetObligationsUnderFinanceLeasesHirePurchaseContracts"),
    6: ("Creditors", "TradeCreditors"),
    7: ("AverageNumberEmployeesDuringPeriod", "OperatingProfitLoss"),
}
DURATION_CONCEPTS = ["Turnover", "OperatingProfitLoss", "AverageNumberEmployeesDuringPeriod"]
TAXONOMY_REF_BY_PRIORITY = {
    "1-URGENT": "https://xbrl.frc.org.uk/FRS-102/2023-01-01/FRS-102-2023-01-01.xsd",
    "2-HIGH": "https://xbrl.frc.org.uk/FRS-102/2024-01-01/FRS-102-2024-01-01.xsd",
    "3-MEDIUM": "https://xbrl.frc.org.uk/FRS-105/2024-01-01/FRS-105-2024-01-01.xsd",
    "4-NOT SPECIFIED": "https://xbrl.example.org/core/2022-01-01/core.xsd",
    "5-LOW": "https://xbrl.ifrs.org/taxonomy/2023-03-23/full_ifrs-cor_2023-03-23.xsd",
}
IX_2013 = "http://www.xbrl.org/2013/inlineXBRL"
IX_2008 = "http://www.xbrl.org/2008/inlineXBRL"
EXEMPTION_CONCEPT = "StatementThatCompanyEntitledToExemptionFromAuditUnderSection477CompaniesAct2006"
# -----------------------------------------------------------------------------------

_HEAD = (
    '<?xml version="1.0" encoding="utf-8"?>'
    '<html xmlns="http://www.w3.org/1999/xhtml" xmlns:ix="{ix}" '
    'xmlns:xbrli="http://www.xbrl.org/2003/instance" xmlns:link="http://www.xbrl.org/2003/linkbase" '
    'xmlns:xlink="http://www.w3.org/1999/xlink" xmlns:xbrldi="http://xbrl.org/2006/xbrldi" '
    'xmlns:core="http://xbrl.frc.org.uk/fr/2023-01-01/core" '
    'xmlns:bus="http://xbrl.frc.org.uk/cd/2023-01-01/business" '
    'xmlns:iso4217="http://www.xbrl.org/2003/iso4217">'
    "<head><title>Annual accounts</title>"
    "<style>body{{font-family:Arial;margin:0;padding:0}}</style>"
    "<script>var shown=1;</script></head><body>"
    "<!-- generated from orders -->"
    '<div style="display:none"><ix:header><ix:references>'
    '<link:schemaRef xlink:type="simple" xlink:href="{ref}"/></ix:references><ix:resources>'
)


def _context_xml(cid: str, year_arg: str, kind: str, member: str | None = None) -> str:
    """One context; %3$s is the identifier, year_arg the positional year argument."""
    seg = ('<xbrli:segment><xbrldi:explicitMember dimension="core:MaturitiesOrExpirationPeriodsDimension">'
           f"core:{member}</xbrldi:explicitMember></xbrli:segment>") if member else ""
    period = (f"<xbrli:startDate>{year_arg}-01-01</xbrli:startDate><xbrli:endDate>{year_arg}-12-31</xbrli:endDate>"
              if kind == "duration" else f"<xbrli:instant>{year_arg}-12-31</xbrli:instant>")
    return (f'<xbrli:context id="{cid}"><xbrli:entity><xbrli:identifier scheme="http://www.companieshouse.gov.uk/">'
            f"%3$s</xbrli:identifier>{seg}</xbrli:entity><xbrli:period>{period}</xbrli:period></xbrli:context>")


# Positional arguments: 1 ix namespace, 2 taxonomy ref, 3 identifier, 4 year, 5 prior year,
# 6 currency, 7 fact rows, 8 meta facts.
_DOC_TEMPLATE = (
    _HEAD.replace("{ix}", "%1$s").replace("{ref}", "%2$s").replace("{{", "{").replace("}}", "}")
    + _context_xml("dur_cur", "%4$s", "duration") + _context_xml("dur_prev", "%5$s", "duration")
    + _context_xml("inst_cur", "%4$s", "instant") + _context_xml("inst_prev", "%5$s", "instant")
    + _context_xml("inst_cur_within", "%4$s", "instant", "WithinOneYear")
    + _context_xml("inst_cur_after", "%4$s", "instant", "AfterOneYear")
    + _context_xml("inst_prev_within", "%5$s", "instant", "WithinOneYear")
    + _context_xml("inst_prev_after", "%5$s", "instant", "AfterOneYear")
    + '<xbrli:unit id="CUR"><xbrli:measure>iso4217:%6$s</xbrli:measure></xbrli:unit><xbrli:unit id="pure">'
    + "<xbrli:measure>xbrli:pure</xbrli:measure></xbrli:unit>"
    + "</ix:resources></ix:header></div><table>%7$s</table>%8$s</body></html>"
)


def _filled(template: str, *args: Column) -> Column:
    """``template`` with ``%n$s`` filled as ``format_string`` does (a null as "null"), by one ``concat``."""
    parts = re.split(r"%(\d)\$s", template)
    return F.concat(*[F.coalesce(args[int(x) - 1], F.lit("null")) if i % 2 else F.lit(x) for i, x in enumerate(parts) if i % 2 or x])


def _lit_case(col: Column, mapping: dict, default=None) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == k, F.lit(v)) if expr is None else expr.when(col == k, F.lit(v))
    return expr.otherwise(F.lit(default))


def fact_concept(linenumber: Column, suppkey: Column) -> Column:
    even = suppkey % 2 == 0
    expr = None
    for line, (ev, od) in CONCEPT_BY_LINE.items():
        val = F.when(even, F.lit(ev)).otherwise(F.lit(od))
        expr = F.when(linenumber == line, val) if expr is None else expr.when(linenumber == line, val)
    return expr


def fact_context(concept: Column, linestatus: Column, returnflag: Column) -> Column:
    cur = linestatus == "F"
    dur = F.when(cur, F.lit("dur_cur")).otherwise(F.lit("dur_prev"))
    base = F.when(cur, F.lit("inst_cur")).otherwise(F.lit("inst_prev"))
    suffix = F.when(returnflag == "N", F.lit("_within")).when(returnflag == "R", F.lit("_after")).otherwise(F.lit(""))
    return F.when(concept.isin(DURATION_CONCEPTS), dur).otherwise(F.concat(base, suffix))


_FACT_TEMPLATE = ('<tr><td>%1$s&nbsp;</td><td>%2$s<ix:nonFraction name="core:%1$s" contextRef="%3$s" '
                  'unitRef="%4$s" decimals="0" scale="%5$s"%6$s format="ixt2:numdotdecimal">%7$s'
                  '</ix:nonFraction>%8$s</td></tr>')


def _fact_markup(line: Column, concept: Column, context_ref: Column) -> Column:
    thousands = line["l_tax"] > 0.04
    text = F.when(thousands, F.format_number(line["l_quantity"], 0)).otherwise(F.format_number(line["l_extendedprice"], 2))
    scale = F.when(thousands, F.lit("3")).otherwise(F.lit("0"))
    unit = F.when(concept == "AverageNumberEmployeesDuringPeriod", F.lit("pure")).otherwise(F.lit("CUR"))
    d = line["l_discount"]
    sign_attr = F.when(d >= 0.08, F.lit(' sign="-"')).otherwise(F.lit(""))
    inner = F.when((d >= 0.03) & (d < 0.05), F.concat(F.lit("("), text, F.lit(")"))).otherwise(text)
    before = (F.when((d >= 0.05) & (d < 0.07), F.lit("(")).when((d >= 0.07) & (d < 0.08), F.lit("<span>(</span>"))
              .otherwise(F.lit("")))
    after = (F.when((d >= 0.05) & (d < 0.07), F.lit(")")).when((d >= 0.07) & (d < 0.08), F.lit("<span>)</span>"))
             .otherwise(F.lit("")))
    return _filled(_FACT_TEMPLATE, concept, before, context_ref, unit, scale, sign_attr, inner, after)


def _nonnumeric(concept: str, text: Column, prefix: str = "bus") -> Column:
    return F.when(text.isNotNull(), F.concat(
        F.lit(f'<p><ix:nonNumeric name="{prefix}:{concept}" contextRef="dur_cur">'), text,
        F.lit("</ix:nonNumeric></p>"))).otherwise(F.lit(""))


_LINE = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_shipdate",
         "l_returnflag", "l_linestatus"]


def rows_markup(lines: Column) -> Column:
    """The table rows of a filing: its lines (structs of ``_LINE``) as facts, in the order of all their columns."""
    told = F.transform(F.array_sort(lines), lambda r: F.struct(r.alias("r"), fact_concept(r["l_linenumber"], r["l_suppkey"]).alias("concept")))
    return F.concat_ws("", F.transform(told, lambda x: _fact_markup(
        x["r"], x["concept"], fact_context(x["concept"], x["r"]["l_linestatus"], x["r"]["l_returnflag"]))))


def virtual_filings(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """orders + lineitem -> filings(filing_id, archive, member, source_file, published, content).

    lineitem and orders are hash-partitioned once on the order key into
    ``spark.sql.shuffle.partitions`` parts (an explicit count, so AQE keeps the
    parallelism for the Python parse that follows); the collect of <= 7 lines per
    order and the join to orders both reuse that partitioning.  All markup is
    written after the join, so only the lines' own columns are shuffled, sorted and spilled."""
    n = int(lineitem.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = (lineitem.select("l_orderkey", *_LINE).repartition(n, "l_orderkey")
            .groupBy("l_orderkey").agg(F.collect_list(F.struct(*_LINE)).alias("rows")))
    o = (orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
         .repartition(n, "o_orderkey"))
    f = o.join(rows, o.o_orderkey == rows.l_orderkey, "left")

    year = F.year("o_orderdate")
    ident = F.col("o_custkey").cast("string")
    currency = F.when(F.col("o_orderstatus") == "O", F.lit("EUR")).otherwise(F.lit("GBP"))
    ix = F.when(F.col("o_orderkey") % 2 == 1, F.lit(IX_2008)).otherwise(F.lit(IX_2013))
    ref = _lit_case(F.col("o_orderpriority"), TAXONOMY_REF_BY_PRIORITY)
    body = F.coalesce(rows_markup(F.col("rows")), F.lit(""))

    ck4 = F.col("o_custkey") % 4
    dormant = (F.when(F.col("o_orderstatus") == "F", F.lit("false"))
               .when(F.col("o_orderstatus") == "P", F.lit(" TRUE ")))
    audit = (F.when(ck4 == 0, F.lit("Audited")).when(ck4 == 1, F.lit("Unaudited"))
             .when(ck4 == 2, F.lit("Exempt from audit")))
    exemption = F.when((ck4 == 3) & (F.col("o_orderkey") % 2 == 0),
                       F.lit("The company is entitled to exemption from audit."))
    acc_type = F.when(F.col("o_totalprice") >= 400000, F.lit("Full accounts"))
    standard = F.when((F.col("o_orderpriority") == "4-NOT SPECIFIED") & (F.col("o_custkey") % 2 == 0),
                      F.lit("FRS102"))
    officer = F.concat(F.lit("Officer "), ident)
    meta = F.concat(
        _nonnumeric("EntityDormantTruefalse", dormant),
        _nonnumeric("AccountsStatusAuditedOrUnaudited", audit),
        _nonnumeric(EXEMPTION_CONCEPT, exemption),
        _nonnumeric("AccountsType", acc_type),
        _nonnumeric("AccountingStandardsApplied", standard),
        _nonnumeric("NameEntityOfficer", officer),
    )
    doc = _filled(_DOC_TEMPLATE, ix, ref, ident, F.format_string("%04d", year),
                          F.format_string("%04d", year - 1), currency, body, meta)

    padded = normalise_number(ident)
    source_file = F.format_string("Prod224_%d_%s_%s.html", F.col("o_orderkey"), padded,
                                  F.date_format("o_orderdate", "yyyyMMdd"))
    archive = F.concat(F.lit("Accounts_Bulk_Data-"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(".zip"))
    return f.select(
        F.concat(F.lit("F"), F.col("o_orderkey").cast("string")).alias("filing_id"),
        archive.alias("archive"),
        source_file.alias("member"),
        source_file.alias("source_file"),
        F.to_date("o_orderdate").alias("published"),
        doc.cast("binary").alias("content"),
    )
