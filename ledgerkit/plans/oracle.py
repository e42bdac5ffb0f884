"""DuckDB oracle SQL for the registered queries.

The oracle never sees the markup: it computes each answer straight from the
driver tables using the virtual-filing mapping in ``plans/virtual.py``.
"""
from __future__ import annotations

DUR = "('Turnover','OperatingProfitLoss','AverageNumberEmployeesDuringPeriod')"

# One row per lineitem fact, in document order, with value and period flags.
FACTS_CTE = f"""
li AS (
  SELECT l_orderkey AS okey,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
        l_extendedprice, l_quantity, l_discount, l_tax, l_shipdate, l_returnflag, l_linestatus) - 1 AS ord,
    CASE l_linenumber
      WHEN 1 THEN CASE WHEN l_suppkey % 2 = 0 THEN 'FixedAssets' ELSE 'TotalAssetsLessCurrentLiabilities' END
      WHEN 2 THEN CASE WHEN l_suppkey % 2 = 0 THEN 'CurrentAssets' ELSE 'NetCurrentAssetsLiabilities' END
      WHEN 3 THEN CASE WHEN l_suppkey % 2 = 0 THEN 'NetAssetsLiabilities' ELSE 'Equity' END
      WHEN 4 THEN CASE WHEN l_suppkey % 2 = 0 THEN 'CashBankOnHand' ELSE 'Turnover' END
      WHEN 5 THEN CASE WHEN l_suppkey % 2 = 0 THEN 'BankBorrowings'
                       ELSE 'NetObligationsUnderFinanceLeasesHirePurchaseContracts' END
      WHEN 6 THEN CASE WHEN l_suppkey % 2 = 0 THEN 'Creditors' ELSE 'TradeCreditors' END
      WHEN 7 THEN CASE WHEN l_suppkey % 2 = 0 THEN 'AverageNumberEmployeesDuringPeriod' ELSE 'OperatingProfitLoss' END
    END AS concept,
    l_linestatus, l_returnflag, l_discount,
    CASE WHEN l_tax > 0.04 THEN l_quantity * 1000 ELSE l_extendedprice END AS base,
    CASE WHEN l_tax > 0.04 THEN l_quantity ELSE l_extendedprice END AS raw_num,
    CASE WHEN l_tax > 0.04 THEN '3' ELSE '0' END AS scale
  FROM lineitem
),
vf AS (
  SELECT *,
    CASE WHEN l_discount >= 0.03 THEN -abs(base) ELSE base END AS value,
    concept IN {DUR} AS is_dur,
    CASE WHEN concept IN {DUR} THEN l_linestatus = 'F'
         ELSE l_linestatus = 'F' AND l_returnflag = 'A' END AS in_period,
    CASE WHEN concept IN {DUR} THEN CASE WHEN l_linestatus = 'F' THEN 'dur_cur' ELSE 'dur_prev' END
         ELSE (CASE WHEN l_linestatus = 'F' THEN 'inst_cur' ELSE 'inst_prev' END)
              || (CASE l_returnflag WHEN 'N' THEN '_within' WHEN 'R' THEN '_after' ELSE '' END) END AS context_ref,
    CASE WHEN concept NOT IN {DUR} AND l_linestatus = 'F'
         THEN CASE l_returnflag WHEN 'A' THEN 'plain' WHEN 'N' THEN 'within' ELSE 'after' END END AS slot
  FROM li
)"""

# Winner per (order, concept): in-period first, largest |value|, first in document.
PICKS_CTE = FACTS_CTE + """,
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY okey, concept ORDER BY in_period DESC, abs(value) DESC, ord) AS rn,
            row_number() OVER (PARTITION BY okey, concept ORDER BY in_period DESC, abs(raw_num) DESC, ord) AS rn_raw
  FROM vf
),
pk AS (
  SELECT okey,
    max(CASE WHEN concept = 'FixedAssets' AND rn = 1 THEN value END) AS fixed_assets,
    max(CASE WHEN concept = 'CurrentAssets' AND rn = 1 THEN value END) AS current_assets,
    max(CASE WHEN concept = 'NetAssetsLiabilities' AND rn = 1 THEN value END) AS net_assets_tag,
    max(CASE WHEN concept = 'CashBankOnHand' AND rn = 1 THEN value END) AS cash,
    max(CASE WHEN concept = 'TotalAssetsLessCurrentLiabilities' AND rn = 1 THEN value END) AS talcl,
    max(CASE WHEN concept = 'NetCurrentAssetsLiabilities' AND rn = 1 THEN value END) AS net_current_assets,
    max(CASE WHEN concept = 'Equity' AND rn = 1 THEN value END) AS equity,
    max(CASE WHEN concept = 'Turnover' AND rn = 1 THEN value END) AS turnover,
    max(CASE WHEN concept = 'OperatingProfitLoss' AND rn = 1 THEN value END) AS operating_profit,
    max(CASE WHEN concept = 'AverageNumberEmployeesDuringPeriod' AND rn_raw = 1 THEN raw_num END) AS employees,
    bool_or(CASE WHEN concept = 'FixedAssets' AND rn = 1 THEN in_period END) AS fixed_assets_in_period,
    bool_or(CASE WHEN concept = 'CurrentAssets' AND rn = 1 THEN in_period END) AS current_assets_in_period,
    bool_or(CASE WHEN concept = 'NetAssetsLiabilities' AND rn = 1 THEN in_period END) AS net_assets_in_period,
    bool_or(CASE WHEN concept = 'CashBankOnHand' AND rn = 1 THEN in_period END) AS cash_in_period,
    bool_or(CASE WHEN concept = 'Equity' AND rn = 1 THEN in_period END) AS equity_in_period,
    bool_or(CASE WHEN concept = 'Turnover' AND rn = 1 THEN in_period END) AS turnover_in_period,
    bool_or(CASE WHEN concept = 'OperatingProfitLoss' AND rn = 1 THEN in_period END) AS operating_profit_in_period,
    bool_or(CASE WHEN concept = 'AverageNumberEmployeesDuringPeriod' AND rn_raw = 1 THEN in_period END)
      AS employees_in_period,
    sum(CASE WHEN concept = 'BankBorrowings' AND slot = 'within' THEN CAST(value AS DECIMAL(38,6)) END) AS bl_w,
    sum(CASE WHEN concept = 'BankBorrowings' AND slot = 'after' THEN CAST(value AS DECIMAL(38,6)) END) AS bl_a,
    sum(CASE WHEN concept = 'BankBorrowings' AND slot = 'plain' THEN CAST(value AS DECIMAL(38,6)) END) AS bl_p,
    sum(CASE WHEN concept = 'NetObligationsUnderFinanceLeasesHirePurchaseContracts' AND slot = 'within'
             THEN CAST(value AS DECIMAL(38,6)) END) AS fl_w,
    sum(CASE WHEN concept = 'NetObligationsUnderFinanceLeasesHirePurchaseContracts' AND slot = 'after'
             THEN CAST(value AS DECIMAL(38,6)) END) AS fl_a,
    sum(CASE WHEN concept = 'NetObligationsUnderFinanceLeasesHirePurchaseContracts' AND slot = 'plain'
             THEN CAST(value AS DECIMAL(38,6)) END) AS fl_p,
    sum(CASE WHEN concept = 'TradeCreditors' AND slot = 'within' THEN CAST(value AS DECIMAL(38,6)) END) AS tc_w,
    sum(CASE WHEN concept = 'TradeCreditors' AND slot = 'after' THEN CAST(value AS DECIMAL(38,6)) END) AS tc_a,
    arg_max(CASE WHEN concept = 'Creditors' AND slot = 'within' THEN value END,
            CASE WHEN concept = 'Creditors' AND slot = 'within' THEN ord END) AS cred_w,
    arg_max(CASE WHEN concept = 'Creditors' AND slot = 'after' THEN value END,
            CASE WHEN concept = 'Creditors' AND slot = 'after' THEN ord END) AS cred_a
  FROM ranked GROUP BY okey
),
rec0 AS (
  SELECT o.o_orderkey AS okey, 'F' || CAST(o.o_orderkey AS VARCHAR) AS filing_id,
    CAST(o.o_custkey AS VARCHAR) AS company_number, o.o_custkey, o.o_orderstatus, o.o_orderpriority,
    o.o_totalprice, o.o_orderdate,
    printf('%04d-01-01', year(o.o_orderdate)) AS period_start,
    printf('%04d-12-31', year(o.o_orderdate)) AS period_end,
    pk.* EXCLUDE (okey),
    coalesce(pk.fixed_assets + pk.current_assets,
             pk.talcl - pk.net_current_assets + pk.current_assets) AS total_assets,
    CASE WHEN pk.fixed_assets + pk.current_assets IS NOT NULL THEN 'summed(fixed+current)'
         WHEN pk.talcl - pk.net_current_assets + pk.current_assets IS NOT NULL THEN 'derived(talcl-nca+current)'
    END AS total_assets_prov,
    coalesce(pk.net_assets_tag, pk.equity) AS net_assets,
    CASE WHEN pk.net_assets_tag IS NOT NULL THEN 'reported' WHEN pk.equity IS NOT NULL THEN 'reported(equity)'
    END AS net_assets_prov,
    CASE WHEN pk.bl_w IS NOT NULL OR pk.bl_a IS NOT NULL THEN coalesce(pk.bl_w, 0) + coalesce(pk.bl_a, 0)
         ELSE pk.bl_p END AS bank_loans_total,
    CASE WHEN pk.fl_w IS NOT NULL OR pk.fl_a IS NOT NULL THEN coalesce(pk.fl_w, 0) + coalesce(pk.fl_a, 0)
         ELSE pk.fl_p END AS finance_leases_total
  FROM orders o LEFT JOIN pk ON pk.okey = o.o_orderkey
),
rec1 AS (
  SELECT *,
    CASE WHEN total_assets IS NOT NULL AND net_assets IS NOT NULL THEN round(total_assets - net_assets, 2)
         WHEN cred_w IS NOT NULL OR cred_a IS NOT NULL
           THEN round(coalesce(cred_w, 0.0) + coalesce(cred_a, 0.0) + 0.0, 2) END AS total_liabilities,
    CASE WHEN total_assets IS NOT NULL AND net_assets IS NOT NULL THEN 'derived(assets-net_assets)'
         WHEN cred_w IS NOT NULL OR cred_a IS NOT NULL THEN 'summed(creditors+provisions)' END
      AS total_liabilities_prov,
    CASE WHEN bank_loans_total IS NOT NULL OR finance_leases_total IS NOT NULL OR cash IS NOT NULL
      THEN CAST(round(coalesce(bank_loans_total, 0) + coalesce(finance_leases_total, 0)
                      - CAST(coalesce(cash, 0.0) AS DECIMAL(38,6)), 2) AS DOUBLE) END AS net_debt,
    CASE WHEN bank_loans_total IS NOT NULL OR finance_leases_total IS NOT NULL THEN 'derived(debt-cash)'
         WHEN cash IS NOT NULL THEN 'derived(net cash; no debt tagged)' END AS net_debt_prov,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'FRS-102' WHEN '2-HIGH' THEN 'FRS-102'
         WHEN '3-MEDIUM' THEN 'FRS-105' WHEN '5-LOW' THEN 'IFRS'
         ELSE CASE WHEN o_custkey % 2 = 0 THEN 'FRS-102' ELSE 'unknown' END END AS taxonomy,
    CASE o_orderpriority WHEN '1-URGENT' THEN '2023-01-01' WHEN '2-HIGH' THEN '2024-01-01'
         WHEN '3-MEDIUM' THEN '2024-01-01' WHEN '4-NOT SPECIFIED' THEN '2022-01-01'
         ELSE '2023-03-23' END AS taxonomy_version,
    CASE WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_custkey % 2 = 0 THEN 'FRS102' END AS accounting_standard,
    CASE WHEN o_orderstatus = 'O' THEN 'EUR' ELSE 'GBP' END AS currency,
    turnover IS NOT NULL OR operating_profit IS NOT NULL AS has_pl,
    CASE o_custkey % 4 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN false
         ELSE CASE WHEN okey % 2 = 0 THEN false END END AS audited,
    CASE o_orderstatus WHEN 'F' THEN false WHEN 'P' THEN true END AS dormant,
    datediff('day', CAST(period_start AS DATE), CAST(period_end AS DATE)) AS period_length_days
  FROM rec0
),
rec AS (
  SELECT *,
    CASE WHEN o_totalprice >= 400000 THEN 'Full accounts'
         WHEN taxonomy = 'FRS-105' THEN 'micro'
         WHEN has_pl THEN 'full_or_small_with_pl' ELSE 'small_filleted_no_pl' END AS accounts_type,
    taxonomy IN ('FRS-102', 'FRS-101', 'IFRS') AND NOT has_pl AS filleted,
    round(((turnover IS NOT NULL)::INT + (operating_profit IS NOT NULL)::INT + (total_assets IS NOT NULL)::INT
      + (total_liabilities IS NOT NULL)::INT + (net_assets IS NOT NULL)::INT + (cash IS NOT NULL)::INT
      + (net_debt IS NOT NULL)::INT + (employees IS NOT NULL)::INT) / CAST(9 AS DOUBLE), 2) AS completeness_score
  FROM rec1
)"""


def with_cte(cte: str, body: str) -> str:
    return "WITH " + cte.strip() + "\n" + body

CORE_NS = "http://xbrl.frc.org.uk/fr/2023-01-01/core"
BUS_NS = "http://xbrl.frc.org.uk/cd/2023-01-01/business"


def x7(tok: str, scale: str = "NULL", sign: str = "NULL") -> str:
    """DuckDB form of the displayed-number rule."""
    v = f"TRY_CAST(regexp_replace({tok}, '[^0-9.\\-]', '', 'g') AS DOUBLE)"
    sc = (f"CASE WHEN regexp_matches({scale}, '^\\s*[+-]?[0-9]+\\s*$') "
          f"THEN TRY_CAST(trim({scale}) AS INTEGER) END")
    v = f"(CASE WHEN ({sc}) IS NOT NULL THEN {v} * power(10.0, {sc}) ELSE {v} END)"
    neg = f"(coalesce({sign} = '-', false) OR (strpos({tok}, '(') > 0 AND strpos({tok}, ')') > 0))"
    return f"(CASE WHEN {neg} THEN -abs({v}) ELSE {v} END)"


PROV_JSON = """'{' || concat_ws(',',
    CASE WHEN turnover IS NOT NULL THEN '"turnover":"' ||
      CASE WHEN turnover_in_period THEN 'reported' ELSE 'reported(out-of-period)' END || '"' END,
    CASE WHEN operating_profit IS NOT NULL THEN '"operating_profit":"' ||
      CASE WHEN operating_profit_in_period THEN 'reported' ELSE 'reported(out-of-period)' END || '"' END,
    CASE WHEN cash IS NOT NULL THEN '"cash":"' ||
      CASE WHEN cash_in_period THEN 'reported' ELSE 'reported(out-of-period)' END || '"' END,
    CASE WHEN employees IS NOT NULL THEN '"employees":"reported"' END,
    CASE WHEN total_assets_prov IS NOT NULL THEN '"total_assets":"' || total_assets_prov || '"' END,
    CASE WHEN net_assets_prov IS NOT NULL THEN '"net_assets":"' || net_assets_prov || '"' END,
    CASE WHEN total_liabilities_prov IS NOT NULL THEN '"total_liabilities":"' || total_liabilities_prov || '"' END,
    CASE WHEN net_debt_prov IS NOT NULL THEN '"net_debt":"' || net_debt_prov || '"' END) || '}'"""

META_CTE = """meta AS (
  SELECT o_orderkey AS okey, 1 AS k, 'EntityDormantTruefalse' AS concept FROM orders WHERE o_orderstatus IN ('F', 'P')
  UNION ALL SELECT o_orderkey, 2, 'AccountsStatusAuditedOrUnaudited' FROM orders WHERE o_custkey % 4 IN (0, 1, 2)
  UNION ALL SELECT o_orderkey, 3, 'StatementThatCompanyEntitledToExemptionFromAuditUnderSection477CompaniesAct2006'
    FROM orders WHERE o_custkey % 4 = 3 AND o_orderkey % 2 = 0
  UNION ALL SELECT o_orderkey, 4, 'AccountsType' FROM orders WHERE o_totalprice >= 400000
  UNION ALL SELECT o_orderkey, 5, 'AccountingStandardsApplied' FROM orders
    WHERE o_orderpriority = '4-NOT SPECIFIED' AND o_custkey % 2 = 0
  UNION ALL SELECT o_orderkey, 6, 'NameEntityOfficer' FROM orders
),
nlines AS (SELECT okey, count(*) AS n FROM li GROUP BY okey)"""

ORACLE = {
    "records": with_cte(PICKS_CTE, f"""
SELECT filing_id, company_number, taxonomy, taxonomy_version, accounting_standard, currency,
  period_start, period_end, period_length_days, turnover, total_assets, total_liabilities, net_assets,
  employees, operating_profit, current_assets, net_current_assets,
  talcl AS total_assets_less_current_liabilities, cash, net_debt,
  CAST(bl_w AS DOUBLE) AS f_within_bank_loans, CAST(bl_a AS DOUBLE) AS f_after_bank_loans,
  CAST(fl_w AS DOUBLE) AS f_within_finance_leases, CAST(fl_a AS DOUBLE) AS f_after_finance_leases,
  CAST(tc_w AS DOUBLE) AS f_within_trade_creditors, CAST(tc_a AS DOUBLE) AS f_after_trade_creditors,
  cred_w AS f_within_creditors_total, cred_a AS f_after_creditors_total,
  accounts_type, filleted, audited, dormant, completeness_score, {PROV_JSON} AS provenance
FROM rec"""),
    "extract_facts_roundtrip": with_cte(FACTS_CTE + ",\n" + META_CTE, f"""
SELECT 'F' || CAST(okey AS VARCHAR) AS filing_id, CAST(ord AS INTEGER) AS ord, 'nonFraction' AS kind, concept,
  '{CORE_NS}' AS namespace, value, scale, CASE WHEN l_discount >= 0.08 THEN '-' END AS sign, context_ref,
  CASE WHEN concept = 'AverageNumberEmployeesDuringPeriod' THEN 'pure' ELSE 'CUR' END AS unit_ref
FROM vf
UNION ALL
SELECT 'F' || CAST(m.okey AS VARCHAR), CAST(coalesce(n.n, 0) + row_number() OVER (PARTITION BY m.okey ORDER BY k) - 1
  AS INTEGER), 'nonNumeric', concept, '{BUS_NS}', CAST(NULL AS DOUBLE), CAST(NULL AS VARCHAR),
  CAST(NULL AS VARCHAR), 'dur_cur', CAST(NULL AS VARCHAR)
FROM meta m LEFT JOIN nlines n ON n.okey = m.okey"""),
    "parse_displayed_number": f"""
WITH t AS (SELECT doc_id, unnest(regexp_extract_all(text, '\\(?-?[0-9][0-9,.]*\\)?')) AS token FROM documents)
SELECT doc_id, token, count(*) AS n, {x7('token')} AS value, {x7('token', "'3'")} AS value_thousands,
  {x7('token', "'x'", "'-'")} AS value_signed
FROM t GROUP BY doc_id, token""",
    "primary_period": with_cte(PICKS_CTE, """
SELECT filing_id, company_number, period_start, period_end, period_length_days FROM rec"""),
    "pick_values": with_cte(PICKS_CTE, """
SELECT filing_id, current_assets, cash, net_current_assets, talcl, net_assets, turnover, operating_profit,
  employees, current_assets_in_period, cash_in_period, turnover_in_period, operating_profit_in_period,
  employees_in_period,
  CASE WHEN net_assets_tag IS NOT NULL THEN net_assets_in_period
       WHEN equity IS NOT NULL THEN equity_in_period END AS net_assets_in_period
FROM rec"""),
    "employees": with_cte(FACTS_CTE, """
SELECT 'F' || CAST(okey AS VARCHAR) AS filing_id, CAST(ord AS INTEGER) AS ord, raw_num AS employees_raw,
  value AS employees_scaled, abs(raw_num) <> abs(value) AS scale_anomaly
FROM vf WHERE concept = 'AverageNumberEmployeesDuringPeriod'"""),
    "funding_breakdown": with_cte(PICKS_CTE, """
SELECT filing_id, CAST(bl_w AS DOUBLE) AS f_within_bank_loans, CAST(bl_a AS DOUBLE) AS f_after_bank_loans,
  CAST(fl_w AS DOUBLE) AS f_within_finance_leases, CAST(fl_a AS DOUBLE) AS f_after_finance_leases,
  CAST(tc_w AS DOUBLE) AS f_within_trade_creditors, CAST(tc_a AS DOUBLE) AS f_after_trade_creditors,
  cred_w AS f_within_creditors_total, cred_a AS f_after_creditors_total
FROM rec"""),
    "net_debt": with_cte(PICKS_CTE, "SELECT filing_id, cash, net_debt, net_debt_prov FROM rec"),
    "derive_totals": with_cte(PICKS_CTE, """
SELECT filing_id, total_assets, total_assets_prov, net_assets, net_assets_prov, total_liabilities,
  total_liabilities_prov FROM rec"""),
    "classify_filing": with_cte(PICKS_CTE, """
SELECT filing_id, taxonomy, taxonomy_version, accounting_standard, currency, accounts_type, filleted, audited,
  dormant, period_length_days, completeness_score FROM rec"""),
}


# ---- aggregates, metadata, sampling, benchmark items ------------------------------------
def pad8(x: str) -> str:
    return f"(CASE WHEN length({x}) < 8 THEN lpad({x}, 8, '0') ELSE {x} END)"


def money_sql(v: str) -> str:
    return f"(CASE WHEN {v} < 0 THEN '(£' || format('{{:,.0f}}', abs({v})) || ')' ELSE '£' || format('{{:,.0f}}', {v}) END)"


NAME = "coalesce(company_name, 'company ' || company_number)"

PRODUCT_CTE = PICKS_CTE + f""",
co AS (
  SELECT {pad8('CAST(c_custkey AS VARCHAR)')} AS company_number, c_name AS company_name, c_mktsegment AS company_type,
    CASE WHEN c_acctbal < 0 THEN 'Liquidation' ELSE 'Active' END AS company_status,
    CASE WHEN c_custkey % 3 = 0 THEN 'MICRO ENTITY' WHEN c_custkey % 3 = 1 THEN 'SMALL' END AS accounts_category,
    concat_ws('; ', printf('%05d - Activity %d', n_nationkey + 64000, n_nationkey),
      CASE WHEN c_custkey % 2 = 0 THEN printf('%05d - Activity %d', n_regionkey + 70000, n_regionkey) END) AS sic_codes,
    printf('N%d', n_nationkey) AS region_outcode, n_name AS post_town, r_name AS country
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
),
prod AS (
  SELECT r.* EXCLUDE (company_number), {pad8('r.company_number')} AS company_number,
    printf('Prod224_%d_%s_%s.html', r.okey, {pad8('r.company_number')}, strftime(r.o_orderdate, '%Y%m%d'))
      AS source_file,
    cred_w AS f_within_creditors_total, cred_a AS f_after_creditors_total,
    talcl AS total_assets_less_current_liabilities,
    co.* EXCLUDE (company_number)
  FROM rec r LEFT JOIN co ON co.company_number = {pad8('r.company_number')}
),
lat AS (
  SELECT * EXCLUDE (rk) FROM (
    SELECT *, row_number() OVER (PARTITION BY company_number
                                 ORDER BY period_end DESC NULLS LAST, source_file, filing_id) AS rk
    FROM prod WHERE company_number IS NOT NULL) WHERE rk = 1
)"""

EXTRACT_LINES = [
    ("current_assets", "Current assets"), ("cash", "Cash at bank and in hand"),
    ("f_within_creditors_total", "Creditors: amounts falling due within one year"),
    ("net_current_assets", "Net current assets"),
    ("total_assets_less_current_liabilities", "Total assets less current liabilities"),
    ("f_after_creditors_total", "Creditors: amounts falling due after more than one year"),
    ("net_assets", "Net assets"), ("turnover", "Turnover"), ("operating_profit", "Operating profit"),
]
MAKE_EXTRACT = ("concat_ws(chr(10), " + NAME + " || ' - accounts to ' || period_end || ' (amounts in ' || "
                "coalesce(currency, 'GBP') || ')', "
                + ", ".join(f"CASE WHEN {c} IS NOT NULL THEN '  {lab}: ' || {money_sql(c)} END"
                            for c, lab in EXTRACT_LINES)
                + ", CASE WHEN employees IS NOT NULL THEN '  Average number of employees: ' || "
                  "CAST(CAST(round_even(employees, 0) AS BIGINT) AS VARCHAR) END"
                + ", CASE WHEN concat_ws('; ', accounts_type, taxonomy) <> '' THEN '  Basis of preparation: ' || "
                  "concat_ws('; ', accounts_type, taxonomy) END)")

ITEM_NULLS = ("CAST(NULL AS DOUBLE) AS answer_num, CAST(NULL AS VARCHAR) AS answer_text, "
              "CAST(NULL AS BOOLEAN) AS answer_bool")


def _extraction_sql(field, n, label, employees):
    unit = "a whole number" if employees else "an amount in pounds"
    ans = "CAST(CAST(round_even(employees, 0) AS BIGINT) AS DOUBLE)" if employees else field
    rel = "0.0" if employees else "0.005"
    return f"""SELECT * FROM (SELECT 'extraction' AS category, 'numeric' AS answer_type,
  'Extract from the accounts of a UK company:' || chr(10) || chr(10) || {MAKE_EXTRACT} || chr(10) || chr(10) ||
  'Question: what is the company''s {label} for this period? Reply with {unit}.' AS question,
  {ans} AS answer_num, CAST(NULL AS VARCHAR) AS answer_text, CAST(NULL AS BOOLEAN) AS answer_bool,
  CAST({rel} AS DOUBLE) AS rel_tol, CAST(1.0 AS DOUBLE) AS abs_tol, company_number, '{field}' AS field
  FROM lat WHERE company_name IS NOT NULL AND {field} IS NOT NULL
  ORDER BY md5('42:{field}:' || company_number) LIMIT {n})"""


def draws_sql(pool: str, key: str, draws: int = 200) -> str:
    """CTEs ending in ``drawn``: the pool's rows picked by each draw, with their position."""
    h = ", ".join(f"CAST('0x' || substr(md5('42:draw:' || d || ':{j}'), 1, 15) AS BIGINT) AS h{j}" for j in range(5))
    steps = ["p0 AS (SELECT *, h0 % (n - 4) AS i0 FROM h)"]
    for j in range(1, 5):
        earlier = ", ".join(f"i{k}" for k in range(j))
        steps.append(f"p{j} AS (SELECT *, CASE WHEN h{j} % (n - {4 - j}) IN ({earlier}) THEN n - {5 - j} "
                     f"ELSE h{j} % (n - {4 - j}) END AS i{j} FROM p{j - 1})")
    return f"""h AS (SELECT d AS draw, (SELECT count(*) FROM {pool}) AS n, {h} FROM range({draws}) t(d)),
{(","+chr(10)).join(steps)},
numbered AS (SELECT *, row_number() OVER (ORDER BY md5('42:pool:' || CAST({key} AS VARCHAR)), CAST({key} AS VARCHAR)) - 1 AS idx FROM {pool}),
drawn AS (SELECT * FROM (SELECT draw, unnest([1, 2, 3, 4, 5]) AS pos, unnest([i0, i1, i2, i3, i4]) AS idx FROM p4) JOIN numbered USING (idx))"""


def _items_sql():
    from ..vocab import CLEAN_EXTRACTION_QUOTAS, FIELD_LABELS
    ext = "\nUNION ALL\n".join(_extraction_sql(f, n, FIELD_LABELS[f], f == "employees")
                               for f, n in CLEAN_EXTRACTION_QUOTAS.items()
                               if f not in ("property_plant_equipment",))
    # property_plant_equipment is never tagged in the virtual filings: its pool is empty.
    nd = f"""SELECT * FROM (SELECT 'not_disclosed' AS category, 'not_disclosed' AS answer_type,
  'Extract from the accounts of a UK company:' || chr(10) || chr(10) || {MAKE_EXTRACT} || chr(10) || chr(10) ||
  'Question: what is the company''s turnover for this period? If these accounts do not show it, say so.' AS question,
  CAST(NULL AS DOUBLE) AS answer_num, 'NOT_DISCLOSED' AS answer_text, CAST(NULL AS BOOLEAN) AS answer_bool,
  CAST(NULL AS DOUBLE) AS rel_tol, CAST(NULL AS DOUBLE) AS abs_tol, company_number, CAST(NULL AS VARCHAR) AS field
  FROM lat WHERE company_name IS NOT NULL AND turnover IS NULL AND net_assets IS NOT NULL
  ORDER BY md5('42:not_disclosed:' || company_number) LIMIT 150)"""
    comp = f"""SELECT * FROM (WITH dpool AS (SELECT *, {NAME} AS nm, '  - ' || {NAME} || ': net assets ' || {money_sql('net_assets')} AS line
  FROM lat WHERE company_name IS NOT NULL AND net_assets IS NOT NULL),
{draws_sql('dpool', 'company_number')}
SELECT 'comparison' AS category, 'choice' AS answer_type,
  'Net assets of five UK companies:' || chr(10) || string_agg(line, chr(10) ORDER BY pos) || chr(10) || chr(10) ||
  'Question: which company has the highest net assets? Reply with its name.' AS question,
  CAST(NULL AS DOUBLE) AS answer_num, arg_max(nm, (net_assets, -pos)) AS answer_text,
  CAST(NULL AS BOOLEAN) AS answer_bool, CAST(NULL AS DOUBLE) AS rel_tol, CAST(NULL AS DOUBLE) AS abs_tol,
  arg_max(company_number, (net_assets, -pos)) AS company_number, CAST(NULL AS VARCHAR) AS field
FROM drawn GROUP BY draw)"""
    ratio = f"""SELECT * FROM (SELECT 'ratio' AS category, 'numeric' AS answer_type,
  {NAME} || ' reports total liabilities of ' || {money_sql('total_liabilities')} || ' and net assets (equity) of ' ||
  {money_sql('net_assets')} || '.' || chr(10) ||
  'Question: what is its debt-to-equity ratio (total liabilities / equity), to two decimal places?' AS question,
  round(total_liabilities / net_assets, 2) AS answer_num, CAST(NULL AS VARCHAR) AS answer_text,
  CAST(NULL AS BOOLEAN) AS answer_bool, CAST(0.02 AS DOUBLE) AS rel_tol, CAST(0.05 AS DOUBLE) AS abs_tol,
  company_number, CAST(NULL AS VARCHAR) AS field
  FROM lat WHERE company_name IS NOT NULL AND total_liabilities > 0 AND net_assets > 0
  ORDER BY md5('42:ratio:' || company_number) LIMIT 150)"""

    def boolean(cond, salt):
        return f"""SELECT * FROM (SELECT 'boolean' AS category, 'boolean' AS answer_type,
  {NAME} || ' reports net assets of ' || {money_sql('net_assets')} || ' at its period end.' || chr(10) ||
  'Question: are its net assets negative (balance-sheet insolvent)? Reply yes or no.' AS question,
  CAST(NULL AS DOUBLE) AS answer_num, CAST(NULL AS VARCHAR) AS answer_text, net_assets < 0 AS answer_bool,
  CAST(NULL AS DOUBLE) AS rel_tol, CAST(NULL AS DOUBLE) AS abs_tol, company_number, CAST(NULL AS VARCHAR) AS field
  FROM lat WHERE company_name IS NOT NULL AND net_assets {cond} 0
  ORDER BY md5('42:{salt}:' || company_number) LIMIT 60)"""
    return {"items_extraction": ext, "items_not_disclosed": nd, "items_comparison": comp, "items_ratio": ratio,
            "items_boolean": boolean("<", "insolvent") + "\nUNION ALL\n" + boolean(">", "solvent")}


_ITEMS = _items_sql()
COV = ["turnover", "gross_profit", "operating_profit", "total_assets", "total_liabilities", "net_assets", "cash",
       "net_debt", "employees", "property_plant_equipment", "total_assets_less_current_liabilities"]
_NULL_ALWAYS = {"gross_profit", "property_plant_equipment"}

ORACLE.update({
    "coverage": with_cte(PRODUCT_CTE, "SELECT count(*) AS record_count, " + ", ".join(
        f"round(count({'NULL' if c in _NULL_ALWAYS else c}) / greatest(count(*), 1), 4) AS cov_{c}" for c in COV)
        + " FROM prod"),
    "distribution": with_cte(PRODUCT_CTE, """
SELECT 'taxonomy' AS dimension, taxonomy AS value, count(*) AS n FROM prod WHERE taxonomy IS NOT NULL GROUP BY taxonomy
UNION ALL
SELECT 'accounts_type', accounts_type, count(*) FROM prod WHERE accounts_type IS NOT NULL GROUP BY accounts_type"""),
    "top_concepts": with_cte(FACTS_CTE + ",\n" + META_CTE, """
SELECT concept, count(*) AS n FROM (SELECT concept FROM vf UNION ALL SELECT concept FROM meta)
GROUP BY concept ORDER BY n DESC, concept LIMIT 40"""),
    "unique_companies": with_cte(PICKS_CTE, f"""
SELECT count(DISTINCT {pad8('company_number')}) AS unique_companies FROM rec WHERE company_number IS NOT NULL"""),
    "metadata_join": with_cte(PRODUCT_CTE, """
SELECT filing_id, company_number, company_name, company_type, company_status, accounts_category, sic_codes,
  region_outcode, post_town, country FROM prod"""),
    "wanted_companies": with_cte(PRODUCT_CTE, """
SELECT company_number, company_name FROM co WHERE company_number IN (SELECT company_number FROM prod)"""),
    "match_rate": with_cte(PRODUCT_CTE, """
SELECT count(*) AS filings, count(company_name) AS matched,
  round(avg(CASE WHEN company_name IS NOT NULL THEN 1.0 ELSE 0.0 END::DOUBLE), 4) AS match_rate FROM prod"""),
    "key_format_probe": """
SELECT regexp_replace(CAST(o_custkey AS VARCHAR), '[0-9]', '9', 'g') AS shape, count(*) AS n, 'left' AS side
FROM orders GROUP BY 1
UNION ALL
SELECT regexp_replace(CAST(c_custkey AS VARCHAR), '[0-9]', '9', 'g'), count(*), 'right' FROM customer GROUP BY 1""",
    "latest_per_company": with_cte(PRODUCT_CTE, "SELECT company_number, filing_id, period_end, net_assets FROM lat"),
    "sample_n": """
SELECT c_custkey, c_name FROM customer ORDER BY md5('42:' || CAST(c_custkey AS VARCHAR)) LIMIT 100""",
    "sample_per_archive": """
SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source
  ORDER BY md5('11:' || CAST(doc_id AS VARCHAR))) AS rn FROM documents) WHERE rn <= 5""",
    "shuffle_number": """
SELECT printf('q%04d', row_number() OVER (ORDER BY md5('42:' || CAST(c_custkey AS VARCHAR)))) AS id, c_custkey
FROM (SELECT c_custkey FROM customer ORDER BY md5('42:' || CAST(c_custkey AS VARCHAR)) LIMIT 100)""",
    "groups_of_five": f"""WITH {draws_sql('customer', 'c_custkey')}
SELECT draw, arg_max(c_name, (c_acctbal, -pos)) AS winner, count(DISTINCT c_custkey) AS members FROM drawn GROUP BY draw""",
    "items_extraction": with_cte(PRODUCT_CTE, _ITEMS["items_extraction"]),
    "items_not_disclosed": with_cte(PRODUCT_CTE, _ITEMS["items_not_disclosed"]),
    "items_comparison": with_cte(PRODUCT_CTE, _ITEMS["items_comparison"]),
    "items_ratio": with_cte(PRODUCT_CTE, _ITEMS["items_ratio"]),
    "items_boolean": with_cte(PRODUCT_CTE, _ITEMS["items_boolean"]),
    "benchmark_table": with_cte(PRODUCT_CTE, "SELECT printf('q%04d', row_number() OVER (ORDER BY md5('42:' || "
                                "concat_ws('|', category, coalesce(field, ''), company_number, md5(question))))) AS id, "
                                "* FROM (" + "\nUNION ALL\n".join(
                                    f"SELECT * FROM ({_ITEMS[k]})" for k in (
                                        "items_extraction", "items_not_disclosed", "items_comparison",
                                        "items_ratio", "items_boolean")) + ")"),
})


# ---- grading -------------------------------------------------------------------------------
FIGURE = "[0-9]+(?:\\.[0-9]+)?"
NOT_WORD = "[^\\p{L}\\p{N}_]"


def answer_number_sql(x):
    """E12 in DuckDB: the figures of the text after the last ``=``, each with what stands before and
    after it, as a scalar subquery."""
    times = ("CASE regexp_extract(after, '^\\)?\\s*([a-z]+)\\b', 1) WHEN 'k' THEN 1e3 WHEN 'thousand' THEN 1e3 "
             "WHEN 'm' THEN 1e6 WHEN 'mn' THEN 1e6 WHEN 'million' THEN 1e6 WHEN 'bn' THEN 1e9 "
             "WHEN 'b' THEN 1e9 WHEN 'billion' THEN 1e9 END")
    minus = "contains(marks, '-') OR contains(marks, '(') AND starts_with(after, ')')"
    return (f"(SELECT coalesce(min_by(v * times, i) FILTER (times IS NOT NULL), min_by(v, i)) FROM (SELECT i, {times} AS times, "
            f"CASE WHEN {minus} THEN -CAST(figure AS DOUBLE) ELSE CAST(figure AS DOUBLE) END AS v FROM (SELECT i, found[i] AS figure, "
            "regexp_extract(gaps[i], '[-(£]*$') AS marks, gaps[i + 1] || CASE WHEN i < len(found) THEN '0' ELSE '' END AS after "
            f"FROM (SELECT found, regexp_split_to_array(t, '{FIGURE}') AS gaps, unnest(range(1, len(found) + 1)) AS i "
            f"FROM (SELECT t, regexp_extract_all(t, '{FIGURE}') AS found FROM (SELECT string_split(lower(replace({x}, ',', '')), '=')[-1] AS t))))))")


def grade_numeric_sql(text, truth, rel="0.01", ab="1.0"):
    v = answer_number_sql(text)
    return (f"coalesce((SELECT abs(v - ({truth})) <= ({ab}) OR (({truth}) <> 0 AND abs(v - ({truth})) / abs({truth}) "
            f"<= ({rel})) FROM (SELECT {v} AS v)), false)")


STOP = "['ltd', 'limited', 'plc', 'llp', 'llc', 'uk', 'the', 'company', 'co']"


def norm_company_sql(s):
    return (f"regexp_replace(array_to_string(list_filter(regexp_extract_all(lower({s}), '[\\p{{L}}\\p{{N}}_]+'), "
            f"lambda w: NOT list_contains({STOP}, w)), ''), '[^a-z0-9]', '', 'g')")


def grade_choice_sql(text, truth):
    t, m = norm_company_sql(truth), norm_company_sql(text)
    return (f"coalesce(coalesce(length({text}), 0) > 0 AND coalesce(length({truth}), 0) > 0 AND "
            f"(CASE WHEN length({t}) < 3 THEN strpos({m}, {t}) > 0 ELSE strpos({m}, {t}) > 0 OR strpos({t}, {m}) > 0 END), false)")


def _word_at(t, words):
    pat = f"(?s)^(.*?(?:^|{NOT_WORD}))({words})(?:{NOT_WORD}|$)"
    return f"regexp_matches({t}, '{pat}')", f"length(regexp_extract({t}, '{pat}', 1))"


def grade_boolean_sql(text, truth):
    t = f"lower(trim({text}))"
    hy, py = _word_at(t, "yes|true|correct")
    hn, pn = _word_at(t, "no|false|incorrect")
    said = f"(CASE WHEN {hy} AND (NOT {hn} OR {py} < {pn}) THEN true WHEN {hn} THEN false END)"
    return f"coalesce(length({text}) > 0 AND {said} = ({truth}), false)"


def grade_not_disclosed_sql(text):
    from ..vocab import NOT_DISCLOSED_LETTERS, NOT_DISCLOSED_PHRASES
    t = f"lower({text})"
    letters = f"regexp_replace({t}, '[^a-z]', '', 'g')"
    q = lambda p: p.replace("'", "''")
    parts = [f"strpos({t}, '{q(p)}') > 0" for p in NOT_DISCLOSED_PHRASES]
    parts += [f"strpos({letters}, '{p}') > 0" for p in NOT_DISCLOSED_LETTERS]
    return "coalesce(" + " OR ".join(parts) + ", false)"


def _numeric_answers_sql():
    p, q = "l_extendedprice", "l_quantity"
    f0 = lambda x: f"format('{{:,.0f}}', {x})"
    f2 = lambda x: f"format('{{:,.2f}}', {x})"
    f3 = lambda x: f"format('{{:,.3f}}', {x})"
    return f"""SELECT l_orderkey, l_linenumber,
  CASE l_linenumber WHEN 1 THEN '£' || {f0(p)} WHEN 2 THEN 'about ' || {f0(q)} || 'k'
    WHEN 3 THEN '(' || {f2(p)} || ')' WHEN 4 THEN 'roughly £' || {f3(p + ' / 1e6')} || ' million'
    WHEN 5 THEN {f2(p)} || ' / 1 = ' || {f2(p)} WHEN 6 THEN 'The figure is not disclosed.'
    ELSE 'It was ' || {f2(p + ' * (1 + l_discount)')} || '.' END AS model_text,
  CASE WHEN l_linenumber = 2 THEN {q} * 1000 ELSE {p} END AS truth
FROM lineitem"""


def _answers_sql(items):
    def one(provider, model, salt):
        h = f"(CAST('0x' || substr(md5('{salt}' || id), 1, 2) AS BIGINT) % 10)"
        good = ("CASE answer_type WHEN 'numeric' THEN format('{:,.2f}', answer_num) WHEN 'choice' THEN answer_text "
                "WHEN 'boolean' THEN CASE WHEN answer_bool THEN 'Yes, it is.' ELSE 'No.' END "
                "ELSE 'That figure is not disclosed in these accounts.' END")
        text = (f"CASE WHEN {h} = 0 THEN '<error: timeout>' WHEN {h} <= 6 THEN {good} "
                f"WHEN {h} = 7 THEN CASE WHEN answer_type = 'numeric' THEN '-' || format('{{:,.2f}}', answer_num) "
                f"ELSE 'Ltd' END WHEN {h} = 8 THEN 'I am not sure.' ELSE 'Approximately £1.2 million' END")
        return f"SELECT id AS item_id, '{provider}' AS provider, '{model}' AS model, {text} AS model_answer FROM {items}"
    return one("p1", "m1", "a:") + " UNION ALL " + one("p2", "m2", "b:")


def _graded_sql():
    bt = ORACLE["benchmark_table"]
    grade = (f"CASE answer_type WHEN 'numeric' THEN {grade_numeric_sql('model_answer', 'answer_num', 'coalesce(rel_tol, 0.01)', 'coalesce(abs_tol, 1.0)')} "
             f"WHEN 'choice' THEN {grade_choice_sql('model_answer', 'answer_text')} "
             f"WHEN 'boolean' THEN {grade_boolean_sql('model_answer', 'answer_bool')} "
             f"WHEN 'not_disclosed' THEN {grade_not_disclosed_sql('model_answer')} ELSE false END")
    return f"""bt AS ({bt}),
ans AS ({_answers_sql('bt')}),
graded AS (
  SELECT a.item_id, a.provider, a.model, b.category, b.field, b.company_number, a.model_answer, b.answer_num,
    {grade} AS correct, coalesce(starts_with(a.model_answer, '<error'), false) AS errored
  FROM ans a JOIN bt b ON a.item_id = b.id
)"""


def _accuracy_sql(src):
    return f"""SELECT a.*, g.n, g.errors FROM (
  SELECT provider, model, category, count(*) AS scored, round(avg(correct::INT::DOUBLE), 4) AS accuracy
  FROM {src} WHERE NOT errored GROUP BY ROLLUP (provider, model, category)
) a LEFT JOIN (SELECT provider, model, count(*) AS n, count_if(errored) AS errors FROM {src} GROUP BY provider, model) g
  ON a.provider = g.provider AND a.model = g.model
WHERE a.model IS NOT NULL"""


ORACLE.update({
    "grade_numeric": f"""SELECT l_orderkey, l_linenumber, model_text, {answer_number_sql('model_text')} AS parsed,
  {grade_numeric_sql('model_text', 'truth')} AS correct FROM ({_numeric_answers_sql()})""",
    "grade_choice": f"""SELECT c_custkey, model_text, {grade_choice_sql('model_text', 'c_name')} AS correct FROM (
  SELECT c_custkey, c_name, CASE c_custkey % 5 WHEN 0 THEN lower(c_name) || ' ltd'
    WHEN 1 THEN 'The ' || c_name || ' Limited' WHEN 2 THEN 'Customer#' || lpad(CAST(c_custkey + 1 AS VARCHAR), 9, '0')
    WHEN 3 THEN 'Ltd' ELSE replace(c_name, '#', ' & ') END AS model_text FROM customer)""",
    "grade_boolean": f"""SELECT conv_id, turn, {grade_boolean_sql('text', 'turn % 2 = 0')} AS correct FROM conversations""",
    "grade_not_disclosed": f"""SELECT conv_id, turn, {grade_not_disclosed_sql('text')} AS correct FROM conversations""",
    "accuracy": "WITH " + PRODUCT_CTE.strip() + ",\n" + _graded_sql() + "\n" + _accuracy_sql("graded"),
    "regrade": "WITH " + PRODUCT_CTE.strip() + ",\n" + _graded_sql() + """,
kept AS (SELECT g.* FROM graded g LEFT JOIN lat l ON l.company_number = g.company_number
         WHERE NOT (g.category = 'not_disclosed' AND coalesce(l.dormant, false)))
""" + _accuracy_sql("kept"),
    "sign_flips": "WITH " + PRODUCT_CTE.strip() + ",\n" + _graded_sql() + f"""
SELECT provider, model, count_if(coalesce(NOT correct AND NOT errored AND field = 'net_assets' AND
  abs({answer_number_sql('model_answer')} + answer_num) <= greatest(1.0, abs(answer_num) * 0.01), false)) AS sign_flips
FROM graded GROUP BY provider, model""",
})


# ---- entities, charges, catalogs -------------------------------------------------------------
def _norm_text(x):
    return f"trim(regexp_replace(regexp_replace(lower({x}), '[^a-z0-9 ]', ' ', 'g'), '\\s+', ' ', 'g'))"


def _shelf(x):
    n = f"upper(coalesce({x}, ''))"
    n = f"regexp_replace({n}, '\\b(PLC|LIMITED|LTD)\\b', '', 'g')"
    n = f"regexp_replace({n}, '\\b20\\d{{2}}[- ]?[0-9A-Z]*\\b', '', 'g')"
    n = f"regexp_replace({n}, '\\bNO\\.?\\s*\\d+\\b', '', 'g')"
    n = f"regexp_replace({n}, '\\s+', ' ', 'g')"
    return f"trim({n}, ' -')"


ENT_CTE = f"""pc AS (
  SELECT CAST(p_partkey AS VARCHAR) AS company_number,
    upper(p_name) || ' ' || upper(p_brand) || CASE WHEN p_size % 3 = 0 THEN ' PLC' ELSE ' LIMITED' END AS company_name,
    CASE WHEN p_size % 3 = 0 THEN 'plc' ELSE 'ltd' END AS company_type FROM part
),
tw AS (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS term FROM part),
terms AS (
  SELECT term, category, CASE WHEN category = 'lender' THEN 0 ELSE 1 END AS cat_rank,
    row_number() OVER (PARTITION BY category ORDER BY term) AS rank
  FROM (SELECT term, CASE WHEN length(term) % 2 = 0 THEN 'lender' ELSE 'spv' END AS category FROM tw)
),
mt AS (
  SELECT pc.*, t.term, t.category, t.cat_rank, t.rank FROM pc JOIN terms t
    ON length({_norm_text('t.term')}) > 0 AND strpos({_norm_text('pc.company_name')}, {_norm_text('t.term')}) > 0
)"""

CHG_CTE = f"""tg AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS company_number,
    printf('SUPPLIER %d FUNDING 20%02d-1 PLC', s_suppkey, s_nationkey) AS company_name,
    'active' AS company_status, 'plc' AS company_type, '2020-01-01' AS date_of_creation,
    CASE WHEN s_suppkey % 2 = 0 THEN 'spv' ELSE 'lender' END AS category,
    CASE WHEN s_suppkey % 2 = 0 THEN 'securitisation vehicle' ELSE 'non-bank lender' END AS refined_entity_type,
    CASE s_nationkey % 3 WHEN 0 THEN 'auto' WHEN 1 THEN 'mortgage' ELSE 'consumer' END AS asset_class_guess,
    CASE WHEN s_acctbal > 0 THEN 'true' ELSE 'false' END AS strict_non_bank_lender_scope
  FROM supplier
),
ch AS (
  SELECT CAST(user_id AS VARCHAR) AS company_number, 'C' || CAST(event_id AS VARCHAR) AS charge_code,
    CASE event_type WHEN 'purchase' THEN 'satisfied' WHEN 'error' THEN 'part-satisfied' ELSE 'outstanding' END AS status,
    CAST(regexp_extract(props, '"k":\\s*(-?\\d+)', 1) AS INTEGER) AS k
  FROM events
)"""

IDX_CTE = """pg AS (
  SELECT o_orderkey AS page_id, strftime(o_orderdate, '%Y-%m-%d') AS d, o_orderkey % 3 <> 0 AS sized,
    CAST(format('{:.1f}', o_totalprice / 1e4) AS DOUBLE) AS size, o_orderstatus,
    strftime(o_orderdate, '%B') AS month_name, year(o_orderdate) AS y, month(o_orderdate) AS m
  FROM orders
),
cat AS (
  SELECT 'Accounts_Bulk_Data-' || d || '.zip' AS name, d AS date,
    arg_max(CASE WHEN sized THEN size END, CASE WHEN sized THEN page_id END) AS size_mb
  FROM pg GROUP BY d
),
mcat AS (
  SELECT DISTINCT 'Accounts_Monthly_Data-' || month_name || CAST(y AS VARCHAR) || '.zip' AS name,
    CAST(y AS INTEGER) AS year, CAST(m AS INTEGER) AS month FROM pg
)"""

ORACLE.update({
    "match_terms": with_cte(ENT_CTE, "SELECT company_number, term FROM mt"),
    "find_entities": with_cte(ENT_CTE, """
SELECT company_number, first(company_name) AS company_name, arg_min(category, (cat_rank, rank)) AS category,
  array_to_string(list_sort(list_distinct(list(term))), '; ') AS matched_terms
FROM mt GROUP BY company_number"""),
    "term_hits": with_cte(ENT_CTE, """
SELECT category, term, count(*) AS name_matched, count_if(lower(company_type) = 'plc') AS plc_matched
FROM mt GROUP BY category, term"""),
    "shelf_of": "SELECT p_partkey, name, " + _shelf("name") + """ AS shelf FROM (
  SELECT p_partkey, upper(p_name) || ' FUNDING ' || CAST(p_size % 30 + 2000 AS VARCHAR) ||
    CASE WHEN p_size % 2 = 0 THEN '-' || CAST(p_size % 5 AS VARCHAR) ELSE '' END ||
    ' NO.' || CAST(p_size % 7 AS VARCHAR) || ' PLC' AS name FROM part)""",
    "charge_rows": with_cte(CHG_CTE, f"""
SELECT c.company_number, c.charge_code, c.status, t.category, {_shelf('t.company_name')} AS shelf,
  CASE c.k % 3 WHEN 0 THEN 'GLAS TRUST CORPORATION LIMITED' WHEN 1 THEN '[individual redacted]'
    ELSE 'HSBC BANK PLC; [individual redacted]' END AS persons_entitled,
  c.k % 3 <> 0 AS persons_entitled_has_individual, c.k % 2 = 0 AS contains_negative_pledge
FROM ch c JOIN tg t ON c.company_number = t.company_number"""),
    "charge_summary": with_cte(CHG_CTE, """
SELECT company_number, count(*) AS charges_total, count_if(status = 'outstanding') AS charges_outstanding
FROM ch GROUP BY company_number"""),
    "entities": with_cte(CHG_CTE, f"""
SELECT t.company_number, t.company_name, t.company_status, t.company_type, t.date_of_creation, t.category,
  t.refined_entity_type, t.asset_class_guess, t.strict_non_bank_lender_scope,
  CASE WHEN t.category = 'spv' THEN {_shelf('t.company_name')} ELSE '' END AS shelf,
  coalesce(s.charges_total, 0) AS charges_total, coalesce(s.charges_outstanding, 0) AS charges_outstanding
FROM tg t LEFT JOIN (SELECT company_number, count(*) AS charges_total,
  count_if(status = 'outstanding') AS charges_outstanding FROM ch GROUP BY company_number) s
  ON s.company_number = t.company_number"""),
    "archive_catalog": with_cte(IDX_CTE, "SELECT name, date, size_mb FROM cat"),
    "company_catalog": with_cte(IDX_CTE, """
SELECT DISTINCT 'BasicCompanyDataAsOneFile-' || d || '.zip' AS name, d AS date FROM pg WHERE o_orderstatus = 'P'"""),
    "monthly_catalog": with_cte(IDX_CTE, "SELECT name, year, month FROM mcat"),
    "trailing_months": with_cte(IDX_CTE, "SELECT name, year, month FROM mcat ORDER BY year DESC, month DESC LIMIT 12"),
    "smallest_recent": with_cte(IDX_CTE, """
SELECT * FROM (SELECT * FROM cat ORDER BY date DESC LIMIT 15) ORDER BY size_mb ASC NULLS LAST, date LIMIT 1"""),
})


# ---- raw-filing benchmarks and the post-cut-off slice ----------------------------------------
RAW_QUOTAS = [("net_assets", 90), ("employees", 70), ("cash", 50), ("current_assets", 40),
              ("f_within_creditors_total", 30)]


def _raw_items_sql(src, seed, prefix, key, named, trap_extra=""):
    nm = "company_name IS NOT NULL AND " if named else ""
    parts = []
    for f, n in RAW_QUOTAS:
        cond = f"{f} IS NOT NULL" if f == "net_assets" else f"{f} > 0"
        ans = "CAST(CAST(round_even(employees, 0) AS BIGINT) AS DOUBLE)" if f == "employees" else f
        parts.append(f"""SELECT * FROM (SELECT 'extraction' AS category, 'numeric' AS answer_type, '{f}' AS field,
  company_number, filing_id, period_end, {ans} AS answer_num, CAST(NULL AS VARCHAR) AS answer_text, {key} AS k
  FROM {src} WHERE {nm}{cond} ORDER BY md5('{seed}:{f}:' || {key}) LIMIT {n})""")
    parts.append(f"""SELECT * FROM (SELECT 'turnover_trap' AS category, 'not_disclosed' AS answer_type,
  'turnover' AS field, company_number, filing_id, period_end, CAST(NULL AS DOUBLE) AS answer_num,
  'NOT_DISCLOSED' AS answer_text, {key} AS k
  FROM {src} WHERE {nm}turnover IS NULL AND net_assets IS NOT NULL AND NOT coalesce(dormant, false){trap_extra}
  ORDER BY md5('{seed}:turnover:' || {key}) LIMIT 70)""")
    u = "\nUNION ALL\n".join(parts)
    return f"""SELECT printf('{prefix}%04d', row_number() OVER (ORDER BY md5('{seed}:' || concat_ws('|', category, field, k))))
  AS id, category, answer_type, field, company_number, filing_id, period_end, answer_num, answer_text FROM ({u})"""


ORACLE.update({
    "raw_benchmark": "WITH " + PRODUCT_CTE.strip() + """,
pool AS (SELECT * FROM lat)
""" + _raw_items_sql("pool", 7, "h", "company_number", True),
    "latest_in_archive": "WITH " + PRODUCT_CTE.strip() + """,
newest AS (SELECT max(strftime(o_orderdate, '%Y-%m')) AS m FROM orders)
SELECT company_number, filing_id, source_file FROM lat
WHERE source_file IN (SELECT source_file FROM prod WHERE strftime(o_orderdate, '%Y-%m') = (SELECT m FROM newest))""",
    "contamination_threshold": """
SELECT CAST(max(released) + INTERVAL 1 DAY AS DATE) AS threshold, arg_max(name, (released, name)) AS newest_model FROM (
  SELECT o_orderpriority AS name, CAST(min(CAST(o_orderdate AS DATE)) + INTERVAL 30 DAY * CAST(left(o_orderpriority, 1) AS INTEGER) AS DATE) AS released
  FROM orders GROUP BY o_orderpriority)""",
    "post_cutoff": "WITH " + PRODUCT_CTE.strip() + """,
thr AS (SELECT CAST(max(released) + INTERVAL 1 DAY AS DATE) AS t FROM (
  SELECT CAST(min(CAST(o_orderdate AS DATE)) + INTERVAL 30 DAY * CAST(left(o_orderpriority, 1) AS INTEGER) AS DATE) AS released
  FROM orders GROUP BY o_orderpriority)),
smp AS (SELECT * FROM prod WHERE CAST(o_orderdate AS DATE) >= (SELECT t FROM thr)),
pool AS (SELECT * EXCLUDE (net_assets, employees, cash, current_assets),
  CASE WHEN net_assets_tag IS NOT NULL THEN CASE WHEN net_assets_in_period THEN net_assets END
       WHEN equity IS NOT NULL THEN CASE WHEN equity_in_period THEN net_assets END END AS net_assets,
  CASE WHEN employees_in_period THEN employees END AS employees,
  CASE WHEN cash_in_period THEN cash END AS cash,
  CASE WHEN current_assets_in_period THEN current_assets END AS current_assets
  FROM smp)
""" + _raw_items_sql("pool", 11, "p", "filing_id", False),
})


# ---- further operators ------------------------------------------------------------------------
def _bt_sql():
    return ORACLE["benchmark_table"]


def _dist_json(col):
    return (f"(SELECT '{{' || string_agg('\"' || {col} || '\":' || CAST(n AS VARCHAR), ',' ORDER BY {col}) || '}}' "
            f"FROM (SELECT {col}, count(*) AS n FROM prod WHERE {col} IS NOT NULL GROUP BY {col}))")


ORACLE.update({
    "facts_with_context": with_cte(FACTS_CTE + ",\n" + META_CTE, f"""
SELECT 'F' || CAST(okey AS VARCHAR) AS filing_id, CAST(ord AS INTEGER) AS ord, concept, context_ref,
  CASE WHEN is_dur THEN 'duration' ELSE 'instant' END AS period_type,
  printf('%04d-12-31', year(o.o_orderdate) - CASE WHEN l_linestatus = 'F' THEN 0 ELSE 1 END) AS period_end,
  CASE WHEN NOT is_dur AND l_returnflag <> 'A' THEN 1 ELSE 0 END AS n_dimensions
FROM vf JOIN orders o ON o.o_orderkey = vf.okey
UNION ALL
SELECT 'F' || CAST(m.okey AS VARCHAR), CAST(coalesce(n.n, 0) + row_number() OVER (PARTITION BY m.okey ORDER BY k) - 1
  AS INTEGER), concept, 'dur_cur', 'duration', printf('%04d-12-31', year(o.o_orderdate)), 0
FROM meta m LEFT JOIN nlines n ON n.okey = m.okey JOIN orders o ON o.o_orderkey = m.okey"""),
    "distinct_numbers": f"SELECT DISTINCT {pad8('CAST(o_custkey AS VARCHAR)')} AS company_number FROM orders",
    "cap_filings": """
SELECT archive, filing_id FROM (
  SELECT 'Accounts_Bulk_Data-' || strftime(o_orderdate, '%Y-%m-%d') || '.zip' AS archive,
    'F' || CAST(o_orderkey AS VARCHAR) AS filing_id,
    row_number() OVER (PARTITION BY strftime(o_orderdate, '%Y-%m-%d') ORDER BY 'F' || CAST(o_orderkey AS VARCHAR)) AS rn
  FROM orders) WHERE rn <= 3""",
    "items_by_category": "SELECT category, count(*) AS n FROM (" + _bt_sql() + ") GROUP BY category",
    "candidate_counts": with_cte(ENT_CTE, """
SELECT category, count(*) AS candidates, count_if(lower(company_type) = 'plc') AS plcs FROM (
  SELECT company_number, first(company_type) AS company_type, arg_min(category, (cat_rank, rank)) AS category
  FROM mt GROUP BY company_number) GROUP BY category"""),
    "targets_in_dataset": """
SELECT (SELECT count(*) FROM supplier WHERE CAST(s_suppkey AS VARCHAR) IN
          (SELECT CAST(o_custkey AS VARCHAR) FROM orders)) AS in_dataset,
       (SELECT count(*) FROM supplier) AS targets""",
    "first_wrong_answers": "WITH " + PRODUCT_CTE.strip() + ",\n" + _graded_sql() + """
SELECT provider, model, item_id, category, model_answer FROM (
  SELECT *, row_number() OVER (PARTITION BY provider, model ORDER BY item_id) AS rn
  FROM graded WHERE NOT correct AND NOT errored) WHERE rn <= 6""",
    "item_sample": "SELECT id, category, answer_type, 'Question:' || string_split(question, 'Question:')[-1] AS question, "
                   "answer_num, answer_text, answer_bool FROM (" + _bt_sql() + ") ORDER BY id LIMIT 12",
    "manifest": "WITH " + PRODUCT_CTE.strip() + "\nSELECT count(*) AS record_count, " + ", ".join(
        f"round(count({'NULL' if c in _NULL_ALWAYS else c}) / greatest(count(*), 1), 4) AS cov_{c}" for c in COV)
        + f", (SELECT count(DISTINCT company_number) FROM prod WHERE company_number IS NOT NULL) AS unique_companies, "
        + f"{_dist_json('taxonomy')} AS taxonomy_distribution, "
        + f"{_dist_json('accounts_type')} AS accounts_type_distribution FROM prod",
})


# ---- the rendered text of the virtual filings, straight from the tables -----------------------
_BOUND = "CASE WHEN l_discount >= 0.07 AND l_discount < 0.08 THEN '{a} ' || t || ' {b}' WHEN l_discount >= 0.03 AND l_discount < 0.07 THEN '{a}' || t || '{b}' ELSE t END".format(a="(", b=")")
_CONTEXTS = " || ' ' || ".join(
    ["cid || ' ' || {0} || '-01-01 ' || {0} || '-12-31'".format(y) for y in ("y", "p")]
    + ["cid || ' ' || {0} || '-12-31'".format(y) for y in ("y", "p")]
    + ["cid || ' core:{1} ' || {0} || '-12-31'".format(y, m) for y in ("y", "p") for m in ("WithinOneYear", "AfterOneYear")])
RENDER_CTE = f""",
shown AS (SELECT okey, ord, concept, l_discount, CASE WHEN scale = '3' THEN format('{{:,}}', CAST(raw_num AS BIGINT))
    ELSE format('{{:,}}', CAST(round(raw_num * 100) AS BIGINT) // 100) || '.' || lpad(CAST(CAST(round(raw_num * 100) AS BIGINT) % 100 AS VARCHAR), 2, '0') END AS t FROM vf),
cells AS (SELECT okey, string_agg(concept || ' ' || {_BOUND}, ' ' ORDER BY ord) AS cells FROM shown GROUP BY okey),
heads AS (SELECT *, CAST(o_custkey AS VARCHAR) AS cid, printf('%04d', year(o_orderdate)) AS y, printf('%04d', year(o_orderdate) - 1) AS p FROM orders),
texts AS (SELECT 'F' || CAST(o_orderkey AS VARCHAR) AS filing_id, concat_ws(' ', 'Annual accounts', {_CONTEXTS},
    'iso4217:' || CASE WHEN o_orderstatus = 'O' THEN 'EUR' ELSE 'GBP' END || ' xbrli:pure', cells,
    CASE o_orderstatus WHEN 'F' THEN 'false' WHEN 'P' THEN 'TRUE' END,
    CASE o_custkey % 4 WHEN 0 THEN 'Audited' WHEN 1 THEN 'Unaudited' WHEN 2 THEN 'Exempt from audit' END,
    CASE WHEN o_custkey % 4 = 3 AND o_orderkey % 2 = 0 THEN 'The company is entitled to exemption from audit.' END,
    CASE WHEN o_totalprice >= 400000 THEN 'Full accounts' END,
    CASE WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_custkey % 2 = 0 THEN 'FRS102' END, '[redacted]') AS text
  FROM heads LEFT JOIN cells ON okey = o_orderkey)
"""

ORACLE["rejects"] = """SELECT 'F' || CAST(o_orderkey AS VARCHAR) AS filing_id,
  'EmptyFiling: no element in the document' AS parse_error FROM orders WHERE o_custkey % 10 <= 2"""
ORACLE.update({
    "render_filings": with_cte(FACTS_CTE + RENDER_CTE, """
SELECT filing_id, CAST(length(text) AS INT) AS n_chars, md5(text) AS text_md5, false AS css_leak FROM texts"""),
    "figure_visible": with_cte(PICKS_CTE + RENDER_CTE, """
SELECT r.filing_id, strpos(replace(text, ',', ''), CAST(CAST(trunc(abs(net_assets)) AS BIGINT) AS VARCHAR)) > 0 AS visible,
  false AS css_leak, true AS officer_redacted
FROM rec r JOIN texts t ON t.filing_id = r.filing_id WHERE net_assets IS NOT NULL"""),
})


# ---- jobs whose files are read back ------------------------------------------------------------
ORACLE["register_charges"] = ORACLE["charge_rows"]
ORACLE["entity_dataset"] = ORACLE["entities"]
ORACLE["build_product"] = "WITH " + PRODUCT_CTE.strip() + """,
months AS (SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS month FROM orders ORDER BY month DESC LIMIT 12)
SELECT strftime(p.o_orderdate, '%Y-%m') AS month, count(*) AS filings, count(DISTINCT company_number) AS companies,
  count(company_name) AS matched, count(net_assets) AS with_net_assets
FROM prod p WHERE strftime(p.o_orderdate, '%Y-%m') IN (SELECT month FROM months) GROUP BY 1"""
