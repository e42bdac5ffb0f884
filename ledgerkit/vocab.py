"""Small static vocabularies.

Everything below is a FIXED VALUE: concept names come from the public FRC
taxonomy, and the other lists are the values the results must agree with.
They are kept in their natural order, as plain text.
"""
from __future__ import annotations

# ---- fixed values: record fields -> taxonomy concept local names ------------
FIELD_CONCEPTS = {
    "turnover": ["TurnoverRevenue", "Turnover", "Revenue"],
    "gross_profit": ["GrossProfitLoss"],
    "operating_profit": ["OperatingProfitLoss"],
    "interest_payable": ["InterestPayableSimilarChargesFinanceCosts", "InterestPayableSimilarCharges", "FinanceCosts"],
    "interest_receivable": ["InterestReceivableSimilarIncomeFinanceIncome", "InterestReceivableSimilarIncome"],
    "profit_before_tax": ["ProfitLossOnOrdinaryActivitiesBeforeTax", "ProfitLossBeforeTax"],
    "tax": ["TaxTaxCreditOnProfitOrLossOnOrdinaryActivities", "TaxOnProfitOrLossOnOrdinaryActivities"],
    "profit_for_year": ["ProfitLoss"],
    "dividends": ["DividendsPaid", "Dividends", "DividendsPaidProposed"],
    "staff_costs": ["StaffCostsEmployeeBenefitsExpense", "StaffCosts"],
    "fixed_assets": ["FixedAssets"],
    "property_plant_equipment": ["PropertyPlantEquipment"],
    "current_assets": ["CurrentAssets"],
    "debtors": ["Debtors"],
    "cash": ["CashBankOnHand", "CashBankInHand", "CashCashEquivalents"],
    "net_current_assets": ["NetCurrentAssetsLiabilities"],
    "talcl": ["TotalAssetsLessCurrentLiabilities"],
    "total_assets_direct": ["Assets", "TotalAssets"],
    "net_assets": ["NetAssetsLiabilities", "NetAssetsLiabilitiesIncludingPensionAssetLiability"],
    "equity": ["Equity", "ShareholdersFunds", "TotalShareholdersFunds", "CapitalEmployed"],
    "provisions": ["ProvisionsForLiabilitiesBalanceSheetSubtotal", "Provisions"],
    "employees": ["AverageNumberEmployeesDuringPeriod", "NumberEmployees", "AverageNumberEmployees"],
}
DURATION_FIELDS = [
    "turnover", "gross_profit", "operating_profit", "interest_payable", "interest_receivable",
    "profit_before_tax", "tax", "profit_for_year", "dividends", "staff_costs", "employees",
]

# ---- fixed values: funding labels -> concept local names ----------------------
FUNDING_CONCEPTS = {
    "bank_loans": ["BankBorrowingsOverdrafts", "BankBorrowings", "BankLoans", "BankOverdrafts", "BankLoansOverdrafts"],
    "other_loans": ["OtherBorrowings", "OtherLoans"],
    "finance_leases": ["NetObligationsUnderFinanceLeasesHirePurchaseContracts", "ObligationsUnderFinanceLeasesHirePurchaseContracts"],
    "trade_creditors": ["TradeCreditorsTradePayables", "TradeCreditors"],
    "intercompany": ["AmountsOwedToGroupUndertakings"],
    "director_loans": ["DirectorLoanAccount", "AmountsOwedToDirectors"],
    "tax_social_security": ["TaxationSocialSecurityPayable"],
    "accruals_deferred": ["AccruedLiabilitiesDeferredIncome", "AccrualsDeferredIncome"],
    "other_creditors": ["OtherCreditors"],
}
CREDITORS_TOTAL_CONCEPTS = ["Creditors"]
DEBT_LIKE = ["bank_loans", "other_loans", "finance_leases"]

# ---- fixed values: tagged meta facts --------------------------------------------
META_TAGS = {
    "accounts_type": "AccountsType",
    "accounting_standard": "AccountingStandardsApplied",
    "audit_status": "AccountsStatusAuditedOrUnaudited",
    "dormant_tag": "EntityDormantTruefalse",
}

# ---- fixed values: personal-data concepts that may never be output columns --------
PERSONAL_CONCEPTS = ["NameEntityOfficer", "DirectorSigningFinancialStatements",
                     "NameIndividualOfficer", "NamePerson"]

# ---- fixed values: fields counted by the completeness score -------------------------
COMPLETENESS_FIELDS = ["turnover", "gross_profit", "operating_profit", "total_assets",
                       "total_liabilities", "net_assets", "cash", "net_debt", "employees"]
# product coverage adds two more fields
PRODUCT_COVERAGE_FIELDS = COMPLETENESS_FIELDS + ["property_plant_equipment",
                                                 "total_assets_less_current_liabilities"]

# ---- fixed values: company metadata kept (output name -> CSV column) ----------------
METADATA_KEEP = {
    "company_name": "CompanyName",
    "company_type": "CompanyCategory",
    "company_status": "CompanyStatus",
    "incorporation_date": "IncorporationDate",
    "dissolution_date": "DissolutionDate",
    "accounts_category": "Accounts.AccountCategory",
}
SIC_COLUMNS = ["SICCode.SicText_1", "SICCode.SicText_2", "SICCode.SicText_3", "SICCode.SicText_4"]
ADDRESS_COLUMNS_NEVER_READ = ["RegAddress.CareOf", "RegAddress.POBox",
                              "RegAddress.AddressLine1", "RegAddress.AddressLine2"]
METADATA_COLUMNS = ["company_name", "company_type", "company_status", "sic_codes",
                    "incorporation_date", "region_outcode", "post_town", "country",
                    "accounts_category"]

# ---- fixed values: substrings of concept names whose facts are redacted ---------------
REDACT_HINTS = ["officer", "signing", "signator", "forename", "surname", "nameindividual",
                "contactname", "addressline", "postalcode", "postcode", "telephone",
                "phone", "email", "faxnumber", "directorname"]

# ---- fixed values: tokens that mark a secured party's name as corporate -----------------
CORP_TOKENS = ["LIMITED", "LTD", "PLC", "LLP", " LP", "N.A", " NA", "TRUSTEE", "TRUST", "BANK",
               "CORPORATION", "COMPANY", "SERVICES", "S.A", " AG", "GMBH", "INC", "B.V", "N.V",
               "NOMINEE", "SECURITIES", "CAPITAL", "FINANCE", "FUNDING", "HOLDINGS", "GROUP",
               "ASSOCIATION", "SOCIETY", "PARTNERS", "MELLON", "CITI", "HSBC", "BARCLAYS", "GLAS"]

# ---- fixed values: number words in free-text answers --------------------------------------
MULTIPLIERS = {"k": 1e3, "thousand": 1e3, "m": 1e6, "mn": 1e6, "million": 1e6,
               "bn": 1e9, "b": 1e9, "billion": 1e9}

# ---- fixed values: phrases meaning "the figure is not disclosed" --------------------------
NOT_DISCLOSED_PHRASES = [
    "not disclosed", "not stated", "not provided", "not available", "not shown",
    "not reported", "cannot be determined", "cannot determine", "can't be determined",
    "no turnover", "not included", "does not disclose", "is not disclosed",
    "isn't disclosed", "not present", "not applicable", "n/a", "unable to",
    "not given", "no figure", "not in these accounts"]
NOT_DISCLOSED_LETTERS = [
    "notdisclosed", "notstated", "notprovided", "notavailable", "notshown",
    "notreported", "cannotbedetermined", "cannotdetermine", "noturnover",
    "notincluded", "doesnotdisclose", "isnotdisclosed", "notpresent",
    "notapplicable", "notgiven", "nofigure", "notintheseaccounts", "unableto"]

# ---- fixed values: balance-sheet extract lines, in presentation order ----------------------
EXTRACT_ROWS = [
    ("property_plant_equipment", "Tangible fixed assets (property, plant & equipment)"),
    ("current_assets", "Current assets"),
    ("debtors", "Debtors"),
    ("cash", "Cash at bank and in hand"),
    ("f_within_creditors_total", "Creditors: amounts falling due within one year"),
    ("net_current_assets", "Net current assets"),
    ("total_assets_less_current_liabilities", "Total assets less current liabilities"),
    ("f_after_creditors_total", "Creditors: amounts falling due after more than one year"),
    ("provisions", "Provisions for liabilities"),
    ("net_assets", "Net assets"),
    ("turnover", "Turnover"),
    ("gross_profit", "Gross profit"),
    ("operating_profit", "Operating profit"),
    ("profit_before_tax", "Profit before taxation"),
    ("employees", "Average number of employees"),
]
FIELD_LABELS = {
    "net_assets": "net assets",
    "current_assets": "current assets",
    "cash": "cash at bank and in hand",
    "property_plant_equipment": "tangible fixed assets",
    "f_within_creditors_total": "creditors falling due within one year",
    "employees": "average number of employees",
    "turnover": "turnover",
}

# ---- fixed values: benchmark quotas and seeds ------------------------------------------------
CLEAN_SEED = 42
CLEAN_EXTRACTION_QUOTAS = {"net_assets": 90, "current_assets": 55, "cash": 50,
                           "property_plant_equipment": 50, "f_within_creditors_total": 45,
                           "employees": 50, "turnover": 40}
CLEAN_NOT_DISCLOSED = 150
CLEAN_COMPARISON_DRAWS = 200
CLEAN_RATIO = 150
CLEAN_BOOLEAN_EACH = 60
RAW_SEED = 7
RAW_EXTRACTION_QUOTAS = {"net_assets": 90, "employees": 70, "cash": 50, "current_assets": 40,
                         "f_within_creditors_total": 30}
RAW_TRAP = 70
POSTCUTOFF_SEED = 11

# ---- fixed values: words left out of a company name when answers are compared ---------------
CHOICE_STOPWORDS = ["ltd", "limited", "plc", "llp", "llc", "uk", "the", "company", "co"]

# ---- fixed values: what is removed from an issuer's name to get its shelf --------------------
SHELF_PATTERNS = ["\\b(PLC|LIMITED|LTD)\\b", "\\b20\\d{2}[- ]?[0-9A-Z]*\\b", "\\bNO\\.?\\s*\\d+\\b"]
