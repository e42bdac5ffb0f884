"""Our own synthetic filings carrying the figures listed in FIXTURES.md (markup written here)."""

NS = ('xmlns="http://www.w3.org/1999/xhtml" xmlns:ix="http://www.xbrl.org/2013/inlineXBRL" '
      'xmlns:xbrli="http://www.xbrl.org/2003/instance" xmlns:link="http://www.xbrl.org/2003/linkbase" '
      'xmlns:xlink="http://www.w3.org/1999/xlink" xmlns:xbrldi="http://xbrl.org/2006/xbrldi" '
      'xmlns:core="http://xbrl.frc.org.uk/fr/2023-01-01/core" xmlns:bus="http://xbrl.frc.org.uk/cd/2023-01-01/business"')


def ctx(cid, ident, start=None, end=None, instant=None, member=None):
    seg = (f'<xbrli:segment><xbrldi:explicitMember dimension="core:MaturitiesOrExpirationPeriodsDimension">'
           f'core:{member}</xbrldi:explicitMember></xbrli:segment>') if member else ""
    per = (f"<xbrli:instant>{instant}</xbrli:instant>" if instant else
           f"<xbrli:startDate>{start}</xbrli:startDate><xbrli:endDate>{end}</xbrli:endDate>")
    return (f'<xbrli:context id="{cid}"><xbrli:entity><xbrli:identifier scheme="x">{ident}</xbrli:identifier>'
            f'{seg}</xbrli:entity><xbrli:period>{per}</xbrli:period></xbrli:context>')


def fact(concept, cref, text, scale=None, unit="GBP", sign=None):
    sc = f' scale="{scale}"' if scale is not None else ""
    sg = f' sign="{sign}"' if sign else ""
    return (f'<tr><td>{concept}</td><td><ix:nonFraction name="core:{concept}" contextRef="{cref}" '
            f'unitRef="{unit}"{sc}{sg}>{text}</ix:nonFraction></td></tr>')


def doc(ref, contexts, facts, extra=""):
    return (f'<html {NS}><head><style>p{{font-family:Arial;margin:0}}</style></head><body>'
            f'<div style="display:none"><ix:header><ix:references><link:schemaRef xlink:href="{ref}"/>'
            f'</ix:references><ix:resources>{"".join(contexts)}'
            '<xbrli:unit id="GBP"><xbrli:measure>iso4217:GBP</xbrli:measure></xbrli:unit>'
            '<xbrli:unit id="pure"><xbrli:measure>xbrli:pure</xbrli:measure></xbrli:unit>'
            f'</ix:resources></ix:header></div><table>{"".join(facts)}</table>{extra}</body></html>')


def full_filing():
    c = [ctx("dur_cur", "12345678", "2024-01-01", "2024-12-31"), ctx("dur_prev", "12345678", "2023-01-01", "2023-12-31"),
         ctx("inst_cur", "12345678", instant="2024-12-31"), ctx("inst_prev", "12345678", instant="2023-12-31"),
         ctx("inst_cur_within", "12345678", instant="2024-12-31", member="WithinOneYear"),
         ctx("inst_cur_after", "12345678", instant="2024-12-31", member="AfterOneYear")]
    f = [fact("Turnover", "dur_cur", "5,000", 3), fact("Turnover", "dur_prev", "4,500", 3),
         fact("GrossProfitLoss", "dur_cur", "2,000", 3), fact("OperatingProfitLoss", "dur_cur", "1,200", 3),
         fact("InterestPayableSimilarChargesFinanceCosts", "dur_cur", "80", 3),
         fact("ProfitLossOnOrdinaryActivitiesBeforeTax", "dur_cur", "1,120", 3),
         fact("FixedAssets", "inst_cur", "1,500", 3), fact("CurrentAssets", "inst_cur", "1,200", 3),
         fact("CashBankOnHand", "inst_cur", "500", 3), fact("NetAssetsLiabilities", "inst_cur", "1,350", 3),
         fact("NetAssetsLiabilities", "inst_prev", "1,250", 3), fact("BankBorrowings", "inst_cur_within", "300", 3),
         fact("BankBorrowings", "inst_cur_after", "400", 3),
         fact("TradeCreditorsTradePayables", "inst_cur_within", "250", 3),
         fact("Creditors", "inst_cur_within", "600", 3), fact("Creditors", "inst_cur_after", "750", 3),
         fact("NetObligationsUnderFinanceLeasesHirePurchaseContracts", "inst_cur_after", "150", 3),
         fact("AmountsOwedToGroupUndertakings", "inst_cur_after", "200", 3),
         fact("StaffCostsEmployeeBenefitsExpense", "dur_cur", "900", 3),
         fact("AverageNumberEmployeesDuringPeriod", "dur_cur", "42", None, unit="pure")]
    return doc("https://xbrl.frc.org.uk/FRS-102/2024-01-01/FRS-102-2024-01-01.xsd", c, f)


def micro_filing():
    c = [ctx("dur_cur", "87654321", "2024-01-01", "2024-12-31"), ctx("inst_cur", "87654321", instant="2024-12-31"),
         ctx("inst_prev", "87654321", instant="2023-12-31")]
    f = [fact("FixedAssets", "inst_cur", "80,000", 0), fact("FixedAssets", "inst_prev", "72,000", 0),
         fact("CurrentAssets", "inst_cur", "45,000", 0), fact("CurrentAssets", "inst_prev", "40,000", 0),
         fact("NetAssetsLiabilities", "inst_cur", "60,000", 0), fact("NetAssetsLiabilities", "inst_prev", "52,000", 0),
         fact("AverageNumberEmployeesDuringPeriod", "dur_cur", "3", 0, unit="pure")]
    return doc("https://xbrl.frc.org.uk/FRS-105/2024-01-01/FRS-105-2024-01-01.xsd", c, f)


def net_cash_filing():
    c = [ctx("inst_cur", "11111111", instant="2024-12-31")]
    return doc("https://example.org/x.xsd", c, [fact("CashBankOnHand", "inst_cur", "10,000", 0)])
