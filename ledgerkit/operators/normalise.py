"""Normalisation (N1-N29): parsed filing -> one wide record with provenance.

A parsed filing is one row holding its facts and contexts in document order, and each
fact names the place of its context there.  Everything is computed in that row: the
facts of the record's concepts are taken out once, with their values and what their
contexts say, and gathered once into maps, the best fact of each concept and the sum of
each funding label and slot.  A record's figures are looked up there, so a filing pays
for the concepts it holds, not for every field times every fact.  No fact becomes a row,
so there is no generator, sort, shuffle, join or Python after the parse, and a filing of
many facts costs in proportion.  Rejects (``parse_error``) are no records.

Pick rule (N4): synonyms pooled; facts in the preferred period first, then the
largest absolute value, ties to the first in document order.  This is the
maximum of ``struct(in_period, abs(value), -ord, value)``.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab
from ..functions.numbers import bracket_negated, displayed_number, raw_number
from .extract import period_type

DEC = "decimal(38,6)"


def _blank(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def _first(arr: Column) -> Column:
    return F.try_element_at(arr, F.lit(1))


def _last(arr: Column) -> Column:
    return F.try_element_at(arr, F.lit(-1))


def maturity_bucket(dims: Column) -> Column:
    """First dimension member naming within / after one year."""
    def b(d):
        m = F.lower(d["member"])
        return (F.when(m.contains("withinoneyear"), F.lit("within"))
                .when(m.contains("afteroneyear") | m.contains("aftermorethanoneyear"), F.lit("after")))
    return _first(F.filter(F.transform(dims, b), lambda x: x.isNotNull()))


def _end(c: Column) -> Column:
    return F.coalesce(_blank(c["instant"]), _blank(c["end_date"]))


def _plain(c: Column, kind: str) -> Column:
    """A context without dimensions of this period type."""
    return (F.size(c["dimensions"]) == 0) & (period_type(_blank(c["instant"]), _blank(c["start_date"]), _blank(c["end_date"])) == kind)


def with_periods(parsed: DataFrame) -> DataFrame:
    """N1 + N2: period end over all contexts, start of the plain in-period durations; ``_ctx``: what
    facts need of each context in period, is it a plain instant or duration, and its slot (N8/N9)."""
    df = parsed.withColumn("period_end", F.array_max(F.transform("contexts", _end)))
    starts = F.filter("contexts", lambda c: (_end(c) == F.col("period_end")) & _plain(c, "duration"))

    def told(c: Column) -> Column:
        flag = lambda kind: F.col("period_end").isNotNull() & _plain(c, kind)
        slot = F.coalesce(maturity_bucket(c["dimensions"]), F.when(flag("instant"), F.lit("plain")))
        return F.when(_end(c).eqNullSafe(F.col("period_end")), F.struct(
            flag("instant").alias("in_inst"), flag("duration").alias("in_dur"), slot.alias("slot")))

    return df.withColumns({"period_start": F.array_min(F.transform(starts, lambda c: _blank(c["start_date"]))),
                           "_ctx": F.transform("contexts", told)})


#: What a concept's figures are for: a field, a funding label or the creditors' total.
CREDITORS = "creditors_total"
PURPOSE = {c: purpose for purpose, names in (*vocab.FIELD_CONCEPTS.items(), *vocab.FUNDING_CONCEPTS.items(),
                                             (CREDITORS, vocab.CREDITORS_TOTAL_CONCEPTS)) for c in names}


def _exempts(concept: Column) -> Column:
    return F.coalesce(F.lower(concept).contains("exemptionfromaudit"), F.lit(False))


def with_facts(df: DataFrame) -> DataFrame:
    """``_f``: the facts of PURPOSE that hold a number, in order: place, purpose, number (X7/X8; employees
    are read raw, N6), is it in the field's period, funding slot; the context is read at its place (N3).
    ``_m``: the facts of the meta tags that hold a text."""
    purpose = F.create_map(*[F.lit(x) for pair in PURPOSE.items() for x in pair])
    placed = F.transform("facts", lambda f, i: F.when(f["concept"].isin(list(PURPOSE)), F.struct(
        f.alias("f"), i.alias("o"), F.try_element_at(purpose, f["concept"]).alias("of"))))

    def told(x: Column) -> Column:
        f, c = x["f"], F.get("_ctx", x["f"]["context_at"])
        value = F.when(f["kind"] == "nonFraction", bracket_negated(
            displayed_number(f["raw_text"], f["scale"], f["sign"]), f["mark_before"], f["mark_after"]))
        in_period = F.when(x["of"].isin(vocab.DURATION_FIELDS), c["in_dur"]).otherwise(c["in_inst"])
        return F.struct(x["o"].alias("o"), x["of"].alias("of"),
                        F.when(x["of"] == "employees", raw_number(f["raw_text"])).otherwise(value).alias("v"),
                        F.coalesce(in_period, F.lit(False)).alias("p"), c["slot"].alias("slot"))

    figures = F.filter(F.transform(F.filter(placed, lambda x: x.isNotNull()), told), lambda x: x["v"].isNotNull())
    texts = F.filter("facts", lambda f: f["concept"].isin(list(vocab.META_TAGS.values())) & (F.length(f["raw_text"]) > 0))
    return df.withColumns({"_f": figures, "_m": texts, "_exempt": F.exists("facts", lambda f: _exempts(f["concept"]))})


def _gathered(rows: str, made) -> Column:
    """Map from each purpose in a column of structs to what is made of its structs, in order."""
    keys = F.array_distinct(F.transform(rows, lambda x: x["of"]))
    return F.map_from_arrays(keys, F.transform(keys, lambda k: made(F.filter(rows, lambda x: x["of"] == k))))


def with_gathered(df: DataFrame) -> DataFrame:
    """``_best``: N4 per field, the maximum of struct(p in-period, a abs, o -ord, v value); ``_sum``: N9 per
    funding label and slot, the sum of every fact (exact decimal)."""
    def best(rows):
        return F.array_max(F.transform(rows, lambda x: F.struct(
            x["p"].alias("p"), F.abs(x["v"]).alias("a"), (-x["o"]).alias("o"), x["v"].alias("v"))))

    def total(rows):
        return F.aggregate(rows, F.lit(0).cast(DEC), lambda acc, x: (acc + x["v"]).cast(DEC))

    funding = F.transform(F.filter("_f", lambda x: x["of"].isin(FUNDING_LABELS) & x["slot"].isNotNull()), lambda x: F.struct(
        F.concat(x["of"], F.lit("_"), x["slot"]).alias("of"), x["v"].cast(DEC).alias("v")))
    df = df.withColumns({"_picked": F.filter("_f", lambda x: x["of"].isin(PICK_FIELDS)), "_funding": funding})
    return df.withColumns({"_best": _gathered("_picked", best), "_sum": _gathered("_funding", total)})


def _meta(tag: str) -> Column:
    """First non-blank text of a meta concept."""
    return _first(F.filter("_m", lambda f: f["concept"] == tag))["raw_text"]


def _creditors_last(slot) -> Column:
    """Creditors total per slot, last fact wins."""
    return _last(F.filter("_f", lambda x: (x["of"] == CREDITORS) & (x["slot"] == slot)))["v"]


def slot_total(within: Column, after: Column, plain: Column) -> Column:
    """Within + after if either is present, else plain."""
    return F.when(within.isNotNull() | after.isNotNull(),
                  F.coalesce(within, F.lit(0)) + F.coalesce(after, F.lit(0))).otherwise(plain)


def detect_taxonomy(refs_text: Column, standard: Column) -> Column:
    """On the space-joined references plus the tagged standard."""
    j = F.lower(F.concat(refs_text, F.lit(" "), F.coalesce(standard, F.lit(""))))
    return (F.when(j.contains("frs-105") | j.contains("frs105") | j.contains("micro"), F.lit("FRS-105"))
            .when(j.contains("frs-102") | j.contains("frs102"), F.lit("FRS-102"))
            .when(j.contains("ifrs"), F.lit("IFRS")).otherwise(F.lit("unknown")))


def taxonomy_version(refs: Column) -> Column:
    """First 20yy-mm-dd found in the references."""
    found = F.transform(refs, lambda r: F.regexp_extract(r, "(20[0-9]{2}-[0-9]{2}-[0-9]{2})", 1))
    return _first(F.filter(found, lambda x: x != ""))


def currency(units_col: Column) -> Column:
    """First unit whose measure is an ISO 4217 code."""
    u = _first(F.filter(units_col, lambda u: F.lower(u["measure"]).contains("iso4217")))
    return F.upper(F.substring_index(u["measure"], ":", -1))


PICK_FIELDS = list(vocab.FIELD_CONCEPTS)
REPORTED_FIELDS = ["turnover", "gross_profit", "operating_profit", "interest_payable", "interest_receivable",
                   "profit_before_tax", "tax", "profit_for_year", "dividends", "staff_costs", "cash", "provisions"]
#: Figures whose source is told.
SOURCED = [*REPORTED_FIELDS, "employees", "total_assets", "net_assets", "total_liabilities", "net_debt"]
FUNDING_LABELS = list(vocab.FUNDING_CONCEPTS)
PASS_THROUGH = ["filing_id", "source_file", "archive", "member", "published"]


def picks(parsed: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per filing with ``_v_<field>`` (value) and ``_in_<field>`` (is it in period), meta texts
    and funding sums, all computed in the filing's own row; columns named in ``keep`` stay."""
    df = with_gathered(with_facts(with_periods(parsed)))
    keys = {c: F.col(c) for c in (*PASS_THROUGH, *keep) if c in parsed.columns}
    keys.update({
        "company_number": _first(F.filter("contexts", lambda c: F.length(c["identifier"]) > 0))["identifier"],
        "period_end": F.col("period_end"), "period_start": F.col("period_start"),
        "_refs_text": F.concat_ws(" ", "refs"),
        "taxonomy_version": taxonomy_version(F.col("refs")),
        "currency": currency(F.col("units")),
    })
    best = {f: F.try_element_at("_best", F.lit(f)) for f in PICK_FIELDS}
    found = {f"_v_{f}": b["v"] for f, b in best.items()} | {f"_in_{f}": b["p"] for f, b in best.items()}
    found |= {f"_m_{key}": _meta(tag) for key, tag in vocab.META_TAGS.items()}
    found |= {f"_fd_{label}_{slot}": F.try_element_at("_sum", F.lit(f"{label}_{slot}"))
              for label in vocab.FUNDING_CONCEPTS for slot in ("within", "after", "plain")}
    found |= {f"_cred_{slot}": _creditors_last(slot) for slot in ("within", "after", "plain")}
    found["_exempt"] = F.col("_exempt")
    return df.select(*[c.alias(k) for k, c in keys.items()], *[c.alias(k) for k, c in found.items()])


def normalise(parsed: DataFrame, keep_internal: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """Parsed filings -> records (38 record columns + filing keys + out_of_period); columns of
    the filing that are named in ``keep`` stay."""
    df = picks(parsed.filter(F.col("parse_error").isNull()), keep)  # rejects are no records
    v = {f: F.col(f"_v_{f}") for f in PICK_FIELDS}
    inp = {f: F.col(f"_in_{f}") for f in PICK_FIELDS}

    fixed = F.coalesce(v["fixed_assets"], v["property_plant_equipment"])  # N12
    ta_sum = fixed + v["current_assets"]
    ta_der = v["talcl"] - v["net_current_assets"] + v["current_assets"]
    total_assets = F.coalesce(v["total_assets_direct"], ta_sum, ta_der)  # N13
    ta_prov = (F.when(v["total_assets_direct"].isNotNull(), F.lit("reported"))
               .when(ta_sum.isNotNull(), F.lit("summed(fixed+current)"))
               .when(ta_der.isNotNull(), F.lit("derived(talcl-nca+current)")))
    net_assets = F.coalesce(v["net_assets"], v["equity"])  # N14
    na_prov = (F.when(v["net_assets"].isNotNull(), F.lit("reported"))
               .when(v["equity"].isNotNull(), F.lit("reported(equity)")))
    cw, ca = F.col("_cred_within"), F.col("_cred_after")
    any_part = cw.isNotNull() | ca.isNotNull() | v["provisions"].isNotNull()
    parts_sum = F.coalesce(cw, F.lit(0.0)) + F.coalesce(ca, F.lit(0.0)) + F.coalesce(v["provisions"], F.lit(0.0))
    tl = (F.when(total_assets.isNotNull() & net_assets.isNotNull(), F.round(total_assets - net_assets, 2))
          .when(any_part, F.round(parts_sum, 2)))  # N15
    tl_prov = (F.when(total_assets.isNotNull() & net_assets.isNotNull(), F.lit("derived(assets-net_assets)"))
               .when(any_part, F.lit("summed(creditors+provisions)")))
    debt_totals = [slot_total(F.col(f"_fd_{lb}_within"), F.col(f"_fd_{lb}_after"), F.col(f"_fd_{lb}_plain"))
                   for lb in vocab.DEBT_LIKE]
    have_debt = F.lit(False)
    debt = F.lit(0).cast(DEC)
    for t in debt_totals:
        have_debt = have_debt | t.isNotNull()
        debt = debt + F.coalesce(t, F.lit(0).cast(DEC))
    cash = v["cash"]
    net_debt = F.when(have_debt | cash.isNotNull(),
                      F.round(debt - F.coalesce(cash, F.lit(0.0)).cast(DEC), 2).cast("double"))  # N16
    nd_prov = (F.when(have_debt, F.lit("derived(debt-cash)"))
               .when(cash.isNotNull(), F.lit("derived(net cash; no debt tagged)")))

    standard = F.col("_m_accounting_standard")
    taxonomy = detect_taxonomy(F.col("_refs_text"), standard)
    has_pl = v["turnover"].isNotNull() | v["operating_profit"].isNotNull()
    accounts_type = F.coalesce(F.col("_m_accounts_type"), F.when(taxonomy == "FRS-105", F.lit("micro"))
                               .when(has_pl, F.lit("full_or_small_with_pl"))
                               .otherwise(F.lit("small_filleted_no_pl")))  # N21
    filleted = taxonomy.isin("FRS-102", "FRS-101", "IFRS") & ~has_pl  # N22
    al = F.lower(F.col("_m_audit_status"))
    audited = F.coalesce(
        F.when(al.contains("unaudited") | al.contains("exempt"), F.lit(False)).when(al.contains("audited"), F.lit(True)),
        F.when(F.col("_exempt"), F.lit(False)))  # N23
    dormant = F.when(F.col("_m_dormant_tag").isNotNull(),
                     F.lower(F.trim(F.col("_m_dormant_tag"))).isin("true", "yes", "1"))  # N24
    pld = F.datediff(F.try_to_date(F.col("period_end"), "yyyy-MM-dd"),
                     F.try_to_date(F.col("period_start"), "yyyy-MM-dd"))  # N25

    reported = F.transform(F.array(*[inp[f] for f in REPORTED_FIELDS]), lambda p: F.when(p, F.lit("reported")).when(
        ~p, F.lit("reported(out-of-period)")))  # null where there is no figure
    sources = F.concat(reported, F.array(F.when(v["employees"].isNotNull(), F.lit("reported")), ta_prov, na_prov, tl_prov, nd_prov))
    out_of_period = F.array_except(F.array(*[F.when(v[f].isNotNull() & ~inp[f], F.lit(f)) for f in PICK_FIELDS]),
                                   F.array(F.lit(None).cast("string")))

    def funding(slot):
        fields = [F.col(f"_fd_{lb}_{slot}").cast("double").alias(lb) for lb in FUNDING_LABELS]
        return F.struct(*fields, F.col(f"_cred_{slot}").alias("creditors_total"))

    rec = {
        "company_number": F.col("company_number"),
        "taxonomy": taxonomy,
        "taxonomy_version": F.col("taxonomy_version"),
        "accounting_standard": standard,
        "currency": F.col("currency"),
        "period_start": F.col("period_start"),
        "period_end": F.col("period_end"),
        "period_length_days": pld,
        "turnover": v["turnover"], "gross_profit": v["gross_profit"],
        "total_assets": total_assets, "total_liabilities": tl, "net_assets": net_assets,
        "employees": v["employees"], "operating_profit": v["operating_profit"],
        "interest_payable": v["interest_payable"], "interest_receivable": v["interest_receivable"],
        "profit_before_tax": v["profit_before_tax"], "tax": v["tax"], "profit_for_year": v["profit_for_year"],
        "dividends": v["dividends"], "staff_costs": v["staff_costs"], "provisions": v["provisions"],
        "property_plant_equipment": v["property_plant_equipment"], "current_assets": v["current_assets"],
        "debtors": v["debtors"], "net_current_assets": v["net_current_assets"],
        "total_assets_less_current_liabilities": v["talcl"], "cash": cash, "net_debt": net_debt,
        "funding_within_one_year": funding("within"), "funding_after_one_year": funding("after"),
        "accounts_type": accounts_type, "filleted": filleted, "audited": audited, "dormant": dormant,
        "provenance": sources,  # of SOURCED; made a map below
    }
    keys = [c for c in (*PASS_THROUGH, *keep) if c in parsed.columns]
    out = df.select(*keys, *[c.alias(k) for k, c in rec.items()], out_of_period.alias("out_of_period"),
                    *([c for c in df.columns if c.startswith("_")] if keep_internal else []))
    score = sum(F.col(k).isNotNull().cast("int") for k in vocab.COMPLETENESS_FIELDS)
    told = F.filter(F.array(*[F.lit(k) for k in SOURCED]), lambda k, i: F.get("provenance", i).isNotNull())
    out = out.withColumns({"provenance": F.map_from_arrays(told, F.filter("provenance", lambda x: x.isNotNull())),  # N17
                           "completeness_score": F.round(score / F.lit(len(vocab.COMPLETENESS_FIELDS)), 2)})
    assert_no_personal_columns(out)
    return out


def assert_no_personal_columns(df: DataFrame) -> DataFrame:
    """No personal-data concept may ever be an output column."""
    bad = [c for c in df.columns if c in vocab.PERSONAL_CONCEPTS]
    if bad:
        raise ValueError(f"personal-data columns in output: {bad}")
    return df


def flatten_record(records: DataFrame) -> DataFrame:
    """Funding structs -> f_within_* / f_after_*, provenance -> JSON text,
    SIC list -> '; ' text (when present).  A flat record stays as it is."""
    cols, types = [], dict(records.dtypes)
    for c in records.columns:
        if c == "funding_within_one_year":
            cols += [F.col(f"{c}.{k}").alias(f"f_within_{k}") for k in FUNDING_LABELS + ["creditors_total"]]
        elif c == "funding_after_one_year":
            cols += [F.col(f"{c}.{k}").alias(f"f_after_{k}") for k in FUNDING_LABELS + ["creditors_total"]]
        elif c == "provenance" and types[c] != "string":
            cols.append(F.to_json("provenance").alias("provenance"))
        elif c == "sic_codes" and types[c].startswith("array"):
            cols.append(F.concat_ws("; ", "sic_codes").alias("sic_codes"))
        elif c == "out_of_period" and types[c] != "string":
            cols.append(F.concat_ws(",", "out_of_period").alias("out_of_period"))
        else:
            cols.append(F.col(c))
    return records.select(*cols)
