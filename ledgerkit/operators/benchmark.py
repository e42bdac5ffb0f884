"""Question-and-answer items derived from the latest record per company.

Item tables are bounded by the quotas (at most a few thousand rows), so the
global numbering in ``benchmark_table`` is safe; pools are always sampled
with a top-k, never sorted whole.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab
from ..functions.numbers import debt_to_equity, money
from .sampling import groups_of_draws, sample_n, shuffle_and_number

ITEM_COLUMNS = ["category", "answer_type", "question", "answer_num", "answer_text", "answer_bool",
                "rel_tol", "abs_tol", "company_number", "field"]


def present(c) -> Column:
    """not null and not NaN."""
    c = F.col(c) if isinstance(c, str) else c
    return c.isNotNull() & ~F.isnan(c)


def display_name() -> Column:
    """E5: name, else ``company <number>``."""
    return F.coalesce(F.col("company_name"), F.concat(F.lit("company "), F.col("company_number")))


def whole(c) -> Column:
    """Employees as a whole number (half to even, as the reference rounds)."""
    return F.bround(F.col(c), 0).cast("bigint")


def make_extract(df: DataFrame) -> Column:
    """Header, one labelled line per present figure, then the basis line."""
    head = F.concat(display_name(), F.lit(" - accounts to "), F.col("period_end"), F.lit(" (amounts in "),
                    F.coalesce(F.col("currency"), F.lit("GBP")), F.lit(")"))
    lines = []
    for col, label in vocab.EXTRACT_ROWS:
        if col not in df.columns:
            continue
        shown = whole(col).cast("string") if col == "employees" else money(col)
        lines.append(F.when(present(col), F.concat(F.lit(f"  {label}: "), shown)))
    basis = F.concat_ws("; ", "accounts_type", "taxonomy")
    lines.append(F.when(basis != "", F.concat(F.lit("  Basis of preparation: "), basis)))
    return F.concat_ws("\n", head, *lines)


def _item(category, answer_type, question, num=None, text=None, boolean=None, rel=None, ab=None, field=None):
    return [F.lit(category).alias("category"), F.lit(answer_type).alias("answer_type"),
            question.alias("question"),
            (num if num is not None else F.lit(None)).cast("double").alias("answer_num"),
            (text if text is not None else F.lit(None)).cast("string").alias("answer_text"),
            (boolean if boolean is not None else F.lit(None)).cast("boolean").alias("answer_bool"),
            F.lit(rel).cast("double").alias("rel_tol"), F.lit(ab).cast("double").alias("abs_tol"),
            F.col("company_number"), F.lit(field).cast("string").alias("field")]


def named(df: DataFrame) -> DataFrame:
    return df.filter(F.col("company_name").isNotNull())


def items_extraction(latest: DataFrame, quotas=None, seed=vocab.CLEAN_SEED) -> DataFrame:
    """B1: read one figure from the extract; quotas per field."""
    quotas = quotas or vocab.CLEAN_EXTRACTION_QUOTAS
    out = None
    for field, n in quotas.items():
        pool = sample_n(named(latest).filter(present(field)), n, seed, F.col("company_number"), salt=field)
        unit = "a whole number" if field == "employees" else "an amount in pounds"
        q = F.concat(F.lit("Extract from the accounts of a UK company:\n\n"), make_extract(latest),
                     F.lit(f"\n\nQuestion: what is the company's {vocab.FIELD_LABELS[field]} for this period? "
                           f"Reply with {unit}."))
        ans = whole(field).cast("double") if field == "employees" else F.col(field)
        part = pool.select(*_item("extraction", "numeric", q, num=ans,
                                  rel=0.0 if field == "employees" else 0.005, ab=1.0, field=field))
        out = part if out is None else out.unionByName(part)
    return out


def items_not_disclosed(latest: DataFrame, n=vocab.CLEAN_NOT_DISCLOSED, seed=vocab.CLEAN_SEED) -> DataFrame:
    """Turnover asked where it is absent."""
    pool = named(latest).filter(~present("turnover") & present("net_assets"))
    pool = sample_n(pool, n, seed, F.col("company_number"), salt="not_disclosed")
    q = F.concat(F.lit("Extract from the accounts of a UK company:\n\n"), make_extract(latest),
                 F.lit("\n\nQuestion: what is the company's turnover for this period? "
                       "If these accounts do not show it, say so."))
    return pool.select(*_item("not_disclosed", "not_disclosed", q, text=F.lit("NOT_DISCLOSED")))


def items_comparison(latest: DataFrame, draws=vocab.CLEAN_COMPARISON_DRAWS, seed=vocab.CLEAN_SEED) -> DataFrame:
    """Which of five companies has the highest net assets (W10 + E16)."""
    pool = named(latest).filter(present("net_assets"))
    g = groups_of_draws(pool.select("company_number", "company_name", "net_assets"), "company_number",
                        draws, 5, seed)
    line = F.concat(F.lit("  - "), display_name(), F.lit(": net assets "), money("net_assets"))
    agg = g.groupBy("draw").agg(
        F.array_sort(F.collect_list(F.struct("pos", line.alias("line")))).alias("lines"),
        F.max(F.struct(F.col("net_assets").alias("v"), (-F.col("pos")).alias("p"),
                       display_name().alias("name"), F.col("company_number").alias("cn"))).alias("w"))
    q = F.concat(F.lit("Net assets of five UK companies:\n"),
                 F.concat_ws("\n", F.transform("lines", lambda x: x["line"])),
                 F.lit("\n\nQuestion: which company has the highest net assets? Reply with its name."))
    return agg.select(
        F.lit("comparison").alias("category"), F.lit("choice").alias("answer_type"), q.alias("question"),
        F.lit(None).cast("double").alias("answer_num"), F.col("w.name").alias("answer_text"),
        F.lit(None).cast("boolean").alias("answer_bool"), F.lit(None).cast("double").alias("rel_tol"),
        F.lit(None).cast("double").alias("abs_tol"), F.col("w.cn").alias("company_number"),
        F.lit(None).cast("string").alias("field"))


def items_ratio(latest: DataFrame, n=vocab.CLEAN_RATIO, seed=vocab.CLEAN_SEED) -> DataFrame:
    """Debt-to-equity to two places."""
    pool = named(latest).filter(present("total_liabilities") & present("net_assets")
                                & (F.col("net_assets") > 0) & (F.col("total_liabilities") > 0))
    pool = sample_n(pool, n, seed, F.col("company_number"), salt="ratio")
    q = F.concat(display_name(), F.lit(" reports total liabilities of "), money("total_liabilities"),
                 F.lit(" and net assets (equity) of "), money("net_assets"),
                 F.lit(".\nQuestion: what is its debt-to-equity ratio (total liabilities / equity), "
                       "to two decimal places?"))
    return pool.select(*_item("ratio", "numeric", q, num=debt_to_equity(F.col("total_liabilities"),
                                                                         F.col("net_assets")), rel=0.02, ab=0.05))


def items_boolean(latest: DataFrame, each=vocab.CLEAN_BOOLEAN_EACH, seed=vocab.CLEAN_SEED) -> DataFrame:
    """Balance-sheet insolvent?  ``each`` insolvent + ``each`` solvent."""
    base = named(latest).filter(present("net_assets"))
    neg = sample_n(base.filter(F.col("net_assets") < 0), each, seed, F.col("company_number"), salt="insolvent")
    pos = sample_n(base.filter(F.col("net_assets") > 0), each, seed, F.col("company_number"), salt="solvent")
    q = F.concat(display_name(), F.lit(" reports net assets of "), money("net_assets"),
                 F.lit(" at its period end.\nQuestion: are its net assets negative (balance-sheet "
                       "insolvent)? Reply yes or no."))
    return neg.unionByName(pos).select(*_item("boolean", "boolean", q, boolean=F.col("net_assets") < 0))


def benchmark_table(latest: DataFrame, seed=vocab.CLEAN_SEED, prefix: str = "q") -> DataFrame:
    """All categories, shuffled and numbered."""
    parts = [items_extraction(latest, seed=seed), items_not_disclosed(latest, seed=seed),
             items_comparison(latest, seed=seed), items_ratio(latest, seed=seed), items_boolean(latest, seed=seed)]
    allv = parts[0]
    for p in parts[1:]:
        allv = allv.unionByName(p)
    key = F.concat_ws("|", "category", F.coalesce("field", F.lit("")), "company_number", F.md5("question"))
    return shuffle_and_number(allv, prefix, seed, key).select("id", *ITEM_COLUMNS)


def items_by_category(items: DataFrame) -> DataFrame:
    """A10."""
    return items.groupBy("category").agg(F.count(F.lit(1)).alias("n"))
