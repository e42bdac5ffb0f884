"""Fact extraction (X1-X11): filings -> parsed filings -> facts / contexts / units / refs.

``parse_filings`` is the one Python pass over the markup: an Arrow-batched
``mapInArrow`` that keeps every input column but ``content`` and adds the raw
lists in document order (one row per filing, so nothing is shuffled).  All
interpretation (numbers, brackets, periods, prefixes) is native Spark on the
exploded tables below.
"""
from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.markup import parse_filing
from ..functions.numbers import bracket_negated, displayed_number

#: Filings of a session's Arrow batch that are parsed at a time: a parsed filing is some hundred Python objects.
PARSED_AT_ONCE = 64

DIM_T = T.StructType([T.StructField("dim", T.StringType()), T.StructField("member", T.StringType())])
CONTEXT_T = T.StructType([
    T.StructField("context_id", T.StringType()), T.StructField("identifier", T.StringType()),
    T.StructField("start_date", T.StringType()), T.StructField("end_date", T.StringType()),
    T.StructField("instant", T.StringType()), T.StructField("dimensions", T.ArrayType(DIM_T)),
])
UNIT_T = T.StructType([T.StructField("unit_id", T.StringType()), T.StructField("measure", T.StringType())])
FACT_T = T.StructType([T.StructField(n, T.StringType()) for n in (
    "kind", "concept", "namespace", "raw_text", "scale", "sign", "context_ref", "unit_ref",
    "mark_before", "mark_after")] + [T.StructField("context_at", T.IntegerType())])

PARSED_FIELDS = [
    T.StructField("parse_error", T.StringType()),
    T.StructField("refs", T.ArrayType(T.StringType())),
    T.StructField("contexts", T.ArrayType(CONTEXT_T)),
    T.StructField("units", T.ArrayType(UNIT_T)),
    T.StructField("facts", T.ArrayType(FACT_T)),
]


def _arrow_type(dt):
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(dt)


def parse_filings(filings: DataFrame) -> DataFrame:
    """X1-X6 + X11: one row per filing with the raw refs, contexts, units and facts.

    A filing that cannot be read, is null or has no element gets ``parse_error`` set (the
    ``rejects`` table) instead of being dropped silently; ``normalise`` leaves it out."""
    keep = [c for c in filings.columns if c != "content"]
    schema = T.StructType([filings.schema[c] for c in keep] + PARSED_FIELDS)
    types = {f.name: _arrow_type(f.dataType) for f in PARSED_FIELDS}

    def run(batches):
        kinds = {}  # of the task's tags
        for b in (whole.slice(at, PARSED_AT_ONCE) for whole in batches for at in range(0, whole.num_rows, PARSED_AT_ONCE)):
            cols = {n: [] for n in types}
            for raw in b.column("content").to_pylist():
                try:
                    text = raw.decode("utf-8", errors="replace") if isinstance(raw, bytes) else (raw or "")
                    p = parse_filing(text, kinds)
                    cols["parse_error"].append(None)
                except Exception as e:  # a bad filing becomes a reject row
                    p = {"refs": [], "contexts": [], "units": [], "facts": []}
                    cols["parse_error"].append(f"{type(e).__name__}: {e}")
                for k in ("refs", "contexts", "units", "facts"):
                    cols[k].append(p[k])
            arrays = [b.column(c) for c in keep] + [pa.array(cols[n], type=types[n]) for n in types]
            yield pa.RecordBatch.from_arrays(arrays, names=keep + list(types))

    return filings.select(*keep, "content").mapInArrow(run, schema)


def rejects(parsed: DataFrame) -> DataFrame:
    """X11: filings that failed to parse, with the reason."""
    return parsed.filter(F.col("parse_error").isNotNull()).select("filing_id", "parse_error")


def taxonomy_refs(parsed: DataFrame) -> DataFrame:
    """(filing_id, ord, href) in document order."""
    return parsed.select("filing_id", F.posexplode("refs").alias("ord", "href"))


def units(parsed: DataFrame) -> DataFrame:
    """(filing_id, ord, unit_id, measure)."""
    return parsed.select("filing_id", F.posexplode("units").alias("ord", "u")).select(
        "filing_id", "ord", "u.unit_id", "u.measure")


def period_type(instant, start, end):
    """Instant if present, else duration if a start or end, else unknown."""
    return (F.when(instant.isNotNull(), F.lit("instant"))
            .when(start.isNotNull() | end.isNotNull(), F.lit("duration"))
            .otherwise(F.lit("unknown")))


def _blank(c):
    return F.nullif(c, F.lit(""))


def contexts(parsed: DataFrame) -> DataFrame:
    """Contexts with typed period and prefix-free dimensions."""
    c = parsed.select("filing_id", F.posexplode("contexts").alias("ord", "c"))
    inst, st, en = _blank(F.col("c.instant")), _blank(F.col("c.start_date")), _blank(F.col("c.end_date"))
    pt = period_type(inst, st, en)
    return c.select(
        "filing_id", "ord", F.col("c.context_id").alias("context_id"),
        F.col("c.identifier").alias("identifier"),
        pt.alias("period_type"),
        F.when(pt == "duration", st).alias("period_start"),
        F.coalesce(inst, en).alias("period_end"),
        F.col("c.dimensions").alias("dimensions"))


def fact_value(kind, raw_text, scale, sign, mark_before, mark_after):
    """X7 + X8 for one fact: only ``nonFraction`` facts carry a number."""
    v = bracket_negated(displayed_number(raw_text, scale, sign), mark_before, mark_after)
    return F.when(kind == "nonFraction", v)


def facts(parsed: DataFrame) -> DataFrame:
    """X1 + X7 + X8 + X10: one row per tagged fact, value parsed natively."""
    f = parsed.select("filing_id", F.posexplode("facts").alias("ord", "f"))
    return f.select(
        "filing_id", "ord", "f.kind", "f.concept", "f.namespace",
        fact_value(F.col("f.kind"), F.col("f.raw_text"), F.col("f.scale"), F.col("f.sign"),
                   F.col("f.mark_before"), F.col("f.mark_after")).alias("value"),
        "f.raw_text", "f.scale", "f.sign", "f.context_ref", "f.unit_ref")


def filing_company_number(parsed: DataFrame) -> DataFrame:
    """First non-empty context identifier in document order."""
    first = F.try_element_at(F.filter("contexts", lambda c: F.length(c["identifier"]) > 0), F.lit(1))
    return parsed.select("filing_id", first["identifier"].alias("company_number"))


def split_concept(name):
    """``prefix:local`` -> local name."""
    return F.substring_index(name, ":", -1)


def facts_with_context(facts_df: DataFrame, contexts_df: DataFrame) -> DataFrame:
    """N3 / J3 on the exploded tables: each fact with its context (left equi join on
    the composite key; the last context of a duplicated id wins)."""
    last = (contexts_df.groupBy("filing_id", "context_id")
            .agg(F.max_by(F.struct("period_type", "period_start", "period_end", "dimensions"), "ord").alias("ctx")))
    return (facts_df.join(last.withColumnRenamed("context_id", "context_ref"), ["filing_id", "context_ref"], "left")
            .select(facts_df["*"], "ctx.period_type", "ctx.period_start", "ctx.period_end", "ctx.dimensions"))
