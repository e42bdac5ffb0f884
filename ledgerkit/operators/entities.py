"""Entities and charges.

Term matching (J7, "normalised term contained in normalised name") is one
equi-join at every size: a term of three or more characters shares its first
trigram with any name that contains it, so a join on trigrams followed by the
``contains`` check loses nothing; shorter terms are joined on every 1- and
2-character substring of the name.  Substrings that no term begins with go before
the join, and both sides of it are shuffled: the planner sizes the substrings of all
names by the file of names, so left to itself it may send them through the driver.
AQE splits the partitions of frequent trigrams.
"""
from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numbers import normalise_number
from ..sources.archives import open_file
from ..vocab import CORP_TOKENS, SHELF_PATTERNS


def norm_text(s) -> Column:
    """Lower, anything but [a-z0-9 ] -> space, whitespace collapsed, trimmed."""
    s = F.col(s) if isinstance(s, str) else s
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(s), "[^a-z0-9 ]", " "), "\\s+", " "))


def read_terms(spark, path: str, category: str) -> DataFrame:
    """One term per line; blank and ``#`` lines dropped; file order kept as rank."""
    t = spark.read.text(path).select(F.trim("value").alias("term"), F.monotonically_increasing_id().alias("rank"))
    return t.filter((F.col("term") != "") & ~F.col("term").startswith("#")).withColumn("category", F.lit(category))


def match_terms(companies: DataFrame, terms: DataFrame, name_col: str = "company_name") -> DataFrame:
    """(company row, term) pairs where the normalised term occurs in the normalised name.

    ``terms`` needs (term, category, cat_rank, rank).  Empty normalised terms match
    nothing (they would match every name)."""
    c = companies.withColumn("_name_n", norm_text(name_col))
    t = terms.withColumn("_term_n", norm_text("term")).filter(F.length("_term_n") > 0)
    long_ = t.filter(F.length("_term_n") >= 3).withColumn("_g", F.substring("_term_n", 1, 3))
    grams = c.withColumn("_g", F.explode(F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.greatest(F.length("_name_n") - 2, F.lit(1))),
        lambda i: F.substring("_name_n", i, 3)))))
    hit_long = _joined(grams, long_).filter(F.col("_name_n").contains(F.col("_term_n"))).drop("_g")
    # Terms of one or two characters: equi-join on every 1- and 2-character substring.
    short = t.filter(F.length("_term_n") < 3).withColumn("_g", F.col("_term_n"))
    n = F.length("_name_n")
    subs = F.array_distinct(F.concat(
        F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.substring("_name_n", i, 1)),
        F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.substring("_name_n", i, 2))))
    hit_short = _joined(c.withColumn("_g", F.explode(subs)), short).drop("_g")
    return hit_long.unionByName(hit_short)


def _joined(grams: DataFrame, terms: DataFrame) -> DataFrame:
    """``grams`` with the ``terms`` of the same ``_g``.  A ``_g`` has at most three characters out of
    37, so the set of those in use is bounded (51,000) and may be broadcast; the rows of neither side are."""
    used = F.broadcast(terms.select("_g").distinct())
    return grams.join(used, "_g", "left_semi").hint("merge").join(terms, "_g")


def find_entities(companies: DataFrame, terms: DataFrame) -> DataFrame:
    """Candidates with the first matching category (W2) and the sorted set of
    matched terms (A6); sorted by category then name (W11)."""
    m = match_terms(companies, terms)
    first = F.min(F.struct("cat_rank", "rank", "category"))["category"]
    keep = [c for c in companies.columns if c != "company_number"]
    return (m.groupBy("company_number")
            .agg(*[F.first(c).alias(c) for c in keep], first.alias("category"),
                 F.concat_ws("; ", F.array_sort(F.collect_set("term"))).alias("matched_terms"))
            .orderBy("category", "company_name"))


def term_hit_counts(companies: DataFrame, terms: DataFrame) -> DataFrame:
    """Per term, name-matched companies (and PLCs among them)."""
    m = match_terms(companies, terms)
    return m.groupBy("category", "term").agg(
        F.count(F.lit(1)).alias("name_matched"),
        F.count_if(F.lower(F.col("company_type")) == "plc").alias("plc_matched"))


def candidate_counts(candidates: DataFrame) -> DataFrame:
    """Candidates by category, and PLCs."""
    return candidates.groupBy("category").agg(
        F.count(F.lit(1)).alias("candidates"),
        F.count_if(F.lower(F.col("company_type")) == "plc").alias("plcs"))


def shelf_of(name) -> Column:
    """Issuer shelf name: company-form words, year-series and NO. n removed."""
    n = F.upper(F.coalesce(F.col(name) if isinstance(name, str) else name, F.lit("")))
    for pattern in SHELF_PATTERNS:
        n = F.regexp_replace(n, pattern, "")
    n = F.regexp_replace(n, "\\s+", " ")
    return F.btrim(n, F.lit(" -"))


def redact_persons(persons) -> tuple[Column, Column]:
    """Names with a corporate token kept, others replaced; (text, had_individual)."""
    names = F.filter(F.transform(persons, lambda p: F.trim(p["name"])), lambda x: F.coalesce(F.length(x), F.lit(0)) > 0)
    corp = lambda x: F.exists(F.array(*[F.lit(t) for t in CORP_TOKENS]),
                              lambda tok: F.instr(F.upper(x), tok) > 0)
    shown = F.transform(names, lambda x: F.when(corp(x), x).otherwise(F.lit("[individual redacted]")))
    return F.concat_ws("; ", shown), F.exists(names, lambda x: ~corp(x))


CHARGE_T = T.StructType([
    T.StructField("charge_code", T.StringType()), T.StructField("charge_number", T.LongType()),
    T.StructField("status", T.StringType()), T.StructField("created_on", T.StringType()),
    T.StructField("delivered_on", T.StringType()), T.StructField("satisfied_on", T.StringType()),
    T.StructField("classification", T.StructType([T.StructField("description", T.StringType())])),
    T.StructField("secured_details", T.StructType([T.StructField("description", T.StringType())])),
    T.StructField("particulars", T.StructType([
        T.StructField("description", T.StringType()), T.StructField("contains_fixed_charge", T.BooleanType()),
        T.StructField("contains_floating_charge", T.BooleanType()),
        T.StructField("contains_negative_pledge", T.BooleanType())])),
    T.StructField("persons_entitled", T.ArrayType(T.StructType([T.StructField("name", T.StringType())]))),
])
#: Bytes that a task holds of a register file at a time.
PIECE_BYTES = 4_000_000


def read_charges(spark, path: str, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """JSON documents {company_number: [charge, ...]} -> one row per charge (company_number, ch).

    A file is read a piece at a time in the task that has it, whether it is one line or many, and
    each charge leaves as a row of its own, so neither a file nor a company is ever a cell.  Spark
    parses the charges.  What is no object in a company's list is left out, a charge that Spark cannot
    parse is a null ``ch``, and a file whose brackets do not close ends the job with its name.  Of a
    company named twice all charges are kept.  One file is one task: register exports of many files
    spread over the cluster."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for one in b.column("path").to_pylist():
                with open_file(one) as f:
                    yield from charge_batches(one, iter(lambda: f.read(piece_bytes), b""))

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))  # a count: paths are few bytes, and AQE would read all files in one task
    raw = files.repartition(n, "path").mapInArrow(run, "company_number string, charge string")
    return raw.select("company_number", F.from_json("charge", CHARGE_T).alias("ch"))


def charge_batches(name: str, pieces: Iterator[bytes]) -> Iterator[pa.RecordBatch]:
    rows, size = [], 0
    for row in charge_texts(name, pieces):
        rows.append(row)
        size += len(row[1])
        if size >= PIECE_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], ["company_number", "charge"])
            rows, size = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], ["company_number", "charge"])


#: What changes the place in a JSON text: strings as a whole and brackets.
_TOKEN = re.compile(rb'"[^"\\]*(?:\\.[^"\\]*)*"|[\[\]{}]', re.S)


def charge_texts(name: str, pieces: Iterator[bytes]) -> Iterator[tuple[str, str]]:
    """(company number, JSON of one charge) of a file's pieces; holds one charge and one piece."""
    buf, at, start, depth, company, listed = b"", 0, None, 0, None, False
    for piece in pieces:
        buf = buf[at if start is None else start:] + piece
        at, start = (0, None) if start is None else (at - start, 0)
        while m := _TOKEN.search(buf, at):
            quote = buf.find(b'"', at, m.start())
            if quote >= 0:  # a string that this piece leaves open
                at = quote
                break
            at, c = m.end(), m[0]
            if c in b"{[":
                if depth == 1:
                    listed = c == b"["
                elif depth == 2 and listed and c == b"{" and company is not None:
                    start = m.start()
                depth += 1
            elif c in b"}]":
                depth -= 1
                if depth == 2 and start is not None:
                    yield company, buf[start:at].decode("utf-8", "replace")
                    start = None
            elif depth == 1:
                company = json.loads(c)
    if depth or b'"' in buf[at:]:
        raise ValueError(f"{name}: the file ends within an object")


def charge_rows(charges: DataFrame, targets: DataFrame) -> DataFrame:
    """One annotated row per charge of a target entity."""
    j = charges.join(targets, "company_number")
    persons, has_ind = redact_persons(F.col("ch.persons_entitled"))
    return j.select(
        "company_number", "company_name", "category", F.col("asset_class_guess").alias("asset_class"),
        shelf_of("company_name").alias("shelf"),
        "ch.charge_code", "ch.charge_number", "ch.status", "ch.created_on", "ch.delivered_on", "ch.satisfied_on",
        F.col("ch.classification.description").alias("classification"),
        F.col("ch.secured_details.description").alias("secured_details"),
        F.col("ch.particulars.description").alias("particulars"),
        F.col("ch.particulars.contains_fixed_charge").alias("contains_fixed_charge"),
        F.col("ch.particulars.contains_floating_charge").alias("contains_floating_charge"),
        F.col("ch.particulars.contains_negative_pledge").alias("contains_negative_pledge"),
        persons.alias("persons_entitled"), has_ind.alias("persons_entitled_has_individual"))


def charge_summary(charges: DataFrame) -> DataFrame:
    """A5: total and outstanding charges per company."""
    return charges.groupBy("company_number").agg(
        F.count(F.lit(1)).alias("charges_total"),
        F.count_if(F.col("ch.status") == "outstanding").alias("charges_outstanding"))


def entity_rows(targets: DataFrame, charges: DataFrame) -> DataFrame:
    """Targets with their charge summary; shelf only for SPVs; no charges -> 0."""
    s = charge_summary(charges)
    return targets.join(s, "company_number", "left").select(
        "company_number", "company_name", "company_status", "company_type", "date_of_creation", "category",
        "refined_entity_type", "asset_class_guess", "strict_non_bank_lender_scope",
        F.when(F.col("category") == "spv", shelf_of("company_name")).otherwise(F.lit("")).alias("shelf"),
        F.coalesce("charges_total", F.lit(0)).alias("charges_total"),
        F.coalesce("charges_outstanding", F.lit(0)).alias("charges_outstanding"))


def targets_in_dataset(targets: DataFrame, records: DataFrame) -> DataFrame:
    """Targets that appear in the filing dataset (left semi) with counts."""
    number = normalise_number(F.col("company_number")).alias("_number")
    hit = targets.withColumn("_number", number).join(records.select(number), "_number", "left_semi")
    a = hit.agg(F.count(F.lit(1)).alias("in_dataset")).withColumn("_k", F.lit(1))
    b = targets.agg(F.count(F.lit(1)).alias("targets")).withColumn("_k", F.lit(1))
    return a.join(b, "_k").drop("_k")


def rank_terms(terms: DataFrame) -> DataFrame:
    """File order within each list (rank), lenders before SPVs (cat_rank)."""
    w = Window.partitionBy("category").orderBy("rank")
    return terms.withColumn("rank", F.row_number().over(w)).withColumn(
        "cat_rank", F.when(F.col("category") == "lender", F.lit(0)).otherwise(F.lit(1)))


def entity_financials(entities: DataFrame, latest: DataFrame,
                      fields=("period_end", "net_assets", "total_assets", "total_liabilities")) -> DataFrame:
    """J15 (optional extra): entities with their latest filed figures, where any exist."""
    return entities.join(latest.select("company_number", *fields), "company_number", "left")
