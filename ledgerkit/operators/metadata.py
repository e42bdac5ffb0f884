"""Company metadata without personal data."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import normalise_number, outward_postcode
from ..vocab import METADATA_KEEP, SIC_COLUMNS


def _q(name: str):
    return F.col(f"`{name}`")


def read_company_csv(spark, path: str) -> DataFrame:
    """Header names trimmed; malformed UTF-8 is replaced, never fatal."""
    df = (spark.read.option("header", True).option("encoding", "UTF-8").option("mode", "PERMISSIVE")
          .csv(path))
    return df.toDF(*[c.strip() for c in df.columns])


def company_rows(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """Company-register-shaped rows derived from the customer tables (test mapping):
    CompanyNumber = c_custkey, name, segment as category, status from balance sign,
    SIC codes from nation, postcode / town / country from nation and region.
    The address line is present (as in the register) but never selected downstream."""
    c = customer.join(nation, customer.c_nationkey == nation.n_nationkey).join(
        region, nation.n_regionkey == region.r_regionkey)
    return c.select(
        F.col("c_custkey").cast("string").alias("CompanyNumber"),
        F.col("c_name").alias("CompanyName"),
        F.col("c_mktsegment").alias("CompanyCategory"),
        F.when(F.col("c_acctbal") < 0, F.lit("Liquidation")).otherwise(F.lit("Active")).alias("CompanyStatus"),
        F.lit("").alias("IncorporationDate"),
        F.lit(None).cast("string").alias("DissolutionDate"),
        F.when(F.col("c_custkey") % 3 == 0, F.lit("MICRO ENTITY")).when(F.col("c_custkey") % 3 == 1,
                                                                        F.lit("SMALL")).otherwise(F.lit(""))
        .alias("Accounts.AccountCategory"),
        F.format_string("%05d - Activity %d", F.col("n_nationkey") + 64000, F.col("n_nationkey")).alias(
            "SICCode.SicText_1"),
        F.when(F.col("c_custkey") % 2 == 0, F.format_string("%05d - Activity %d", F.col("n_regionkey") + 70000,
                                                            F.col("n_regionkey"))).alias("SICCode.SicText_2"),
        F.lit("").alias("SICCode.SicText_3"),
        F.lit(None).cast("string").alias("SICCode.SicText_4"),
        F.format_string("N%d %dAB", F.col("n_nationkey"), F.col("c_custkey") % 10).alias("RegAddress.PostCode"),
        F.col("n_name").alias("RegAddress.PostTown"),
        F.col("r_name").alias("RegAddress.Country"),
        F.format_string("%d High Street", F.col("c_custkey")).alias("RegAddress.AddressLine1"),
    )


def metadata_projection(companies: DataFrame) -> DataFrame:
    """non-personal fields only; blanks -> null; SIC list; outward postcode."""
    blank = lambda c: F.nullif(c, F.lit(""))
    sic = F.filter(F.array(*[blank(_q(c)) for c in SIC_COLUMNS]), lambda x: x.isNotNull())
    return companies.select(
        normalise_number(_q("CompanyNumber")).alias("company_number"),
        *[blank(_q(src)).alias(out) for out, src in METADATA_KEEP.items()],
        sic.alias("sic_codes"),
        outward_postcode(_q("RegAddress.PostCode")).alias("region_outcode"),
        _q("RegAddress.PostTown").alias("post_town"),
        _q("RegAddress.Country").alias("country"),
    )


def join_metadata(records: DataFrame, meta: DataFrame) -> DataFrame:
    """Left equi join on the normalised company number (E1 on both sides).
    A null or blank number stays null and matches nothing.  The strategy is left to AQE:
    the register is millions of rows, so no hint."""
    r = records.withColumn("company_number", F.nullif(normalise_number(F.col("company_number")), F.lit("")))
    return r.join(meta, "company_number", "left")


def wanted_companies(meta: DataFrame, records: DataFrame) -> DataFrame:
    """Register rows that have at least one filing (left semi)."""
    keys = records.select(normalise_number(F.col("company_number")).alias("company_number"))
    return meta.join(keys, "company_number", "left_semi")


def match_rate(joined: DataFrame) -> DataFrame:
    """V3: share of filings with metadata."""
    return joined.agg(F.count(F.lit(1)).alias("filings"),
                      F.count("company_name").alias("matched"),
                      F.round(F.avg(F.col("company_name").isNotNull().cast("double")), 4).alias("match_rate"))


def key_format_probe(a: DataFrame, a_col: str, b: DataFrame, b_col: str) -> DataFrame:
    """V4: do two tables' keys share a format? digits -> 9, count per shape and side."""
    def shape(df, col, side):
        return (df.select(F.regexp_replace(F.col(col).cast("string"), "[0-9]", "9").alias("shape"))
                .groupBy("shape").agg(F.count(F.lit(1)).alias("n")).withColumn("side", F.lit(side)))
    return shape(a, a_col, "left").unionByName(shape(b, b_col, "right"))


def assert_unique_keys(df: DataFrame, key: str) -> None:
    """J1 guard: the register side must have one row per company number."""
    dup = df.groupBy(key).count().filter("count > 1").limit(1).count()
    if dup:
        raise ValueError(f"duplicate {key} values on the metadata side")
