"""Archive index pages as tables (S12-S14) and archive choice.

The index text is a column, so one page or millions of pages are the same job:
``regexp_extract_all`` + explode, then a grouped pick per archive name.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ---- fixed values: archive name patterns and month names --------------------------------
SIZED = "(?i)(Accounts_Bulk_Data-(\\d{4}-\\d{2}-\\d{2})\\.zip)\\s*\\(([\\d.]+)\\s*MiB\\)"
NAMED = "(?i)(Accounts_Bulk_Data-(\\d{4}-\\d{2}-\\d{2})\\.zip)"
COMPANY = "(?i)(BasicCompanyDataAsOneFile-(\\d{4}-\\d{2}-\\d{2})\\.zip)"
MONTHLY = "(?i)(Accounts_Monthly_Data-([A-Za-z]+)(\\d{4})\\.zip)"
MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september",
          "october", "november", "december"]


def _occurrences(pages: DataFrame, text: str, order: str, pattern: str, groups: dict) -> DataFrame:
    cols = {k: F.regexp_extract_all(F.col(text), F.lit(pattern), g) for k, g in groups.items()}
    z = F.arrays_zip(*[v.alias(k) for k, v in cols.items()])
    return pages.select(F.col(order).alias("_page"), F.posexplode(z).alias("_pos", "m")).select(
        "_page", "_pos", *[F.col(f"m.{k}").alias(k) for k in groups])


def archive_catalog(pages: DataFrame, text: str = "html", order: str = "page_id") -> DataFrame:
    """(name, date, size_mb) per archive; a sized mention wins (the last one in
    page order), unsized mentions only fill gaps; oldest first."""
    sized = _occurrences(pages, text, order, SIZED, {"name": 1, "date": 2, "size": 3})
    named = _occurrences(pages, text, order, NAMED, {"name": 1, "date": 2})
    s = sized.groupBy("name").agg(F.first("date").alias("date"),
                                  F.max_by(F.col("size").cast("double"), F.struct("_page", "_pos")).alias("size_mb"))
    n = named.groupBy("name").agg(F.first("date").alias("date"))
    return (s.unionByName(n.join(s.select("name"), "name", "left_anti")
                          .withColumn("size_mb", F.lit(None).cast("double")))  # J13 fill_missing
            .orderBy("date"))


def company_catalog(pages: DataFrame, text: str = "html", order: str = "page_id") -> DataFrame:
    """Company snapshot archives, oldest first."""
    n = _occurrences(pages, text, order, COMPANY, {"name": 1, "date": 2})
    return n.groupBy("name").agg(F.first("date").alias("date")).orderBy("date")


def monthly_catalog(pages: DataFrame, text: str = "html", order: str = "page_id") -> DataFrame:
    """Month name + year -> numeric sort key (unknown month -> 0)."""
    n = _occurrences(pages, text, order, MONTHLY, {"name": 1, "month_name": 2, "year": 3})
    months = F.create_map(*[x for i, m in enumerate(MONTHS, 1) for x in (F.lit(m), F.lit(i))])
    return (n.groupBy("name").agg(F.first("month_name").alias("month_name"), F.first("year").alias("y"))
            .select("name", F.col("y").cast("int").alias("year"),
                    F.coalesce(F.element_at(months, F.lower("month_name")), F.lit(0)).alias("month"))
            .orderBy("year", "month"))


def trailing_months(monthly: DataFrame, n: int = 12) -> DataFrame:
    """The newest n monthly archives."""
    return monthly.orderBy(F.desc("year"), F.desc("month")).limit(n)


def smallest_recent(catalog: DataFrame, recent: int = 15) -> DataFrame:
    """Among the newest ``recent`` archives, the smallest sized one (unsized only
    when none has a size)."""
    pool = catalog.orderBy(F.desc("date")).limit(recent)
    return pool.orderBy(F.col("size_mb").asc_nulls_last(), F.col("date")).limit(1)
