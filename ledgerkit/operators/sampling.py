"""Dedupe, deterministic sampling and numbering.

Sampling is by ``md5(seed:key)``: deterministic, independent of partitioning,
identical in Spark and DuckDB, and evaluated as a top-k (bounded memory per
task) rather than a full sort.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hash_key(seed, *parts) -> Column:
    cols = [F.lit(str(seed))]
    for p in parts:
        cols += [F.lit(":"), p if isinstance(p, Column) else F.lit(str(p))]
    return F.md5(F.concat(*cols))


def sample_n(df: DataFrame, n: int, seed, key: Column, salt: str | None = None) -> DataFrame:
    """Exactly min(n, |df|) rows without replacement (top-n by hash)."""
    h = hash_key(seed, *([salt] if salt else []), key)
    return df.withColumn("_h", h).orderBy("_h").limit(n).drop("_h")


def sample_per_group(df: DataFrame, group: str, n: int, seed, key: Column) -> DataFrame:
    """N rows per group by hash order.  Planned as a WindowGroupLimit, which also
    runs before the shuffle, so a hot group is cut to n rows per task map-side."""
    w = Window.partitionBy(group).orderBy(hash_key(seed, key))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def shuffle_and_number(df: DataFrame, prefix: str, seed, key: Column, width: int = 4) -> DataFrame:
    """Shuffle by hash, then number ``<prefix>0001...``.  A global ordering is
    used only on bounded item tables (quota-sized, thousands of rows)."""
    w = Window.orderBy(hash_key(seed, key))
    return df.withColumn("id", F.format_string(f"{prefix}%0{width}d", F.row_number().over(w)))


def latest_per_company(records: DataFrame, key: str = "company_number") -> DataFrame:
    """Newest period_end per company (no date, or no ISO date, last; ties to the smaller
    source file, then filing id).  ``row_number() = 1`` is planned as a WindowGroupLimit that
    also runs before the shuffle: a task passes on one row per company, so a company holding a
    third of all filings cannot overload one.  Rows without a key are left out."""
    days = F.datediff(F.try_to_date(F.col("period_end"), "yyyy-MM-dd"), F.lit("1970-01-01"))
    w = Window.partitionBy(key).orderBy(F.desc_nulls_last(days), "source_file", "filing_id")
    best = records.filter(F.col(key).isNotNull()).withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
    return best.select(key, *[c for c in records.columns if c != key])


def trailing(df: DataFrame, order_col: str, n: int) -> DataFrame:
    """The newest n rows."""
    return df.orderBy(F.desc(order_col)).limit(n)


def indexed(df: DataFrame, key: str, seed) -> DataFrame:
    """Rows numbered 0, 1, ... in hash order (``idx``) without sorting them in one task: counts of
    4,096 hash ranges give each range's first number, a row's rank in its range the rest."""
    k = F.coalesce(F.col(key).cast("string"), F.lit(""))
    rows = df.withColumn("_h", hash_key(seed, "pool", k)).withColumn("_range", F.substring("_h", 1, 3))
    upto = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    first = (rows.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
             .select("_range", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_first")))
    rank = F.row_number().over(Window.partitionBy("_range").orderBy("_h", k))
    return (rows.withColumn("_rank", rank).join(first, "_range")
            .withColumn("idx", (F.col("_first") + F.col("_rank") - 1).cast("bigint")).drop("_h", "_range", "_rank", "_first"))


def groups_of_draws(pool: DataFrame, key: str, draws: int, size: int, seed) -> DataFrame:
    """``draws`` groups of ``size`` distinct rows (all rows where there are fewer); groups may
    overlap, every row is as likely as any other.

    Each draw picks its row numbers by hash: for the last ``size`` numbers in turn a number up
    to it, or itself where that has been picked before, so ``size`` distinct ones come out
    without a second try.  The picks are joined to the numbered pool; nothing else of the pool moves."""
    n = pool.agg(F.count(F.lit(1)).alias("n")).scalar()
    picks = pool.sparkSession.range(draws).select(F.col("id").alias("draw"), n.alias("n"))

    def pick(done: Column, j: Column) -> Column:
        last = F.col("n") - size + j
        h = hash_key(seed, "draw", F.col("draw").cast("string"), j.cast("string"))
        one = F.conv(F.substring(h, 1, 15), 16, 10).cast("bigint") % (last + 1)
        return F.when(last < 0, done).otherwise(F.concat(done, F.array(F.when(F.array_contains(done, one), last).otherwise(one))))

    chosen = F.aggregate(F.sequence(F.lit(0), F.lit(size - 1)), F.array().cast("array<bigint>"), pick)
    picks = picks.select("draw", F.posexplode(chosen).alias("pos", "idx")).withColumn("pos", F.col("pos") + 1)
    return indexed(pool, key, seed).join(picks, "idx").drop("idx")


def winner_of(groups: DataFrame, value: str, label: str) -> DataFrame:
    """Per draw, the label of the largest value; ties go to the first listed."""
    return groups.groupBy("draw").agg(
        F.max(F.struct(F.col(value).alias("v"), (-F.col("pos")).alias("p"), F.col(label).alias("l")))["l"]
        .alias("winner"),
        F.count(F.lit(1)).alias("members"))


def cap_per_group(df: DataFrame, group: str, n: int, order: str) -> DataFrame:
    """At most n rows per group (e.g. filings per archive in a trial build)."""
    w = Window.partitionBy(group).orderBy(order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")
