"""Readers for the small input documents (S6, S7, S10, S11), all with declared schemas."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

META_T = T.StructType([T.StructField(n, T.StringType()) for n in
                       ("company_number", "field", "published", "source_zip")])
ITEM_T = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("category", T.StringType()),
    T.StructField("answer_type", T.StringType()), T.StructField("question", T.StringType()),
    T.StructField("answer_num", T.DoubleType()), T.StructField("answer_text", T.StringType()),
    T.StructField("answer_bool", T.BooleanType()), T.StructField("rel_tol", T.DoubleType()),
    T.StructField("abs_tol", T.DoubleType()), T.StructField("meta", META_T),
])
RESULT_T = T.StructType([
    T.StructField("summary", T.StructType([
        T.StructField("provider", T.StringType()), T.StructField("model", T.StringType()),
        T.StructField("n", T.LongType()), T.StructField("scored", T.LongType()),
        T.StructField("overall_accuracy", T.DoubleType()),
        T.StructField("by_category", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("errors", T.LongType()), T.StructField("seconds", T.DoubleType())])),
    T.StructField("detail", T.ArrayType(T.StructType([
        T.StructField("id", T.StringType()), T.StructField("category", T.StringType()),
        T.StructField("field", T.StringType()), T.StructField("correct", T.BooleanType()),
        T.StructField("errored", T.BooleanType()), T.StructField("truth", T.StringType()),
        T.StructField("model_answer", T.StringType())]))),
])
CUTOFFS_T = T.StructType([
    T.StructField("threshold_date", T.StringType()),
    T.StructField("models", T.ArrayType(T.StructType([
        T.StructField("name", T.StringType()), T.StructField("provider", T.StringType()),
        T.StructField("released", T.StringType()), T.StructField("source", T.StringType())]))),
])


def read_items(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """One JSON item per line (declared schema; ``limit`` is the evaluate-first-N option)."""
    df = spark.read.schema(ITEM_T).json(path)
    return df.orderBy("id").limit(limit) if limit else df


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """Result documents (summary + detail array) -> one row per detail entry."""
    r = spark.read.schema(RESULT_T).option("multiLine", True).json(path)
    return r.select("summary.provider", "summary.model", F.explode("detail").alias("d")).select(
        "provider", "model", "d.*")


def read_targets(spark: SparkSession, path: str) -> DataFrame:
    """The curated entity list (CSV with header)."""
    return spark.read.option("header", True).csv(path)


def read_cutoffs(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Model release list + stated threshold, and the agreement check
    (stated threshold == max(released) + 1 day)."""
    c = spark.read.schema(CUTOFFS_T).option("multiLine", True).json(path)
    models = c.select(F.explode("models").alias("m")).select(
        "m.name", "m.provider", F.to_date("m.released").alias("released"), "m.source")
    stated = c.select(F.to_date("threshold_date").alias("stated"), F.lit(1).alias("_k"))
    computed = models.agg(F.date_add(F.max("released"), 1).alias("computed")).withColumn("_k", F.lit(1))
    check = stated.join(computed, "_k").select("stated", "computed", (F.col("stated") == F.col("computed")).alias("agrees"))
    return models, check
