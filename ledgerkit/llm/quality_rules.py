"""Operator 10, quality rules: hashed n-gram log-likelihood ratio of a trusted target over the raw corpus.

Two multinomials over ``BUCKETS`` hash buckets of lower-cased word unigrams and bigrams are
counted: one over all trusted texts, one over all raw documents.  A document's score is the mean
over its n-grams of log(trusted share / raw share); it is kept if the score reaches ``MIN_SCORE``
and it passes the base rules.  Every document is judged by the same threshold; nothing is sampled.

Only DataFrame functions.  Counting is one map-side combined aggregation of at most BUCKETS
groups; the ratios are one array, a scalar subquery; scoring stays in the document's own row and
shuffles nothing.  A repeated window is found by sorting the row's window hashes, and only where
there are fewer distinct hashes than windows.

Defined results: null and empty texts have no words, fail the base rules and have score null;
rows that repeat are judged alike; an empty table gives no rows, an empty trusted table gives
every document the score of the smoothed flat target; columns of the documents are kept, the operator's
own win over equal names.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD, read, text_of

BUCKETS = 1 << 14
#: Added to every bucket's count, in hundredths of the mean count of a bucket.
SMOOTH_PERCENT = 10
MIN_SCORE = -0.25
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20
WINDOW = 5


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value`` evaluated once, also where a lambda inside reads it many times."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeated_words(words: Column, width: int = WINDOW) -> Column:
    """Words that lie in a window of ``width`` words found twice or more among the windows."""
    def covered(windows: Column) -> Column:
        placed = F.sort_array(F.transform(windows, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))

        def twice(s: Column) -> Column:
            again = F.filter(s, lambda e, j: F.coalesce((F.get(s, j - 1)["x"] == e["x"]) | (j < 0), F.lit(False))
                             | F.coalesce(F.get(s, j + 1)["x"] == e["x"], F.lit(False)))
            return F.sort_array(F.transform(again, lambda e: e["i"]))

        def total(at: Column) -> Column:
            own = F.transform(at, lambda p, j: F.coalesce(F.least(F.lit(width), F.get(at, j + 1) - p), F.lit(width)))
            return F.aggregate(own, F.lit(0), lambda a, b: a + b)

        return let(let(placed, twice), total)

    def counted(h: Column) -> Column:
        windows = F.transform(F.sequence(F.lit(0), F.size(h) - width), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(width)]))
        return F.when(F.size(h) < width, 0).otherwise(
            let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), 0).otherwise(covered(w))))

    return let(F.transform(words, lambda w: F.xxhash64(w)), counted).cast("long")


def repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def base_rules(docs: DataFrame) -> DataFrame:
    """``docs`` plus n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed and _words."""
    text = text_of()
    rows = docs.withColumn("_words", F.regexp_extract_all(text, F.lit(WORD), F.lit(0)))
    rows = rows.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": (F.char_length(text) - F.regexp_count(text, F.lit(r"[\x20\x09-\x0D]"))).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long"),
        "n_dup_lines": repeated_lines(text),
        "n_repeat_words": repeated_words(F.col("_words"))})
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    return rows.withColumn("base_failed", failed)


def gram_buckets(words: Column, buckets: int = BUCKETS) -> Column:
    """Buckets of the unigrams and bigrams of lower-cased words."""
    def both(h: Column) -> Column:
        pairs = F.transform(h, lambda x, i: F.xxhash64(x, F.get(h, i + 1)))
        return F.concat(h, F.slice(pairs, 1, F.greatest(F.size(h) - 1, F.lit(0))))

    hashes = let(F.transform(words, lambda w: F.xxhash64(F.lower(w))), both)
    return F.transform(hashes, lambda x: F.pmod(x, F.lit(buckets)).cast("int"))


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) over all texts."""
    words = F.regexp_extract_all(text_of(), F.lit(WORD), F.lit(0))
    return texts.select(F.explode(gram_buckets(words, buckets)).alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n"))


def log_ratios(raw: DataFrame, trusted: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """One row: the array of log(trusted share / raw share) by bucket, smoothed."""
    counts = (bucket_counts(raw, buckets).select("bucket", F.col("n").alias("raw"), F.lit(0).alias("good"))
              .union(bucket_counts(trusted, buckets).select("bucket", F.lit(0), "n"))
              .union(raw.sparkSession.range(buckets).select(F.col("id").cast("int"), F.lit(0), F.lit(0)))
              .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("good").alias("good")))
    table = counts.agg(F.sort_array(F.collect_list(F.struct("bucket", "raw", "good"))).alias("rows"),
                       F.sum("raw").alias("all_raw"), F.sum("good").alias("all_good"))

    def share(n: Column, total: str) -> Column:
        total = F.greatest(F.col(total), F.lit(1)).cast("double")
        more = total * SMOOTH_PERCENT / (100 * buckets)
        return (n + more) / (total + more * buckets)

    return table.select(F.transform("rows", lambda r: F.log(share(r["good"], "all_good")) - F.log(share(r["raw"], "all_raw"))).alias("ratios"))


def judged(docs: DataFrame, raw: DataFrame, trusted: DataFrame, min_score: float = MIN_SCORE, buckets: int = BUCKETS) -> DataFrame:
    """``docs`` plus the base counts, score and kept."""
    rows = base_rules(docs).withColumn("_ratios", log_ratios(raw, trusted, buckets).scalar())

    def mean(grams: Column) -> Column:
        return let(F.col("_ratios"), lambda r: F.aggregate(grams, F.lit(0.0), lambda a, b: a + F.get(r, b))) / F.size(grams)

    score = let(gram_buckets(F.col("_words"), buckets), lambda g: F.when(F.size(g) > 0, mean(g)))
    rows = rows.withColumn("score", score)
    kept = ~F.col("base_failed") & F.coalesce(F.col("score") >= min_score, F.lit(False))
    return rows.withColumn("kept", kept).drop("_words", "_ratios")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    trusted = read(spark, sf_dir, "conversations").select("text")
    return judged(docs, docs, trusted).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")
