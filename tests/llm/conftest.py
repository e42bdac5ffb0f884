import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use for columns of their own.
CLASHES = ("score", "predicted", "n_tokens", "epoch", "domain", "hits", "found", "entities", "_row", "shard", "size", "version", "virtual_slot", "kept")


def plain(i, n=40):
    return " ".join(f"w{(i * 7919 + k * 104729) % 99991}" for k in range(n))


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty and very long texts, repeated rows and ids, clashing columns."""
    rows = [(1, plain(1), "en", "src1", 10), (1, plain(1), "en", "src1", 10), (2, None, "de", "src2", None),
            (3, "", None, "src7", 0), (None, plain(4), "en", None, 5), (None, None, None, None, None), (5, plain(5), "fr", "other", 7),
            (6, " \t\n", "es", "src19", 3), (7, plain(7, 200_000), "en", "src1", 9), (8, "one two", "en", "src1", 7),
            (9, "one two", "en", "src1", 7), (10, plain(1), "en", "src3", 10), (11, "é" * 3000, "fr", "src4", 3000)]
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, DOCUMENTS)
    return df.withColumns({c: F.lit(f"own {c}") for c in CLASHES})


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture(scope="session")
def empty_sf(spark, tmp_path_factory):
    """A data folder whose tables have no rows."""
    d = str(tmp_path_factory.mktemp("empty"))
    for name, schema in {"documents": DOCUMENTS, "labels": "doc_id long, quality long, toxic long", "benchmark": "item_id long, text string",
                         "conversations": "conv_id long, turn long, role string, text string", "embeddings": "vec_id long, embedding array<float>, label int"}.items():
        spark.createDataFrame([], schema).write.parquet(f"{d}/{name}.parquet")
    return d
