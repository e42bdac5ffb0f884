"""The correctness gate in miniature: Spark queries vs their DuckDB oracle at sf0.001."""
import os
import sys

import pytest

from paths import ROOT, SF

sys.path.insert(0, os.path.join(ROOT, "tools"))

KEYS = ["records", "extract_facts_roundtrip", "pick_values", "funding_breakdown", "latest_per_company",
        "benchmark_table", "grade_choice", "match_terms", "archive_catalog", "post_cutoff"]


@pytest.fixture(scope="module")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in ("region nation customer supplier part orders lineitem events documents embeddings pages "
              "benchmark labels conversations").split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    from compare import digest
    from __spark_entry__ import oracle_sql, queries
    df = queries()[key](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(oracle_sql()[key])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(df.columns, srows)[0] == digest(dcols, drows)[0]


def test_normalise_stays_in_the_row_after_the_parse(spark):
    from ledgerkit.plans.queries import records
    plan = records(spark, SF)._jdf.queryExecution().executedPlan().toString()
    above_parse = plan.split("MapInArrow")[0]
    assert plan.count("MapInArrow") == 1
    for node in ("Exchange", "Generate", "Aggregate", "Sort", "Join"):
        assert f"{node} " not in above_parse and f"{node}(" not in above_parse, node
