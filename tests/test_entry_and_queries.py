from paths import SF


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.count() > 0
    assert "provenance" in df.columns


def test_every_query_has_an_oracle_or_is_rows_only(spark):
    from __spark_entry__ import oracle_sql, queries
    from ledgerkit.plans.catalog import ORACLE_SQL, QUERIES
    assert set(oracle_sql()) <= set(queries())
    assert set(QUERIES) <= set(queries())
    assert set(QUERIES) - set(ORACLE_SQL) == {"render_redacted"}


def test_sampling_is_deterministic(spark):
    from __spark_entry__ import queries
    a = [tuple(r) for r in queries()["sample_n"](spark, SF).collect()]
    b = [tuple(r) for r in queries()["sample_n"](spark, SF).collect()]
    assert sorted(a) == sorted(b) and len(a) == 100


def test_normalise_plans_one_exchange_after_parse(spark):
    from ledgerkit.plans.queries import records
    plan = records(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
