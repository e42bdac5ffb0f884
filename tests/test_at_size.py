"""Steps that must not grow with the table in the driver, in one task or in one Python batch."""
import pytest


def test_no_side_of_the_term_join_is_broadcast(spark, tmp_path):
    from ledgerkit.operators import entities as E
    spark.createDataFrame([("1", "ACME STEEL LIMITED"), ("2", "AB HOLDINGS PLC"), ("3", "Q"), ("4", None), ("5", "STEELYARD")],
                          "company_number string, company_name string").write.parquet(f"{tmp_path}/names")
    spark.createDataFrame([("Steel", "spv", 0, 1), ("ab", "lender", 0, 0), ("q", "spv", 1, 1), ("acme s", "spv", 2, 1), ("..", "spv", 3, 1)],
                          "term string, category string, rank int, cat_rank int").write.parquet(f"{tmp_path}/terms")
    got = E.match_terms(spark.read.parquet(f"{tmp_path}/names"), spark.read.parquet(f"{tmp_path}/terms"))
    assert {(r.company_number, r.term) for r in got.collect()} == {("1", "Steel"), ("1", "acme s"), ("2", "ab"), ("3", "q"), ("5", "Steel")}
    joins = [x for x in got._jdf.queryExecution().sparkPlan().toString().splitlines() if "BroadcastHashJoin" in x]
    assert joins and all("LeftSemi" in x for x in joins)


def test_register_files_are_read_in_several_tasks(spark, tmp_path):
    from pyspark.sql import functions as F

    from ledgerkit.operators import entities as E
    for k in range(40):
        (tmp_path / f"r{k}.json").write_text('{"%d": [{"charge_code": "C%d"}]}' % (k, k))
    charges = E.read_charges(spark, str(tmp_path)).select("company_number", "ch.charge_code", F.spark_partition_id().alias("task"))
    got = charges.collect()
    assert {(r.company_number, r.charge_code) for r in got} == {(str(k), f"C{k}") for k in range(40)}
    assert len({r.task for r in got}) > 1


def test_a_large_batch_of_filings_is_parsed_in_small_ones():
    import pyarrow as pa
    from pyspark.sql import types as T

    from fixtures import micro_filing
    from ledgerkit.operators.extract import PARSED_AT_ONCE, parse_filings

    class Filings:  # gives the function that runs in the tasks
        columns = ["filing_id", "content"]
        schema = T.StructType([T.StructField("filing_id", T.StringType()), T.StructField("content", T.BinaryType())])

        def select(self, *_):
            return self

        def mapInArrow(self, run, _):
            return run

    ids = [f"F{k}" for k in range(1000)]
    batch = pa.RecordBatch.from_arrays([pa.array(ids), pa.array([micro_filing().encode()] * 1000)], ["filing_id", "content"])
    got = list(parse_filings(Filings())(iter([batch])))
    assert [x for b in got for x in b.column("filing_id").to_pylist()] == ids
    assert max(b.num_rows for b in got) <= PARSED_AT_ONCE
    assert all(len(f) == 7 for b in got for f in b.column("facts").to_pylist())


def _orders_and_lines(spark, folder, twice):
    from datetime import date
    orders = [(k, 10 + k, "F", 1000.0 * k, date(2024, 3, k), "2-HIGH") for k in range(1, 6)]
    orders += [(None, 77, "F", 5.0, date(2024, 3, 9), "2-HIGH")] + ([(2, 40, "F", 9.0, date(2024, 4, 2), "5-LOW")] * 2 if twice else [])
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate date, "
                                  "o_orderpriority string").write.parquet(f"{folder}/orders.parquet")
    lines = [(k, 1, 2, 3, 5.0, 100.0 * k, 0.0, 0.0, "A", "F", date(2024, 5, 1)) for k in (1, 2, 3, 4)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                                 "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate date"
                          ).write.parquet(f"{folder}/lineitem.parquet")


def _scans(df, column):
    return sum("FileScan" in x and column in x for x in df._jdf.queryExecution().sparkPlan().toString().splitlines())


def test_figure_visible_writes_each_filing_once(spark, tmp_path):
    from ledgerkit.plans.queries import q_figure_visible
    _orders_and_lines(spark, tmp_path / "once", False)
    _orders_and_lines(spark, tmp_path / "twice", True)
    got = q_figure_visible(spark, str(tmp_path / "once"))
    assert sorted((r.filing_id, r.visible, r.css_leak, r.officer_redacted) for r in got.collect()) == [
        (f"F{k}", True, False, True) for k in (1, 2, 3, 4)]
    assert _scans(got, "l_orderkey") == 1
    twice = q_figure_visible(spark, str(tmp_path / "twice")).collect()
    assert sorted(r.filing_id for r in twice) == ["F1"] + ["F2"] * 9 + ["F3", "F4"] and all(r.visible for r in twice)


def test_raw_benchmark_writes_only_the_markup_of_a_round(spark, tmp_path, monkeypatch):
    from ledgerkit.plans import queries as Q
    _orders_and_lines(spark, tmp_path / "t", True)
    got = Q.filings_of(spark, str(tmp_path / "t"), spark.createDataFrame([("F2",), ("F3",), ("F9",), (None,)], "filing_id string"))
    whole = {(r.filing_id, bytes(r.content)) for r in Q.filings(spark, str(tmp_path / "t")).collect() if r.filing_id in ("F2", "F3")}
    assert sorted(r.filing_id for r in got.collect()) == ["F2"] * 3 + ["F3"]
    assert {(r.filing_id, bytes(r.content)) for r in got.collect()} == whole
    given = {}
    monkeypatch.setattr(Q, "latest_table", lambda *_: None)
    monkeypatch.setattr(Q.RB, "build_raw_benchmark", lambda latest, filings, members: given.update(filings=filings) or spark.createDataFrame(
        [], ", ".join(f"{c} string" for c in Q.RAW_OUT)))
    Q.q_raw_benchmark(spark, str(tmp_path / "t"))
    ids = spark.createDataFrame([("F3",)], "filing_id string")
    assert callable(given["filings"]) and [r.filing_id for r in given["filings"](ids).collect()] == ["F3"]


ODD_BODIES = [
    "(<ix:nonFraction name='core:A' contextRef='c' id='1'>1</ix:nonFraction>)",
    "<p>(</p> <ix:nonFraction name='core:A'><b>1</b> 2</ix:nonFraction><!-- x --><i> </i>)",
    "<p>(<b> </b></p><ix:nonFraction name='core:A'>1<ix:nonNumeric name='zz:B'>t</ix:nonNumeric></ix:nonFraction><i><u> ) </u></i>",
    "<p>x&nbsp;<ix:nonFraction name='A'>1&pound;&amp;</ix:nonFraction>&nbsp;<s/>)</p>",
    "<p title='a&nbsp;b'>&unknown;<IX:nonFraction name='core:A'>1</IX:nonFraction></p>",
    "<p>&unknown;<ix:nonFraction name='core:A'>1</ix:nonFraction></p>",
    "<p><![CDATA[<(&nbsp;]]><ix:NONFRACTION NAME='core:A' name='core:B' SCALE='3'>1</ix:NONFRACTION></p>",
    "<p><ix:nonFraction Name='CORE:A' contextref='c'/><ix:nonFraction name=''>(</ix:nonFraction><ix:nonNumeric>n</ix:nonNumeric></p>",
    "<div xmlns:core='urn:other'><ix:nonFraction name='core:A'>1</ix:nonFraction></div>",
    "<p>xmlns</p><ix:nonFraction name='core:A'>1</ix:nonFraction>",
    "<xbrli:context id='c' ID='d'><xbrli:instant> 2024-12-31 </xbrli:instant></xbrli:context>",
    "<xbrli:context id='c'><xbrli:period><xbrli:instant>2024<b>-12-31</b></xbrli:instant></xbrli:period><explicitMember dimension='a:B'>c:D</explicitMember>"
    "<xbrldi:explicitMember x='1'/></xbrli:context><xbrli:identifier>9</xbrli:identifier><xbrli:measure>m</xbrli:measure>",
    "<xbrli:context id='c'><xbrli:context id='e'/><xbrli:identifier>7</xbrli:identifier></xbrli:context>",
    "<xbrli:unit id='u'><x><xbrli:measure>a</xbrli:measure><core:measure>b</core:measure><measure>c</measure></x></xbrli:unit>",
    "<xbrli:unit id='u'><ix:nonFraction name='A'>1</ix:nonFraction></xbrli:unit>",
    "<link:schemaRef xlink:href='h'/><link:schemaRef href='i'/><link:SchemaRef xlink:HREF='j'/><link:schemaRef xlink:href=''/>",
    "<p><ix:nonFraction name='core:A'>1</ix:nonFraction><p>)",
    "<p>" * 3000 + "(<ix:nonFraction name='core:A'>1</ix:nonFraction>" + "</p>" * 3000,
]


def test_the_tree_gives_what_the_events_give():
    from fixtures import NS, full_filing
    from ledgerkit.functions import markup as M
    heads = ["", "<?xml version='1.0' encoding='utf-8'?><!-- c --> ", "<!DOCTYPE html>", "<!-- <!DOCTYPE x> -->", "\ufeff", " <?xml version='1.0'?>",
             "<!DOCTYPE html PUBLIC 'a' 'b'>", "<!DOCTYPE html [<!ENTITY unknown '('>]>", "<?xml version='1.0' standalone='yes'?>"]
    roots = [NS, NS + " xmlns:l2='http://www.w3.org/1999/xlink'", NS + " xmlns:CORE='urn:x'", NS.replace("xmlns=", "title='a>b' xmlns="),
             NS.replace('xmlns="http://www.w3.org/1999/xhtml" ', ""), NS.replace("inlineXBRL", "inlinexbrl") + " xmlns:xmlnsx='urn:y'"]
    read = 0
    for body in ODD_BODIES:
        for head in heads:
            for root in roots:
                text = f"{head}<html {root}><body>{body}</body></html>"
                want = M._from_events(text)
                for f in want["facts"]:
                    f.pop("context_at", None)
                try:
                    got = M._from_tree(text, {})
                except (M.ET.ParseError, M._Unusual, RecursionError):
                    continue
                read += 1
                assert got == want, text[:500]
    assert read > 150
    assert M._from_tree(full_filing(), {}) == M._from_events(full_filing())


def test_an_ordinary_filing_needs_no_event_in_python(monkeypatch):
    from fixtures import full_filing
    from ledgerkit.functions import markup as M
    want = M.parse_filing(full_filing())
    monkeypatch.setattr(M, "_feed", lambda *_: pytest.fail("read event by event"))
    assert M.parse_filing(full_filing()) == want and len(want["facts"]) == 20


def test_no_markup_is_shuffled_or_sorted(spark, tmp_path):
    from ledgerkit.plans.queries import filings
    _orders_and_lines(spark, tmp_path / "t", False)
    plan = filings(spark, str(tmp_path / "t"))._jdf.queryExecution().optimizedPlan().toString()
    join = plan.index("Join ")
    assert "nonFraction" in plan[:join] and "nonFraction" not in plan[join:]


def _with_meta(monkeypatch, spark, numbers):
    from ledgerkit.plans import queries as Q
    cols = ["company_number", "company_name", "company_type", "company_status", "incorporation_date", "dissolution_date",
            "accounts_category", "region_outcode", "post_town", "country"]
    meta = spark.createDataFrame([(n,) + (f"C{n}",) * (len(cols) - 1) + ([n],) for n in numbers],
                                 ", ".join(f"{c} string" for c in cols) + ", sic_codes array<string>")
    monkeypatch.setattr(Q, "meta", lambda *_: meta)
    return Q


def test_post_cutoff_writes_only_the_markup_of_a_round(spark, tmp_path, monkeypatch):
    from datetime import date
    _orders_and_lines(spark, tmp_path / "t", True)
    Q = _with_meta(monkeypatch, spark, ["00000011"])
    given, written = {}, []
    write = Q.materialise
    monkeypatch.setattr(Q, "cutoff_models", lambda *_: spark.createDataFrame([("m", date(2024, 3, 3))], "name string, released date"))
    monkeypatch.setattr(Q, "materialise", lambda df: written.append(df.columns) or write(df))
    monkeypatch.setattr(Q.RB, "build_post_cutoff", lambda recs, filings: given.update(recs=recs, filings=filings) or spark.createDataFrame(
        [], ", ".join(f"{c} string" for c in Q.RAW_OUT)))
    Q.q_post_cutoff(spark, str(tmp_path / "t"))
    assert written and not any("content" in c for c in written)
    assert sorted(r.filing_id or "" for r in given["recs"].collect()) == ["", "F2", "F2", "F4", "F5"]
    ids = spark.createDataFrame([("F1",), ("F2",), ("F4",)], "filing_id string")
    assert sorted((r.filing_id, r.published.month) for r in given["filings"](ids).collect()) == [("F2", 4), ("F2", 4), ("F4", 3)]
