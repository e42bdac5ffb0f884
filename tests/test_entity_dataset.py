import json
import os
import tempfile

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

CHARGE = {"charge_code": "C1", "charge_number": 1, "status": "outstanding", "created_on": "2020-01-01",
          "particulars": {"description": 'all "plant" } ] [ { \\\\', "contains_fixed_charge": True},
          "persons_entitled": [{"name": "Jane Doe"}, {"name": "HSBC BANK PLC"}]}


def _plain(register):
    return [(c, x) for c, xs in register.items() if isinstance(xs, list) for x in xs if isinstance(x, dict)]


def _read(data, size):
    from ledgerkit.operators.entities import charge_texts
    pieces = [data[i:i + size] for i in range(0, len(data), size)]
    return [(c, json.loads(t)) for c, t in charge_texts("f", iter(pieces))]


_ANY = st.recursive(st.none() | st.booleans() | st.integers() | st.text(), lambda x: st.lists(x, max_size=3) | st.dictionaries(st.text(), x, max_size=3), max_leaves=8)


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.text(), _ANY | st.lists(st.dictionaries(st.text(), _ANY, max_size=3), max_size=4), max_size=4), st.integers(1, 40), st.booleans())
def test_charges_whatever_the_pieces(register, size, ascii_):
    data = json.dumps(register, ensure_ascii=ascii_).encode("utf-8", "surrogatepass")
    assert _read(data, size) == _plain(json.loads(data.decode("utf-8", "surrogatepass")))


def test_cut_files_are_named():
    whole = json.dumps({"1": [CHARGE, CHARGE]}).encode()
    for cut in (len(whole) - 1, len(whole) // 2, 8):
        with pytest.raises(ValueError, match="ends within"):
            _read(whole[:cut], 64)


def test_reader_of_one_long_line_holds_a_piece(spark):
    import tracemalloc

    from ledgerkit.operators.entities import charge_texts
    one = json.dumps(CHARGE).encode()

    def pieces(n):
        yield b'{"1": ['
        for k in range(n):
            yield (b"," if k else b"") + one
        yield b"]}"
    tracemalloc.start()
    assert sum(1 for _ in charge_texts("f", pieces(20000))) == 20000
    assert tracemalloc.get_traced_memory()[1] < 1_000_000
    tracemalloc.stop()


def test_entity_dataset_files_are_read_back(spark):
    from ledgerkit.operators import entities as E
    from ledgerkit.plans.entity_dataset import build_entity_dataset
    from ledgerkit.sources.inputs import read_targets
    d = tempfile.mkdtemp(prefix="lk-ent-")
    register = {"00000001": [CHARGE, dict(CHARGE, charge_code="C2", status="satisfied", persons_entitled=[])], "00000009": [CHARGE], "00000002": []}
    os.mkdir(f"{d}/register")
    for n, part in enumerate((register, {"00000003": [dict(CHARGE, charge_code="C3")]})):
        with open(f"{d}/register/charges{n}.json", "w") as f:
            json.dump(part, f, indent=n or None)
    columns = ["company_number", "company_name", "company_status", "company_type", "date_of_creation", "category",
               "refined_entity_type", "asset_class_guess", "strict_non_bank_lender_scope"]
    with open(f"{d}/targets.csv", "w") as f:
        f.write(",".join(columns) + "\n")
        for k, kind in ((1, "spv"), (2, "lender"), (3, "spv")):
            f.write(f"0000000{k},ACME FUNDING 202{k}-1 PLC,active,plc,2020-01-01,{kind},x,auto,true\n")
    charges = E.read_charges(spark, f"{d}/register", piece_bytes=50)
    assert charges.count() == 4 and charges.where("ch is null").isEmpty()
    targets = read_targets(spark, f"{d}/targets.csv")
    made = build_entity_dataset(targets, charges, f"{d}/out", "1", sources=["register"], licence="open")
    back = lambda p: spark.read.option("header", True).option("escape", "\\").csv(p)
    entities = {r.company_number: (r.charges_total, r.charges_outstanding, r.shelf) for r in back(made["entities"]).collect()}
    assert entities == {"00000001": ("2", "1", "ACME FUNDING"), "00000002": ("0", "0", None), "00000003": ("1", "1", "ACME FUNDING")}
    rows = {r.charge_code: (r.company_number, r.persons_entitled, r.persons_entitled_has_individual, r.particulars) for r in back(made["charges"]).collect()}
    names = "[individual redacted]; HSBC BANK PLC"
    text = CHARGE["particulars"]["description"]
    assert rows == {"C1": ("00000001", names, "true", text), "C2": ("00000001", None, "false", text), "C3": ("00000003", names, "true", text)}
    told, = spark.read.json(made["manifest"]).collect()
    assert (told.entities, told.charges, told.with_charges, told.spvs, told.lenders, told.outstanding, told.with_individuals) == (3, 3, 2, 2, 1, 2, 2)
    assert (told.version, told.sources, told.licence) == ("1", ["register"], "open")
    with pytest.raises(ValueError, match="duplicate company_number"):
        build_entity_dataset(targets.union(targets), charges, f"{d}/again", "1")
