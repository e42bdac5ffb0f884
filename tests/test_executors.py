from far import rows_from_afar


def test_executors_need_no_copy_of_the_package(tmp_path):
    assert rows_from_afar(tmp_path, ["register_charges", "records", "render_filings"]) == {"register_charges": 650, "records": 1500, "render_filings": 1500}
