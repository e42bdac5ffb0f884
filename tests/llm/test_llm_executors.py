from far import rows_from_afar


def test_operators_need_no_copy_of_the_package_on_executors(tmp_path):
    names = ["op4_pii_surrogates", "op5_near_duplicates", "op6_toxicity", "op8_decontamination", "op9_secret_scan",
             "op11_embedding_dedup", "op12_prefix_trie", "op13_vector_codes"]
    got = rows_from_afar(tmp_path, names)
    assert set(got) == set(names) and all(got.values())
