"""Every registered query of the subpackage has SQL, or a test against brute
force (or held-out accuracy) that is named here and exists."""

import importlib.util
import os

import __spark_entry__ as entry
import corpus_pipeline
from legwise.llm.queries import ORACLE_SQL, QUERIES

HERE = os.path.dirname(__file__)
BRUTE_FORCE = {
    "op2_language_id": ("test_llm", "test_language_held_out_and_rejects"),
    "op3_bpe": ("test_codecs_and_pages", "test_word_bpe_equals_library"),
    "op4_ngram_join": ("test_more_operators", "test_join_of_a_table_equals_brute_force"),
    "op5_token_counts": ("test_edits", "test_a_table_of_edits_equals_counting_anew"),
    "op6_packing": ("test_codecs_and_pages", "test_packing_pieces_equal_library"),
    "op7_html_text": ("test_more_operators", "test_pages_by_hand"),
    "op8_license_scan": ("test_llm", "test_license_places_equal_brute_force"),
    "op9_vector_links": ("test_more_operators", "test_vector_links_equal_brute_force"),
    "op11_quality": ("test_new_operators", "test_quality_held_out_accuracy"),
    "op12_spelling_variants": ("test_new_operators", "test_variants_of_a_table_equal_brute_force"),
    "op13_whitening": ("test_new_operators", "test_whitening_of_a_table"),
    "pipeline": ("test_more_operators", "test_pipeline_equals_brute_force"),
}


def test_every_query_has_sql_or_brute_force():
    names = {*QUERIES, "pipeline"}
    assert names <= set(entry.queries())
    assert names == set(ORACLE_SQL) | set(BRUTE_FORCE) and not set(ORACLE_SQL) & set(BRUTE_FORCE)
    assert corpus_pipeline.ORACLE_SQL is None


def test_the_named_tests_exist():
    for query, (module, test) in BRUTE_FORCE.items():
        spec = importlib.util.spec_from_file_location(f"named_{module}", os.path.join(HERE, module + ".py"))
        loaded = importlib.util.module_from_spec(spec)
        spec.loader.exec_module(loaded)
        assert hasattr(loaded, test), (query, module, test)
