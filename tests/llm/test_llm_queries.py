"""Every query of the operators runs over its whole table; those with SQL give its rows."""

import pytest
from compare import difference

from strataframe.llm.queries import CHECKS, QUERIES

COLUMNS = {
    "op1": ["page_id", "url", "text", "n_chars"], "op2": ["doc_id", "held_out", "lang_pred", "score"],
    "op3": ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
    "op4": ["doc_id", "size", "source_size", "target", "taken"], "op5": ["doc_id", "n_shingles", "component_id"],
    "op6": ["query_id", "rank", "vec_id", "score"], "op7": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"], "op8": ["doc_id", "is_secret"],
    "op9": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op10": ["doc_id", "n_words", "n_removed", "kept_sha256"],
    "op11": ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"],
    "op12": ["query_id", "rank", "vec_id", "score"], "op13": ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"],
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, oracle, name):
    if name.startswith("op8"):  # the smallest table holds no candidate
        sf_dir = "/root/testdata/sf0.01"
    df = QUERIES[name](spark, sf_dir)
    assert set(COLUMNS[name.split("_")[0]]) <= set(df.columns)
    if name in CHECKS:
        assert difference(df, oracle, CHECKS[name]) is None
    elif name.startswith(("op2", "op3", "op4", "op7", "op9")):
        assert df.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    else:
        assert df.count() > 0
