"""Every registered query over the smallest tables: against its SQL, or for its shape."""

import pytest

from tickharbor.llm.queries import ORACLES, QUERIES
from tools.compare import connect, table

SMALL = "/root/testdata/sf0.001"
# The table that a query gives one row for each row of.
OF = {"op1_chunks": "documents", "op2_languages": "documents", "op3_personal_data": "documents", "op4_main_text": "pages",
      "op7_token_files": "documents", "op9_minhash": "documents", "op10_repeats": "documents", "op11_near_vectors": "embeddings"}
FIRST_COLUMNS = {
    "op1_chunks": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    "op2_languages": ["doc_id", "held_out", "lang_pred", "score"],
    "op3_personal_data": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op4_main_text": ["page_id", "url", "text", "n_chars"],
    "op7_token_files": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op8_packing": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    "op9_minhash": ["doc_id", "n_shingles", "component_id", "kept"],
    "op10_repeats": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op11_near_vectors": ["vec_id", "n_links", "component_id", "kept"],
    "op12_hard_negatives": ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"],
    "op13_divergence": ["lang", "source", "part", "item", "value", "rank"],
}


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, name):
    df = QUERIES[name](spark, SMALL)
    assert df.columns == FIRST_COLUMNS.get(name, df.columns)
    rows = df.collect()
    if name in OF:
        assert len(rows) == spark.read.parquet(f"{SMALL}/{OF[name]}.parquet").count()
    if name in ORACLES:
        expected = connect(SMALL).sql(ORACLES[name])
        assert table(df.columns, rows) == table(expected.columns, expected.fetchall())
