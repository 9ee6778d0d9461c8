from __future__ import annotations

import duckdb
import pytest

from ledgerloom.llm.queries import ORACLE_SQL, QUERIES

COLUMNS = {
    "op1_embedding_dedup": ["vec_id", "n_links", "component_id", "kept"],
    "op2_language_id": ["doc_id", "held_out", "lang_pred", "score", "rejected"],
    "op3_line_dedup": ["doc_id", "text", "n_lines", "n_dropped"],
    "op4_html_text": ["page_id", "url", "text", "n_chars"],
    "op5_warc": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
    "op6_exact_dedup": ["doc_id", "text_sha256", "keep_id", "group_size", "kept"],
    "op7_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op8_wavelet_shards": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op9_simhash": ["doc_id", "fingerprint", "component_id"],
    "op10_packing": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    "op11_importance": ["doc_id", "n_features", "weight", "score", "rank"],
    "op12_url_filter": ["page_id", "host", "path", "rule", "verdict"],
    "op13_alignment": ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
}
TABLES = ("documents", "pages", "embeddings")


def test_names():
    assert list(QUERIES) == list(COLUMNS)
    assert set(ORACLE_SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", list(COLUMNS))
def test_query_covers_its_table_and_equals_its_sql(spark, folder, name):
    df = QUERIES[name](spark, folder)
    assert df.columns == COLUMNS[name]
    got = [tuple(r) for r in df.collect()]
    table = "embeddings" if name.startswith("op1_") else "pages" if name[:4] in ("op4_", "op5_", "op12") else "documents"
    ids = [r[0] for r in spark.read.parquet(f"{folder}/{table}.parquet").select(COLUMNS[name][0]).collect()]
    assert (sorted(set(r[0] for r in got)) if name == "op10_packing" else sorted(r[0] for r in got)) == sorted(ids)
    if name in ORACLE_SQL:
        con = duckdb.connect()
        for t in TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
        result = con.execute(ORACLE_SQL[name])
        order = [[c[0] for c in result.description].index(c) for c in df.columns]
        assert sorted((tuple(r[i] for i in order) for r in result.fetchall()), key=repr) == sorted(got, key=repr)
