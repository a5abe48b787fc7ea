"""Every query of the subpackage: against its SQL where there is some, else its rows and columns."""

from pathlib import Path

import pytest

from check import connect, differences
from millrace.llm.queries import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="needs the test tables")

COLUMNS = {
    "op1_token_shards": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    "op2_quality_rules": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, base_failed boolean, kept boolean",
    "op4_pii": "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string",
    "op6_bpe": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op8_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op9_quality_classifier": "doc_id bigint, held_out boolean, score double, predicted int",
    "op13_periodic_runs": "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, "
    "exponent_milli bigint, runs_sha256 string, collapsed_sha256 string",
}


def test_one_query_per_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(QUERIES) == set(ORACLE) | set(COLUMNS)


@pytest.mark.parametrize("key", ORACLE)
def test_agrees_with_sql(spark, key):
    assert differences(spark, connect(SF_DIR), key, SF_DIR) is None


@pytest.mark.parametrize("key", COLUMNS)
def test_returns_every_document(spark, key):
    result = QUERIES[key](spark, SF_DIR)
    kinds = [f"{name} {kind}" for name, kind in result.dtypes]
    wanted = COLUMNS[key].split(", ")
    assert kinds[: len(wanted)] == wanted
    ids = [row[0] for row in result.select("doc_id").collect()]
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert sorted(ids) == sorted(row[0] for row in documents.select("doc_id").collect())
