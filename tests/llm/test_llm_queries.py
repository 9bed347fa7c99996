"""Registered queries: against their SQL, and the columns that others rely on."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import compare  # noqa: E402

from __spark_entry__ import queries  # noqa: E402
from tripmarts.llm.oracles import ORACLES  # noqa: E402
from tripmarts.llm.queries import REGISTRY  # noqa: E402

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
COLUMNS = {
    "op2_wrapper_main_text": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
    "op3_quality_rules": {
        "doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint",
        "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean",
    },
    "op4_best_fit_packing": {"doc_id": "bigint", "bin_id": "bigint", "bin_offset": "bigint"},
    "op5_wavelet_tokens": {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"},
    "op6_simhash_near_duplicates": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op7_toxicity_bigru": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op8_pfair_mixing": {"doc_id": "bigint", "mix_slot": "bigint", "mix_position": "bigint"},
}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    assert compare.assert_same(REGISTRY[name](spark, FOLDER), compare.connect(FOLDER), ORACLES[name]) > 0


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, name):
    df = REGISTRY[name](spark, FOLDER)
    kinds = dict(df.dtypes)
    assert {column: kinds[column] for column in COLUMNS[name]} == COLUMNS[name]
    table = "pages" if name.startswith("op2_") else "documents"
    rows = spark.read.parquet(f"{FOLDER}/{table}.parquet").count()
    assert df.count() == rows or name.startswith("op4_") and df.count() > rows


def test_all_are_registered():
    assert {int(name[2:].split("_")[0]) for name in REGISTRY} == set(range(1, 14))
    assert {*REGISTRY, "pipeline"} <= set(queries())
