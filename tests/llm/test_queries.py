"""Every registered query of this subpackage on small tables: its contract's columns, and its SQL where it has one."""

import importlib.util
from pathlib import Path

import pytest

import corpus_pipeline
from blotter.llm.queries import ORACLES, QUERIES

_spec = importlib.util.spec_from_file_location(
    "check_oracle", Path(__file__).resolve().parents[2] / "scripts" / "check_oracle.py")
_chk = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(_chk)

COLUMNS = {
    "op1": ["doc_id", "keep_id", "group_size", "kept", "text_sha256"],
    "op2": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
    "op3": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op4": ["doc_id", "n_shingles", "component_id"],
    "op5": ["doc_id", "held_out", "score", "predicted"],
    "op6": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    "op7": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op8": ["doc_id", "n_words", "n_removed", "kept_sha256"],
    "op9": ["doc_id", "held_out", "score", "predicted"],
    "op10": ["doc_id"],
    "op12": ["query_id", "rank", "vec_id", "score"],
    "op13": ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"],
    "op11": ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
}


def test_one_query_an_operator():
    assert sorted(n.split("_")[0] for n in QUERIES) == sorted(COLUMNS)
    assert len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    want = COLUMNS[name.split("_")[0]]
    assert set(want) <= set(df.columns)
    types = dict(df.dtypes)
    assert types.get("score", "double") == "double" and types.get("predicted", "int") == "int"
    if name not in ORACLES:
        least = "vec_id % 50 = 0" if name.startswith("op12") else "true"
        source = "embeddings" if name.startswith("op12") else "documents"
        assert df.count() >= spark.read.parquet(f"{sf_dir}/{source}.parquet").filter(least).count()
        return
    got, exact = df.toPandas(), _chk.duck(sf_dir).sql(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(exact.columns) and _chk.norm(got, True) == _chk.norm(exact, True)
