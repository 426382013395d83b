"""Every query of the subpackage through its registered name, over awkward and over empty tables."""

import hashlib
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lodestack.llm import registry

SF = "/root/testdata/sf0.001"
SHAPES = {
    "op1_sentencepiece": {"doc_id": "bigint", "tokens": "array<int>", "round_trip": "boolean"},
    "op2_html_extraction": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
    "op3_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op4_line_dedup": {"doc_id": "bigint", "n_lines": "bigint", "n_dropped": "bigint", "kept_sha256": "string"},
    "op5_sharding": {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"},
    "op6_simhash": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op7_secret_scan": {"doc_id": "bigint", "n_assign": "bigint", "n_access": "bigint", "n_hex": "bigint", "base_sha256": "string", "spans": "string"},
    "op8_quality_rules": {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint", "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean"},
    "op9_repeats": {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"},
    "op10_decontamination": {"doc_id": "bigint", "item_id": "bigint"},
    "op11_merkle": {"doc_id": "bigint", "leaf": "string", "subroot": "string", "root": "string", "proof_sha256": "string", "folded_root": "string", "verified": "boolean"},
    "op12_spelling": {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"},
    "op13_packing": {"doc_id": "bigint", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "doc_tokens": "bigint", "sequence_id": "bigint", "offset": "bigint"},
}


@pytest.fixture(scope="module")
def folders(spark, odd_rows, tmp_path_factory):
    """A directory of awkward tables, and one of the same tables without rows."""
    homes = {}
    tables = {
        "documents": spark.createDataFrame([(i, t, lang, "src", len(t or "")) for i, t, lang in odd_rows], "doc_id long, text string, lang string, source string, n_chars long"),
        "labels": spark.createDataFrame([(3, 1, 1), (5, 0, 0), (6, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int"),
        "benchmark": spark.createDataFrame([(1, "the very old house"), (2, None), (3, ""), (None, "jumps over the lazy dog and runs")], "item_id long, text string"),
        "pages": spark.createDataFrame([(1, "u", "<article><p>Hi, there.</p></article>"), (1, "u", "<article><p>Hi, there.</p></article>"), (None, None, None), (2, "", "")], "page_id long, url string, html string"),
    }
    for kind in ("odd", "none"):
        homes[kind] = str(tmp_path_factory.mktemp(kind))
        for name, df in tables.items():
            (df if kind == "odd" else df.filter("false")).write.parquet(f"{homes[kind]}/{name}.parquet")
    return homes


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_contract_on_awkward_tables(spark, folders, odd_rows, name):
    df = registry.QUERIES[name](spark, folders["odd"])
    kinds = dict(df.dtypes)
    assert {c: kinds[c] for c in SHAPES[name]} == SHAPES[name]
    rows = df.collect()
    if name == "op10_decontamination":
        assert {(r.doc_id, r.item_id) for r in rows} >= {(5, None), (3, 1)}
    elif name == "op12_spelling":
        assert all(r.root == r.word and r.n >= 2 for r in rows)
    elif name == "op13_packing":
        assert sum(r.length for r in rows if r.start == 0) > 0 and len({str(r.doc_id) for r in rows}) == len({str(i) for i, _, _ in odd_rows})
    else:
        assert len(rows) == (4 if name == "op2_html_extraction" else len(odd_rows))
    if name == "op3_toxicity":
        for r in rows:
            assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and r.predicted == (r.score >= 0.3)
    if name == "op5_sharding":
        sizes = sorted((str(r.doc_id), r["size"], r.text_crc32) for r in rows)
        assert sizes == sorted((str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in odd_rows)
    if name == "op1_sentencepiece":
        assert all(r.round_trip for r in rows if r.doc_id != 9)
    if name in ("op4_line_dedup", "op9_repeats"):
        empty = hashlib.sha256(b"").hexdigest()
        assert all(r.kept_sha256 == empty for r in rows if r.doc_id in (1, 2))


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_empty_tables_give_no_rows(spark, folders, name):
    assert registry.QUERIES[name](spark, folders["none"]).count() == 0


def test_pipeline_runs_as_a_whole(spark, folders):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "n_tokens", "tokens"] and out.count() > 0
    docs, kept = spark.read.parquet(f"{SF}/documents.parquet"), None
    for _, stage in corpus_pipeline.STAGES:
        docs = kept = stage(spark, docs, SF)
    assert sorted(r.doc_id for r in out.collect()) == sorted(r.doc_id for r in kept.collect())
    assert out.filter(F.size("tokens") != F.col("n_tokens")).count() == 0
    assert corpus_pipeline.run(spark, folders["none"]).count() == 0
    odd = corpus_pipeline.run(spark, folders["odd"]).collect()
    assert all(r.n_tokens > 0 for r in odd)


@pytest.mark.parametrize("name", ["op11_merkle", "op12_spelling"])
def test_equals_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    found = con.execute(registry.ORACLES[name])
    names = [c[0] for c in found.description]
    want = sorted(map(str, found.fetchall()))
    got = registry.QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(names) and len(want) > 100
    assert sorted(str(tuple(r)) for r in got.select(*names).collect()) == want
