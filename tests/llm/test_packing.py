import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lodestack.llm import packing, registry


@pytest.fixture(scope="module")
def model():
    from tokenizers import Tokenizer

    return Tokenizer.from_str(packing.vocabulary_text())


def ids_of(model, text):
    return [*model.encode(text or "", add_special_tokens=False).ids, 2]


def check(rows, pieces, model, size):
    """Every id lies in one piece, sequences are gapless; padding is returned."""
    ids = {i: ids_of(model, t) for i, t in rows}
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        part = np.array(ids[p.doc_id][p.start : p.start + p.length], dtype="<u4").tobytes()
        assert p.length > 0 and p.ids_crc32 == zlib.crc32(part) and p.doc_tokens == len(ids[p.doc_id])
        by_doc[p.doc_id].append((p.start, p.length))
        by_seq[p.sequence_id].append((p.offset, p.length))
    for i, _ in rows:
        at, times = 0, sum(1 for j, _ in rows if j == i)
        want = sorted(x for x in by_doc[i])
        if times == 1:
            for start, length in want:
                assert start == at
                at += length
            assert at == len(ids[i])
        else:
            assert sum(n for _, n in want) == times * len(ids[i])
    padding = 0
    for parts in by_seq.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
        padding += 0 if at & (at - 1) == 0 else size - at
    return padding, len(by_seq), sum(len(ids[i]) for i, _ in rows)


def test_query_over_odd_rows(spark, odd, odd_rows, model, tmp_path):
    odd.filter("doc_id IS NOT NULL").write.parquet(f"{tmp_path}/documents.parquet")
    got = registry.QUERIES["op13_packing"](spark, str(tmp_path))
    assert set(got.columns) == {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"}
    rows = [r[:2] for r in odd_rows if r[0] is not None]
    padding, sequences, total = check(rows, got.collect(), model, 4096)
    assert padding == 0 and sequences == total // 4096 + (total % 4096).bit_count()
    assert packing.pieces_of(packing.pack(odd)).filter("id IS NULL").agg(F.sum("length")).first()[0] == sum(len(ids_of(model, r[1])) for r in odd_rows if r[0] is None)


@pytest.mark.parametrize("parts,merged,most_open", [(1, 2, 1), (7, 2, 3), (9, 3, 8), (5, 256, 32)])
def test_random_lengths(spark, model, parts, merged, most_open):
    rng = random.Random(parts)
    rows = [(k, "tok " * rng.choice([0, 1, 5, 17, 60, 64, 300])) for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    out = packing.pack(docs, size=64, most_open=most_open, merged=merged)
    pieces = packing.pieces_of(out).withColumnRenamed("id", "doc_id").collect()
    padding, sequences, total = check(rows, pieces, model, 64)
    assert padding == 0 and sequences == total // 64 + (total % 64).bit_count()
    assert out.count() == out.select("sequence_id").distinct().count() == sequences


def test_a_sequence_costs_one_cut_at_most(spark, model):
    rng = random.Random(3)
    rows = [(k, "tok " * rng.randrange(100, 1500)) for k in range(400)]
    pieces = packing.pieces_of(packing.pack(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1))).collect()
    assert len(pieces) - len(rows) <= len({p.sequence_id for p in pieces})


def test_ids_are_the_library_s(model):
    texts = [
        "The quick, brown fox; it's DON'T won't 'tis o'clock!? 3.14 ½ ² Ⅷ 12,5", "ÉTÉ été, naïve. Ünïcode: İstanbul ǅ ß ſ Σίσυφος ΟΔΟΣ.",
        "été å J̌ ǰ 漢字かな 한국어 한 💩💩,  x y\x1cz\x85w", "<|endoftext|>x <|STARTOFTEXT|>", "a_b c-d e.f,g ...,, ,x :y", "x" * 5000,
        "\x00 \x0b\x0c\r\n\t", "word " * 3000,
    ]
    own = packing.WordIds(packing.vocabulary_text())
    for part in (texts, texts, [t[::-1] for t in texts]):
        got = packing.encoded(pa.array(part), own)
        assert [np.frombuffer(x, dtype="<u4").tolist() for x in got] == [ids_of(model, t) for t in part]


def test_long_texts(model, monkeypatch):
    monkeypatch.setattr(packing, "SLICE", 50)
    monkeypatch.setattr(packing, "TOGETHER", 3)
    own = packing.WordIds(packing.vocabulary_text())
    text = " ".join(f"word{k}, and \n more" for k in range(200)) + "y" * 300
    assert [np.frombuffer(x, dtype="<u4").tolist() for x in packing.encoded(pa.array([text, None, "", "short"]), own)] == [ids_of(model, t) for t in (text, "", "", "short")]


def test_powers_of_two():
    w = packing.Window()
    for d, n in enumerate((100, 3, 77)):
        w.add(d, n, 0, bytes(4 * n))
    parts = list(packing.powers_of_two(w))
    assert [p.used for p in parts] == [128, 32, 16, 4]
    assert [(p[0], p[1], p[2]) for x in parts for p in x.pieces] == [(0, 0, 100), (1, 0, 3), (2, 0, 25), (2, 25, 32), (2, 57, 16), (2, 73, 4)]


def test_empty(empty):
    assert packing.pack(empty).count() == 0
