import duckdb
import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from lodestack.llm import pieces

V = pieces.Vocabulary()
E = pieces.Encoder(V)
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=pieces.VOCABULARY)
TEXTS = [
    "Hello world, the thing.", "theatinly erhe", "a  b\n\nc\t€ 漢字 💩", "x" * 300, "&&& &&&&&&& ab&&&", " lead and trail ", "▁", " " * 90,
    "=" * 70 + "\r\n", "\x00\x01 nul", "includegraphics" * 9, "é é ﬁ x²", "a▁b", "<s> <0x41> </s>",
]


def in_chunks(text, chunk):
    s = pieces.MARK + text.replace(" ", pieces.MARK)
    n = V.longest
    parts = [(s[max(0, i - n) : i], s[i : i + chunk], s[i + chunk : i + chunk + n]) for i in range(0, len(s), chunk)]
    matrices = [E.transfer(*x) for x in parts]
    vectors = pieces.prefixes(matrices, np.zeros((1, 1), dtype=np.int64))
    ends = [E.ends(*x, v[0].tolist()) for x, v in zip(parts, vectors)]
    alive = [k for k, c in enumerate(ends[-1][1]) if c >= 0]
    assert len(alive) == 1, "one path at the end of a text"
    state, out = alive[0], []
    for common, comes, tails in reversed(ends):
        out = common + tails[state] + out
        state = comes[state]
    return out


@pytest.mark.parametrize("text", TEXTS)
def test_ids_are_the_librarys(text):
    ids = E.encode(text).tolist()
    assert ids == LIBRARY.encode(text)
    assert b"".join(V.out[k] for k in ids)[1:].decode() == text.replace(pieces.MARK, " ")


def test_ids_are_the_librarys_on_all_documents():
    rows = duckdb.sql("SELECT text FROM '/root/testdata/sf0.01/documents.parquet' WHERE text IS NOT NULL").fetchall()
    texts = [r[0] for r in rows]
    assert [x.tolist() for x in E.encode_many(texts)] == LIBRARY.encode(texts)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("aeintrshlo  ▁\n=.,AX0é漢💩")), max_size=200))
def test_ids_are_the_librarys_on_any_text(text):
    want = LIBRARY.encode(text)
    assert E.encode(text).tolist() == want
    if text:
        assert in_chunks(text, 16) == want and in_chunks(text, 23) == want


@pytest.mark.parametrize("chunk", [17, 40, 111])
@pytest.mark.parametrize("text", [*TEXTS, "the cat sat on the mat " * 20, "thecatsatonthemat" * 30 + "漢" * 20, "a" * 500, "internationalization" * 20])
def test_chunks_agree(text, chunk):
    assert in_chunks(text, chunk) == LIBRARY.encode(text)


def test_long_words_are_merged_alike():
    rng = np.random.default_rng(3)
    for _ in range(50):
        s = "".join(rng.choice(list("etaoinshr "), 400)).replace(" ", pieces.MARK)
        assert E._merged_long(s) == [p for w in [s] for p in _plain(w)]


def _plain(s):
    """Merging by the definition: the best pair, leftmost first, until there is none."""
    parts = list(s)
    while True:
        ranks = [(V.order[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in V.order]
        if not ranks:
            return parts
        k = min(ranks)[1]
        parts[k : k + 2] = [parts[k] + parts[k + 1]]


def test_product_is_associative():
    rng = np.random.default_rng(0)
    a, b, c = (rng.choice([0, pieces.DEAD], shape) for shape in ((3, 5), (5, 4), (4, 6)))
    left, right = pieces.maxplus(pieces.maxplus(a, b), c), pieces.maxplus(a, pieces.maxplus(b, c))
    assert (left == right).all()
    assert (pieces.unpacked(pieces.packed(a)) == a).all()


def test_giant_texts_equal_small(odd):
    small = sorted((str(r.id), r.th, tuple(r.tokens)) for r in pieces.encode(odd).collect())
    giant = sorted((str(r.id), r.th, tuple(r.tokens)) for r in pieces.encode(odd, giant=40, chunk=25, block=2).collect() if r.th is not None)
    assert len(small) == odd.count() and [x for x in small] == giant
    with pytest.raises(ValueError):
        pieces.encode(odd, giant=10, chunk=3)


def test_round_trip(odd, odd_rows, empty):
    rows = pieces.decode(pieces.encode(odd)).collect()
    want = sorted((str(i), (t or "").replace(pieces.MARK, " ")) for i, t, _ in odd_rows)
    assert sorted((str(r.id), r.decoded) for r in rows) == want
    assert pieces.encode(empty).count() == 0


def test_ids_of_documents_may_be_strings(spark):
    rows = spark.createDataFrame([("a", "some text"), ("b", "word " * 30)], "doc_id string, text string")
    assert sorted((r.id, list(r.tokens)) for r in pieces.encode(rows, giant=60, chunk=32).collect()) == [
        ("a", LIBRARY.encode("some text")), ("b", LIBRARY.encode("word " * 30))
    ]
