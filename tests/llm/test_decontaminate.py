import random

import numpy as np
import pytest

from lodestack.llm import decontaminate as D


def texts(seed, n, length):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(3000)]
    return [" ".join(rng.choice(words) for _ in range(length)) for _ in range(n)]


def test_finds_what_brute_force_finds():
    rng = random.Random(0)
    items = [(k, " ".join(t.split()[: 6 + k])) for k, t in enumerate(texts(1, 40, 60))]
    block = D.Items(items)
    filler = texts(2, 1, 400)[0].split()
    seen = 0
    for _ in range(300):
        k = rng.randrange(len(items))
        words = items[k][1].split()
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = rng.choice(filler)
        doc = filler[: rng.randrange(60)] + words + filler[200 : 200 + rng.randrange(60)]
        n = len(block.words[k])
        best = max((D.overlap(doc[s : s + n], block.words[k], D.SHINGLE) for s in range(len(doc) - n + 1)), default=0)
        got = block.matches(" ".join(doc)).get(k, (0.0, 0))[0]
        if best >= D.SIMILARITY:
            seen += 1
            assert abs(got - best) < 1e-9
        else:
            assert got == 0
    assert seen > 80


def test_index_guarantees_the_radius():
    rng = np.random.default_rng(0)
    block = D.Items([(k, t) for k, t in enumerate(texts(3, 100, 30))])
    for _ in range(200):
        k = int(rng.integers(100))
        x = int(block.fps[k])
        for b in rng.choice(64, D.RADIUS, replace=False):
            x ^= 1 << int(b)
        assert k in {i for _, i in block.candidates(np.array([x], dtype=np.uint64))}


def test_rows(spark, odd, empty):
    items = [(1, texts(4, 1, 30)[0]), (1, texts(4, 1, 30)[0]), (2, None), (3, ""), (4, "three short words"), (None, texts(5, 1, 25)[0])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = [(1, "x y z " + items[0][1].upper().replace(" ", ", ") + " tail"), (2, "nothing here"), (3, None), (4, "Three, SHORT words!"), (None, items[5][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in D.leaks(df, bench).collect()}
    assert got == {(1, 1), (4, 4), (None, None)}
    assert {r.doc_id for r in D.keep_clean(df, bench).collect()} == {2, 3}
    assert D.keep_clean(odd, bench.filter("false")).count() == odd.count() and D.leaks(empty, bench).count() == 0
    assert D.keep_clean(odd, bench).columns == odd.columns


@pytest.mark.parametrize("most", [1 << 20, 0])
def test_large_benchmarks_are_dealt_and_documents_scanned_once(spark, monkeypatch, odd, most):
    monkeypatch.setattr(D, "BLOCK_BYTES", 200)
    monkeypatch.setattr(D, "DOCS", 7)
    items = [(k, t) for k, t in enumerate(texts(6, 10, 20))] + [(3, "x y"), (3, "x y"), (None, "three short words"), (11, None), (12, "")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [(k, "before " + t + " after") for k, t in items[:10]] * 3 + [(50 + k, items[0][1]) for k in range(40)] + [(None, "Three short, words"), (99, "x y"), (98, "clean")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = lambda **kw: sorted(map(str, D.leaks(docs, bench, **kw).collect()))
    want = found()
    assert len(want) == 30 + 40 + 2
    assert found(small=0, most_shingles=most) == want
    assert D.leaks(odd, bench, small=0, most_shingles=most).count() == 0


def test_ids_may_be_strings(spark):
    bench = spark.createDataFrame([("i", "one two three four five six")], "item_id string, text string")
    docs = spark.createDataFrame([("d", "so one two three four five six it is"), ("e", "no")], "doc_id string, text string")
    for small in (1 << 20, 0):
        assert [(r.doc_id, r.item_id, r.first_word) for r in D.leaks(docs, bench, small=small).collect()] == [("d", "i", 1)]


def test_fingerprints_of_similar_windows_lie_within_the_radius():
    rng = random.Random(4)
    block, near, seen = D.Items([]), 0, 0
    while seen < 2000:
        n = rng.randint(20, 200)
        a = [f"w{rng.randrange(3000)}" for _ in range(n)]
        b = list(a)
        for _ in range(max(1, round(n * 0.2 / D.SHINGLE))):
            b[rng.randrange(n)] = f"v{rng.randrange(3000)}"
        if not D.SIMILARITY <= D.overlap(a, b, D.SHINGLE) < 0.85:
            continue
        seen += 1
        x, y = (D.simhashes(h, len(h))[0] for h in (D.shingle_hashes(block.hashed(w), D.SHINGLE) for w in (a, b)))
        near += int(x ^ y).bit_count() <= D.RADIUS
    print("within the radius at similarity 0.80 to 0.85:", near / seen)
    assert near / seen > 0.99


def test_item_without_its_last_word():
    item = " ".join(f"w{k}" for k in range(37))
    items = D.Items([(1, item)])
    short = item.rsplit(" ", 1)[0]
    (k, (similarity, at)), = items.matches(short).items()
    assert k == 0 and at == 0 and 0.95 < similarity < 1
    assert not items.matches(" ".join(item.split()[:12]))
