import random

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from lodestack.llm import simhash
from lodestack.llm.components import connected_components
from lodestack.llm.text import words_of


def components(pairs, nodes):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(1)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + k, 1001 + k) for k in range(60)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = components(pairs, {x for p in pairs if p[0] != p[1] for x in p})
    assert got == want


def test_fingerprint_by_definition():
    for text in ("", "one", "A b C d e f a b c d e", "x " * 50):
        words = words_of(text)
        shingles = [b" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))] if words else []
        hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
        assert simhash.fingerprint(words, 4) % (1 << 64) == want


def test_hash_is_sparks(spark):
    got = spark.sql("SELECT xxhash64('a b c d') AS h").first().h
    assert got % (1 << 64) == xxhash.xxh64_intdigest(b"a b c d", 42)


@pytest.mark.parametrize("segments,radius", [(simhash.SEGMENTS, 4), (simhash.FOUR_SEGMENTS, 7)])
def test_links_connect_what_brute_force_connects(spark, segments, radius):
    rng = random.Random(radius)
    fps = set()
    for _ in range(40):
        centre = rng.getrandbits(64)
        for _ in range(30):
            x = centre
            for _ in range(rng.randrange(8)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    dense = rng.getrandbits(64)
    fps |= {dense ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(a)}
    signed = np.array(sorted(fps), dtype=np.uint64).view(np.int64).tolist()
    u = np.array(signed, dtype=np.int64).view(np.uint64)
    pairs = [(signed[i], signed[j]) for i in range(len(u)) for j in np.flatnonzero(np.bitwise_count(u[:i] ^ u[i]) <= radius)]
    want = components(pairs, signed)
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    for block in (4096, 10):
        links = [(r.a, r.b) for r in simhash.near_links(df, radius, segments, block).collect()]
        assert all(np.bitwise_count(np.uint64(a % (1 << 64)) ^ np.uint64(b % (1 << 64))) <= radius for a, b in links)
        assert components(links, signed) == want


def test_groups_and_keep_one(spark, odd, empty):
    got = simhash.near_groups(odd).collect()
    assert len(got) == odd.count()
    by = {}
    for r in got:
        by.setdefault(r.fp, set()).add(r.component_id)
    assert all(len(c) == 1 for c in by.values())
    assert {r.component_id for r in got if r.id in (1, 2, 8)} == {1}
    kept = simhash.keep_one(odd)
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == odd.columns and 3 in ids and 4 not in ids and ids.count(3) == 1 and 7 in ids and 9 in ids
    assert simhash.keep_one(empty).count() == 0 and simhash.near_groups(empty).count() == 0


def test_keep_one_wants_similarity(spark):
    rng = random.Random(5)
    base = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    near = base[:200] + ["changed"] + base[201:]
    rows = [(k, " ".join(near if k % 2 else base)) for k in range(10)] + [(50 + k, f"other text number {k} " + " ".join(base[k * 9 : k * 9 + 9])) for k in range(10)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id for r in simhash.keep_one(df).collect()}
    assert len(kept & set(range(10))) == 1 and kept >= set(range(50, 60))
    assert df.select(F.max("doc_id")).first()[0] in kept


def greedy(rows, size, similarity):
    kept = []
    for key, text in sorted(rows):
        mine = simhash.shingle_hashes(text, size)
        if all(simhash.jaccard(mine, x) < similarity for _, x in kept):
            kept.append((key, mine))
    return {k for k, _ in kept}


def test_large_groups_are_settled_alike(spark, monkeypatch):
    rng = random.Random(7)
    base = [f"w{rng.randrange(10**6)}" for _ in range(300)]
    rows = []
    for k in range(60):
        words = list(base)
        for _ in range(rng.randrange(1, 9)):
            words[rng.randrange(300)] = f"v{rng.randrange(10**6)}"
        rows.append((k, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    # all in one group, whatever their fingerprints
    monkeypatch.setattr(simhash, "near_groups", lambda docs, *a, **k: docs.selectExpr("doc_id AS id", "xxhash64(text) AS th", "doc_id AS fp", "0L AS component_id"))
    want = greedy(rows, 5, 0.8)
    for most in (256, 10, 3):
        monkeypatch.setattr(simhash, "SMALL_GROUP", most)
        assert {r.doc_id for r in simhash.keep_one(df).collect()} == want
    assert 1 < len(want) < 60


def test_scattered_edits_are_found(spark):
    """Pairs at similarity 0.8 and little more, each a group of its own, found through the stage's own candidates."""
    rng = random.Random(11)
    rows, pairs = [], 0
    for k in range(200):
        n = rng.randrange(60, 500)
        base = [f"w{rng.randrange(10**6)}" for _ in range(n)]
        near = list(base)
        mine, other = (simhash.shingle_hashes(" ".join(x), 5) for x in (base, near))
        while simhash.jaccard(mine, other) >= 0.83:
            near[rng.randrange(n)] = f"v{rng.randrange(10**6)}"
            other = simhash.shingle_hashes(" ".join(near), 5)
        pairs += simhash.jaccard(mine, other) >= 0.8
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(near))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = greedy(rows, 5, 0.8)
    assert pairs > 100 and len(want) == len(rows) - pairs
    assert {r.doc_id for r in simhash.keep_one(df).collect()} == want


def test_hot_marks_and_large_components_give_the_same_groups(spark, monkeypatch):
    rng = random.Random(9)
    base = [f"w{rng.randrange(500)}" for _ in range(200)]
    rows = []
    for k in range(120):
        words = list(base)
        words[rng.randrange(200)] = f"v{k}"
        rows.append((k, " ".join(words)))
    rows += [(200 + k, " ".join(f"u{rng.randrange(9000)}" for _ in range(80))) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    groups = lambda: sorted(tuple(r) for r in simhash.near_groups(docs, size=5, radius=7, segments=simhash.FOUR_SEGMENTS, marked=True).collect())
    want = groups()
    monkeypatch.setattr(simhash, "BLOCK", 3)
    monkeypatch.setattr(simhash, "LARGE_ROOT", 3)
    monkeypatch.setattr(simhash, "MOST_NAMED", 2)
    assert groups() == want and {x[3] for x in want if x[0] < 200} == {0}


def test_a_bucket_of_three_in_a_hundred_is_split(spark):
    rng = random.Random(2)
    shared = rng.getrandbits(21)
    fps = {(rng.getrandbits(43) << 21 | shared) - (1 << 63) for _ in range(6000)} | {rng.getrandbits(64) - (1 << 63) for _ in range(194_000)}
    df = spark.createDataFrame(pd.DataFrame({"fp": sorted(fps)}))
    named = {r.key: r.blocks for r in simhash.large_buckets(df.select(F.col("fp").bitwiseAND(31).alias("key")), 6000).collect()}
    assert sorted(set(named.values())) == [2, 3] and len(named) > 15
    links = simhash.near_links(df)
    sizes = [r[0] for r in df.select((F.col("fp").bitwiseAND((1 << 21) - 1)).alias("key")).groupBy("key").count().select("count").collect()]
    assert max(sizes) >= 6000 > simhash.BLOCK  # the bucket, and each of its 21 variants, is above a block
    got = {tuple(sorted((r.a, r.b))) for r in links.collect()}
    assert all(0 < (a ^ b).bit_count() <= 4 for a, b in got)
