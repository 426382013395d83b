from collections import Counter

import numpy as np

from lodestack.llm import sharding


def test_matrix_is_exact():
    rows = np.array([5, 0, 17, 3, 100])
    m = sharding.communication_matrix(rows, 8, seed=1)
    assert (m.sum(axis=1) == rows).all() and (m >= 0).all()
    assert m.sum(axis=0).max() - m.sum(axis=0).min() <= 1


def test_matrix_is_hypergeometric():
    got = [sharding.communication_matrix(np.array([6, 6]), 2, seed=s)[0, 0] for s in range(4000)]
    # C(6,k) C(6,6-k) / C(12,6)
    want = np.array([1, 36, 225, 400, 225, 36, 1]) / 924
    assert np.abs(np.bincount(got, minlength=7) / 4000 - want).max() < 0.03


def places(df, **kw):
    return [(r.doc_id, r.shard, r.slot) for r in sharding.shard(df, **kw).select("doc_id", "shard_place.*").collect()]


def test_exact_sizes_and_slots(spark):
    df = spark.range(1003).withColumnRenamed("id", "doc_id")
    for kw in ({}, {"rows_per_partition": 40}):
        got = places(df, shards=8, **kw)
        assert sorted(x[0] for x in got) == list(range(1003))
        size = Counter(x[1] for x in got)
        assert max(size.values()) - min(size.values()) <= 1 and len(size) == 8
        for s in range(8):
            assert sorted(x[2] for x in got if x[1] == s) == list(range(size[s]))
        assert sorted(got) == sorted(places(df, shards=8, **kw))
        assert sorted(got) == sorted(places(df.repartition(7), shards=8, **kw))


def test_uniform(spark):
    df = spark.range(4000).withColumnRenamed("id", "doc_id")
    got = places(df, shards=8)
    table = np.zeros((10, 8))
    for i, s, _ in got:
        table[i // 400, s] += 1
    assert ((table - 50) ** 2 / 50).sum() < 120  # 63 degrees of freedom


def test_odd_rows(odd, empty):
    got = sharding.shard(odd, shards=3)
    assert got.columns == [*odd.columns, "shard_place"] and got.count() == odd.count()
    assert sharding.shard(empty, shards=3).count() == 0


def test_margins_of_large_urns():
    left = np.array([250_000_000] * 7 + [750_000_000], dtype=np.int64)
    rng = np.random.default_rng(3)
    got = np.stack([sharding.draw(rng, left, 10_000) for _ in range(50)])
    assert (got.sum(axis=1) == 10_000).all()
    assert np.allclose(got.mean(axis=0), 10_000 * left / left.sum(), rtol=0.02)
    assert (left - sharding.draw(rng, left, int(left.sum()) - 10_000)).sum() == 10_000
