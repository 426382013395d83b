"""Sharding: a uniform random shuffle into shards of exact size, by a hypergeometric communication matrix.

Rows are dealt to source partitions by a content hash, so the partition of a
row does not depend on how files were split or on which executor ran. From the
source counts alone the driver draws the communication matrix: row p says
exactly how many rows partition p sends to each shard (multivariate
hypergeometric, the law of those counts under a uniform shuffle). Each
partition is permuted locally and its first rows go to shard 0, the next to
shard 1 and so on; after the exchange every shard is permuted again. The second
permutation orders by a fresh 64-bit key whose top bits name a block, so that
no shard is sorted in one task: blocks are ranked on their own and a table of
block offsets turns ranks into gapless slots.

What the driver sees are counts: partitions x shards numbers, and one number
per block. Both follow ``rows_per_partition`` (a million rows each by default)
and stay a few MB at 10^11 rows. Law: ``rows``: shard sizes differ by one at
most. Equal texts are ordinary rows of this law and need no group.

Defined cases: null ids and texts are ordinary values; a null text has size 1
and the CRC of no bytes. Repeated rows share a key and are told apart by their
rank, so each still gets its own slot. An empty table gives no rows. All input
columns are kept; the added ones are in struct ``shard_place``.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_PARTITION = 1_000_000
MIN_PARTITIONS = 256
#: numpy draws hypergeometric margins of fewer than 10^9 good or bad rows.
URN = 1_000_000_000


def communication_matrix(rows: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """Counts partition x shard; its columns sum to sizes at most one apart, drawn uniformly."""
    total = int(rows.sum())
    left = np.full(shards, total // shards, dtype=np.int64)
    left[: total % shards] += 1
    rng = np.random.default_rng(seed)
    out = np.zeros((len(rows), shards), dtype=np.int64)
    for p, n in enumerate(rows):
        out[p] = draw(rng, left, int(n))
        left -= out[p]
    return out


def draw(rng: np.random.Generator, left: np.ndarray, n: int) -> np.ndarray:
    """One multivariate hypergeometric row, by marginals; of urns too large for numpy's margins, n different rows are drawn."""
    got = np.zeros(len(left), dtype=np.int64)
    rest = int(left.sum())
    if rest >= URN and n > rest // 2:
        return left - draw(rng, left, rest - n)
    if rest >= URN:
        picked = np.zeros(0, dtype=np.int64)
        while len(picked) < n:
            picked = np.union1d(picked, rng.integers(rest, size=n - len(picked)))
        return np.bincount(np.searchsorted(np.cumsum(left), picked, side="right"), minlength=len(left))
    for s, have in enumerate(left):
        rest -= int(have)
        got[s] = n if rest == 0 else rng.hypergeometric(int(have), rest, n) if n and have else 0
        n -= int(got[s])
    return got


def shard(
    df: DataFrame, shards: int = 8, seed: int = 17, rows_per_partition: int = ROWS_PER_PARTITION
) -> DataFrame:
    """All columns of ``df`` plus ``shard_place`` struct<shard int, slot long>."""
    spark = df.sparkSession
    names = df.columns
    rows = df.select(
        F.struct(*[F.col(c) for c in names]).alias("row"),
        F.xxhash64(F.lit(seed), *[F.col(c) for c in names]).alias("key"),
    )
    total = df.count()
    parts = max(MIN_PARTITIONS, -(-total // rows_per_partition))
    source = F.pmod(F.xxhash64(F.lit("source"), F.col("key")), F.lit(parts)).cast("int")
    rows = rows.withColumn("part", source)
    counts = np.zeros(parts, dtype=np.int64)
    for r in rows.groupBy("part").count().collect():  # one number per source partition
        counts[r["part"]] = r["count"]
    sent = communication_matrix(counts, shards, seed)
    bounds = spark.createDataFrame(
        [(p, [int(x) for x in np.cumsum(sent[p])]) for p in range(parts)], "part int, upto array<long>"
    )
    local = Window.partitionBy("part").orderBy("key")
    # `again` tells repeated rows apart in the second permutation.
    permuted = rows.withColumn("rank", F.row_number().over(local).cast("long"))
    placed = permuted.join(bounds, "part").select(
        "row",
        F.aggregate("upto", F.lit(0), lambda n, b: n + F.when(F.col("rank") > b, 1).otherwise(0)).alias("shard"),
        F.xxhash64(F.lit("second"), F.col("key"), F.col("rank")).alias("again"),
    )
    blocks = max(1, -(-total // (shards * rows_per_partition // 16)))
    placed = placed.withColumn("block", F.floor((F.shiftrightunsigned("again", 32) * blocks) / F.lit(2.0**32)).cast("int"))
    sizes = placed.groupBy("shard", "block").count()
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("shard", "block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("shard", "block").orderBy("again")
    return (
        placed.withColumn("at", F.row_number().over(within) - 1)
        .join(offsets, ["shard", "block"])
        .select("row", F.struct("shard", (F.col("before") + F.col("at")).cast("long").alias("slot")).alias("shard_place"))
        .select("row.*", "shard_place")
    )
