"""Acquisition queries: which region yields which part, and how likely."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestack.session import table


def mining_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight of each (supplier, part); quantities become decimals so that sums do not depend on row order."""
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_suppkey", "l_partkey")
        .agg(F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("w"))
    )


def mining_chance(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = mining_weights(spark, sf_dir)
    totals = weights.groupBy("l_suppkey").agg(F.sum("w").alias("total"))
    return weights.join(totals, "l_suppkey").select(
        F.col("l_suppkey").alias("supplier"),
        F.col("l_partkey").alias("part"),
        (F.col("w").cast("double") / F.greatest(F.lit(1.0), F.col("total").cast("double"))).alias("chance"),
    )


def new_materials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per part the ring with the smallest (-chance, ring)."""
    rings = table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    return (
        mining_chance(spark, sf_dir)
        .join(rings, F.col("supplier") == F.col("s_suppkey"))
        .groupBy(F.col("part").alias("p"))
        .agg(F.min(F.struct((-F.col("chance")).alias("c"), F.col("n_regionkey").alias("r"))).alias("best"))
        .select("p", F.col("best.r").alias("ring"), (-F.col("best.c")).alias("chance"))
    )


_CHANCE = """
w AS (SELECT l_suppkey, l_partkey, sum(CAST(l_quantity AS DECIMAL(18,2))) AS w FROM lineitem GROUP BY 1, 2),
t AS (SELECT l_suppkey, sum(w) AS total FROM w GROUP BY 1),
c AS (SELECT w.l_suppkey AS supplier, w.l_partkey AS part,
             CAST(w AS DOUBLE) / greatest(1.0, CAST(total AS DOUBLE)) AS chance FROM w JOIN t USING (l_suppkey))
"""

QUERIES = {"mining_chance": mining_chance, "gq_new_materials": new_materials}
ORACLES = {
    "mining_chance": f"WITH {_CHANCE} SELECT supplier, part, chance FROM c",
    "gq_new_materials": f"""WITH {_CHANCE},
r AS (SELECT part, n_regionkey AS ring, chance,
             row_number() OVER (PARTITION BY part ORDER BY chance DESC, n_regionkey) AS k
      FROM c JOIN supplier ON s_suppkey = supplier JOIN nation ON n_nationkey = s_nationkey)
SELECT part AS p, ring, chance FROM r WHERE k = 1""",
}
