"""Rings of a world: layers of one width around the start, without the patch at it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestack.session import cut

#: Fixed value: where the first ring begins.
FIRST_EDGE = 12


def rings(layers: DataFrame, widths: DataFrame, base: DataFrame) -> DataFrame:
    """layers(config, layer, biome), widths(config, width), base(biome) -> (layer, biome, inner_edge, outer_edge).

    A layer's ring begins where the one before ends. The biome of the patch at the
    start is in no ring. Configurations with layers have to agree on rings and
    widths, widths are positive, and there is one patch at most; else the job fails.
    A layer whose biomes are all in the patch has a ring with a null biome.
    """
    patches = base.select("biome").distinct().limit(2).collect()
    if len(patches) > 1:
        raise ValueError(f"several biomes at the start: {sorted(r[0] for r in patches)}")
    known = cut(layers.distinct().join(widths, "config"))
    if not known.filter("width IS NULL OR NOT width > 0 OR width = double('infinity')").isEmpty():
        raise ValueError("a ring's width has to be positive and finite")
    digest = F.sum(F.xxhash64("layer", "biome", F.col("width").cast("double")).cast("decimal(38,0)"))
    shapes = known.groupBy("config").agg(F.count("*").alias("n"), digest.alias("d")).select("n", "d").distinct().count()
    if shapes > 1:
        raise ValueError("configurations with different layers")
    one = known.select("layer", "width").distinct()
    inside = known.select("layer", "biome").distinct().join(base.select("biome").distinct(), "biome", "left_anti")
    inner = F.lit(FIRST_EDGE) + F.col("layer") * F.col("width")
    return one.join(inside, "layer", "left").select("layer", "biome", inner.alias("inner_edge"), (inner + F.col("width")).alias("outer_edge"))
