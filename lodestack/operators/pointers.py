"""JSON pointers: lookup, wildcard walk, leaf flattening and normalization."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestack.session import cut


def parts(pointer: str) -> list[str]:
    """Reference tokens of a pointer, ~1 and ~0 undone."""
    if pointer == "":
        return []
    if not pointer.startswith("/"):
        raise ValueError(f"not a JSON pointer: {pointer!r}")
    return [p.replace("~1", "/").replace("~0", "~") for p in pointer[1:].split("/")]


def variant_path(pointer: str) -> str:
    """The VARIANT path of a pointer; digits address list elements."""
    return "$" + "".join(f"[{p}]" if p.isdigit() else "['" + p.replace("'", "\\'") + "']" for p in parts(pointer))


def get(value: Column | str, pointer: str, kind: str = "variant") -> Column:
    return F.try_variant_get(value, variant_path(pointer), kind)


def normalize(pointer: Column) -> Column:
    """List positions become stars."""
    return F.regexp_replace(pointer, r"/\d+(?=/|$)", "/*")


def under(pointer: Column, prefix: str) -> Column:
    return (pointer == prefix) | pointer.startswith(prefix.rstrip("/") + "/")


def leaves(rows: DataFrame, keys: list[str], value: str, depth: int, arrays: bool = True) -> DataFrame:
    """keys plus (pointer, leaf as JSON text). Each level of the value is one variant_explode; ``depth`` levels go into one plan.

    Finished leaves travel along as rows that a level does not open, so every level is computed once. Empty
    objects and lists are leaves. Values that are still open after a plan's levels are opened by further ones.
    """
    level = rows.select(*keys, F.lit("").alias("pointer"), F.col(value).alias("v"))
    opens = ["OBJECT", "ARRAY"] if arrays else ["OBJECT"]
    more = F.coalesce(F.regexp_extract(F.schema_of_variant("v"), "^[A-Z]+", 0).isin(*opens) & ~F.to_json("v").isin("{}", "[]"), F.lit(False))
    out = None
    while True:
        for _ in range(depth):
            level = level.withColumn("more", more).withColumn("open", F.when(F.col("more"), F.col("v")))
            level = level.lateralJoin(
                rows.sparkSession.tvf.variant_explode_outer(F.col("open").outer()).select(F.col("pos"), F.col("key").alias("name"), F.col("value").alias("inner"))
            )
            name = F.replace(F.replace(F.col("name"), F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1"))
            longer = F.concat("pointer", F.lit("/"), F.coalesce(name, F.col("pos").cast("string")))
            level = level.select(
                *keys, F.when(F.col("more"), longer).otherwise(F.col("pointer")).alias("pointer"), F.when(F.col("more"), F.col("inner")).otherwise(F.col("v")).alias("v")
            )
        level = cut(level.withColumn("unfinished", more))
        done = level.filter("NOT unfinished").select(*keys, "pointer", F.to_json("v").alias("leaf"))
        out = done if out is None else out.union(done)
        level = level.filter("unfinished").drop("unfinished")
        if level.isEmpty():
            return out


def truncate_or_hash(text: Column, most: int) -> Column:
    """Long values are replaced by their size and hash."""
    note = F.concat(F.lit('{"omitted_bytes":'), F.octet_length(text), F.lit(',"sha256":"'), F.sha2(text, 256), F.lit('"}'))
    return F.when(F.octet_length(text) > most, note).otherwise(text)
