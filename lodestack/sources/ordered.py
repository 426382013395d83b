"""Tables stored in order of a key, with a directory of what each file holds: lookups open only files that can hold an answer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Files that are named to a reader one by one at most; a wider prefix is a filtered scan.
MOST_FILES = 10_000
#: Keys of one lookup at most; more are a join.
MOST_KEYS = 1_000
LAST = "\U0010ffff"


def write(rows: DataFrame, key: str, folder: str, files: int) -> None:
    """Files of consecutive key ranges, sorted inside, and ``folder/directory``: (file, first, last, rows)."""
    rows.repartitionByRange(files, key).sortWithinPartitions(key).write.mode("overwrite").parquet(f"{folder}/rows")
    stored = rows.sparkSession.read.parquet(f"{folder}/rows")
    name = F.element_at(F.split("_metadata.file_path", "/"), -1)
    listed = stored.select(name.alias("file"), F.col(key).alias("key")).groupBy("file")
    listed.agg(F.min("key").alias("first"), F.max("key").alias("last"), F.count("*").alias("rows")).coalesce(1).write.mode("overwrite").parquet(f"{folder}/directory")


def _opened(spark: SparkSession, folder: str, holds) -> DataFrame | None:
    """The files whose range may hold an answer; None if they are too many to name."""
    found = spark.read.parquet(f"{folder}/directory").filter(holds).select("file").limit(MOST_FILES + 1).collect()
    if len(found) > MOST_FILES:
        return None
    whole = spark.read.parquet(f"{folder}/rows")
    return spark.read.schema(whole.schema).parquet(*(f"{folder}/rows/{r['file']}" for r in found)) if found else whole.filter("false")


def by_keys(spark: SparkSession, folder: str, key: str, wanted: list) -> DataFrame:
    """Rows with one of the keys; at most one file per key is opened, and where equal keys span files, these."""
    wanted = sorted({k for k in wanted if k is not None})
    if len(wanted) > MOST_KEYS:
        raise ValueError(f"more than {MOST_KEYS} keys are a join with the stored table, not a lookup")
    if not wanted:
        return spark.read.parquet(f"{folder}/rows").filter("false")
    holds = F.exists(F.array(*map(F.lit, wanted)), lambda k: (k >= F.col("first")) & (k <= F.col("last")))
    rows = _opened(spark, folder, holds)
    return (spark.read.parquet(f"{folder}/rows") if rows is None else rows).filter(F.col(key).isin(wanted))


def by_prefix(spark: SparkSession, folder: str, key: str, prefix: str) -> DataFrame:
    """Rows whose key begins so."""
    rows = _opened(spark, folder, (F.col("last") >= prefix) & (F.col("first") <= prefix + LAST))
    return (spark.read.parquet(f"{folder}/rows") if rows is None else rows).filter(F.col(key).startswith(prefix))
