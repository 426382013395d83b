"""Session, table and checkpoint helpers shared by every operator."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, name: str = "lodestack") -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``; only a local session may do without it."""
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix="lodestack-")


def _place(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, system = _place(spark, path)
    return system.exists(place)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the shared one, deleted when the driver's JVM ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    place, system = _place(spark, path)
    system.mkdirs(place)  # only what is there is marked
    system.deleteOnExit(place)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table that nothing reads any more."""
    place, system = _place(spark, path)
    system.delete(place, True)


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def stored(df: DataFrame, key: str, path: str) -> DataFrame:
    """df as Parquet at a new path in the shared folder, dealt by a key: joins and groups by it need no shuffle of these rows.

    The catalog knows the table only until it is read; rows that are not dealt by
    the key into ``spark.sql.shuffle.partitions`` before give small files.
    """
    spark, name = df.sparkSession, f"stored_{uuid.uuid4().hex}"
    df.write.bucketBy(shuffle_partitions(spark), key).option("path", path).saveAsTable(name)
    out = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return out


def written(df: DataFrame, path: str) -> DataFrame:
    """df as Parquet at a new path in the shared folder, computed once and read back with its own schema."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
