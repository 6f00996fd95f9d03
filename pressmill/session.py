"""Session settings and tables written between stages."""

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings worth having on any cluster.  Sizes of shuffles and joins are left to
# AQE, and Spark bounds Arrow batches of page bodies by their bytes.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def settle(df: DataFrame) -> DataFrame:
    """``df``, with its session set to take repeated JSON keys, of which the last counts.

    Operators that read JSON call it, so that results do not depend on how the
    session was made.
    """
    df.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return df


@contextmanager
def task_bytes(spark: SparkSession, size: int):
    """Shuffled bytes that a task is to take, at most, for what is run inside."""
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, str(size))
    try:
        yield
    finally:
        spark.conf.set(key, before)


_local_folder = []


def shared_folder(spark: SparkSession) -> str:
    """Folder for tables between stages, as named by the cluster."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder all executors share")
    if not _local_folder:
        _local_folder.append(tempfile.mkdtemp(prefix="pressmill-"))
    return _local_folder[0]


def write_between(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts the lineage with a table that outlives executors, gives later stages
    column pruning and real sizes, and fixes values that depend on how rows were
    spread over partitions.
    """
    spark = df.sparkSession
    path = "/".join([
        shared_folder(spark).rstrip("/"), "pressmill",
        spark.sparkContext.applicationId, uuid.uuid4().hex,
    ])
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Remove a folder, if it is there, wherever Spark can write."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def clear_between(spark: SparkSession) -> None:
    """Remove the tables this application wrote between stages; call it when no result needs them any more."""
    remove_folder(spark, "/".join([shared_folder(spark).rstrip("/"), "pressmill", spark.sparkContext.applicationId]))
