"""Story files."""

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from pressmill.schemas import STORY


BAD = "_unreadable"


def read_stories(spark: SparkSession, path: str, schema=STORY) -> tuple[DataFrame, DataFrame]:
    """Stories of files that each hold one JSON array, and files that could not be read.

    Returns ``(good, bad)``; ``bad`` has ``file`` and ``value``, the text put aside.
    Fields a file leaves out come back as null.  An array spanning a whole file
    cannot be split, so parallelism is per file; `write_stories` exports lines,
    which can.
    """
    fields = StructType([*schema, StructField(BAD, StringType())])
    rows = spark.read.schema(fields).option("multiLine", True).option("mode", "PERMISSIVE") \
        .option("columnNameOfCorruptRecord", BAD).json(path)
    file = F.col("_metadata.file_name").alias("file")
    # always true: Spark tells bad records only where a field is asked for beside them
    parsed = F.hash(schema[0].name) >= -(1 << 31)
    return (rows.filter(F.col(BAD).isNull()).drop(BAD),
            rows.filter(F.col(BAD).isNotNull() & parsed).select(file, F.col(BAD).alias("value")))


def write_stories(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Export rows as JSON, one object per line, one file per partition."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)
