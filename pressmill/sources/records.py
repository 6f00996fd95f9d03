"""Record files: envelopes and JSON lines."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pressmill.functions.json_text import one_record
from pressmill.session import settle


def envelope_items(text: str) -> Column:
    """Items of the ``content`` list of one envelope, each as JSON text.

    Null where the text is not a JSON object or ``content`` is not a list.
    """
    record = one_record(text, "content: array<variant>")
    return F.expr(f"transform(get({record}, 0).content, item -> to_json(item))")


def unwrap_envelope(spark: SparkSession, folder: str) -> DataFrame:
    """One row ``(file, value)`` per item of every ``*.json`` envelope.

    An envelope is one JSON document, so a file is one task; files spread over
    the cluster.
    """
    files = settle(spark.read.option("wholetext", True).option("pathGlobFilter", "*.json").text(folder))
    return files.select(
        F.col("_metadata.file_name").alias("file"),
        F.explode(envelope_items("value")).alias("value"),
    )


def write_lines(items: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write items as JSON lines, in one folder per input file."""
    items.write.mode(mode).partitionBy("file").text(path)


def read_lines(spark: SparkSession, folder: str, pattern: str = "*.json") -> DataFrame:
    """One row ``(file, value)`` per line of every ``*.json`` file; splittable.

    What `write_lines` wrote is read with ``pattern="*.txt"``; its column
    ``file`` then names the original file.
    """
    lines = spark.read.option("pathGlobFilter", pattern).text(folder)
    file = F.col("file") if "file" in lines.columns else F.col("_metadata.file_name")
    return lines.select(file.alias("file"), "value")


def is_record(value: str) -> Column:
    """True for a line that holds exactly one JSON object."""
    return F.expr(f"size({one_record(value, '_: string')}) = 1")


def read_article_lines(spark: SparkSession, folder: str,
                       pattern: str = "*.json") -> tuple[DataFrame, DataFrame]:
    """Lines that hold a JSON object, and the malformed ones for quarantine."""
    return split_lines(read_lines(spark, folder, pattern))


def split_lines(lines: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Split lines into ``(good, bad)``; blank lines and non-objects are bad."""
    good = is_record(value)
    return lines.filter(good), lines.filter(~good)
