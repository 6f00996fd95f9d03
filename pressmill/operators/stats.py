"""Counts of processing state (A1-A3)."""

from pyspark.sql import DataFrame, functions as F


def _count(articles: DataFrame, key, name: str) -> DataFrame:
    counts = articles.groupBy(key.alias(name)).agg(F.count("*").alias("count"))
    return counts.orderBy(F.desc("count"), F.asc_nulls_last(name))


def count_status(articles: DataFrame) -> DataFrame:
    """Rows per status, most frequent first; a missing status is a group too."""
    return _count(articles, F.col("status"), "status")


def count_status_codes(articles: DataFrame) -> DataFrame:
    """Rows per HTTP status code, most frequent first; null means not fetched."""
    return _count(articles, F.col("scraping_result.status_code"), "status_code")


def diff_counts(previous: DataFrame, new: DataFrame, key: str = "status") -> DataFrame:
    """New counts with the previous ones and the change.

    Statuses that are gone are not shown; a missing status matches itself.
    """
    before = previous.select(F.col(key).alias("_key"), F.col("count").alias("_count"))
    return new.join(before, F.col(key).eqNullSafe(F.col("_key")), "left").select(
        key,
        F.coalesce("_count", F.lit(0)).alias("previous_count"),
        F.col("count").alias("new_count"),
        (F.col("count") - F.coalesce("_count", F.lit(0))).alias("diff"),
    )
