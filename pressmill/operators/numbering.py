"""Exact row numbers without a window over the whole table."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from pressmill.session import write_between

_ROW_BITS = 33  # monotonically_increasing_id keeps the row in the low 33 bits


def in_order(df: DataFrame, *order: Column | str) -> DataFrame:
    """Range-partition and sort by ``order``; add ``_part`` and ``_at``.

    ``_part`` numbers the ranges in order and ``_at`` the rows within a range.
    Ranges are cut from a sample of the keys, so they are even as long as
    ``order`` ends in a unique column.  The result is written once, because both
    numbers depend on where the ranges were cut; so pass only the columns needed.
    """
    row_id = F.monotonically_increasing_id()
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return write_between(
        ranged.withColumn("_id", row_id)
        .withColumn("_part", F.shiftright("_id", _ROW_BITS).cast("int"))
        .withColumn("_at", F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
        .drop("_id")
    )


def add_totals_before(df: DataFrame, totals: DataFrame, total: str, by: list[str]) -> DataFrame:
    """Join to each row the sum of ``total`` over the earlier ranges, as ``_before``.

    ``totals`` has one row per range and ``by`` value in it; Spark broadcasts it if
    its size allows.
    """
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(
        *by, "_part", F.coalesce(F.sum(total).over(earlier), F.lit(0)).cast("bigint").alias("_before")
    )
    return df.join(before, [*by, "_part"])


def number_rows(df: DataFrame, *order: Column | str, name: str = "position") -> DataFrame:
    """Add the 0-based position of each row in ``order``, which must be total.

    One range shuffle; then only one count per range is gathered.
    """
    ranged = in_order(df, *order)
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_size"))
    return (
        add_totals_before(ranged, sizes, "_size", [])
        .withColumn(name, F.col("_before") + F.col("_at"))
        .drop("_part", "_at", "_before")
    )
