"""Helpers that the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def packed(docs: DataFrame, name: str = "_all") -> Column:
    """All columns of a row in one, so that none clashes with those of an operator."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(name)


def unpacked(docs: DataFrame, name: str = "_all") -> list[Column]:
    """The columns of ``docs`` again, from a row packed as ``name``."""
    return [F.col(f"{name}.`{c}`").alias(c) for c in docs.columns]


def crc_mod(key: str | Column, n: int) -> Column:
    """crc32 of a key's text, modulo ``n``; null for a null key."""
    key = F.col(key) if isinstance(key, str) else key
    return F.crc32(key.cast("string").cast("binary")) % n


def held_out(key: str | Column, n: int) -> Column:
    """Whether the remainder is 0; a null key is not held out."""
    return F.coalesce(crc_mod(key, n) == 0, F.lit(False))


def learned(key: str | Column, n: int) -> Column:
    """Whether a row may be learned from; one without a key may not."""
    return F.coalesce(crc_mod(key, n) != 0, F.lit(False))


def total_bytes(docs: DataFrame, text: str = "text") -> int:
    return docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
