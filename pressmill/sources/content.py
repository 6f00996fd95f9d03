"""Page bodies kept apart from the articles.

Bodies lie in one folder per kind and batch of their articles.  Where references have a
``batch_id``, lookups join by batch too, so that Spark prunes the folders of other
batches when it has seen the references, or at once if it is told the batches.
"""

from pyspark.sql import Column, DataFrame, functions as F

from pressmill.schemas import PAGE_CONTENT


def content_id(article_id: Column, kind: str, tries: Column) -> Column:
    """Id of the body stored by one attempt; a new attempt makes a new id."""
    return F.sha2(F.concat_ws("|", article_id.cast("string"), F.lit(kind), tries.cast("string")), 256)


# Bodies of articles without a batch.
NO_BATCH = -1


def batch_of(articles: DataFrame) -> Column:
    """Number of the folder that an article's bodies go to."""
    if "batch_id" not in articles.columns:
        return F.lit(NO_BATCH).cast("bigint")
    return F.coalesce(F.col("batch_id").cast("bigint"), F.lit(NO_BATCH).cast("bigint"))


def put_content(articles: DataFrame, body: str, kind: str, url: str = "url",
                tries: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows to append to the content table, and the articles with their reference.

    Returns ``(content, refs)``; ``refs`` is the input without the body and with
    ``content_id``, which is null where there was nothing to store.  Both are
    narrow: the id is computed, not looked up.
    """
    tries = F.coalesce(F.col("tries"), F.lit(0)) if tries is None else tries
    stored = F.when(F.octet_length(body) > 0, content_id(F.col("article_id"), kind, tries))
    with_id = articles.withColumn("content_id", stored)
    content = with_id.filter(F.col("content_id").isNotNull()).select(
        "content_id",
        F.col("article_id").cast("string").alias("article_id"),
        F.col(url).alias("target_url"),
        F.lit(kind).alias("kind"),
        F.col(body).alias("body"),
        batch_of(with_id).alias("batch"),
    )
    return content, with_id.drop(body)


def append_content(content: DataFrame, path: str) -> None:
    """Append bodies, one folder per kind and batch, so that a reader of some skips the others."""
    content.write.mode("append").partitionBy("kind", "batch").parquet(path)


def read_content(spark, path: str, kind: str | None = None, batches: list[int | None] | None = None) -> DataFrame:
    """Stored bodies, of one kind and of some batches if these are given."""
    content = spark.read.schema(PAGE_CONTENT).parquet(path)
    if kind is not None:
        content = content.filter(F.col("kind") == kind)
    if batches is not None:
        content = content.filter(F.col("batch").isin([NO_BATCH if b is None else b for b in batches]))
    return content


def _matched(refs: DataFrame, content: DataFrame, ref: str, *columns: Column) -> tuple[DataFrame, Column]:
    """Narrowed content, and the condition that finds the rows of references in it."""
    by_batch = "batch_id" in refs.columns and "batch" in content.columns
    found = content.select(F.col("content_id").alias("_id"), *columns, *([F.col("batch").alias("_batch")] if by_batch else []))
    match = F.col(ref) == F.col("_id")
    return found, match & (batch_of(refs) == F.col("_batch")) if by_batch else match


def get_content(refs: DataFrame, content: DataFrame, ref: str = "content_id") -> DataFrame:
    """Add ``body`` by reference; null where nothing was stored.

    Rows with a body come from `stored_bodies`; the others are found by an anti
    join on ids alone.
    """
    ids, match = _matched(refs, content, ref)
    absent = refs.join(ids, match, "left_anti")
    return stored_bodies(refs, content, ref).unionByName(absent.withColumn("body", F.lit(None).cast("string")))


def stored_bodies(refs: DataFrame, content: DataFrame, ref: str = "content_id") -> DataFrame:
    """Rows whose body is stored, with ``body``.

    An inner join on a hash key: Spark broadcasts the references where they are
    small enough, so that no body is moved, and otherwise a run-time bloom filter
    can drop unwanted bodies before the shuffle.
    """
    bodies, match = _matched(refs, content, ref, F.col("body"))
    return refs.join(bodies, match).select(*refs.columns, "body")


def content_info(refs: DataFrame, content: DataFrame, ref: str = "content_id") -> DataFrame:
    """Add the stored attributes by reference; the body column is never read."""
    info, match = _matched(
        refs, content, ref, F.col("article_id").alias("stored_article_id"),
        F.col("target_url").alias("stored_url"), F.col("kind").alias("stored_kind"))
    return refs.join(info, match, "left").select(*refs.columns, "stored_article_id", "stored_url", "stored_kind")
