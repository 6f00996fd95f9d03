"""Status counts and their changes, refreshed as a stream (A4).

The newest status of every article is kept as a table in buckets of ids: a *base*, and
a *delta* for each refresh since.  A refresh takes the newest change of each article
from its rows, looks up what was known of these articles in the buckets they fall
into, adds the difference to the counts, and writes what is new as its delta.  Every
``BASE_EVERY`` refreshes base and deltas are merged into a new base.  All of it is
joins and aggregates; nothing passes through Python.

Which tables a refresh reads follows from its number alone, and it only writes tables
of that number, so a refresh repeated after a failure gives the same.  Tables that
neither it nor a later one reads are removed.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from pressmill.operators.stats import diff_counts
from pressmill.schemas import STATUS_CHANGE
from pressmill.session import remove_folder

COUNTS = "status string, count bigint"
STATE = "article_id string, version bigint, status string, bucket int"
# number of buckets, and of refreshes between merges
BUCKETS, BASE_EVERY = 64, 8


def read_changes(spark: SparkSession, path: str, files_per_refresh: int | None = None) -> DataFrame:
    """Stream of status changes ``(article_id, version, status)`` from Parquet files."""
    reader = spark.readStream.schema(STATUS_CHANGE)
    if files_per_refresh:
        reader = reader.option("maxFilesPerTrigger", files_per_refresh)
    return reader.parquet(path)


def changes_between(before: DataFrame | None, after: DataFrame, version: int) -> DataFrame:
    """Rows for the change log: articles of a table whose status is not that of its last version."""
    rows = after.select("article_id", F.lit(version).cast("bigint").alias("version"), "status")
    if before is None:
        return rows
    old = before.select(F.col("article_id").alias("_id"), F.col("status").alias("_was"), F.lit(True).alias("_known"))
    joined = rows.join(old, F.col("article_id") == F.col("_id"), "left")
    return joined.filter(F.col("_known").isNull() | ~F.col("status").eqNullSafe(F.col("_was"))).select(rows.columns)


def newest_status(changes: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """The change of the highest version of each article; of one version the last status in order."""
    newest = changes.groupBy("article_id").agg(F.max(F.struct("version", "status")).alias("_newest"))
    bucket = F.pmod(F.xxhash64("article_id"), F.lit(buckets)).cast("int")
    return newest.select("article_id", "_newest.version", "_newest.status", bucket.alias("bucket"))


def advance(newest: DataFrame, known: DataFrame) -> DataFrame:
    """Changes that are newer than what is known, with ``was`` and ``is_new``.

    Changes that arrive late or twice carry an old version and drop out.  ``known``
    has one row per article.
    """
    old = known.select(F.col("article_id").alias("_id"), F.col("bucket").alias("_bucket"),
                       F.col("version").alias("_version"), F.col("status").alias("was"), F.lit(True).alias("_known"))
    joined = newest.join(old, F.col("article_id").eqNullSafe(F.col("_id")) & (F.col("bucket") == F.col("_bucket")), "left")
    newer = F.col("_known").isNull() | F.coalesce(F.col("version") > F.col("_version"), F.col("_version").isNull() & F.col("version").isNotNull())
    return joined.filter(newer).select("article_id", "version", "status", "bucket", "was", F.col("_known").isNull().alias("is_new"))


def count_changes(advanced: DataFrame) -> DataFrame:
    """``(status, count)`` to add to the counts."""
    one = lambda status, n: F.struct(F.col(status).alias("status"), F.lit(n).cast("bigint").alias("count"))
    steps = F.when(F.col("is_new"), F.array(one("status", 1))).when(
        ~F.col("status").eqNullSafe(F.col("was")), F.array(one("was", -1), one("status", 1)))
    return advanced.select(F.explode(steps).alias("step")).groupBy("step.status").agg(F.sum("step.count").alias("count"))


class ProgressState:
    """The tables behind the counts, in ``folder``."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int = BUCKETS, base_every: int = BASE_EVERY):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.buckets, self.base_every = buckets, base_every

    def path(self, kind: str, n: int) -> str:
        return f"{self.folder}/{kind}/{n}"

    def base_before(self, n: int) -> int:
        """Number of the last base that refresh ``n`` reads; -1 for none."""
        return n // self.base_every * self.base_every - 1

    def tables_before(self, n: int) -> list[str]:
        base = self.base_before(n)
        return [*([self.path("base", base)] if base >= 0 else []), *[self.path("delta", k) for k in range(base + 1, n)]]

    def known(self, n: int, asked: DataFrame | None = None, buckets: list[int] | None = None) -> DataFrame:
        """One row per article as refresh ``n`` finds it; only those ``asked`` for, which are in ``buckets``.

        Files of other buckets are not read, and rows of other articles not shuffled
        if Spark can broadcast the ids.
        """
        rows = None
        for path in self.tables_before(n):
            part = self.spark.read.schema(STATE).parquet(path)
            rows = part if rows is None else rows.unionByName(part)
        if rows is None:
            return self.spark.createDataFrame([], STATE)
        if asked is not None:
            ids = asked.select(F.col("article_id").alias("_id"), F.col("bucket").alias("_bucket"))
            rows = rows.filter(F.col("bucket").isin(buckets)).join(
                ids, F.col("article_id").eqNullSafe(F.col("_id")) & (F.col("bucket") == F.col("_bucket")), "left_semi")
        return self._one_per_article(rows)

    @staticmethod
    def _one_per_article(rows: DataFrame) -> DataFrame:
        newest = rows.groupBy("bucket", "article_id").agg(F.max(F.struct("version", "status")).alias("_newest"))
        return newest.select("article_id", "_newest.version", "_newest.status", "bucket")

    def counts(self, n: int) -> DataFrame:
        if n < 0:
            return self.spark.createDataFrame([], COUNTS)
        return self.spark.read.schema(COUNTS).parquet(self.path("counts", n))

    def _write(self, rows: DataFrame, kind: str, n: int) -> None:
        rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(self.path(kind, n))

    def refresh(self, changes: DataFrame, n: int) -> DataFrame:
        """Bring state and counts up to date with the changes of refresh ``n``; the differences."""
        newest = newest_status(changes, self.buckets).persist()
        touched = sorted(r[0] for r in newest.select("bucket").distinct().collect())
        advanced = advance(newest, self.known(n, newest, touched))
        self._write(advanced.select("article_id", "version", "status", "was", "is_new", "bucket"), "delta", n)
        newest.unpersist()
        written = self.spark.read.schema(f"{STATE}, was string, is_new boolean").parquet(self.path("delta", n))
        previous = self.counts(n - 1)
        merged = previous.unionByName(count_changes(written)).groupBy("status").agg(F.sum("count").alias("count"))
        merged.filter("count <> 0").coalesce(1).write.mode("overwrite").parquet(self.path("counts", n))
        if (n + 1) % self.base_every == 0:
            self._write(self.known_after(n), "base", n)
        self._remove_before(n)
        return diff_counts(previous, self.counts(n))

    def known_after(self, n: int) -> DataFrame:
        """One row per article as refresh ``n`` leaves it."""
        return self._one_per_article(self.known(n).unionByName(self.spark.read.schema(STATE).parquet(self.path("delta", n))))

    def _remove_before(self, n: int) -> None:
        """Remove what only refreshes before ``n`` read; refresh ``n`` itself may be repeated."""
        base = self.base_before(n)
        remove_folder(self.spark, self.path("counts", n - 2))
        if n > 0 and base == n - 1:
            for k in range(base - self.base_every + 1, base + 1):
                remove_folder(self.spark, self.path("delta", k))
            remove_folder(self.spark, self.path("base", base - self.base_every))


def progress_stream(changes: DataFrame, folder: str, on_refresh=None, seconds: int | None = 5,
                    buckets: int = BUCKETS, base_every: int = BASE_EVERY):
    """Start the refresh loop over a stream of changes.

    Every ``seconds`` (None: once through all that is available) the counts are
    brought up to date and their differences given to ``on_refresh(diff, n)``, to be
    used before the next refresh.  At the first one the previous counts are 0.  ``folder``, which all executors share, keeps the stream's checkpoint and
    the state, so that a restart goes on where it was; ``buckets`` and ``base_every``
    must then be the same.
    """
    state = ProgressState(changes.sparkSession, folder, buckets, base_every)

    def refresh(rows: DataFrame, n: int) -> None:
        diff = state.refresh(rows.select("article_id", "version", "status"), n)
        if on_refresh is not None:
            on_refresh(diff, n)

    writer = changes.writeStream.foreachBatch(refresh).option("checkpointLocation", f"{state.folder}/checkpoint")
    writer = writer.trigger(availableNow=True) if seconds is None else writer.trigger(
        processingTime=f"{seconds} seconds")
    return writer.start()
