"""Processing state of articles, as snapshots."""

from pyspark.sql import DataFrame, functions as F

from pressmill.schemas import EXTRACTION
from pressmill.session import write_between


def _last_update(updates: DataFrame, fields: list[str], newest: str | None) -> DataFrame:
    """One row per article: its last update and how many there were.

    The aggregation uses the key of the join that follows, so the updates are
    shuffled once for both.
    """
    packed = F.struct(*fields)
    last = F.max_by(packed, newest) if newest else F.any_value(packed)
    return updates.groupBy("article_id").agg(last.alias("_new"), F.count("*").alias("_tries"))


def _join_updates(articles: DataFrame, updates: DataFrame, fields, newest) -> DataFrame:
    joined = articles.join(_last_update(updates, fields, newest), "article_id", "left")
    tries = F.coalesce("tries", F.lit(0)) + F.coalesce("_tries", F.lit(0))
    kept = F.when(F.col("_tries").isNull(), F.col("tries")).otherwise(tries)
    return joined.withColumn("tries", kept.cast(articles.schema["tries"].dataType))


def apply_scrape(articles: DataFrame, outcome: DataFrame, newest: str | None = None) -> DataFrame:
    """Set ``status``, replace ``scraping_result`` and count a try, by article id.

    Failed fetches are applied as well.  If an article has several outcomes, each
    counts as a try and the one with the highest ``newest`` stays.
    """
    joined = _join_updates(articles, outcome, ["status", "scraping_result"], newest)
    done = F.col("_tries").isNotNull()
    return joined.withColumns({
        name: F.when(done, F.col(f"_new.{name}")).otherwise(F.col(name))
        for name in ("status", "scraping_result")
    }).select(*articles.columns)


def apply_extraction(articles: DataFrame, extracted: DataFrame, newest: str | None = None) -> DataFrame:
    """Set the extraction columns and the reference to the text, by article id.

    Only ``content_text`` changes inside ``scraping_result``; the status does not
    change, and extraction counts as a try too.
    """
    for field in EXTRACTION:
        if field.name not in articles.columns:
            articles = articles.withColumn(field.name, F.lit(None).cast(field.dataType))
    names = [field.name for field in EXTRACTION]
    joined = _join_updates(articles, extracted, [*names, "content_text"], newest)
    done = F.col("_tries").isNotNull()
    new_result = F.col("scraping_result").withField("content_text", F.col("_new.content_text"))
    return joined.withColumns({
        **{name: F.when(done, F.col(f"_new.{name}")).otherwise(F.col(name)) for name in names},
        "scraping_result": F.when(done, new_result).otherwise(F.col("scraping_result")),
    }).select(*articles.columns)


def write_snapshot(articles: DataFrame, path: str) -> None:
    """Write a new version of the table, one folder per batch.

    Never give the path that ``articles`` was read from.
    """
    articles.write.mode("errorifexists").partitionBy("batch_id").parquet(path)


def replace_batches(articles: DataFrame, path: str) -> None:
    """Write the batches in ``articles`` over those of the table; others stay untouched.

    Lets a job rewrite only the batches it worked on, given whole: one of another
    number of rows than the stored one is refused before anything is written.  The rows
    are written apart first, so they may come from the same table.  See `BatchTable` for
    versions, which readers can hold on to.
    """
    new = write_between(articles)
    stored = new.sparkSession.read.schema(articles.schema).parquet(path)
    sizes = lambda df, name: df.groupBy(F.col("batch_id").alias(f"_{name}")).agg(F.count("*").alias(name))
    given = sizes(new, "given").join(sizes(stored, "kept"), F.col("_given").eqNullSafe(F.col("_kept")))
    wrong = given.filter("given <> kept").select("_given", "given", "kept").limit(5).collect()
    if wrong:
        raise ValueError("batches not given whole: " + ", ".join(f"{b} ({g} of {k} rows)" for b, g, k in wrong))
    new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy("batch_id").parquet(path)
