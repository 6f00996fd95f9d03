"""Inputs of the registered queries, derived from the driver's tables.

Each derivation is plain SQL, so that DuckDB can repeat it in `oracles`.
"""

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pressmill.functions import rule_values
from pressmill.session import shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def folder(spark: SparkSession) -> str:
    """A fresh folder that all executors share."""
    return "/".join([shared_folder(spark).rstrip("/"), "pressmill",
                     spark.sparkContext.applicationId, uuid.uuid4().hex])


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles with state, from events."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id AS article_id",
        "event_type AS status",
        "concat('u', CAST(user_id AS STRING)) AS media_url",
        "concat('https://u', CAST(user_id AS STRING), '.example/', CAST(event_id AS STRING)) AS url",
        "event_id % 7 AS batch_id",
        "CAST(event_id % 8 AS INT) AS tries",
        "value",
    )


def scraped_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles with a nested result whose status code is null for one in five."""
    code = """CASE event_id % 5 WHEN 0 THEN 200 WHEN 1 THEN 404 WHEN 2 THEN 200
              WHEN 3 THEN 503 END"""
    rows = table(spark, sf_dir, "events").selectExpr("*", f"CAST({code} AS INT) AS status_code")
    return rows.selectExpr(
        "event_id AS article_id",
        "event_type AS status",
        "CAST(event_id % 8 AS INT) AS tries",
        """named_struct('target_url', concat('https://x.example/', CAST(event_id AS STRING)),
             'status_code', status_code, 'content_html', CAST(NULL AS STRING),
             'content_text', CAST(NULL AS STRING)) AS scraping_result""",
    )


def stories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stories from documents."""
    return table(spark, sf_dir, "documents").selectExpr(
        "doc_id", "text", "lang AS language", "source AS domain",
        "concat('https://', source, '.example/', CAST(doc_id AS STRING)) AS url",
        "substring_index(text, '\n', 1) AS title",
        "CAST(date_add(DATE '2024-01-01', CAST(doc_id % 30 AS INT)) AS STRING) AS publication_date",
    )


def needles(rules, kinds=("any", "all", "equals", "ends"), field: str | None = None) -> list[str]:
    """Needles of a rule table in order."""
    return [needle for _, tests in rules for f, kind, values in tests
            if kind in kinds and field in (None, f) for needle in values]


URL_NEEDLES = needles(rule_values.URL_RULES)
TEXT_NEEDLES = needles(rule_values.PAGE_TEXT_RULES)
EMPTY_URL_NEEDLES = needles(rule_values.EMPTY_PAGE_RULES, field="url")
EMPTY_TEXT_NEEDLES = needles(rule_values.EMPTY_PAGE_RULES, field="text")
LAST_NEEDLES = needles(rule_values.LAST_RESORT_RULES)


def pick(values: list[str], index: str) -> Column:
    """``values[index]`` for a 0-based SQL index expression."""
    return F.get(F.array(*[F.lit(v) for v in values]), F.expr(f"CAST({index} AS INT)"))


def escape(text: str) -> str:
    """SQL expression of a text with its HTML characters escaped."""
    return f"replace(replace(replace({text}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


def html_lines(text: str) -> str:
    """SQL expression of a page with one paragraph per line of a text."""
    lines = f"replace({escape(text)}, '\n', '</p><p>')"
    return f"concat('<html><head><script>var a=1;</script></head><body><p>', {lines}, '</p></body></html>')"
