"""Outcome of fetching, read from a table of captured responses."""

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, functions as F

from pressmill.functions.decoding import ALL_NAMES, decode_other, decode_single_byte
from pressmill.functions.rules import label
from pressmill.functions.rule_values import NOT_FOUND
from pressmill.schemas import CONTENT_FETCHED, FAILED
from pressmill.session import write_between

# Limits, and the text stored when nothing could decode a body.
MAX_BYTES = 52_428_800
MAX_SECONDS = 300
UNDECODED = "DECODING_ERROR"

# Names of encodings that Spark decodes itself.
UTF_8 = ["utf-8", "utf8", "u8", "utf", "cp65001"]
LATIN_1 = ["iso-8859-1", "iso8859-1", "latin-1", "latin1", "latin", "l1", "8859", "cp819"]
ASCII = ["us-ascii", "ascii", "646"]


def one_response_per_url(responses: DataFrame, newest: str) -> DataFrame:
    """The newest response of every URL, for tables with several captures of one.

    Only URLs and times are aggregated, with map-side combine; bodies move once,
    in the join.  Of captures with equal times all are kept by the join, so
    ``newest`` must tell the captures of a URL apart.
    """
    latest = responses.groupBy("url").agg(F.max(newest).alias(newest))
    return responses.join(latest, ["url", newest], "left_semi")


def _is_scan(df: DataFrame) -> bool:
    """Whether each row is one row of a file, so that its place there tells it from all others."""
    node = df._jdf.queryExecution().analyzed()
    while node.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        node = node.children().head()
    return node.nodeName() == "LogicalRelation"


def addressed(responses: DataFrame) -> DataFrame:
    """``responses`` with ``_file`` and ``_row``, where each row is stored; rows made otherwise are stored first."""
    place = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")]
    if _is_scan(responses):
        try:
            return responses.select("*", *place)
        except AnalysisException:  # a format whose rows have no places
            pass
    return write_between(responses).select("*", *place)


def newest_captures(urls: DataFrame, captures: DataFrame, newest: str | None = None) -> DataFrame:
    """``(url, _file, _row)`` of the newest capture of each URL asked for.

    Reads URLs, times and addresses alone.  Of captures with one highest ``newest``,
    or without such a column, the last by address counts.
    """
    asked = urls.select("url").filter("url IS NOT NULL").distinct()
    found = captures.select("url", *([newest] if newest else []), "_file", "_row").join(asked, "url", "left_semi")
    order = F.struct(*([F.col(newest)] if newest else []), "_file", "_row")
    return found.groupBy("url").agg(F.max(order).alias("_pick")).select("url", "_pick._file", "_pick._row")


def attach_newest(tasks: DataFrame, responses: DataFrame, newest: str | None = None) -> DataFrame:
    """Add ``response`` (null if none) and ``status`` to every task, from a table of captures.

    The capture of each URL is chosen by address, in narrow columns; bodies move once,
    in the join by address, and those over a limit not at all (the response's
    ``capped`` names the limit).  Tasks without a capture stay out of that join, as
    their addresses would all be null.
    """
    captures = addressed(responses)
    picked = newest_captures(tasks, captures, newest).withColumnRenamed("url", "_url")
    placed = write_between(tasks.drop("status").join(picked, F.col("url") == F.col("_url"), "left").drop("_url"))
    capped = cap_label(F.col("headers"), F.col("body"), F.col("elapsed"))
    slim = captures.withColumn("capped", capped).withColumn("body", F.when(F.col("capped").isNull(), F.col("body")))
    fields = [c for c in responses.columns if c != "url"]
    bodies = slim.select(F.col("_file").alias("_at"), F.col("_row").alias("_n"), F.struct(*fields, "capped").alias("response"))
    found = placed.filter(F.col("_file").isNotNull()).join(
        bodies, (F.col("_file") == F.col("_at")) & (F.col("_row") == F.col("_n"))).drop("_at", "_n")
    none = placed.filter(F.col("_file").isNull()).withColumn("response", F.lit(None).cast(bodies.schema["response"].dataType))
    return _with_status(found.unionByName(none).drop("_file", "_row"), responses)


def _with_status(joined: DataFrame, responses: DataFrame) -> DataFrame:
    got = F.col("response").isNotNull()
    if "error_kind" in responses.columns:
        got = got & F.col("response.error_kind").isNull()
    return joined.withColumn("status", F.when(got, CONTENT_FETCHED).otherwise(FAILED))


def attach_responses(tasks: DataFrame, responses: DataFrame) -> DataFrame:
    """Add ``response`` (null if none) and ``status`` to every task.

    ``responses`` holds one row per URL.  The HTTP status code is not looked at:
    an error page with a body counts as fetched.
    """
    packed = responses.select(F.col("url").alias("_url"), F.struct(*[
        c for c in responses.columns if c != "url"
    ]).alias("response"))
    return _with_status(tasks.drop("status").join(packed, F.col("url") == F.col("_url"), "left").drop("_url"), responses)


def header(headers: Column, name: str) -> Column:
    """Header value by name in any case; null if absent."""
    found = F.filter(F.map_entries(headers), lambda e: F.lower(e["key"]) == name)
    return F.get(found, F.lit(0))["value"]


def cap_label(headers: Column, body: Column, elapsed: Column, max_len: int = MAX_BYTES,
              max_time: float = MAX_SECONDS) -> Column:
    """Name of the limit a response breaks, in the order they are checked; else null."""
    length, content_type = header(headers, "content-length"), header(headers, "content-type")
    number = F.trim(length).try_cast("bigint")
    return (
        F.when((length != "") & number.isNull(), "BAD_CONTENT_LENGTH")
        .when(number > max_len, "HEADERS_TOO_LARGE")
        .when(F.startswith(content_type, F.lit("audio/")), "CONTENT_AUDIO")
        .when(F.startswith(content_type, F.lit("video/")), "CONTENT_VIDEO")
        .when(elapsed > max_time, "TOO_LONG")
        .when(F.octet_length(body) > max_len, "TOO_LARGE")
    )


def cap_responses(df: DataFrame, max_len: int = MAX_BYTES, max_time: float = MAX_SECONDS) -> DataFrame:
    """Add ``capped``; a response over a limit makes its row ``FAILED``."""
    capped = cap_label(F.col("headers"), F.col("body"), F.col("elapsed"), max_len, max_time)
    df = df.withColumn("capped", capped)
    if "status" not in df.columns:
        df = df.withColumn("status", F.lit(CONTENT_FETCHED))
    return df.withColumn("status", F.when(F.col("capped").isNotNull(), FAILED).otherwise(F.col("status")))


def decode_body(df: DataFrame, body: str = "body", encoding: str = "encoding") -> DataFrame:
    """Add ``content`` and ``used_encoding``.

    Declared encoding first, then UTF-8, then a fixed text that marks failure;
    such a row still counts as fetched.  UTF-8 and encodings of one byte a character
    are decoded in the JVM; only bodies in another encoding pass through Python.
    """
    raw, declared = F.col(body), F.col(encoding)
    name = F.replace(F.lower(F.trim(declared)), F.lit("_"), F.lit("-"))
    utf8 = F.try_validate_utf8(raw.cast("string"))
    latin1 = F.decode(raw, "ISO-8859-1")
    in_jvm = name.isin(UTF_8 + LATIN_1 + ASCII + ALL_NAMES)
    df = df.withColumn("_other", decode_other(
        F.when(~in_jvm, raw), F.when(~in_jvm, declared)
    ))
    by_declared = (
        F.when(name.isin(UTF_8), utf8)
        .when(name.isin(LATIN_1), latin1)
        .when(name.isin(ASCII) & latin1.rlike(r"\A\p{ASCII}*\z"), latin1)
        .when(name.isin(ALL_NAMES), decode_single_byte(latin1, name))
        .otherwise(F.col("_other"))
    )
    content = F.coalesce(by_declared, utf8, F.when(raw.isNotNull(), UNDECODED))
    used = F.when(by_declared.isNotNull(), declared).when(raw.isNotNull(), "utf-8")
    return df.withColumns({"content": content, "used_encoding": used}).drop("_other")


def fetch_error_label(error_kind: Column, message: Column, content: Column) -> Column:
    """Label of a fetch that gave no page (one row at a time variant); else null."""
    return (
        F.when(error_kind == "ConnectionError", label("requests.exceptions.ConnectionError"))
        .when(error_kind == "ReadTimeout", label("requests.exceptions.ReadTimeout"))
        .when(error_kind == "TooManyRedirects", label("Too Many redirects"))
        .when(error_kind.isNotNull(), F.concat(label(""), F.coalesce(message, error_kind)))
        .when(F.coalesce(F.length(content), F.lit(0)) == 0, label(NOT_FOUND))
    )


def scraping_result(url: Column, content_html: Column, scraped_at: Column | None = None,
                    response: str = "response") -> Column:
    """The nested result kept with an article.

    After a failure only the target and the time are known, as ``response`` is null.
    """
    part = lambda name: F.col(f"{response}.{name}")
    return F.struct(
        url.alias("target_url"),
        part("landing_url").alias("landing_url"),
        content_html.alias("content_html"),
        F.lit(None).cast("string").alias("content_text"),
        part("elapsed").alias("elapsed"),
        part("encoding").alias("encoding"),
        part("headers").alias("headers"),
        part("status_code").alias("status_code"),
        (F.current_timestamp() if scraped_at is None else scraped_at).alias("scraped_at"),
    )


def build_scraping_result(df: DataFrame, scraped_at: Column | None = None) -> DataFrame:
    """Add ``scraping_result``; ``content_id`` refers to the stored page, if any."""
    return df.withColumn(
        "scraping_result", scraping_result(F.col("url"), F.col("content_id"), scraped_at)
    )
