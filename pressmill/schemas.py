"""Explicit schemas of the tables; nothing is inferred."""

from pyspark.sql import types as T

# Processing states of an article.
UNPROCESSED = "UNPROCESSED"
CONTENT_FETCHED = "CONTENT-FETCHED"
CONTENT_EXTRACTED = "CONTENT-EXTRACTED"
DENYLISTED = "DENYLISTED"
FAILED = "FAILED"

TAGS = T.ArrayType(T.MapType(T.StringType(), T.StringType()))
STRINGS = T.MapType(T.StringType(), T.StringType())


def table(**columns: T.DataType) -> T.StructType:
    """Schema with nullable columns."""
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


STORY = table(
    title=T.StringType(), publication_date=T.StringType(), capture_time=T.StringType(),
    language=T.StringType(), domain=T.StringType(), url=T.StringType(),
    original_capture_url=T.StringType(), archive_playback_url=T.StringType(),
    article_url=T.StringType(),
)

SOURCE = table(collection_id=T.LongType(), name=T.StringType())

METADATA = table(
    date_guess_method=STRINGS, extractor_version=STRINGS, geocoder_version=STRINGS,
    nyt_themes_version=STRINGS,
)

SCRAPING_RESULT = table(
    target_url=T.StringType(), landing_url=T.StringType(), content_html=T.StringType(),
    content_text=T.StringType(), elapsed=T.DoubleType(), encoding=T.StringType(),
    headers=STRINGS, status_code=T.IntegerType(), scraped_at=T.TimestampType(),
)

# Article fields read from a record.  The key must be present where marked,
# though its value may be null.
STRING, INTEGER, BOOLEAN, OBJECT, LIST = "string", "integer", "boolean", "object", "list"
ARTICLE_FIELDS = [
    # field, kind, key required
    ("ap_syndicated", BOOLEAN, True),
    ("collect_date", STRING, True),
    ("feeds", STRING, False),
    ("guid", STRING, True),
    ("language", STRING, True),
    ("media_id", INTEGER, True),
    ("media_name", STRING, True),
    ("media_url", STRING, True),
    ("processed_stories_id", INTEGER, True),
    ("publish_date", STRING, False),
    ("stories_id", INTEGER, True),
    ("story_tags", LIST, False),
    ("title", STRING, True),
    ("url", STRING, True),
    ("word_count", INTEGER, False),
    ("metadata", OBJECT, True),
]

ARTICLE = table(
    article_id=T.StringType(), ap_syndicated=T.BooleanType(), collect_date=T.StringType(),
    feeds=T.StringType(), guid=T.StringType(), lang=T.StringType(), media_id=T.LongType(),
    media_name=T.StringType(), media_url=T.StringType(), processed_stories_id=T.LongType(),
    publish_date=T.StringType(), stories_id=T.LongType(), story_tags=TAGS,
    title=T.StringType(), url=T.StringType(), word_count=T.LongType(), metadata=METADATA,
    batch_id=T.LongType(), imported_from=T.StringType(), imported_at=T.TimestampType(),
    scraping_result=SCRAPING_RESULT, status=T.StringType(), tries=T.IntegerType(),
)

# Columns that the first extraction adds to an article.
EXTRACTION = table(
    text_extracted=T.BooleanType(), abstract=T.StringType(), parsing_error=T.StringType(),
)

PAGE_CONTENT = table(
    content_id=T.StringType(), article_id=T.StringType(), target_url=T.StringType(),
    kind=T.StringType(), body=T.StringType(), batch=T.LongType(),
)

RESPONSE = table(
    url=T.StringType(), landing_url=T.StringType(), status_code=T.IntegerType(),
    headers=STRINGS, encoding=T.StringType(), body=T.BinaryType(), elapsed=T.DoubleType(),
    error_kind=T.StringType(),
)

STATUS_CHANGE = table(
    article_id=T.StringType(), version=T.LongType(), status=T.StringType(),
)
