"""Story jobs: search an index, and resolve stories to text."""

from pyspark.sql import DataFrame, functions as F

from pressmill.functions.rules import url_label
from pressmill.operators.extract import resolve_strict
from pressmill.operators.fetch import attach_newest, decode_body
from pressmill.operators.search import collection_domains, search_stories
from pressmill.operators.tasks import gate_label


def story_query(stories: DataFrame, sources: DataFrame, phrase: str, collection_id: int,
                start, end, text: tuple[str, ...] = ("title",)) -> DataFrame:
    """Stories of a source collection that contain a phrase, within dates."""
    return search_stories(stories, collection_domains(sources, collection_id), phrase, start, end, text)


def scrape_stories(stories: DataFrame, responses: DataFrame, english_only: bool = True,
                   newest: str | None = None) -> DataFrame:
    """Stories with ``text``: the article, or the first error on the way to it.

    Stories settled by language or URL are not looked up: they never meet the captures.
    Each other one takes one response, the newest of its URL by the column ``newest``.
    Bodies move once, by address, and are decoded and parsed in the stage after it.
    """
    names = ["landing_url", "status_code", "headers", "encoding", "body", "elapsed", "error_kind"]
    settled = F.coalesce(gate_label(english_only), url_label("url")).isNotNull()
    captured = responses.select("url", *names, *([newest] if newest and newest not in names else []))
    # every column of a story goes along in one, so that none clashes with those of a response
    packed = stories.select("url", settled.alias("_settled"), F.struct(*stories.columns).alias("_story"))
    found = attach_newest(packed.filter("NOT _settled").drop("_settled"), captured, newest)
    fields = [F.col(f"response.{name}").alias(name) for name in names]
    looked_up = found.select("_story.*", *fields)
    types = {name: looked_up.schema[name].dataType for name in names}
    alone = packed.filter("_settled").select("_story.*", *[F.lit(None).cast(types[name]).alias(name) for name in names])
    resolved = resolve_strict(decode_body(looked_up.unionByName(alone)), english_only)
    return resolved.select(*stories.columns, "text")
