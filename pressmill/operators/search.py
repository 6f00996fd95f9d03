"""Story search by phrase, source collection and date (Q1, Q2)."""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from pressmill.functions.text import regex_literal


def collection_domains(sources: DataFrame, collection_id: int) -> DataFrame:
    """All source names of a collection, repeats kept."""
    return sources.filter(F.col("collection_id") == collection_id).select("name")


def has_phrase(text: Column, phrase: str) -> Column:
    """The whole phrase occurs, in any case, not inside a longer word.

    Its longest word is looked for first, which is far cheaper than the regular
    expression and settles most texts.
    """
    words, text = phrase.lower().split(), F.lower(text)
    pattern = "\\s+".join(regex_literal(word) for word in words)
    return F.contains(text, F.lit(max(words, key=len))) & text.rlike(f"(?U)(?<!\\w){pattern}(?!\\w)")


def search_stories(stories: DataFrame, domains: DataFrame, phrase: str, start, end,
                   text: tuple[str, ...] = ("title",), domain: str = "domain",
                   date: str = "publication_date") -> DataFrame:
    """Stories with the phrase, from one of the domains, within the dates.

    Both end dates count.  Repeated stories stay, and repeated domain names add
    nothing: the join is a semi join.  A date that is none does not count, and the
    cheap date test comes first; it reaches the scan if the column is a DATE.  The
    domain list is broadcast by Spark only if its size allows;
    else the join shuffles and AQE splits a hot domain.
    """
    day = F.col(date).try_cast("date")
    phrases = [has_phrase(F.coalesce(F.col(c), F.lit("")), phrase) for c in text]
    found = stories.filter(
        day.between(F.lit(start).cast("date"), F.lit(end).cast("date"))
        & reduce(lambda left, right: left | right, phrases)
    )
    return found.join(domains, F.col(domain) == domains["name"], "left_semi")
