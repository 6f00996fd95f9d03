"""A stored index of words in stories, so that a phrase is found without reading texts (Q2).

A folder holds

* ``stories``: the stories by day, each as one struct, numbered as they are written,
* ``postings``: a row for each place of a word in a field of a story, by buckets of words
  and sorted in them, so that a search opens the buckets of its words alone,
* ``words``: how often a word occurs in a field,
* ``columns``: no rows, but the columns of a story.

A word is a run of word characters in lower case.  A place is twice the number of the
word in its text, plus one if only white space parts it from the word before; that is
what a phrase of plain words needs to know, so its stories' texts are never read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pressmill.operators.search import has_phrase
from pressmill.session import task_bytes

BUCKETS = 64
# packed postings a task takes; unpacked and sorted they are about twelve times as much
TASK_BYTES = 32 << 20
# a row's address among the stored stories
ADDRESS = ["_day", "_id"]
POSTING = "word string, _day date, _id long, _field string, place int, bucket int"
# what comes before a word, and the word
PIECES = "(?U)\\W*\\w+"


def _bucket(word: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(buckets)).cast("int")


def _pieces(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(PIECES), F.lit(0))


def _word(piece: Column) -> Column:
    return F.regexp_replace(piece, "(?U)^\\W+", "")


def _stored(spark: SparkSession, path: str) -> DataFrame:
    # an index of no stories has no files to tell the columns
    columns = spark.read.parquet(f"{path}/columns").schema.add("_id", "long").add("_day", "date")
    return spark.read.schema(columns).parquet(f"{path}/stories").select(*ADDRESS, "_story")


def _by_bucket(places: DataFrame, buckets: int) -> DataFrame:
    """Words of a text by bucket, joined by blanks, and their places beside them: short rows to move.

    A text's words are sorted and cut where the bucket changes, all inside its row.
    """
    own = [c for c in places.columns if c != "_places"]
    ordered = places.where(F.size("_places") > 0).select(*own, F.sort_array(F.transform("_places", lambda p: F.struct(
        _bucket(p["word"], buckets).alias("bucket"), p["word"].alias("word"), p["place"].alias("place")))).alias("_sorted"))
    bucket = lambda at: F.get("_sorted", at)["bucket"]
    cut = ordered.select(*own, "_sorted", F.filter(
        F.sequence(F.lit(0), F.size("_sorted")),
        lambda at: (at == 0) | (at == F.size("_sorted")) | (bucket(at) != bucket(at - 1))).alias("_cuts"))
    group = F.explode(F.transform(
        F.slice("_cuts", F.lit(2), F.size("_cuts") - 1),
        lambda end, i: F.slice("_sorted", F.get("_cuts", i) + 1, end - F.get("_cuts", i))))
    return cut.select(*own, group.alias("_g")).select(
        F.get("_g.bucket", F.lit(0)).alias("bucket"), *own,
        F.array_join("_g.word", " ").alias("_words"), F.col("_g.place").alias("place"))


def _postings(texts: DataFrame, buckets: int) -> DataFrame:
    """A row for each place of a word, its bucket's rows together."""
    pieces = texts.select(*ADDRESS, "_field", _pieces(F.col("_text")).alias("_pieces"))
    spaced = lambda piece: piece.rlike("(?U)^\\s+\\w").cast("int")
    places = pieces.select(*ADDRESS, "_field", F.transform("_pieces", lambda p, i: F.struct(
        _word(p).alias("word"), (2 * i + spaced(p)).alias("place"))).alias("_places"))
    return _by_bucket(places, buckets).hint("rebalance", "bucket") \
        .select("bucket", *ADDRESS, "_field", F.explode(F.arrays_zip(F.split("_words", " ").alias("word"), F.col("place"))).alias("_p")) \
        .select("_p.word", *ADDRESS, "_field", "_p.place", "bucket")


def write_phrase_index(stories: DataFrame, path: str, text: tuple[str, ...] = ("title",),
                       date: str = "publication_date", buckets: int = BUCKETS) -> None:
    """Write the index of ``text`` columns to ``path``, in place of one that is there.

    All stories are kept, repeated ones too; a story whose date is none is stored and
    never found, as by `search_stories`.  Any column names will do.  Places are moved
    once, to their buckets, one row for a text and bucket; so a frequent word is no hot
    key, and a bucket too large for one task is cut.
    """
    spark = stories.sparkSession
    packed = stories.select(F.struct(*[F.col(f"`{c}`") for c in stories.columns]).alias("_story"))
    dated = packed.withColumn("_day", F.col(f"_story.`{date}`").try_cast("date"))
    packed.limit(0).write.mode("overwrite").parquet(f"{path}/columns")
    dated.hint("rebalance", "_day").withColumn("_id", F.monotonically_increasing_id()) \
        .write.mode("overwrite").partitionBy("_day").parquet(f"{path}/stories")
    # a story's address is fixed once it is written
    stored = _stored(spark, path).where("_day IS NOT NULL")
    fields = F.explode(F.array(*[
        F.struct(F.lit(c).alias("_field"), F.col(f"_story.`{c}`").cast("string").alias("_text")) for c in text]))
    texts = stored.select(*ADDRESS, fields.alias("_f")).select(*ADDRESS, "_f._field", "_f._text")
    with task_bytes(spark, TASK_BYTES):
        _postings(texts, buckets).sortWithinPartitions("bucket", "word", *ADDRESS, "_field", "place") \
            .write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/postings")
    words = spark.read.schema(POSTING).parquet(f"{path}/postings").groupBy("bucket", "word", "_field").agg(F.count("*").alias("n"))
    words.withColumn("_buckets", F.lit(buckets)).write.mode("overwrite").parquet(f"{path}/words")


def _phrase_words(spark: SparkSession, phrase: str, buckets: int) -> list[tuple[str, int]]:
    """Words of a phrase and their buckets, cut as texts are."""
    row = spark.range(1).select(F.transform(_pieces(F.lit(phrase)), _word).alias("w")) \
        .select(F.transform("w", lambda w: F.struct(w, _bucket(w, buckets))).alias("w")).first()
    return [tuple(w) for w in row["w"]]


def search_phrase_index(spark: SparkSession, path: str, domains: DataFrame, phrase: str, start, end,
                        text: tuple[str, ...] = ("title",), domain: str = "domain") -> DataFrame:
    """The rows that `search_stories` finds, by the index at ``path``.

    Postings of the phrase's rarest word are read first and those of the others joined
    to them in rising number, each keeping the places where the phrase may begin.  The
    joins are on address and place; Spark broadcasts the side that is small.  A phrase with
    other than word characters is looked for in the texts of the stories left; one
    without any is looked for in all texts of the days.
    """
    day = F.col("_day").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    stories = _stored(spark, path).where(day)
    columns = [F.col(f"_story.`{c}`").alias(c) for c in stories.schema["_story"].dataType.names]
    known = spark.read.parquet(f"{path}/words")
    any_row = known.select("_buckets").first()
    words = _phrase_words(spark, phrase, any_row["_buckets"]) if any_row else []
    phrases = [has_phrase(F.coalesce(F.col(f"_story.`{c}`"), F.lit("")), phrase) for c in text]
    in_text = reduce(lambda left, right: left | right, phrases)
    if words:
        spelled = " ".join(w for w, _ in words)
        plain = spelled == " ".join(phrase.lower().split())
        wanted = F.col("_field").isin(*text)
        counts = {r["word"]: r["n"] for r in known.where(F.col("word").isin(*[w for w, _ in words]) & wanted)
                  .groupBy("word").agg(F.sum("n").alias("n")).collect()}
        order = sorted(range(len(words)), key=lambda i: (counts.get(words[i][0], 0), i))
        postings = spark.read.schema(POSTING).parquet(f"{path}/postings").where(day & wanted)

        def begins(i: int) -> DataFrame:
            """Where the phrase would begin, by its word ``i``."""
            word, bucket = words[i]
            rows = postings.where((F.col("bucket") == bucket) & (F.col("word") == word))
            if plain and i:
                rows = rows.where(F.col("place") % 2 == 1)
            return rows.select(*ADDRESS, "_field", (F.floor(F.col("place") / 2).cast("int") - i).alias("_begin"))

        found = begins(order[0])
        for i in order[1:]:
            found = found.join(begins(i), [*ADDRESS, "_field", "_begin"], "left_semi")
        stories = stories.join(found.select(*ADDRESS), ADDRESS, "left_semi")
        in_text = F.lit(True) if plain else in_text
    found = stories.where(in_text)
    return found.join(domains, F.col(f"_story.`{domain}`") == domains["name"], "left_semi").select(*columns)
