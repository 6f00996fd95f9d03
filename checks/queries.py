"""One query per operator, over the driver's tables."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from checks import inputs
from checks.inputs import articles, folder, pick, scraped_articles, stories, table
from pressmill.functions import rules
from pressmill.operators import extract, fetch, html, imports, search, state, stats, tasks
from pressmill.plans.articles import extract_batch, extract_plan, fetch_plan, import_batch, scrape_batch, run_extract, run_import, run_scrape
from pressmill.sources.batches import BatchTable
from pressmill.plans.stories import scrape_stories, story_query
from pressmill.schemas import ARTICLE, STORY
from pressmill.session import write_between
from pressmill.sources import content, phrase_index, records, stories as story_files
from pressmill.streaming.progress import progress_stream, read_changes

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


# -- sources and sinks ---------------------------------------------------------

def _chunks(df: DataFrame, value: Column) -> DataFrame:
    """Rows packed into lists of at most 100, to be written as one file each."""
    return df.groupBy(F.expr("doc_id DIV 100").alias("chunk")).agg(F.collect_list(value).alias("items"))


STORY_FIELDS = [f.name for f in STORY if f.name in ("title", "publication_date", "language", "domain", "url")]


@query
def read_stories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that hold one JSON array each, among files cut off."""
    path = folder(spark)
    packed = _chunks(stories(spark, sf_dir), F.struct(*STORY_FIELDS))
    packed.select("chunk", F.to_json("items").alias("value")).write.partitionBy("chunk").text(path)
    spark.range(3).selectExpr("'[{\"url\": \"lost\"}, {\"title\": \"cut' AS value").write.mode("append").text(f"{path}/chunk=broken")
    good, _ = story_files.read_stories(spark, path)
    return good.select(
        "url", "domain", "language", "publication_date", F.length("title").alias("title_chars"),
        F.col("capture_time").isNull().alias("no_capture_time"))


@query
def write_stories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export and read back."""
    path = folder(spark)
    story_files.write_stories(stories(spark, sf_dir).select(*STORY_FIELDS), path)
    back = spark.read.schema(STORY).json(path)
    return back.select("url", "domain", "language", F.md5("title").alias("title_md5"))


@query
def unwrap_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes with a list, and ones whose content is no list."""
    path = folder(spark)
    packed = _chunks(stories(spark, sf_dir), F.struct("doc_id", "text", "language"))
    is_list = F.col("chunk") % 3 != 2
    packed.filter(is_list).select("chunk", F.col("items").alias("content")) \
        .write.partitionBy("chunk").json(path)
    packed.filter(~is_list).select("chunk", F.get("items", F.lit(0)).alias("content")) \
        .write.mode("append").partitionBy("chunk").json(path)
    items = records.unwrap_envelope(spark, path)
    item = F.from_json("value", "doc_id bigint, text string, language string")
    return items.select(item.alias("i")).select("i.doc_id", "i.language", F.md5("i.text").alias("text_md5"))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of records, some cut off, blank, or no object."""
    line = F.to_json(F.struct("doc_id", "text", "language"))
    return stories(spark, sf_dir).select(
        F.when(F.col("doc_id") % 10 == 3, F.lit('{"doc_id": 3, "text": "cut'))
        .when(F.col("doc_id") % 10 == 5, F.lit(""))
        .when(F.col("doc_id") % 10 == 7, F.lit("[1, 2]"))
        .when(F.col("doc_id") % 10 == 9, F.concat(line, F.lit(" extra")))
        .otherwise(line).alias("value"))


def _read_lines(spark: SparkSession, sf_dir: str):
    path = folder(spark)
    _lines(spark, sf_dir).write.text(path)
    return records.read_article_lines(spark, path, "*.txt")


@query
def read_article_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: the lines that hold a record."""
    good, _ = _read_lines(spark, sf_dir)
    item = F.from_json("value", "doc_id bigint, text string, language string")
    return good.select(item.alias("i")).select("i.doc_id", "i.language", F.md5("i.text").alias("text_md5"))


@query
def malformed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: the lines put aside, counted by how they start."""
    _, bad = _read_lines(spark, sf_dir)
    start = F.when(F.endswith("value", F.lit(" extra")), "extra").otherwise(F.col("value"))
    return bad.groupBy(start.alias("line")).agg(F.count("*").alias("n"))


def _bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as articles with a body, which is sometimes empty or absent."""
    return table(spark, sf_dir, "documents").selectExpr(
        "doc_id AS article_id", "concat('https://x.example/', CAST(doc_id AS STRING)) AS url",
        "CAST(doc_id % 4 AS INT) AS tries", "CASE WHEN doc_id % 6 > 0 THEN doc_id % 6 END AS batch_id",
        "CASE doc_id % 11 WHEN 4 THEN '' WHEN 7 THEN NULL ELSE text END AS body")


@query
def put_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows stored."""
    stored, _ = content.put_content(_bodies(spark, sf_dir), "body", "html")
    return stored.select("content_id", "article_id", "target_url", "kind", F.md5("body").alias("body_md5"))


def _stored(spark: SparkSession, sf_dir: str):
    path = folder(spark)
    stored, refs = content.put_content(_bodies(spark, sf_dir), "body", "html")
    content.append_content(stored, path)
    return content.read_content(spark, path, "html"), refs


@query
def get_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies looked up by reference, from a written content table."""
    stored, refs = _stored(spark, sf_dir)
    return content.get_content(refs, stored).select(
        "article_id", "content_id", F.md5("body").alias("body_md5"))


@query
def content_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attributes looked up by reference."""
    stored, refs = _stored(spark, sf_dir)
    return content.content_info(refs, stored).select(
        "article_id", "stored_article_id", "stored_url", "stored_kind")


# -- import and batches --------------------------------------------------------

def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Article records as JSON lines, with one fault per kind planted by id."""
    doc = table(spark, sf_dir, "documents")
    q = lambda fault, text, otherwise: f"CASE WHEN doc_id % 17 = {fault} THEN '{text}' ELSE {otherwise} END"
    quoted = lambda expression: f"to_json(named_struct('v', {expression}))"
    value = lambda expression: f"substring({quoted(expression)}, 6, length({quoted(expression)}) - 6)"
    parts = [
        q(1, '"ap_syndicated": "maybe", ', q(2, '"ap_syndicated": "true", ', q(3, '"ap_syndicated": 0, ', "'\"ap_syndicated\": false, '"))),
        "'\"collect_date\": \"2024-01-05\", '",
        q(4, "", q(5, '"guid": null, ', "concat('\"guid\": \"g', CAST(doc_id AS STRING), '\", ')")),
        q(6, "", "concat('\"language\": \"', lang, '\", ')"),
        q(7, '"media_id": 12.5, ', q(8, '"media_id": 12.0, ', "concat('\"media_id\": \"', CAST(doc_id AS STRING), '\", ')")),
        "concat('\"media_name\": \"', source, '\", \"media_url\": \"https://', source, '.example\", ')",
        "'\"processed_stories_id\": 5, '",
        q(9, '"publish_date": 20240105, ', "'\"publish_date\": \"2024-01-05\", '"),
        "concat('\"stories_id\": ', CAST(doc_id AS STRING), ', ')",
        q(10, '"story_tags": {"tag": "x"}, ', q(11, '"story_tags": [{"tag": "x"}, {"tag": "y"}], ', "''")),
        q(12, '"title": 7, ', f"concat('\"title\": ', {value('text')}, ', ')"),
        "concat('\"url\": \"https://', source, '.example/', CAST(doc_id AS STRING), '\", \"unknown\": [1], ')",
        q(13, '"metadata": "none"', q(14, '"metadata": {"geocoder_version": {"v": "2"}}', "'\"metadata\": null'")),
    ]
    line = "concat('{', " + ", ".join(parts) + ", '}')"
    return doc.selectExpr("doc_id", f"CASE WHEN doc_id % 17 = 15 THEN 'oops' ELSE {line} END AS value",
                          "concat('f', CAST(doc_id % 3 AS STRING), '.json') AS file")


@query
def validate_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed fields of accepted records."""
    accepted, _ = imports.validate_articles(_records(spark, sf_dir))
    return accepted.select(
        "doc_id", "ap_syndicated", "guid", "language", "media_id", "stories_id", "publish_date",
        F.size("story_tags").alias("n_tags"), F.md5("title").alias("title_md5"),
        F.col("metadata.geocoder_version")["v"].alias("geocoder"))


@query
def rejected_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refused records and why."""
    _, rejected = imports.validate_articles(_records(spark, sf_dir))
    return rejected.select("doc_id", F.array_join("reasons", ",").alias("reasons"))


@query
def stamp_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stamped with the next batch id of another table."""
    accepted, _ = imports.validate_articles(_records(spark, sf_dir))
    batch = imports.next_batch_id(articles(spark, sf_dir)).scalar()
    stamped = imports.stamp_articles(accepted, batch)
    return stamped.select("stories_id", "lang", "batch_id", "imported_from", "status", "tries",
                          F.size("story_tags").alias("n_tags"),
                          F.col("scraping_result").isNull().alias("no_result"))


@query
def next_batch_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I3."""
    return imports.next_batch_id(articles(spark, sf_dir))


@query
def latest_batch_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I4."""
    return imports.latest_batch_id(articles(spark, sf_dir))


@query
def first_open_batch_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I5: 'error' events stand for unprocessed articles of batches 3 and up."""
    status = F.when((F.col("status") == "error") & (F.col("batch_id") >= 3), "UNPROCESSED").otherwise(F.col("status"))
    return imports.first_open_batch_id(articles(spark, sf_dir).withColumn("status", status))


@query
def delete_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest batch deleted; rows without a batch stay."""
    rows = articles(spark, sf_dir).withColumn("batch_id", F.expr("CASE WHEN article_id % 11 = 0 THEN NULL ELSE batch_id END"))
    latest = imports.latest_batch_id(rows).scalar()
    return imports.delete_batch(rows, latest).select("article_id", "batch_id")


@query
def append_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with other columns appended."""
    new = table(spark, sf_dir, "documents").selectExpr("doc_id AS article_id", "lang")
    both = imports.append_articles(articles(spark, sf_dir).select("article_id", "status"), new)
    return both.select("article_id", "status", "lang")


# -- story search --------------------------------------------------------------

def _sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source directory with repeats: one row per document."""
    return table(spark, sf_dir, "documents").selectExpr(
        "CAST(substring(source, 4) AS BIGINT) % 4 AS collection_id", "source AS name")


@query
def collection_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1."""
    return search.collection_domains(_sources(spark, sf_dir), 1)


@query
def search_stories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2: a phrase in title or body; some dates are none."""
    dated = stories(spark, sf_dir).withColumn("publication_date", F.expr(
        "CASE WHEN doc_id % 29 = 5 THEN 'n/a' ELSE publication_date END"))
    found = search.search_stories(
        dated, search.collection_domains(_sources(spark, sf_dir), 1),
        "of the", "2024-01-03", "2024-01-24", text=("title", "text"))
    return found.select("doc_id", "domain", "publication_date")


@query
def search_phrase_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2: the same from a stored index of all words."""
    dated = stories(spark, sf_dir).withColumn("publication_date", F.expr(
        "CASE WHEN doc_id % 29 = 5 THEN 'n/a' ELSE publication_date END"))
    path = folder(spark)
    phrase_index.write_phrase_index(dated, path, ("title", "text"))
    found = phrase_index.search_phrase_index(
        spark, path, search.collection_domains(_sources(spark, sf_dir), 1),
        "of the", "2024-01-03", "2024-01-24", text=("title", "text"))
    return found.select("doc_id", "domain", "publication_date")


@query
def story_search_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole search job, one word in the body."""
    found = story_query(stories(spark, sf_dir), _sources(spark, sf_dir), "Les", 2,
                        "2024-01-01", "2024-01-15", text=("text",))
    return found.select("doc_id", "language", "url")


# -- work selection ------------------------------------------------------------

@query
def fetch_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By status and batch, no limit."""
    return tasks.fetch_tasks(articles(spark, sf_dir), 3, "error", 0, ["article_id", "url", "tries"])


@query
def fetch_tasks_limited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By status, the first 1,500."""
    return tasks.fetch_tasks(articles(spark, sf_dir), None, "click", 1_500, ["article_id", "url"])


@query
def fetch_tasks_large_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Most of the rows; ids are null or come twice, also where the limit cuts."""
    rows = articles(spark, sf_dir).withColumn("article_id", F.expr("CASE WHEN article_id % 500 <> 0 THEN article_id DIV 2 END"))
    return tasks.fetch_tasks(rows, None, "", 9_000, ["article_id"])


@query
def retry_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After the limit, so fewer rows can remain."""
    rows = articles(spark, sf_dir).withColumn("tries", F.expr("CASE WHEN article_id % 13 = 0 THEN NULL ELSE tries END"))
    limited = tasks.fetch_tasks(rows, None, "click", 1_500, ["article_id", "tries"])
    return tasks.retry_filter(limited, 5)


@query
def shuffle_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W3."""
    return tasks.shuffle_tasks(articles(spark, sf_dir).select("article_id", "url"), seed=7)


@query
def assign_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a site drop out."""
    rows = articles(spark, sf_dir).withColumn("media_url", F.expr(
        "CASE article_id % 19 WHEN 3 THEN NULL WHEN 8 THEN '' ELSE media_url END"))
    return tasks.assign_blocks(rows, 8).select("article_id", "media_url", "block")


@query
def even_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sites of very uneven sizes, heavy ones placed one by one."""
    rows = articles(spark, sf_dir).withColumn("media_url", F.expr(
        "CASE WHEN article_id % 10 < 6 THEN concat('h', CAST(floor(sqrt(article_id % 1000)) AS INT)) ELSE media_url END"))
    return tasks.assign_blocks(rows, 8, even=True).select("article_id", "media_url", "block")


@query
def stripe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W5."""
    return tasks.stripe(articles(spark, sf_dir).select("article_id", "url"), 4)


@query
def language_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A missing language counts as not English."""
    rows = stories(spark, sf_dir).withColumn("language", F.expr("CASE WHEN doc_id % 23 = 0 THEN NULL ELSE language END"))
    return tasks.language_gate(rows.select("doc_id", "language"))


@query
def pause_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sequence of all stories."""
    rows = stories(spark, sf_dir).selectExpr("doc_id", "language", "domain")
    return tasks.pause_plan(rows, "doc_id", seed=3, gated=tasks.gate_label(True).isNotNull()).select(
        "doc_id", "domain", "pause", "start_offset")


@query
def pause_plan_per_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each block planned on its own."""
    rows = articles(spark, sf_dir).selectExpr("article_id", "status AS domain", "CAST(batch_id AS INT) AS block")
    return tasks.pause_plan(rows, "article_id", seed=5, by="block").select(
        "article_id", "block", "pause", "start_offset")


@query
def fetch_plan_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tasks of all batches in random order, in blocks of whole sites, with their pauses."""
    plan = fetch_plan(articles(spark, sf_dir), 8, 7, "all", "click")
    return plan.select("article_id", "media_url", "block", "pause", "start_offset")


@query
def extract_plan_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tasks of the last batch dealt out in turn."""
    return extract_plan(articles(spark, sf_dir), 4, "last", "error")


@query
def extract_plan_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first batch that has tasks."""
    return extract_plan(articles(spark, sf_dir).filter("batch_id > 2"), 3, "first", "error")


# -- fetch outcome -------------------------------------------------------------

def _responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captured responses from pages; headers and failures planted by id."""
    return table(spark, sf_dir, "pages").selectExpr(
        "page_id",
        "concat('https://x.example/', CAST(page_id AS STRING)) AS url",
        "url AS landing_url",
        "CAST(CASE page_id % 4 WHEN 0 THEN 404 ELSE 200 END AS INT) AS status_code",
        """CASE page_id % 7
             WHEN 0 THEN map('Content-Length', '52428801')
             WHEN 1 THEN map('content-type', 'audio/mpeg', 'Content-Length', '10')
             WHEN 2 THEN map('Content-Type', 'video/mp4')
             WHEN 3 THEN map('Content-Length', 'many')
             WHEN 4 THEN map('CONTENT-TYPE', 'text/html', 'content-length', '52428800')
             ELSE map('Content-Type', 'text/html') END AS headers""",
        "'utf-8' AS encoding",
        "encode(html, 'UTF-8') AS body",
        "CAST(CASE page_id % 5 WHEN 0 THEN 300.5 ELSE 0.25 END AS DOUBLE) AS elapsed",
        "CASE page_id % 10 WHEN 9 THEN 'ReadTimeout' END AS error_kind",
    )


def _fetches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One fetch per document; only some have a response."""
    return table(spark, sf_dir, "documents").selectExpr(
        "doc_id AS article_id", "concat('https://x.example/', CAST(doc_id AS STRING)) AS url",
        "CAST(doc_id % 4 AS INT) AS tries")


@query
def attach_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1."""
    got = fetch.attach_responses(_fetches(spark, sf_dir), _responses(spark, sf_dir))
    return got.select("article_id", "status", F.col("response.status_code").alias("status_code"),
                      F.octet_length("response.body").cast("bigint").alias("n_bytes"))


@query
def one_response_per_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    """several captures of a URL, of which the newest counts."""
    captures = table(spark, sf_dir, "events").selectExpr(
        "concat('https://u', CAST(user_id AS STRING)) AS url", "event_id AS capture", "value")
    return fetch.one_response_per_url(captures, "capture").select("url", "capture", "value")


@query
def cap_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """with a body limit that some pages exceed."""
    capped = fetch.cap_responses(_responses(spark, sf_dir).withColumn(
        "headers", F.expr("CASE WHEN page_id % 14 = 4 THEN NULL ELSE headers END")), max_len=52_428_800)
    small = fetch.cap_responses(_responses(spark, sf_dir).drop("headers").withColumn(
        "headers", F.lit(None).cast("map<string,string>")), max_len=3_000)
    return capped.select("page_id", "capped", "status").join(
        small.select("page_id", F.col("capped").alias("capped_small")), "page_id")


def _encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages in several encodings, some declared wrongly or undecodable."""
    return table(spark, sf_dir, "pages").selectExpr(
        "page_id",
        """CASE page_id % 8
             WHEN 0 THEN encode(html, 'UTF-8') WHEN 1 THEN encode(html, 'ISO-8859-1')
             WHEN 2 THEN encode(html, 'UTF-16LE') WHEN 3 THEN encode(html, 'ISO-8859-1')
             WHEN 4 THEN encode(html, 'UTF-8') WHEN 5 THEN unhex(concat('FF', hex(encode(html, 'UTF-8'))))
             WHEN 6 THEN encode(html, 'UTF-8') ELSE NULL END AS body""",
        """CASE page_id % 8
             WHEN 0 THEN 'UTF_8' WHEN 1 THEN 'latin-1' WHEN 2 THEN 'utf-16-le' WHEN 3 THEN 'windows-1252'
             WHEN 4 THEN 'ascii' WHEN 5 THEN NULL WHEN 6 THEN 'no-such-code' ELSE 'utf-8' END AS encoding""")


@query
def decode_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F3."""
    return fetch.decode_body(_encoded(spark, sf_dir)).select(
        "page_id", F.md5("content").alias("content_md5"), "used_encoding")


@query
def fetch_error_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F4."""
    kind = "element_at(array('ConnectionError', 'ReadTimeout', 'TooManyRedirects', 'bad chunk'), CAST(page_id % 7 + 1 AS INT))"
    rows = table(spark, sf_dir, "pages").selectExpr(
        "page_id", f"CASE WHEN page_id % 7 < 4 THEN {kind} END AS error_kind",
        "CASE page_id % 7 WHEN 4 THEN '' WHEN 5 THEN NULL ELSE html END AS content")
    return rows.select("page_id", fetch.fetch_error_label(
        F.col("error_kind"), F.col("error_kind"), F.col("content")).alias("label"))


@query
def build_scraping_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F5."""
    got = fetch.attach_responses(_fetches(spark, sf_dir), _responses(spark, sf_dir))
    _, refs = content.put_content(got.withColumn("body", F.col("response.body")), "body", "html")
    built = fetch.build_scraping_result(refs, F.timestamp_seconds(F.col("article_id")))
    return built.select("article_id", *[
        F.col(f"scraping_result.{name}").alias(name)
        for name in ("target_url", "landing_url", "content_html", "content_text", "elapsed",
                     "encoding", "status_code", "scraped_at")
    ], fetch.header(F.col("scraping_result.headers"), "content-type").alias("content_type"))


# -- error rules ---------------------------------------------------------------

@query
def url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two needles planted per URL."""
    k = len(inputs.URL_NEEDLES)
    url = F.concat(F.col("url"), F.lit("/"), pick(inputs.URL_NEEDLES, f"page_id % {k}"), F.lit("/"),
                   pick(inputs.URL_NEEDLES, f"(page_id * 7 + page_id DIV {k}) % {k}"))
    return table(spark, sf_dir, "pages").select("page_id", url.alias("u")).select(
        "page_id", rules.url_label("u").alias("label"))


@query
def page_text_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Needles planted in texts, or as the whole text."""
    k = len(inputs.TEXT_NEEDLES)
    first, second = pick(inputs.TEXT_NEEDLES, f"doc_id % {k}"), pick(inputs.TEXT_NEEDLES, f"(doc_id * 11 + 5) % {k}")
    text = F.when(F.col("doc_id") % 3 == 0, F.upper(first)).when(
        F.col("doc_id") % 3 == 1, F.concat(F.col("text"), first)).otherwise(F.concat(first, F.col("text"), second))
    return table(spark, sf_dir, "documents").select("doc_id", F.lower(text).alias("t")).select(
        "doc_id", rules.page_text_label("t").alias("label"))


def _empty_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw pages, every fourth with a needle as its text, parsed."""
    u, t = len(inputs.EMPTY_URL_NEEDLES), len(inputs.EMPTY_TEXT_NEEDLES)
    rows = table(spark, sf_dir, "pages").select(
        "page_id", "html", pick(inputs.EMPTY_TEXT_NEEDLES, f"page_id % {t}").alias("needle"),
        F.when(F.col("page_id") % 5 == 0, F.col("url")).otherwise(
            F.concat(F.col("url"), F.lit("/"), pick(inputs.EMPTY_URL_NEEDLES, f"page_id % {u}"), F.lit("/"),
                     pick(inputs.EMPTY_URL_NEEDLES, f"(page_id * 3 + 1) % {u}"))).alias("url"))
    planted = f"CASE WHEN page_id % 4 = 0 THEN concat('<div>', {inputs.escape('needle')}, '</div>') ELSE html END"
    return html.page_parts(rows.withColumn("html", F.expr(planted)))


@query
def empty_page_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label or page text."""
    rows = _empty_pages(spark, sf_dir)
    rows = rows.withColumn("lower_text", F.lower("page_text"))
    return rows.select("page_id", rules.empty_page_result("url", "page_text", "lower_text").alias("result"))


@query
def last_resort_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4: the first rule wins."""
    k = len(inputs.LAST_NEEDLES)
    url = F.when(F.col("page_id") % 8 == 0, F.col("url")).otherwise(F.concat(
        F.col("url"), pick(inputs.LAST_NEEDLES, f"page_id % {k}"), pick(inputs.LAST_NEEDLES, f"(page_id DIV {k}) % {k}")))
    return table(spark, sf_dir, "pages").select("page_id", url.alias("u")).select(
        "page_id", rules.last_resort_label("u").alias("label"))


# -- pages and extraction ------------------------------------------------------

@query
def page_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H1: raw pages, with unclosed paragraphs and cut-off ends."""
    parts = html.page_parts(table(spark, sf_dir, "pages"))
    return parts.select("page_id", F.md5("page_text").alias("text_md5"),
                        F.size("p_texts").cast("bigint").alias("n_paragraphs"), "parse_failed")


@query
def page_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H2: paragraph text of raw pages; an unclosed paragraph holds the next ones."""
    parts = html.page_parts(table(spark, sf_dir, "pages"))
    text = html.paragraph_text()
    return parts.select("page_id", F.length(text).cast("bigint").alias("n_chars"), F.md5(text).alias("text_md5"))


@query
def paragraph_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H2: every line of every document as a paragraph, and back."""
    pages = table(spark, sf_dir, "documents").selectExpr("doc_id", f"{inputs.html_lines('text')} AS html")
    parts = html.page_parts(pages)
    return parts.select("doc_id", html.paragraph_text().alias("text"))


@query
def empty_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H3: no paragraph, one blank, two blank, one with text, a heading alone; every text is in its page."""
    text = inputs.escape("text")
    body = f"""CASE doc_id % 5 WHEN 0 THEN concat('<div>', {text}, '</div>')
                 WHEN 1 THEN concat('<p> &nbsp;\t</p><div>', {text}, '</div>')
                 WHEN 2 THEN concat('<p></p><p></p><div>', {text}, '</div>')
                 WHEN 3 THEN concat('<p>x ', {text}) ELSE concat('<h1>', {text}, '</h1>') END"""
    parts = html.page_parts(table(spark, sf_dir, "documents").selectExpr("doc_id", f"{body} AS html"))
    return parts.select("doc_id", html.is_empty().alias("is_empty"))


def _json(fields: str) -> str:
    """SQL expression of JSON text that can stand in a script."""
    return f"to_json({fields})"


_NESTED_TEXT = "named_struct('props', named_struct('pageProps', named_struct('data', named_struct('page', named_struct('leaf', named_struct('bodyText', text))))))"
_PARSED_BODY = "named_struct('props', named_struct('pageProps', named_struct('pageContent', named_struct('parsedBody', split(text, '\n')))))"
_RENDERED = f"map(concat('https://k/', CAST(doc_id AS STRING)), named_struct('body', named_struct('queried_object', named_struct('content', named_struct('rendered', concat('<i>', {inputs.escape('text')}, '</i>'))))))"
_FUSION = "named_struct('content_elements', array(named_struct('type', 'text', 'content', text), named_struct('type', 'image', 'content', 'no'), named_struct('type', 'text', 'content', lang)))"
_STORY = f"named_struct('articles', array(named_struct('body', concat('<div>', {inputs.escape('text')}, '</div>'))))"
_script = lambda kind, fields: f"concat('<script type=\"{kind}\">', {_json(fields)}, '</script>')"
_div = lambda attr: f"concat('<div {attr}> ', {inputs.escape('text')}, '</div><div>other</div>')"
_filler = "'<p>paragraph</p>'"

# id -> (url, SQL for the page); each page has a paragraph unless it is for an empty page
SITE_PAGES = {
    "X1": ("https://qz.com/", f"concat({_script('application/json', 'named_struct(\"no\", 1)')}, {_script('application/ld+json', 'named_struct(\"articleBody\", text)')}, {_filler})"),
    "X2": ("https://miamiherald.typepad.com/", f"concat({_div('id=\"story-content\"')}, {_filler})"),
    "X3": ("https://www.dailywire.com/", f"concat({_div('id=\"post-body-text\"')}, {_filler})"),
    "X4": ("https://www.nationalreview.com/", f"concat('<script>\n nr.headless.preloadedData = ', {_json(_RENDERED)}, ';\n</script>', {_filler})"),
    "X5": ("https://www.columbiaspectator.com/", f"concat('<script>Fusion.x=1;Fusion.globalContent=', {_json(_FUSION)}, ';Fusion.y={{}};</script>', {_filler})"),
    "X6": ("https://www.toledoblade.com/", f"concat('<script>pgStoryZeroJSON = ', {_json(_STORY)}, '</script>', {_filler})"),
    "X7": ("https://www.blacknews.com/news/", f"concat({_div('class=\"post-body  entry-content\"')}, {_filler})"),
    "X8": ("https://thepoliticalinsider.com/", f"concat({_div('class=\"text article-body font-default font-size-med\"')}, {_filler})"),
    "X9": ("https://www.ibtimes.com/", f"concat(CASE WHEN doc_id % 2 = 0 THEN '<b>Forbidden</b>' ELSE '' END, '<p>', {inputs.escape('text')}, '</p>')"),
    "X10": ("https://www.tampabay.com/", f"concat('<p>', {inputs.escape('text')}, '</p>')"),
    "X11": ("https://www.newsday.com/", f"concat({_script('application/json', _NESTED_TEXT)}, {_filler})"),
    "X12": ("https://timesofindia.example/videoshow/", f"concat('<p>', {inputs.escape('text')}, '</p>')"),
    "X13": ("https://timesofindia.example/", f"CASE doc_id % 3 WHEN 0 THEN {_div('data-articlebody=\"1\"')} WHEN 1 THEN {_div('class=\"main-content single-article-content\"')} ELSE {_filler} END"),
    "X14": ("https://www.NewsMax.com/", f"concat({_div('id=\"mainArticleDiv\"')}, {_filler})"),
    "X15": ("https://www.sbs.com.au/", f"concat({_script('application/json', _PARSED_BODY)}, {_filler})"),
    "X16": ("https://feeds.example/NDTV-LatestNews/", f"concat({_div('id=\"ins_storybody\"')}, {_filler})"),
    "X17": ("https://any.example/", f"concat('<p>', {inputs.escape('text')}, '</p>')"),
    "X18": ("https://www.ynetnews.com/", f"concat('<span data-text=\"true\">', {inputs.escape('text')}, '</span><span>other</span>')"),
    "X19": ("https://www.refinery29.com/", _div('class="first section-text"')),
    "X20": ("https://www.cnbctv18.com/", f"concat({_script('x application/ld+json', 'named_struct(\"articleBody\", text)')}, '<p></p>')"),
}


def _site_query(id: str):
    url, page = SITE_PAGES[id]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        pages = table(spark, sf_dir, "documents").selectExpr(
            "doc_id", f"concat('{url}', CAST(doc_id AS STRING)) AS url",
            f"concat('<html><body>', {page}, '</body></html>') AS html")
        parts = extract.extract_parts(pages)
        return parts.select("doc_id", F.coalesce("site_result", "empty_result").alias("result"), "extract_exception")

    run.__doc__ = f"{id}: the text of every document placed in a page of the site."
    return run


for _id in SITE_PAGES:
    QUERIES[f"site_{_id.lower()}"] = _site_query(_id)


def _mixed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of all kinds: plain, site pages, error pages, empty pages."""
    return table(spark, sf_dir, "documents").selectExpr(
        "doc_id", "doc_id AS article_id", "lang AS language", "source", "CAST(doc_id % 4 AS INT) AS tries",
        """concat(CASE doc_id % 12 WHEN 0 THEN 'https://www.tampabay.com/' WHEN 1 THEN 'https://www.dailywire.com/'
             WHEN 2 THEN 'https://kuow.org/' WHEN 3 THEN 'https://www.instagram.com/' WHEN 4 THEN 'https://wral.com/'
             ELSE 'https://a.example/' END, CAST(doc_id AS STRING)) AS url""",
        "CASE doc_id % 31 WHEN 0 THEN 'ReadTimeout' WHEN 1 THEN 'odd failure' END AS error_kind",
        f"""CASE WHEN doc_id % 29 = 0 THEN ''
             WHEN doc_id % 12 = 1 THEN concat('<p>x</p><div id="post-body-text">', {inputs.escape('text')}, '</div>')
             WHEN doc_id % 12 IN (2, 4) THEN concat('<div>', {inputs.escape('text')}, '</div>')
             WHEN doc_id % 12 = 5 THEN concat('<p>Access Denied</p><p>', {inputs.escape('text')}, '</p>')
             WHEN doc_id % 12 = 6 THEN '<script>a</script><p> </p>'
             ELSE concat('<p>', replace({inputs.escape('text')}, '\n', '</p><p>'), '</p>') END AS content""")


@query
def resolve_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X21."""
    return extract.resolve_strict(_mixed_pages(spark, sf_dir)).select("doc_id", "text", "extract_exception")


@query
def resolve_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X22."""
    return extract.resolve_pair(_mixed_pages(spark, sf_dir), html="content").select(
        "doc_id", "text", "error", "extract_exception")


@query
def resolve_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X22 on raw pages."""
    resolved = extract.resolve_pair(table(spark, sf_dir, "pages"))
    return resolved.select("page_id", F.md5("text").alias("text_md5"), "error", "extract_exception")


@query
def extraction_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a stored page give no update."""
    pages = _mixed_pages(spark, sf_dir).withColumn("content_html", F.expr("CASE WHEN doc_id % 6 <> 0 THEN concat('c', CAST(doc_id AS STRING)) END"))
    done = extract.extraction_update(extract.resolve_pair(pages, html="content"))
    return done.select("doc_id", "text_extracted", "abstract", "parsing_error")


# -- state ---------------------------------------------------------------------

def _outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes for the articles of high value, some of them twice."""
    events = table(spark, sf_dir, "events").filter("value >= 20")
    rows = events.selectExpr("event_id AS article_id", "explode(CASE WHEN event_id % 5 = 0 THEN array(1, 2) ELSE array(1) END) AS attempt")
    return rows.selectExpr(
        "article_id", "attempt", "CASE WHEN article_id % 3 = 0 THEN 'FAILED' ELSE 'CONTENT-FETCHED' END AS status",
        """named_struct('target_url', concat('https://y.example/', CAST(article_id AS STRING)), 'status_code', CAST(200 + attempt AS INT),
             'content_html', concat('h', CAST(article_id AS STRING)), 'content_text', CAST(NULL AS STRING)) AS scraping_result""")


@query
def apply_scrape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U1."""
    new = state.apply_scrape(scraped_articles(spark, sf_dir), _outcomes(spark, sf_dir), "attempt")
    return new.select("article_id", "status", "tries", F.col("scraping_result.target_url").alias("target_url"),
                      F.col("scraping_result.status_code").alias("status_code"),
                      F.col("scraping_result.content_html").alias("content_html"))


@query
def apply_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the text reference changes in the nested result."""
    extracted = table(spark, sf_dir, "events").filter("event_type <> 'error'").selectExpr(
        "event_id AS article_id", "true AS text_extracted", "event_type AS abstract", "'' AS parsing_error",
        "concat('t', CAST(event_id AS STRING)) AS content_text")
    new = state.apply_extraction(scraped_articles(spark, sf_dir), extracted)
    return new.select("article_id", "status", "tries", "text_extracted", "abstract", "parsing_error",
                      F.col("scraping_result.target_url").alias("target_url"),
                      F.col("scraping_result.status_code").alias("status_code"),
                      F.col("scraping_result.content_text").alias("content_text"))


# -- counts and progress -------------------------------------------------------

@query
def count_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: a missing status is a group."""
    rows = articles(spark, sf_dir).withColumn("status", F.expr("CASE WHEN article_id % 9 = 0 THEN NULL ELSE status END"))
    return stats.count_status(rows)


@query
def count_status_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2."""
    return stats.count_status_codes(scraped_articles(spark, sf_dir))


@query
def diff_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: before and after views are done and high values lost their status."""
    before = articles(spark, sf_dir)
    after = before.withColumn("status", F.expr(
        "CASE WHEN status = 'view' THEN 'done' WHEN value > 50 THEN NULL ELSE status END"))
    return stats.diff_counts(stats.count_status(before), stats.count_status(after))


@query
def progress_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: events as a change log of users, read as a stream in three refreshes; the last one's differences."""
    path, log = folder(spark), folder(spark)
    events = table(spark, sf_dir, "events").selectExpr(
        "CAST(user_id AS STRING) AS article_id", "event_id AS version", "event_type AS status").repartition(4)
    diffs = []
    for part in range(3):
        # several files a refresh; every run goes on from what the last one kept
        events.filter(F.col("version") % 3 == part).write.mode("append").parquet(log)
        progress_stream(read_changes(spark, log), path, lambda diff, n: diffs.append(diff), seconds=None,
                        buckets=8, base_every=2).awaitTermination()
    return diffs[-1]


# -- whole jobs ----------------------------------------------------------------

@query
def scrape_stories_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stories and captured responses to text."""
    pages = _mixed_pages(spark, sf_dir)
    responses = pages.filter("source <> 'src3'").selectExpr(
        "url", "url AS landing_url", "CAST(200 AS INT) AS status_code", "map('a', 'b') AS headers",
        "'utf-8' AS encoding", "CASE WHEN error_kind IS NULL THEN encode(content, 'UTF-8') END AS body",
        "CAST(0.5 AS DOUBLE) AS elapsed", "error_kind")
    return scrape_stories(pages.select("doc_id", "language", "url"), responses).select("doc_id", "text")


@query
def article_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Import, scrape and extract, from record files to the article table."""
    path = folder(spark)
    docs = _mixed_pages(spark, sf_dir)
    line = F.to_json(F.expr("""named_struct('ap_syndicated', false, 'collect_date', '2024-01-05', 'guid', url,
        'language', language, 'media_id', 1, 'media_name', 'm', 'media_url', url, 'processed_stories_id', doc_id,
        'stories_id', doc_id, 'title', 't', 'url', url, 'metadata', CAST(NULL AS STRUCT<a: INT>))"""),
        {"ignoreNullFields": "false"})
    docs.select(line.alias("value")).write.text(path)
    # every other page was captured twice before, with another body
    responses = docs.filter("source <> 'src3'").selectExpr(
        "url", "url AS landing_url", "CAST(200 AS INT) AS status_code",
        "CASE WHEN doc_id % 10 = 0 THEN map('Content-Type', 'audio/x') ELSE map('a', 'b') END AS headers",
        "'utf-8' AS encoding", "content", "CAST(0.5 AS DOUBLE) AS elapsed", "CAST(NULL AS STRING) AS error_kind",
        "explode(CASE WHEN doc_id % 2 = 0 THEN array(3, 1, 2) ELSE array(3) END) AS capture") \
        .selectExpr("* EXCEPT (content)", "encode(CASE capture WHEN 3 THEN content ELSE '<p>old</p>' END, 'UTF-8') AS body")
    nothing = spark.createDataFrame([], ARTICLE)
    imported = import_batch(spark, nothing, path, pattern="*.txt").articles
    scraped = scrape_batch(imported, write_between(responses), limit=0, newest="capture")
    done = extract_batch(write_between(scraped.articles), scraped.content, limit=0)
    return done.articles.select(
        F.col("stories_id").alias("doc_id"), "batch_id", "status", "tries", "text_extracted", "abstract",
        "parsing_error", F.col("scraping_result.content_html").isNotNull().alias("has_html"),
        F.col("scraping_result.content_text").isNotNull().alias("has_text"))


@query
def batch_table_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches in a versioned table, of which the last is scraped, and then both extracted."""
    docs = _mixed_pages(spark, sf_dir)
    line = F.to_json(F.expr("""named_struct('ap_syndicated', false, 'collect_date', '2024-01-05', 'guid', url,
        'language', language, 'media_id', 1, 'media_name', 'm', 'media_url', url, 'processed_stories_id', doc_id,
        'stories_id', doc_id, 'title', 't', 'url', url, 'metadata', CAST(NULL AS STRUCT<a: INT>))"""),
        {"ignoreNullFields": "false"})
    responses = write_between(docs.filter("source <> 'src3'").selectExpr(
        "url", "url AS landing_url", "CAST(200 AS INT) AS status_code",
        "CASE WHEN doc_id % 10 = 1 THEN map('Content-Type', 'audio/x') ELSE map('a', 'b') END AS headers",
        "'utf-8' AS encoding", "encode(content, 'UTF-8') AS body", "CAST(0.5 AS DOUBLE) AS elapsed",
        "CAST(NULL AS STRING) AS error_kind"))
    articles, pages = BatchTable(spark, folder(spark)), folder(spark)
    for part in range(2):
        path = folder(spark)
        docs.filter(F.col("doc_id") % 2 == part).select(line.alias("value")).write.text(path)
        run_import(articles, path, pattern="*.txt")
    run_scrape(articles, pages, responses, "last")
    version = run_extract(articles, pages)
    return articles.read().select(
        F.col("stories_id").alias("doc_id"), "batch_id", "status", "tries", "text_extracted", "abstract", "parsing_error",
        F.col("scraping_result.content_text").isNotNull().alias("has_text"), F.lit(version).cast("long").alias("version"))
