"""Outcome of captured responses."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pressmill.operators import fetch
from pressmill.schemas import RESPONSE


def response(url="u", headers=None, body=b"x", encoding="utf-8", elapsed=1.0, error_kind=None, status=200):
    return (url, url + "/l", status, headers, encoding, body, elapsed, error_kind)


@pytest.mark.parametrize("row, capped", [
    (response(), None),
    (response(headers={"Content-Length": "101", "Content-Type": "audio/x"}), "HEADERS_TOO_LARGE"),
    (response(headers={"CONTENT-LENGTH": "100", "content-type": "audio/x"}), "CONTENT_AUDIO"),
    (response(headers={"content-type": "video/x"}, elapsed=99.0), "CONTENT_VIDEO"),
    (response(headers={"content-type": "text/html; video/"}), None),
    (response(headers={"content-length": ""}), None),
    (response(headers={"content-length": "x"}), "BAD_CONTENT_LENGTH"),
    (response(elapsed=9.5, body=b"y" * 200), "TOO_LONG"),
    (response(elapsed=9.0, body=b"y" * 101), "TOO_LARGE"),
    (response(body=b"y" * 100), None), (response(body=None), None),
])
def test_caps(spark, row, capped):
    got = fetch.cap_responses(spark.createDataFrame([row], RESPONSE), max_len=100, max_time=9).first()
    assert (got["capped"], got["status"]) == (capped, "FAILED" if capped else "CONTENT-FETCHED")


@pytest.mark.parametrize("body, encoding, content, used", [
    ("é".encode(), "utf-8", "é", "utf-8"), ("é".encode(), "UTF8", "é", "UTF8"),
    ("é".encode("latin-1"), "ISO-8859-1", "é", "ISO-8859-1"),
    ("“é”".encode("cp1252"), "windows-1252", "“é”", "windows-1252"),
    ("ж".encode("koi8-r"), "koi8_r", "ж", "koi8_r"), ("é".encode("utf-16"), "utf-16", "é", "utf-16"),
    (b"abc", "ascii", "abc", "ascii"), ("é".encode(), "ascii", "é", "utf-8"),
    ("é".encode(), None, "é", "utf-8"), ("é".encode(), "nonsense", "é", "utf-8"),
    (b"\xff\xfe\xff", "utf-8", "DECODING_ERROR", "utf-8"), (b"\xff", None, "DECODING_ERROR", "utf-8"),
    (b"\xff", "ascii", "DECODING_ERROR", "utf-8"), (b"abc", "utf-16", "abc", "utf-8"),
    (b"", "utf-8", "", "utf-8"), (None, "utf-8", None, None),
])
def test_decoding(spark, body, encoding, content, used):
    got = fetch.decode_body(spark.createDataFrame([response(body=body, encoding=encoding)], RESPONSE)).first()
    assert (got["content"], got["used_encoding"]) == (content, used)


def test_only_other_encodings_go_to_python(spark):
    df = fetch.decode_body(spark.createDataFrame([response()], RESPONSE))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "CASE WHEN NOT" in plan


def test_attach_and_result(spark):
    tasks = spark.createDataFrame([(1, "u", "h1"), (2, "u", None), (3, "gone", None), (4, "bad", None)], "article_id long, url string, content_id string")
    responses = spark.createDataFrame([response(status=404), response("bad", error_kind="ReadTimeout")], RESPONSE)
    got = fetch.attach_responses(tasks, responses)
    assert {r["article_id"]: r["status"] for r in got.collect()} == {
        1: "CONTENT-FETCHED", 2: "CONTENT-FETCHED", 3: "FAILED", 4: "FAILED"}
    when = dt.datetime(2024, 1, 2)
    built = fetch.build_scraping_result(got, F.lit(when)).orderBy("article_id").collect()
    first, gone = built[0]["scraping_result"], built[2]["scraping_result"]
    assert (first["target_url"], first["landing_url"], first["status_code"], first["content_html"]) == ("u", "u/l", 404, "h1")
    assert (gone["target_url"], gone["status_code"], gone["content_html"], gone["scraped_at"]) == ("gone", None, None, when)


def test_newest_response(spark):
    rows = spark.createDataFrame([("a", 1, "old"), ("a", 2, "new"), ("b", 1, "only")], "url string, t int, v string")
    assert sorted(r["v"] for r in fetch.one_response_per_url(rows, "t").collect()) == ["new", "only"]


def capture_rows():
    """Captures of URLs, some of one time, with and without a limit broken, and a hot URL."""
    rows = []
    for u, times in {"a": [1, 3, 2], "b": [5], "c": [1, 1], "unasked": [1, 2], "hot": list(range(200))}.items():
        rows += [(*response(u, body=f"{u}{t}".encode(), headers={"content-type": "audio/x"} if u == "b" else {"k": "v"}), t) for t in times]
    return rows


@pytest.mark.parametrize("stored", ["scan", "made", "exploded"])
def test_newest_captures_by_address(spark, tmp_path, stored):
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RESPONSE) + ", t int"
    captures = spark.createDataFrame(capture_rows(), schema)
    if stored == "exploded":
        # many captures come from one row of a file
        names = [f.name for f in RESPONSE] + ["t"]
        captures.selectExpr(f"struct({', '.join(names)}) AS one").agg(F.collect_list("one").alias("all")).write.parquet(str(tmp_path / "all"))
        captures = spark.read.parquet(str(tmp_path / "all")).selectExpr("inline(all)")
    elif stored == "scan":
        captures.repartition(3).write.parquet(str(tmp_path / "captures"))
        captures = spark.read.parquet(str(tmp_path / "captures")).filter("status_code = 200")
    tasks = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "none"), (5, None), (6, "hot"), (7, "a")], "article_id long, url string")
    got = {r["article_id"]: r for r in fetch.attach_newest(tasks, captures, "t").collect()}
    assert {k: r["response"] and (bytes(r["response"]["body"]).decode() if r["response"]["body"] else None, r["response"]["t"])
            for k, r in got.items()} == {
        1: ("a3", 3), 2: (None, 5), 3: ("c1", 1), 4: None, 5: None, 6: ("hot199", 199), 7: ("a3", 3)}
    assert got[2]["response"]["capped"] == "CONTENT_AUDIO" and got[1]["response"]["capped"] is None
    assert {k: r["status"] for k, r in got.items()} == {k: "FAILED" if k in (4, 5) else "CONTENT-FETCHED" for k in got}
    # without times the last by address counts, one of each URL
    assert sorted(r["article_id"] for r in fetch.attach_newest(tasks, captures.drop("t")).collect()) == [1, 2, 3, 4, 5, 6, 7]
    assert fetch.attach_newest(tasks.filter("false"), captures, "t").count() == 0
    assert {r["status"] for r in fetch.attach_newest(tasks, captures.filter("false"), "t").collect()} == {"FAILED"}


def test_bodies_go_through_one_join_and_no_aggregate(spark, tmp_path, monkeypatch):
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RESPONSE) + ", t int"
    path = str(tmp_path / "captures")
    spark.createDataFrame(capture_rows(), schema).write.parquet(path)
    plans = []
    monkeypatch.setattr(fetch, "write_between", lambda df: plans.append(df) or df)
    tasks = spark.createDataFrame([(1, "a")], "article_id long, url string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        done = fetch.attach_newest(tasks, spark.read.parquet(path), "t")
        text = done._jdf.queryExecution().executedPlan().toString()
        narrow = plans[0]._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "body" not in narrow.split("== ")[0]
    lines = [line for line in text.splitlines() if "body#" in line or "response#" in line]
    assert lines and not any("Aggregate" in line for line in lines)
    assert sum("Exchange" in line and "_at#" in line for line in text.splitlines()) == 1


@pytest.mark.parametrize("kind, content, label", [
    (None, "x", None), (None, "", "Article not found"), (None, None, "Article not found"),
    ("ConnectionError", None, "requests.exceptions.ConnectionError"), ("ReadTimeout", None, "requests.exceptions.ReadTimeout"),
    ("TooManyRedirects", "", "Too Many redirects"), ("Invalid URL", None, "Invalid URL"),
])
def test_fetch_errors(values, kind, content, label):
    column = fetch.fetch_error_label(F.col("k"), F.col("k"), F.col("c"))
    assert values([(kind, content)], "k string, c string", column) == [label and "ERROR: " + label]


def test_single_byte_encodings_without_python(spark):
    """Each byte of each encoding, as Python's codecs read it."""
    from pressmill.functions.decoding import SINGLE_BYTE, names_of

    rows, want = [], {}
    for codec in SINGLE_BYTE:
        for name in (names_of(codec)[0], codec.upper()):
            for byte in range(256):
                body = b"a" + bytes([byte]) + b"z"
                rows.append(response(body=body, encoding=name))
                try:
                    want[name, body] = (body.decode(codec), name)
                except UnicodeDecodeError:
                    want[name, body] = ("DECODING_ERROR", "utf-8")
    got = fetch.decode_body(spark.createDataFrame(rows, RESPONSE)).select("encoding", "body", "content", "used_encoding").collect()
    assert {(r[0], bytes(r[1])): (r[2], r[3]) for r in got} == want
