"""Validation, stamping and batches."""

import json

from pressmill.operators import imports
from pressmill.plans.articles import import_batch
from pressmill.schemas import ARTICLE, ARTICLE_FIELDS

RECORD = {
    "ap_syndicated": False, "collect_date": "2024-01-01", "guid": "g", "language": "en", "media_id": 1,
    "media_name": "m", "media_url": "http://m", "processed_stories_id": 2, "stories_id": 3, "title": "t",
    "url": "http://m/1", "metadata": {"geocoder_version": {"v": "1"}, "other": 1}, "unknown": [1],
}
REQUIRED = [name for name, _, required in ARTICLE_FIELDS if required]


def changed(**changes):
    return json.dumps({**RECORD, **changes})


def without(key):
    return json.dumps({k: v for k, v in RECORD.items() if k != key})


CASES = (
    [(json.dumps(RECORD), [])]
    + [(without(key), [f"missing:{key}"]) for key in REQUIRED]
    + [(changed(**{key: None}), []) for key in REQUIRED]
    + [(changed(media_id=v), []) for v in ("12", " 12 ", 12.0, "12.0", True, "-5", 1e3)]
    + [(changed(media_id=v), ["type:media_id"]) for v in (12.5, "12.5", "x", "", [1], {"a": 1}, 10**20)]
    + [(changed(ap_syndicated=v), []) for v in (True, "true", "No", 0, 1, 1.0, "1", "off")]
    + [(changed(ap_syndicated=v), ["type:ap_syndicated"]) for v in (2, "maybe", [], 0.5)]
    + [(changed(title=v), ["type:title"]) for v in (7, True, [], {})]
    + [(changed(metadata=v), ["type:metadata"]) for v in ("x", 1, [])]
    + [(changed(metadata={"geocoder_version": 3}), ["type:metadata"]),
       (changed(metadata={"geocoder_version": None}), [])]
    + [(changed(story_tags=v), []) for v in ([], None, [{"tag": "x", "n": 1}])]
    + [(changed(story_tags=v), ["type:story_tags"]) for v in ({"a": 1}, "x", [1])]
    + [(changed(word_count="9", feeds="f", publish_date=None), [])]
    + [(line, ["malformed"]) for line in ("", "oops", "[1]", "3", json.dumps(RECORD) + " x")]
    + [("{}", [f"missing:{key}" for key in REQUIRED])]
)


def test_reasons(spark):
    df = spark.createDataFrame([(i, line) for i, (line, _) in enumerate(CASES)], "i int, value string")
    got = {r["i"]: r["reasons"] for r in imports.check_articles(df).collect()}
    wrong = {CASES[i][0]: (got[i], reasons) for i, (_, reasons) in enumerate(CASES)
             if sorted(got[i]) != sorted(reasons)}
    assert not wrong, wrong.values()
    accepted, rejected = imports.validate_articles(df)
    assert accepted.count() + rejected.count() == len(CASES)


def test_values(spark):
    lines = [json.dumps(RECORD), changed(media_id="12", ap_syndicated="true", story_tags=[{"tag": "x"}], word_count=4.0)]
    df = spark.createDataFrame([(line, "f.json") for line in lines], "value string, file string")
    accepted, _ = imports.validate_articles(df)
    rows = sorted(imports.stamp_articles(accepted, 4).collect(), key=lambda r: r["media_id"])
    assert rows[0].asDict()["story_tags"] == [] and rows[1]["story_tags"] == [{"tag": "x"}]
    assert (rows[1]["media_id"], rows[1]["ap_syndicated"], rows[1]["word_count"]) == (12, True, 4)
    for r in rows:
        assert (r["lang"], r["batch_id"], r["imported_from"], r["status"], r["tries"], r["scraping_result"]) == (
            "en", 4, "f.json", "UNPROCESSED", 0, None)
        assert r["imported_at"] is not None and r["metadata"]["geocoder_version"] == {"v": "1"}
    assert rows[0]["article_id"] != rows[1]["article_id"]


def test_batch_ids(spark):
    rows = spark.createDataFrame([(1, "FAILED"), (2, "UNPROCESSED"), (3, "UNPROCESSED"), (None, "FAILED")], "batch_id long, status string")
    one = lambda df: df.first()["batch_id"]
    assert (one(imports.latest_batch_id(rows)), one(imports.next_batch_id(rows)), one(imports.first_open_batch_id(rows))) == (3, 4, 2)
    none = rows.limit(0)
    assert (one(imports.latest_batch_id(none)), one(imports.next_batch_id(none)), one(imports.first_open_batch_id(none))) == (0, 1, 0)
    kept = imports.delete_batch(rows, imports.latest_batch_id(rows).scalar())
    assert sorted((r["batch_id"] or 0) for r in kept.collect()) == [0, 1, 2]
    both = imports.append_articles(rows, spark.createDataFrame([(9,)], "new int"))
    assert both.columns == ["batch_id", "status", "new"] and both.count() == 5


def test_import_batch_and_reimport(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(RECORD) + "\n" + without("title") + "\nbad\n")
    (tmp_path / "b.json").write_text(json.dumps(RECORD) + "\n")
    first = import_batch(spark, spark.createDataFrame([], ARTICLE), str(tmp_path))
    assert first.articles.select("batch_id").distinct().collect()[0][0] == 1
    assert first.articles.count() == 2 and first.rejected.count() == 2
    second = import_batch(spark, first.articles, str(tmp_path))
    assert sorted(r[0] for r in second.articles.select("batch_id").collect()) == [1, 1, 2, 2]
    again = import_batch(spark, second.articles, str(tmp_path), overwrite=True)
    assert sorted(r[0] for r in again.articles.select("batch_id").collect()) == [1, 1, 2, 2]
    assert again.articles.schema == ARTICLE
    assert {r[0] for r in again.articles.select("imported_from").collect()} == {"a.json", "b.json"}


def test_repeated_keys_do_not_depend_on_the_session(spark):
    plain = spark.newSession()
    plain.conf.set("spark.sql.variant.allowDuplicateKeys", "false")
    line = json.dumps({**RECORD, "metadata": {}}).replace('"metadata": {}', '"metadata": {"date_guess_method": {"a": "1", "a": "2"}}')
    accepted, rejected = imports.validate_articles(plain.createDataFrame([(line,)], "value string"))
    assert rejected.count() == 0 and accepted.first()["metadata"]["date_guess_method"] == {"a": "2"}
