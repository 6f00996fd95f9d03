"""Files in and out."""

import json

from pyspark.sql import functions as F

from pressmill.sources import content, records, stories


def test_story_array_and_minimal_story(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([
        {"title": "A\nB", "publication_date": "2022-02-11", "language": "en", "domain": "d", "url": "u1", "extra": 1},
        {"language": "en", "domain": "a", "url": "u2"},
        {"language": "en", "domain": "a", "url": "u2"}], indent=1))
    (tmp_path / "cut.json").write_text('[{"title": "lost", "url": "u0"}, {"title": "cu')
    good, bad = stories.read_stories(spark, str(tmp_path))
    rows = good.orderBy("url").collect()
    assert [(r["file"], r["value"][:10]) for r in bad.collect()] == [("cut.json", '[{"title":')]
    assert [(r["url"], r["title"], r["publication_date"]) for r in rows] == [
        ("u1", "A\nB", "2022-02-11"), ("u2", None, None), ("u2", None, None)]
    stories.write_stories(good, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).count() == 3


def test_envelopes(spark, tmp_path):
    files = {
        "list.json": '{"content": [{"b": 1, "a": "x"}, {"c": null}]}',
        "empty.json": '{"content": []}', "absent.json": '{"x": 1}', "object.json": '{"content": {"a": 1}}',
        "broken.json": '{"content": [1,', "array.json": '[{"content": [1]}]', "trailing.json": '{"content": [1]} x',
        "skip.txt": '{"content": [1]}', "scalars.json": '{"content": ["{\\"a\\": 1}", 2, [3]]}',
        "repeat.json": '{"content": [{"k": 1, "k": 2}]}',
    }
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    got = {}
    for r in records.unwrap_envelope(spark, str(tmp_path)).collect():
        got.setdefault(r["file"], []).append(json.loads(r["value"]))
    assert got == {"list.json": [{"b": 1, "a": "x"}, {"c": None}], "scalars.json": ['{"a": 1}', 2, [3]],
                   "repeat.json": [{"k": 2}]}
    out = str(tmp_path / "lines")
    records.write_lines(records.unwrap_envelope(spark, str(tmp_path)), out)
    back = records.read_lines(spark, out, "*.txt")
    assert sorted(r["file"] for r in back.collect()) == ["list.json"] * 2 + ["repeat.json"] + ["scalars.json"] * 3


def test_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"a": 1}\n\n{"a": \n[1]\n{"a": 1} {"b": 2}\n"s"\nnull\n{}\n{"a": 1}, {"b": 1}\n')
    (tmp_path / "empty.json").write_text("")
    (tmp_path / "other.txt").write_text('{"a": 1}\n')
    good, bad = records.read_article_lines(spark, str(tmp_path))
    assert sorted(r["value"] for r in good.collect()) == ['{"a": 1}', "{}"]
    assert bad.count() == 7
    assert {r["file"] for r in good.collect()} == {"a.json"}


def test_content_round_trip(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, "u1", 0, "é"), (2, "u2", None, ""), (3, "u3", 1, None)], "article_id int, url string, tries int, body string")
    stored, refs = content.put_content(df, "body", "html")
    again, _ = content.put_content(df.withColumn("tries", F.lit(9)), "body", "html")
    path = str(tmp_path / "content")
    content.append_content(stored, path)
    content.append_content(again, path)
    table = content.read_content(spark, path, "html")
    assert table.count() == 2  # every attempt stores its own object
    got = {r["article_id"]: r["body"] for r in content.get_content(refs, table).collect()}
    assert got == {1: "é", 2: None, 3: None}
    info = content.content_info(refs, table)
    assert {r["article_id"]: r["stored_url"] for r in info.collect()} == {1: "u1", 2: None, 3: None}
    # the bodies are not even read
    plan = info._jdf.queryExecution().executedPlan().toString()
    assert all("body:string" not in line for line in plan.splitlines() if "ReadSchema" in line)
