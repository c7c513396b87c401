"""Feeds of both dialects with namespaces, and folders of documents with bad and missing files."""

import json
import os

from pyspark.sql import functions as F

from newsloom.sources import readers

RSS = """<?xml version="1.0" encoding="UTF-8"?>
<!-- made by hand --><rss version="2.0" xmlns:dc="http://purl.org/dc/elements/1.1/" xmlns:atom="http://www.w3.org/2005/Atom" xmlns:media="http://m/">
<channel><title>Feed</title><atom:link rel="self" href="https://self.example"/>
<item><title>First</title><atom:link rel="self" href="https://no.example"/><link>https://a.example/1</link><dc:date>2024-01-02T03:04:05Z</dc:date><dc:creator>C. Reator</dc:creator><description> </description><media:content url="x"/></item>
<item><title/><link>https://a.example/2</link><author><name>Nested Name</name></author><pubDate>Thu, 18 Jan 2024 09:30:00 GMT</pubDate><dc:date>1999-01-01</dc:date><guid isPermaLink="false">g2</guid><description>Text</description><media:description>Other</media:description></item>
<item><title>No link</title></item>
<item><title>Plain</title><link> https://a.example/3 </link><author>Plain Author</author></item>
</channel></rss>"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><title type="text">Atom</title>
<entry><title>One</title><link rel="enclosure" href="https://b.example/audio"/><link href="https://b.example/1"/><id>i1</id><author><name>A. One</name></author><author><name>B. Two</name></author><updated>2024-02-01T00:00:00Z</updated><summary/><content>Body</content></entry>
<entry><title>Two</title><link rel="self" href="https://b.example/self"/></entry></feed>"""


def test_feeds_of_both_dialects(spark):
    docs = spark.createDataFrame([("r", RSS), ("a", ATOM), ("bad", "<rss><channel><item>"), ("other", "<html><entry><link href='x'/></entry></html>"), ("none", None), ("noise", "not xml")], "feed_url string, body string")
    got = {(r["feed_url"], r["at"]): r for r in readers.parse_feeds(docs).collect()}
    assert set(got) == {("r", 0), ("r", 1), ("r", 3), ("a", 0)}
    first, second, plain, one = got["r", 0], got["r", 1], got["r", 3], got["a", 0]
    assert (first["entry_url_raw"], first["published"], first["author"], first["summary"], first["feed_title"]) == ("https://a.example/1", "2024-01-02T03:04:05Z", "C. Reator", None, "Feed")
    assert (second["entry_title"], second["author"], second["published"], second["entry_guid"], second["summary"]) == ("(untitled)", "Nested Name", "Thu, 18 Jan 2024 09:30:00 GMT", "g2", "Text")
    assert (plain["entry_url_raw"], plain["author"]) == ("https://a.example/3", "Plain Author")
    assert (one["entry_url_raw"], one["author"], one["published"], one["summary"], one["entry_guid"]) == ("https://b.example/1", "A. One", "2024-02-01T00:00:00Z", "Body", "i1")
    outcomes = {r["feed_url"]: (r["ok"], r["n_items"]) for r in readers.feed_outcomes(docs).collect()}
    assert outcomes["r"] == (True, 4) and outcomes["a"] == (True, 2) and outcomes["other"] == (True, 0)
    assert not any(outcomes[x][0] for x in ("bad", "none", "noise"))


def test_documents_of_a_folder(spark, tmp_path):
    for name, value in (("b.json", '{"run_id": "r1", "new_gate1_events": 2}'), ("a.json", '{"run_id": "r1", "new_gate1_events": 1}'), ("c.json", "[1]"), ("d.json", "{broken"), ("e.json", '{"run_id": "r2", "new_gate1_events": "x"}')):
        (tmp_path / name).write_text(value)
    os.utime(tmp_path / "e.json", (0, 0))
    got = {r["run_id"]: r for r in readers.read_runs(spark, f"{tmp_path}/*.json").collect()}
    assert got["r1"]["new_gate1_events"] == 2 and got["r2"]["new_gate1_events"] is None
    young = readers.read_documents(spark, str(tmp_path), "run_id STRING", max_age_days=30)
    assert {r["run_id"] for r in young.collect()} == {"r1"}
    old = readers.read_documents(spark, str(tmp_path), "run_id STRING", max_age_days=30, now=F.lit("1970-01-02").cast("timestamp"))
    assert old.count() == 3
    assert {os.path.basename(r["file_path"]) for r in readers.bad_documents(spark, str(tmp_path)).collect()} == {"c.json", "d.json"}


def test_missing_inputs_are_empty(spark, tmp_path):
    missing = f"{tmp_path}/nowhere"
    assert readers.read_feeds(spark, f"{missing}/feeds.md").columns == ["url", "priority"] and readers.read_feeds(spark, f"{missing}/feeds.md").count() == 0
    assert readers.read_known_pages(spark, f"{missing}.json").count() == 0 and readers.read_runs(spark, f"{missing}/*.json").count() == 0
    assert readers.read_summaries(spark, f"{missing}/*.json").count() == 0 and readers.bad_documents(spark, missing).count() == 0
    (tmp_path / "known.json").write_text(json.dumps({"entries": {"ada lovelace": {"pageid": 1, "title": "Ada Lovelace"}, "x": None}}))
    assert {(r["normalized_name"], r["pageid"]) for r in readers.read_known_pages(spark, f"{tmp_path}/known.json").collect()} == {("ada lovelace", 1), ("x", None)}
    (tmp_path / "known.json").write_text("nothing of use")
    assert readers.read_known_pages(spark, f"{tmp_path}/known.json").count() == 0


def test_strict_lines_and_input_choice(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"a": 1}\nbad\n')
    try:
        readers.read_jsonl(spark, str(tmp_path / "x.jsonl"), "a INT", strict=True).collect()
        raise AssertionError("a bad line has to stop a strict read")
    except Exception as e:
        assert "Malformed" in str(e) or "FAILFAST" in str(e) or "malformed" in str(e).lower()
    for name, n in (("raw", 1), ("prefiltered", 2), ("own", 3)):
        spark.range(n).write.parquet(f"{tmp_path}/{name}")
    at = lambda n: f"{tmp_path}/{n}"
    assert readers.resolve_events(spark, None, at("prefiltered"), at("raw")).count() == 2
    assert readers.resolve_events(spark, None, at("missing"), at("raw")).count() == 1
    assert readers.resolve_events(spark, at("own"), at("prefiltered"), at("raw")).count() == 3
