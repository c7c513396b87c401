"""Operators on small tables, streams, sinks, and a sample of the registered queries."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from newsloom.operators import joins, ordered, rollups
from newsloom.sources import readers, writers
from newsloom.streaming import streams


def test_known_name_overrides(spark):
    from newsloom.functions.text import classify_event

    e = spark.createDataFrame([("Letters: Ed Crane", "Ed Crane wrote")], "entry_title string, summary string")
    known = spark.createDataFrame([("ed crane",)], "normalized_name string")
    r = joins.flag_known(classify_event(e), known).first()
    assert r["prefilter_decision"] == "PREFILTER_SKIP_HAS_WIKI_PAGE" and r["prefilter_reason_codes"] == ["LETTERS_HEADER_SKIP", "KNOWN_WIKI_PAGE"]


def test_order_of_input_does_not_matter(spark):
    rows = [("a", 3, 1), ("a", 1, 2), ("b", 2, 3), (None, 9, 4), (None, 8, 5)]
    for data in (rows, rows[::-1]):
        df = spark.createDataFrame(data, "k string, v int, seq int").repartition(3)
        assert sorted((r["k"] or "", r["v"]) for r in ordered.first_wins(df, "k", ["seq"]).collect()) == [("", 8), ("", 9), ("a", 3), ("b", 2)]


def test_priority_order(spark):
    df = spark.createDataFrame([(1, 3, ""), (2, 1, ""), (3, 2, ""), (4, None, "2024")], "seq int, feed_priority int, published_at_utc string")
    assert [r["seq"] for r in ordered.top_k(df, 4, ordered.priority_order()).collect()] == [2, 3, 1, 4]


def test_reliable(spark):
    entries = spark.createDataFrame([("yahoo.com", "host"), ("nytimes.com", "host"), ("dw.com/en", "path_prefix"), ("https://a.org/x", "url_prefix")], "entry string, kind string")
    rows = [("https://uk.news.yahoo.com/1", "uk.news.yahoo.com", True), ("https://fakenytimes.com/1", "fakenytimes.com", False), ("https://www.dw.com/energy", "dw.com", True), ("https://dw.com/de", "dw.com", False), ("https://a.org/xy", "a.org", True)]
    kept = joins.filter_reliable(spark.createDataFrame(rows, "url string, source_domain string, want boolean"), entries)
    assert sorted(r["url"] for r in kept.collect()) == sorted(u for u, _, w in rows if w)


def test_fold(spark):
    """The second pass counts reliable sources only; what wasn't answered is uncertain; what was skipped has no domains."""
    rows = [("e1", 1, "a", True, True), ("e1", 2, "b", True, True), ("e2", 1, "a", True, True), ("e2", 1, "b", True, True), ("e3", 1, "a", False, True), ("e4", 1, "a", True, True)]
    rows += [("e5", 1, "a", True, False), ("e5", 2, "b", True, False), ("e6", 2, "a", True, None), ("e7", 1, "a", True, True), ("e7", 1, "b", True, True), ("e8", 2, "a", True, True), ("e8", 2, "b", True, True)]
    v = spark.createDataFrame([(e, p, i, d, y, r) for i, (e, p, d, y, r) in enumerate(rows)], "event_id string, pass int, rank int, domain string, about_subject boolean, reliable boolean")
    domains = rollups.confirmed_domains(v)
    got = {r["event_id"]: r["gate4b_status"] for r in rollups.fold_verdict(domains).collect()}
    assert got == {"e1": "POSSIBLY_NOTABLE", "e2": "LIKELY_NOTABLE", "e3": "NOT_NOTABLE", "e4": "UNCERTAIN", "e5": "UNCERTAIN", "e6": "NOT_NOTABLE", "e7": "LIKELY_NOTABLE", "e8": "POSSIBLY_NOTABLE"}
    skip = F.when(F.col("event_id") == "e2", "HAS_PAGE").when(F.col("event_id") == "e1", "SKIPPED_INSUFFICIENT_RESULTS")
    got = {r["event_id"]: (r["gate4b_status"], r["confirmed_count"]) for r in rollups.fold_verdict(domains, ~F.col("event_id").isin("e6", "e7", "e8"), skip).collect()}
    assert got["e1"] == ("SKIPPED", 0) and got["e2"] == ("SKIPPED_HAS_PAGE", 0) and got["e6"] == got["e7"] == ("UNCERTAIN", 0) and got["e8"] == ("POSSIBLY_NOTABLE", 0)


def test_feed_lines_and_jsonl(spark, tmp_path):
    (tmp_path / "feeds.md").write_text("# x\n- https://a.org/f 2\n- https://b.org/f 1.5\n- ftp://c 1\nnoise\n")
    assert {(r["url"], r["priority"]) for r in readers.read_feeds(spark, str(tmp_path / "feeds.md")).collect()} == {("https://a.org/f", 2), ("https://b.org/f", None)}
    (tmp_path / "x.jsonl").write_text('{"a": 1}\n\nbad\n[1]\n')
    good, bad = readers.read_jsonl(spark, str(tmp_path / "x.jsonl"), "a INT")
    assert [r["a"] for r in good.collect()] == [1] and bad.count() == 2


def test_snapshot_and_stage(spark, tmp_path):
    df = spark.range(3)
    writers.write_snapshot(df, str(tmp_path / "s"))
    writers.write_snapshot(spark.range(5), str(tmp_path / "s"))
    assert writers.read_snapshot(spark, str(tmp_path / "s")).count() == 5
    writers.write_stage(df, str(tmp_path / "t"))
    with pytest.raises(Exception, match="(?i)exists"):
        writers.write_stage(df, str(tmp_path / "t"))


def test_stream_ingest_is_idempotent(spark, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()
    body = "<rss><channel><item><title>T</title><link>https://example.com/news/story?id=10&amp;utm_source=a</link></item></channel></rss>"
    (landing / "a.xml").write_text(body)
    (landing / "b.xml").write_text(body.replace("utm_source=a", "fbclid=b"))
    for name in ("c1", "c2"):  # a second run with a new checkpoint reads all again
        streams.stream_entries(spark, str(landing), str(tmp_path / "out"), str(tmp_path / name)).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_attribution(spark):
    runs = spark.sql("SELECT 'r1' run_id, timestamp'2024-01-01 00:00:00' started_at, timestamp'2024-01-01 01:00:00' finished_at UNION ALL SELECT 'r2', timestamp'2024-01-01 00:30:00', timestamp'2024-01-01 02:00:00'")
    trials = spark.sql("SELECT 1 trial_id, timestamp'2024-01-01 00:45:00' trial_at UNION ALL SELECT 2, timestamp'2024-01-01 02:10:00' UNION ALL SELECT 3, timestamp'2024-01-01 09:00:00'")
    assert {r["trial_id"]: r["run_id"] for r in joins.attribute_run(trials, runs).collect()} == {1: "r2", 2: "r2", 3: None}


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert F is not None
