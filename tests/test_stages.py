"""Whole stages: existence cascade, response shapes, nested records, ingest, digest, split and counted writes, fetch state."""

import datetime as dt
import json

import duckdb
import pytest
from pyspark.sql import functions as F

from newsloom import schemas
from newsloom.functions import specs
from newsloom.functions.text import looks_like_person
from newsloom.operators import existence, records, rollups
from newsloom.plans import pipelines, stages
from newsloom.sources import readers, writers
from newsloom.streaming import streams

T0 = dt.datetime(2024, 1, 1)


def at(**k):
    return T0 + dt.timedelta(**k)


@pytest.mark.parametrize(("title", "description", "want"), [("X", "British actress", True), ("X", "football coach", False), ("Ann (visual artist)", None, True), ("Ann (artists' book)", None, False), ("X", "visual artist and poet", True), ("X", "cricketer", False), ("Ann (cricketer)", "", True), (None, None, False), ("X", "factory", False)])
def test_person_pages(spark, title, description, want):
    row = spark.createDataFrame([(title, description)], "t string, d string")
    assert row.select(looks_like_person(F.col("t"), F.col("d"))).first()[0] is want


def test_cascade_reaches_every_outcome(spark):
    names = ["Exact Person", "Town Name", "Many Meanings", "Link Person", "Variant Person", "Search Person", "Near Person", "Context Only", "Nobody", "Moved Person", "No Link", "Second Variant"]
    pages = [
        ("Exact Person", False, "a poet", "u1"), ("Town Name", False, "a town", "u2"), ("Many Meanings", True, None, None), ("Link Person", True, None, None), ("Link Person (poet)", False, None, "u4"),
        ("Variant Person (poet)", False, "x", "u5"), ("The Search Person story", False, "a journalist", "u6"), ("Other One", False, "a chef", "u7"), ("Some Place", False, "a place", "u8"), ("New Title", False, "an actor", "u9"),
        ("No Link", True, None, None), ("Second Variant (artist)", True, None, None), ("Second Variant (poet)", False, "z", None), ("A List", True, "list", "u10"),
    ]
    links = [("Many Meanings", 0, "Unrelated"), ("Many Meanings", 2, "Many Meanings (ship)"), ("Link Person", 1, "Link Person (poet)"), ("Link Person", 0, "Link Person (artist)")]
    search = [("Search Person", 1, "Some Place"), ("Search Person", 2, "The Search Person story"), ("Near Person", 1, "Other One"), ("Near Person", 2, "Some Place"), ("Context Only", 3, "A List"), ("Nobody", 1, "Not There"), ("Nobody", 6, "Other One")]
    probe = existence.page_probe(
        spark.createDataFrame([(n,) for n in [*names, "Nobody", None]], "name string"), spark.createDataFrame(pages, "title string, is_disambig boolean, description string, url string"), ("artist", "poet"),
        spark.createDataFrame(search, "name string, rank int, title string"), spark.createDataFrame(links, "title string, at int, link string"), spark.createDataFrame([("Moved Person", "New Title")], "from string, to string"),
    )
    got = {r["name"]: (r["status"], r["via"], r["resolved_title"], r["candidates"], r["context"], r["collisions"]) for r in probe.collect()}
    has = lambda via, title: ("HAS_PAGE", via, title, None, None, None)
    uncertain = lambda *lists: ("UNCERTAIN", "search-uncertain", None, *lists)
    base = "https://en.wikipedia.org/wiki/"
    assert got == {
        "Exact Person": has("exact", "Exact Person"), "Moved Person": has("exact", "New Title"), "Link Person": has("disambiguation-link", "Link Person (poet)"), "Variant Person": has("variant", "Variant Person (poet)"),
        "Second Variant": has("variant", "Second Variant (poet)"), "Search Person": has("search", "The Search Person story"), "Near Person": uncertain(["u7"], ["u8"], []), "Context Only": uncertain([], ["u10"], []),
        "Town Name": uncertain([], [], ["u2"]), "Many Meanings": uncertain([], [], []), "No Link": uncertain([], [], []), "Nobody": ("MISSING", "search-empty", None, None, None, None),
    }
    assert next(r["url"] for r in probe.collect() if r["name"] == "Second Variant") == base + "Second_Variant_%28poet%29"
    assert {r["status"]: r["n"] for r in existence.probe_counts(probe).collect()} == {"HAS_PAGE": 6, "UNCERTAIN": 5, "MISSING": 1}


GOOD = {"person_detected": True, "subject_name_as_written": "A", "subject_name_full": None, "name_completeness": "UNKNOWN", "primary_focus": False, "gate1_decision": "FAIL", "reasoning_summary": ["x"], "signal_type": "OTHER", "confidence": "low"}


@pytest.mark.parametrize(("change", "want"), [
    ({}, []), ({"confidence": "sure"}, ["$.confidence: not one of the values"]), ({"person_detected": "yes"}, ["$.person_detected: not true or false"]), ({"reasoning_summary": []}, ["$.reasoning_summary: fewer than 1 items"]),
    ({"reasoning_summary": ["a", "b", 3]}, ["$.reasoning_summary: more than 2 items", "$.reasoning_summary[2]: not text"]), ({"signal_type": None}, ["$.signal_type: not text"]), ({"new": 1, "more": 2}, ["$.more: not expected", "$.new: not expected"]),
])
def test_triage_shape(spark, change, want):
    rows = spark.createDataFrame([(json.dumps(GOOD | change),)], "j string")
    assert specs.validate(rows, "j", specs.TRIAGE).first()["violations"] == want
    batch = spark.createDataFrame([(json.dumps({"items": [GOOD | {"event_id": "e"}, GOOD | {"event_id": "f"} | change]}),)], "j string")
    assert specs.validate(batch, "j", specs.TRIAGE_BATCH).first()["violations"] == [w.replace("$", "$.items[1]") for w in want]


def test_other_shapes(spark):
    check = lambda value, kind: specs.validate(spark.createDataFrame([(value,)], "j string"), "j", kind).first()["violations"]
    verdict = {"rank": 1, "about_subject": True, "confidence": 0.5, "reasoning": "r"}
    assert check(json.dumps({"results": [verdict]}), specs.LISTED_VERDICTS) == []
    assert check(json.dumps({"results": [verdict, {**verdict, "rank": 1.5, "confidence": 2}]}), specs.LISTED_VERDICTS) == ["$.results[1].rank: not a whole number", "$.results[1].confidence: above 1"]
    assert check(json.dumps({"results": [verdict]}), specs.OTHER_VERDICTS) == ["$.results[0].is_reliable_source: missing"]
    assert check('{"status":"MISSING","matched_title":null,"confidence":1,"evidence":["a"]}', specs.MATCH) == []
    assert check(None, specs.MATCH) == check("{", specs.MATCH) == ["$: no JSON"] and check("[]", specs.MATCH) == ["$: not an object"]


def test_candidate_records(spark):
    subjects = spark.createDataFrame([("e1", "Ada Byron", None), ("e2", "Bob Fail", 1), ("e3", "No Hits", 2)], "event_id string, subject_name string, feed_priority int").withColumn("published_at_utc", F.lit("2024")).withColumn("seq", F.col("event_id"))
    results = [("Ada Byron", 1, "Ada", 5, "s1"), ("Ada Byron", 2, None, 6, "s2"), ("Ada Byron", 3, "Byron Court", 7, None), ("Ada Byron", 4, "Broken", 8, None), ("Ada Byron", 5, "Again", 5, None), ("Bob Fail", 1, "Bob", 9, None)]
    pages = [("Ada Lovelace", 5, "f", False, "a countess", "x", ["Category:1815 births", "Living people"]), ("Broken", 8, "f", False, None, None, [])]
    out = pipelines.candidate_sets(
        subjects, spark.createDataFrame(results, "query string, rank int, title string, pageid long, snippet string"), spark.createDataFrame(pages, "title string, pageid long, fullurl string, is_disambig boolean, description string, extract string, categories array<string>"),
        spark.createDataFrame([("Ada", "Ada Lovelace")], "from string, to string"), search_errors=spark.createDataFrame([("Bob Fail", "429")], "query string, error string"), page_errors=spark.createDataFrame([("Broken", "timeout")], "title string, error string"),
    )
    got = {r["event_id"]: r for r in out.collect()}
    ada = got["e1"]["candidates"]
    assert [(c["rank"], c["title"], c["pageid"], c["redirected_from"], c["biography_score"], c["biography_prioritized"]) for c in ada] == [(1, "Ada Lovelace", 5, "Ada", 8, True), (3, "Byron Court", None, None, 0, False), (4, "Broken", None, None, 0, False)]
    assert got["e1"]["errors"] == ["page_error:Broken:timeout"] and got["e1"]["query"]["variants"] == ["Ada Byron"]
    assert got["e2"]["errors"] == ["search_error:429"] and got["e2"]["candidates"] == [] and got["e3"]["candidates"] == [] and got["e3"]["errors"] == []
    trials = spark.createDataFrame([("e3", 1, True), ("e2", 2, False)], "event_id string, seq int, ok boolean")
    work = pipelines.match_worklist(out, trials).orderBy("position").collect()
    assert [(r["event_id"], r["position"], r["settled"], [c["rank"] for c in r["shown"]]) for r in work] == [("e2", 1, "MISSING", []), ("e1", 2, None, [1, 3])]
    assert [r["event_id"] for r in pipelines.match_worklist(out, trials, retry=True).collect()] == ["e2"]


def test_coverage_and_reliable_records(spark):
    subjects = spark.createDataFrame([("e1", "Ann Lee", "t", ""), ("e2", "Bo Day", "t", "")], "event_id string, subject_name string, title string, summary string")
    answers = [('"Ann Lee"', 20, 0, [("A", "https://x.org/1"), ("B", "https://bad.net/1"), ("A2", "https://x.org/1")]), ('"Ann Lee"', 20, 1, [("C", "https://sub.x.org/2")]), ('"Bo Day"', 20, 0, [("D", "https://x.org/3")])]
    sets = pipelines.coverage_sets(subjects, spark.createDataFrame(answers, "query string, count int, offset int, results array<struct<title: string, url: string>>"), spark.createDataFrame([('"Bo Day"', "500")], "query string, error string"))
    got = {r["event_id"]: r for r in sets.collect()}
    assert [(x["rank"], x["title"]) for x in got["e1"]["results"]] == [(1, "A"), (2, "B"), (3, "C")] and got["e1"]["errors"] == [] and got["e1"]["result_count"] == 3
    assert got["e2"]["results"] == [] and got["e2"]["errors"] == ['search_error:"Bo Day":500'] and got["e2"]["result_count"] == 0
    kept = pipelines.reliable_sets(sets, spark.createDataFrame([("x.org", "host")], "entry string, kind string"))
    got = {r["event_id"]: r for r in kept.collect()}
    assert [(x["rank"], x["title"]) for x in got["e1"]["results"]] == [(1, "A"), (2, "C")] and (got["e1"]["result_count"], got["e1"]["unfiltered_count"]) == (2, 3)
    assert tuple(rollups.filter_totals(kept).first()) == (2, 1)


def test_ingest_run_and_its_counters(spark):
    item = lambda url, date: f"<item><title>T</title><link>{url}</link><pubDate>{date}</pubDate></item>"
    good = f"<rss><channel>{item('https://a.org/1?utm_source=x', '2024-01-01')}{item('https://a.org/2', 'no date')}{item('not a url', '')}</channel></rss>"
    other = f"<rss><channel>{item('https://a.org/1', '2024-01-01')}{item('https://a.org/old', '2024-01-01')}</channel></rss>"
    rows = [("f1", good, False, None), ("f2", other, False, None), ("f3", None, True, None), ("f4", None, False, "timeout"), ("f5", "<rss", False, None)]
    fetches = spark.createDataFrame([(u, b, n, e, "tag" + u, None, u, 200, at(hours=1), e) for u, b, n, e in rows], "feed_url string, body string, not_modified boolean, error string, etag string, last_modified string, resolved_url string, last_status int, last_fetch_at timestamp, last_error string")
    old = pipelines.ingest(spark.createDataFrame([("f", f"<rss><channel>{item('https://a.org/old', '')}</channel></rss>")], "feed_url string, body string"), spark.createDataFrame([], "url_key string"))
    state = spark.createDataFrame([("f1", "old", None, None, 200, at(hours=0), None), ("f9", "kept", None, None, 200, at(hours=0), None)], schemas.FETCH_STATE)
    run = pipelines.ingest_run(fetches, old.select("url_key"), state)
    assert sorted((r["feed_url"], r["entry_url_canonical"]) for r in run.events.collect()) == [("f1", "https://a.org/1"), ("f1", "https://a.org/2")]
    assert run.seen.count() == 2
    assert run.stats.first().asDict() == {"feeds_total": 5, "feeds_succeeded": 3, "feeds_failed": 2, "feeds_not_modified": 1, "entries_parsed": 5, "entries_invalid": 1, "new_events_appended": 2, "duplicates_skipped": 2, "date_parse_errors": 1}
    assert {r["feed_url"]: r["etag"] for r in run.fetch_state.collect()} == {**{f"f{i}": f"tagf{i}" for i in range(1, 6)}, "f9": "kept"}


def test_a_feed_of_several_documents(spark, tmp_path, monkeypatch):
    """A long feed comes in documents, which are one feed; a page that one of them repeats is an entry once, from its first place."""
    item = lambda n, date: f"<item><title>T</title><link>https://a.org/{n}</link><pubDate>{date}</pubDate></item>"
    rss = lambda *items: f"<rss><channel>{''.join(items)}</channel></rss>"
    rows = [("f1", rss(item(9, "2024-01-09"), item(1, "2024-01-03")), 2, None), ("f1", rss(item(1, "2024-01-01"), item(2, "2024-01-02")), 0, None), ("f2", rss(item(3, "2024-01-01")), 0, None), ("f2", "<rss", 1, None), ("f3", None, 0, "timeout"), ("f3", rss(), 1, None)]
    fetches = spark.createDataFrame([(u, b, n, None, e, None, None, u, 200, at(hours=1), e) for u, b, n, e in rows], "feed_url string, body string, first long, not_modified boolean, error string, etag string, last_modified string, resolved_url string, last_status int, last_fetch_at timestamp, last_error string")
    run = pipelines.ingest_run(fetches, spark.createDataFrame([], "url_key string"))
    assert sorted((r["entry_url_canonical"][-1], r["at"], r["published_at_utc"][:10]) for r in run.events.collect()) == [("1", 0, "2024-01-01"), ("2", 1, "2024-01-02"), ("3", 0, "2024-01-01"), ("9", 2, "2024-01-09")]
    got = run.stats.first().asDict()
    assert (got["feeds_total"], got["feeds_succeeded"], got["feeds_failed"], got["entries_parsed"], got["duplicates_skipped"]) == (3, 1, 2, 5, 1)
    pages = [(n, f"https://h.example/{n}", "<title>t</title>") for n in range(0, 50, 2)]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    monkeypatch.setattr(stages, "ITEMS", 10)
    docs = stages._feed_documents(spark, str(tmp_path)).collect()
    assert sorted((r["feed_url"], r["first"]) for r in docs) == [("h.example", n) for n in range(0, 50, 10)]
    assert readers.parse_feeds(stages._feed_documents(spark, str(tmp_path))).count() == 22  # every eleventh page has no link


def test_entries_of_a_key_by_title_as_in_sql(spark, tmp_path):
    """Entries of one address go by their titles as these stand in the page, white space and all, then by their place in the feed."""
    pairs = [("a", " b"), ("b", "\tc"), ("", "a"), (" ", ""), ("(untitled)", " "), ("e\n", "e\r\n"), ("x&amp;y", " x&amp;y"), ("z", "ä")]
    ids = iter([n for n in range(200) if n % 11 and n % 4])  # pages with a link that are not seen
    pages = [(next(ids), f"https://{host}/{i}/{k}", f"<title>{t}</title>") for host in ("example.com", "abcd.example.com") for k, pair in enumerate(pairs) for i in (0, 1) for t in pair[:: 1 - 2 * i]]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got = stages.QUERIES["ingest_run"](spark, str(tmp_path)).collect()
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    want = duck.execute(f"SELECT url_key, feed_url, published_at_utc, date_parse_error FROM ({stages.SQL['ingest_run']})").fetchall()
    assert len(got) == 4 * len(pairs) and sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    twice = [(n, "https://example.com/1", "<title>same</title>") for n in (62, 5, 1, 17)]
    spark.createDataFrame(twice, "page_id long, url string, html string").write.parquet(str(tmp_path / "open" / "pages.parquet"))
    assert [r["published_at_utc"] for r in stages.QUERIES["ingest_run"](spark, str(tmp_path / "open")).collect()] == ["2024-01-02T00:00:00Z"]  # page 1


def test_fetches_are_made_once(spark, tmp_path):
    """Counters and states read what the run kept, not what fetches are made from."""
    rows = [("f1", "<rss><channel><item><title>T</title><link>https://a.org/1</link></item></channel></rss>"), ("f2", "<rss")]
    columns = [F.lit(None).cast("string").alias(c) for c in ("error", "etag", "last_modified", "last_error")]
    spark.createDataFrame(rows, "feed_url string, body string").write.parquet(str(tmp_path / "made"))
    made = spark.read.parquet(str(tmp_path / "made"))
    fetches = made.select("*", *columns, F.lit(False).alias("not_modified"), F.col("feed_url").alias("resolved_url"), F.lit(200).alias("last_status"), F.lit("2024-06-01").cast("timestamp").alias("last_fetch_at"))
    run = pipelines.ingest_run(fetches, spark.createDataFrame([], "url_key string"))
    for table in (run.stats, run.fetch_state, run.events):
        assert table.inputFiles() and not [f for f in table.inputFiles() if str(tmp_path) in f]
    assert tuple(run.stats.first())[:3] == (2, 1, 1) and run.events.count() == 1 and run.fetch_state.count() == 2


def test_digest_document(spark, tmp_path):
    manifests = spark.createDataFrame([("r1", at(hours=1), at(hours=2)), ("r2", at(hours=30), at(hours=31))], "run_id string, started_at timestamp, finished_at timestamp")
    summaries = spark.createDataFrame([("r1", at(hours=2)), ("r2", at(hours=31)), ("r9", at(hours=32))], "run_id string, generated_at timestamp")
    like, some = "LIKELY_NOTABLE", "POSSIBLY_NOTABLE"
    trials = [
        ("e1", like, "Ann Lee", at(hours=30, minutes=5), 1, "t1", ["x.org"], None), ("e1", like, "ANN LEE ", at(hours=30, minutes=9), 2, "t1b", [], None), ("e2", like, "Bo Day", at(hours=1, minutes=5), 3, "t", [], None),
        ("e3", some, "Cy Old", at(hours=30, minutes=5), 4, "t3", None, ["https://w.net/1", "", "https://own.org/3"]), ("e4", "UNCERTAIN", "Di", at(hours=30, minutes=5), 5, "t", [], None), ("e5", like, " ", at(hours=30, minutes=5), 6, "t", [], None),
    ]
    events = spark.createDataFrame([("e1", 1, "https://own.org/1", "2024"), ("e3", 2, "https://own.org/3", None)], "event_id string, seq int, rss_entry_url string, rss_published_at_utc string")
    cover = spark.createDataFrame([("e1", 1, ["https://a.org/1", "https://own.org/1", "https://www.b.org/2", "https://a.org/1"])], "event_id string, seq int, urls array<string>")
    frame = spark.createDataFrame(trials, "event_id string, gate4b_status string, subject_name string, trial_at timestamp, seq long, source_article_title string, domains array<string>, results_sent array<string>")
    head, people = pipelines.digest(frame, summaries, manifests, events, cover, F.lit(at(hours=32)))
    got = {(r["gate4b_status"], r["person"]): r for r in people.collect()}
    assert set(got) == {(like, "ann lee"), (some, "cy old")}
    ann, cy = got[like, "ann lee"], got[some, "cy old"]
    assert ann["subject_name"] == "Ann Lee" and ann["run_ids"] == ["r2"] and ann["event_count"] == 1 and [e["source_article_title"] for e in ann["events"]] == ["t1b"]
    assert ann["all_urls"] == ["https://a.org/1", "https://www.b.org/2"] and ann["all_domains"] == ["x.org", "a.org", "b.org"] and ann["events"][0]["domains"] == ["a.org", "b.org"]
    assert cy["all_urls"] == ["https://w.net/1"] and cy["all_domains"] == ["w.net"] and cy["events"][0]["rss_entry_url"] == "https://own.org/3"
    top = head.first()
    assert top["counts"].asDict() == {"runs_in_window": 2, "likely_people": 1, "possibly_people": 1, "likely_events": 1, "possibly_events": 1}
    assert [(r["run_id"], r["started_at"] is None) for r in top["runs"]] == [("r2", False), ("r9", True)]
    sections = {"likely_notable_people": people.where(f"gate4b_status = '{like}'"), "possibly_notable_people": people.where(f"gate4b_status = '{some}'")}
    writers.write_digest(head, sections, ["person"], str(tmp_path / "d"))
    again, read = writers.read_digest(spark, str(tmp_path / "d"), head.schema, people.schema, list(sections))
    assert again.first()["counts"] == top["counts"] and read["likely_notable_people"].first()["events"] == ann["events"]


def test_split_and_counted_writes(spark, tmp_path):
    rows = spark.createDataFrame([(1, True), (2, False), (3, None), (4, True)], "id int, keep boolean")
    passed, skipped = writers.write_split(rows, F.col("keep"), str(tmp_path / "s"))
    assert {r["id"] for r in passed.collect()} == {1, 4} and {r["id"] for r in skipped.collect()} == {2, 3} and passed.columns == ["id", "keep"]
    one, none = writers.write_split(rows.where("keep"), F.col("keep"), str(tmp_path / "t"))
    assert one.count() == 2 and none.count() == 0
    counted = writers.write_counted(rows, str(tmp_path / "c"), kept=F.count_if("keep"), largest=F.max("id")).first()
    assert counted.asDict() == {"rows": 4, "kept": 2, "largest": 4} and spark.read.parquet(str(tmp_path / "c")).count() == 4
    table = rollups.stage_counts(a=(rows, F.col("id") > 2), b=(rows.limit(0), None)).collect()
    assert sorted((r["stage"], r["rows"], r["new_rows"]) for r in table) == [("a", 4, 2), ("b", 0, 0)]
    runs = spark.createDataFrame([("r1", at(hours=1), None, [(1.5,), (None,)]), ("r2", None, at(hours=3), []), ("r3", None, None, None)], "run_id string, generated_at timestamp, finished_at timestamp, stages array<struct<duration_s: double>>")
    assert rollups.latest_run(runs).first()["run_id"] == "r2" and {r["run_id"]: r["seconds"] for r in rollups.run_durations(runs).collect()} == {"r1": 1.5, "r2": 0.0, "r3": 0.0}


def test_fetch_state_of_stream_and_batch(spark, tmp_path):
    """Feeds come in three files; one is not fetched for longer than the horizon and is forgotten, one comes back."""
    parts = [[("a", "1", at(hours=0)), ("b", "1", at(hours=1)), ("c", "1", at(hours=0))], [("a", "2", at(hours=5)), ("b", "0", at(minutes=30)), (None, "x", at(hours=5))], [("a", "3", at(hours=30)), ("c", "2", at(hours=30))]]
    frame = lambda rows: spark.createDataFrame([(u, e, None, None, 200, t, None) for u, e, t in rows], schemas.FETCH_STATE).coalesce(1)
    for rows in parts:
        frame(rows).write.mode("append").parquet(str(tmp_path / "in"))
        log = streams.stream_fetch_state(spark.readStream.schema(schemas.FETCH_STATE).parquet(str(tmp_path / "in")), 10 * 3600)
        log.writeStream.format("parquet").option("path", str(tmp_path / "log")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
    got = streams.fetch_state_of(spark.read.parquet(str(tmp_path / "log"))).collect()
    assert {(r["feed_url"], r["etag"]) for r in got} == {("a", "3"), ("c", "2")}
    everything = frame([r for p in parts for r in p])
    assert {tuple(r) for r in rollups.fetch_state(everything, horizon="10 hours").collect()} == {tuple(r) for r in got}
    assert {(r["feed_url"], r["etag"]) for r in rollups.fetch_state(everything).collect()} == {("a", "3"), ("b", "1"), ("c", "2")}


def test_fetch_state_of_many_feeds_in_groups(spark, tmp_path, monkeypatch):
    """Feeds share groups, so the state has fewer rows than feeds; of equal times one row counts, as in the batch form; times keep their microseconds."""
    monkeypatch.setattr(streams, "GROUPS", 2, raising=False)
    parts = [[(f"f{i}", str(i), at(seconds=i, microseconds=i)) for i in range(60)] + [("f3", x, at(seconds=3, microseconds=3)) for x in "pqr"], [(f"f{i}", "new", at(hours=9, seconds=i, microseconds=457)) for i in range(0, 60, 7)], [("f59", "newest", at(hours=10, seconds=30, milliseconds=500))]]
    frame = lambda rows: spark.createDataFrame([(u, e, None, None, None if e == "q" else 200, t, None) for u, e, t in rows], schemas.FETCH_STATE).coalesce(1)
    for rows in parts:
        frame(rows).write.mode("append").parquet(str(tmp_path / "in"))
        log = streams.stream_fetch_state(spark.readStream.schema(schemas.FETCH_STATE).parquet(str(tmp_path / "in")), 10 * 3600)
        query = log.writeStream.format("parquet").option("path", str(tmp_path / "log")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        query.awaitTermination()
        assert sum(o["numRowsTotal"] for o in query.lastProgress["stateOperators"]) <= 2
    got = {tuple(r) for r in streams.fetch_state_of(spark.read.parquet(str(tmp_path / "log"))).collect()}
    want = rollups.fetch_state(frame([r for p in parts for r in p]), horizon="10 hours")
    assert got == {tuple(r) for r in want.collect()} and 9 < len(got) < 40
    expired = [r["feed_url"] for r in spark.read.parquet(str(tmp_path / "log")).where("expired").collect()]
    assert len(expired) == len(set(expired)) == 60 - len(got)


def test_records_of_nothing(spark):
    rows = spark.createDataFrame([], "event_id string, rank int, title string")
    sets = records.nested(rows, ["event_id"], ["rank"], ["rank", "title"], "found")
    assert records.with_nested(spark.createDataFrame([("e",)], "event_id string"), sets, "event_id", "found").first()["found"] == []


def test_known_names_of_stream_and_batch(spark, tmp_path):
    """Names come in three files, one of them late: the log ends with what an upsert of all rows gives."""
    rows = [[("ann", "A", "t1", 1), ("bo", "B", "t2", 2)], [("ann", "A2", "t5", 5), ("", "x", "t6", 6)], [("bo", "old", "t0", 0), ("cy", "C", "t7", 7)]]
    schema = "normalized_name string, title string, added_at_utc string, seq long"
    for part in rows:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        source = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        streams.stream_upsert_known(source, str(tmp_path / "log"), str(tmp_path / "state")).awaitTermination()
    want = rollups.upsert_known(spark.createDataFrame([], schema), spark.createDataFrame([r for p in rows for r in p], schema))
    got = streams.known_of(spark, str(tmp_path / "log")).select(want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.where("normalized_name = 'bo'").first()["added_at_utc"] == "t0"


def test_digest_windows_slide_and_drop_late_rows(spark, tmp_path):
    schema = "status string, at timestamp"
    for i, part in enumerate([[("L", at(hours=1)), ("L", at(hours=13))], [("P", at(hours=80))], [("L", at(hours=2)), ("P", at(hours=81))]]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        counts = streams.stream_digest(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), "at", "24 hours", "12 hours", "1 hour")
        counts.writeStream.outputMode("append").format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
    got = {(r["starts"], r["status"]): r["n"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {(at(hours=-12), "L"): 1, (at(), "L"): 2, (at(hours=12), "L"): 1}  # the row of hour 2 came after its windows closed


def test_report_of_an_empty_section(spark, tmp_path):
    rows = [("Ann", "LIKELY_NOTABLE", 2, "t", ["u1", ""], 0, 1), ("Ann", "LIKELY_NOTABLE", 3, "t2", ["u2"], 0, 2), ("Bo", "LIKELY_NOTABLE", 1, None, None, 0, 3), ("Cy", "NOT_NOTABLE", 9, "t", [], 0, 4)]
    frame = spark.createDataFrame(rows, "subject_name string, gate4b_status string, confirmed_count int, source_article string, source_urls array<string>, second_pass_confirmed_count int, seq int")
    lines = pipelines.run_report(frame, str(tmp_path / "d")).orderBy("section", "line_no").collect()
    assert [(r["section"], r["line_no"], r["line"]) for r in lines] == [("LIKELY_NOTABLE", i + 1, x) for i, x in enumerate(["- Ann", "  t2", "    u2", "- Bo", "  (untitled)"])] + [("POSSIBLY_NOTABLE", 1, "- None")]
    assert spark.read.json(str(tmp_path / "d" / "head")).first().asDict() == {"likely_notable_count": 2, "possibly_notable_count": 0}
