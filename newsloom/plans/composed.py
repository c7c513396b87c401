"""Registered queries of look-up joins, sinks, streams and end-to-end compositions, with SQL.

Sinks and streams write below ``spark.checkpoint.dir``, which all executors share, and the query
reads what was written; nothing passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsloom.functions import text, urls
from newsloom.operators import joins, ordered
from newsloom.plans import pipelines
from newsloom.plans import registry as base
from newsloom.sources import shared, writers
from newsloom.streaming import streams

QUERIES: dict = {}
SQL: dict = {}


def _add(name, fn, sql):
    QUERIES[name] = fn
    SQL[name] = sql


_folder = shared.folder


def _stream(spark: SparkSession, sf: str, table: str) -> DataFrame:
    schema = base._t(spark, sf, table).schema
    return spark.readStream.schema(schema).parquet(f"{sf}/{table}.parquet*")


def _appended(rows: DataFrame, name: str) -> DataFrame:
    """All rows that a stream appends, by a file sink."""
    spark = rows.sparkSession
    path = _folder(spark, name)
    rows.writeStream.format("parquet").option("path", f"{path}/rows").option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{path}/rows")


def _final(rows: DataFrame, name: str) -> DataFrame:
    """The last complete result of an aggregating stream, as a snapshot."""
    spark = rows.sparkSession
    path = _folder(spark, name)
    query = rows.writeStream.outputMode("complete").foreachBatch(lambda batch, _: writers.write_snapshot(batch, f"{path}/rows"))
    query.option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start().awaitTermination()
    return writers.read_snapshot(spark, f"{path}/rows")


def _trial(spark, sf):
    return base.trial(spark, sf)


# --- selection and look-ups


def select_triaged(spark, sf):
    rows = _trial(spark, sf).withColumn("subject_name", F.when(F.col("event_id") % 5 != 0, F.col("event_id").cast("string")))
    rows = rows.withColumn("decision", F.col("status"))
    return pipelines.select_triaged(rows, ("LIKELY", "POSSIBLY")).select("event_id", "seq", "reason")


_add("select_triaged", select_triaged, f"WITH {base.TRIAL} SELECT event_id, min(seq) AS seq, CASE WHEN event_id % 5 = 0 THEN 'missing_subject' WHEN arg_min(status, seq) NOT IN ('LIKELY', 'POSSIBLY') THEN 'decision_not_selected' END AS reason FROM trial GROUP BY event_id")


def search_lookup(spark, sf):
    variants = base._t(spark, sf, "customer").select(F.col("c_custkey").alias("event_id"), F.lit(0).alias("variant_no"), F.col("c_nationkey").cast("string").alias("variant"))
    rank = F.row_number().over(Window.partitionBy("s_nationkey").orderBy("s_suppkey"))
    results = base._t(spark, sf, "supplier").select(F.col("s_nationkey").cast("string").alias("query"), rank.alias("rank"), F.col("s_name").alias("title"))
    return joins.search_lookup(variants, results, 2).select("event_id", "variant", F.col("rank").cast("long").alias("rank"), "title")


_add("search_lookup", search_lookup, "WITH r AS (SELECT s_nationkey, s_name, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS rank FROM supplier) SELECT c_custkey AS event_id, CAST(c_nationkey AS VARCHAR) AS variant, rank, s_name AS title FROM customer JOIN r ON c_nationkey = s_nationkey WHERE rank <= 2")


def attach_pages(spark, sf):
    s = base._t(spark, sf, "supplier")
    moved = F.concat("s_name", F.lit(" II"))
    redirects = s.where("s_suppkey % 4 = 1").select(F.col("s_name").alias("from"), moved.alias("to"))
    pages = s.where("s_suppkey % 3 <> 0").select(F.when(F.col("s_suppkey") % 4 == 1, moved).otherwise(F.col("s_name")).alias("title"), F.col("s_suppkey").alias("pageid"))
    return joins.attach_pages(s.select("s_suppkey", F.col("s_name").alias("title")), pages, redirects).select("s_suppkey", "title", "redirected_from", "pageid")


_add("attach_pages", attach_pages, "SELECT s_suppkey, s_name || CASE WHEN s_suppkey % 4 = 1 THEN ' II' ELSE '' END AS title, CASE WHEN s_suppkey % 4 = 1 THEN s_name END AS redirected_from, CASE WHEN s_suppkey % 3 <> 0 THEN s_suppkey END AS pageid FROM supplier")


def second_pass_input(spark, sf):
    t = _trial(spark, sf)
    return joins.second_pass_input(t.select("event_id").distinct(), t.where("seq % 3 = 0").select("event_id", "seq", F.col("status").alias("found"))).select("event_id", "found")


_add("second_pass_input", second_pass_input, f"WITH {base.TRIAL} SELECT event_id, arg_max(status, seq) FILTER (WHERE seq % 3 = 0) AS found FROM trial GROUP BY event_id")


def _answers(spark, sf):
    """Verdict rows of which every third has a sent result, and every second its own domain."""
    v = base.verdict(spark, sf)
    sent = v.where("page_id % 3 = 0").select("event_id", "pass", "rank", F.when(F.col("page_id") % 9 == 0, F.lit("")).otherwise(F.col("domain")).alias("domain"))
    return v.withColumn("domain", F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("own"), F.col("page_id") % 7, F.lit(".example")))), sent


_PLACED = f"{base.VERDICT}, placed AS (SELECT event_id, page_id, pass, rank, about_subject, reliable, coalesce(CASE WHEN page_id % 3 = 0 AND page_id % 9 <> 0 THEN nullif(domain, '') END, CASE WHEN page_id % 2 = 0 THEN 'own' || (page_id % 7) || '.example' END) AS domain FROM verdict)"
_add("verdict_domains", lambda s, d: joins.verdict_domains(*_answers(s, d)).select("event_id", "page_id", "domain"), f"WITH {_PLACED} SELECT event_id, page_id, domain FROM placed")


def verdicts(spark, sf):
    answers, sent = _answers(spark, sf)
    out = pipelines.verdicts(answers, sent)
    return out.select("event_id", "gate4b_status", F.col("reliable_domain_count").cast("long").alias("domains"))


_add("verdicts", verdicts, f"""WITH {_PLACED}, a AS (SELECT event_id, count(DISTINCT domain) FILTER (WHERE about_subject AND pass = 1) AS f, count(DISTINCT domain) FILTER (WHERE about_subject AND (pass = 1 OR reliable)) AS b FROM placed GROUP BY event_id)
SELECT event_id, CASE WHEN f >= 2 THEN 'LIKELY_NOTABLE' WHEN b >= 2 THEN 'POSSIBLY_NOTABLE' WHEN f = 1 THEN 'UNCERTAIN' ELSE 'NOT_NOTABLE' END AS gate4b_status, CASE WHEN f >= 2 THEN f ELSE b END AS domains FROM a""")


def match_batch(spark, sf):
    t = _trial(spark, sf)
    answers = ordered.last_wins(t.where("seq % 3 = 0").select("event_id", "seq", "status"), "event_id", ["seq"])
    return joins.match_batch(t.select("event_id").distinct(), answers).select("event_id", "status", "json_parse_error")


_add("match_batch", match_batch, f"WITH {base.TRIAL}, a AS (SELECT event_id, arg_max(status, seq) FILTER (WHERE seq % 3 = 0) AS status FROM trial GROUP BY event_id) SELECT event_id, status, CASE WHEN status IS NULL THEN 'event_id_missing_in_batch_output' END AS json_parse_error FROM a")


def enrich_verdicts(spark, sf):
    t = _trial(spark, sf)
    events = t.select("event_id", "seq", F.col("status").alias("last_status"))
    coverage = t.where("seq % 3 = 0").select("event_id", "seq", F.col("confirmed_count").alias("covered"))
    return joins.enrich_verdicts(t.where("status = 'LIKELY'").select("event_id", F.col("seq").alias("trial_no")), events, coverage).select("event_id", "trial_no", "last_status", "covered")


_add("enrich_verdicts", enrich_verdicts, f"WITH {base.TRIAL}, e AS (SELECT event_id, arg_max(status, seq) AS last_status FROM trial GROUP BY event_id), c AS (SELECT event_id, arg_max(confirmed_count, seq) AS covered FROM trial WHERE seq % 3 = 0 GROUP BY event_id) SELECT t.event_id, t.seq AS trial_no, last_status, covered FROM trial t LEFT JOIN e ON t.event_id = e.event_id LEFT JOIN c ON t.event_id = c.event_id WHERE status = 'LIKELY'")


# --- sinks


def append_log(spark, sf):
    path, t = _folder(spark, "log"), _trial(spark, sf).select("event_id", "seq", "status")
    writers.append(t.where("seq % 2 = 0"), path)
    writers.append(t.where("seq % 2 = 1"), path)
    return spark.read.schema(t.schema).parquet(path)


_add("append_log", append_log, f"WITH {base.TRIAL} SELECT event_id, seq, status FROM trial")


def snapshot_replace(spark, sf):
    path, t = _folder(spark, "snapshot"), _trial(spark, sf).select("event_id", "seq", "status")
    writers.write_snapshot(ordered.last_wins(t.where("seq % 2 = 0"), "event_id", ["seq"]), path)
    writers.write_snapshot(ordered.last_wins(writers.read_snapshot(spark, path).unionByName(t), "event_id", ["seq"]), path)
    return writers.read_snapshot(spark, path).select("event_id", "seq", "status")


_add("snapshot_replace", snapshot_replace, f"WITH {base.TRIAL} SELECT event_id, max(seq) AS seq, arg_max(status, seq) AS status FROM trial GROUP BY event_id")


# --- streams


def stream_latest(spark, sf):
    rows = _stream(spark, sf, "events").select(F.col("user_id").alias("event_id"), F.col("event_id").alias("seq"), F.col("event_type").alias("status"))
    return _final(streams.stream_latest(rows), "stream-latest")


_add("stream_latest", stream_latest, "SELECT user_id AS event_id, arg_max(event_type, event_id) AS status, max(event_id) AS seq FROM events GROUP BY user_id")


def stream_prefilter(spark, sf):
    out = streams.stream_prefilter(base.doc_rows(_stream(spark, sf, "documents")), base._known(spark, sf))
    return _appended(out.select("doc_id", "prefilter_decision", F.array_join("prefilter_reason_codes", ",").alias("reasons")), "stream-prefilter")


_add("stream_prefilter", stream_prefilter, f"SELECT doc_id, prefilter_decision, reasons FROM ({base.SQL['prefilter_flagship']})")


def stream_new(spark, sf):
    rows = _stream(spark, sf, "events").select(F.col("user_id").alias("event_id"), F.col("ts").cast("timestamp").alias("ts"))
    return _appended(streams.stream_new(rows, "ts", "event_id", "3650 days").select("event_id"), "stream-new")


_add("stream_new", stream_new, "SELECT DISTINCT user_id AS event_id FROM events")


def stream_digest(spark, sf):
    rows = _stream(spark, sf, "events").select(F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("status"))
    out = _final(streams.stream_digest(rows, "ts"), "stream-digest")
    return out.select(F.date_format("starts", "yyyy-MM-dd").alias("day"), "status", "n")


_add("stream_digest", stream_digest, "SELECT strftime(ts, '%Y-%m-%d') AS day, event_type AS status, count(*) AS n FROM events GROUP BY ALL")


def stream_upsert_known(spark, sf):
    path = _folder(spark, "stream-known")
    rows = _stream(spark, sf, "events").select(F.col("user_id").cast("string").alias("normalized_name"), F.col("event_type").alias("status"), F.col("event_id").cast("string").alias("added_at_utc"), F.col("event_id").alias("seq"))
    streams.stream_upsert_known(rows, f"{path}/rows", f"{path}/state").awaitTermination()
    return streams.known_of(spark, f"{path}/rows").select("normalized_name", "status", "added_at_utc", "seq")


_add("stream_upsert_known", stream_upsert_known, "SELECT CAST(user_id AS VARCHAR) AS normalized_name, arg_max(event_type, event_id) AS status, CAST(min(event_id) AS VARCHAR) AS added_at_utc, max(event_id) AS seq FROM events GROUP BY user_id")


# --- compositions


def triage_worklist(spark, sf):
    events = base.doc(spark, sf).select(F.col("doc_id").alias("event_id"), F.col("doc_id").alias("seq"), "entry_title", "summary", F.col("priority").alias("feed_priority"), F.lit(None).cast("string").alias("published_at_utc"))
    trials = events.select("event_id", (F.col("event_id") % 3 == 0).alias("ok"))
    out = pipelines.triage_worklist(events, trials, 50, "licen[sc]e|reserved")
    return out.select("event_id", F.col("position").cast("long").alias("position"), F.col("batch").cast("long").alias("batch"))


_add("triage_worklist", triage_worklist, f"WITH {base.DOC}, o AS (SELECT doc_id AS event_id, row_number() OVER (ORDER BY priority ASC NULLS LAST, doc_id) AS position FROM doc WHERE regexp_matches(entry_title || ' ' || summary, '(?i)licen[sc]e|reserved') AND doc_id % 3 <> 0) SELECT event_id, position, (position - 1) // 10 + 1 AS batch FROM o WHERE position <= 50")


def match_results(spark, sf):
    kind = F.col("event_id") % 4
    raw = F.when(kind == 0, F.lit('{"status": "HAS_PAGE", "confidence": 0.75}')).when(kind == 1, F.lit('Answer: {"status": "ODD", "confidence": 2}')).otherwise(F.col("event_type"))
    rows = base._t(spark, sf, "events").select("event_id", raw.alias("raw_output"), F.when(kind == 3, 0).otherwise(2).alias("n_candidates"))
    return pipelines.match_results(rows).select("event_id", "gate3_status", "confidence", F.array_join("violations", ",").alias("violations"))


_add("match_results", match_results, "SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'HAS_PAGE' WHEN 1 THEN 'ODD' WHEN 2 THEN 'UNCERTAIN' ELSE 'MISSING' END AS gate3_status, CAST(CASE event_id % 4 WHEN 0 THEN 0.75 WHEN 1 THEN 2 WHEN 3 THEN 1 END AS DOUBLE) AS confidence, CASE event_id % 4 WHEN 1 THEN 'status,confidence' WHEN 2 THEN 'confidence' ELSE '' END AS violations FROM events")


def ingest(spark, sf):
    esc = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    a = base.art(spark, sf).where("title <> ''")
    body = F.concat(F.lit("<rss><channel><title>c</title><item><title>"), esc(F.col("title")), F.lit("</title><link>"), esc(F.col("url")), F.lit("</link></item></channel></rss>"))
    seen = a.where("page_id % 4 = 0").select(urls.url_key(urls.canonical_url(F.col("url"))).alias("url_key"))
    return pipelines.ingest(a.select(F.col("feed").alias("feed_url"), body.alias("body")), seen).select("url_key", "event_id")


_add("ingest", ingest, f"WITH {base.ART}, c AS (SELECT *, {base._CANON} AS canon FROM art WHERE title <> ''), o AS (SELECT sha256(canon) AS url_key, sha256(canon || '||' || feed || '|unknown-date') AS event_id, page_id FROM c) SELECT DISTINCT url_key, event_id FROM o WHERE url_key NOT IN (SELECT url_key FROM o WHERE page_id % 4 = 0)")


def candidates(spark, sf):
    c = base._t(spark, sf, "customer")
    found = F.array(F.struct(F.lit(1).alias("rank"), F.col("c_custkey").alias("pageid"), F.col("c_name").alias("title")), F.struct(F.lit(2).alias("rank"), (F.col("c_custkey") + 10_000_000).alias("pageid"), F.concat(F.lit("Other "), F.col("c_custkey").cast("string")).alias("title")))
    results = c.select(F.col("c_name").alias("query"), F.explode(found).alias("r")).select("query", "r.*")
    pages = c.where("c_custkey % 2 = 0").select(F.col("c_name").alias("title"), F.array(F.lit("Category:1950 births")).alias("categories"))
    out = pipelines.candidates(c.select(F.col("c_custkey").alias("event_id"), F.col("c_name").alias("subject_name")), results, pages)
    return out.select("event_id", F.col("rank").cast("long").alias("rank"), "title", F.col("score").cast("long").alias("score"))


_add("candidates", candidates, "SELECT c_custkey AS event_id, rank, CASE rank WHEN 1 THEN c_name ELSE 'Other ' || c_custkey END AS title, CASE WHEN rank = 1 AND c_custkey % 2 = 0 THEN 3 ELSE 0 END AS score FROM customer, (SELECT unnest([1, 2]) AS rank)")


def coverage(spark, sf):
    s = base._t(spark, sf, "supplier")
    link = lambda host: F.struct(F.concat(F.lit(host), F.col("s_suppkey").cast("string")).alias("url"))
    both = F.array(F.struct(F.lit(0).alias("offset"), F.array(link("https://www.first.example/"), link("https://second.example/")).alias("results")), F.struct(F.lit(1).alias("offset"), F.array(link("https://second.example/"), link("https://third.example/")).alias("results")))
    answers = s.select(F.concat(F.lit('"'), "s_name", F.lit('"')).alias("query"), F.lit(20).alias("count"), F.explode(both).alias("b")).select("query", "count", "b.*")
    subjects = s.select(F.col("s_suppkey").alias("event_id"), F.col("s_name").alias("subject_name"), F.lit("").alias("title"), F.lit("").alias("summary"))
    return pipelines.coverage(subjects, answers).select("event_id", "url", "source_domain", F.col("rank").cast("long").alias("rank"))


_add("coverage", coverage, "SELECT s_suppkey AS event_id, CASE r WHEN 1 THEN 'https://www.first.example/' WHEN 2 THEN 'https://second.example/' ELSE 'https://third.example/' END || s_suppkey AS url, CASE r WHEN 1 THEN 'first.example' WHEN 2 THEN 'second.example' ELSE 'third.example' END AS source_domain, r AS rank FROM supplier, (SELECT unnest([1, 2, 3]) AS r)")


def reliable(spark, sf):
    entries = spark.createDataFrame(list(base.RELIABLE), "entry string, kind string")
    a = base.art(spark, sf)
    found = a.select(F.md5("title").substr(1, 2).alias("event_id"), "page_id", "url", urls.source_domain(F.col("url")).alias("source_domain"), F.col("page_id").alias("rank"))
    return pipelines.reliable(found, entries).select("event_id", "page_id", F.col("rank").cast("long").alias("rank"))


_add("reliable", reliable, f"WITH {base._REL} SELECT substr(md5(title), 1, 2) AS event_id, page_id, row_number() OVER (PARTITION BY substr(md5(title), 1, 2) ORDER BY page_id) AS rank FROM rel WHERE ok")


def daily_digest(spark, sf):
    e, runs = base._t(spark, sf, "events"), base._runs(spark, sf)
    last = runs.agg(F.max("finished_at")).first()[0]
    trials = e.select(F.col("event_id").alias("trial_id"), F.col("event_type").alias("subject_name"), F.col("user_id").alias("event_id"), F.col("ts").alias("trial_at"), F.col("event_id").alias("seq"), F.array().cast("array<string>").alias("urls"), F.array().cast("array<string>").alias("domains"))
    return pipelines.daily_digest(trials, runs, F.lit(last), 72).select("person", F.size("run_ids").cast("long").alias("runs"), "event_count")


_add("daily_digest", daily_digest, f"WITH {base._RUNS}, i AS (SELECT e.event_id, max(struct_pack(f := finished_at, r := run_id)) AS m FROM events e JOIN run ON e.ts BETWEEN started_at AND finished_at GROUP BY e.event_id), n AS (SELECT e.event_id, arg_min(run_id, abs(epoch_us(e.ts) - epoch_us(finished_at))) AS r FROM events e JOIN run ON e.ts BETWEEN finished_at - INTERVAL 15 MINUTE AND finished_at + INTERVAL 15 MINUTE GROUP BY e.event_id), a AS (SELECT e.event_type, e.user_id, coalesce(i.m.r, n.r) AS run_id FROM events e LEFT JOIN i ON i.event_id = e.event_id LEFT JOIN n ON n.event_id = e.event_id) SELECT event_type AS person, count(DISTINCT run_id) AS runs, count(DISTINCT user_id) AS event_count FROM a WHERE run_id IN (SELECT run_id FROM run WHERE finished_at >= (SELECT max(finished_at) FROM run) - INTERVAL 72 HOUR) GROUP BY event_type")
