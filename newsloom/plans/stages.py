"""Registered queries of whole stages: existence, shapes, nested records, ingest, digest, counted writes, feeds' state.

Where both engines need the same made-up column, one expression that both read is stated once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom import schemas
from newsloom.functions import names, specs, text, urls
from newsloom.operators import existence, ordered, records, rollups
from newsloom.plans import pipelines
from newsloom.plans import registry as base
from newsloom.sources import readers, shared, writers
from newsloom.streaming import streams

QUERIES: dict = {}
SQL: dict = {}


def _add(name, fn, sql):
    QUERIES[name] = fn
    SQL[name] = sql


def _union(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# --- J19, P31, P32: suppliers in eleven situations

_TRADES = ("artist", "poet", "chef")


def _world(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    s = base._t(spark, sf, "supplier").select((F.col("s_suppkey") % 11).alias("k"), F.col("s_suppkey").cast("string").alias("n"), F.col("s_name").alias("name"))

    def page(k: int, title: str, disambig: bool = False, description: str | None = None) -> DataFrame:
        return s.where(F.col("k") == k).select(F.expr(title).alias("title"), F.lit(disambig).alias("is_disambig"), F.lit(description).cast("string").alias("description"), F.concat(F.lit("u"), F.lit(str(k)), F.lit("/"), "n").alias("url"))

    pages = _union(
        page(0, "name", False, "a painter and poet"), page(1, "name", False, "a town"), page(2, "name", True), page(2, "name || ' (poet)'"), page(3, "name || ' (artist)'"), page(4, "'The ' || name || ' story'", False, "journalist"),
        page(5, "'Other ' || n", False, "a chef"), page(6, "'Place ' || n", False, "a place"), page(8, "'Moved ' || n", False, "an actor"), page(9, "name", True), page(10, "'Late ' || n", False, "a poet"),
    )
    link = lambda k, at, title: s.where(F.col("k") == k).select(F.col("name").alias("title"), F.lit(at).alias("at"), F.expr(title).alias("link"))
    hit = lambda k, rank, title: s.where(F.col("k") == k).select("name", F.lit(rank).alias("rank"), F.expr(title).alias("title"))
    return {
        "names": s.select("name"), "pages": pages, "links": _union(link(2, 0, "name || ' (ship)'"), link(2, 1, "name || ' (poet)'"), link(9, 0, "'Else ' || n")),
        "search": _union(hit(4, 1, "'Nothing ' || n"), hit(4, 2, "'The ' || name || ' story'"), hit(5, 1, "'Other ' || n"), hit(6, 2, "'Place ' || n"), hit(10, 6, "'Late ' || n")),
        "redirects": s.where("k = 8").select(F.col("name").alias("from"), F.concat(F.lit("Moved "), "n").alias("to")),
    }


def page_probe(spark, sf):
    w = _world(spark, sf)
    out = existence.page_probe(w["names"], w["pages"], _TRADES, w["search"], w["links"], w["redirects"])
    n = lambda c: F.coalesce(F.nullif(F.size(c), F.lit(-1)), F.lit(0)).cast("long")
    return out.select("name", "status", "via", "resolved_title", "url", *(F.when(F.col(c).isNotNull(), n(c)).otherwise(F.lit(0)).alias(f"n_{c}") for c in ("candidates", "context", "collisions")))


def _page(k: int, title: str, disambig: bool = False, description: str | None = None) -> str:
    return f"SELECT {title} AS title, {disambig} AS is_disambig, {'NULL' if description is None else repr(description)} AS description, 'u{k}/' || n AS url FROM s WHERE k = {k}"


_WORLD = f"""s AS (SELECT s_suppkey % 11 AS k, CAST(s_suppkey AS VARCHAR) AS n, s_name AS name FROM supplier),
page AS ({' UNION ALL '.join([_page(0, 'name', False, 'a painter and poet'), _page(1, 'name', False, 'a town'), _page(2, 'name', True), _page(2, "name || ' (poet)'"), _page(3, "name || ' (artist)'"), _page(4, "'The ' || name || ' story'", False, 'journalist'), _page(5, "'Other ' || n", False, 'a chef'), _page(6, "'Place ' || n", False, 'a place'), _page(8, "'Moved ' || n", False, 'an actor'), _page(9, 'name', True), _page(10, "'Late ' || n", False, 'a poet')])}),
pg AS (SELECT *, NOT is_disambig AND (regexp_matches(lower(title), '\\(({'|'.join(text.TITLE_OCCUPATIONS)})\\)') OR regexp_matches(lower(coalesce(description, '')), '\\b({'|'.join(text.DESCRIPTION_OCCUPATIONS)})\\b')) AS person FROM page),
link AS (SELECT name AS title, 0 AS at_, name || ' (ship)' AS link FROM s WHERE k = 2 UNION ALL SELECT name, 1, name || ' (poet)' FROM s WHERE k = 2 UNION ALL SELECT name, 0, 'Else ' || n FROM s WHERE k = 9),
hit AS (SELECT name, 1 AS rank, 'Nothing ' || n AS title FROM s WHERE k = 4 UNION ALL SELECT name, 2, 'The ' || name || ' story' FROM s WHERE k = 4 UNION ALL SELECT name, 1, 'Other ' || n FROM s WHERE k = 5 UNION ALL SELECT name, 2, 'Place ' || n FROM s WHERE k = 6 UNION ALL SELECT name, 6, 'Late ' || n FROM s WHERE k = 10),
trade AS (SELECT unnest({list(_TRADES)}) AS trade, unnest(range({len(_TRADES)})) AS no),
x AS (SELECT s.name, pg.* FROM s LEFT JOIN pg ON pg.title = CASE WHEN k = 8 THEN 'Moved ' || n ELSE name END),
a AS (SELECT name, title, url FROM x WHERE person),
b AS (SELECT x.name, arg_min(p.title, at_) AS title, arg_min(p.url, at_) AS url FROM x JOIN link l ON l.title = x.title JOIN pg p ON p.title = l.link WHERE x.is_disambig AND NOT p.is_disambig
  AND (l.link = x.name OR l.link IN (SELECT x.name || ' (' || trade || ')' FROM trade)) AND x.name NOT IN (SELECT name FROM a) GROUP BY x.name),
c AS (SELECT x.name, arg_min(p.title, no) AS title, arg_min(p.url, no) AS url FROM x, trade JOIN pg p ON p.person WHERE p.title = x.name || ' (' || trade || ')' AND x.name NOT IN (SELECT name FROM a UNION SELECT name FROM b) GROUP BY x.name),
f AS (SELECT h.name, arg_min(p.title, rank) FILTER (WHERE person AND contains(lower(p.title), lower(h.name))) AS title, arg_min(p.url, rank) FILTER (WHERE person AND contains(lower(p.title), lower(h.name))) AS url,
  least(3, count(*) FILTER (WHERE person)) AS np, least(3, count(*) FILTER (WHERE NOT person)) AS nc FROM hit h JOIN pg p ON p.title = h.title WHERE rank <= 5 GROUP BY h.name)"""
_add("page_probe", page_probe, f"""WITH {_WORLD}
SELECT x.name, CASE WHEN coalesce(a.title, b.title, c.title, f.title) IS NOT NULL THEN 'HAS_PAGE' WHEN x.title IS NOT NULL OR f.name IS NOT NULL THEN 'UNCERTAIN' ELSE 'MISSING' END AS status,
  CASE WHEN a.title IS NOT NULL THEN 'exact' WHEN b.title IS NOT NULL THEN 'disambiguation-link' WHEN c.title IS NOT NULL THEN 'variant' WHEN f.title IS NOT NULL THEN 'search' WHEN x.title IS NOT NULL OR f.name IS NOT NULL THEN 'search-uncertain' ELSE 'search-empty' END AS via,
  coalesce(a.title, b.title, c.title, f.title) AS resolved_title, coalesce(a.url, b.url, c.url, f.url) AS url,
  CASE WHEN coalesce(a.title, b.title, c.title, f.title) IS NULL THEN coalesce(np, 0) ELSE 0 END AS n_candidates, CASE WHEN coalesce(a.title, b.title, c.title, f.title) IS NULL THEN coalesce(nc, 0) ELSE 0 END AS n_context,
  CASE WHEN coalesce(a.title, b.title, c.title, f.title) IS NULL AND x.title IS NOT NULL AND NOT x.is_disambig THEN 1 ELSE 0 END AS n_collisions
FROM x LEFT JOIN a USING (name) LEFT JOIN b USING (name) LEFT JOIN c USING (name) LEFT JOIN f USING (name)""")


# --- V2: a response for each event, with each kind of violation

_RESPONSE = """'{' || CASE event_id % 5 WHEN 0 THEN '"status": "HAS_PAGE", ' WHEN 1 THEN '"status": "MISSING", ' WHEN 2 THEN '"status": "MAYBE", ' WHEN 3 THEN '"status": 7, ' ELSE '' END
|| CASE event_id % 3 WHEN 0 THEN '"matched_title": null, ' WHEN 1 THEN '"matched_title": "t", ' ELSE '"matched_title": 1.5, ' END
|| CASE event_id % 7 WHEN 0 THEN '"confidence": 1.25, ' WHEN 1 THEN '"confidence": -1, ' WHEN 2 THEN '"confidence": "high", ' ELSE '"confidence": 0.5, ' END
|| CASE event_id % 4 WHEN 0 THEN '"evidence": []' WHEN 1 THEN '"evidence": ["a", "b", 3, "d"]' WHEN 2 THEN '"evidence": "a"' ELSE '"evidence": ["a"]' END
|| CASE WHEN event_id % 11 = 0 THEN ', "more": 1}' WHEN event_id % 13 = 0 THEN ', ' ELSE '}' END"""


def response_specs(spark, sf):
    rows = base._t(spark, sf, "events").select("event_id", F.expr(_RESPONSE).alias("raw"))
    return specs.validate(rows, "raw", specs.MATCH).select("event_id", F.array_join("violations", "; ").alias("violations"))


_add("response_specs", response_specs, f"""WITH r AS (SELECT event_id, try_cast({_RESPONSE} AS JSON) AS j FROM events),
t AS (SELECT *, json_type(j, '$.status') AS s, json_type(j, '$.matched_title') AS m, json_type(j, '$.confidence') AS c, json_type(j, '$.evidence') AS e FROM r)
SELECT event_id, CASE WHEN j IS NULL THEN '$: no JSON' ELSE concat_ws('; ',
  CASE WHEN s IS NULL THEN '$.status: missing' WHEN s <> 'VARCHAR' THEN '$.status: not text' WHEN json_extract_string(j, '$.status') NOT IN ('HAS_PAGE', 'MISSING', 'UNCERTAIN') THEN '$.status: not one of the values' END,
  CASE WHEN m IS NULL THEN '$.matched_title: missing' WHEN m NOT IN ('VARCHAR', 'NULL') THEN '$.matched_title: not text' END,
  CASE WHEN c = 'VARCHAR' THEN '$.confidence: not a number' WHEN CAST(json_extract_string(j, '$.confidence') AS DOUBLE) < 0 THEN '$.confidence: below 0' WHEN CAST(json_extract_string(j, '$.confidence') AS DOUBLE) > 1 THEN '$.confidence: above 1' END,
  CASE WHEN e <> 'ARRAY' THEN '$.evidence: not a list' WHEN json_array_length(j, '$.evidence') < 1 THEN '$.evidence: fewer than 1 items' WHEN json_array_length(j, '$.evidence') > 3 THEN '$.evidence: more than 3 items' END,
  CASE WHEN e = 'ARRAY' AND json_type(j, '$.evidence[2]') <> 'VARCHAR' THEN '$.evidence[2]: not text' END,
  CASE WHEN json_type(j, '$.more') IS NOT NULL THEN '$.more: not expected' END) END AS violations FROM t""")


# --- K3, A2, A3, A13: a split and its counters by one write each


def split_stages(spark, sf):
    rows = text.classify_event(base.doc(spark, sf)).select("doc_id", "prefilter_decision")
    passed, skipped = writers.write_split(rows, F.col("prefilter_decision") == "PREFILTER_PASS_TO_LLM", shared.folder(spark, "stages"))
    return passed.withColumn("side", F.lit("pass")).unionByName(skipped.withColumn("side", F.lit("skip")))


_add("split_stages", split_stages, f"WITH {base.CLASSIFIED}, p AS (SELECT doc_id, {base._DECISION} AS prefilter_decision FROM r) SELECT doc_id, prefilter_decision, CASE WHEN prefilter_decision = 'PREFILTER_PASS_TO_LLM' THEN 'pass' ELSE 'skip' END AS side FROM p")
_add("stage_metrics", lambda s, d: writers.write_counted(base.trial(s, d), shared.folder(s, "counted"), ok=F.count_if("ok"), confirmed=F.sum("confirmed_count"), last_seq=F.max("seq")), f"WITH {base.TRIAL} SELECT count(*) AS rows, count(*) FILTER (WHERE ok) AS ok, CAST(sum(confirmed_count) AS BIGINT) AS confirmed, max(seq) AS last_seq FROM trial")
_add("stage_counts", lambda s, d: rollups.stage_counts(trials=(base.trial(s, d), F.col("seq") >= 500), documents=(base.doc(s, d), F.col("priority").isNull()), pages=(base.art(s, d), None)), f"WITH {base.TRIAL}, {base.DOC}, {base.ART} SELECT 'trials' AS stage, count(*) AS rows, count(*) FILTER (WHERE seq >= 500) AS new_rows FROM trial UNION ALL SELECT 'documents', count(*), count(*) FILTER (WHERE priority IS NULL) FROM doc UNION ALL SELECT 'pages', count(*), count(*) FROM art")


def title_rows(d: DataFrame) -> DataFrame:
    """Every line of a document as an entry of its own, about as long as a feed's titles."""
    return readers.spread(d.select("doc_id", "text")).select("doc_id", F.explode(F.split("text", "\n")).alias("entry_title"), F.lit("").alias("summary"))


_TITLES = base.CLASSIFIED.replace(base.DOC, "doc AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS entry_title, '' AS summary FROM documents)")
_add("prefilter_titles", lambda s, d: rollups.code_counts(text.classify_event(title_rows(base._t(s, d, "documents"))), F.col("prefilter_reason_codes")), f"WITH {_TITLES} SELECT reason AS code, count(*) AS n FROM r GROUP BY reason")


# --- S7, E1, A3, U5: one feed of many items for each host

_DATED = "DATE '2024-01-01' + CAST(page_id % 300 AS INT)"


#: Page ids that one feed document covers.
ITEMS = 1000


def _feed_documents(spark: SparkSession, sf: str) -> DataFrame:
    """(feed_url, body, first): RSS with Dublin Core, or Atom, by the host's length; every eleventh item lacks its link, some hosts' documents are cut off.

    A host's pages are one feed, in documents of ``ITEMS`` page ids each, so that none grows with the host."""
    esc = lambda c: F.replace(F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")), F.lit("\r"), F.lit("&#13;"))
    a = base.art(spark, sf).withColumn("day", F.date_format(F.expr(_DATED), "yyyy-MM-dd")).withColumn("t", esc(F.col("title"))).withColumn("u", F.when(F.col("page_id") % 11 > 0, esc(F.col("url"))))
    id_ = F.col("page_id").cast("string")
    date = F.when(F.col("page_id") % 3 > 0, F.concat(F.lit("<dc:date>"), "day", F.lit("T00:00:00Z</dc:date>"))).otherwise(F.lit("<pubDate>soon</pubDate>"))
    author = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("<author><name>N "), id_, F.lit("</name></author>"))).otherwise(F.concat(F.lit("<dc:creator>C "), id_, F.lit("</dc:creator>")))
    rss = F.concat(F.lit("<item><title>"), "t", F.lit("</title>"), F.coalesce(F.concat(F.lit("<link>"), "u", F.lit("</link>")), F.lit("")), date, author, F.lit("</item>"))
    atom = F.concat(F.lit('<entry><title type="text">'), "t", F.lit("</title>"), F.coalesce(F.concat(F.lit('<link rel="self" href="https://self.example/"/><link href="'), "u", F.lit('"/>')), F.lit("")), date, author, F.lit("</entry>"))
    first = F.floor(F.col("page_id") / ITEMS) * ITEMS
    items = a.select("feed", first.alias("first"), "page_id", F.when(F.length("feed") % 2 == 0, atom).otherwise(rss).alias("item"))
    listed = items.groupBy("feed", "first").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_id", "item"))), lambda x: x["item"]), "").alias("items"))
    dc = ' xmlns:dc="http://purl.org/dc/elements/1.1/"'
    rss = F.concat(F.lit(f"<?xml version='1.0'?><rss{dc}><channel><title>c</title>"), "items", F.lit("</channel></rss>"))
    atom = F.concat(F.lit(f'<feed xmlns="http://www.w3.org/2005/Atom"{dc}><title>c</title>'), "items", F.lit("</feed>"))
    body = F.when(F.length("feed") % 2 == 0, atom).otherwise(rss)
    return listed.select(F.col("feed").alias("feed_url"), F.when(F.length("feed") % 7 == 0, F.expr("substring(items, 1, 20)")).otherwise(body).alias("body"), "first")


_add(
    "feeds_full", lambda s, d: readers.parse_feeds(_feed_documents(s, d)).select("feed_url", "entry_title", "entry_url_raw", "author", "published"),
    f"""WITH {base.ART} SELECT feed AS feed_url, CASE WHEN trim(title) = '' THEN '(untitled)' ELSE trim(title) END AS entry_title, url AS entry_url_raw, CASE WHEN page_id % 2 = 0 THEN 'N ' || page_id ELSE 'C ' || page_id END AS author,
CASE WHEN page_id % 3 > 0 THEN strftime({_DATED}, '%Y-%m-%d') || 'T00:00:00Z' ELSE 'soon' END AS published FROM art WHERE page_id % 11 > 0 AND length(feed) % 7 > 0""",
)


def _fetches(spark: SparkSession, sf: str) -> DataFrame:
    """A fetch of each feed's documents; every fifth feed by length was not modified, every ninth failed."""
    n = F.length("feed_url")
    error = F.when(n % 9 == 0, F.lit("timeout"))
    docs = _feed_documents(spark, sf).withColumn("error", error).withColumn("not_modified", n % 5 == 0)
    return docs.withColumn("body", F.when(F.col("error").isNull(), F.col("body"))).select(
        "feed_url", "body", "first", "not_modified", "error", F.md5("feed_url").alias("etag"), F.lit(None).cast("string").alias("last_modified"), F.col("feed_url").alias("resolved_url"), F.lit(200).alias("last_status"),
        F.lit("2024-06-01").cast("timestamp").alias("last_fetch_at"), F.col("error").alias("last_error"),
    )


def _ingested(spark: SparkSession, sf: str) -> pipelines.Ingest:
    seen = base.art(spark, sf).where("page_id % 4 = 0").select(urls.url_key(urls.canonical_url(F.col("url"))).alias("url_key"))
    return pipelines.ingest_run(_fetches(spark, sf), seen, order=("feed_url", "entry_url_raw", "entry_title_raw"))


_INGESTED = f"""{base.ART}, h AS (SELECT DISTINCT feed, length(feed) % 9 > 0 AND (length(feed) % 5 = 0 OR length(feed) % 7 > 0) AS ok, length(feed) % 5 = 0 AS same FROM art),
e AS (SELECT *, sha256({base._CANON}) AS url_key FROM art WHERE page_id % 11 > 0 AND length(feed) % 7 > 0 AND length(feed) % 9 > 0 AND length(feed) % 5 > 0),
k AS (SELECT sha256({base._CANON}) AS url_key FROM art WHERE page_id % 4 = 0),
n AS (SELECT *, row_number() OVER (PARTITION BY url_key ORDER BY feed, url, title) = 1 AND url_key NOT IN (SELECT url_key FROM k) AS is_new FROM e)"""
_add("ingest_run", lambda s, d: _ingested(s, d).events.select("url_key", "feed_url", "published_at_utc", "date_parse_error"), f"WITH {_INGESTED} SELECT url_key, feed AS feed_url, CASE WHEN page_id % 3 > 0 THEN strftime({_DATED}, '%Y-%m-%d') || 'T00:00:00Z' END AS published_at_utc, page_id % 3 = 0 AS date_parse_error FROM n WHERE is_new")
_add("ingest_run_stats", lambda s, d: _ingested(s, d).stats, f"""WITH {_INGESTED}, f AS (SELECT count(*) AS feeds_total, count(*) FILTER (WHERE ok) AS feeds_succeeded, count(*) FILTER (WHERE NOT ok) AS feeds_failed, count(*) FILTER (WHERE ok AND same) AS feeds_not_modified FROM h)
SELECT f.*, count(url_key) AS entries_parsed, 0::BIGINT AS entries_invalid, count(*) FILTER (WHERE is_new) AS new_events_appended, count(*) FILTER (WHERE NOT is_new) AS duplicates_skipped, count(*) FILTER (WHERE page_id % 3 = 0) AS date_parse_errors FROM f LEFT JOIN n ON true GROUP BY ALL""")


def _visits(e: DataFrame) -> DataFrame:
    at = F.col("ts").cast("timestamp")
    feed = F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("-"), F.date_format("ts", "dd"))
    return e.select(feed.alias("feed_url"), F.date_format("ts", "HH:mm:ss.SSSSSS").alias("etag"), F.lit(None).cast("string").alias("last_modified"), F.lit("r").alias("resolved_url"), F.lit(200).alias("last_status"), at.alias("last_fetch_at"), F.lit(None).cast("string").alias("last_error"))


def stream_fetch_state(spark, sf):
    path = shared.folder(spark, "fetches")
    e = spark.readStream.schema(base._t(spark, sf, "events").schema).parquet(f"{sf}/events.parquet*")
    log = streams.stream_fetch_state(_visits(e), 3 * 86400)
    log.writeStream.format("parquet").option("path", f"{path}/log").option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start().awaitTermination()
    state = streams.fetch_state_of(spark.read.schema(schemas.FETCH_STATE + ", expired BOOLEAN").parquet(f"{path}/log"))
    return state.select("feed_url", "etag")


_VISITS = "WITH v AS (SELECT 'u' || user_id || '-' || strftime(ts, '%d') AS feed_url, max(ts) AS m FROM events GROUP BY 1)"
_add("stream_fetch_state", stream_fetch_state, f"{_VISITS} SELECT feed_url, strftime(m, '%H:%M:%S.%f') AS etag FROM v WHERE m + INTERVAL 3 DAY > (SELECT max(m) FROM v)")
_add("fetch_state", lambda s, d: rollups.fetch_state(_visits(base._t(s, d, "events")), horizon="3 days").select("feed_url", "etag"), SQL["stream_fetch_state"])


# --- S6, A15, A16: a manifest document for each day of events


def _manifests(spark: SparkSession, sf: str) -> DataFrame:
    path = shared.folder(spark, "manifests")
    day = F.date_format("ts", "yyyyMMdd")
    stage = base._t(spark, sf, "events").groupBy(day.alias("run_id"), "event_type").agg(F.count("*").alias("n"), F.min("ts").alias("a"), F.max("ts").alias("b"))
    stages = F.transform(F.array_sort(F.collect_list(F.struct("event_type", "n"))), lambda x: F.struct(x["event_type"].alias("name"), (x["n"] / 4).alias("duration_s"), F.lit(0).alias("exit_code")))
    iso = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    runs = stage.groupBy("run_id").agg(stages.alias("stages"), iso(F.min("a")).alias("started_at"), iso(F.max("b")).alias("finished_at"))  # a day's kinds of events are few
    body = F.when(F.col("run_id") % 10 == 3, F.lit("{cut off")).otherwise(F.to_json(F.struct("run_id", "started_at", "finished_at", "stages")))
    runs.select(F.col("run_id").alias("file"), body.alias("value")).write.partitionBy("file").text(path)
    return readers.read_runs(spark, f"{path}/*/part-*")


_MANIFESTS = "m AS (SELECT strftime(ts, '%Y%m%d') AS run_id, strftime(max(ts), '%Y-%m-%dT%H:%M:%SZ') AS finished_at, count(*) / 4.0 AS seconds FROM events GROUP BY 1 HAVING CAST(strftime(ts, '%Y%m%d') AS BIGINT) % 10 <> 3)"
_add("run_documents", lambda s, d: rollups.run_durations(_manifests(s, d)), f"WITH {_MANIFESTS} SELECT run_id, CAST(seconds AS DOUBLE) AS seconds FROM m")
_add("latest_run", lambda s, d: rollups.latest_run(_manifests(s, d)), f"WITH {_MANIFESTS} SELECT arg_max(run_id, finished_at || run_id) AS run_id, max(finished_at) AS \"at\" FROM m")


# --- P34, E3, E11: customers with up to four search items

_ITEM = "CASE i WHEN 0 THEN c_name WHEN 1 THEN CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'Other ' || CAST(c_custkey AS STRING) END WHEN 2 THEN 'Lost ' || CAST(c_custkey % 50 AS STRING) ELSE 'More ' || CAST(c_custkey AS STRING) END"


def _candidate_sets(spark: SparkSession, sf: str) -> DataFrame:
    c = base._t(spark, sf, "customer")
    subjects = c.select(F.col("c_custkey").alias("event_id"), F.col("c_name").alias("subject_name"), F.nullif(F.col("c_custkey") % 6, F.lit(0)).alias("feed_priority"), F.concat(F.lit("2024-"), F.col("c_nationkey").cast("string")).alias("published_at_utc"), F.col("c_custkey").alias("seq"))
    items = c.where("c_custkey % 7 > 0").withColumn("i", F.explode(F.sequence(F.lit(0), (F.col("c_custkey") % 4).cast("int"))))
    results = items.select(F.col("c_name").alias("query"), (F.col("i") + 1).alias("rank"), F.expr(_ITEM).alias("title"), F.when(F.col("i") == 3, F.lit(0)).otherwise(F.col("c_custkey") * 10 + F.col("i")).alias("pageid"), F.lit(None).cast("string").alias("snippet"))
    births = F.when(F.col("c_custkey") % 2 == 0, F.array(F.lit("Category:1900 births"))).otherwise(F.array(F.lit("Lists of things")))
    pages = c.select(F.concat("c_name", F.lit(" II")).alias("title"), F.col("c_custkey").alias("pageid"), F.lit("f").alias("fullurl"), F.lit(False).alias("is_disambig"), F.lit("d").alias("description"), F.lit("e").alias("extract"), births.alias("categories"))
    moved = c.select(F.col("c_name").alias("from"), F.concat("c_name", F.lit(" II")).alias("to"))
    failed = c.where("c_custkey % 13 = 0").select(F.col("c_name").alias("query"), F.lit("429").alias("error"))
    lost = c.where("c_custkey % 50 < 5").select(F.concat(F.lit("Lost "), (F.col("c_custkey") % 50).cast("string")).alias("title"), F.lit("timeout").alias("error")).distinct()
    return pipelines.candidate_sets(subjects, results, pages, moved, search_errors=failed, page_errors=lost)


_CANDIDATES = f"""c AS (SELECT *, c_custkey AS event_id FROM customer), i AS (SELECT *, unnest(range(c_custkey % 4 + 1)) AS i FROM c WHERE c_custkey % 7 > 0 AND c_custkey % 13 > 0),
t AS (SELECT event_id, c_name, c_custkey, i + 1 AS rank, i, {_ITEM.replace('STRING', 'VARCHAR')} AS item FROM i),
k AS (SELECT event_id, rank, CASE WHEN i = 0 THEN c_name || ' II' ELSE item END AS title, CASE WHEN i = 0 THEN CASE WHEN c_custkey % 2 = 0 THEN 3 ELSE -3 END ELSE 0 END AS score, i = 2 AND c_custkey % 50 < 5 AS bad, item FROM t WHERE item IS NOT NULL)"""
_add(
    "candidate_sets", lambda s, d: _candidate_sets(s, d).select("event_id", F.array_join(F.transform("candidates", lambda x: F.concat_ws(":", x["rank"], x["title"], F.coalesce(x["redirected_from"], F.lit("-")), x["biography_score"])), "; ").alias("candidates"), F.array_join("errors", "; ").alias("errors")),
    f"""WITH {_CANDIDATES}, a AS (SELECT event_id, string_agg(rank || ':' || title || ':' || CASE WHEN rank = 1 THEN item ELSE '-' END || ':' || score, '; ' ORDER BY rank) AS candidates, string_agg(CASE WHEN bad THEN 'page_error:' || item || ':timeout' END, '; ' ORDER BY rank) AS errors FROM k GROUP BY event_id)
SELECT c.event_id, coalesce(a.candidates, '') AS candidates, CASE WHEN c_custkey % 13 = 0 THEN 'search_error:429' ELSE coalesce(a.errors, '') END AS errors FROM c LEFT JOIN a ON a.event_id = c.event_id""",
)
_add(
    "match_worklist", lambda s, d: pipelines.match_worklist(_candidate_sets(s, d), base._t(s, d, "customer").select(F.col("c_custkey").alias("event_id"), F.col("c_custkey").alias("seq"), (F.col("c_custkey") % 5 == 0).alias("ok"))).select("event_id", "position", "settled", F.array_join(F.transform("shown", lambda x: x["rank"].cast("string")), ",").alias("shown")),
    f"""WITH {_CANDIDATES}, w AS (SELECT *, count(*) FILTER (WHERE score > 0) OVER (PARTITION BY event_id) AS n, row_number() OVER (PARTITION BY event_id, score > 0 ORDER BY rank) AS r FROM k),
s AS (SELECT event_id, string_agg(rank, ',' ORDER BY rank) AS shown FROM w WHERE score > 0 OR (n < 2 AND r = 1) GROUP BY event_id)
SELECT c.event_id, row_number() OVER (ORDER BY nullif(c_custkey % 6, 0) NULLS LAST, '2024-' || c_nationkey DESC, c_custkey) AS position, CASE WHEN s.shown IS NULL THEN 'MISSING' END AS settled, coalesce(s.shown, '') AS shown FROM c LEFT JOIN s ON s.event_id = c.event_id WHERE c_custkey % 5 > 0""",
)


# --- P34, E6, A4: the pages of a block of ids are a subject's coverage


def _reliable_sets(spark: SparkSession, sf: str) -> DataFrame:
    a = base.art(spark, sf).withColumn("event_id", F.floor(F.col("page_id") / 7)).withColumn("source_domain", urls.source_domain(F.col("url")))
    rows = ordered.rerank(a, ["event_id"], ["page_id"])
    sets = records.with_nested(a.select("event_id").distinct(), records.nested(rows, ["event_id"], ["rank"], records.RESULT_FIELDS, "results"), "event_id", "results")
    return pipelines.reliable_sets(sets.withColumn("result_count", F.size("results").cast("long")), spark.createDataFrame(list(base.RELIABLE), "entry string, kind string"))


_add("reliable_sets", lambda s, d: _reliable_sets(s, d).select("event_id", "result_count", "unfiltered_count", F.array_join(F.transform("results", lambda x: F.concat_ws("=", x["rank"], x["url"])), " ").alias("results")), f"""WITH {base._REL}, r AS (SELECT page_id // 7 AS event_id, count(*) AS unfiltered_count, count(*) FILTER (WHERE ok) AS result_count FROM rel GROUP BY 1),
k AS (SELECT page_id // 7 AS event_id, url, row_number() OVER (PARTITION BY page_id // 7 ORDER BY page_id) AS n FROM rel WHERE ok), l AS (SELECT event_id, string_agg(n || '=' || url, ' ' ORDER BY n) AS results FROM k GROUP BY event_id)
SELECT r.event_id, result_count, unfiltered_count, coalesce(results, '') AS results FROM r LEFT JOIN l ON l.event_id = r.event_id""")
_add("filter_totals", lambda s, d: rollups.filter_totals(_reliable_sets(s, d)), f"WITH {base._REL} SELECT count(*) FILTER (WHERE ok) AS kept, count(*) FILTER (WHERE NOT ok) AS dropped FROM rel")


# --- E9, K5: the document of the last three days, written and read again

_PERSON = "'Person ' || CAST(user_id % 40 AS STRING)"


def digest_document(spark, sf):
    e, runs = base._t(spark, sf, "events"), base._runs(spark, sf)
    last = runs.agg(F.max("finished_at")).first()[0]
    status = F.when(F.col("event_type") == "purchase", "LIKELY_NOTABLE").when(F.col("event_type") == "signup", "POSSIBLY_NOTABLE").otherwise("NOT_NOTABLE")
    none = F.lit(None).cast("array<string>")
    url = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))
    trials = e.select(
        F.col("user_id").cast("string").alias("event_id"), status.alias("gate4b_status"), F.expr(_PERSON).alias("subject_name"), F.col("ts").alias("trial_at"), F.col("event_id").alias("seq"),
        F.lit("t").alias("source_article_title"), none.alias("domains"), F.array(url("https://sent.example/", F.col("event_id"))).alias("results_sent"),
    )
    users = e.select(F.col("user_id").cast("string").alias("event_id"), "user_id").distinct()
    entries = users.where("user_id % 2 = 0").select("event_id", F.lit(1).alias("seq"), url("https://own.example/", F.col("user_id")).alias("rss_entry_url"), F.lit("2024").alias("rss_published_at_utc"))
    cover = users.where("user_id % 3 = 0").select("event_id", F.lit(1).alias("seq"), F.array(url("https://www.a.example/", F.col("user_id")), url("https://own.example/", F.col("user_id"))).alias("urls"))
    head, people = pipelines.digest(trials, runs.select("run_id", F.col("finished_at").alias("generated_at")), runs, entries, cover, F.lit(last), 72)
    path = shared.folder(spark, "digest")
    names = {"likely": "LIKELY_NOTABLE", "possibly": "POSSIBLY_NOTABLE"}
    writers.write_digest(head, {n: people.where(F.col("gate4b_status") == s) for n, s in names.items()}, ["person"], path)
    _, sections = writers.read_digest(spark, path, head.schema, people.schema, list(names))
    joined = lambda c: F.array_join(F.array_sort(c), ",")
    return _union(*sections.values()).select("gate4b_status", "person", "event_count", F.array_join("run_ids", ",").alias("run_ids"), joined("all_urls").alias("all_urls"), joined("all_domains").alias("all_domains"), F.size(F.filter("events", lambda x: x["rss_entry_url"].isNotNull())).cast("long").alias("from_feeds"))


_DIGEST = f"""{base._RUNS}, i AS (SELECT e.event_id, max(struct_pack(f := finished_at, r := run_id)) AS m FROM events e JOIN run ON e.ts BETWEEN started_at AND finished_at GROUP BY e.event_id),
n AS (SELECT e.event_id, arg_min(run_id, abs(epoch_us(e.ts) - epoch_us(finished_at))) AS r FROM events e JOIN run ON e.ts BETWEEN finished_at - INTERVAL 15 MINUTE AND finished_at + INTERVAL 15 MINUTE GROUP BY e.event_id),
a AS (SELECT e.*, coalesce(i.m.r, n.r) AS run_id, CASE event_type WHEN 'purchase' THEN 'LIKELY_NOTABLE' WHEN 'signup' THEN 'POSSIBLY_NOTABLE' END AS gate4b_status, lower({_PERSON.replace('STRING', 'VARCHAR')}) AS person FROM events e LEFT JOIN i ON i.event_id = e.event_id LEFT JOIN n ON n.event_id = e.event_id),
p AS (SELECT *, CASE WHEN user_id % 3 = 0 THEN CASE WHEN user_id % 2 = 0 THEN ['https://www.a.example/' || user_id] ELSE ['https://www.a.example/' || user_id, 'https://own.example/' || user_id] END ELSE ['https://sent.example/' || event_id] END AS u
  FROM a WHERE gate4b_status IS NOT NULL AND run_id IN (SELECT run_id FROM run WHERE finished_at >= (SELECT max(finished_at) FROM run) - INTERVAL 72 HOUR)),
g AS (SELECT gate4b_status, person, count(DISTINCT user_id) AS event_count, count(DISTINCT user_id) FILTER (WHERE user_id % 2 = 0) AS from_feeds, string_agg(DISTINCT run_id, ',' ORDER BY run_id) AS run_ids FROM p GROUP BY ALL),
l AS (SELECT gate4b_status, person, unnest(u) AS url FROM p), x AS (SELECT *, regexp_replace(regexp_extract(url, '^https://([^/]*)', 1), '^www[.]', '') AS d FROM l),
y AS (SELECT gate4b_status, person, string_agg(DISTINCT url, ',' ORDER BY url) AS all_urls, string_agg(DISTINCT d, ',' ORDER BY d) AS all_domains FROM x GROUP BY ALL)"""
_add("digest_document", digest_document, f"WITH {_DIGEST} SELECT gate4b_status, person, event_count, run_ids, all_urls, all_domains, from_feeds FROM g JOIN y USING (gate4b_status, person)")


# --- P25, W11, J14: prose with templates and paragraphs; candidates in every situation

_PROSE = "'{{box|a {b} c}}' || CASE WHEN doc_id % 2 = 0 THEN replace(text, CAST(unhex('0A') AS STRING), CAST(unhex('0A0A0A0A') AS STRING)) ELSE replace(text, CAST(unhex('0A') AS STRING), ' {{cite}}  ') END"
_PROSE_SQL = "'{{box|a {b} c}}' || CASE WHEN doc_id % 2 = 0 THEN replace(text, chr(10), repeat(chr(10), 4)) ELSE replace(text, chr(10), ' {{cite}}  ') END"
_add("prose_snippet", lambda s, d: base._t(s, d, "documents").select("doc_id", F.sha2(text.prose_snippet(F.expr(_PROSE), 700), 256).alias("snippet"), F.length(text.prose_snippet(F.expr(_PROSE), 700)).cast("long").alias("n")), f"""WITH p AS (SELECT doc_id, {_PROSE_SQL} AS t FROM documents),
c AS (SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(coalesce(t, ''), '\\{{\\{{[^{{}}]*\\}}\\}}', '', 'g'), '[ \\t]+', ' ', 'g'), '\\n{{3,}}', repeat(chr(10), 2), 'g'), ' ') AS c FROM p),
f AS (SELECT doc_id, c, trim(split_part(c, repeat(chr(10), 2), 1), ' ') AS f FROM c), o AS (SELECT doc_id, CASE WHEN length(f) >= 700 THEN f ELSE trim(substr(c, 1, 700), ' ') END AS o FROM f)
SELECT doc_id, sha256(o) AS snippet, length(o) AS n FROM o""")


def _match_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Customers by key: no result, no biography, no exact title, an exact title, one by redirect, a near name beside it, two with one title."""
    c = base._t(spark, sf, "customer").withColumn("k", F.col("c_custkey") % 7).withColumn("name", F.concat(F.lit("Ann B"), F.col("c_custkey").cast("string"), F.lit(" Lee")))

    def row(k: Column | bool, rank: int, title: str | None, score: int, moved: str | None = None, page: int = 1) -> DataFrame:
        return c.where(k).select(F.col("c_custkey").alias("event_id"), F.col("name").alias("subject_name"), F.lit(rank).alias("rank"), F.expr(title or "CAST(NULL AS STRING)").alias("title"), F.expr(moved or "CAST(NULL AS STRING)").alias("redirected_from"), F.lit(page).cast("long").alias("pageid"), F.lit(score).alias("score"))

    k = F.col("k")
    return _union(
        row(k == 0, 1, None, 0), row(k == 1, 1, "name", 1), row(k == 2, 1, "name || ' Jr'", 5), row(k == 3, 2, "name || ' (poet)'", 4), row(k == 3, 1, "'Some Thing'", 9),
        row(k == 4, 1, "'Born Otherwise'", 6, "name"), row(k == 5, 1, "name", 5), row(k == 5, 2, "replace(name, 'Ann', 'Anne')", 3), row(k == 6, 1, "name || ' (chef)'", 4, None, 9), row(k == 6, 2, "name", 4, None, 2),
    )


_add(
    "annotate_match", lambda s, d: pipelines.annotate_match(_match_rows(s, d)).select("event_id", "signal", "best_title", "match_type"),
    """WITH c AS (SELECT c_custkey AS event_id, c_custkey % 7 AS k, 'Ann B' || c_custkey || ' Lee' AS name FROM customer),
m AS (SELECT event_id, name, 1 AS rank, CASE k WHEN 0 THEN NULL WHEN 2 THEN name || ' Jr' WHEN 3 THEN 'Some Thing' WHEN 4 THEN 'Born Otherwise' WHEN 6 THEN name || ' (chef)' ELSE name END AS title, CASE WHEN k = 4 THEN name END AS moved, CASE k WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 3 THEN 9 WHEN 4 THEN 6 WHEN 6 THEN 4 ELSE 5 END AS score, CASE WHEN k = 6 THEN 9 ELSE 1 END AS pageid FROM c
  UNION ALL SELECT event_id, name, 2, CASE k WHEN 3 THEN name || ' (poet)' WHEN 5 THEN replace(name, 'Ann', 'Anne') ELSE name END, NULL, CASE WHEN k = 5 THEN 3 ELSE 4 END, CASE WHEN k = 6 THEN 2 ELSE 1 END FROM c WHERE k IN (3, 5, 6)),
b AS (SELECT *, lower(regexp_replace(title, ' *[(][^)]*[)]', '')) AS plain FROM m WHERE score >= 3),
x AS (SELECT *, CASE WHEN plain = lower(name) THEN 'title' ELSE 'redirect' END AS how, row_number() OVER (PARTITION BY event_id ORDER BY score DESC, pageid, rank) AS n FROM b WHERE plain = lower(name) OR lower(moved) = lower(name)),
o AS (SELECT * FROM x WHERE n = 1),
s AS (SELECT DISTINCT o.event_id FROM o JOIN b ON b.event_id = o.event_id AND b.rank <> o.rank WHERE levenshtein(b.plain, o.plain) <= 2 AND split_part(b.plain, ' ', -1) = split_part(o.plain, ' ', -1)),
g AS (SELECT event_id, count(title) AS n, count(*) FILTER (WHERE score >= 3) AS bio FROM m GROUP BY event_id)
SELECT g.event_id, CASE WHEN g.n = 0 THEN 'NO_RESULTS' WHEN bio = 0 THEN 'NO_BIO_CANDIDATES' WHEN o.title IS NULL THEN 'NO_EXACT_MATCH' WHEN s.event_id IS NOT NULL THEN 'EXACT_MATCH_AMBIGUOUS' ELSE 'EXACT_MATCH' END AS signal, o.title AS best_title, o.how AS match_type
FROM g LEFT JOIN o ON o.event_id = g.event_id LEFT JOIN s ON s.event_id = g.event_id""",
)


# --- P16, P17, P18, P19: spellings of names, and searches of long and short names with and without a signal

_SPELLED = "CASE c_custkey % 6 WHEN 0 THEN 'Dr. Ann  B' || c WHEN 1 THEN 'Lee' || c || ', Bob Ann' WHEN 2 THEN 'José B' || c || ' (poet)' WHEN 3 THEN 'Bob B' || c WHEN 4 THEN 'Sir' ELSE 'Ann' || c || ' Lee' END"
_NICKS = (("bob", "robert"), ("rob", "robert"), ("ann", "anna"))


def name_spellings(spark, sf):
    rows = base._t(spark, sf, "customer").withColumn("c", F.col("c_custkey").cast("string")).select("c_custkey", F.expr(_SPELLED).alias("name"))
    named = names.expand_nicknames(rows, spark.createDataFrame(list(_NICKS), "nick string, formal string"))
    return named.select("c_custkey", F.array_join(names.name_variants(F.col("name"), F.col("nicknames")), "|").alias("variants"))


_ORDERED = "list_filter({0}, lambda e, i: e IS NOT NULL AND e <> '' AND list_position({0}, e) = i)"
_add("name_spellings", name_spellings, f"""WITH s AS (SELECT c_custkey, {_SPELLED} AS name FROM (SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS c FROM customer)),
d AS (SELECT unnest({[n for n, _ in _NICKS]}) AS nick, unnest({[f for _, f in _NICKS]}) AS formal),
b AS (SELECT c_custkey, name, trim(regexp_replace(regexp_replace(name, '[(][^)]*[)]', ' ', 'g'), '\\s+', ' ', 'g')) AS b FROM s),
k AS (SELECT c_custkey, list(upper(t[1]) || substr(t, 2) || regexp_replace(name, '^[^ ]+', '') ORDER BY side, t) AS ks FROM (
  SELECT DISTINCT c_custkey, name, 0 AS side, formal AS t FROM b JOIN d ON lower(split_part(name, ' ', 1)) = nick UNION SELECT c_custkey, name, 1, nick FROM b JOIN d ON lower(split_part(name, ' ', 1)) = formal) GROUP BY c_custkey),
v AS (SELECT b.c_custkey, list_concat([b, CASE WHEN regexp_replace(lower(split_part(b, ' ', 1)), '^[.]+|[.]+$', '', 'g') IN {names.HONORIFICS} AND contains(b, ' ') THEN substr(b, instr(b, ' ') + 1) END,
  CASE WHEN contains(b, ',') THEN trim(trim(regexp_replace(b, '^[^,]*,', '')) || ' ' || trim(split_part(b, ',', 1))) END, regexp_replace(b, '[^\x00-\x7F]', '', 'g')], coalesce(ks, [])) AS v FROM b LEFT JOIN k ON k.c_custkey = b.c_custkey)
SELECT c_custkey, array_to_string({_ORDERED.format('v')}, '|') AS variants FROM v""")

_SUBJECT = "CASE doc_id % 3 WHEN 0 THEN 'Ann Lee' WHEN 1 THEN 'Ann Bea Lee' ELSE ' Juan  de la Cruz ' END"


def coverage_spellings(spark, sf):
    rows = base.doc(spark, sf).select("doc_id", F.expr(_SUBJECT).alias("name"), "entry_title", F.when(F.col("doc_id") % 4 == 0, F.concat("summary", F.lit(" who died"))).otherwise(F.col("summary")).alias("summary"))
    return rows.select("doc_id", F.array_join(text.coverage_queries(F.col("name"), F.col("entry_title"), F.col("summary")), "|").alias("queries"))


_add("coverage_spellings", coverage_spellings, f"""WITH {base.DOC}, a AS (SELECT doc_id, trim(regexp_replace({_SUBJECT}, '\\s+', ' ', 'g')) AS name, coalesce(entry_title, '') AS title, coalesce(summary, '') || CASE WHEN doc_id % 4 = 0 THEN ' who died' ELSE '' END AS summary FROM doc),
t AS (SELECT *, string_split(name, ' ') AS own, list_filter(regexp_extract_all(title, '[A-Za-z0-9]+'), lambda w: length(w) >= 3 AND lower(w) NOT IN {text.STOP_WORDS} AND NOT list_contains(list_transform(string_split(name, ' '), lambda z: lower(z)), lower(w))) AS words FROM a),
c AS (SELECT *, list_transform(words, lambda w: lower(w)) AS low, {" OR ".join(f"contains(lower(' ' || title || ' ' || summary || ' '), '{p}')" for p in text.OBITUARY_SIGNALS)} AS signal FROM t),
x AS (SELECT *, array_to_string(list_slice(list_filter(words, lambda w, i: list_position(low, lower(w)) = i), 1, 2), ' ') AS context, own[1] || ' ' || own[-1] AS short, len(own) >= 3 AS long FROM c),
q AS (SELECT doc_id, ['"' || name || '"', CASE WHEN signal THEN '"' || name || '" obituary' END, CASE WHEN long THEN '"' || short || '"' END, CASE WHEN long THEN short END, CASE WHEN long AND signal THEN '"' || short || '" obituary' END, CASE WHEN long AND context <> '' THEN '"' || short || '" ' || context END] AS v FROM x)
SELECT doc_id, array_to_string({_ORDERED.format('v')}, '|') AS queries FROM q""")


# --- P29, U4, K6: capped texts, inserts of new keys, report lines numbered across the section


def upsert_first(spark, sf):
    t = base.trial(spark, sf).select(F.col("event_id").cast("string").alias("key"), "seq")
    first = t.groupBy("key").agg(F.min("seq").alias("seq"))
    last = t.groupBy("key").agg(F.max("seq").alias("seq"))
    return rollups.upsert_first(first.where("seq % 2 = 0"), last, "key")


_add("upsert_first", upsert_first, f"WITH {base.TRIAL} SELECT CAST(event_id AS VARCHAR) AS key, CASE WHEN min(seq) % 2 = 0 THEN min(seq) ELSE max(seq) END AS seq FROM trial GROUP BY event_id")
_add("capped_text", lambda s, d: base._t(s, d, "documents").select("doc_id", F.sha2(text.cap(F.col("text"), 500), 256).alias("capped")), "SELECT doc_id, sha256(substr(text, 1, 500)) AS capped FROM documents")
