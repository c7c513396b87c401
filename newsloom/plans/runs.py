"""Registered queries of records between stages, run summaries and digests, each with SQL.

``result`` reads pages as search results sent for an event: every label row is an answer, the
event is a remainder of the page's id, and the article that started it has the title of its first
page.  ``record`` reads events as match rows of several generations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsloom.operators import ordered, records, rollups
from newsloom.plans import pipelines
from newsloom.plans import registry as base
from newsloom.sources import shared

QUERIES: dict = {}
SQL: dict = {}


def _add(name: str, fn, sql: str) -> None:
    QUERIES[name] = fn
    SQL[name] = sql


def _result(spark: SparkSession, sf: str) -> DataFrame:
    v = base.verdict(spark, sf).withColumn("event_id", F.concat(F.lit("e-"), F.col("page_id") % 35))
    within = Window.partitionBy("event_id").orderBy("page_id")
    return v.withColumn("rank", F.row_number().over(within)).withColumn("title", F.concat(F.lit("Page "), F.col("page_id") % 40)).withColumn("entry_title", F.first("title").over(within)).withColumn("source", F.lit(""))


_RESULT = f"""{base.VERDICT},
  block AS (SELECT * EXCLUDE (event_id, rank), 'e-' || (page_id % 35) AS event_id FROM verdict),
  result AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY page_id) AS rank, 'Page ' || (page_id % 40) AS title,
    'Page ' || (min(page_id) OVER (PARTITION BY event_id) % 40) AS entry_title FROM block)"""


def _folded(spark: SparkSession, sf: str) -> DataFrame:
    """All six statuses occur: every event whose number divides by 7 has a page, by 5 no parsed answer."""
    r = _result(spark, sf)
    n = F.regexp_extract("event_id", "([0-9]+)$", 1).cast("int")
    subjects = r.select("event_id").distinct().withColumn("gate3_status", F.when(n % 7 == 0, "HAS_PAGE").otherwise("MISSING")).withColumn("answered", n % 5 != 0)
    sent = r.select("event_id", "pass", "rank", "domain", "title", "entry_title", "source")
    answers = r.select("event_id", "pass", "rank", "about_subject", "reliable", "domain")
    return pipelines.verdicts(answers, sent, subjects, least=1)


_FOLDED = f"""{_RESULT},
  kept AS (SELECT * FROM result WHERE lower(title) <> lower(entry_title)),
  subject AS (SELECT DISTINCT event_id, CAST(regexp_extract(event_id, '([0-9]+)$', 1) AS INTEGER) AS n FROM result),
  counted AS (SELECT event_id, count(*) FILTER (WHERE pass = 1) AS sent FROM kept GROUP BY event_id),
  named AS (SELECT event_id, pass, domain FROM kept WHERE domain <> '' AND about_subject AND (pass = 1 OR reliable)),
  firsts AS (SELECT s.event_id, s.n, coalesce(c.sent, 0) AS sent, count(DISTINCT d.domain) FILTER (WHERE d.pass = 1 AND s.n % 5 <> 0) AS f,
    count(DISTINCT d.domain) FILTER (WHERE d.pass = 2 OR s.n % 5 <> 0) AS b
    FROM subject s LEFT JOIN counted c ON c.event_id = s.event_id LEFT JOIN named d ON d.event_id = s.event_id GROUP BY ALL),
  folded AS (SELECT event_id, CASE WHEN n % 7 = 0 THEN 'SKIPPED_HAS_PAGE' WHEN sent < 1 THEN 'SKIPPED' WHEN f >= 2 THEN 'LIKELY_NOTABLE' WHEN b >= 2 THEN 'POSSIBLY_NOTABLE'
      WHEN n % 5 = 0 OR f = 1 THEN 'UNCERTAIN' ELSE 'NOT_NOTABLE' END AS gate4b_status,
    CASE WHEN n % 7 = 0 OR sent < 1 THEN 0 ELSE f END AS confirmed_count, CASE WHEN n % 7 = 0 OR sent < 1 THEN 0 WHEN f >= 2 THEN f ELSE b END AS domains FROM firsts)"""
_add("verdicts_gated", lambda s, d: _folded(s, d).select("event_id", "gate4b_status", F.col("confirmed_count").cast("long").alias("confirmed_count"), F.col("reliable_domain_count").cast("long").alias("domains")), f"WITH {_FOLDED} SELECT event_id, gate4b_status, confirmed_count, domains FROM folded")

_add("drop_original", lambda s, d: records.drop_original(_result(s, d)).select("event_id", "page_id", "excluded_count"),
     f"WITH {_RESULT}, x AS (SELECT *, lower(title) = lower(entry_title) AS original FROM result), c AS (SELECT event_id, count(*) FILTER (WHERE original) AS excluded_count FROM x GROUP BY event_id) SELECT x.event_id, page_id, excluded_count FROM x JOIN c ON c.event_id = x.event_id WHERE NOT original")


def _rows(spark: SparkSession, sf: str) -> DataFrame:
    """Trials as records with a verdict, a subject and the URLs that were sent."""
    t = base.trial(spark, sf)
    verdict = F.when(F.col("status") == "LIKELY", "LIKELY_NOTABLE").when(F.col("status") == "POSSIBLY", "POSSIBLY_NOTABLE").otherwise("NOT_NOTABLE")
    name = F.when(F.col("event_id") % 11 == 0, F.lit("")).otherwise(F.concat(F.lit("Person "), F.col("event_id") % 500))
    url = F.concat(F.lit("https://s"), F.col("seq") % 9, F.lit(".example/"), F.col("event_id"))
    return t.select(
        "event_id", "seq", "ts", name.alias("subject_name"), verdict.alias("gate4b_status"), "confirmed_count", F.concat(F.lit("Title "), "seq").alias("source_article"),
        F.array(url, F.lit(""), F.lit(None).cast("string")).alias("source_urls"), (F.col("confirmed_count") % 4).alias("second_pass_confirmed_count"), url.alias("url"),
    )


_ROWS = f"""{base.TRIAL}, rows_ AS (SELECT event_id, seq, ts, CASE WHEN event_id % 11 = 0 THEN '' ELSE 'Person ' || (event_id % 500) END AS subject_name,
  CASE status WHEN 'LIKELY' THEN 'LIKELY_NOTABLE' WHEN 'POSSIBLY' THEN 'POSSIBLY_NOTABLE' ELSE 'NOT_NOTABLE' END AS gate4b_status, confirmed_count, 'Title ' || seq AS source_article,
  confirmed_count % 4 AS second_count, 'https://s' || (seq % 9) || '.example/' || event_id AS url FROM trial)"""
_add("run_summary", lambda s, d: records.run_summary(_rows(s, d)).select("subject_name", "gate4b_status", "confirmed_count", "source_article", F.array_join("source_urls", ",").alias("urls"), "second_pass_confirmed_count"),
     f"""WITH {_ROWS}, w AS (SELECT *, row_number() OVER (PARTITION BY gate4b_status, subject_name ORDER BY confirmed_count DESC, seq) AS n FROM rows_ WHERE gate4b_status <> 'NOT_NOTABLE')
SELECT subject_name, gate4b_status, confirmed_count, source_article, url AS urls, CASE WHEN gate4b_status = 'POSSIBLY_NOTABLE' THEN second_count END AS second_pass_confirmed_count FROM w WHERE n = 1""")  # fmt: skip
_add("verdict_names", lambda s, d: records.verdict_names(_rows(s, d)).select("gate4b_status", F.sha2(F.array_join("names", ","), 256).alias("names_sha256"), F.size("names").cast("long").alias("n")),
     f"WITH {_ROWS} SELECT gate4b_status, sha256(string_agg(subject_name, ',' ORDER BY seq)) AS names_sha256, count(*) AS n FROM rows_ WHERE gate4b_status <> 'NOT_NOTABLE' GROUP BY gate4b_status")
_add("select_uncovered", lambda s, d: records.select_uncovered(_rows(s, d), ("LIKELY_NOTABLE", "POSSIBLY_NOTABLE"), "gate4b_status").select("seq", "subject_name"),
     f"WITH {_ROWS} SELECT seq, subject_name FROM rows_ WHERE gate4b_status <> 'NOT_NOTABLE' AND subject_name <> ''")
_add("signal_counts", lambda s, d: records.signal_counts(_rows(s, d), "gate4b_status"), f"WITH {_ROWS} SELECT gate4b_status, count(*) AS n FROM rows_ GROUP BY gate4b_status")


def digest_counts(spark: SparkSession, sf: str) -> DataFrame:
    rows = _rows(spark, sf).where("gate4b_status <> 'NOT_NOTABLE' AND subject_name <> ''")
    people = rows.groupBy("gate4b_status", "subject_name").agg(F.countDistinct("event_id").alias("event_count"))
    return records.digest_counts(people, rows.select(F.to_date("ts").alias("run_id")).distinct())


_add("digest_counts", digest_counts, f"""WITH {_ROWS}, p AS (SELECT gate4b_status AS g, subject_name, count(DISTINCT event_id) AS n FROM rows_ WHERE gate4b_status <> 'NOT_NOTABLE' AND subject_name <> '' GROUP BY ALL)
SELECT (SELECT count(DISTINCT CAST(ts AS DATE)) FROM rows_ WHERE gate4b_status <> 'NOT_NOTABLE' AND subject_name <> '') AS runs_in_window, count(*) FILTER (WHERE g LIKE 'L%') AS likely_people,
  count(*) FILTER (WHERE g LIKE 'P%') AS possibly_people, CAST(coalesce(sum(n) FILTER (WHERE g LIKE 'L%'), 0) AS BIGINT) AS likely_events, CAST(coalesce(sum(n) FILTER (WHERE g LIKE 'P%'), 0) AS BIGINT) AS possibly_events FROM p""")


def person_urls(spark: SparkSession, sf: str) -> DataFrame:
    rows = _rows(spark, sf).withColumnRenamed("subject_name", "person")
    summary = rows.where("gate4b_status = 'LIKELY_NOTABLE'").select("person", F.concat(F.lit("https://all.example/"), F.col("seq") % 3).alias("url"))
    return records.person_urls(rows, summary).select("person", F.array_join("urls", ",").alias("urls"))


_add("person_urls", person_urls, f"""WITH {_ROWS}, u AS (SELECT subject_name AS person, url FROM rows_ UNION SELECT subject_name, 'https://all.example/' || (seq % 3) FROM rows_ WHERE gate4b_status = 'LIKELY_NOTABLE')
SELECT person, string_agg(url, ',' ORDER BY url) AS urls FROM u GROUP BY person""")


def runs_in_window(spark: SparkSession, sf: str) -> DataFrame:
    rows = _rows(spark, sf)
    summaries = rows.groupBy(F.date_format("ts", "yyyyMMdd").alias("run_id")).agg(F.count("*").alias("n"))
    manifests = rows.where("gate4b_status = 'LIKELY_NOTABLE'").groupBy(F.date_format("ts", "yyyyMMdd").alias("run_id")).agg(F.max("seq").alias("last")).where("last % 2 = 0")
    return records.runs_in_window(summaries, manifests)


_add("runs_in_window", runs_in_window, f"""WITH {_ROWS}, s AS (SELECT strftime(ts, '%Y%m%d') AS run_id, count(*) AS n FROM rows_ GROUP BY 1),
m AS (SELECT strftime(ts, '%Y%m%d') AS run_id, max(seq) AS last FROM rows_ WHERE gate4b_status = 'LIKELY_NOTABLE' GROUP BY 1 HAVING max(seq) % 2 = 0) SELECT s.run_id, n, last FROM s LEFT JOIN m ON m.run_id = s.run_id""")


def recency_topk(spark: SparkSession, sf: str) -> DataFrame:
    rows = _rows(spark, sf).withColumn("published_at_utc", F.when(F.col("seq") % 5 > 0, F.date_format("ts", "yyyy-MM-dd HH")))
    return ordered.top_k(rows, 50, records.recency_order()).select("seq", "published_at_utc")


_add("recency_topk", recency_topk, f"WITH {_ROWS} SELECT seq, CASE WHEN seq % 5 > 0 THEN strftime(ts, '%Y-%m-%d %H') END AS published_at_utc FROM rows_ ORDER BY coalesce(CASE WHEN seq % 5 > 0 THEN strftime(ts, '%Y-%m-%d %H') END, '') DESC, seq LIMIT 50")


def without(spark: SparkSession, sf: str) -> DataFrame:
    own = F.when(F.col("seq") % 3 == 0, F.col("url")).when(F.col("seq") % 3 == 1, F.lit(""))
    left = records.without(F.array("url", F.lit("https://other.example/")), own)
    return _rows(spark, sf).select("seq", F.array_join(left, ",").alias("urls"))


_add("without", without, f"WITH {_ROWS} SELECT seq, CASE WHEN seq % 3 = 0 THEN '' ELSE url || ',' END || 'https://other.example/' AS urls FROM rows_")


def source_context(spark: SparkSession, sf: str) -> DataFrame:
    r = _rows(spark, sf)
    old = r.select("seq", F.col("source_article").alias("entry_title"), F.when(F.col("seq") % 2 == 0, "").otherwise("Feed").alias("source_feed_title"), F.lit("Old").alias("source"), F.date_format("ts", "yyyy-MM-dd").alias("publication_date"))
    own = F.struct(F.lit("Own").alias("entry_title"), F.lit("s").alias("summary"), F.lit("Ctx").alias("source"), F.lit("").alias("publication_date"))
    rows = old.withColumn("source_context", F.when(F.col("seq") % 4 == 0, own))
    return records.source_context(rows).select("seq", "source_context.entry_title", "source_context.summary", "source_context.source", "source_context.publication_date")


_add("source_context", source_context, f"""WITH {_ROWS} SELECT seq, CASE WHEN seq % 4 = 0 THEN 'Own' ELSE source_article END AS entry_title, CASE WHEN seq % 4 = 0 THEN 's' END AS summary,
CASE WHEN seq % 4 = 0 THEN 'Ctx' WHEN seq % 2 = 0 THEN 'Old' ELSE 'Feed' END AS source, CASE WHEN seq % 4 = 0 THEN '' ELSE strftime(ts, '%Y-%m-%d') END AS publication_date FROM rows_""")


def trial_rows(spark: SparkSession, sf: str) -> DataFrame:
    r = _rows(spark, sf)
    name = F.col("gate4b_status").alias("status")
    asked = r.where("confirmed_count >= 2").select("event_id", "subject_name", F.lit("m").alias("model"), F.lit("cli").alias("backend"), F.col("seq").alias("duration_ms"), (F.col("seq") % 2 == 0).alias("json_parse_ok"), F.lit("{}").alias("raw_output"), name)
    fixed = r.where("confirmed_count < 2").select("event_id", "subject_name", F.lit("deterministic").alias("backend"), name)
    return records.trial_rows(asked, fixed).select("event_id", "model", "backend", "duration_ms", "json_parse_ok", "raw_output", "status", "llm_error")


_add("trial_rows", trial_rows, f"""WITH {_ROWS} SELECT CAST(event_id AS VARCHAR) AS event_id, CASE WHEN confirmed_count >= 2 THEN 'm' END AS model, CASE WHEN confirmed_count >= 2 THEN 'cli' ELSE 'deterministic' END AS backend,
CASE WHEN confirmed_count >= 2 THEN seq ELSE 0 END AS duration_ms, confirmed_count < 2 OR seq % 2 = 0 AS json_parse_ok, CASE WHEN confirmed_count >= 2 THEN '{{}}' ELSE '' END AS raw_output, gate4b_status AS status, CAST(NULL AS VARCHAR) AS llm_error FROM rows_""")


def _record(spark: SparkSession, sf: str) -> DataFrame:
    """Match rows of four layouts: flat, parsed, a match without a subject, and one of no use."""
    name, page = F.col("subject_name"), F.struct(F.col("event_id").cast("string").alias("pageid"), F.col("source_article").alias("title"), F.col("url").alias("fullurl"))
    flat = F.to_json(F.struct(F.lit("HAS_PAGE").alias("gate2_status"), name.alias("subject_name"), page.alias("match")))
    parsed = F.to_json(F.struct(F.struct(F.lit("MATCH").alias("status"), name.alias("subject_name_full"), page.alias("matched_page")).alias("parsed_output")))
    bare = F.to_json(F.struct(F.lit("HAS_PAGE").alias("status"), F.struct(F.col("seq").alias("pageid"), F.col("source_article").alias("page_title")).alias("matched")))
    other = F.to_json(F.struct(F.lit("NO_PAGE").alias("status"), name.alias("subject_name")))
    kind = F.col("seq") % 4
    return _rows(spark, sf).select("seq", F.when(kind == 0, flat).when(kind == 1, parsed).when(kind == 2, bare).otherwise(other).alias("record"))


_MATCHED = f"""{_ROWS}, matched AS (SELECT seq, CASE seq % 4 WHEN 2 THEN source_article ELSE coalesce(nullif(subject_name, ''), source_article) END AS name, source_article AS title,
  CASE WHEN seq % 4 = 2 THEN seq ELSE event_id END AS pageid, CASE WHEN seq % 4 < 2 THEN url END AS fullurl FROM rows_ WHERE seq % 4 < 3)"""
_add("probe_fields", lambda s, d: records.generic_matches(_record(s, d)).select("seq", "normalized_name", "title", "pageid", "fullurl"), f"WITH {_MATCHED} SELECT seq, lower(name) AS normalized_name, title, pageid, fullurl FROM matched")


def known_upsert_generic(spark: SparkSession, sf: str) -> DataFrame:
    """The earlier half makes the state, the later half goes into it."""
    rows = records.generic_matches(_record(spark, sf)).select("normalized_name", "pageid", "title", F.col("seq").cast("string").alias("added_at_utc"), F.lit("generic").alias("source_stage"), "seq")
    half = rows.agg(F.max("seq").alias("m")).select((F.col("m") / 2).alias("half"))
    parted = rows.crossJoin(half)  # one row
    state = rollups.upsert_known(parted.where("seq <= half").drop("half"), parted.where("false").drop("half"))
    return rollups.upsert_known(state, parted.where("seq > half").drop("half")).select("normalized_name", "pageid", "title", "added_at_utc", "seq")


_add("known_upsert_generic", known_upsert_generic, f"WITH {_MATCHED} SELECT lower(name) AS normalized_name, arg_max(pageid, seq) AS pageid, arg_max(title, seq) AS title, CAST(min(seq) AS VARCHAR) AS added_at_utc, max(seq) AS seq FROM matched GROUP BY lower(name)")


def known_upsert_match(spark: SparkSession, sf: str) -> DataFrame:
    """Canonical names and their aliases."""
    rows = _rows(spark, sf).where("gate4b_status = 'LIKELY_NOTABLE'").select("seq", F.lower("subject_name").alias("name"), F.lower("source_article").alias("alias"))
    both = rollups.alias_rows(rows, F.col("name"), F.col("alias")).select("normalized_name", F.lit(None).cast("bigint").alias("pageid"), "alias", F.col("seq").cast("string").alias("added_at_utc"), "seq")
    return rollups.upsert_known(both.where("seq % 3 = 0"), both.where("seq % 3 <> 0")).select("normalized_name", "alias", "added_at_utc", "seq")


_add("known_upsert_match", known_upsert_match, f"""WITH {_ROWS}, l AS (SELECT seq, lower(subject_name) AS name, lower(source_article) AS alias FROM rows_ WHERE gate4b_status = 'LIKELY_NOTABLE'),
b AS (SELECT name AS k, alias, 2 * seq AS seq FROM l WHERE name <> '' UNION ALL SELECT alias, alias, 2 * seq + 1 FROM l) SELECT k AS normalized_name, arg_max(alias, seq) AS alias, CAST(min(seq) AS VARCHAR) AS added_at_utc, max(seq) AS seq FROM b GROUP BY k""")


def ingest_stats(spark: SparkSession, sf: str) -> DataFrame:
    r = _rows(spark, sf)
    n = F.row_number().over(Window.partitionBy("url").orderBy("seq"))
    entries = r.select((F.col("subject_name") != "").alias("valid"), (n == 1).alias("is_new"), (F.col("seq") % 6 == 0).alias("date_parse_error"))
    feeds = r.groupBy((F.col("event_id") % 300).alias("feed")).agg((F.max("seq") % 4 > 0).alias("ok"), (F.max("seq") % 4 == 2).alias("not_modified"))
    return records.ingest_stats(entries, feeds)


_add("ingest_stats", ingest_stats, f"""WITH {_ROWS}, e AS (SELECT subject_name <> '' AS valid, row_number() OVER (PARTITION BY url ORDER BY seq) = 1 AS new, seq % 6 = 0 AS bad FROM rows_), f AS (SELECT max(seq) % 4 AS m FROM rows_ GROUP BY event_id % 300)
SELECT (SELECT count(*) FROM f) AS feeds_total, (SELECT count(*) FROM f WHERE m > 0) AS feeds_succeeded, (SELECT count(*) FROM f WHERE m = 0) AS feeds_failed, (SELECT count(*) FROM f WHERE m = 2) AS feeds_not_modified, count(*) AS entries_parsed,
  count(*) FILTER (WHERE NOT valid) AS entries_invalid, count(*) FILTER (WHERE valid AND new) AS new_events_appended, count(*) FILTER (WHERE valid AND NOT new) AS duplicates_skipped, count(*) FILTER (WHERE valid AND bad) AS date_parse_errors FROM e""")


# --- E8, K5, K6: the whole summary as a document, and its lines

_add(
    "run_report", lambda s, d: pipelines.run_report(_rows(s, d), shared.folder(s, "report")).select("section", "line_no", "line"),
    f"""WITH {_ROWS}, w AS (SELECT *, row_number() OVER (PARTITION BY gate4b_status, subject_name ORDER BY confirmed_count DESC, seq) AS n FROM rows_ WHERE gate4b_status <> 'NOT_NOTABLE'),
l AS (SELECT gate4b_status AS section, subject_name, unnest(['- ' || subject_name, '  ' || source_article, '    ' || url]) AS line, unnest([0, 1, 2]) AS o FROM w WHERE n = 1)
SELECT section, row_number() OVER (PARTITION BY section ORDER BY subject_name, o) AS line_no, line FROM l""",
)
