"""Queries over the given tables, each with SQL that gives the same rows.

Shared views: ``art`` reads pages as articles, ``doc`` reads documents as feed entries, ``trial``
reads events as a log of model trials, ``verdict`` joins labels and pages to ranked answers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsloom.functions import names, responses, text, urls
from newsloom.operators import joins, ordered, rollups
from newsloom.plans import pipelines
from newsloom.sources import readers, shared, writers

#: The list of reliable sources that the queries use.
RELIABLE = (("example.org", "host"), ("example.net", "host"), ("example.com/fr", "path_prefix"), ("https://blog.example.com/en", "url_prefix"))


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return shared.parquet(spark, f"{sf}/{name}.parquet")


def art(spark, sf):
    p = _t(spark, sf, "pages")
    return p.select("page_id", "url", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), F.regexp_extract("url", "^[a-z]+://([^/?#]*)", 1).alias("feed"))


ART = "art AS (SELECT page_id, url, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS feed FROM pages)"


def doc(spark, sf):
    return doc_rows(_t(spark, sf, "documents"))


def doc_rows(d: DataFrame) -> DataFrame:
    at = F.instr("text", "\n")
    n = F.regexp_extract("source", "([0-9]+)$", 1).try_cast("int") % 6
    return d.select("doc_id", F.when(at > 0, F.expr("substring(text, 1, instr(text, '\n') - 1)")).otherwise(F.col("text")).alias("entry_title"), F.when(at > 0, F.expr("substring(text, instr(text, '\n') + 1)")).otherwise(F.lit("")).alias("summary"), F.col("source").alias("source_feed_url_original"), F.nullif(n, F.lit(0)).alias("priority"))


DOC = """doc AS (SELECT doc_id, CASE WHEN instr(text, chr(10)) > 0 THEN substr(text, 1, instr(text, chr(10)) - 1) ELSE text END AS entry_title,
  CASE WHEN instr(text, chr(10)) > 0 THEN substr(text, instr(text, chr(10)) + 1) ELSE '' END AS summary, source,
  nullif(CAST(regexp_extract(source, '([0-9]+)$', 1) AS INTEGER) % 6, 0) AS priority FROM documents)"""


def trial(spark, sf):
    e = _t(spark, sf, "events")
    status = F.when(F.col("event_type") == "purchase", "LIKELY").when(F.col("event_type") == "signup", "POSSIBLY").when(F.col("event_type") == "view", "NOT").when(F.col("event_type") == "click", "UNCERTAIN").otherwise("FAILED")
    return e.select(F.col("user_id").alias("event_id"), F.col("event_id").alias("seq"), "ts", status.alias("status"), (F.col("event_type") != "error").alias("ok"), F.floor("value").cast("long").alias("confirmed_count"))


TRIAL = """trial AS (SELECT user_id AS event_id, event_id AS seq, ts, CASE event_type WHEN 'purchase' THEN 'LIKELY' WHEN 'signup' THEN 'POSSIBLY' WHEN 'view' THEN 'NOT'
  WHEN 'click' THEN 'UNCERTAIN' ELSE 'FAILED' END AS status, event_type <> 'error' AS ok, CAST(floor(value) AS BIGINT) AS confirmed_count FROM events)"""


def verdict(spark, sf):
    v = _t(spark, sf, "labels").join(_t(spark, sf, "pages"), F.col("doc_id") == F.col("page_id")).join(_t(spark, sf, "documents").select("doc_id", "source"), "doc_id")
    n = F.row_number().over(Window.partitionBy("source").orderBy("page_id"))
    return v.select(F.col("source").alias("event_id"), "page_id", "url", n.alias("rank"), (F.col("quality") == 1).alias("about_subject"), (F.col("toxic") == 0).alias("reliable"), urls.source_domain(F.col("url")).alias("domain"), (F.col("quality") * 3 - F.col("toxic") * 4).alias("score"), (1 + F.col("page_id") % 2).alias("pass"))


VERDICT = """verdict AS (SELECT d.source AS event_id, p.page_id, p.url, row_number() OVER (PARTITION BY d.source ORDER BY p.page_id) AS rank, l.quality = 1 AS about_subject,
  l.toxic = 0 AS reliable, regexp_replace(regexp_extract(p.url, '^[a-z]+://([^/?#]*)', 1), '^www[.]', '') AS domain, l.quality * 3 - l.toxic * 4 AS score, 1 + p.page_id % 2 AS pass
  FROM labels l JOIN pages p ON l.doc_id = p.page_id JOIN documents d ON d.doc_id = l.doc_id)"""


def _feeds(spark, sf):
    return doc(spark, sf).select(F.col("source_feed_url_original").alias("url"), "priority").distinct()


def _known(spark, sf):
    """Every tenth document's name counts as known."""
    d = doc(spark, sf).where("doc_id % 10 = 0")
    return d.select(names.normalize_name(text.candidate_name(text.event_text(F.col("entry_title"), F.col("summary")))).alias("normalized_name"))


def prefilter_flagship(spark, sf):
    out = pipelines.prefilter(doc(spark, sf), _known(spark, sf), _feeds(spark, sf))
    return out.select("doc_id", "prefilter_decision", F.array_join("prefilter_reason_codes", ",").alias("reasons"), "feed_priority")


_EDGE = "(?:^|[^\\p{L}\\p{N}_])"
_END = "(?:$|[^\\p{L}\\p{N}_])"
_S = "[\\s\\x{a0}]"
_FULL = f"{_EDGE}([A-Z][a-z]{{1,29}}\\s+[A-Z][a-z]{{1,39}}){_END}"
_INIT = f"{_EDGE}((?:[A-Z]\\.\\s*[A-Z][a-z]{{1,39}}|[A-Z](?:\\s+[A-Z])?\\s+[A-Z][a-z]{{1,39}})){_END}"
_CUE = f"(?i){_EDGE}(obituary|obit|died|dies|dead|aged\\s+[0-9]{{2,3}}|tributes?|remembered){_END}"
_CAP = f"{_EDGE}([A-Z][a-z]{{2,39}}){_END}"
_TRIBUTE = text.TRIBUTE.replace("(?Ui)", "(?i)")
CLASSIFIED = f"""{DOC}, x AS (SELECT *, trim(coalesce(entry_title, '') || ' ' || coalesce(summary, '')) AS body FROM doc),
n AS (SELECT *, coalesce(nullif(regexp_extract(body, '{_FULL}', 1), ''), nullif(regexp_extract(body, '{_INIT}', 1), '')) AS name FROM x),
r AS (SELECT *, CASE WHEN regexp_matches(entry_title, '{text.LETTERS_HEAD}') OR regexp_matches(entry_title, '(?i)[|]\\s*Letters?\\s*$') THEN 'LETTERS_HEADER_SKIP'
  WHEN regexp_matches(entry_title, '(?i)(?:–|-)\\s+in\\s+pictures\\b|\\bin\\s+pictures\\b|\\bTrivia\\b') THEN 'STRUCTURAL_TOPIC_SKIP'
  WHEN regexp_matches(summary, '{_TRIBUTE}') THEN 'PERSONAL_TRIBUTE_OBIT_SKIP'
  WHEN regexp_matches(body, '{_FULL}') THEN 'NAME_FULL_MATCH' WHEN regexp_matches(body, '{_INIT}') THEN 'NAME_INITIAL_SURNAME_MATCH'
  WHEN regexp_matches(body, '{_CUE}') AND regexp_matches(body, '{_CAP}') THEN 'OBIT_CUE_WITH_CAPITALIZED_TOKEN'
  WHEN regexp_matches(body, '{_CUE}') THEN 'NO_NAME_SIGNAL_OBIT_CUE_WITHOUT_GUARDRAIL' ELSE 'NO_NAME_SIGNAL_DEFAULT_SKIP' END AS reason,
  trim(regexp_replace(lower(coalesce(name, '')), '\\s+', ' ', 'g')) AS norm FROM n)"""
_DECISION = """CASE reason WHEN 'LETTERS_HEADER_SKIP' THEN 'LETTERS_HEADER_SKIP' WHEN 'STRUCTURAL_TOPIC_SKIP' THEN 'PREFILTER_SKIP_STRUCTURAL_PATTERN'
  WHEN 'PERSONAL_TRIBUTE_OBIT_SKIP' THEN 'PERSONAL_TRIBUTE_OBIT_SKIP' ELSE CASE WHEN reason LIKE 'NO_NAME%' THEN 'PREFILTER_SKIP_NO_NAME' ELSE 'PREFILTER_PASS_TO_LLM' END END"""

QUERIES: dict = {"prefilter_flagship": prefilter_flagship}
SQL: dict = {
    "prefilter_flagship": f"""WITH {CLASSIFIED}, k AS (SELECT DISTINCT norm FROM r WHERE doc_id % 10 = 0 AND norm <> '')
SELECT r.doc_id, CASE WHEN k.norm IS NOT NULL THEN 'PREFILTER_SKIP_HAS_WIKI_PAGE' ELSE {_DECISION} END AS prefilter_decision,
  CASE WHEN k.norm IS NOT NULL THEN reason || ',KNOWN_WIKI_PAGE' ELSE reason END AS reasons, priority AS feed_priority FROM r LEFT JOIN k ON r.norm = k.norm"""
}


def _add(name, fn, sql=None):
    QUERIES[name] = fn
    if sql:
        SQL[name] = sql


def _classified(spark, sf):
    return text.classify_event(readers.spread(doc(spark, sf)))


_add("prefilter_reason_counts", lambda s, d: rollups.code_counts(_classified(s, d), F.col("prefilter_reason_codes")), f"WITH {CLASSIFIED} SELECT reason AS code, count(*) AS n FROM r GROUP BY reason")
_add("prefilter_rates", lambda s, d: rollups.pass_rates(_classified(s, d), F.col("prefilter_decision") == "PREFILTER_PASS_TO_LLM"),
     f"WITH {CLASSIFIED}, p AS (SELECT {_DECISION} = 'PREFILTER_PASS_TO_LLM' AS ok FROM r) SELECT count(*) AS n, count(*) FILTER (WHERE ok) AS n_pass, count(*) FILTER (WHERE NOT ok) AS n_skip, count(*) FILTER (WHERE ok) / count(*) AS pass_rate, count(*) FILTER (WHERE NOT ok) / count(*) AS skip_rate FROM p")
_add("candidate_name", lambda s, d: doc(s, d).select("doc_id", text.candidate_name(text.event_text(F.col("entry_title"), F.col("summary"))).alias("name")), f"WITH {CLASSIFIED} SELECT doc_id, name FROM r")
_add("keyword_filter", lambda s, d: text.keyword_filter(doc(s, d), "licen[sc]e|reserved").select("doc_id"), f"WITH {DOC} SELECT doc_id FROM doc WHERE regexp_matches(entry_title || ' ' || summary, '(?i)licen[sc]e|reserved')")
_add("obit_signal", lambda s, d: doc(s, d).select("doc_id", text.has_obit_signal(F.col("entry_title"), F.col("summary")).alias("signal")),
     f"WITH {DOC}, b AS (SELECT doc_id, lower(' ' || entry_title || ' ' || summary || ' ') AS t FROM doc) SELECT doc_id, " + " OR ".join(f"contains(t, '{p}')" for p in text.OBITUARY_SIGNALS) + " AS signal FROM b")


def _url_rows(spark, sf):
    return art(spark, sf).withColumn("u", F.concat("url", F.when(F.contains("url", F.lit("?")), F.lit("")).otherwise(F.lit(""))))


# the pages' URLs hold page, ref and utm_source keys in lower case, a #top fragment, and no port
_CANON = "regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(url, '#.*$', ''), '([?&])(ref|utm_source|src)=[^&]*', '\\1', 'g'), '[?&]+$', ''), '[?]&+', '?'), '/+([?]|$)', '\\1')"
_add("url_canonical", lambda s, d: art(s, d).select("page_id", urls.canonical_url(F.col("url")).alias("canonical")), f"WITH {ART} SELECT page_id, {_CANON} AS canonical FROM art")
_add("url_key", lambda s, d: art(s, d).select("page_id", urls.url_key(urls.canonical_url(F.col("url"))).alias("url_key")), f"WITH {ART} SELECT page_id, sha256({_CANON}) AS url_key FROM art")
_add("event_id", lambda s, d: art(s, d).select("page_id", urls.event_id(urls.canonical_url(F.col("url")), F.lit(None).cast("string"), F.col("feed"), F.lit(None).cast("string")).alias("event_id")), f"WITH {ART} SELECT page_id, sha256({_CANON} || '||' || feed || '|unknown-date') AS event_id FROM art")
_add("source_domain", lambda s, d: art(s, d).select("page_id", urls.source_domain(F.col("url")).alias("domain")), f"WITH {ART} SELECT page_id, regexp_replace(lower(feed), '^www[.]', '') AS domain FROM art")
_add("resolve_domain", lambda s, d: art(s, d).select("page_id", urls.resolve_domain(F.when(F.col("page_id") % 2 == 0, F.lit("WWW.Given.org")), F.col("url")).alias("domain")), f"WITH {ART} SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'given.org' ELSE regexp_replace(lower(feed), '^www[.]', '') END AS domain FROM art")


def _entries(spark, sf):
    a = art(spark, sf)
    return a.unionByName(a.withColumn("page_id", F.col("page_id") + 1_000_000_000).withColumn("url", F.concat(F.regexp_replace("url", "#.*$", ""), F.when(F.contains("url", F.lit("?")), F.lit("&")).otherwise(F.lit("?")), F.lit("utm_medium=x")))).withColumn("url_key", urls.url_key(urls.canonical_url(F.col("url"))))


_ENTRIES = f"{ART}, e AS (SELECT page_id, feed, url, title, sha256({_CANON}) AS url_key FROM art UNION ALL SELECT page_id + 1000000000, feed, regexp_replace(url, '#.*$', '') || CASE WHEN contains(url, '?') THEN '&' ELSE '?' END || 'utm_medium=x', title, sha256({_CANON}) FROM art), w AS (SELECT *, row_number() OVER (PARTITION BY url_key ORDER BY feed, url, title, page_id) AS n FROM e)"
_add("entries_dedupe", lambda s, d: ordered.first_wins(_entries(s, d), "url_key", ["feed", "url", "title", "page_id"]).select("page_id", "url_key"), f"WITH {_ENTRIES} SELECT page_id, url_key FROM w WHERE n = 1")
_add("new_only", lambda s, d: joins.new_only(_entries(s, d), _entries(s, d).where("page_id % 3 = 0").select("url_key")).select("page_id"), f"WITH {_ENTRIES} SELECT page_id FROM e WHERE url_key NOT IN (SELECT url_key FROM e WHERE page_id % 3 = 0)")


def feed_xml_roundtrip(spark, sf):
    esc = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    a = art(spark, sf).where("title <> ''")
    rss = F.concat(F.lit("<rss><channel><title>c</title><item><title>"), esc(F.col("title")), F.lit("</title><link>"), esc(F.col("url")), F.lit("</link><guid>"), F.col("page_id").cast("string"), F.lit("</guid></item></channel></rss>"))
    atom = F.concat(F.lit("<feed><title>c</title><entry><title>"), esc(F.col("title")), F.lit('</title><link href="'), esc(F.col("url")), F.lit('"/><id>'), F.col("page_id").cast("string"), F.lit("</id></entry></feed>"))
    body = F.when(F.col("page_id") % 3 == 0, rss).when(F.col("page_id") % 3 == 1, atom).otherwise(F.lit("<rss><chan"))
    out = readers.parse_feeds(a.select(F.col("feed").alias("feed_url"), body.alias("body")))
    return out.select(F.col("entry_guid").cast("long").alias("page_id"), F.col("entry_url_raw").alias("url"), "entry_title")


_add("feed_xml_roundtrip", feed_xml_roundtrip, f"WITH {ART} SELECT page_id, url, trim(title) AS entry_title FROM art WHERE title <> '' AND page_id % 3 < 2")


def parse_published(spark, sf):
    o = _t(spark, sf, "orders")
    said = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("Mon, "), F.date_format("o_orderdate", "d MMM yyyy HH:mm:ss"), F.lit(" GMT"))).when(F.col("o_orderkey") % 3 == 1, F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise(F.lit("not-a-date"))
    p = text.parse_published(said)
    return o.select("o_orderkey", text.iso_utc(p["ts"]).alias("ts"), p["err"].alias("err"))


_add("parse_published", parse_published, "SELECT o_orderkey, CASE WHEN o_orderkey % 3 < 2 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') END AS ts, o_orderkey % 3 = 2 AS err FROM orders")
_add("last_name", lambda s, d: _t(s, d, "customer").select("c_custkey", names.last_name(F.regexp_replace("c_name", "#", "  ")).alias("last_name")), "SELECT c_custkey, regexp_extract(c_name, '#(.*)$', 1) AS last_name FROM customer")
_add("name_normalize", lambda s, d: _t(s, d, "customer").select("c_custkey", names.normalize_name(F.concat("c_name", F.lit(" (Ámbar)  ÉL "))).alias("name")), "SELECT c_custkey, lower(c_name) || ' el' AS name FROM customer")
_add("name_variants", lambda s, d: _t(s, d, "customer").select("c_custkey", F.posexplode(names.name_variants(F.concat(F.lit("Dr "), F.replace("c_name", F.lit("#"), F.lit(" "))))).alias("no", "variant")),
     "SELECT c_custkey, 0 AS no, 'Dr ' || replace(c_name, '#', ' ') AS variant FROM customer UNION ALL SELECT c_custkey, 1, replace(c_name, '#', ' ') FROM customer")


def nickname_expand(spark, sf):
    dim = _t(spark, sf, "nation").select(F.lower("n_name").alias("nick"), F.concat(F.lower("n_name"), F.lit("us")).alias("formal"))
    n = _t(spark, sf, "customer").join(_t(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.concat(F.initcap("n_name"), F.lit(" Smith")).alias("name"))
    return names.expand_nicknames(n, dim).select("c_custkey", F.array_join("nicknames", "|").alias("nicknames"))


_add("nickname_expand", nickname_expand, "SELECT c_custkey, upper(substr(n_name, 1, 1)) || lower(substr(n_name, 2)) || 'us Smith' AS nicknames FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE NOT contains(n_name, ' ') UNION ALL SELECT c_custkey, '' FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE contains(n_name, ' ')")
_add("coverage_queries", lambda s, d: doc(s, d).select("doc_id", F.posexplode(text.coverage_queries(F.col("source_feed_url_original"), F.col("entry_title"), F.col("summary"))).alias("no", "query")),
     f"WITH {DOC}, b AS (SELECT doc_id, source, lower(' ' || entry_title || ' ' || summary || ' ') AS t FROM doc) SELECT doc_id, 0 AS no, '\"' || source || '\"' AS query FROM b UNION ALL SELECT doc_id, 1, '\"' || source || '\" obituary' FROM b WHERE " + " OR ".join(f"contains(t, '{p}')" for p in text.OBITUARY_SIGNALS))
_add("biography_score", lambda s, d: _t(s, d, "events").select("event_id", text.biography_score(F.array(F.concat(F.lit("Category:"), F.col("event_type"), F.when(F.col("event_id") % 2 == 0, F.lit(" births")).otherwise(F.lit(" actors"))), F.when(F.col("event_id") % 5 == 0, F.lit("Living people")).otherwise(F.lit("Lists")))).alias("score")),
     "SELECT event_id, CAST(CASE WHEN event_id % 2 = 0 THEN 3 ELSE 1 END + CASE WHEN event_id % 5 = 0 THEN 5 ELSE -3 END AS INTEGER) AS score FROM events")


def _salvage(spark, sf):
    e = _t(spark, sf, "events")
    raw = F.when(F.col("event_id") % 4 == 0, F.col("props")).when(F.col("event_id") % 4 == 1, F.concat(F.lit("So: "), "props", F.lit(" done"))).when(F.col("event_id") % 4 == 2, F.lit("no json")).otherwise(F.lit(" "))
    r = responses.salvage_json(raw)
    return e.select("event_id", r["ok"].alias("ok"), r["error"].alias("error"), F.get_json_object(r["value"], "$.k").try_cast("long").alias("k"))


_add("json_salvage", _salvage, "SELECT event_id, event_id % 4 < 2 AS ok, CASE event_id % 4 WHEN 2 THEN 'no_json_object_found' WHEN 3 THEN 'empty_output' END AS error, CASE WHEN event_id % 4 < 2 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k FROM events")
_add("validate_response", lambda s, d: _t(s, d, "events").select("event_id", F.array_join(responses.violations({"kind": F.col("event_type").isin("view", "click"), "value": F.col("value").between(0, 50)}), ",").alias("violations")), "SELECT event_id, concat_ws(',', CASE WHEN event_type NOT IN ('view', 'click') THEN 'kind' END, CASE WHEN NOT value BETWEEN 0 AND 50 THEN 'value' END) AS violations FROM events")
_add("batch_explode", lambda s, d: responses.explode_batch(_t(s, d, "events").select("event_id", F.concat(F.lit('{"items":[{"event_id":"'), F.col("user_id").cast("string"), F.lit('","t":"'), F.col("event_type"), F.lit('"}]}')).alias("raw")), "raw", "event_id").select("event_id", F.col("item")["t"].alias("t")), "SELECT CAST(user_id AS VARCHAR) AS event_id, arg_max(event_type, event_id) AS t FROM events GROUP BY user_id")
_add("payloads", lambda s, d: pipelines.payloads(_t(s, d, "conversations"), "Turns", F.concat("role", F.lit(": "), "text"), "turn", "conv_id"), "SELECT conv_id, 'Turns' || chr(10) || string_agg(CAST(turn AS VARCHAR) || '. ' || role || ': ' || text, chr(10) ORDER BY turn) AS payload FROM conversations GROUP BY conv_id")
_add("unprocessed", lambda s, d: joins.unprocessed(trial(s, d).select("event_id").distinct(), trial(s, d).where("seq % 7 <> 0").where("confirmed_count > 150")), f"WITH {TRIAL} SELECT DISTINCT event_id FROM trial WHERE event_id NOT IN (SELECT event_id FROM trial WHERE ok AND seq % 7 <> 0 AND confirmed_count > 150)")
_add("retry_candidates", lambda s, d: joins.retry_candidates(trial(s, d).select("event_id").distinct(), trial(s, d)), f"WITH {TRIAL} SELECT event_id FROM trial GROUP BY event_id HAVING NOT arg_max(ok, seq)")
_add("retry_resolution", lambda s, d: rollups.retry_resolution(trial(s, d).where("seq % 2 = 0"), trial(s, d)), f"WITH {TRIAL}, f AS (SELECT event_id FROM trial WHERE seq % 2 = 0 GROUP BY event_id HAVING NOT arg_max(ok, seq)), l AS (SELECT event_id, arg_max(ok, seq) AS ok FROM trial GROUP BY event_id) SELECT count(*) AS n_failed, count(*) FILTER (WHERE l.ok) AS n_resolved FROM f LEFT JOIN l ON f.event_id = l.event_id")
_add("first_wins", lambda s, d: ordered.first_wins(trial(s, d), "event_id", ["seq"]).select("event_id", "seq", "status"), f"WITH {TRIAL} SELECT event_id, min(seq) AS seq, arg_min(status, seq) AS status FROM trial GROUP BY event_id")
_add("last_wins", lambda s, d: ordered.last_wins(trial(s, d), "event_id", ["seq"]).select("event_id", "seq", "status"), f"WITH {TRIAL} SELECT event_id, max(seq) AS seq, arg_max(status, seq) AS status FROM trial GROUP BY event_id")
_add("best_per_subject", lambda s, d: rollups.best_per_subject(trial(s, d).withColumn("subject_name", F.col("event_id").cast("string"))).select("subject_name", "seq", "confirmed_count"), f"WITH {TRIAL}, w AS (SELECT CAST(event_id AS VARCHAR) AS subject_name, seq, confirmed_count, row_number() OVER (PARTITION BY event_id ORDER BY confirmed_count DESC, seq) AS n FROM trial) SELECT subject_name, seq, confirmed_count FROM w WHERE n = 1")
_add("best_match", lambda s, d: ordered.best_match(verdict(s, d).withColumnRenamed("page_id", "pageid"), ["event_id"]).select("event_id", "pageid", "score"), f"WITH {VERDICT}, w AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY score DESC, page_id, rank) AS n FROM verdict) SELECT event_id, page_id AS pageid, score FROM w WHERE n = 1")
_add("select_candidates", lambda s, d: ordered.select_candidates(verdict(s, d), ["event_id"]).select("event_id", "page_id", "score"), f"WITH {VERDICT}, w AS (SELECT *, count(*) FILTER (WHERE score > 0) OVER (PARTITION BY event_id) AS p, row_number() OVER (PARTITION BY event_id, score > 0 ORDER BY rank) AS n FROM verdict) SELECT event_id, page_id, score FROM w WHERE score > 0 OR (p < 2 AND n = 1)")
_add("similar_names", lambda s, d: joins.similar_names(_t(s, d, "customer").withColumn("nm", F.concat(F.regexp_extract("c_name", "([0-9]+)$", 1), F.lit(" smith"))), "c_custkey", "nm", ["c_nationkey"], 1), "WITH n AS (SELECT c_custkey, c_nationkey, regexp_extract(c_name, '([0-9]+)$', 1) AS m FROM customer) SELECT DISTINCT a.c_custkey FROM n a JOIN n b ON a.c_nationkey = b.c_nationkey AND a.c_custkey <> b.c_custkey WHERE levenshtein(a.m, b.m) <= 1")


def _reliable(spark, sf):
    entries = spark.createDataFrame(list(RELIABLE), "entry string, kind string")
    return joins.filter_reliable(art(spark, sf).withColumn("source_domain", urls.source_domain(F.col("url"))), entries)


_REL = f"{ART}, s AS (SELECT *, regexp_replace(lower(feed), '^www[.]', '') AS dom, regexp_replace(lower(url), '^https?://', '') AS bare FROM art), rel AS (SELECT *, dom = 'example.org' OR dom LIKE '%.example.org' OR dom = 'example.net' OR dom LIKE '%.example.net' OR starts_with(regexp_replace(bare, '^www[.]', ''), 'example.com/fr') OR starts_with(bare, 'blog.example.com/en') AS ok FROM s)"
_add("reliable_match", lambda s, d: _reliable(s, d).select("page_id", "source_domain"), f"WITH {_REL} SELECT page_id, dom AS source_domain FROM rel WHERE ok")
_add("coverage_dedupe", lambda s, d: ordered.rerank(ordered.dedupe_known(_entries(s, d).withColumn("url", F.when(F.col("page_id") % 5 == 0, F.lit("")).otherwise(F.col("url_key"))), ["feed"], "url", ["page_id"]), ["feed"], ["page_id"]).select("feed", "page_id", F.col("rank").cast("long").alias("rank")),
     f"WITH {_ENTRIES}, q AS (SELECT feed, page_id, CASE WHEN page_id % 5 = 0 THEN '' ELSE url_key END AS u FROM e), z AS (SELECT *, row_number() OVER (PARTITION BY feed, u ORDER BY page_id) AS k FROM q) SELECT feed, page_id, row_number() OVER (PARTITION BY feed ORDER BY page_id) AS rank FROM z WHERE k = 1 OR u = ''")
_DOMAINS = f"""{VERDICT}, g AS (SELECT event_id, pass, domain, min(rank) AS r FROM verdict WHERE about_subject AND (pass = 1 OR reliable) AND domain <> '' GROUP BY ALL),
a AS (SELECT event_id, string_agg(domain, ',' ORDER BY r) FILTER (WHERE pass = 1) AS f, string_agg(domain, ',' ORDER BY r) FILTER (WHERE pass = 2) AS s FROM g GROUP BY event_id)"""
_add("confirmed_domains", lambda s, d: rollups.confirmed_domains(verdict(s, d)).select("event_id", F.array_join("first_pass_domains", ",").alias("first"), F.array_join("second_pass_domains", ",").alias("second")),
     f"WITH {_DOMAINS} SELECT v.event_id, coalesce(a.f, '') AS first, coalesce(a.s, '') AS second FROM (SELECT DISTINCT event_id FROM verdict) v LEFT JOIN a ON a.event_id = v.event_id")


def verdict_fold(spark, sf):
    """A source's pages are judged in blocks of thirty page ids, so every status occurs."""
    rows = verdict(spark, sf).withColumn("event_id", F.concat("event_id", F.lit("-"), F.floor(F.col("page_id") / 30).cast("string")))
    out = rollups.fold_verdict(rollups.confirmed_domains(rows))
    return out.select("event_id", "gate4b_status", F.col("confirmed_count").cast("long").alias("confirmed_count"), F.col("reliable_domain_count").cast("long").alias("reliable_domain_count"))


_add("verdict_fold", verdict_fold, f"""WITH {VERDICT}, a AS (SELECT event_id || '-' || CAST(page_id // 30 AS VARCHAR) AS event_id, count(DISTINCT domain) FILTER (WHERE about_subject AND pass = 1) AS f,
count(DISTINCT domain) FILTER (WHERE about_subject AND (pass = 1 OR reliable)) AS b FROM (SELECT * REPLACE (nullif(domain, '') AS domain) FROM verdict) GROUP BY 1)
SELECT event_id, CASE WHEN f >= 2 THEN 'LIKELY_NOTABLE' WHEN b >= 2 THEN 'POSSIBLY_NOTABLE' WHEN f = 1 THEN 'UNCERTAIN' ELSE 'NOT_NOTABLE' END AS gate4b_status, f AS confirmed_count, CASE WHEN f >= 2 THEN f ELSE b END AS reliable_domain_count FROM a""")
_add("evidence_gate", lambda s, d: rollups.evidence_gate(verdict(s, d).groupBy("event_id").agg(F.count("*").alias("n_results"), F.max(F.when(F.col("page_id") % 50 == 0, "HAS_PAGE")).alias("gate3_status")), 12).select("event_id", "short_circuit"), f"WITH {VERDICT} SELECT event_id, CASE WHEN bool_or(page_id % 50 = 0) THEN 'HAS_PAGE' WHEN count(*) < 12 THEN 'SKIPPED_INSUFFICIENT_RESULTS' END AS short_circuit FROM verdict GROUP BY event_id")


def _runs(spark, sf):
    day = F.date_trunc("day", "ts")
    return _t(spark, sf, "events").where(F.hour("ts").between(8, 15)).groupBy(day.alias("day")).agg(F.min("ts").alias("started_at"), F.max("ts").alias("finished_at")).select(F.date_format("day", "yyyyMMdd").alias("run_id"), "started_at", "finished_at")


_RUNS = "run AS (SELECT strftime(date_trunc('day', ts), '%Y%m%d') AS run_id, min(ts) AS started_at, max(ts) AS finished_at FROM events WHERE hour(ts) BETWEEN 8 AND 15 GROUP BY 1)"


def run_attribution(spark, sf):
    t = _t(spark, sf, "events").select(F.col("event_id").alias("trial_id"), F.col("ts").alias("trial_at"))
    return joins.attribute_run(t, _runs(spark, sf)).select("trial_id", "run_id")


_add("run_attribution", run_attribution, f"WITH {_RUNS}, i AS (SELECT e.event_id, max(struct_pack(f := finished_at, r := run_id)) AS m FROM events e JOIN run ON e.ts BETWEEN started_at AND finished_at GROUP BY e.event_id), n AS (SELECT e.event_id, arg_min(run_id, abs(epoch_us(e.ts) - epoch_us(finished_at))) AS r FROM events e JOIN run ON e.ts BETWEEN finished_at - INTERVAL 15 MINUTE AND finished_at + INTERVAL 15 MINUTE GROUP BY e.event_id) SELECT e.event_id AS trial_id, coalesce(i.m.r, n.r) AS run_id FROM events e LEFT JOIN i ON i.event_id = e.event_id LEFT JOIN n ON n.event_id = e.event_id")


def known_upsert(spark, sf):
    """The earlier half of the trials is the state, the later half comes to it."""
    t = trial(spark, sf).select(F.col("event_id").cast("string").alias("normalized_name"), "status", F.col("seq").cast("string").alias("added_at_utc"), "seq")
    half = (t.agg(F.max("seq")).first()[0] or 0) // 2
    state = rollups.upsert_known(t.where("false"), t.where(F.col("seq") <= half))
    return rollups.upsert_known(state, t.where(F.col("seq") > half)).select("normalized_name", "status", "added_at_utc", "seq")


_add("known_upsert", known_upsert, f"WITH {TRIAL} SELECT CAST(event_id AS VARCHAR) AS normalized_name, arg_max(status, seq) AS status, CAST(min(seq) AS VARCHAR) AS added_at_utc, max(seq) AS seq FROM trial GROUP BY event_id")
_add("person_rollup", lambda s, d: rollups.person_rollup(trial(s, d).select(F.col("status").alias("subject_name"), F.date_format("ts", "yyyyMMdd").alias("run_id"), "event_id", F.col("ts").alias("trial_at"), "seq", F.array(F.col("event_id").cast("string")).alias("urls"), F.array().cast("array<string>").alias("domains"))).select("person", F.size("run_ids").cast("long").alias("runs"), "event_count", F.size("all_urls").cast("long").alias("urls"), F.size("events").cast("long").alias("events")), f"WITH {TRIAL} SELECT lower(status) AS person, count(DISTINCT strftime(ts, '%Y%m%d')) AS runs, count(DISTINCT event_id) AS event_count, count(DISTINCT event_id) AS urls, count(DISTINCT event_id) AS events FROM trial GROUP BY status")
_add("priority_recency_topk", lambda s, d: ordered.top_k(_t(s, d, "orders").select(F.col("o_orderkey").alias("seq"), F.nullif(F.substring("o_orderpriority", 1, 1).cast("int"), F.lit(5)).alias("feed_priority"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("published_at_utc")), 50, ordered.priority_order()), "SELECT o_orderkey AS seq, nullif(CAST(substr(o_orderpriority, 1, 1) AS INTEGER), 5) AS feed_priority, strftime(o_orderdate, '%Y-%m-%d') AS published_at_utc FROM orders ORDER BY feed_priority ASC NULLS LAST, published_at_utc DESC, seq LIMIT 50")
_add("sample_k", lambda s, d: ordered.sample_k(_t(s, d, "orders"), 50, "o_orderkey").select("o_orderkey"), "SELECT o_orderkey FROM orders ORDER BY md5('42:' || CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT 50")
_add("error_samples", lambda s, d: rollups.error_samples(_t(s, d, "events").withColumn("err", F.when(F.col("event_type") == "error", F.concat(F.lit("bad "), F.col("user_id").cast("string")))), "err"), "SELECT 'bad ' || CAST(user_id AS VARCHAR) AS error, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY user_id")
_add("batches", lambda s, d: ordered.batches(_t(s, d, "orders"), [F.col("o_orderdate").desc(), F.col("o_orderkey")], 10).select("o_orderkey", "batch"), "SELECT o_orderkey, CAST((row_number() OVER (ORDER BY o_orderdate DESC, o_orderkey) - 1) // 10 + 1 AS BIGINT) AS batch FROM orders")
_add("backfill_priority", lambda s, d: joins.backfill_priority(doc(s, d).withColumn("lacks_priority", F.col("doc_id") % 2 == 0).withColumn("feed_priority", F.lit(9)), _feeds(s, d)).select("doc_id", "feed_priority"), f"WITH {DOC} SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN priority ELSE 9 END AS feed_priority FROM doc")
_add("latest_and_duration", lambda s, d: _runs(s, d).agg(F.max_by("run_id", "finished_at").alias("latest_run"), F.sum(F.unix_timestamp("finished_at") - F.unix_timestamp("started_at")).alias("seconds")), f"WITH {_RUNS} SELECT arg_max(run_id, finished_at) AS latest_run, CAST(sum(floor(epoch(finished_at)) - floor(epoch(started_at))) AS BIGINT) AS seconds FROM run")
_add("report_lines", lambda s, d: writers.report_lines(art(s, d).select(F.col("feed").alias("section"), F.col("page_id").cast("string").alias("subject_name"), "title", F.array("url").alias("urls"))).select("section", F.col("line_no").cast("long").alias("line_no"), "line"),
     f"WITH {ART}, l AS (SELECT feed AS section, CAST(page_id AS VARCHAR) AS k, 0 AS o, '- ' || page_id AS line FROM art UNION ALL SELECT feed, CAST(page_id AS VARCHAR), 1, '  ' || title FROM art UNION ALL SELECT feed, CAST(page_id AS VARCHAR), 2, '    ' || url FROM art) SELECT section, row_number() OVER (PARTITION BY section ORDER BY k, o) AS line_no, line FROM l")
