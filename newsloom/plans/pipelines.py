"""End-to-end compositions; each is one plan until a table must be kept."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom import schemas
from newsloom.functions import names, responses, text, urls
from newsloom.operators import joins, ordered, records, rollups
from newsloom.sources import readers, shared, writers


def ingest(docs: DataFrame, seen: DataFrame) -> DataFrame:
    """Feed documents to new events: parsed, canonical, deduplicated across feeds, dated, identified."""
    rows = _entries(docs)
    rows = joins.new_only(ordered.first_wins(rows.where("url_key IS NOT NULL"), "url_key", ["feed_url", "entry_url_raw", "entry_title"]), seen)
    return _identified(rows)


def _entries(docs: DataFrame) -> DataFrame:
    rows = readers.parse_feeds(docs).withColumn("entry_url_canonical", urls.canonical_url(F.col("entry_url_raw")))
    return rows.withColumn("url_key", urls.url_key(F.col("entry_url_canonical")))


def _identified(rows: DataFrame) -> DataFrame:
    rows = rows.withColumn("__p", text.parse_published(F.col("published"))).withColumn("published_at_utc", text.iso_utc(F.col("__p.ts"))).withColumn("date_parse_error", F.col("__p.err")).drop("__p")
    return rows.withColumn("event_id", urls.event_id(F.col("entry_url_canonical"), F.col("entry_guid"), F.col("feed_url"), F.col("published_at_utc")))


class Ingest(NamedTuple):
    """What a run of ingest gives: new events, their keys for the seen table, the feeds' state, nine counters."""

    events: DataFrame
    seen: DataFrame
    fetch_state: DataFrame
    stats: DataFrame


def ingest_run(fetches: DataFrame, seen: DataFrame, state: DataFrame | None = None, order: Sequence[str] = ("feed_url", "entry_url_raw", "entry_title")) -> Ingest:
    """One run over fetched feeds.

    fetches: (feed_url, body, not_modified, error) and the columns of ``schemas.FETCH_STATE``; seen: (url_key, ...);
    state: the feeds' state before; order: which of several entries of a key is first, and the place in the feed
    where that leaves it open.  Entries are parsed once and kept, since events and counters both read them.
    A feed that was not modified has no entries and counts as fetched; one that does not parse counts as failed.
    A feed of several documents (rows, with ``first`` as in ``parse_feeds``) is one feed, fine if all of them are.
    Fetches are kept first, so that what makes them runs once and not for entries, outcomes and states apart."""
    fetches = shared.kept(fetches, "fetches")
    fresh = fetches.where("error IS NULL AND NOT coalesce(not_modified, false)").select("feed_url", "body", *(c for c in fetches.columns if c == "first"))
    rows = _identified(_entries(fresh))
    by = Window.partitionBy("url_key", F.when(F.col("url_key").isNull(), F.xxhash64("feed_url", "at"))).orderBy(*order, "at")
    known = seen.select("url_key").distinct().withColumn("__seen", F.lit(True))
    rows = rows.withColumn("__n", F.row_number().over(by)).join(known, "url_key", "left")
    rows = rows.withColumn("valid", F.col("url_key").isNotNull()).withColumn("is_new", F.col("valid") & (F.col("__n") == 1) & F.col("__seen").isNull()).drop("__n", "__seen")
    rows = shared.kept(rows, "ingest")
    fetched = F.struct("feed_url", F.col("error").isNull().alias("fine"), F.coalesce("not_modified", F.lit(False)).alias("same"))
    bodies = fetches.select(fetched.alias("feed_url"), F.expr("CASE WHEN error IS NULL AND NOT coalesce(not_modified, false) THEN body END").alias("body"))
    feeds = readers.feed_outcomes(bodies).select("feed_url.*", F.coalesce("ok", F.lit(False)).alias("ok"))
    feeds = feeds.groupBy(F.col("feed_url").alias("feed")).agg(F.bool_and(F.col("fine") & (F.col("same") | F.col("ok"))).alias("ok"), F.bool_and("same").alias("not_modified"))
    events = rows.where("is_new").drop("valid", "is_new")
    keys = events.select("url_key", "event_id", F.col("feed_url").alias("first_feed_url"))
    latest = rollups.fetch_state(fetches.select([f.split()[0] for f in schemas.FETCH_STATE.split(", ")]), state)
    return Ingest(events, keys, latest, records.ingest_stats(rows, feeds))


def prefilter(events: DataFrame, known: DataFrame, feeds: DataFrame) -> DataFrame:
    return joins.with_priority(joins.flag_known(text.classify_event(readers.spread(events)), known), feeds)


def select_triaged(trials: DataFrame, decisions=("STRONG_PASS", "WEAK_PASS"), keep: str = "first") -> DataFrame:
    """One trial for each event, then passing decisions with a subject; ``reason`` says why not.

    ``first`` lets a failed first trial stand, as the log's order has it; ``last_success`` takes retries."""
    rows = ordered.first_wins(trials, "event_id", ["seq"]) if keep == "first" else ordered.last_wins(trials.where("ok"), "event_id", ["seq"])
    subject = F.coalesce(F.col("subject_name"), F.lit(""))
    return rows.withColumn("reason", F.when(subject == "", "missing_subject").when(~F.coalesce(F.col("decision").isin(*decisions), F.lit(False)), "decision_not_selected"))


def triage_worklist(events: DataFrame, trials: DataFrame, k: int = 50, pattern: str | None = None, retry: bool = False, n: int = 10) -> DataFrame:
    """The first k open events by priority and date, with ``position`` and batches of n.

    Open events have no successful trial; with ``retry`` they are those whose latest trial failed."""
    rows = text.keyword_filter(events, pattern) if pattern else events
    rows = joins.retry_candidates(rows, trials) if retry else joins.unprocessed(rows, trials)
    position = F.row_number().over(Window.orderBy(*ordered.priority_order()))  # over k rows at most
    rows = ordered.top_k(rows, k, ordered.priority_order()).withColumn("position", position)
    return rows.withColumn("batch", F.floor((F.col("position") - 1) / n).cast("int") + 1)


def candidates(subjects: DataFrame, results: DataFrame, pages: DataFrame, cap: int = 10) -> DataFrame:
    """(event_id, subject_name) to ranked candidates with their pages and scores."""
    made = subjects.select("event_id", "subject_name", F.posexplode(names.name_variants(F.col("subject_name"))).alias("variant_no", "variant"))
    found = joins.search_lookup(made, results, cap)
    found = ordered.dedupe_known(found, ["event_id"], "pageid", ["variant_no", "rank"])
    found = ordered.rerank(found.withColumnRenamed("rank", "__r"), ["event_id"], ["variant_no", "__r"]).where(F.col("rank") <= cap)
    return joins.attach_pages(found.drop("__r"), pages).withColumn("score", text.biography_score(F.coalesce("categories", F.array().cast("array<string>"))))


def candidate_sets(subjects: DataFrame, results: DataFrame, pages: DataFrame, redirects: DataFrame | None = None, nicknames: DataFrame | None = None, search_errors: DataFrame | None = None, page_errors: DataFrame | None = None, cap: int = 10) -> DataFrame:
    """One record for each subject: its queries, its ranked candidates with their pages, and what failed.

    subjects: (event_id, subject_name, source_context, feed_priority, published_at_utc), one row an event;
    results: (query, rank, title, pageid, snippet); pages: (title, pageid, fullurl, is_disambig, description, extract,
    categories); redirects: (from, to); search_errors: (query, error); page_errors: (title, error).
    An event of which one search failed has no candidates; a page that failed leaves its candidate without page.
    Ranks are given before items without a title go, so they may have gaps."""
    named = names.expand_nicknames(subjects, nicknames, "subject_name") if nicknames is not None else subjects.withColumn("nicknames", F.array().cast("array<string>"))
    named = named.withColumn("variants", names.name_variants(F.col("subject_name"), F.col("nicknames"))).drop("nicknames")
    asked = named.select("event_id", F.posexplode("variants").alias("variant_no", "variant"))
    errors = asked.select("event_id", F.col("variant_no").alias("at"), F.col("variant").alias("error")).where("false")
    if search_errors is not None:
        failed = asked.join(search_errors.select(F.col("query").alias("variant"), "error"), "variant")
        failed = failed.groupBy("event_id").agg(F.min_by("error", "variant_no").alias("error"))  # the first that fails ends the search
        errors = errors.unionByName(failed.select("event_id", F.lit(0).alias("at"), F.concat(F.lit("search_error:"), "error").alias("error")))
        asked = asked.join(failed.select("event_id"), "event_id", "left_anti")
    items = results.select("query", "rank", F.col("title").alias("item_title"), F.col("pageid").alias("item_page"), "snippet")
    found = ordered.dedupe_known(joins.search_lookup(asked, items, cap), ["event_id"], "item_page", ["variant_no", "rank"])
    found = ordered.rerank(found.withColumnRenamed("rank", "__r"), ["event_id"], ["variant_no", "__r"]).select("event_id", "rank", "item_title", "snippet", F.col("item_title").alias("title"))
    if page_errors is not None:
        found = found.join(page_errors.select(F.col("title").alias("__bad"), F.col("error").alias("__error")), F.col("title") == F.col("__bad"), "left")
        lost = found.where("__bad IS NOT NULL").select("event_id", F.col("rank").alias("at"), F.concat(F.lit("page_error:"), "item_title", F.lit(":"), "__error").alias("error"))
        errors = errors.unionByName(lost)
        found = found.withColumn("title", F.when(F.col("__bad").isNull(), F.col("title"))).drop("__bad", "__error")  # looked up in vain
    met = joins.attach_pages(found, pages.withColumn("__page", F.lit(True)), redirects)
    met = met if redirects is not None else met.withColumn("redirected_from", F.lit(None).cast("string"))
    met = met.withColumn("title", F.when(F.col("__page"), F.col("title"))).withColumn("redirected_from", F.when(F.col("__page"), F.col("redirected_from")))
    sets = records.nested(records.candidate_fields(met), ["event_id"], ["rank"], records.CANDIDATE_FIELDS, "candidates")
    out = records.with_nested(named, sets, "event_id", "candidates")
    out = records.with_nested(out, records.nested(errors, ["event_id"], ["at", "error"], ["error"], "errors"), "event_id", "errors")
    query = F.struct(F.col("subject_name").alias("original"), names.normalize_query(F.col("subject_name")).alias("normalized"), "variants")
    return out.withColumn("query", query).withColumn("errors", F.col("errors.error")).drop("variants")


def coverage_sets(subjects: DataFrame, responses_: DataFrame, search_errors: DataFrame | None = None, per_page: int = 20, pages: int = 2) -> DataFrame:
    """One record for each subject: its queries, its merged and ranked results, their number, and what failed.

    subjects: (event_id, subject_name, title, summary, ...); responses_: (query, count, offset, results);
    search_errors: (query, error).  A query that failed costs its own results only."""
    asked = subjects.withColumn("queries", text.coverage_queries(F.col("subject_name"), F.col("title"), F.col("summary")))
    good = responses_
    errors = None
    if search_errors is not None:
        good = responses_.join(search_errors.select("query"), "query", "left_anti")
        each = asked.select("event_id", F.posexplode("queries").alias("at", "query")).join(search_errors, "query")
        errors = records.nested(each.withColumn("error", F.concat(F.lit("search_error:"), "query", F.lit(":"), "error")), ["event_id"], ["at"], ["error"], "errors")
    found = coverage(subjects, good, per_page, pages)
    out = records.with_nested(asked, records.nested(found, ["event_id"], ["rank"], records.RESULT_FIELDS, "results"), "event_id", "results")
    out = records.with_nested(out, errors, "event_id", "errors").withColumn("errors", F.col("errors.error")) if errors is not None else out.withColumn("errors", F.array().cast("array<string>"))
    return out.withColumn("result_count", F.size("results").cast("long"))


def reliable_sets(sets: DataFrame, entries: DataFrame) -> DataFrame:
    """Coverage records with their reliable results alone, ranked anew, and the number before: ``unfiltered_count``."""
    flat = sets.select("event_id", F.inline("results"))
    kept = records.nested(reliable(flat, entries), ["event_id"], ["rank"], records.RESULT_FIELDS, "results")
    out = records.with_nested(sets.withColumn("unfiltered_count", F.size("results").cast("long")).drop("results", "result_count"), kept, "event_id", "results")
    return out.withColumn("result_count", F.size("results").cast("long"))


def annotate_match(rows: DataFrame) -> DataFrame:
    """(event_id, subject_name, rank, title, redirected_from, pageid, score): one signal for each event."""
    bio = rows.where("score >= 3")
    best = ordered.best_match(joins.exact_matches(bio), ["event_id"])
    target = names.normalize_name(F.col("title"))
    chosen = best.select("event_id", F.col("rank").alias("__rank"), target.alias("__t"), F.col("title").alias("best_title"), F.col("pageid").alias("best_pageid"), "match_type", F.col("score").alias("best_score"))
    near = F.levenshtein(names.normalize_name(F.col("title")), F.col("__t"), 2).between(0, 2) & (names.last_name(names.normalize_name(F.col("title"))) == names.last_name(F.col("__t")))
    similar = bio.join(chosen, "event_id").where((F.col("rank") != F.col("__rank")) & near).select("event_id").distinct().withColumn("has_similar", F.lit(True))
    out = rows.groupBy("event_id").agg(F.count("title").alias("n"), F.count_if(F.col("score") >= 3).alias("n_bio")).join(chosen.drop("__rank", "__t"), "event_id", "left").join(similar, "event_id", "left")
    signal = F.when(F.col("n") == 0, "NO_RESULTS").when(F.col("n_bio") == 0, "NO_BIO_CANDIDATES").when(F.col("best_title").isNull(), "NO_EXACT_MATCH").when(F.col("has_similar"), "EXACT_MATCH_AMBIGUOUS").otherwise("EXACT_MATCH")
    return out.withColumn("signal", signal).withColumn("has_similar", F.coalesce("has_similar", F.lit(False)))


def coverage(subjects: DataFrame, responses_: DataFrame, per_page: int = 20, pages: int = 2) -> DataFrame:
    """(event_id, subject_name, title, summary) to deduplicated, re-ranked results of all queries and pages."""
    asked = subjects.select("event_id", F.posexplode(text.coverage_queries(F.col("subject_name"), F.col("title"), F.col("summary"))).alias("query_no", "query")).withColumn("offset", F.explode(F.sequence(F.lit(0), F.lit(pages - 1))))
    found = asked.join(responses_.where(F.col("count") == per_page), ["query", "offset"]).select("event_id", "query_no", "offset", F.posexplode("results").alias("at", "r")).select("event_id", "query_no", "offset", "at", "r.*")
    found = ordered.dedupe_known(found, ["event_id"], "url", ["query_no", "offset", "at"])
    return ordered.rerank(found, ["event_id"], ["query_no", "offset", "at"]).withColumn("source_domain", urls.source_domain(F.col("url")))


def reliable(found: DataFrame, entries: DataFrame) -> DataFrame:
    kept = joins.filter_reliable(found, entries)
    return ordered.rerank(kept.withColumn("__r", F.col("rank")).drop("rank"), ["event_id"], ["__r"]).drop("__r")


def verdicts(answers: DataFrame, sent: DataFrame, subjects: DataFrame | None = None, least: int = 2) -> DataFrame:
    """Ranked model answers to one folded verdict for each event.

    sent: (event_id, pass, rank, domain), with title, entry_title and source where the originating
    article is to be left out.  subjects: (event_id, gate3_status, answered); those that have a
    page, or fewer than ``least`` results of the first pass that aren't the article, get no pass."""
    if {"title", "entry_title", "source"} <= set(sent.columns):
        sent = records.drop_original(sent)
        kept = sent.select("event_id", "pass", "rank").distinct()
        answers = answers.join(kept, ["event_id", "pass", "rank"], "left_semi")
    domains = rollups.confirmed_domains(joins.verdict_domains(answers, sent.select("event_id", "pass", "rank", "domain")))
    if subjects is None:
        return rollups.fold_verdict(domains)
    counts = sent.where(F.col("pass") == 1).groupBy("event_id").agg(F.count("*").alias("n_results"))
    gated = rollups.evidence_gate(subjects.join(counts, "event_id", "left").withColumn("n_results", F.coalesce("n_results", F.lit(0))), least)
    return rollups.fold_verdict(gated.join(domains, "event_id", "left"), F.col("answered"), F.col("short_circuit"))


def daily_digest(trials: DataFrame, runs: DataFrame, now: Column, hours: int = 24) -> DataFrame:
    """People of each verdict over the runs that finished in the window."""
    recent = rollups.in_window(runs, now, "finished_at", hours)
    placed = joins.attribute_run(trials, runs).join(recent.select("run_id"), "run_id", "left_semi")
    return rollups.person_rollup(placed)


def digest(trials: DataFrame, summaries: DataFrame, manifests: DataFrame, events: DataFrame, coverage_: DataFrame, now: Column, hours: int = 24) -> tuple[DataFrame, DataFrame]:
    """(head, people): the document of the runs whose summary falls in the window.

    trials: (event_id, gate4b_status, subject_name, trial_at, seq, source_article_title, domains, results_sent);
    summaries: (run_id, generated_at, ...); manifests: (run_id, started_at, finished_at); events: (event_id, seq,
    rss_entry_url, rss_published_at_utc); coverage_: (event_id, seq, urls).  A trial belongs to the run that holds
    it, looked for among all manifests, and counts if that run is in the window.  ``people`` has a row for each
    person of either positive verdict, with nested events; ``head`` has window, runs and counts in one row."""
    recent = rollups.in_window(summaries, now, "generated_at", hours)
    wanted = trials.where(F.col("gate4b_status").isin("LIKELY_NOTABLE", "POSSIBLY_NOTABLE") & (F.coalesce(F.col("event_id").cast("string"), F.lit("")) != ""))
    placed = joins.attribute_run(wanted, manifests.where("finished_at IS NOT NULL"), key="seq", at="trial_at").join(recent.select("run_id").distinct(), "run_id", "left_semi")
    rows = joins.enrich_verdicts(placed, events, coverage_)
    none = F.array().cast("array<string>")
    full = lambda a: F.filter(F.coalesce(a, none), lambda u: F.coalesce(u, F.lit("")) != "")
    found = F.when(F.size(full(F.col("urls"))) > 0, full(F.col("urls"))).otherwise(full(F.col("results_sent")))
    rows = rows.withColumn("urls", F.array_distinct(records.without(found, F.col("rss_entry_url"))))
    hosts = F.array_compact(F.transform("urls", lambda u: urls.resolve_domain(F.lit(None).cast("string"), u)))
    rows = rows.withColumn("domains", F.array_distinct(F.when(F.size(full(F.col("domains"))) > 0, full(F.col("domains"))).otherwise(hosts)))
    people = shared.kept(rollups.digest_people(rows), "people")
    runs = records.runs_in_window(recent.select("run_id", "generated_at"), manifests.select("run_id", "started_at", "finished_at"))
    listed = runs.agg(F.array_sort(F.collect_list(F.struct("run_id", "generated_at", "started_at", "finished_at"))).alias("runs"))  # the runs of a day or so
    window = F.struct(F.lit(hours).alias("hours"), (now - F.make_dt_interval(F.lit(0), F.lit(hours))).alias("start"), now.alias("end"))
    head = listed.crossJoin(records.digest_counts(people, recent)).select(window.alias("window"), "runs", F.struct("runs_in_window", "likely_people", "possibly_people", "likely_events", "possibly_events").alias("counts"))  # one row each
    return head, people


def run_report(rows: DataFrame, path: str) -> DataFrame:
    """The summary of a history as a document, and its report lines.

    rows: as for ``records.run_summary``.  The document has counts in its head and a section for each positive
    verdict; lines have a section of each, which says None where it is empty."""
    summary = shared.kept(records.run_summary(rows), "run-summary")
    verdicts_ = ("LIKELY_NOTABLE", "POSSIBLY_NOTABLE")
    head = summary.agg(*(F.count_if(F.col("gate4b_status") == v).alias(f"{v.lower()}_count") for v in verdicts_))
    writers.write_digest(head, {v.lower(): summary.where(F.col("gate4b_status") == v) for v in verdicts_}, ["subject_name"], path)
    empty = summary.sparkSession.createDataFrame([(v,) for v in verdicts_], "section string").join(summary.select(F.col("gate4b_status").alias("section")).distinct(), "section", "left_anti")
    lines = summary.select(F.col("gate4b_status").alias("section"), "subject_name", F.col("source_article").alias("title"), F.col("source_urls").alias("urls"))
    return writers.report_lines(lines.unionByName(empty, allowMissingColumns=True))


def match_worklist(candidate_records: DataFrame, trials: DataFrame, retry: bool = False, pattern: str | None = None) -> DataFrame:
    """Open candidate records by priority and date, with the candidates a model is shown; the reason where none is asked.

    candidate_records: ``candidate_sets`` with ``seq``; trials: (event_id, seq, ok).  Of a record's candidates all of
    positive score are shown, and the first of the others where these are fewer than two; disambiguation pages stay
    in.  Records without candidates are settled as missing and are not asked."""
    rows = joins.retry_candidates(candidate_records, trials) if retry else joins.unprocessed(candidate_records, trials)
    if pattern:
        rows = rows.where(F.rlike(F.coalesce("subject_name", F.lit("")), F.lit(f"(?i){pattern}")))
    positive = F.filter("candidates", lambda c: F.coalesce(c["biography_score"], F.lit(0)) > 0)
    first_other = F.slice(F.filter("candidates", lambda c: F.coalesce(c["biography_score"], F.lit(0)) <= 0), 1, 1)
    shown = F.when(F.size(positive) < 2, F.array_sort(F.concat(positive, first_other))).otherwise(positive)
    rows = rows.withColumn("shown", shown).withColumn("settled", F.when(F.size("candidates") == 0, "MISSING"))
    return ordered.numbered(rows, ordered.priority_order(), "position")


def payloads(rows: DataFrame, header: str, line: Column, order: str, within: str) -> DataFrame:
    """One prompt body for each subject: a header and its numbered lines."""
    listed = F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), line.alias("t")))), lambda x: F.concat(x["o"].cast("string"), F.lit(". "), x["t"]))
    return rows.groupBy(within).agg(F.concat(F.lit(header + "\n"), F.array_join(listed, "\n")).alias("payload"))


def match_results(raw: DataFrame) -> DataFrame:
    """Raw model output to status and validation; no candidates means MISSING with confidence 1."""
    out = raw.withColumn("r", responses.salvage_json(F.col("raw_output")))
    none = F.coalesce(F.col("n_candidates"), F.lit(0)) == 0
    out = out.withColumn("gate3_status", F.when(none, "MISSING").otherwise(responses.match_status(F.col("r.ok"), F.col("r.value"))))
    confidence = F.get_json_object("r.value", "$.confidence").try_cast("double")
    out = out.withColumn("confidence", F.when(none, 1.0).otherwise(confidence))
    checks = {"status": F.col("gate3_status").isin("HAS_PAGE", "MISSING", "UNCERTAIN"), "confidence": F.col("confidence").between(0, 1)}
    return out.withColumn("violations", responses.violations(checks)).drop("r")
