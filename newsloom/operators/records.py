"""Records between stages: field probing, source context, trial rows, run summaries and their counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions import names, text
from newsloom.operators import rollups

#: Where a generic match row may hold a field, first choice first.
STATUS_FIELDS = ("gate2_status", "gate2_decision", "status")
MATCH_FIELDS = ("matched_page", "match", "matched")
TITLE_FIELDS = ("title", "matched_title", "page_title")
SUBJECT_FIELDS = ("subject_name_full", "subject_name_as_written", "subject_name")
HAS_PAGE = ("HAS_PAGE", "MATCH")

#: One shape for rows of a model and for rows that needed none.
TRIAL_FIELDS = {
    "event_id": "string", "subject_name": "string", "model": "string", "backend": "string", "trial_at_utc": "string", "duration_ms": "bigint",
    "llm_error": "string", "json_parse_ok": "boolean", "json_parse_error": "string", "status": "string", "raw_output": "string",
}


def text_at(json: Column, path: str) -> Column:
    """The string at a path of a JSON column; null for any other kind of value."""
    parsed = F.try_parse_json(json)
    return F.when(F.schema_of_variant(F.try_variant_get(parsed, path, "variant")) == "STRING", F.try_variant_get(parsed, path, "string"))


def probe(json: Column, fields: Sequence[str], inside: Sequence[str] = ("$", "$.parsed_output")) -> Column:
    """The first string among the fields at the top level, then among those of the parsed output."""
    return F.coalesce(*(text_at(json, f"{at}.{f}") for at in inside for f in fields))


def generic_matches(rows: DataFrame, json: str = "record") -> DataFrame:
    """status, normalized_name, title, pageid and fullurl of has-page rows in any generation's layout."""
    row = F.col(json)
    parsed = F.try_parse_json(row)
    kind = lambda path: F.schema_of_variant(F.try_variant_get(parsed, path, "variant"))
    places = [f"{at}.{f}" for at in ("$", "$.parsed_output") for f in MATCH_FIELDS]
    match = F.coalesce(*(F.when(F.startswith(kind(p), F.lit("OBJECT")), F.try_variant_get(parsed, p, "string")) for p in places))
    out = rows.withColumn("status", probe(row, STATUS_FIELDS)).where(F.col("status").isin(*HAS_PAGE)).withColumn("__match", match)
    inner = F.col("__match")
    title = F.coalesce(*(text_at(row, f"$.{f}") for f in TITLE_FIELDS), *(text_at(inner, f"$.{f}") for f in TITLE_FIELDS))
    digits = F.try_variant_get(F.try_parse_json(inner), "$.pageid", "string")
    out = out.withColumn("title", title).withColumn("pageid", F.when(F.rlike(digits, F.lit("^[0-9]+$")), digits).try_cast("bigint")).withColumn("fullurl", text_at(inner, "$.fullurl"))
    out = out.withColumn("normalized_name", names.normalize_name(F.coalesce(F.nullif(probe(row, SUBJECT_FIELDS), F.lit("")), F.col("title"))))
    return out.where("normalized_name <> ''").drop("__match")


def source_context(rows: DataFrame) -> DataFrame:
    """``source_context`` of rows of any generation: as it is, else from the fields that older rows carry."""
    have = lambda *cs: F.coalesce(*(F.nullif(F.col(c), F.lit("")) for c in cs if c in rows.columns), F.lit(None).cast("string"))
    own = F.struct(
        have("entry_title").alias("entry_title"), have("summary").alias("summary"),
        have("source_feed_title", "source").alias("source"), have("published_at_utc", "publication_date").alias("publication_date"),
    )
    return rows.withColumn("source_context", F.coalesce("source_context", own) if "source_context" in rows.columns else own)


def trial_rows(*parts: DataFrame) -> DataFrame:
    """Rows of models and deterministic rows in one shape; what a part lacks is null, or fine and instant where no model ran."""
    out = None
    for part in parts:
        default = {"json_parse_ok": F.lit(True), "duration_ms": F.lit(0), "raw_output": F.lit("")} if "model" not in part.columns else {}
        row = part.select(*((F.col(c) if c in part.columns else default.get(c, F.lit(None))).cast(t).alias(c) for c, t in TRIAL_FIELDS.items()))
        out = row if out is None else out.unionByName(row)
    return out


def nested(rows: DataFrame, within: Sequence[str], order: Sequence[str], fields: Sequence[str], name: str) -> DataFrame:
    """(within, name): the rows of each group as an array of structs, in order.  Groups are as large as one record may be."""
    listed = F.array_sort(F.collect_list(F.struct(*(F.col(c).alias(f"o{i}") for i, c in enumerate(order)), F.struct(*fields).alias("item"))))
    return rows.groupBy(*within).agg(F.transform(listed, lambda x: x["item"]).alias(name))


def with_nested(records: DataFrame, sets: DataFrame, key: str, name: str) -> DataFrame:
    """``records`` with their set; an empty one where there are no rows."""
    kind = sets.schema[name].dataType
    return records.join(sets, key, "left").withColumn(name, F.coalesce(F.col(name), F.array().cast(kind)))


#: Fields of a candidate and of a coverage result inside their records.
CANDIDATE_FIELDS = ("rank", "title", "pageid", "fullurl", "snippet", "is_disambig", "redirected_from", "description", "extract", "categories", "biography_score", "biography_prioritized")
RESULT_FIELDS = ("rank", "title", "url", "source_domain")


def candidate_fields(found: DataFrame) -> DataFrame:
    """Ranked search items with their page, if there is one, as the fields of a candidate.

    found: (event_id, rank, item_title, snippet, redirected_from) and page columns (title, pageid, fullurl,
    is_disambig, description, extract, categories), null without a page.  Items without a title go; their rank stays taken."""
    none = F.array().cast("array<string>")
    score = text.biography_score(F.coalesce("categories", none))
    rows = found.where(F.coalesce("item_title", F.lit("")) != "")
    return rows.select(
        "event_id", "rank", F.coalesce("title", "item_title").alias("title"), "pageid", "fullurl", "snippet", F.coalesce("is_disambig", F.lit(False)).alias("is_disambig"), "redirected_from",
        "description", "extract", F.coalesce("categories", none).alias("categories"), score.alias("biography_score"), (score >= 3).alias("biography_prioritized"),
    )


def select_uncovered(rows: DataFrame, statuses: Sequence[str] = ("MISSING", "UNCERTAIN"), status: str = "gate3_status") -> DataFrame:
    """Rows of the wanted match statuses that have a subject."""
    return rows.where(F.col(status).isin(*statuses) & (F.coalesce(F.col("subject_name"), F.lit("")) != ""))


def drop_original(results: DataFrame) -> DataFrame:
    """Results that aren't the originating article, with ``excluded_count`` of their event.

    results: (event_id, title, domain, entry_title, source)."""
    original = text.is_original_source(F.col("title"), F.col("domain"), F.col("entry_title"), F.col("source"))
    marked = results.withColumn("__original", original)
    excluded = marked.groupBy("event_id").agg(F.count_if("__original").alias("excluded_count"))
    return marked.where("NOT __original").drop("__original").join(excluded, "event_id")


def runs_in_window(summaries: DataFrame, manifests: DataFrame) -> DataFrame:
    """Run summaries with what their manifest knows, if there is one."""
    return summaries.join(manifests, "run_id", "left")


def recency_order(seq: str = "seq") -> list[Column]:
    """Newest first, rows without a date last, then input order."""
    return [F.coalesce("published_at_utc", F.lit("")).desc(), F.col(seq).asc()]


def without(values: Column, value: Column) -> Column:
    """The list without one value; all of it where the value is null or empty."""
    return F.when(F.coalesce(value, F.lit("")) == "", values).otherwise(F.filter(values, lambda v: v != value))


def run_entries(rows: DataFrame) -> DataFrame:
    """One summary entry for each row: URLs that aren't empty, and the second pass's count for the weaker verdict."""
    urls = F.filter("source_urls", lambda u: F.coalesce(u, F.lit("")) != "")
    weaker = F.when(F.col("gate4b_status") == "POSSIBLY_NOTABLE", F.coalesce("second_pass_confirmed_count", F.lit(0)))
    return rows.select("subject_name", "gate4b_status", F.coalesce("confirmed_count", F.lit(0)).alias("confirmed_count"), "source_article", urls.alias("source_urls"), weaker.alias("second_pass_confirmed_count"))


def run_summary(rows: DataFrame) -> DataFrame:
    """Entries of the two positive verdicts over the whole history, the best record of each exact name.

    rows: (subject_name, gate4b_status, confirmed_count, source_article, source_urls, second_pass_confirmed_count, seq)."""
    parts = [rollups.best_per_subject(rows.where(F.col("gate4b_status") == status)) for status in ("LIKELY_NOTABLE", "POSSIBLY_NOTABLE")]
    return run_entries(parts[0].unionByName(parts[1]))


def verdict_names(rows: DataFrame) -> DataFrame:
    """Names of each positive verdict in input order, repeats included."""
    listed = F.transform(F.array_sort(F.collect_list(F.struct("seq", "subject_name"))), lambda x: x["subject_name"])
    return rows.where(F.col("gate4b_status").isin("LIKELY_NOTABLE", "POSSIBLY_NOTABLE")).groupBy("gate4b_status").agg(listed.alias("names"))


def ingest_stats(entries: DataFrame, feeds: DataFrame) -> DataFrame:
    """Nine counters of an ingest run.

    feeds: (feed, ok, not_modified); entries: (valid, is_new, date_parse_error)."""
    succeeded = feeds.agg(F.count("*").alias("feeds_total"), F.count_if("ok").alias("feeds_succeeded"), F.count_if(~F.col("ok")).alias("feeds_failed"), F.count_if(F.col("ok") & F.col("not_modified")).alias("feeds_not_modified"))
    valid = F.col("valid")
    counted = entries.agg(
        F.count("*").alias("entries_parsed"), F.count_if(~valid).alias("entries_invalid"), F.count_if(valid & F.col("is_new")).alias("new_events_appended"),
        F.count_if(valid & ~F.col("is_new")).alias("duplicates_skipped"), F.count_if(valid & F.col("date_parse_error")).alias("date_parse_errors"),
    )
    return succeeded.crossJoin(counted)  # one row each


def signal_counts(rows: DataFrame, signal: str = "gate2_signal") -> DataFrame:
    return rows.groupBy(signal).agg(F.count("*").alias("n"))


def digest_counts(people: DataFrame, runs: DataFrame) -> DataFrame:
    """Runs, people and events of each verdict in a digest.  people: (gate4b_status, event_count)."""
    of = lambda status: F.col("gate4b_status") == status
    total = people.agg(
        F.count_if(of("LIKELY_NOTABLE")).alias("likely_people"), F.count_if(of("POSSIBLY_NOTABLE")).alias("possibly_people"),
        F.coalesce(F.sum(F.when(of("LIKELY_NOTABLE"), F.col("event_count"))), F.lit(0)).alias("likely_events"),
        F.coalesce(F.sum(F.when(of("POSSIBLY_NOTABLE"), F.col("event_count"))), F.lit(0)).alias("possibly_events"),
    )
    return runs.agg(F.count("*").alias("runs_in_window")).crossJoin(total)  # one row each


def person_urls(events: DataFrame, summary: DataFrame) -> DataFrame:
    """All URLs of a person, sorted: those of their events and those of the summary.  (person, url) rows on both sides."""
    urls = events.select("person", "url").unionByName(summary.select("person", "url")).where("url <> ''").distinct()
    return urls.groupBy("person").agg(F.array_sort(F.collect_list("url")).alias("urls"))
