"""Counts, verdict folds, roll-ups by person, and upserts of keyed state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.operators.ordered import last_wins


def code_counts(rows: DataFrame, codes: Column) -> DataFrame:
    """Rows of each code in an array column."""
    return rows.select(F.explode(codes).alias("code")).groupBy("code").agg(F.count("*").alias("n"))


def pass_rates(rows: DataFrame, passes: Column) -> DataFrame:
    n, p = F.count("*"), F.count_if(passes)
    return rows.agg(n.alias("n"), p.alias("n_pass"), (n - p).alias("n_skip"), F.try_divide(p, n).alias("pass_rate"), F.try_divide(n - p, n).alias("skip_rate"))


def first_seen(value: Column, order: Column) -> Column:
    """Distinct values of a group in the order of their first row."""
    pairs = F.array_sort(F.collect_list(F.when(value.isNotNull() & (value != ""), F.struct(order.alias("o"), value.alias("v")))))
    return F.array_distinct(F.transform(pairs, lambda p: p["v"]))


def confirmed_domains(verdicts: DataFrame, about: str = "about_subject", reliable: str = "reliable") -> DataFrame:
    """(event_id, first_pass_domains, second_pass_domains): domains of confirmed results by rank.

    A result of the second pass, which looks beyond the listed sources, has to be judged reliable too."""
    yes = F.coalesce(F.col(about), F.lit(False))
    sure = yes & F.coalesce(F.col(reliable), F.lit(False))
    return verdicts.groupBy("event_id").agg(
        first_seen(F.when(yes & (F.col("pass") == 1), F.col("domain")), F.col("rank")).alias("first_pass_domains"),
        first_seen(F.when(sure & (F.col("pass") == 2), F.col("domain")), F.col("rank")).alias("second_pass_domains"),
    )


def fold_verdict(domains: DataFrame, answered: Column | None = None, short_circuit: Column | None = None) -> DataFrame:
    """Two domains in the first pass are likely, two over both passes possibly notable.

    ``answered`` is false where the first pass failed or didn't parse: nothing is known of it, so
    without enough domains of the second pass the subject stays uncertain.  Subjects with a
    ``short_circuit`` had no pass at all."""
    none = F.array().cast("array<string>")
    answered = F.lit(True) if answered is None else F.coalesce(answered, F.lit(False))
    skipped = F.lit(None).cast("string") if short_circuit is None else short_circuit
    first = F.when(answered & skipped.isNull(), F.coalesce("first_pass_domains", none)).otherwise(none)
    second = F.when(skipped.isNull() & (F.size(first) < 2), F.coalesce("second_pass_domains", none)).otherwise(none)
    both = F.array_union(first, second)
    n = F.size(first)
    status = F.when(skipped == "HAS_PAGE", "SKIPPED_HAS_PAGE").when(skipped.isNotNull(), "SKIPPED").when(n >= 2, "LIKELY_NOTABLE").when(F.size(both) >= 2, "POSSIBLY_NOTABLE")
    status = status.when(~answered | (n == 1), "UNCERTAIN").otherwise("NOT_NOTABLE")
    return domains.withColumn("gate4b_status", status).withColumn("confirmed_count", n).withColumn("all_domains", both).withColumn("reliable_domain_count", F.size(both))


def evidence_gate(rows: DataFrame, least: int = 2) -> DataFrame:
    """HAS_PAGE and too few results need no verdict."""
    return rows.withColumn("short_circuit", F.when(F.col("gate3_status") == "HAS_PAGE", "HAS_PAGE").when(F.col("n_results") < least, "SKIPPED_INSUFFICIENT_RESULTS"))


def best_per_subject(rows: DataFrame) -> DataFrame:
    """The record with the most confirmed sources; the earliest wins ties."""
    best = F.max_by(F.struct(*rows.columns), F.struct("confirmed_count", -F.col("seq")))
    return rows.groupBy("subject_name").agg(best.alias("r")).select("r.*")


def person_rollup(rows: DataFrame) -> DataFrame:
    """By folded name: runs, the latest event of each id, and all URLs and domains ever seen, in the order of their first row.

    rows: (subject_name, run_id, event_id, trial_at, seq, urls, domains).  URLs and domains are made
    distinct before they are gathered, so a person's list holds what differs and not every row."""
    key = F.replace(F.lower(F.trim("subject_name")), F.lit("ß"), F.lit("ss"))
    rows = rows.withColumn("person", key).where("person <> ''")
    order = F.struct("trial_at", "seq", F.col("place"))

    def seen(column: str, name: str) -> DataFrame:
        each = rows.select("person", "trial_at", "seq", F.posexplode(column).alias("place", "value")).groupBy("person", "value").agg(F.min(order).alias("first"))
        listed = F.transform(F.array_sort(F.collect_list(F.struct("first", "value"))), lambda x: x["value"])
        return each.groupBy("person").agg(listed.alias(name))

    none = F.array().cast("array<string>")
    people = rows.groupBy("person").agg(F.min_by("subject_name", F.struct("trial_at", "seq")).alias("subject_name"), F.array_sort(F.collect_set("run_id")).alias("run_ids"), F.countDistinct("event_id").alias("event_count"))
    people = people.join(seen("urls", "all_urls"), "person", "left").join(seen("domains", "all_domains"), "person", "left")
    people = people.withColumn("all_urls", F.coalesce("all_urls", none)).withColumn("all_domains", F.coalesce("all_domains", none))
    events = rows.groupBy("person", "event_id").agg(F.max_by(F.struct("event_id", "run_id", "trial_at", "urls"), F.struct("trial_at", "seq")).alias("e"))
    events = events.groupBy("person").agg(F.array_sort(F.collect_list(F.struct(F.col("e.trial_at"), F.col("e.event_id"), F.col("e.run_id"), F.col("e.urls")))).alias("events"))
    return people.join(events, "person")


def digest_people(rows: DataFrame) -> DataFrame:
    """A person of a verdict in a row: runs, nested events, and all URLs and domains in the order they were first seen.

    rows: (gate4b_status, subject_name, run_id, event_id, trial_at, seq, rss_entry_url, rss_published_at_utc,
    source_article_title, urls, domains).  Names are folded; of an event's trials the latest counts, URLs and
    domains of superseded ones stay.  What a list gathers is made distinct before, so it holds what differs."""
    keys = ["gate4b_status", "person"]
    person = F.replace(F.lower(F.trim("subject_name")), F.lit("ß"), F.lit("ss"))
    rows = rows.withColumn("person", person).where("person <> ''")
    order = F.struct("seq", F.col("place"))

    def seen(column: str, name: str) -> DataFrame:
        each = rows.select(*keys, "seq", F.posexplode(column).alias("place", "value")).groupBy(*keys, "value").agg(F.min(order).alias("first"))
        listed = F.transform(F.array_sort(F.collect_list(F.struct("first", "value"))), lambda x: x["value"])
        return each.groupBy(*keys).agg(listed.alias(name))

    event = F.struct("trial_at", "event_id", "run_id", "rss_entry_url", "rss_published_at_utc", "source_article_title", "urls", "domains", F.size("domains").cast("long").alias("domain_count"))
    latest = rows.groupBy(*keys, "event_id").agg(F.max_by(event, F.struct("trial_at", "seq")).alias("e"), F.min("seq").alias("first"), F.min_by("subject_name", "seq").alias("name"), F.collect_set("run_id").alias("runs"))
    people = latest.groupBy(*keys).agg(
        F.trim(F.min_by("name", "first")).alias("subject_name"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("runs")))).alias("run_ids"),
        F.array_sort(F.collect_list("e")).alias("events"), F.count("*").alias("event_count"),
    )
    none = F.array().cast("array<string>")
    for column, name in (("urls", "all_urls"), ("domains", "all_domains")):
        people = people.join(seen(column, name), keys, "left").withColumn(name, F.coalesce(name, none))
    return people.withColumn("url_count", F.size("all_urls").cast("long")).withColumn("domain_count", F.size("all_domains").cast("long"))


def fetch_state(fetches: DataFrame, state: DataFrame | None = None, horizon: str | None = None, late: str = "0 seconds") -> DataFrame:
    """The last fetch of each feed, replacing its state; with a horizon, feeds not fetched for so long are forgotten.

    (feed_url, last_fetch_at, ...).  Time is that of the fetches, less what may come late, so reruns agree."""
    rows = fetches.withColumn("__new", F.lit(1))
    if state is not None:
        rows = rows.unionByName(state.select(fetches.columns).withColumn("__new", F.lit(0)))
    value = F.struct(*(c for c in fetches.columns if c != "feed_url"))
    out = rows.where("feed_url IS NOT NULL").groupBy("feed_url").agg(F.max_by(value, F.struct("last_fetch_at", "__new", F.xxhash64(*fetches.columns))).alias("r")).select("feed_url", "r.*").select(fetches.columns)
    if horizon is None:
        return out
    newest = out.agg(F.max("last_fetch_at").alias("__now"))
    return out.crossJoin(newest).where(F.col("last_fetch_at") + F.expr(f"INTERVAL {horizon}") > F.col("__now") - F.expr(f"INTERVAL {late}")).drop("__now")  # one row


def in_window(rows: DataFrame, now: Column, at: str, hours: int = 24) -> DataFrame:
    return rows.where(F.col(at).between(now - F.make_dt_interval(F.lit(0), F.lit(hours)), now))


def error_samples(rows: DataFrame, error: str, n: int = 300) -> DataFrame:
    short = F.substring(error, 1, n)
    return rows.where(F.coalesce(F.col(error), F.lit("")) != "").groupBy(short.alias("error")).agg(F.count("*").alias("n"))


def filter_totals(sets: DataFrame, kept: str = "result_count", before: str = "unfiltered_count") -> DataFrame:
    """Results that a filter kept and dropped, over all sets."""
    n, m = F.coalesce(F.sum(kept), F.lit(0)), F.coalesce(F.sum(before), F.lit(0))
    return sets.agg(n.alias("kept"), (m - n).alias("dropped"))


def stage_counts(**stages: tuple[DataFrame, Column | None]) -> DataFrame:
    """(stage, rows, new_rows) of tables, each with a condition of its new rows, in one job."""
    out = None
    for name, (rows, new) in stages.items():
        one = rows.agg(F.lit(name).alias("stage"), F.count("*").alias("rows"), (F.count_if(new) if new is not None else F.count("*")).alias("new_rows"))
        out = one if out is None else out.unionByName(one)
    return out


def latest_run(runs: DataFrame) -> DataFrame:
    """(run_id, at) of the run generated, or else finished, last; the larger id wins ties."""
    at = [F.col(c) for c in ("generated_at", "finished_at") if c in runs.columns]
    last = F.max(F.struct(F.coalesce(*at).alias("at"), "run_id"))
    return runs.where(F.coalesce(*at).isNotNull()).agg(last.alias("r")).where("r IS NOT NULL").select("r.run_id", "r.at")


def run_durations(runs: DataFrame) -> DataFrame:
    """(run_id, seconds): the sum over a run's stages, 0 without any."""
    seconds = F.aggregate(F.coalesce("stages", F.array().cast(runs.schema["stages"].dataType)), F.lit(0.0), lambda t, x: t + F.coalesce(x["duration_s"], F.lit(0.0)))
    return runs.select("run_id", seconds.alias("seconds"))


def retry_resolution(before: DataFrame, after: DataFrame) -> DataFrame:
    """Of the events whose latest trial had failed, how many succeed in their latest trial now."""
    failed = before.groupBy("event_id").agg(F.max_by("ok", "seq").alias("ok")).where("NOT ok").select("event_id")
    latest = after.groupBy("event_id").agg(F.max_by("ok", "seq").alias("ok"))
    return failed.join(latest, "event_id", "left").agg(F.count("*").alias("n_failed"), F.count_if("ok").alias("n_resolved"))


def upsert_first(state: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Insert only: keys that are there stay as they are."""
    return state.unionByName(new.join(state.select(key), key, "left_anti"), allowMissingColumns=True)


def upsert_last(state: DataFrame, new: DataFrame, key: str, seq: str = "seq") -> DataFrame:
    return last_wins(state.unionByName(new, allowMissingColumns=True), key, [seq])


def upsert_known(state: DataFrame, new: DataFrame) -> DataFrame:
    """Known names: the last row of a key replaces all but the first time it was added.

    (normalized_name, pageid, title, added_at_utc, source_stage, seq)"""
    rows = state.unionByName(new, allowMissingColumns=True).where("normalized_name <> ''")
    value = F.struct(*(c for c in rows.columns if c not in ("normalized_name", "added_at_utc")))
    found = rows.groupBy("normalized_name").agg(F.max_by(value, "seq").alias("r"), F.min_by("added_at_utc", "seq").alias("added_at_utc"))
    return found.select("normalized_name", "r.*", "added_at_utc")


def alias_rows(matches: DataFrame, name: Column, alias: Column) -> DataFrame:
    """A canonical row and an alias row for each match; the alias comes second."""
    both = F.array(F.struct(name.alias("normalized_name"), F.lit(0).alias("o")), F.struct(alias.alias("normalized_name"), F.lit(1).alias("o")))
    rows = matches.withColumn("__x", F.explode(both)).withColumn("normalized_name", F.col("__x.normalized_name")).withColumn("seq", 2 * F.col("seq") + F.col("__x.o"))
    return rows.where("normalized_name IS NOT NULL AND normalized_name <> ''").drop("__x")
