"""Look-ups, anti and semi joins, and joins by domain, interval and similar name.

Dimension tables (known names, feeds, runs, domain lists) belong to the user, so their size is
not known here: no join is forced to broadcast, the planner and adaptive execution choose by
measured size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions.names import last_name, normalize_name
from newsloom.functions.text import bind
from newsloom.operators.ordered import last_wins


def flag_known(events: DataFrame, known: DataFrame) -> DataFrame:
    """A known name overrides any decision and adds its reason; known: (normalized_name); events: ``classify_event``.

    Rows without a name, mostly the larger part, get keys that no name can have, many of them, so that a
    join by shuffle does not gather them in one task."""
    nobody = F.concat(F.lit("\n"), F.pmod(F.xxhash64("entry_title", "summary"), F.lit(1 << 16)).cast("string"))
    name = F.when(F.col("candidate_name").isNotNull(), bind(F.col("candidate_name"), normalize_name)).otherwise(nobody)
    hits = known.select(F.col("normalized_name").alias("__k")).where("__k <> ''").distinct().withColumn("__hit", F.lit(True))
    out = events.withColumn("__name", name).join(hits, F.col("__name") == F.col("__k"), "left")
    hit = F.coalesce("__hit", F.lit(False))
    out = out.withColumn("prefilter_decision", F.when(hit, "PREFILTER_SKIP_HAS_WIKI_PAGE").otherwise(F.col("prefilter_decision")))
    out = out.withColumn("prefilter_reason_codes", F.when(hit, F.concat("prefilter_reason_codes", F.array(F.lit("KNOWN_WIKI_PAGE")))).otherwise(F.col("prefilter_reason_codes")))
    return out.withColumn("prefilter_signals", F.col("prefilter_signals").withField("known_wiki_page_match", hit)).drop("__name", "__k", "__hit")


def with_priority(events: DataFrame, feeds: DataFrame) -> DataFrame:
    """feeds: one (url, priority) for each feed."""
    return events.drop("feed_priority").join(feeds.select(F.col("url").alias("__u"), F.col("priority").alias("feed_priority")), F.col("source_feed_url_original") == F.col("__u"), "left").drop("__u")


def backfill_priority(events: DataFrame, feeds: DataFrame, lacks: str = "lacks_priority") -> DataFrame:
    """Only rows that lack the field; a null that is there stays null."""
    side = feeds.select(F.col("url").alias("__u"), F.col("priority").alias("__p"))
    out = events.join(side, F.col("source_feed_url_original") == F.col("__u"), "left")
    return out.withColumn("feed_priority", F.when(F.col(lacks), F.col("__p")).otherwise(F.col("feed_priority"))).drop("__u", "__p")


def new_only(entries: DataFrame, seen: DataFrame, key: str = "url_key") -> DataFrame:
    return entries.join(seen.select(key).distinct(), key, "left_anti")


def unprocessed(events: DataFrame, trials: DataFrame) -> DataFrame:
    """Events without any successful trial; trials: (event_id, ok)."""
    return events.join(trials.where("ok").select("event_id").distinct(), "event_id", "left_anti")


def retry_candidates(events: DataFrame, trials: DataFrame) -> DataFrame:
    """Events whose latest trial failed; trials: (event_id, seq, ok)."""
    latest = trials.groupBy("event_id").agg(F.max_by("ok", "seq").alias("ok"))
    return events.join(latest.where("NOT ok").select("event_id"), "event_id", "left_semi")


def search_lookup(variants: DataFrame, results: DataFrame, cap: int = 10) -> DataFrame:
    """variants (event_id, variant_no, variant) to results (query, rank, ...) up to a rank."""
    return variants.join(results.where(F.col("rank") <= cap), variants["variant"] == results["query"])


def attach_pages(found: DataFrame, pages: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """Pages by title, or by the target of a redirect; results without a page stay."""
    out = found
    if redirects is not None:
        moved = redirects.select(F.col("from").alias("title"), F.col("to").alias("__to"))
        out = out.join(moved, "title", "left").withColumn("redirected_from", F.when(F.col("__to").isNotNull(), F.col("title"))).withColumn("title", F.coalesce("__to", "title")).drop("__to")
    return out.join(pages, "title", "left")


def filter_reliable(results: DataFrame, entries: DataFrame, url: str = "url", domain: str = "source_domain") -> DataFrame:
    """Results whose host or a domain above it is listed, or whose URL starts with a listed prefix.

    One pass over the results: a look-up of the last n labels of the host for each number of labels that
    listed hosts have (a few), and one of the host for the prefixes, which are gathered by host.  Every
    listed host is one row of one look-up, so no row is multiplied and none has to be found again."""
    host = F.regexp_replace(F.lower(F.trim("entry")), r"^\.+|\.+$", "")
    plain = entries.where("kind = 'host'").select(host.alias("__e")).where("__e <> ''").distinct().withColumn("__labels", F.size(F.split("__e", r"\.")))
    listed = F.lit(False)
    out = results
    for n in sorted(r[0] for r in plain.select("__labels").distinct().collect()):  # at most the labels of a host name
        side = plain.where(F.col("__labels") == n).select(F.col("__e").alias(f"__e{n}"))
        out = out.join(side, F.substring_index(F.col(domain), ".", -n) == F.col(f"__e{n}"), "left")
        listed = listed | F.col(f"__e{n}").isNotNull()
    bare = F.regexp_replace(F.lower(F.col(url)), "^https?://", "")
    prefixes = entries.where("kind <> 'host'").select(F.lower(F.regexp_replace("entry", "^https?://", "")).alias("p"), (F.col("kind") == "url_prefix").alias("full")).distinct()
    prefixes = prefixes.groupBy(F.regexp_replace(F.substring_index("p", "/", 1), r"^www\.", "").alias("__h")).agg(F.collect_set(F.struct("p", "full")).alias("__ps"))
    out = out.withColumn("__b", bare).join(prefixes, F.regexp_replace(F.substring_index("__b", "/", 1), r"^www\.", "") == F.col("__h"), "left")
    starts = F.exists("__ps", lambda x: F.startswith("__b", x["p"]) | (~x["full"] & F.startswith(F.regexp_replace("__b", r"^www\.", ""), x["p"])))
    return out.where(listed | F.coalesce(starts, F.lit(False))).select(results.columns)


def second_pass_input(events: DataFrame, coverage: DataFrame) -> DataFrame:
    """Events with the last row of their full result set; coverage: (event_id, seq, ...)."""
    return events.join(last_wins(coverage, "event_id", ["seq"]).drop("seq"), "event_id", "left")


def verdict_domains(verdicts: DataFrame, sent: DataFrame) -> DataFrame:
    """Verdicts with the domain of the result they rank, else their own."""
    side = sent.select("event_id", "pass", "rank", F.col("domain").alias("__d"))
    return verdicts.join(side, ["event_id", "pass", "rank"], "left").withColumn("domain", F.coalesce(F.nullif("__d", F.lit("")), F.nullif("domain", F.lit("")))).drop("__d")


def match_batch(sent: DataFrame, answers: DataFrame) -> DataFrame:
    """Batch inputs with their outputs; those without one carry an error."""
    out = sent.join(answers.withColumn("__there", F.lit(True)), "event_id", "left")
    return out.withColumn("json_parse_error", F.when(F.col("__there").isNull(), F.lit("event_id_missing_in_batch_output"))).drop("__there")


def exact_matches(candidates: DataFrame) -> DataFrame:
    """Candidates whose title, or the title they were redirected from, is the subject's name."""
    subject = normalize_name(F.col("subject_name"))
    by_title, by_redirect = normalize_name(F.col("title")) == subject, normalize_name(F.col("redirected_from")) == subject
    return candidates.where((subject != "") & (by_title | by_redirect)).withColumn("match_type", F.when(by_title, "title").otherwise("redirect"))


def similar_names(names: DataFrame, key: str, name: str, within: list[str], max_distance: int = 2) -> DataFrame:
    """(key) with another row of the same last name within the distance; blocked by last name.

    Two names within the distance have a form in common that each reaches by leaving out as many
    characters at most.  Distinct names meet on such forms alone, so a last name that many rows
    share makes no pairs of rows."""
    left = names.select(key, *within, normalize_name(F.col(name)).alias("__n")).withColumn("__l", last_name(F.col("__n")))
    by = [*within, "__l"]
    one = left.groupBy(*by, "__n").agg(F.countDistinct(key).alias("__keys"))
    shorter = lambda x: F.transform(F.sequence(F.lit(1), F.length(x)), lambda i: F.concat(F.substring(x, F.lit(1), i - 1), F.substring(x, i + 1, F.length(x))))
    forms = F.array(F.col("__n"))
    for _ in range(max_distance):
        forms = F.array_distinct(F.concat(forms, F.flatten(F.transform(F.filter(forms, lambda x: F.length(x) > 0), shorter))))
    met = one.select(*by, "__n", F.explode(forms).alias("__form"))
    other = met.withColumnRenamed("__n", "__m")
    near = met.join(other, [*by, "__form"]).where((F.col("__n") != F.col("__m")) & F.levenshtein("__n", "__m", max_distance).between(0, max_distance)).select(*by, "__n")
    found = near.unionByName(one.where("__keys > 1").select(*by, "__n")).distinct()
    return left.join(found, [*by, "__n"], "left_semi").select(key).distinct()


def attribute_run(trials: DataFrame, runs: DataFrame, tolerance_s: int = 900, key: str = "trial_id", at: str = "trial_at") -> DataFrame:
    """The latest-finished run that holds the trial, else the nearest finish within the tolerance.

    Runs are found by the hours they span, an equi join, so the plan stays linear in trials."""
    pad = tolerance_s
    hours = F.sequence(F.floor((F.unix_timestamp("started_at") - pad) / 3600), F.floor((F.unix_timestamp("finished_at") + pad) / 3600))
    spread = runs.withColumn("__h", F.explode(hours))
    met = trials.withColumn("__h", F.floor(F.unix_timestamp(at) / 3600)).join(spread, "__h")
    inside = F.col(at).between(F.col("started_at"), F.col("finished_at"))
    delta = F.abs(F.unix_micros(F.col(at).cast("timestamp")) - F.unix_micros(F.col("finished_at").cast("timestamp")))
    ranked = met.withColumn("__in", inside).withColumn("__d", delta).where(F.col("__in") | (F.col("__d") <= tolerance_s * 1_000_000))
    last = F.max(F.when(F.col("__in"), F.struct("finished_at", "run_id")))["run_id"]
    near = F.min(F.struct("__d", "run_id"))["run_id"]
    found = ranked.groupBy(key).agg(F.coalesce(last, near).alias("run_id"))
    return trials.join(found, key, "left")


def enrich_verdicts(verdicts: DataFrame, events: DataFrame, coverage: DataFrame) -> DataFrame:
    """Verdicts with the last row of their event and of their coverage."""
    return verdicts.join(last_wins(events, "event_id", ["seq"]).drop("seq"), "event_id", "left").join(last_wins(coverage, "event_id", ["seq"]).drop("seq"), "event_id", "left")
