"""Expressions over titles, summaries, categories, dates and prose."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.names import name_tokens, squeeze

# Patterns of names, cues and headings.
FULL_NAME = r"(?U)\b[A-Z][a-z]{1,29}\s+[A-Z][a-z]{1,39}\b"
INITIAL_SURNAME = r"(?U)\b(?:[A-Z]\.\s*[A-Z][a-z]{1,39}|[A-Z](?:\s+[A-Z])?\s+[A-Z][a-z]{1,39})\b"
OBITUARY_CUE = r"(?Ui)\b(obituary|obit|died|dies|dead|aged\s+\d{2,3}|tributes?|remembered)\b"
CAPITALISED = r"(?U)\b[A-Z][a-z]{2,39}\b"
LETTERS_HEAD = r"^Letters?:\s"
LETTERS_TAIL = r"(?Ui)\|\s*Letters?\s*$"
STRUCTURAL = r"(?Ui)(?:–|-)\s+in\s+pictures\b|\bin\s+pictures\b|\bTrivia\b"
TRIBUTE = (
    r"(?Ui)(?:^|<p>)\s*(?:My|Our)\s+(?:late\s+)?(?:husband|wife|father|mother|son|daughter|sister|brother|"
    r"twin\s+(?:brother|sister)|partner|friend|colleague|former\s+colleague|uncle|aunt|grandfather|grandmother|nephew|niece|cousin)\b"
)
#: Phrases that announce a death.
OBITUARY_SIGNALS = (" obituary", " obituaries", " dies", " died", " dead", " death", " passed away", " passes away")
#: Words that say nothing about a subject.
STOP_WORDS = ("a", "an", "and", "as", "at", "by", "for", "from", "has", "in", "is", "it", "of", "on", "the", "to", "was", "were", "with")
#: Endings of occupation categories.
OCCUPATIONS = (
    "actors", "actresses", "singers", "musicians", "composers", "writers", "poets", "journalists", "politicians", "scientists",
    "engineers", "artists", "painters", "designers", "directors", "producers", "athletes", "sportspeople", "footballers", "players",
    "coaches", "lawyers", "judges", "professors", "historians", "photographers", "dancers",
)
#: Occupations that mark a person's page, alone in parentheses in its title and as words of its description.
TITLE_OCCUPATIONS = (
    "artist", "painter", "sculptor", "visual artist", "photographer", "writer", "poet", "politician", "journalist", "actor", "actress", "musician",
    "composer", "conductor", "footballer", "cricketer", "scientist", "historian", "architect", "designer", "chef",
)
DESCRIPTION_OCCUPATIONS = tuple(o for o in TITLE_OCCUPATIONS if o not in ("visual artist", "footballer", "cricketer"))
#: Parts of categories that no biography has.
NOT_PEOPLE = (
    "lists", "events", "awards", "templates", "disambiguation", "articles", "redirects", "organizations", "companies", "municipalities",
    "geographic", "schools", "universities", "clubs",
)


#: A cheap test of the first letter before the patterns' word boundary; it changes no match.
_CAPITAL, _CUE = "(?=[A-Z])", "(?=[oOdDaAtTrR])"


def blank(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def event_text(title: Column, summary: Column) -> Column:
    return F.trim(F.concat_ws(" ", blank(title), blank(summary)))


def _found(text: Column, pattern: str) -> Column:
    """The first match, else null."""
    return F.nullif(F.regexp_extract(text, _CAPITAL + pattern, 0), F.lit(""))


def candidate_name(text: Column) -> Column:
    """The first full name, else the first initial with a surname, else null."""
    return F.coalesce(_found(text, FULL_NAME), _found(text, INITIAL_SURNAME))


def name_signals(text: Column, full: Column | None = None, initial: Column | None = None) -> Column:
    """Which patterns a text holds; ``full`` and ``initial`` are first matches that are known already."""
    full = _found(text, FULL_NAME) if full is None else full
    initial = _found(text, INITIAL_SURNAME) if initial is None else initial
    return F.struct(
        full.isNotNull().alias("full_name_match"), initial.isNotNull().alias("initial_surname_match"),
        F.rlike(text, F.lit(_CUE + OBITUARY_CUE)).alias("obit_cue_match"), F.rlike(text, F.lit(_CAPITAL + CAPITALISED)).alias("obit_guardrail_token_match"),
        F.lit(False).alias("known_wiki_page_match"),
    )


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` refers to it."""
    return F.get(F.transform(F.array(value), use), 0)


def _reason(heading: Column, s: Column) -> Column:
    return (
        F.when(heading.isNotNull(), heading).when(s["full_name_match"], "NAME_FULL_MATCH").when(s["initial_surname_match"], "NAME_INITIAL_SURNAME_MATCH")
        .when(s["obit_cue_match"] & s["obit_guardrail_token_match"], "OBIT_CUE_WITH_CAPITALIZED_TOKEN").when(s["obit_cue_match"], "NO_NAME_SIGNAL_OBIT_CUE_WITHOUT_GUARDRAIL")
        .otherwise("NO_NAME_SIGNAL_DEFAULT_SKIP")
    )


def classify_event(events: DataFrame) -> DataFrame:
    """Ordered rules over entry_title and summary: decision, reason codes, signals, and the first name as ``candidate_name``.

    Each pattern is tried once a row: the flags of names are whether their first match is there."""
    title, summary = blank(F.col("entry_title")), blank(F.col("summary"))
    none = F.struct(*(F.lit(False).alias(c) for c in ("full_name_match", "initial_surname_match", "obit_cue_match", "obit_guardrail_token_match", "known_wiki_page_match")))
    heading = F.when(F.rlike(title, F.lit(LETTERS_HEAD)) | F.rlike(title, F.lit(LETTERS_TAIL)), F.lit("LETTERS_HEADER_SKIP")).when(F.rlike(title, F.lit(STRUCTURAL)), F.lit("STRUCTURAL_TOPIC_SKIP")).when(F.rlike(summary, F.lit(TRIBUTE)), F.lit("PERSONAL_TRIBUTE_OBIT_SKIP"))
    named = lambda x: F.struct(x["h"].alias("h"), x["t"].alias("t"), _found(x["t"], FULL_NAME).alias("f"), _found(x["t"], INITIAL_SURNAME).alias("i"))
    signals = lambda x: F.struct(x["h"].alias("h"), F.coalesce(x["f"], x["i"]).alias("n"), F.when(x["h"].isNull(), name_signals(x["t"], x["f"], x["i"])).otherwise(none).alias("s"))
    found = bind(bind(bind(F.struct(heading.alias("h"), event_text(title, summary).alias("t")), named), signals), lambda x: F.struct(x["s"].alias("s"), x["n"].alias("n"), _reason(x["h"], x["s"]).alias("r")))
    # a generator of one row: neither projections nor filters above repeat the patterns
    out = events.drop("candidate_name").select("*", F.explode_outer(F.array(found)).alias("__p"))
    reason = F.col("__p")["r"]
    decision = (
        F.when(reason == "LETTERS_HEADER_SKIP", "LETTERS_HEADER_SKIP").when(reason == "STRUCTURAL_TOPIC_SKIP", "PREFILTER_SKIP_STRUCTURAL_PATTERN")
        .when(reason == "PERSONAL_TRIBUTE_OBIT_SKIP", "PERSONAL_TRIBUTE_OBIT_SKIP").when(F.startswith(reason, F.lit("NO_NAME")), "PREFILTER_SKIP_NO_NAME").otherwise("PREFILTER_PASS_TO_LLM")
    )
    out = out.withColumn("prefilter_decision", decision).withColumn("prefilter_reason_codes", F.array(reason)).withColumn("prefilter_signals", F.col("__p")["s"])
    return out.withColumn("candidate_name", F.col("__p")["n"]).drop("__p")


def keyword_filter(events: DataFrame, pattern: str) -> DataFrame:
    return events.where(F.rlike(event_text(F.col("entry_title"), F.col("summary")), F.lit(f"(?i){pattern}")))


def has_obit_signal(title: Column, summary: Column) -> Column:
    text = F.lower(F.concat(F.lit(" "), blank(title), F.lit(" "), blank(summary), F.lit(" ")))
    found = bind(text, lambda t: F.exists(F.array(*map(F.lit, OBITUARY_SIGNALS)), lambda p: F.contains(t, p)))
    return found & (title.isNotNull() | summary.isNotNull())


def context_terms(title: Column, tokens: Column) -> Column:
    """The first two distinct telling words of a title, joined; empty if there are none.  Linear in the title's words."""
    telling = lambda own: F.filter(F.regexp_extract_all(blank(title), F.lit(r"([A-Za-z0-9]+)"), F.lit(1)), lambda w: (F.length(w) >= 3) & ~F.lower(w).isin(*STOP_WORDS) & ~F.array_contains(own, F.lower(w)))
    first = lambda words, low: F.transform(F.slice(F.array_distinct(low), 1, 2), lambda x: F.get(words, (F.array_position(low, x) - 1).cast("int")))
    words = bind(F.transform(tokens, lambda t: F.lower(t)), telling)
    return F.array_join(bind(words, lambda ws: bind(F.transform(ws, lambda w: F.lower(w)), lambda low: first(ws, low))), " ")


def coverage_queries(name: Column, title: Column, summary: Column) -> Column:
    """Searches for one subject, in order and distinct."""
    quoted = lambda x: F.concat(F.lit('"'), x, F.lit('"'))

    def queries(x: Column) -> Column:
        name, signal, context, long = x["name"], x["signal"], x["context"], F.size(x["tokens"]) >= 3
        short = F.concat(F.element_at(x["tokens"], 1), F.lit(" "), F.element_at(x["tokens"], -1))
        out = F.array(
            quoted(name), F.when(signal, F.concat(quoted(name), F.lit(" obituary"))), F.when(long, quoted(short)), F.when(long, short),
            F.when(long & signal, F.concat(quoted(short), F.lit(" obituary"))), F.when(long & (context != ""), F.concat(quoted(short), F.lit(" "), context)),
        )
        return F.when(name == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.array_compact(out)))

    parts = lambda x: F.struct(x["name"].alias("name"), x["tokens"].alias("tokens"), has_obit_signal(title, summary).alias("signal"), F.when(F.size(x["tokens"]) >= 3, context_terms(title, x["tokens"])).otherwise("").alias("context"))
    named = bind(squeeze(name), lambda n: F.struct(n.alias("name"), name_tokens(n).alias("tokens")))
    return bind(bind(named, parts), queries)


def normalize_category(category: Column) -> Column:
    return F.trim(F.lower(F.regexp_replace(F.trim(blank(category)), "^(?i)category:", "")))


def biography_score(categories: Column) -> Column:
    c = F.filter(F.transform(categories, normalize_category), lambda x: x != "")
    points = lambda n, test: F.when(F.exists(c, test), F.lit(n)).otherwise(F.lit(0))
    return (
        points(3, lambda x: F.endswith(x, F.lit(" births"))) + points(3, lambda x: F.endswith(x, F.lit(" deaths"))) + points(3, lambda x: x == "living people")
        + points(2, lambda x: F.contains(x, F.lit(" people"))) + points(1, lambda x: F.rlike(x, F.lit(f"(?:{'|'.join(OCCUPATIONS)})$"))) + points(-3, lambda x: F.rlike(x, F.lit("|".join(NOT_PEOPLE))))
    )


def prose_snippet(text: Column, n: int = 700) -> Column:
    """Without templates: the first paragraph if it is long, else the first n characters."""
    clean = F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(blank(text), r"\{\{[^{}]*\}\}", ""), r"[ \t]+", " "), r"\n{3,}", "\n\n"))
    first = F.trim(F.element_at(F.split(clean, "\n\n"), 1))
    return F.when(F.length(first) >= n, first).otherwise(F.trim(F.substring(clean, 1, n)))


def cap(text: Column, n: int) -> Column:
    return F.substring(text, 1, n)


def is_original_source(title: Column, domain: Column, entry_title: Column, source: Column) -> Column:
    """Whether a result is the article that started the search."""
    head = lambda x: F.substring(F.lower(F.trim(blank(x))), 1, 60)
    token = F.get(F.filter(F.split(F.lower(blank(source)), "[^a-z]+"), lambda t: F.length(t) >= 3), 0)
    return ((head(title) != "") & (head(title) == head(entry_title))) | F.coalesce(F.contains(F.lower(blank(domain)), token), F.lit(False))


def looks_like_person(title: Column, description: Column, in_titles: Sequence[str] = TITLE_OCCUPATIONS, in_descriptions: Sequence[str] = DESCRIPTION_OCCUPATIONS) -> Column:
    """An occupation alone in parentheses in the title, or as a word of the description."""
    named = F.rlike(blank(title), F.lit(rf"(?i)\((?:{'|'.join(in_titles)})\)"))
    return named | F.rlike(blank(description), F.lit(rf"(?i)\b(?:{'|'.join(in_descriptions)})\b"))


def parse_published(text: Column) -> Column:
    """(ts, err): RFC 2822 first, then ISO 8601; a naive time is UTC."""
    plain = F.regexp_replace(F.trim(blank(text)), r"^[A-Za-z]{3},\s*", "")
    zoned = F.regexp_replace(plain, r" (?:GMT|UTC|UT)$", " +0000")
    tries = [F.try_to_timestamp(zoned, F.lit(f)) for f in ("d MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm Z", "d MMM yyyy HH:mm:ss")]
    iso = F.when(F.rlike(plain, F.lit(r"^\d{4}-\d{2}-\d{2}")), plain.try_cast("timestamp"))
    ts = F.coalesce(*tries, iso)
    return F.struct(ts.alias("ts"), ts.isNull().alias("err"))


def iso_utc(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")
