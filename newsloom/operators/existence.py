"""Whether a person has a page: a cascade of look-ups, each for the names that are still open.

1. the exact title: a person's page decides, any other page is a collision, a disambiguation
   page goes on to its links
2. links of a disambiguation page that are the name itself or "Name (occupation)"
3. titles "Name (occupation)" of persons, in the order of the occupations
4. hits of a search, of which a person's page decides whose title holds the name; other pages
   leave the name uncertain, and nothing at all makes it missing

Every tier is an equi join of the open names with one table; what it decides is taken out by an
anti join, so later tiers see fewer names.  Tables of links are exploded by the caller, one
row a link, and semi-joined to the titles that are wanted before pages are looked up.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.text import looks_like_person
from newsloom.sources import shared

#: Candidates, context pages and collisions that an uncertain name lists.
LISTED = 3
_OUT = ["name", "status", "via", "resolved_title", "url", "candidates", "context", "collisions"]


def title_variants(name: Column, suffixes: Sequence[str]) -> Column:
    """"Name (occupation)" for each occupation, in order."""
    return F.transform(F.array(*map(F.lit, suffixes)), lambda s: F.concat(name, F.lit(" ("), s, F.lit(")")))


def page_url(title: Column, url: Column) -> Column:
    return F.coalesce(F.nullif(url, F.lit("")), F.concat(F.lit("https://en.wikipedia.org/wiki/"), F.url_encode(F.replace(title, F.lit(" "), F.lit("_")))))


def _pages(pages: DataFrame) -> DataFrame:
    """What the cascade asks of a page: (p_title, p_url, p_disambig, p_person)."""
    columns = pages.columns
    description = F.col("description") if "description" in columns else F.lit(None).cast("string")
    url = F.col("url") if "url" in columns else F.lit(None).cast("string")
    disambig = F.coalesce(F.col("is_disambig"), F.lit(False))
    return pages.select(
        F.col("title").alias("p_title"), page_url(F.col("title"), url).alias("p_url"), disambig.alias("p_disambig"),
        (~disambig & looks_like_person(F.col("title"), description)).alias("p_person"),
    )


def _look_up(rows: DataFrame, title: str, pages: DataFrame, redirects: DataFrame | None, how: str = "inner") -> DataFrame:
    """Pages of titles, or of the titles that these redirect to."""
    target = F.col(title)
    if redirects is not None:
        rows = rows.join(redirects.select(F.col("from").alias("__from"), F.col("to").alias("__to")), F.col(title) == F.col("__from"), "left")
        target = F.coalesce("__to", title)
    return rows.withColumn("__target", target).join(pages, F.col("__target") == F.col("p_title"), how).drop("__from", "__to", "__target")


def _found(rows: DataFrame, via: str) -> DataFrame:
    none = F.lit(None).cast("array<string>")
    return rows.select("name", F.lit("HAS_PAGE").alias("status"), F.lit(via).alias("via"), F.col("p_title").alias("resolved_title"), F.col("p_url").alias("url"), none.alias("candidates"), none.alias("context"), none.alias("collisions"))


def _first(rows: DataFrame, order: str) -> DataFrame:
    """One page for each name, the first by an order."""
    return rows.groupBy("name").agg(F.min_by(F.struct("p_title", "p_url"), order).alias("p")).select("name", "p.*")


def page_probe(names: DataFrame, pages: DataFrame, suffixes: Sequence[str], search: DataFrame, links: DataFrame | None = None, redirects: DataFrame | None = None, top: int = 5) -> DataFrame:
    """(name, status, via, resolved_title, url, candidates, context, collisions), a row for each distinct name.

    names: (name); pages: (title, is_disambig, description, url), one row a title, the last two may lack;
    suffixes: occupations for titles like "Name (artist)"; search: (name, rank, title), of which the first
    ``top`` ranks count; links: (title, at, link) of disambiguation pages; redirects: (from, to), one row a title.
    Status is HAS_PAGE, UNCERTAIN or MISSING; null names stay out."""
    pages = _pages(pages)
    exact = shared.kept(_look_up(names.where("name IS NOT NULL").select("name").distinct(), "name", pages, redirects, "left"), "probe-exact")
    decided = [_found(exact.where("p_person"), "exact")]
    state = exact.where(~F.coalesce("p_person", F.lit(False))).select("name", F.col("p_title").alias("x_title"), F.col("p_url").alias("x_url"), F.col("p_disambig").alias("x_disambig"))

    if links is not None:
        side = links.select(F.col("title").alias("__page"), "at", "link")
        wanted = (F.col("link") == F.col("name")) | F.array_contains(title_variants(F.col("name"), suffixes), F.col("link"))
        met = state.where("x_disambig").join(side, F.col("x_title") == F.col("__page")).where(wanted).select("name", "at", "link")
        linked = shared.kept(_first(_look_up(met, "link", pages, redirects).where(~F.col("p_disambig")), "at"), "probe-links")
        decided.append(_found(linked, "disambiguation-link"))
        state = state.join(linked.select("name"), "name", "left_anti")

    state = shared.kept(state, "probe-open")
    made = state.select("name", F.posexplode(title_variants(F.col("name"), suffixes)).alias("at", "variant"))
    variants = shared.kept(_first(_look_up(made, "variant", pages, redirects).where("p_person"), "at"), "probe-variants")
    decided.append(_found(variants, "variant"))
    state = state.join(variants.select("name"), "name", "left_anti")

    asked = state.select("name").join(search.where(F.col("rank") <= top).select("name", "rank", F.col("title").alias("hit")), "name")
    hits = _look_up(asked, "hit", pages, redirects)
    holds = F.contains(F.lower("p_title"), F.lower("name"))
    listed = lambda test: F.slice(F.transform(F.array_sort(F.collect_list(F.when(test, F.struct("rank", "p_url")))), lambda x: x["p_url"]), 1, LISTED)
    found = hits.groupBy("name").agg(
        F.min_by(F.struct("p_title", "p_url"), F.when(F.col("p_person") & holds, F.col("rank"))).alias("direct"),
        F.bool_or(F.col("p_person") & holds).alias("sure"), listed(F.col("p_person")).alias("candidates"), listed(~F.col("p_person")).alias("context"),
    )
    rest = state.join(found, "name", "left")
    none = F.array().cast("array<string>")
    sure, there = F.coalesce("sure", F.lit(False)), F.col("x_title").isNotNull()
    collision = F.when(there & ~F.col("x_disambig"), F.array("x_url")).otherwise(none)
    status = F.when(sure, "HAS_PAGE").when(there | F.col("sure").isNotNull(), "UNCERTAIN").otherwise("MISSING")
    open_ = status == "UNCERTAIN"
    last = rest.select(
        "name", status.alias("status"), F.when(sure, "search").when(open_, "search-uncertain").otherwise("search-empty").alias("via"),
        F.when(sure, F.col("direct.p_title")).alias("resolved_title"), F.when(sure, F.col("direct.p_url")).alias("url"),
        F.when(open_, F.coalesce("candidates", none)).alias("candidates"), F.when(open_, F.coalesce("context", none)).alias("context"), F.when(open_, collision).alias("collisions"),
    )
    for part in decided:
        last = last.unionByName(part)
    return last.select(_OUT)


def probe_counts(probed: DataFrame) -> DataFrame:
    """Names of each status."""
    return probed.groupBy("status").agg(F.count("*").alias("n"))
