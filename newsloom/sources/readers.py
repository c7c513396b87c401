"""Feeds, JSON lines, documents, runs and known names as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom import schemas
from newsloom.operators import ordered
from newsloom.sources import shared

CORRUPT = "_corrupt_record"


def read_feeds(spark: SparkSession, path: str) -> DataFrame:
    """``- URL [number]`` lines; only a number of digits is a priority, the last duplicate wins; a missing file is empty."""
    if not shared.exists(spark, path):
        return spark.createDataFrame([], schemas.FEEDS)
    lines = spark.read.text(path).select(F.trim("value").alias("line"), F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("seq"))
    return parse_feed_lines(lines)


def parse_feed_lines(lines: DataFrame) -> DataFrame:
    """(line, seq) to (url, priority)."""
    body = F.trim(F.regexp_replace("line", r"^-\s*", ""))
    tail = F.regexp_extract(body, r"\s(\S+)$", 1)
    numeric = tail.try_cast("double").isNotNull() & (tail != "")
    rows = lines.where(F.rlike("line", F.lit(r"^-\s"))).select(F.when(numeric, F.trim(F.regexp_replace(body, r"\s\S+$", ""))).otherwise(body).alias("url"), F.when(F.rlike(tail, F.lit("^[0-9]+$")), tail.try_cast("int")).alias("priority"), "seq")
    return rows.where(F.rlike("url", F.lit("^https?://"))).groupBy("url").agg(F.max_by("priority", F.when(F.col("priority").isNotNull(), F.col("seq"))).alias("priority"))


def read_jsonl(spark: SparkSession, path: str, schema: str, strict: bool = False) -> tuple[DataFrame, DataFrame] | DataFrame:
    """Rows, and the lines that are no JSON object; a strict read fails on such a line."""
    if strict:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    lines = spark.read.text(path).where(F.trim("value") != "")
    fields = T.StructType.fromDDL(schema).add(CORRUPT, T.StringType())
    parsed = lines.select("value", F.from_json("value", fields, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("r"))
    good = F.col(f"r.{CORRUPT}").isNull() & F.startswith(F.ltrim("value"), F.lit("{"))
    return parsed.where(good).select("r.*").drop(CORRUPT), parsed.where(~F.coalesce(good, F.lit(False))).select("value")


def _documents(spark: SparkSession, path: str) -> DataFrame:
    """(value, file_path, modified, good) of whole files; none if the path is missing."""
    if not shared.exists(spark, path):
        return spark.createDataFrame([], "value STRING, file_path STRING, modified TIMESTAMP, good BOOLEAN")
    files = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_modification_time").alias("modified"))
    return files.withColumn("good", F.startswith(F.ltrim("value"), F.lit("{")) & F.try_parse_json("value").isNotNull())


def read_documents(spark: SparkSession, path: str, schema: str, max_age_days: float | None = None, now: Column | None = None) -> DataFrame:
    """One row for each JSON object of a file or folder that parses and is young enough, with ``file_path`` and ``modified``.

    A missing path, a file that is no JSON object and one older than the limit are absent; a field of another
    type than the schema's is null.  Order by ``file_path`` where the order of files matters."""
    rows = _documents(spark, path).where("good")
    if max_age_days is not None:
        oldest = (now if now is not None else F.current_timestamp()) - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(max_age_days * 86400.0))
        rows = rows.where(F.col("modified") >= oldest)
    return rows.select(F.from_json("value", schema).alias("d"), "file_path", "modified").select("d.*", "file_path", "modified")


def bad_documents(spark: SparkSession, path: str) -> DataFrame:
    """(file_path, value) of files that are no JSON object."""
    return _documents(spark, path).where("NOT coalesce(good, false)").select("file_path", "value")


def read_runs(spark: SparkSession, glob: str) -> DataFrame:
    """Run manifests; of a run that several files describe the last by path counts."""
    return ordered.last_wins(read_documents(spark, glob, schemas.RUNS).where("run_id IS NOT NULL"), "run_id", ["file_path"])


def read_summaries(spark: SparkSession, glob: str) -> DataFrame:
    """Run summaries; of a run that several files describe the last by path counts."""
    return ordered.last_wins(read_documents(spark, glob, schemas.SUMMARIES).where("run_id IS NOT NULL"), "run_id", ["file_path"])


def read_known_pages(spark: SparkSession, path: str) -> DataFrame:
    """(normalized_name, ...) of a versioned document; nothing if it is missing or no JSON object."""
    doc = read_documents(spark, path, schemas.KNOWN_PAGES)
    return doc.select(F.explode("entries").alias("normalized_name", "page")).select("normalized_name", "page.*")


#: What may stand before a document's first element.
_PROLOGUE = r"(?s)^(?:\s|\x{FEFF}|<\?.*?\?>|<!--.*?-->|<!DOCTYPE[^>\[]*(?:\[.*?\])?[^>]*>)*<(?:[\w.-]+:)?([\w.-]+)"


def _dialects(docs: DataFrame) -> DataFrame:
    """``docs`` with ``rss`` or ``atom``, by the name of their root; both are null where neither parses."""
    root = F.lower(F.regexp_extract(F.coalesce("body", F.lit("")), _PROLOGUE, 1))
    options = {"mode": "PERMISSIVE", "ignoreNamespace": "true", "ignoreSurroundingSpaces": "false"}
    rss, atom = F.from_xml(F.when(root == "rss", F.col("body")), schemas.RSS, options), F.from_xml(F.when(root == "feed", F.col("body")), schemas.ATOM, options)
    first = F.col("first") if "first" in docs.columns else F.lit(0)
    return docs.select("feed_url", first.alias("first"), root.alias("root"), rss.alias("rss"), atom.alias("atom"))


def _strip(text: Column) -> Column:
    """``text`` without the white space of XML around it."""
    return F.btrim(text, F.lit(" \t\r\n"))


def _first_text(values: Column) -> Column:
    return F.get(F.filter(F.transform(values, _strip), lambda x: x != ""), 0)


def _entries(items: DataFrame) -> DataFrame:
    text = lambda *cs: F.coalesce(*(F.nullif(_strip(F.col(c)), F.lit("")) for c in cs))
    often = lambda *cs: F.coalesce(*(_first_text(F.col(c)) for c in cs))
    alternate = F.filter("e.link", lambda x: (_strip(F.coalesce(x["_href"], F.lit(""))) != "") & F.lower(_strip(F.coalesce(x["_rel"], F.lit("alternate")))).isin("", "alternate"))
    link = F.coalesce(_strip(F.get(alternate, 0)["_href"]), _first_text(F.transform("e.link", lambda x: x["_VALUE"])))
    author = F.coalesce(_first_text(F.transform("e.author", lambda x: x["_VALUE"])), text("e.creator"), _first_text(F.transform("e.author", lambda x: x["name"])))
    title_raw = F.coalesce(F.get(F.filter("e.title", lambda x: _strip(x) != ""), 0), F.get("e.title", 0))
    out = items.select(
        "feed_url", "feed_title", "at", F.coalesce(often("e.title"), F.lit("(untitled)")).alias("entry_title"), title_raw.alias("entry_title_raw"), link.alias("entry_url_raw"), text("e.guid", "e.id").alias("entry_guid"),
        often("e.description", "e.summary", "e.content").alias("summary"), author.alias("author"), text("e.pubDate", "e.published", "e.updated", "e.date").alias("published"),
    )
    return out.where(F.coalesce("entry_url_raw", F.lit("")) != "")


def parse_feeds(docs: DataFrame) -> DataFrame:
    """(feed_url, body) of RSS and Atom documents to entries, ``at`` being their place in the document.

    A document is parsed whole, in one task; a long feed comes as several documents, of which ``first``, if there
    is such a column, is the place of the first entry in the feed, and ``at`` goes on from there.
    Elements count by local name, so Dublin Core dates and creators are read in either dialect.  ``entry_title_raw``
    is the title as it stands there, with the white space around it; all other texts go without.  An entry
    without a link goes; a document that does not parse, or has another root, gives no rows."""
    parsed = _dialects(docs)
    item = parsed.select("feed_url", "first", _first_text(F.col("rss.channel.title")).alias("feed_title"), F.posexplode("rss.channel.item").alias("at", "e"))
    entry = parsed.select("feed_url", "first", _first_text(F.col("atom.title")).alias("feed_title"), F.posexplode("atom.entry").alias("at", "e"))
    return _entries(item.unionByName(entry).withColumn("at", F.col("first") + F.col("at")))


def feed_outcomes(docs: DataFrame) -> DataFrame:
    """(feed_url, ok, n_items): whether a document parsed, and its entries, those without a link included.

    A well-formed document with another root is fine and has no entries."""
    parsed = _dialects(docs.withColumn("feed_url", F.struct("feed_url", "body")))
    n = F.greatest(F.size("rss.channel.item"), F.lit(0)) + F.greatest(F.size("atom.entry"), F.lit(0))
    other = F.from_xml(F.when(~F.col("root").isin("", "rss", "feed"), F.col("feed_url.body")), "none STRING, _corrupt_record STRING", {"mode": "PERMISSIVE"})
    ok = (other.isNotNull() & other["_corrupt_record"].isNull()) | F.col("rss.channel").isNotNull() | F.col("atom.entry").isNotNull() | F.col("atom.title").isNotNull()
    return parsed.select("feed_url.feed_url", ok.alias("ok"), F.coalesce(n, F.lit(0)).cast("long").alias("n_items"))


def spread(rows: DataFrame) -> DataFrame:
    """Rows dealt out to all cores where their files are fewer than these, before expressions that cost more than a shuffle.

    A file may be one row group, which one task reads however many tasks there are.  Tables of more
    files, as large ones are, stay as they are."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if len(rows.inputFiles()) < cores else rows


def resolve_events(spark: SparkSession, explicit: str | None, prefiltered: str | None, raw: str) -> DataFrame:
    """The explicit table, else the prefiltered one if it is there, else the raw events."""
    path = explicit or raw
    if not explicit and prefiltered and shared.exists(spark, prefiltered):
        path = prefiltered
    return spark.read.parquet(path)
