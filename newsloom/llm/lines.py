"""Line deduplication: lines that several documents share stay in one of them.

Lines are exploded and normalised (ASCII blanks stripped at both ends, A-Z lower-cased),
hashed to 128 bits, and counted by document.  The shuffle carries hashes and ids, never
text; each hash is combined before the shuffle, so a line that a third of all documents
hold arrives once per task.  A hash is in two documents or more where its least and its
greatest id differ; higher thresholds count distinct ids.  Dropped lines are kept as positions
of a row's text, and the rest is put together again by position.  The join back is a plain shuffle join of two written inputs,
which adaptive execution splits where a hash is hot, or a broadcast if the table of repeated
hashes is small on disk.

Defined results: a null or empty text is one empty line; a key shorter than ``min_chars``
never counts; long texts cost their number of lines; rows with a null id pass through unchanged and count for nobody; rows that
repeat an id count as one document; an empty table gives an empty table.  Other columns pass
through; input columns named like the two counters are replaced.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm import scratch

BLANKS = " \t\n\v\f\r"


def ascii_lower(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def _hash(key: Column) -> Column:
    """128 bits: two hashes of the key under different seeds."""
    return F.struct(F.xxhash64(key).alias("a"), F.xxhash64(F.lit(1), key).alias("b"))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def drop_repeated_lines(docs: DataFrame, min_chars: int = 10, min_docs: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with repeated lines taken out of the text, plus ``n_lines`` and ``n_dropped``.

    A key of at least ``min_chars`` code points found in at least ``min_docs`` documents loses
    its lines everywhere except in the document with the smallest id that holds it.
    """
    own = F.xxhash64(text_col)  # tells rows apart that repeat an id
    line = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), own.alias("own"), F.posexplode(_lines(F.col(text_col))).alias("place", "line"))
    keyed = line.select("id", "own", "place", line_key(F.col("line")).alias("key")).where(F.length("key") >= min_chars)
    hashed = keyed.select("id", "own", "place", _hash(F.col("key")).alias("h")).select("id", "own", "place", F.col("h.a").alias("a"), F.col("h.b").alias("b"))
    if min_docs == 2:
        shared = hashed.groupBy("a", "b").agg(F.min("id").alias("keeper"), F.max("id").alias("last")).where("keeper < last")
    else:
        shared = hashed.select("id", "a", "b").distinct().groupBy("a", "b").agg(F.min("id").alias("keeper"), F.count("*").alias("n")).where(F.col("n") >= min_docs)
    shared = scratch.table(shared.select("a", "b", "keeper"), "shared-lines")
    lost = hashed.join(shared, ["a", "b"]).where("id <> keeper").groupBy("id", "own").agg(F.collect_set("place").alias("lost"))
    lost = scratch.table(lost.select(F.col("id").alias("__id"), F.col("own").alias("__own"), F.col("lost").alias("__lost")), "lost-lines")
    joined = docs.drop("n_lines", "n_dropped").join(lost, (F.col(id_col) == F.col("__id")) & (own == F.col("__own")), "left")
    # the lines are bound once, as an array of one; array_except keeps order and looks up in a hash set
    left = lambda lines: F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__lost"))
    kept = F.transform(F.array(_lines(F.col(text_col))), lambda lines: F.array_join(F.transform(left(lines), lambda place: F.get(lines, place)), "\n"))
    joined = joined.withColumn("n_lines", F.size(_lines(F.col(text_col))).cast("long")).withColumn("n_dropped", F.coalesce(F.when(F.col("__lost").isNotNull(), F.size("__lost")), F.lit(0)).cast("long"))
    return joined.withColumn(text_col, F.when(F.col("__lost").isNotNull(), F.get(kept, 0)).otherwise(F.col(text_col))).drop("__id", "__own", "__lost")


def op7_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = drop_repeated_lines(docs)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


OP7_SQL = """
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents),
k AS (
  SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
s AS (
  SELECT key, min(doc_id) AS keeper FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
m AS (
  SELECT k.doc_id, k.pos, k.line, s.key IS NOT NULL AND s.keeper <> k.doc_id AS lost FROM k LEFT JOIN s ON k.key = s.key)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN lost THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
