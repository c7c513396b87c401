"""Dedupe, ranking and limits by an explicit order; ties never depend on file order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.sources import shared


def _numbered(rows: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str = "__n") -> DataFrame:
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def _known(key: str) -> Column:
    return F.col(key).isNotNull() & ~F.col(key).cast("string").isin("", "0")


def _one(rows: DataFrame, keyed: Column, keys: Sequence[str], order: Sequence[str], last: bool = False) -> DataFrame:
    """The first of each key; rows without one all stay, dealt out by a hash of their order so that no task gathers them."""
    rows = rows.withColumn("__free", F.when(~F.coalesce(keyed, F.lit(False)), F.xxhash64(*order)))
    by = [F.col(c).desc() if last else F.col(c) for c in order]
    return _numbered(rows, [*keys, "__free"], by).where((F.col("__n") == 1) | F.col("__free").isNotNull()).drop("__n", "__free")


def first_wins(rows: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The first row of each key; rows without a key all stay."""
    return _one(rows, F.col(key).isNotNull(), [key], order)


def last_wins(rows: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The last row of each key; rows without a key all stay."""
    return _one(rows, F.col(key).isNotNull(), [key], order, last=True)


def dedupe_known(rows: DataFrame, within: Sequence[str], key: str, order: Sequence[str]) -> DataFrame:
    """The first row of each key within a subject; empty, zero and null keys always stay."""
    return _one(rows, _known(key), [*within, key], order)


def rerank(rows: DataFrame, within: Sequence[str], order: Sequence[str], name: str = "rank") -> DataFrame:
    return _numbered(rows, within, [F.col(c) for c in order], name)


def best_match(rows: DataFrame, within: Sequence[str]) -> DataFrame:
    """Highest score, then lowest page id, then input order."""
    order = [F.col("score").desc(), F.coalesce("pageid", F.lit(0)).asc(), F.col("rank").asc()]
    return _numbered(rows, within, order).where("__n = 1").drop("__n")


def select_candidates(rows: DataFrame, within: Sequence[str]) -> DataFrame:
    """All of positive score; where these are fewer than two, also the first of the others.  No score is a score of 0."""
    positive = F.coalesce(F.col("score"), F.lit(0)) > 0
    rows = _numbered(rows.withColumn("__p", positive), [*within, "__p"], [F.col("rank")])
    rows = rows.withColumn("__count", F.sum(F.col("__p").cast("int")).over(Window.partitionBy(*within)))
    return rows.where(F.col("__p") | ((F.col("__count") < 2) & (F.col("__n") == 1))).drop("__p", "__n", "__count")


def priority_order(seq: str = "seq") -> list[Column]:
    """Priority with nulls last, then newest, then input order."""
    return [F.col("feed_priority").asc_nulls_last(), F.coalesce("published_at_utc", F.lit("")).desc(), F.col(seq).asc()]


def top_k(rows: DataFrame, k: int, order: Sequence[Column]) -> DataFrame:
    return rows.orderBy(*order).limit(k)


def sample_k(rows: DataFrame, k: int, key: str, seed: int = 42) -> DataFrame:
    """At most k rows by a seeded digest of the key; the same rows every time, here and in SQL."""
    return rows.orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")).cast("binary")), key).limit(k)


def numbered(rows: DataFrame, order: Sequence[Column], name: str = "position") -> DataFrame:
    """Rows numbered from 1 in a total order, with no task that orders all of them.

    The rows are sorted by ranges and kept; a row's number is its place in its range plus the
    rows of earlier ranges, of which there is one count each.  Rows that tie in the whole order
    share a range, so a key that many rows have needs a tie-break in ``order``."""
    placed = shared.kept(rows.orderBy(*order).withColumn("__at", F.monotonically_increasing_id()), "numbered")
    # the upper bits of the id are the range, the lower 33 the place in it
    part, place = F.shiftright("__at", 33), F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("__part")).agg(F.count("*").alias("__rows"))
    before = F.coalesce(F.sum("__rows").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = shared.kept(sizes.select("__part", before.alias("__before")), "range-starts")  # a row for each range, small on disk
    out = placed.withColumn("__part", part).join(starts, "__part")
    return out.withColumn(name, F.col("__before") + place + 1).drop("__at", "__part", "__before")


def batches(rows: DataFrame, order: Sequence[Column], n: int = 10) -> DataFrame:
    """``batch`` from 1 on: runs of n rows in the given order; the last may be shorter."""
    return numbered(rows, order, "__n").withColumn("batch", F.floor((F.col("__n") - 1) / n).cast("long") + 1).drop("__n")
