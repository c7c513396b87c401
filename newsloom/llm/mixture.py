"""Mixing sources to target weights: how often each document is taken, by pivotal rounding.

1. Tasks count the words of whole texts.  Sizes add up by source, sources are numbered in code
   point order, and each gets a share of the budget by its weight.  A target stops at ``cap``
   times its source's size; the rest is shared again until none is above.  The driver holds a
   few sums; the sources stay a table.
2. All documents of a source have the same fractional number of copies, target over size.  Its
   whole part is taken outright.  The rest is a probability, rounded in pairs: words move at
   random from one document of a pair to the other until one of them is taken or left, so that
   the words of the pair and every document's chance stay as they are.  The other one goes on.
3. Documents meet in groups of a source and a hash of the id, largest first, read as a stream
   that holds one document.  Each group leaves one at most; ``FAN`` groups are one group of the
   next round, down to one document of each source, which is rounded to the nearer side.

A source's words miss its target by half a document at most, the last of the tree, and large
documents meet first.  Groups and draws depend on ids, sizes and the seed alone, so reruns
agree, on other partitions and after lost executors as well.

Defined results: a null text has no words and is taken 0 words; rows with a null source are one
source, the last; rows that repeat an id and a size share their copies and stay rows of their
own; a null id is an id like others; ties of sizes go by id; an empty table gives no rows; long
texts are counted whole.  Other columns are ignored, so names cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm import scratch, textbatch
from newsloom.operators import ordered

#: Documents of a source that meet in one group, about.
GROUP = 4096
#: Groups whose last documents meet in one group of the next round.
FAN = 256
#: Rows that repeat an id and a size are written out in runs of so many.
RUN = 1 << 16


def word_counts(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(doc_id, source, size): words parted by ASCII blanks and the controls from tab to carriage return."""

    def count(batches):
        for batch in batches:
            sizes = np.zeros(batch.num_rows, np.int64)
            for first, end, data, offsets in textbatch.steps(batch.column(2)):
                sizes[first:end] = np.diff(textbatch.spans(data, offsets, textbatch.BLANK_WORDS)[2])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes)], names=["doc_id", "source", "size"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.col(text_col).alias("text"))
    return rows.mapInArrow(count, f"doc_id {docs.schema[id_col].dataType.simpleString()}, source {docs.schema[source_col].dataType.simpleString()}, size bigint")


def source_targets(sizes: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """(sid, source, source_size, n_docs, weight, target) of (source, size) rows, kept.

    Sources take the weights in turn, by code point and null last; targets add up to ``share`` times all sizes."""
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    ranked = ordered.numbered(by_source, [F.col("source").asc_nulls_last()], "sid")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("sid") - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = scratch.table(ranked.withColumn("weight", weight), "sources")
    fixed = total_weight = total = 0
    above, capped = F.lit(False), -1
    while True:
        s, w, t, n = ranked.agg(F.sum(F.when(above, F.col("source_size"))), F.sum(F.when(~above, F.col("weight"))), F.sum("source_size"), F.count_if(above)).first()
        if n == capped:
            break
        capped, fixed, total_weight, total = n, cap * (s or 0), w or 1, t or 0
        above = (share * total - fixed) * F.col("weight") / float(total_weight) > cap * F.col("source_size")
    given = (share * total - fixed) * F.col("weight") / float(total_weight)
    return ranked.withColumn("target", F.when(above, cap * F.col("source_size")).otherwise(given))


def _uniform(*parts: int) -> float:
    """A number in [0, 1) that depends on the parts alone."""
    x = 0
    for p in parts:
        x = ((x ^ (p & 0xFFFFFFFFFFFFFFFF)) + 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF
        x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
        x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & 0xFFFFFFFFFFFFFFFF
        x ^= x >> 31
    return (x >> 11) / float(1 << 53)


def meet(a: float, p: float, b: float, q: float, draw: float) -> tuple[float, float]:
    """Chances of two documents of a and b words after words moved between them; one is 0 or 1.

    The words a * p + b * q stay, and so does each chance in expectation."""
    up, down = min(a * (1 - p), b * q), min(a * p, b * (1 - q))  # words to the first, words from it
    if draw * (up + down) < down:
        words = up
        p, q = (1.0, q - words / b) if a * (1 - p) <= b * q else (p + words / a, 0.0)
    else:
        words = down
        p, q = (0.0, q + words / b) if a * p <= b * (1 - q) else (p - words / a, 1.0)
    return min(max(p, 0.0), 1.0), min(max(q, 0.0), 1.0)


def _round(rows: DataFrame, level: int, seed: int) -> DataFrame:
    """One round of (sid, bucket, doc_id, size, base, p): all but one document of each group get 0 or 1 for p."""

    def run(batches):
        key, held, step = None, None, 0
        for batch in batches:
            schema, out = batch.schema, []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                sid, bucket, _, size, _, p = row
                if (sid, bucket) != key:
                    if held is not None:
                        out.append(held)
                    key, held, step = (sid, bucket), None, 0
                if held is None:
                    held = row
                    continue
                step += 1
                before, now = meet(held[3], held[5], size, p, _uniform(seed, level, sid, bucket, step))
                old, new = (*held[:5], before), (*row[:5], now)
                done, held = (old, new) if before in (0.0, 1.0) else (new, old)
                out.append(done)
                if held[5] in (0.0, 1.0):
                    out.append(held)
                    held = None
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(held, schema, strict=True)], schema=schema)

    columns = ["sid", "bucket", "doc_id", "size", "base", "p"]
    dealt = rows.select(columns).repartition("sid", "bucket").sortWithinPartitions("sid", "bucket", F.col("size").desc(), "doc_id")
    return dealt.mapInArrow(run, dealt.schema)


def mix_sources(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, cap: float = 2.0, seed: int = 13, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken), a row for each row of ``docs``."""
    sizes = scratch.table(word_counts(docs, id_col, source_col, text_col), "sizes")
    sources = scratch.table(source_targets(sizes, weights, share, cap), "source-targets")
    side = sources.select(F.col("source").alias("__s"), "sid", "n_docs", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("ratio"))
    # rows that repeat an id and a size are one block; what isn't whole in it is one document
    blocks = sizes.join(side, F.col("source").eqNullSafe(F.col("__s"))).groupBy("sid", "doc_id", "size").agg(F.count("*").alias("m"), F.first("ratio").alias("ratio"), F.first("n_docs").alias("n_docs"))
    blocks = blocks.withColumn("base", F.floor("ratio").cast("long")).withColumn("p", F.when(F.col("size") > 0, F.col("ratio") - F.col("base")).otherwise(0.0))
    blocks = blocks.withColumn("more", F.when(F.col("m") == 1, F.lit(0)).otherwise(F.floor(F.col("m") * F.col("p"))).cast("long"))
    blocks = blocks.withColumn("p", F.when(F.col("m") == 1, F.col("p")).otherwise(F.col("m") * F.col("p") - F.col("more"))).withColumn("open", F.col("p") > 0)
    groups = F.ceil(F.col("n_docs") / GROUP)
    blocks = scratch.table(blocks.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "size"), groups)), "blocks")
    scratch.discard(sizes)
    taken = lambda copies, times: F.struct((F.col("base") + copies).alias("copies"), times.alias("times"))
    settled = blocks.select("sid", "doc_id", "size", F.inline(F.array(taken(1, F.col("more")), taken(0, F.col("m") - F.col("more") - F.col("open").cast("long")))))
    runs = settled.where("times > 0").withColumn("run", F.explode(F.sequence(F.lit(0), F.floor((F.col("times") - 1) / RUN))))
    out = runs.withColumn("__i", F.explode(F.sequence(F.lit(1), F.least(F.lit(RUN), F.col("times") - F.col("run") * RUN)))).select("sid", "doc_id", "size", "copies")

    rest, level, fringe = blocks.where("open"), 0, sources.agg(F.max(F.ceil(F.col("n_docs") / GROUP))).first()[0] or 0
    parts = [out]
    while fringe:
        met = scratch.table(_round(rest, level, seed), "rounded")
        done = F.col("p").isin(0.0, 1.0) if fringe > 1 else F.lit(True)
        parts.append(met.where(done).select("sid", "doc_id", "size", (F.col("base") + F.round("p").cast("long")).alias("copies")))
        rest = met.where(~done).withColumn("bucket", F.floor(F.col("bucket") / FAN))
        fringe, level = -(-fringe // FAN) if fringe > 1 else 0, level + 1
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    out = out.join(sources.select("sid", "source", "source_size", "target"), "sid")
    return out.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def op13_source_mixing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    return mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")
