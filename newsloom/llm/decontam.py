"""Benchmark decontamination by winnowed fingerprints.

Of every ``w`` consecutive k-gram hashes the smallest is kept, on both sides by the same
rule, so each shared span of at least ``k + w - 1`` words shares a kept hash with the same
alignment.  Joined fingerprints are extended in both directions over equal words; spans of a
whole window count as hit.  Items shorter than a window are one window; their lengths are
looked up as whole grams.

The fingerprints of a benchmark of at most ``MAX_ITEM_BYTES`` of text go to every task, and
documents are read once with no shuffle.  A larger benchmark (its size is measured first) is
joined by a shuffle on the fingerprint; both ways share the code that extends hits and give
the same results.

A hash that a text and an item hold often (a repeated word) gives as many alignments as the
product of its places.  Beyond ``MAX_ALIGNED`` they are not listed: the two are compared by the
hashes of all their whole windows, which is what all alignments together would find.

Defined results: null and empty texts have no words and are clean; an empty benchmark hits
nothing; null items are ignored; rows that repeat an item's id count as one item, of which any
may hit; equal items of different ids are each reported; on ties every least gram of a window
is kept; long texts are judged whole; rows that repeat a document are judged alike, and those with a null id or with one id and two
texts each by its own text.  Input columns named like the results are replaced, others pass through.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.llm import scratch
from newsloom.llm import textbatch as tb

WINDOW, GRAM = 13, 7
#: Benchmarks of at most so many bytes of text are sent to every task.
MAX_ITEM_BYTES = 16 << 20
#: Places of one hash in a text times those in an item, up to which alignments are listed.
MAX_ALIGNED = 16
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def _words(texts: pa.Array) -> Iterable[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, word hashes, word offsets) for slices of a column."""
    for first, end, data, offsets in tb.steps(texts):
        low = tb.lower(data)
        starts, ends, at = tb.spans(low, offsets, tb.ALNUM_WORDS)
        yield first, end, tb.span_hashes(low, starts, ends), at


def _text_grams(words: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """The k-gram hash at each word, _NONE where a gram would leave its text."""
    out = np.full(len(words), _NONE, np.uint64)
    grams = tb.gram_hashes(words, k)
    here = tb.ranges(at[:-1], tb.gram_offsets(at, k))
    out[here] = np.minimum(grams[here], _NONE - np.uint64(1))
    return out


def winnow(grams: np.ndarray, w: int) -> np.ndarray:
    """Positions that hold the minimum of a window of w grams (all of them on ties)."""
    n = len(grams)
    if not n:
        return np.zeros(0, np.int64)
    padded = np.concatenate([grams, np.full(w - 1, _NONE, np.uint64)])
    least = np.lib.stride_tricks.sliding_window_view(padded, w).min(axis=1)
    padded = np.concatenate([np.zeros(w - 1, np.uint64), least])
    most = np.lib.stride_tricks.sliding_window_view(padded, w).max(axis=1)
    return np.flatnonzero((most == grams) & (grams != _NONE))


def _fingerprints(words: np.ndarray, at: np.ndarray, short: Iterable[int], whole: bool) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes): winnowed grams, and for each short length the grams of that length.

    ``whole``: short grams only of texts that are just so long, as for items."""
    grams = _text_grams(words, at, GRAM)
    lengths = np.diff(at)
    if whole:
        grams[tb.ranges(at[:-1], np.where(lengths < WINDOW, lengths, 0))] = _NONE
    found = [winnow(grams, WINDOW - GRAM + 1)]
    hashes = [grams[found[0]]]
    for m in short:
        grams = _text_grams(words, at, m)
        here = at[:-1][lengths == m] if whole else np.flatnonzero(grams != _NONE)
        found.append(here)
        hashes.append(grams[here])
    return np.concatenate(found), np.concatenate(hashes)


def _edges(same: np.ndarray, need: int) -> list[tuple[int, int]]:
    """Runs of true of at least ``need``: first place and one past the last."""
    edges = np.diff(np.concatenate([[0], same.view(np.int8), [0]]))
    return [(int(a), int(b)) for a, b in zip(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1), strict=True) if b - a >= need]


def _extend(doc: np.ndarray, item: np.ndarray, shifts: Iterable[int] | None) -> list[tuple[int, int]]:
    """Spans of doc, one past the end, that equal item for a whole window: at these alignments, or at any if None."""
    need, out = min(WINDOW, len(item)), []
    if shifts is None:
        found = np.isin(tb.gram_hashes(doc, need), tb.gram_hashes(item, need))
        return [(a, b + need - 1) for a, b in _edges(found, 1)]
    for shift in shifts:
        first, end = max(0, shift), min(len(doc), len(item) + shift)
        if end - first >= need:
            out += [(first + a, first + b) for a, b in _edges(doc[first:end] == item[first - shift : end - shift], need)]
    return out


def _judge(doc: np.ndarray, met: dict[int, set[int] | None], items: list[np.ndarray]) -> tuple[int, set[int]]:
    """Words hit and items found, from the alignments of each item."""
    hit, found = np.zeros(len(doc) + 1, np.int32), set()
    for item, shifts in met.items():
        for a, b in _extend(doc, items[item], shifts):
            hit[a] += 1
            hit[b] -= 1
            found.add(item)
    return int((np.cumsum(hit) > 0).sum()), found


def _groups(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place and size of each run of equal keys; the keys are sorted."""
    if not len(keys[0]):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.concatenate([[True], np.any([k[1:] != k[:-1] for k in keys], axis=0)])
    first = np.flatnonzero(new)
    return first, np.diff(np.append(first, len(new)))


class _Index:
    """The benchmark's fingerprints, sorted, with their items and places."""

    def __init__(self, ids: list, texts: list[str]):
        self.ids, self.items = [], []
        for first, end, words, at in _words(pa.array(texts, pa.large_string())):
            for i in range(end - first):
                if at[i] < at[i + 1]:
                    self.ids.append(ids[first + i])
                    self.items.append(words[at[i] : at[i + 1]])
        lengths = [len(x) for x in self.items]
        self.short = sorted({n for n in lengths if n < WINDOW})
        at = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
        places, hashes = _fingerprints(np.concatenate([*self.items, np.zeros(0, np.uint64)]), at, self.short, True)
        owner = np.searchsorted(at, places, side="right") - 1
        order = np.lexsort((owner, hashes))
        self.place = (places - at[owner])[order]
        self.first, self.count = _groups(hashes[order], owner[order])
        self.hashes, self.owner = hashes[order][self.first], owner[order][self.first]

    def judge(self, texts: pa.Array):
        """n_words, n_hit and the items found, for every text."""
        for first, end, words, at in _words(texts):
            rows = [(int(at[i + 1] - at[i]), 0, []) for i in range(end - first)]
            if len(self.hashes):
                places, hashes = _fingerprints(words, at, self.short, False)
                row = np.searchsorted(at, places, side="right") - 1
                order = np.lexsort((hashes, row))
                places, hashes, row = (places - at[row])[order], hashes[order], row[order]
                first, count = _groups(row, hashes)
                low = np.searchsorted(self.hashes, hashes[first], side="left")
                met = np.searchsorted(self.hashes, hashes[first], side="right") - low
                entry, own = tb.ranges(low, met), np.repeat(np.arange(len(first)), met)
                n = count[own] * self.count[entry]
                pair = np.repeat(np.arange(len(n)), np.where(n <= MAX_ALIGNED, n, 0))
                k = tb.ranges(np.zeros(len(n), np.int64), np.where(n <= MAX_ALIGNED, n, 0))
                mine = places[first[own[pair]] + k // self.count[entry[pair]]]
                theirs = self.place[self.first[entry[pair]] + k % self.count[entry[pair]]]
                hits: dict[int, dict[int, set[int] | None]] = {}
                for r, item, shift in zip(row[first[own[pair]]].tolist(), self.owner[entry[pair]].tolist(), (mine - theirs).tolist(), strict=True):
                    hits.setdefault(r, {}).setdefault(item, set()).add(shift)
                many = n > MAX_ALIGNED
                for r, item in zip(row[first[own[many]]].tolist(), self.owner[entry[many]].tolist(), strict=True):
                    hits.setdefault(r, {})[item] = None
                for r, met_items in hits.items():
                    n_hit, found = _judge(words[at[r] : at[r + 1]], met_items, self.items)
                    rows[r] = (rows[r][0], n_hit, sorted({self.ids[i] for i in found}))
            yield from rows


_RESULTS = [T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("items", T.ArrayType(T.LongType())), T.StructField("contaminated", T.BooleanType())]
_NAMES = [f.name for f in _RESULTS]


def _columns(rows: list[tuple[int, int, list]]) -> list[pa.Array]:
    words, hits = [r[0] for r in rows], [r[1] for r in rows]
    bad = [h > 0 and 20 * h >= w for w, h in zip(words, hits, strict=True)]
    return [pa.array(words, pa.int64()), pa.array(hits, pa.int64()), pa.array([r[2] for r in rows], pa.list_(pa.int64())), pa.array(bad, pa.bool_())]


def judge_contamination(docs: DataFrame, benchmark: DataFrame, keep: list[str] | None = None, clean_only: bool = False, id_col: str = "doc_id", text_col: str = "text", max_item_bytes: int = MAX_ITEM_BYTES) -> DataFrame:
    """``keep`` columns of ``docs`` (all by default) with n_words, n_hit, items, contaminated.

    ``clean_only`` drops contaminated documents inside the scan."""
    docs = docs.drop(*_NAMES)
    keep = [c for c in (keep or docs.columns) if c in docs.columns]
    items = benchmark.where(F.col("text").isNotNull() & F.col("item_id").isNotNull()).select("item_id", "text")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    if size <= max_item_bytes:
        out = _in_scan(docs, items, keep, clean_only, text_col)
    else:
        out = _by_join(docs, items, keep, id_col, text_col)
        out = out.where(~F.col("contaminated")) if clean_only else out
    return out


def _in_scan(docs: DataFrame, items: DataFrame, keep: list[str], clean_only: bool, text_col: str) -> DataFrame:
    rows = items.collect()  # at most max_item_bytes of text
    index = docs.sparkSession.sparkContext.broadcast(_Index([r["item_id"] for r in rows], [r["text"] for r in rows]))

    def judge(batches):
        for batch in batches:
            found = _columns(list(index.value.judge(batch.column(text_col))))
            out = pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *found], [*keep, *_NAMES])
            yield out.filter(pc.invert(found[3])) if clean_only else out

    schema = T.StructType([*(docs.schema[c] for c in keep), *_RESULTS])
    return docs.select(list(dict.fromkeys([*keep, text_col]))).mapInArrow(tb.settled(judge), schema)


def _prints(df: DataFrame, short: list[int], whole: bool) -> DataFrame:
    """(id, key, text) rows to (id, key, place, hash)."""

    def emit(batches):
        for batch in batches:
            ids, keys = batch.column("id"), batch.column("key")
            for first, _, words, at in _words(batch.column("text")):
                places, hashes = _fingerprints(words, at, short, whole)
                row = np.searchsorted(at, places, side="right") - 1
                take = pa.array(row + first)
                yield pa.RecordBatch.from_arrays([ids.take(take), keys.take(take), pa.array(places - at[row]), pa.array(hashes.view(np.int64))], ["id", "key", "place", "hash"])

    return df.mapInArrow(tb.settled(emit), T.StructType([df.schema["id"], df.schema["key"], T.StructField("place", T.LongType()), T.StructField("hash", T.LongType())]))


def _by_join(docs: DataFrame, items: DataFrame, keep: list[str], id_col: str, text_col: str) -> DataFrame:
    """For a benchmark of any size: join on the fingerprint, gather the alignments, extend."""
    # words are runs of these bytes, so the count of their first bytes is native
    n_words = F.size(F.filter(F.split(F.coalesce(text_col, F.lit("")), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), lambda w: w != "")).cast("long")
    sized = items.withColumn("n", F.size(F.filter(F.split("text", r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), lambda w: w != "")))
    short = [r["n"] for r in sized.where(F.col("n").between(1, WINDOW - 1)).select("n").distinct().collect()]  # at most 12 rows
    keyed = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("key"), F.col(text_col).alias("text"))
    left = _prints(keyed, sorted(short), False)
    right = _prints(items.select(F.col("item_id").alias("id"), F.lit(0).alias("key"), "text"), sorted(short), True)
    right = scratch.table(right.groupBy(F.col("id").alias("item"), "hash").agg(F.collect_set("place").alias("at")), "item-prints")
    left = left.groupBy("id", "key", "hash").agg(F.collect_set("place").alias("places"))  # at most the words of a text
    met = left.join(right, "hash").withColumn("many", F.size("places") * F.size("at") > MAX_ALIGNED)
    shifts = F.flatten(F.transform("places", lambda p: F.transform("at", lambda a: p - a)))
    met = met.select("id", "key", "item", "many", F.when(~F.col("many"), shifts).alias("shifts"))
    met = met.groupBy("id", "key", "item").agg(F.max("many").alias("many"), F.flatten(F.collect_set("shifts")).alias("shifts"))
    met = met.select("id", "key", "item", F.when(~F.col("many"), F.array_distinct("shifts")).alias("shifts"))
    texts = keyed.dropDuplicates(["id", "key"]).select(F.col("id").alias("__id"), F.col("key").alias("__key"), "text")
    pairs = met.join(texts, F.col("id").eqNullSafe(F.col("__id")) & (F.col("key") == F.col("__key"))).drop("__id", "__key").join(items.select(F.col("item_id").alias("item"), F.col("text").alias("item_text")), "item")

    def extend(batches):
        for batch in batches:
            out = []
            for row in batch.select(["text", "item_text", "shifts"]).to_pylist():
                doc, item = (next((w for *_, w, _ in _words(pa.array([row[c]], pa.large_string()))), np.zeros(0, np.uint64)) for c in ("text", "item_text"))
                out.append([{"a": a, "b": b} for a, b in _extend(doc, item, row["shifts"])])
            spans = pa.array(out, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("key"), batch.column("item"), spans], ["id", "key", "item", "spans"])

    spans = pairs.select("id", "key", "text", "item", "item_text", "shifts").mapInArrow(tb.settled(extend), T.StructType([pairs.schema["id"], pairs.schema["key"], pairs.schema["item"], T.StructField("spans", T.ArrayType(T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])))]))
    spans = spans.where(F.size("spans") > 0).groupBy("id", "key").agg(F.array_sort(F.collect_set("item")).alias("items"), F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))
    # the union's length: each span, sorted by start, adds what lies beyond the end so far
    union = F.aggregate("spans", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("e")), lambda s, x: F.struct((s["n"] + F.greatest(F.lit(0), x["b"] - F.greatest(x["a"], s["e"]))).alias("n"), F.greatest(s["e"], x["b"]).alias("e")), lambda s: s["n"])
    found = scratch.table(spans.select(F.col("id").alias("__id"), F.col("key").alias("__key"), "items", union.alias("n_hit")), "contaminated")
    out = docs.withColumn("n_words", n_words).join(found, F.col(id_col).eqNullSafe(F.col("__id")) & (F.xxhash64(text_col) == F.col("__key")), "left")
    out = out.withColumn("n_hit", F.coalesce("n_hit", F.lit(0))).withColumn("items", F.coalesce("items", F.array().cast("array<bigint>")))
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).select(*keep, *_NAMES)


def op3_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = judge_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), keep=["doc_id"])
    names = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join(names, ","), 256).alias("items_sha256"), "contaminated")
