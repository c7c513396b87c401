"""Toxicity: class-conditional Kneser-Ney language models, compared by length-normalised likelihood.

Two interpolated Kneser-Ney models, one of toxic and one of ordinary text, predict the bytes of
each word from up to ``ORDER - 1`` bytes before them.  Orders up to ``SHARED`` use continuation
counts pooled over both classes, so a rare expression backs off to what both have in common
and only real evidence moves the comparison.  A document's features are the log-likelihood
ratio per word over the whole text and over its most toxic window; a logistic calibration
turns them into a score.

Counts come from all labelled training rows: tasks count the grams of distinct words, Spark
sums them by key and derives continuation counts, discounts and backoff weights of all grams,
which stay in a table.  A table of at most ``IN_TASKS`` rows (they are counted first) goes to
every task, which scores each distinct word once.  A larger one is joined gram by gram to the
distinct words of the documents, and the words' ratios to the documents; both ways give the
same ratios.  Only the calibration is fitted on a bounded sample, about ``MAX_LABELLED`` rows
taken by a hash, scored by a model of the other training fold.  Labels, language, source and id
are no inputs of a score.

README has figures of other values of ``ORDER``, ``SHARED`` and ``WINDOW``.

Defined results: a null or empty text has ratios of 0 and is scored like any other; a text of any
length is scored whole; rows with a null id or label don't train; without labels of both classes,
as for empty tables, the score is the constant 0.5; repeated rows count as often as they occur;
grams of equal counts need no order, since none is left out; other input columns pass through,
but columns named like the results are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.llm import scratch
from newsloom.llm import textbatch as tb

ORDER, SHARED, WINDOW = 6, 2, 3
MAX_LABELLED = 20_000
_PLACES = 1 << 20
THRESHOLD = 0.7
#: Rows of a model that goes to every task (64 MB there); a larger one is joined.
IN_TASKS = 1 << 22
#: Word ratios that a task remembers; when full it starts anew.
MEMO = 1 << 20
#: By a join, words whose ratios go to every task; the others are joined.
HEAD = 1 << 20
#: Ratios of words are whole multiples of 1 / SCALE, so that sums don't depend on their order.
SCALE = 1 << 32
_START, _END = 1, 2
_TAG = np.int64(56)


def _unique_words(low: np.ndarray, offsets: np.ndarray):
    """Hashes, byte spans of one occurrence each, each word's place among them, word offsets."""
    starts, ends, at = tb.spans(low, offsets, tb.ALNUM_WORDS)
    hashes, first, inverse = np.unique(tb.span_hashes(low, starts, ends), return_index=True, return_inverse=True)
    return hashes, starts[first], ends[first], inverse, at


def _symbols(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words' bytes with start and end marks, each symbol's place in its word, its word."""
    lengths = ends - starts
    total = lengths + 2
    first = np.cumsum(total) - total
    out = np.full(int(total.sum()), _END, np.int64)
    out[first] = _START
    out[tb.ranges(first + 1, lengths)] = low[tb.ranges(starts, lengths)]
    word = np.repeat(np.arange(len(starts)), total)
    return out, np.arange(len(out)) - first[word], word


def _grams(symbols: np.ndarray, k: int) -> np.ndarray:
    """The k symbols up to each place, packed; the last one is the lowest byte."""
    out = np.zeros(len(symbols), np.int64)
    for j in range(min(k, len(symbols))):
        out[j:] |= symbols[: len(symbols) - j] << np.int64(8 * j)
    return out | (np.int64(k) << _TAG)


def count_grams(low: np.ndarray, starts: np.ndarray, ends: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(gram, counts) of full length, or shorter and at the word's start; a column for each weight."""
    symbols, place, word = _symbols(low, starts, ends)
    keys = np.zeros(len(symbols), np.int64)
    for k in range(2, ORDER + 1):
        here = (place == k - 1) if k < ORDER else (place >= k - 1)
        keys[here] = _grams(symbols, k)[here]
    inside = place > 0
    found, inverse = np.unique(keys[inside], return_inverse=True)
    out = np.zeros((len(found), weights.shape[1]), np.int64)
    for c in range(weights.shape[1]):
        out[:, c] = np.bincount(inverse, weights=weights[word[inside], c], minlength=len(found))
    return found, out


class KneserNey:
    """Interpolated models of the classes toxic and ordinary, as a table.

    ``table``: (key, t0, o0, t, o): the share of each gram and the backoff weight of each context
    in the models of fold 0 and of all training rows.  A context's key has 8 added to its order."""

    def __init__(self, table: DataFrame):
        self.table = table
        self.rows = table.count()

    def arrays(self, half: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Sorted keys and their values in both classes, for a model of at most IN_TASKS rows."""
        found = self.table.select("key", *(_CLASSES[:2] if half else _CLASSES[2:])).toArrow()
        keys = found.column("key").to_numpy()
        order = np.argsort(keys)
        return keys[order], np.stack([found.column(i).to_numpy()[order] for i in (1, 2)], axis=1)

    @classmethod
    def of(cls, counted: DataFrame) -> KneserNey:
        """The models of (gram, t0, o0, t, o) counts: no gram is left out."""
        order, above, levels = F.shiftright("gram", int(_TAG)), None, []
        counted = scratch.table(counted, "grams")
        for k in range(ORDER, 0, -1):
            own = counted.where(order == k)
            if above is not None:  # how many symbols are seen before the gram
                suffix = F.col("gram").bitwiseAND(F.lit((1 << 8 * k) - 1)).bitwiseOR(F.lit(k << int(_TAG)))
                cont = above.select(suffix.alias("gram"), *((F.col(c) > 0).cast("long").alias(c) for c in _CLASSES))
                own = own.unionByName(cont).groupBy("gram").agg(*(F.sum(c).alias(c) for c in _CLASSES))
                own = scratch.table(own, f"grams-{k}")
            above = own
            if k <= SHARED:
                own = own.select("gram", (F.col("t0") + F.col("o0")).alias("t0"), (F.col("t0") + F.col("o0")).alias("o0"), (F.col("t") + F.col("o")).alias("t"), (F.col("t") + F.col("o")).alias("o"))
            levels.append(own.withColumn("k", F.lit(k)))
        rows = levels[0]
        for level in levels[1:]:
            rows = rows.unionByName(level)
        seen = rows.groupBy("k").agg(*(F.count_if(F.col(c) == n).alias(f"{c}{n}_") for c in _CLASSES for n in (1, 2))).collect()  # a row for each order
        # an order without any gram still needs a value for the planner; no row uses it
        by_order = {c: {r["k"]: r[f"{c}1_"] / (r[f"{c}1_"] + 2 * r[f"{c}2_"]) if r[f"{c}1_"] else 0.5 for r in seen} for c in _CLASSES}
        discount = {c: F.element_at(F.array(*(F.lit(by_order[c].get(k, 0.5)) for k in range(1, ORDER + 1))), F.col("k")) for c in _CLASSES}
        context = F.shiftright(F.col("gram").bitwiseAND(F.lit((1 << int(_TAG)) - 1)), 8).bitwiseOR(F.shiftleft(F.lit(8).bitwiseOR(F.col("k")).cast("long"), int(_TAG)))
        rows = rows.withColumn("context", context)
        held = rows.groupBy("context", "k").agg(*(F.sum(c).alias(f"{c}_all") for c in _CLASSES), *(F.count_if(F.col(c) > 0).alias(f"{c}_types") for c in _CLASSES))
        held = scratch.table(held, "contexts")
        shares = rows.join(held.drop("k"), "context").select(F.col("gram").alias("key"), *((F.greatest(F.col(c) - discount[c], F.lit(0.0)) / F.greatest(f"{c}_all", F.lit(1))).alias(c) for c in _CLASSES))
        left = held.select(F.col("context").alias("key"), *(F.when(F.col(f"{c}_all") > 0, discount[c] * F.col(f"{c}_types") / F.greatest(f"{c}_all", F.lit(1))).otherwise(1.0).alias(c) for c in _CLASSES))
        out = scratch.table(shares.unionByName(left).select("key", *(F.col(c).cast("float").alias(c) for c in _CLASSES)), "model")
        scratch.discard(counted, held)
        return cls(out)

    def ratios(self, words: DataFrame, half: bool = False) -> DataFrame:
        """(hash, n, ratio) of (word, n) rows: log P(word | toxic) - log P(word | ordinary), times SCALE, by the model of fold 0 or of all."""
        spelled = words.mapInArrow(tb.settled(_spell), "hash bigint, n bigint, gram bigint")
        classes = _CLASSES[:2] if half else _CLASSES[2:]
        tag = int(_TAG)
        one = lambda k: f"(gram & (shiftleft(1L, 8 * {k}) - 1))"
        keys = f"flatten(transform(sequence(1, cast(shiftright(gram, {tag}) as int)), k -> array({one('k')} | shiftleft(cast(k as bigint), {tag}), shiftright({one('k')}, 8) | shiftleft(cast(k + 8 as bigint), {tag}))))"
        asked = spelled.select("gram").distinct().select("gram", F.explode(F.expr(keys)).alias("key")).join(self.table.select("key", *classes), "key")
        # by ascending order, the backoff weight before the share
        place = F.when(F.shiftright("key", tag) > 8, 2 * (F.shiftright("key", tag) - 8)).otherwise(2 * F.shiftright("key", tag) + 1)
        start = F.struct(*(F.lit(1 / 256).alias(c) for c in classes))
        step = lambda acc, x: F.struct(*(F.when(x["place"] % 2 == 0, acc[c] * x[c]).otherwise(acc[c] + x[c]).alias(c) for c in classes))
        chances = asked.groupBy("gram").agg(F.aggregate(F.array_sort(F.collect_list(F.struct(place.alias("place"), *classes))), start, step).alias("p"))
        chances = chances.select("gram", F.round((F.log(F.col(f"p.{classes[0]}")) - F.log(F.col(f"p.{classes[1]}"))) * SCALE).cast("long").alias("ratio"))
        return spelled.join(chances, "gram", "left").groupBy("hash").agg(F.max("n").alias("n"), F.sum(F.coalesce("ratio", F.lit(0))).alias("ratio"))


_CLASSES = ("t0", "o0", "t", "o")
_FEATURES = ["__a", "__b", "__c"]


def _spell(batches):
    """(hash, n, gram) of every symbol of a word: the symbol and those before it, ORDER at most."""
    for batch in batches:
        n = batch.column("n").to_numpy()
        for first, end, data, offsets in tb.steps(pc.cast(batch.column("word"), pa.large_binary())):
            starts, ends = offsets[:-1], offsets[1:]
            hashes = tb.span_hashes(data, starts, ends).view(np.int64)
            symbols, place, word = _symbols(data, starts, ends)
            keys = np.zeros(len(symbols), np.int64)
            for k in range(2, ORDER + 1):
                here = (place == k - 1) if k < ORDER else (place >= k - 1)
                keys[here] = _grams(symbols, k)[here]
            inside = place > 0
            yield pa.RecordBatch.from_arrays([pa.array(hashes[word[inside]]), pa.array(n[first:end][word[inside]]), pa.array(keys[inside])], ["hash", "n", "gram"])


def _vocabulary(docs: DataFrame, text_col: str) -> DataFrame:
    """(word, n): distinct words in lower case and their occurrences."""

    def emit(batches):
        for batch in batches:
            for _, _, data, offsets in tb.steps(batch.column(text_col)):
                low = tb.lower(data)
                hashes, starts, ends, inverse, _ = _unique_words(low, offsets)
                if not len(hashes):
                    continue
                lengths = ends - starts
                flat, at = low[tb.ranges(starts, lengths)], np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
                words = pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(at), pa.py_buffer(flat)])
                yield pa.RecordBatch.from_arrays([words, pa.array(np.bincount(inverse, minlength=len(hashes)))], ["word", "n"])

    return docs.select(text_col).mapInArrow(tb.settled(emit), "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


class _Scorer:
    """Ratios of words by a model that the task holds, with a memo."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.keys, self.values = keys, values
        self.known, self.ratio = np.zeros(0, np.int64), np.zeros(0)

    def _look(self, key: np.ndarray, missing: float) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key)[:, None], self.values[at].astype(np.float64), missing)

    def _new(self, low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(starts))
        symbols, place, word = _symbols(low, starts, ends)
        chance = np.full((len(symbols), 2), 1 / 256)
        for k in range(1, ORDER + 1):
            here = np.flatnonzero(place >= max(k - 1, 1))
            gram = _grams(symbols, k)[here]
            context = ((gram & ((np.int64(1) << _TAG) - 1)) >> np.int64(8)) | (np.int64(8 + k) << _TAG)
            # grams and contexts repeat: each distinct one is looked up once
            one, back = np.unique(gram, return_inverse=True)
            share = self._look(one, 0.0)[back]
            one, back = np.unique(context, return_inverse=True)
            chance[here] = chance[here] * self._look(one, 1.0)[back] + share
        per = np.round((np.log(chance[:, 0]) - np.log(chance[:, 1])) * SCALE)
        per[place == 0] = 0
        return np.bincount(word, weights=per, minlength=len(starts)) / SCALE

    def __call__(self, low: np.ndarray, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(self.known) > MEMO:
            self.known, self.ratio = np.zeros(0, np.int64), np.zeros(0)
        at = np.minimum(np.searchsorted(self.known, hashes), max(len(self.known) - 1, 0))
        new = self.known[at] != hashes if len(self.known) else np.ones(len(hashes), bool)
        if new.any():
            merged = np.concatenate([self.known, hashes[new]])
            ratio = np.concatenate([self.ratio, self._new(low, starts[new], ends[new])])
            order = np.argsort(merged)
            self.known, self.ratio = merged[order], ratio[order]
            at = np.searchsorted(self.known, hashes)
        return self.ratio[at], np.ones(len(hashes), bool)


def _held(known: np.ndarray, ratio: np.ndarray):
    """Looks words up among known ratios."""

    def look(low, hashes, starts, ends):
        if not len(known):
            return np.zeros(len(hashes)), np.zeros(len(hashes), bool)
        place = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        found = known[place] == hashes
        return np.where(found, ratio[place], 0.0), found

    return look


def _text_features(texts: pa.Array, look) -> tuple[np.ndarray, np.ndarray]:
    """Mean ratio, best window's mean ratio and log words of every text; whether all its words are known."""
    parts, full = [], []
    for first, end, data, offsets in tb.steps(texts):
        low = tb.lower(data)
        hashes, starts, ends, inverse, at = _unique_words(low, offsets)
        n = np.diff(at)
        owner = np.repeat(np.arange(end - first), n)
        values, found = look(low, hashes.view(np.int64), starts, ends)
        values = values[inverse]
        complete = np.ones(end - first, bool)
        complete[owner[~found[inverse]]] = False
        sums = np.concatenate([[0], np.cumsum(values)])
        mean = (sums[at[1:]] - sums[at[:-1]]) / np.maximum(n, 1)
        width = np.minimum(n, WINDOW)
        best = np.full(end - first, -np.inf)
        begin = np.arange(len(values))
        stop = np.minimum(begin + WINDOW, at[1:][owner])
        whole = stop - begin == width[owner]
        np.maximum.at(best, owner[whole], (sums[stop[whole]] - sums[begin[whole]]) / width[owner[whole]])
        best[n == 0] = 0
        parts.append(np.stack([mean, best, np.log1p(n)], axis=1))
        full.append(complete)
    return (np.concatenate(parts), np.concatenate(full)) if parts else (np.zeros((0, 3)), np.zeros(0, bool))


def features(docs: DataFrame, model: KneserNey, keep: list[str], text_col: str = "text", half: bool = False) -> DataFrame:
    """``keep`` columns with the features ``__a``, ``__b`` and ``__c`` of each text."""
    return (_in_tasks if model.rows <= IN_TASKS else _by_join)(docs, model, keep, text_col, half)


def _schema(docs: DataFrame, keep: list[str]) -> T.StructType:
    return T.StructType([*(docs.schema[c] for c in keep), *(T.StructField(c, T.DoubleType()) for c in _FEATURES)])


def _rows(batch: pa.RecordBatch, keep: list[str], x: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *(pa.array(x[:, i]) for i in range(3))], [*keep, *_FEATURES])


def _in_tasks(docs: DataFrame, model: KneserNey, keep: list[str], text_col: str, half: bool) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model.arrays(half))  # at most IN_TASKS rows

    def score(batches):
        look = _Scorer(*shared.value)
        for batch in batches:
            yield _rows(batch, keep, _text_features(batch.column(text_col), look)[0])

    return docs.select(list(dict.fromkeys([*keep, text_col]))).mapInArrow(tb.settled(score), _schema(docs, keep))


def _by_join(docs: DataFrame, model: KneserNey, keep: list[str], text_col: str, half: bool) -> DataFrame:
    words = scratch.table(_vocabulary(docs, text_col), "words")
    ratios = scratch.table(model.ratios(words, half), "word-ratios")
    scratch.discard(words)
    # the least power of two so that words that occur as often are HEAD at most
    level = F.floor(F.log2("n")).cast("int")
    least, held = 64, 0
    for r in ratios.groupBy(level.alias("level")).agg(F.count("*").alias("n")).orderBy(F.desc("level")).collect():  # 63 rows at most
        held += r["n"]
        if held > HEAD:
            break
        least = r["level"]
    else:
        least = 0
    head = ratios.where(level >= least).select("hash", "ratio").toArrow().sort_by("hash")  # HEAD rows at most
    shared = docs.sparkSession.sparkContext.broadcast((head.column("hash").to_numpy(), head.column("ratio").to_numpy() / SCALE))
    columns = list(dict.fromkeys([*keep, text_col]))
    schema = _schema(docs, keep)

    def direct(batches):
        known, ratio = shared.value
        for batch in batches:
            x, complete = _text_features(batch.column(text_col), _held(known, ratio))
            yield _rows(batch, keep, x).filter(pa.array(complete))

    def rest(batches):
        known, _ = shared.value
        for batch in batches:
            tails = []
            for first, end, data, offsets in tb.steps(batch.column(text_col)):
                hashes, _, _, inverse, at = _unique_words(tb.lower(data), offsets)
                hashes = hashes.view(np.int64)
                place = np.minimum(np.searchsorted(known, hashes), max(len(known) - 1, 0))
                new = known[place] != hashes if len(known) else np.ones(len(hashes), bool)
                for i in range(end - first):
                    own = np.unique(inverse[at[i] : at[i + 1]])
                    tails.append(hashes[own[new[own]]])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(tails, pa.list_(pa.int64()))], [*columns, "__tail"]).filter(pa.array([len(t) > 0 for t in tails], pa.bool_()))

    def joined(batches):
        known, ratio = shared.value
        for batch in batches:
            pairs = batch.column("__pairs").flatten()
            more, first = np.unique(pairs.field("hash").to_numpy(), return_index=True)
            hashes, values = np.concatenate([known, more]), np.concatenate([ratio, pairs.field("ratio").to_numpy()[first] / SCALE])
            order = np.argsort(hashes)
            yield _rows(batch, keep, _text_features(batch.column(text_col), _held(hashes[order], values[order]))[0])

    out = docs.select(columns).mapInArrow(tb.settled(direct), schema)
    if least == 0:
        return out
    wide = T.StructType([*(docs.schema[c] for c in columns), T.StructField("__tail", T.ArrayType(T.LongType()))])
    others = scratch.table(docs.select(columns).mapInArrow(tb.settled(rest), wide).withColumn("__row", F.monotonically_increasing_id()), "rare-words")
    tails = others.select("__row", F.explode("__tail").alias("hash")).join(ratios.where(level < least).select("hash", "ratio"), "hash")
    pairs = tails.groupBy("__row").agg(F.collect_list(F.struct("hash", "ratio")).alias("__pairs"))
    return out.unionByName(others.drop("__tail").join(pairs, "__row").select(*columns, "__pairs").mapInArrow(tb.settled(joined), schema))


class Calibration:
    """Logistic regression on standardised features, fitted by damped Newton steps."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.weights = None
        if not len(y) or y.all() or not y.any():
            return
        self.mean, self.scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
        z = np.column_stack([np.ones(len(x)), (x - self.mean) / self.scale])
        w, penalty = np.zeros(z.shape[1]), np.diag([1e-6, *[1e-2] * x.shape[1]])
        for _ in range(40):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + penalty, z.T @ (y - p) - penalty @ w)
            w = w + np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-7:
                break
        self.weights = w

    def score(self, names: tuple[str, ...] = ("__a", "__b", "__c")) -> Column:
        """The score of feature columns."""
        if self.weights is None:
            return F.lit(0.5)
        z = F.lit(float(self.weights[0]))
        for w, name, mean, scale in zip(self.weights[1:], names, self.mean, self.scale, strict=True):
            z = z + float(w) * (F.col(name) - float(mean)) / float(scale)
        return 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(30.0)), F.lit(-30.0))))


def fold(id_col: str):
    return F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(3))


def _counts(rows: DataFrame) -> DataFrame:
    """(gram, toxic and ordinary counts of either fold) over (text, label, fold) rows."""

    def count(batches):
        for batch in batches:
            label, part = batch.column("label").to_numpy(zero_copy_only=False), batch.column("fold").to_numpy(zero_copy_only=False)
            column = 2 * (part != 0) + (label == 0)  # toxic, ordinary of fold 0, then of fold 2
            for first, end, data, offsets in tb.steps(batch.column("text")):
                low = tb.lower(data)
                hashes, starts, ends, inverse, at = _unique_words(low, offsets)
                if not len(hashes):
                    continue
                kind = np.repeat(column[first:end], np.diff(at))
                weights = np.stack([np.bincount(inverse, weights=kind == c, minlength=len(hashes)) for c in range(4)], axis=1)
                keys, counts = count_grams(low, starts, ends, weights)
                yield pa.RecordBatch.from_arrays([pa.array(keys), *(pa.array(counts[:, c]) for c in range(4))], ["gram", "t0", "o0", "t2", "o2"])

    out = rows.mapInArrow(tb.settled(count), "gram bigint, t0 bigint, o0 bigint, t2 bigint, o2 bigint")
    return out.groupBy("gram").agg(*(F.sum(c).alias(c) for c in ("t0", "o0", "t2", "o2")))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_labelled: int = MAX_LABELLED) -> tuple[KneserNey, Calibration]:
    """The models and the calibration, from labelled rows that aren't held out."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & (fold(id_col) != 1)).select(F.col(id_col).alias("__id"), F.col(label_col).alias("label"))
    # sorted and merged at every size: the smaller the labels, the larger the step to shuffled texts would be otherwise
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text")).where(fold("__id") != 1).join(known.hint("merge"), "__id")
    rows = scratch.table(rows.select("text", "label", fold("__id").alias("fold"), F.pmod(F.xxhash64("__id"), F.lit(_PLACES)).alias("o")), "labelled")
    counted = _counts(rows.select("text", "label", "fold"))
    model = KneserNey.of(counted.select("gram", "t0", "o0", (F.col("t0") + F.col("t2")).alias("t"), (F.col("o0") + F.col("o2")).alias("o")))
    second = rows.where("fold = 2")
    least = int(_PLACES * min(1.0, max_labelled / max(second.count(), 1)))  # an even share of the places, so about max_labelled rows
    sample = second.where(F.col("o") < least).select("text", "label")
    seen = features(sample, model, ["label"], half=True).select(*_FEATURES, "label").toArrow()  # about max_labelled rows of four numbers
    x = np.stack([seen.column(c).to_numpy() for c in (*_FEATURES, "label")], axis=1).astype(float)
    x = x[np.lexsort(x.T[::-1])]  # the fit doesn't depend on the order of tasks
    calibration = Calibration(x[:, :3], (x[:, 3] != 0).astype(float))
    scratch.discard(rows)
    return model, calibration


def score_toxicity(docs: DataFrame, model: KneserNey, calibration: Calibration, keep: list[str] | None = None, ordinary_only: bool = False, text_col: str = "text") -> DataFrame:
    """``keep`` columns (all by default) with ``score`` and ``predicted``.

    ``ordinary_only`` drops documents predicted toxic."""
    docs = docs.drop("score", "predicted")
    keep = [c for c in (keep or docs.columns) if c in docs.columns]
    out = features(docs, model, keep, text_col).withColumn("score", calibration.score())
    out = out.select(*keep, "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
    return out.where("predicted = 0") if ordinary_only else out


def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model, calibration = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    out = score_toxicity(docs, model, calibration, keep=["doc_id"])
    return out.select("doc_id", (fold("doc_id") == 1).alias("held_out"), "score", "predicted")
