"""Quality rules: an ordered decision list learned from labelled statistics.

Counts of words, symbols, repeated lines and repeated word windows come from one pass over
whole texts.  Sequential covering then learns rules for low quality from labelled rows: a rule
grows by the threshold condition of the highest FOIL gain on two thirds of the rows, is pruned
on the remaining third, and what it covers is taken out before the next one.  The list is
emitted as one ordered ``CASE WHEN`` over the statistics, so scoring stays in the JVM.

The rules are fitted on at most ``MAX_LABELLED`` labelled rows, taken by the order of a hash of
the id; the statistics cover every document.

Defined results: null and empty texts have no words and fail the base rule; with no labelled
rows, or none of low quality, the list is empty and keeps all that passes the base rule; null
labels are ignored; repeated rows count as often as they occur.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.llm import scratch
from newsloom.llm import textbatch as tb

MAX_LABELLED = 20_000
SYMBOLS = tb.byte_table(b"#*$%&|<>")
UPPER = tb.byte_table(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")
DIGITS = tb.byte_table(b"0123456789")
MARKS = tb.byte_table(b"!?")
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits", "n_marks", "n_distinct"]


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])[offsets])


def _repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys occur again anywhere, and which are not the first of their kind."""
    order = np.argsort(keys, kind="stable")
    same = np.zeros(len(keys), bool)
    same[1:] = keys[order][1:] == keys[order][:-1]
    many = same.copy()
    many[:-1] |= same[1:]
    out, later = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    out[order], later[order] = many, same
    return out, later


def _statistics(texts: pa.Array) -> np.ndarray:
    """A row of COUNTS for every text."""
    parts = []
    for first, end, data, offsets in tb.steps(texts):
        starts, ends, at = tb.spans(data, offsets, tb.BLANK_WORDS)
        words = tb.span_hashes(data, starts, ends)
        row = np.repeat(np.arange(end - first), np.diff(at))
        salt = tb.mix(np.arange(end - first, dtype=np.uint64))
        first_byte = (data & 0xC0) != 0x80
        chars = np.concatenate([[0], np.cumsum(first_byte, dtype=np.int64)])
        letters = np.concatenate([[0], np.cumsum(chars[ends] - chars[starts])])
        # lines are spans between line breaks and text ends; equal lines count where they hold a word
        breaks = np.flatnonzero(data == 10)
        edges = np.sort(np.concatenate([breaks, offsets[1:]]))
        begins = np.sort(np.concatenate([breaks + 1, offsets[:-1]]))
        owner = np.searchsorted(offsets[1:], begins, side="right")
        owner = np.minimum(owner, end - first - 1)
        filled = np.searchsorted(starts, edges) > np.searchsorted(starts, begins)
        begins, edges, owner = begins[filled], edges[filled], owner[filled]
        _, later = _repeats(tb.mix(tb.span_hashes(data, begins, edges) ^ salt[owner]))
        # words inside 3-word windows that occur twice or more in their text
        here = tb.ranges(at[:-1], tb.gram_offsets(at, 3))
        many, _ = _repeats(tb.mix(tb.gram_hashes(words, 3)[here] ^ salt[row[here]]))
        cover = np.zeros(len(words) + 3, np.int32)
        np.add.at(cover, here[many], 1)
        np.add.at(cover, here[many] + 3, -1)
        _, known = _repeats(tb.mix(words ^ salt[row]))
        parts.append(np.stack([
            np.diff(at), np.diff(letters[at]), _per_text(SYMBOLS[data], offsets), np.bincount(owner[later], minlength=end - first),
            _per_text(np.cumsum(cover)[: len(words)] > 0, at), np.bincount(owner, minlength=end - first), _per_text(UPPER[data], offsets),
            _per_text(DIGITS[data], offsets), _per_text(MARKS[data], offsets), np.diff(at) - _per_text(known, at),
        ], axis=1))
    return np.concatenate(parts) if parts else np.zeros((0, len(COUNTS)), np.int64)


def text_statistics(docs: DataFrame, keep: list[str] | None = None, text_col: str = "text") -> DataFrame:
    """``keep`` columns (all by default) and COUNTS; input columns of those names are replaced."""
    docs = docs.drop(*COUNTS)
    keep = [c for c in (keep or docs.columns) if c in docs.columns]

    def count(batches):
        for batch in batches:
            rows = _statistics(batch.column(text_col))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *(pa.array(rows[:, i]) for i in range(len(COUNTS)))], [*keep, *COUNTS])

    schema = T.StructType([*(docs.schema[c] for c in keep), *(T.StructField(c, T.LongType()) for c in COUNTS)])
    return docs.select(list(dict.fromkeys([*keep, text_col]))).mapInArrow(count, schema)


def features() -> dict[str, Column]:
    """Statistics that rules may test, as expressions over COUNTS."""
    per_word = lambda c: F.col(c) / F.greatest(F.col("n_words"), F.lit(1))
    per_char = lambda c: F.col(c) / F.greatest(F.col("word_chars"), F.lit(1))
    return {
        "words": F.col("n_words").cast("double"),
        "mean_word": per_word("word_chars"),
        "symbols_a_word": per_word("n_symbols"),
        "repeated_words": per_word("n_repeat_words"),
        "repeated_lines": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "words_a_line": F.col("n_words") / F.greatest(F.col("n_lines"), F.lit(1)),
        "capitals": per_char("n_upper"),
        "digits": per_char("n_digits"),
        "marks_a_word": per_word("n_marks"),
        "distinct_words": per_word("n_distinct"),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<'} {self.threshold:.6g}"


class DecisionList:
    """Ordered conjunctions for one class; anything else is the default class."""

    def __init__(self, rules: list[list[Condition]]):
        self.rules = rules

    def __str__(self) -> str:
        return "\n".join(["low if " + " and ".join(map(str, r)) for r in self.rules] + ["else high"])

    def verdict(self) -> Column:
        """True to keep: the first rule that holds rejects."""
        known, out = features(), F
        for rule in self.rules:
            test = F.lit(True)
            for c in rule:
                test = test & ((known[c.feature] >= c.threshold) if c.above else (known[c.feature] < c.threshold))
            out = out.when(test, F.lit(False))
        return F.lit(True) if out is F else out.otherwise(F.lit(True))


def _covers(rule: list[tuple[int, bool, float]], x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for f, above, t in rule:
        out &= (x[:, f] >= t) if above else (x[:, f] < t)
    return out


def _best_condition(x: np.ndarray, y: np.ndarray) -> tuple[float, tuple[int, bool, float] | None]:
    """The condition of the highest FOIL gain; one sort for each feature."""
    p0, n0 = y.sum(), len(y) - y.sum()
    best, found = 0.0, None
    base = np.log2(p0 / (p0 + n0))
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        v, positive = x[order, f], np.cumsum(y[order])
        cuts = np.flatnonzero(v[1:] > v[:-1])
        for above in (False, True):
            p = (p0 - positive[cuts]) if above else positive[cuts]
            n = (len(v) - 1 - cuts if above else cuts + 1) - p
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(p > 0, p * (np.log2(p / (p + n)) - base), 0)
            if len(gain) and gain.max() > best + 1e-9:
                i = int(np.argmax(gain))
                best, found = float(gain[i]), (f, above, float((v[cuts[i]] + v[cuts[i] + 1]) / 2))
    return best, found


def learn(x: np.ndarray, low: np.ndarray, names: list[str], max_rules: int = 16, max_conditions: int = 4, precision: float = 0.9, support: int = 5) -> DecisionList:
    """Sequential covering with reduced-error pruning."""
    rules: list[list[tuple[int, bool, float]]] = []
    fold = np.arange(len(x)) % 3
    left = np.ones(len(x), bool)
    while len(rules) < max_rules and (low & left).sum() >= support:
        grow, prune = left & (fold > 0), left & (fold == 0)
        rule: list[tuple[int, bool, float]] = []
        inside = grow.copy()
        while len(rule) < max_conditions and low[inside].any() and not low[inside].all():
            _, condition = _best_condition(x[inside], low[inside])
            if condition is None:
                break
            rule.append(condition)
            inside = grow & _covers(rule, x)
        def worth(r: list) -> float:
            c = _covers(r, x) & prune
            p, n = (low & c).sum(), (~low & c).sum()
            return (p - n) / (p + n) if p + n else -1.0
        while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
            rule.pop()
        covered = _covers(rule, x) & left
        if not rule or covered.sum() < support or low[covered].mean() < precision:
            break
        rules.append(rule)
        left &= ~covered
    return DecisionList([[Condition(names[f], above, t) for f, above, t in r] for r in rules])


def fit(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", max_labelled: int = MAX_LABELLED) -> DecisionList:
    """Learn from at most ``max_labelled`` labelled rows of ``stats``."""
    known = features()
    rows = stats.join(labels.where(F.col(label_col).isNotNull()).select(id_col, label_col), id_col)
    rows = rows.select(F.xxhash64(id_col).alias("__order"), *(c.alias(n) for n, c in known.items()), (F.col(label_col) == 0).alias("__low"))
    sample = rows.orderBy("__order").limit(max_labelled).toPandas()
    names = list(known)
    if sample.empty:
        return DecisionList([])
    return learn(sample[names].to_numpy(float), sample["__low"].to_numpy(bool), names)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def op6_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    stats = scratch.table(text_statistics(docs, ["doc_id"]), "statistics")
    rules = fit(stats, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    out = stats.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & rules.verdict())
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
