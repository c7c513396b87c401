"""Personal data: base patterns, plus terms that give away what the patterns protect.

Emails, addresses, cards and phone numbers are found in whole texts.  Each value is a protected
entity, and so is the group it belongs to (mail domain, first two parts of an address, first six
digits of a card, first four of a phone number), since single values are often unique.

How far a term discloses an entity is estimated from the corpus.  With N distinct texts, of which
e hold the entity, t the term and c both, the term's mutual information log2(N c / (e t)) is
compared with the entity's own information log2(N / e).  A ratio at or over the threshold counts
if it is hardly chance: Chernoff's bound on c or more meetings where e t / N are expected, times
the number of entities that a term is tried with, has to be ``CHANCE`` at most.  Such a term is
telling, and each of its occurrences in any text is a span of its own.  ``redact`` generalises entities to
their kind and removes such terms.

Copies and near copies are one piece of evidence, or what only a family of them holds would tell
a lot.  Texts that agree in one of ``BANDS`` bands of min-hashes of their five-word shingles are
linked, and of each component of links only the text with the least hash is counted.  Entities and
terms that cannot pass the bound whatever t is are left out before they are paired.  At most ``IN_TASKS`` telling terms (they are counted first) go to every task;
of more a bitmap does, and an exact join follows, with the same spans.  Terms are counted in an eighth
of the texts first: a count there is a lower bound, and both tests only get harder with more texts, so what
fails with it is ruled out for sure.  Counts of the others cover all texts: tasks add up texts that are alone, and
those that may be copies (by a bitmap of bounded size) are looked up exactly first.

Defined results: null and empty texts have no spans; texts of any length are searched whole; a
term is a word of digits, letters and characters beyond ASCII, A-Z lower-cased, with
``MIN_LETTERS`` characters at least and not of digits alone; words that overlap a base span are
no terms; of several telling entities any one suffices, so ties don't matter; repeated rows are
judged alike; input columns named like the results are replaced, others pass through; an empty
table gives an empty table.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.llm import graph, scratch
from newsloom.llm import textbatch as tb

KINDS = ("email", "ip", "card", "phone", "term")
#: Least characters of a term, the threshold of disclosure, and how likely a term may be told by chance.
MIN_LETTERS, DISCLOSURE, CHANCE = 4, 0.5, 0.001
#: Where x log(1 / x) - x + x x is largest: log(1 / x) = 2 - 2 x.
PEAK = 0.20318787
#: Words of a shingle, and bands of min-hashes: near copies of a similarity of 0.97 are linked all but once in 3000 times, texts of 0.3 once in 30.
SHINGLE, BANDS, ROWS = 5, 4, 4
#: One text in so many is counted first; it rules terms out and tells none.
SHARE = 8
#: Places of a bitmap at most (32 MB), and telling terms that go to every task (8 MB); of more only a bitmap does.
BITMAP, IN_TASKS = 1 << 28, 1 << 20

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)+")
_DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")


def _emails(text: str):
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            end = m.end()
        at = text.find("@", max(at + 1, end))


def _addresses(text: str):
    """Each four numbers of a dotted row, from its left end."""
    for m in _DOTTED.finditer(text):
        parts, at = m[0].split("."), m.start()
        for i in range(0, len(parts), 4):
            four = parts[i : i + 4]
            length = sum(map(len, four)) + len(four) - 1
            if len(four) == 4 and all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in four):
                yield at, at + length
            at += length + 1


def _luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(c), 10)) for c in even)) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) in code points, by start and then kind."""
    out = [(a, 0, b) for a, b in _emails(text)] if "@" in text else []
    out += [(a, 1, b) for a, b in _addresses(text)]
    for m in _DIGITS.finditer(text):
        if m.end() - m.start() >= 12:
            digits = _NOT_DIGIT.sub("", m[0])
            if 12 <= len(digits) <= 19 and _luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def _long(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _entities(text: str, spans: list[tuple[int, int, int]]) -> list[int]:
    """Hashes of the values found and of their groups."""
    found = set()
    for start, kind, end in spans:
        if kind == 0:
            value = text[start:end].lower()
            group = value.rpartition("@")[2]
        elif kind == 1:
            value = text[start:end]
            group = ".".join(value.split(".")[:2])
        else:
            value = _NOT_DIGIT.sub("", text[start:end])
            group = value[: 6 if kind == 2 else 4]
        found |= {_long(f"{KINDS[kind]}:{value}"), _long(f"{KINDS[kind]}s of {group}")}
    return sorted(found)


_SEEDS = tb.mix(np.arange(7, 7 + BANDS * ROWS, dtype=np.uint64))


def _bands(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hashes of bands of min-hashes, a row a text; of a text shorter than a shingle those of its words; 0 without words."""
    out = np.zeros((len(at) - 1, BANDS), np.uint64)
    counts = tb.gram_offsets(at, SHINGLE)
    long = np.flatnonzero(counts)
    if len(long):
        grams = tb.gram_hashes(words, SHINGLE)[tb.ranges(at[:-1], counts)]
        heads = (np.cumsum(counts) - counts)[long]
        for i, seed in enumerate(_SEEDS):
            out[long, i // ROWS] = tb.mix(out[long, i // ROWS] ^ np.minimum.reduceat(tb.mix(grams ^ seed), heads))
    for n in range(1, SHINGLE):
        rows = np.flatnonzero(np.diff(at) == n)
        if len(rows):
            out[rows] = tb.mix(tb.gram_hashes(words, n)[at[rows]])[:, None]
    return out


class _Terms:
    """The terms of a slice of texts: hash, row, and start and end in code points of the row's text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        low = tb.lower(data)
        starts, ends, at = tb.spans(low, offsets, tb.ALNUM_WORDS)
        points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        other = np.concatenate([[0], np.cumsum((data < 48) | (data > 57))])
        row = np.repeat(np.arange(len(offsets) - 1), np.diff(at))
        ok = (points[ends] - points[starts] >= MIN_LETTERS) & (other[ends] > other[starts])
        self.hash = tb.span_hashes(low, starts, ends).view(np.int64)[ok]
        self.row = row[ok]
        first = points[offsets[:-1]][self.row]
        self.start, self.end = points[starts[ok]] - first, points[ends[ok]] - first
        self.at = np.searchsorted(self.row, np.arange(len(offsets)))

    def apart(self, row: int, spans: list[tuple[int, int, int]], places: np.ndarray | None = None) -> np.ndarray:
        """Places of the row's terms (or of those given) that overlap none of the spans, which come by start."""
        here = np.arange(self.at[row], self.at[row + 1]) if places is None else places
        if not spans:
            return here
        before = np.searchsorted([s for s, _, _ in spans], self.end[here], side="left") - 1
        reach = np.maximum.accumulate([e for _, _, e in spans])
        return here[(before < 0) | (reach[np.maximum(before, 0)] <= self.start[here])]


_SPAN = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("kind", T.IntegerType()), T.StructField("end", T.LongType())]))
_ARROW_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
_WORDS = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("term", "start", "end")]))
_ARROW_WORDS = pa.list_(pa.struct([(c, pa.int64()) for c in ("term", "start", "end")]))


def _text_key(text_col: str) -> list[Column]:
    """Two hashes that tell texts apart."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return [F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b")]


def _distinct(docs: DataFrame, text_col: str) -> DataFrame:
    """(a, b, n, bands) of the distinct texts, with their number of rows."""

    def find(batches):
        for batch in batches:
            for first, end, data, offsets in tb.steps(batch.column("text")):
                starts, ends, at = tb.spans(low := tb.lower(data), offsets, tb.ALNUM_WORDS)
                bands = _bands(tb.span_hashes(low, starts, ends), at).view(np.int64)
                bands = pa.FixedSizeListArray.from_arrays(pa.array(bands.ravel()), BANDS).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(first, end - first) for c in ("a", "b")), bands], ["a", "b", "bands"])

    found = docs.select(*_text_key(text_col), F.col(text_col).alias("text")).mapInArrow(find, "a bigint, b bigint, bands array<bigint>")
    return scratch.table(found.groupBy("a", "b").agg(F.count("*").alias("n"), F.first("bands").alias("bands")), "distinct-texts")


def _followers(texts: DataFrame) -> DataFrame:
    """(a): texts that are near copies of one with a smaller hash, which stands for all of them."""
    members = texts.select("a", F.posexplode("bands").alias("at", "band")).where("band <> 0")
    hubs = members.groupBy("at", "band").agg(F.min("a").alias("hub"), F.max("a").alias("last")).where("hub < last")
    edges = members.join(scratch.table(hubs.select("at", "band", "hub"), "shared-bands"), ["at", "band"]).select(F.col("a").alias("u"), F.col("hub").alias("v"))
    return scratch.table(graph.components(edges).where("vertex <> component").select(F.col("vertex").alias("a")), "near-copies")


def _bitmap(numbers: DataFrame) -> np.ndarray:
    """Words of 64 places, two of which each of the table's numbers marks.

    There are 256 places for a number as long as BITMAP allows; beyond, more other numbers look marked."""
    n, places = numbers.count(), 1 << 16
    while places < 256 * n and places < BITMAP:
        places *= 2
    number = F.col(numbers.columns[0])
    at = F.explode(F.array(number, F.shiftrightunsigned(number, 32)))  # places is a power of two, so the remainder is a mask
    marked = numbers.select(at.alias("p")).select(F.col("p").bitwiseAND(F.lit(places - 1)).alias("p"))
    words = marked.groupBy(F.floor(F.col("p") / 64).alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(p % 64 as int)))").alias("bits")).toArrow()  # BITMAP / 64 rows at most
    bitmap = np.zeros(places // 64, np.int64)
    bitmap[words.column("w").to_numpy()] = words.column("bits").to_numpy()
    return bitmap


def _marked(bitmap: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Whether both places of each number are marked."""
    found = np.ones(len(numbers), bool)
    for at in (numbers, (numbers.view(np.uint64) >> np.uint64(32)).view(np.int64)):
        at = at & np.int64(64 * len(bitmap) - 1)
        found &= (bitmap.view(np.uint64)[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) > 0
    return found


def _holders(docs: DataFrame, followers: DataFrame, text_col: str) -> DataFrame:
    """(a, b, entities, terms) of the texts with entities that count."""

    def find(batches):
        for batch in batches:
            texts, keys, entities, held = batch.column("text"), [], [], []
            for first, end, data, offsets in tb.steps(texts):
                terms = None
                for i in range(first, end):
                    text = texts[i].as_py() or ""
                    if not (spans := base_spans(text)):
                        continue
                    terms = terms or _Terms(data, offsets)
                    keys.append(i)
                    entities.append(_entities(text, spans))
                    held.append(np.unique(terms.hash[terms.apart(i - first, spans)]))
            at, longs = pa.array(keys, pa.int64()), pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("a").take(at), batch.column("b").take(at), pa.array(entities, longs), pa.array(held, longs)], ["a", "b", "entities", "terms"])

    found = docs.select(*_text_key(text_col), F.col(text_col).alias("text")).mapInArrow(find, "a bigint, b bigint, entities array<bigint>, terms array<bigint>")
    return scratch.table(found.dropDuplicates(["a", "b"]).join(followers, "a", "left_anti"), "holders")


def _term_texts(docs: DataFrame, copies, followers: DataFrame, wanted: DataFrame, text_col: str, share: int = 1) -> DataFrame:
    """(term, n): texts that count and hold each wanted term, of all texts or of those whose hash a share has.

    ``copies`` is a broadcast bitmap of the texts that may be copies."""
    terms = docs.sparkSession.sparkContext.broadcast(_bitmap(scratch.table(wanted, "wanted-terms")))
    keyed = docs.select(*_text_key(text_col), F.col(text_col).alias("text")).where(F.pmod("b", F.lit(share)) == 0)

    def count(batches):
        for batch in batches:
            may = _marked(copies.value, batch.column("a").to_numpy())
            for first, end, data, offsets in tb.steps(batch.column("text")):
                found = _Terms(data, offsets)
                kept = np.flatnonzero(_marked(terms.value, found.hash))
                pairs = np.unique(np.stack([found.row[kept], found.hash[kept]], axis=1), axis=0)
                own = may[first:end][pairs[:, 0]]
                term, n = np.unique(pairs[~own, 1], return_counts=True)
                yield summed(term, n)
                rows = np.flatnonzero(may[first:end])
                cut = np.searchsorted(pairs[:, 0], np.stack([rows, rows + 1]))
                held = pa.array([pairs[x:y, 1] for x, y in cut.T], pa.list_(pa.int64()))
                at = pa.array(rows + first)
                yield pa.RecordBatch.from_arrays([pa.nulls(len(rows), pa.int64()), pa.nulls(len(rows), pa.int64()), batch.column("a").take(at), batch.column("b").take(at), held], ["term", "n", "a", "b", "terms"])

    def total(term, n):
        term, back = np.unique(term, return_inverse=True)
        return term, np.bincount(back, weights=n, minlength=len(term)).astype(np.int64)

    def added(batches):
        """Counts of a task's slices are added up before they are shuffled: a row for each term, unless a task has very many."""
        term, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for out in count(batches):
            if out.column("term").null_count:
                yield out
                continue
            term = np.concatenate([term, out.column("term").to_numpy()])
            n = np.concatenate([n, out.column("n").to_numpy()])
            if len(term) > 1 << 20:
                term, n = total(term, n)
                if len(term) > 1 << 19:
                    yield summed(term, n)
                    term, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        yield summed(*total(term, n))

    def summed(term, n):
        none = pa.nulls(len(term), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(term), pa.array(n), none, none, pa.nulls(len(term), pa.list_(pa.int64()))], ["term", "n", "a", "b", "terms"])

    found = scratch.table(keyed.mapInArrow(added, "term bigint, n bigint, a bigint, b bigint, terms array<bigint>"), "term-texts")
    single = found.where("term IS NOT NULL").select("term", "n")
    several = found.where("term IS NULL AND size(terms) > 0").dropDuplicates(["a", "b"]).join(followers, "a", "left_anti")
    several = several.select(F.explode("terms").alias("term"), F.lit(1).cast("long").alias("n"))
    return single.unionByName(several).groupBy("term").agg(F.sum("n").alias("n"))


def telling_terms(docs: DataFrame, text_col: str = "text", disclosure: float = DISCLOSURE) -> DataFrame:
    """(term): hashes of the terms that disclose an entity."""
    distinct = _distinct(docs, text_col)
    followers = _followers(distinct)
    held = _holders(docs, followers, text_col)
    keyed = held.withColumn("entity", F.explode("entities")).select("a", "b", "entity")
    worded = held.withColumn("term", F.explode("terms")).select("a", "b", "term")
    texts = float(max(distinct.count() - followers.count(), 1))
    entities = scratch.table(keyed.groupBy("entity").agg(F.count("*").alias("entity_texts")), "entities")
    common = scratch.table(worded.groupBy("term").agg(F.count("*").alias("k")), "holder-terms")
    tried = math.log2(max(entities.count(), 1) / CHANCE)

    def certain(met, expected):
        """Whether so many meetings are beyond chance with any of the entities."""
        return met * F.log2(met / expected) - (met - expected) * math.log2(math.e) >= tried

    # c <= e, c <= t and so at least c c / N are expected; the bound with that grows with c up to PEAK N, so n or
    # PEAK N meetings at most give the most there can be, and what fails with that cannot pass
    most = lambda n: F.least(F.col(n), F.lit(PEAK * texts))
    possible = lambda n: certain(most(n), most(n) ** 2 / texts)
    entities, common = entities.where(possible("entity_texts")), common.where(possible("k"))
    pairs = keyed.join(entities.select("entity"), "entity").join(worded.join(common, "term"), ["a", "b"]).groupBy("entity", "term", "k").agg(F.count("*").alias("both"))
    own = F.log2(texts / F.col("entity_texts"))
    tells = lambda met, expected: (own > 0) & (F.log2(met / expected) >= disclosure * own) & certain(met, expected)
    # at least k texts hold the term, and both tests only get harder with more
    pairs = pairs.join(entities, "entity").where(tells(F.col("both"), F.col("entity_texts") * F.col("k") / texts))
    pairs = scratch.table(pairs, "term-pairs")
    copied = distinct.where("n > 1").select("a").unionByName(followers)
    copies = docs.sparkSession.sparkContext.broadcast(_bitmap(scratch.table(copied, "copied-texts")))
    # most pairs are common words, of which few texts hold an entity: those that some of all texts rule out are not counted in all
    some = _term_texts(docs, copies, followers, pairs.select("term").distinct(), text_col, SHARE).withColumnRenamed("n", "some_texts")
    least = F.greatest(F.col("k"), F.coalesce("some_texts", F.lit(0)))
    pairs = scratch.table(pairs.join(some, "term", "left").where(tells(F.col("both"), F.col("entity_texts") * least / texts)).drop("some_texts"), "open-pairs")
    counted = pairs.join(_term_texts(docs, copies, followers, pairs.select("term").distinct(), text_col).withColumnRenamed("n", "term_texts"), "term")
    told = counted.where(tells(F.col("both"), F.col("entity_texts") * F.col("term_texts") / texts))
    return scratch.table(told.select("term").distinct(), "telling-terms")


def _scan(docs: DataFrame, keep: list[str], text_col: str, terms_held: np.ndarray, exact: bool) -> DataFrame:
    """``keep`` columns with ``base`` spans and the words that are telling, or that may be by a bitmap."""
    shared = docs.sparkSession.sparkContext.broadcast(terms_held)

    def chosen(hashes: np.ndarray) -> np.ndarray:
        if not exact:
            return np.flatnonzero(_marked(shared.value, hashes))
        if not len(shared.value):
            return np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(shared.value, hashes), len(shared.value) - 1)
        return np.flatnonzero(shared.value[at] == hashes)

    def find(batches):
        for batch in batches:
            texts, spans, words = batch.column(text_col), [], []
            for first, end, data, offsets in tb.steps(texts):
                terms = _Terms(data, offsets)
                hits = chosen(terms.hash)
                cut = np.searchsorted(terms.row[hits], np.arange(end - first + 1))
                for i in range(end - first):
                    base = base_spans(texts[first + i].as_py() or "")
                    spans.append([{"start": a, "kind": k, "end": b} for a, k, b in base])
                    at = terms.apart(i, base, hits[cut[i] : cut[i + 1]])
                    words.append([{"term": int(terms.hash[p]), "start": int(terms.start[p]), "end": int(terms.end[p])} for p in at])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(spans, _ARROW_SPAN), pa.array(words, _ARROW_WORDS)], [*keep, "base", "__words"])

    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField("base", _SPAN), T.StructField("__words", _WORDS)])
    return docs.select(list(dict.fromkeys([*keep, text_col]))).mapInArrow(find, schema)


def find_personal_data(docs: DataFrame, keep: list[str] | None = None, text_col: str = "text", disclosure: float = DISCLOSURE) -> DataFrame:
    """``keep`` columns of ``docs`` (all by default) with ``base`` and ``spans``: arrays of (start, kind, end)."""
    docs = docs.drop("base", "spans", "__words", "__row")
    keep = [c for c in (keep or docs.columns) if c in docs.columns]
    telling = telling_terms(docs, text_col, disclosure)
    union = lambda extra: F.array_sort(F.concat("base", F.coalesce(extra, F.array().cast(_SPAN))))
    if telling.count() <= IN_TASKS:
        held = np.sort(telling.toArrow().column("term").to_numpy())  # at most IN_TASKS numbers
        found = _scan(docs, keep, text_col, held, exact=True)
        extra = F.transform("__words", lambda w: F.struct(w["start"].alias("start"), F.lit(4).alias("kind"), w["end"].alias("end")))
        return found.withColumn("spans", union(extra)).select(*keep, "base", "spans")
    found = _scan(docs, keep, text_col, _bitmap(telling), exact=False).withColumn("__row", F.monotonically_increasing_id())
    found = scratch.table(found, "personal")  # numbers of written rows stay
    words = found.where(F.size("__words") > 0).select("__row", F.explode("__words").alias("x")).select("__row", "x.*")
    extra = words.join(telling, "term").groupBy("__row").agg(F.collect_set(F.struct("start", F.lit(4).alias("kind"), "end")).alias("__extra"))
    return found.join(extra, "__row", "left").withColumn("spans", union(F.col("__extra"))).select(*keep, "base", "spans")


def span_list(spans: str) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text_col: str = "text", spans_col: str = "spans") -> Column:
    """The text with entities generalised to their kind and telling terms removed, as an expression."""
    names = F.array(*(F.lit("" if k == "term" else f"[{k.upper()}]") for k in KINDS))
    text = F.coalesce(F.col(text_col), F.lit(""))
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def step(acc, s):
        piece = F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.element_at(names, s["kind"] + 1))
        return F.when(s["start"] < acc["at"], F.struct(acc["out"].alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))).otherwise(F.struct(piece.alias("out"), s["end"].alias("at")))

    return F.aggregate(spans_col, start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))


def op4_personal_data(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = find_personal_data(docs, keep=["doc_id"])
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    return out.select("doc_id", *map(count, range(4)), F.sha2(span_list("base"), 256).alias("base_sha256"), span_list("spans").alias("spans"))
