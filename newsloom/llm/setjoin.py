"""Exact n-gram Jaccard join by a token-group matrix.

Sets of 5-word shingles that share at least three quarters of their union are linked.  Copies
are one class.  The exact work is done for classes, and of two classes the larger one (by size,
then id) is the query:

1. *Groups.*  Classes that agree in a band of min-hash keys and are of similar size share a
   bucket; a class joins the largest of its buckets, so many near copies make few groups.
2. *Matrix.*  Under one order of tokens (frequent ones last) a link needs several shared tokens
   between the query's prefix and the shorter prefix that suffices for the smaller set.  The
   matrix holds the tokens of each group's union of such member prefixes, with the sizes of the
   members behind each token.  Tokens that one class alone holds are dropped, and tokens that the
   same classes hold are one column with a weight, so a shared passage counts as one.
3. *Bound.*  A query adds up the weights of the columns that it shares with each group that has
   members of a fitting size.  Groups below the least that a link needs are never opened.
4. *Opening.*  Members of qualifying groups are compared with the queries exactly, in blocks of
   bounded size.  A block returns the number of links of each query and member and edges that
   span what it links, so its rows grow with queries and members and not with their pairs.

Steps 1 and the token order only steer the work: whatever they choose, steps 2 to 4 find every
link, so components and numbers of links are exact.  The order comes from a sample of documents;
its table holds at most ``MAX_FREQUENT`` tokens.

No step gathers a key's rows in memory: counts are combined before shuffles, tokens stream in
sorted order, the matrix is joined by Spark, and groups are opened in chunks of at most ``BLOCK``
members or about ``BLOCK_TOKENS`` tokens.

Defined results: a text with fewer words than a shingle has them all as one; without words the
set is empty and linked with nothing; rows that repeat an id with an equal text are one
document, and where an id comes with different texts one of them stands for it; rows with a null
id have a set but no links; a text of any length is one set, held by one task; ties of size go by
id, ties of bucket size by the bucket's hash; an empty table gives an empty table.  Other input
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm import graph, scratch
from newsloom.llm import textbatch as tb

SHINGLE, PERCENT = 5, 75
#: Prefixes grow by a SPARE-th of a set, and so many shared tokens are needed.
SPARE = 32
BANDS, ROWS = 6, 2
SAMPLED, MAX_FREQUENT = 16, 1 << 18
BLOCK, BLOCK_TOKENS = 256, 1 << 20
_SEEDS = tb.mix(np.arange(101, 101 + BANDS * ROWS, dtype=np.uint64))
_ODD = tb.mix(np.arange(301, 301 + BANDS * ROWS, dtype=np.uint64)) | np.uint64(1)


def _sets(texts: pa.Array, size: int):
    """The sorted distinct shingle hashes of every text."""
    for first, end, data, offsets in tb.steps(texts):
        low = tb.lower(data)
        starts, ends, at = tb.spans(low, offsets, tb.BLANK_WORDS)
        words = tb.span_hashes(low, starts, ends)
        grams = tb.gram_hashes(words, size)
        for i in range(end - first):
            a, b = at[i], at[i + 1]
            if b - a >= size:
                yield np.unique(grams[a : b - size + 1])
            elif b > a:
                yield tb.gram_hashes(words[a:b], b - a)
            else:
                yield np.zeros(0, np.uint64)


def _sign(s: np.ndarray) -> tuple[np.ndarray, int, int]:
    """Mixed tokens, and two numbers that equal sets share."""
    m = tb.mix(s)
    return m, int(m.sum()) - (1 << 63), int(tb.mix(m ^ _SEEDS[0]).sum()) - (1 << 63)


def least_overlap(n: int) -> int:
    """Tokens that a set of n shares with any smaller or equal set that it is linked to."""
    return -(-PERCENT * n // 100)


def least_within(n: int) -> int:
    """Tokens that a set of n shares with any larger or equal set that it is linked to."""
    return -(-2 * PERCENT * n // (100 + PERCENT))


def needed(n: int) -> int:
    """Shared prefix tokens that a link has whose smaller set has n tokens."""
    return max(1, min(least_overlap(n), n // SPARE))


def _frequent(docs: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent tokens of a sample, sorted, and their counts: a hint for the order."""

    def emit(batches):
        for batch in batches:
            found = [s for s in _sets(batch.column("text"), size) if len(s)]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64))], ["token"])

    sampled = docs.where(F.pmod(F.xxhash64("text"), F.lit(SAMPLED)) == 0).select("text").dropDuplicates(["text"])
    counts = sampled.mapInArrow(tb.settled(emit), "token bigint").groupBy("token").count().where("count >= 3")
    top = counts.orderBy(F.desc("count"), "token").limit(MAX_FREQUENT).toPandas()  # at most MAX_FREQUENT rows
    tokens, n = top["token"].to_numpy(np.int64).view(np.uint64), top["count"].to_numpy(np.int64)
    order = np.argsort(tokens)
    return tokens[order], n[order]


def _sketches(docs: DataFrame, frequent: tuple[np.ndarray, np.ndarray], size: int) -> DataFrame:
    """One row per document; bands and prefix only for the first of equal sets in a task.

    The prefix is ``rare`` and then ``common`` tokens; its first ``own`` ones serve as a member's."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def emit(batches):
        tokens, counts = shared.value
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            n, a, b, bands, own, rare, common = [], [], [], [], [], [], []
            for s in _sets(batch.column("text"), size):
                m, x, y = _sign(s)
                n.append(len(s))
                a.append(x)
                b.append(y)
                if not len(s) or (x, y) in seen:
                    bands.append(None), own.append(None), rare.append(None), common.append(None)
                    continue
                if len(seen) < 1_000_000:
                    seen.add((x, y))
                keys = np.array([((m ^ seed) * odd).min() for seed, odd in zip(_SEEDS, _ODD, strict=True)]).reshape(BANDS, ROWS)
                scale = np.uint64(int(np.log(len(s)) / np.log(4 / 3)))
                bucket = tb.mix(keys[:, 0] ^ tb.mix(keys[:, 1])) ^ tb.mix(scale + (np.arange(BANDS, dtype=np.uint64) << np.uint64(32)))
                bands.append(bucket.view(np.int64))
                spare = needed(len(s))
                own.append(len(s) - least_within(len(s)) + spare)
                need = len(s) - least_overlap(len(s)) + spare
                if len(tokens):
                    at = np.minimum(np.searchsorted(tokens, s), len(tokens) - 1)
                    known = tokens[at] == s
                else:
                    at, known = np.zeros(len(s), np.int64), np.zeros(len(s), bool)
                first = s[~known][:need]
                rest = np.flatnonzero(known)
                rest = rest[np.lexsort((s[rest], counts[at[rest]]))][: need - len(first)] if len(first) < need else rest[:0]
                rare.append(first.view(np.int64))
                common.append(s[rest].view(np.int64))
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(bands, longs), pa.array(own, pa.int64()), pa.array(rare, longs), pa.array(common, longs)], ["id", "n", "a", "b", "bands", "own", "rare", "common"])

    return docs.mapInArrow(tb.settled(emit), "id bigint, n bigint, a bigint, b bigint, bands array<bigint>, own bigint, rare array<bigint>, common array<bigint>")


def _wanted_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(id, n, copies, tokens) of the wanted (id, a, b, copies) classes; a bitmap of bounded size spares the rest."""
    bits = 1 << 16
    n = wanted.count()
    while bits < 16 * n and bits < 1 << 26:
        bits *= 2
    place = F.pmod(F.xxhash64("id"), F.lit(bits))
    words = wanted.select(place.alias("p")).groupBy(F.floor(F.col("p") / 64).alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(p % 64 as int)))").alias("bits")).toPandas()  # at most 2^20 rows
    bitmap = np.zeros(bits // 64, np.int64)
    bitmap[words["w"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64)
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def emit(batches):
        bitmap = shared.value.view(np.uint64)
        for batch in batches:
            p = batch.column("p").to_numpy(zero_copy_only=False).astype(np.int64)
            batch = batch.filter(pa.array(((bitmap[p >> 6] >> (p & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)))
            ids, a, b, sets = [], [], [], []
            for doc, s in zip(batch.column("id").to_pylist(), _sets(batch.column("text"), size), strict=True):
                _, x, y = _sign(s)
                ids.append(doc)
                a.append(x)
                b.append(y)
                sets.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(sets, pa.binary())], ["id", "a", "b", "tokens"])

    found = docs.where(F.col("id").isNotNull()).withColumn("p", place.cast("int")).mapInArrow(tb.settled(emit), "id bigint, a bigint, b bigint, tokens binary")
    found = found.join(wanted.select("id", "a", "b", "copies"), ["id", "a", "b"]).select("id", "copies", "tokens")
    return scratch.table(found.dropDuplicates(["id"]), "sets")


class _Members:
    """Members of a block: an index of their tokens, their links so far, and what is connected."""

    def __init__(self, rows: list[tuple[int, int, np.ndarray]]):
        self.ids = np.array([r[0] for r in rows], np.int64)
        self.copies = np.array([r[1] for r in rows], np.int64)
        self.sizes = np.array([len(r[2]) for r in rows], np.int64)
        flat = np.concatenate([r[2] for r in rows])
        order = np.argsort(flat, kind="stable")
        self.flat, self.owner = flat[order], np.repeat(np.arange(len(rows)), self.sizes)[order]
        self.links = np.zeros(len(rows), np.int64)
        self.label = np.arange(len(rows))

    def linked(self, doc: int, s: np.ndarray) -> np.ndarray:
        """Places of the members, before the query by size and id, that the query is linked to."""
        low, high = np.searchsorted(self.flat, s, "left"), np.searchsorted(self.flat, s, "right")
        common = np.bincount(self.owner[tb.ranges(low, high - low)], minlength=len(self.ids))
        before = (self.sizes < len(s)) | (self.sizes == len(s)) & (self.ids < doc)
        return np.flatnonzero(before & (100 * common >= PERCENT * (len(s) + self.sizes - common)))

    def connect(self, at: np.ndarray) -> np.ndarray:
        """One member for each part that these members join; they are one part from now on."""
        parts = np.unique(self.label[at])
        self.label[np.isin(self.label, parts)] = parts[0]
        return self.ids[parts]


def _compare(blocks: DataFrame, sets: DataFrame) -> DataFrame:
    """(u, v, links): edges that span the links (links is 0), and numbers of links (v is null).

    blocks: (group, m, q, role, id), members with role 0 and queries with role 1."""
    rows = blocks.join(sets, "id").repartition("group", "m", "q").sortWithinPartitions("group", "m", "q", "role")

    def emit(batches):
        key, rows, members = None, [], None

        def totals():
            at = np.flatnonzero(members.links) if members is not None else []
            return [(int(members.ids[i]), None, int(members.links[i])) for i in at]

        def batch_of(out):
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in range(3)], ["u", "v", "links"])

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("group", "m", "q", "role", "id", "copies")]
            tokens = batch.column("tokens")
            out: list[tuple] = []
            for i, (g, m, q, role, doc, copies) in enumerate(zip(*columns, strict=True)):
                if (g, m, q) != key:
                    out += totals()
                    key, rows, members = (g, m, q), [], None
                s = np.frombuffer(tokens[i].as_py(), np.uint64)
                if role == 0:
                    rows.append((doc, copies, s))
                    continue
                if members is None:
                    if not rows:
                        continue
                    members, rows = _Members(rows), []
                if len(at := members.linked(doc, s)):
                    members.links[at] += copies
                    out.append((doc, None, int(members.copies[at].sum())))
                    out += [(doc, int(v), 0) for v in members.connect(at)]
            if out:
                yield batch_of(out)
        yield batch_of(totals())

    return rows.select("group", "m", "q", "role", "id", "copies", "tokens").mapInArrow(tb.settled(emit), "u bigint, v bigint, links bigint")


def _blocks(members: DataFrame, queries: DataFrame) -> DataFrame:
    """Chunks of the (group, id, n) members and queries of each group, and the blocks of either."""
    chunks = F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / BLOCK_TOKENS))
    count = lambda df, c: df.groupBy("group").agg(chunks.alias(c))
    chunks = scratch.table(count(members, "ms").join(count(queries, "qs"), "group"), "chunks")
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n).cast("int") - 1))
    own = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    left = members.join(chunks, "group").select("group", own("ms").alias("m"), spread("qs").alias("q"), F.lit(0).alias("role"), "id")
    right = queries.join(chunks, "group").select("group", spread("ms").alias("m"), own("qs").alias("q"), F.lit(1).alias("role"), "id")
    return left.unionByName(right)


def _groups(classes: DataFrame) -> DataFrame:
    """(id, group): the largest bucket of each class; classes alone in all of theirs are left out."""
    held = classes.select("id", F.explode("bands").alias("bucket"))
    many = scratch.table(held.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1"), "buckets")
    best = F.max(F.struct("size", "bucket"))
    return scratch.table(held.join(many, "bucket").groupBy("id").agg(best.alias("x")).select("id", F.col("x.bucket").alias("group")), "groups")


def _shared_tokens(rows: DataFrame) -> DataFrame:
    """The (token, id, member) rows of tokens that two classes or more hold; tokens stream in order."""

    def emit(batches):
        held, gone = None, False  # the last row so far, and whether it went out
        for batch in batches:
            t, v, w = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("token", "id", "member"))
            if held is not None:
                t, v, w = np.concatenate([held[0], t]), np.concatenate([held[1], v]), np.concatenate([held[2], w])
            same = t[1:] == t[:-1]
            many = np.concatenate([[gone], same])
            many[:-1] |= same
            out = many.copy()
            out[0] &= not gone
            if out.any():
                yield pa.RecordBatch.from_arrays([pa.array(t[out]), pa.array(v[out]), pa.array(w[out])], ["token", "id", "member"])
            held, gone = (t[-1:], v[-1:], w[-1:]), bool(many[-1])

    return rows.repartition("token").sortWithinPartitions("token").mapInArrow(tb.settled(emit), "token bigint, id bigint, member boolean")


def _columns(held: DataFrame) -> DataFrame:
    """(token, id, member, weight): of tokens that equal sets of classes hold, one and their number.

    Sets are equal by count and two 64-bit exclusive ors of hashed rows."""
    by_token = held.groupBy("token").agg(F.bit_xor(F.xxhash64("id", "member")).alias("x"), F.bit_xor(F.xxhash64("member", "id", F.lit(1))).alias("y"), F.count("*").alias("k"), F.bool_or("member").alias("asked"))
    columns = by_token.where("asked AND k > 1").groupBy("x", "y", "k").agg(F.min("token").alias("token"), F.count("*").alias("weight"))
    return held.join(scratch.table(columns.select("token", "weight"), "columns"), "token")


def _qualifying(held: DataFrame, vertices: DataFrame) -> DataFrame:
    """(group, id, n): queries with the groups that the bound doesn't exclude."""
    held = scratch.table(_columns(held).join(vertices.select("id", "n", "group"), "id"), "matrix")
    matrix = held.where("member").groupBy("token", "group", "weight").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    fits = (F.col("low") <= F.col("n")) & (100 * F.col("high") >= PERCENT * F.col("n"))
    met = held.select("token", "id", "n").join(matrix, "token").where(fits).groupBy("id", "n", "group").agg(F.sum("weight").alias("tokens"), F.min("low").alias("low"))
    least = F.greatest("low", F.ceil(F.col("n") * PERCENT / 100))
    need = F.greatest(F.lit(1), F.least(F.ceil(least * PERCENT / 100), F.floor(least / SPARE)))
    return met.where(F.col("tokens") >= need).select("group", "id", "n")


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE) -> DataFrame:
    """(id_col, n_shingles, component_id, n_links) of every row; links are to other rows, copies among them."""
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = scratch.table(_sketches(docs, _frequent(docs, size), size), "sketches")
    full = rows.where("n > 0 AND id IS NOT NULL")
    stands = F.min(F.when(F.col("bands").isNotNull(), F.col("id")))
    one = full.select("id", "a", "b", "bands").groupBy("a", "b").agg(stands.alias("id"), F.min("id").alias("first"), F.countDistinct("id").alias("copies"))
    signs = scratch.table(one, "signs")
    one = signs.groupBy("id").agg(F.min(F.struct("a", "b", "copies")).alias("s")).select("id", "s.*")
    classes = full.where("bands IS NOT NULL").join(one, ["id", "a", "b"]).dropDuplicates(["id"])
    classes = scratch.table(classes, "classes")
    vertices = classes.select("id", "n", "a", "b", "copies").join(_groups(classes), "id", "left").withColumn("group", F.coalesce("group", F.xxhash64("id", F.lit("alone"))))
    vertices = scratch.table(vertices, "vertices")

    rare = _shared_tokens(classes.select("id", "own", F.posexplode("rare").alias("at", "token")).select("token", "id", (F.col("at") < F.col("own")).alias("member")))
    common = classes.where("size(common) > 0").select("id", (F.col("own") - F.size("rare")).alias("own"), F.posexplode("common").alias("at", "token")).select("token", "id", (F.col("at") < F.col("own")).alias("member"))
    held = scratch.table(rare.unionByName(common), "shared-tokens")

    many = vertices.groupBy("group").agg(F.count("*").alias("size"))
    queries = _qualifying(held, vertices).join(many, "group")
    own = vertices.select("id", F.col("group").alias("mine"))
    queries = queries.join(own, "id").where("size > 1 OR group <> mine")  # a class alone in its group doesn't meet itself
    queries = scratch.table(queries.select("group", "id", "n"), "queries")
    opened = scratch.table(vertices.join(queries.select("group").distinct(), "group").select("group", "id", "n"), "opened")
    wanted = vertices.select("id", "a", "b", "copies").join(opened.select("id").unionByName(queries.select("id")).distinct(), "id")
    sets = _wanted_sets(docs, scratch.table(wanted, "wanted"), size)
    found = scratch.table(_compare(_blocks(opened, queries), sets), "links")
    roots = graph.components(found.where("v IS NOT NULL").select("u", "v"))
    counts = found.where("links > 0").groupBy(F.col("u").alias("id")).agg(F.sum("links").alias("links"))

    named = signs.join(roots.withColumnRenamed("vertex", "id"), "id", "left").withColumn("root", F.coalesce("component", "id")).join(counts, "id", "left")
    firsts = named.groupBy("root").agg(F.min("first").alias("component_id"))
    named = named.join(firsts, "root").select("a", "b", "component_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    named = scratch.table(named, "named")
    scratch.discard(signs, classes, vertices, held, queries, opened, sets, found)
    out = rows.select("id", "n", "a", "b").join(named, ["a", "b"], "left")
    linked = (F.col("n") > 0) & F.col("id").isNotNull()
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(linked, F.coalesce("component_id", "id")).otherwise(F.col("id")).alias("component_id"), F.when(linked, F.coalesce("n_links", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("n_links"))


def op9_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return similar_documents(scratch.given(spark, f"{sf_dir}/documents.parquet").select("doc_id", "text"))
