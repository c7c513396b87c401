"""The trie of conversation prefixes, by splitters, sorted shards and a skeleton.

1. A conversation is one row: its id, a digest of 16 bytes for each turn (its path) and the code
   points of each text.  Texts are hashed where they are read; no shuffle carries them.
2. Paths and ids are cut into ranges by splitters, which a sample by hash picks.  A node whose
   members lie in two ranges is a prefix of the splitter between them, so the splitters' paths
   are a trie of all such nodes, the skeleton.  It goes to every task: it has one node at most
   for each splitter and turn, and there are ``MAX_SHARDS`` splitters at most.
3. Tasks sort their ranges and finish every node outside the skeleton.  Of skeleton nodes they
   have a part of the members, kept as one row of counts for each range, and of the ids that end
   there runs of ``RUN``.  The parts are added up by node; runs of ids are hashed as a sorted
   stream.  Sums over subtrees of the skeleton follow from its nodes' own sums.

Equal conversations are told apart by id, so a conversation that a third of the table repeats
is cut into ranges like all others.  Splitters decide who works on what, never a result.

Defined results: turns with equal numbers are ordered by their digest, null numbers come first;
a null role or text is empty; rows that repeat a turn are turns of their own; rows with a null
conversation id belong to none and are left out; an empty table gives no nodes, not even a root;
a text's length costs its hash alone; a conversation's digests, 20 bytes a turn, have to fit in a
task.  Other columns are ignored, so names cannot clash.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm import scratch

#: Conversations of a range, about, and the most ranges there are; beyond that ranges grow.
SHARD = 4096
MAX_SHARDS = 1 << 14
#: Sampled paths for each range.
SAMPLE = 16
#: Ids in one run of members that end at a skeleton node.
RUN = 1 << 15
#: Nodes that a task gathers before it hands them on.
OUT = 1 << 14
STEP = 16
_MARKS = 1 << 20
_NODES = "kind int, conv_id bigint, depth bigint, parent_conv_id bigint, parent int, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends string"


def turn_digest(role: Column, text: Column) -> Column:
    """Hex digest of a turn; the role's length keeps role and text apart."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    return F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))


def paths(turns: DataFrame) -> DataFrame:
    """(conv_id, path, sizes) of (conv_id, turn, role, text) rows."""
    size = F.length(F.coalesce("text", F.lit("")))
    one = turns.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), F.struct("turn", turn_digest(F.col("role"), F.col("text")).alias("digest"), size.alias("size")).alias("t"))
    rows = one.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    return rows.select("conv_id", F.unhex(F.array_join(F.col("t.digest"), "")).alias("path"), F.col("t.size").alias("sizes"))


def rebuilt(talks: DataFrame, every: int = 100, most: int = 6) -> DataFrame:
    """Each conversation with its first turns taken from the one whose id is the next lower multiple of ``every``.

    The number of turns is the id's CRC-32 modulo ``most``, so only short heads of few rows are joined."""
    heads = talks.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("__base"), F.substring("path", 1, STEP * (most - 1)).alias("__path"), F.slice("sizes", 1, most - 1).alias("__sizes"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    rows = talks.withColumn("__h", h).join(heads, F.col("conv_id") - F.col("conv_id") % every == F.col("__base"), "left")
    head = F.coalesce(F.expr(f"substring(__path, 1, {STEP} * __h)"), F.lit(b""))
    first = F.coalesce(F.slice("__sizes", F.lit(1), F.col("__h")), F.array().cast("array<int>"))
    own = F.expr(f"substring(path, {STEP} * __h + 1)")
    return rows.select("conv_id", F.concat(head, own).alias("path"), F.concat(first, F.slice("sizes", F.col("__h") + 1, F.size("sizes"))).alias("sizes"))


class Skeleton:
    """The trie of splitter paths: children by digest, node 0 is the root."""

    def __init__(self, splitters: list[tuple[bytes, int]]):
        self.children: list[dict[bytes, int]] = [{}]
        self.parents, self.depths = [-1], [0]
        for path, _ in splitters:
            node = 0
            for at in range(0, len(path), STEP):
                digest = path[at : at + STEP]
                if digest not in self.children[node]:
                    self.children[node][digest] = len(self.children)
                    self.children.append({})
                    self.parents.append(node)
                    self.depths.append(self.depths[node] + 1)
                node = self.children[node][digest]


def choose_splitters(rows: DataFrame, shard: int | None = None) -> list[tuple[bytes, int]]:
    """Sorted (path, conv_id) between ranges, from a sample by hash of a size that is known beforehand."""
    n, shard = rows.count(), shard or SHARD
    shards = min(MAX_SHARDS, -(-n // shard))
    if shards < 2:
        return []
    mark = min(_MARKS, -(-SAMPLE * shards * _MARKS // n))
    seen = sorted((bytes(r[0]), r[1]) for r in rows.where(F.pmod(F.xxhash64("conv_id"), F.lit(_MARKS)) < mark).select("path", "conv_id").collect())
    return sorted({seen[len(seen) * i // shards] for i in range(1, shards)}) if seen else []


def _place(rows: DataFrame, splitters: list[tuple[bytes, int]]) -> DataFrame:
    """``rows`` with the number of their range."""

    def place(batches):
        for batch in batches:
            ids, ways = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            shard = pa.array([bisect_right(splitters, (way, i)) for way, i in zip(ways, ids, strict=True)], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, shard], names=["conv_id", "path", "sizes", "shard"])

    return rows.mapInArrow(place, "conv_id bigint, path binary, sizes array<int>, shard int")


class _Node:
    __slots__ = ("bone", "children", "done", "ends", "first", "leaves", "members", "saved", "size")

    def __init__(self, size: int, bone: int):
        self.size, self.bone, self.first = size, bone, None
        self.members = self.children = self.leaves = self.saved = 0
        self.ends, self.done = [], []


class _Shard:
    """Nodes of one sorted range, closed as soon as the path leaves them.

    Closed nodes wait in their parent until its least member is known; parents in the skeleton
    know theirs only after the reduction, so their children carry the node's number instead."""

    def __init__(self, skeleton: Skeleton):
        self.skeleton, self.out = skeleton, []
        self.path, self.open = b"", [_Node(0, 0)]

    def add(self, conv: int, path: bytes, sizes: list[int]) -> None:
        same, most = 0, min(len(path), len(self.path)) // STEP
        while same < most and path[STEP * same : STEP * same + STEP] == self.path[STEP * same : STEP * same + STEP]:
            same += 1
        self.close(same)
        for at in range(same, len(path) // STEP):
            bone = self.open[-1].bone
            bone = self.skeleton.children[bone].get(path[STEP * at : STEP * at + STEP], -1) if bone >= 0 else -1
            self.open.append(_Node(sizes[at], bone))
        self.path = path
        for node in self.open:
            node.members += 1
            if node.first is None or conv < node.first:
                node.first = conv
        ends, last = self.open[-1].ends, self.open[-1]
        ends.append(conv)
        if last.bone >= 0 and len(ends) >= RUN:
            self.run(last)

    def run(self, node: _Node) -> None:
        if node.ends:
            self.out.append((2, node.ends[0], 0, None, node.bone, 0, 0, 0, 0, ",".join(map(str, node.ends))))
            node.ends = []

    def close(self, depth: int) -> None:
        while len(self.open) - 1 > depth:
            node, at = self.open.pop(), len(self.open)
            above = self.open[-1]
            if node.bone >= 0:
                self.bone(node)
                continue
            if not node.children:
                node.leaves = 1
            node.saved += (node.members - 1) * node.size
            self.out += [(*row[:3], node.first, *row[4:]) for row in node.done]
            row = (0, node.first, at, None, above.bone, node.members, node.children, node.leaves, node.saved, hashlib.sha256(",".join(map(str, node.ends)).encode()).hexdigest())
            (self.out if above.bone >= 0 else above.done).append(row)
            above.children += 1
            above.leaves += node.leaves
            above.saved += node.saved

    def bone(self, node: _Node) -> None:
        """A part of a skeleton node: what lies below it outside the skeleton, and its members."""
        self.run(node)
        self.out.append((1, node.first, 0, None, node.bone, node.members, node.children, node.leaves, node.saved, str(node.size)))  # the text's size goes where ids go

    def end(self) -> None:
        self.close(0)
        self.bone(self.open[0])


def _finish(rows: DataFrame, skeleton: Skeleton, shards: int) -> DataFrame:
    """Rows of kind 0 (nodes), 1 (parts of skeleton nodes) and 2 (runs of ids that end at one)."""

    def tell(out):
        return pa.RecordBatch.from_pylist([dict(zip(names, row, strict=True)) for row in out], schema=schema)

    names = [c.split()[0] for c in _NODES.split(", ")]
    schema = pa.schema([(c.split()[0], {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string()}[c.split()[1]]) for c in _NODES.split(", ")])

    def finish(batches):
        shard, now = None, None
        for batch in batches:
            for s, conv, path, sizes in zip(*(batch.column(c).to_pylist() for c in ("shard", "conv_id", "path", "sizes")), strict=True):
                if s != now:
                    if shard is not None:
                        shard.end()
                        yield tell(shard.out)
                    shard, now = _Shard(skeleton), s
                shard.add(conv, path, sizes)
                if len(shard.out) >= OUT:
                    yield tell(shard.out)
                    shard.out = []
        if shard is not None:
            shard.end()
            yield tell(shard.out)

    return rows.repartition(max(1, shards), "shard").sortWithinPartitions("shard", "path", "conv_id").mapInArrow(finish, _NODES)


def _hash_runs(runs: DataFrame) -> DataFrame:
    """(bone, sha) of runs of ids, a stream by node and first id."""

    def digest(batches):
        now, sha = None, None
        for batch in batches:
            done = []
            for bone, _, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bone != now:
                    if sha is not None:
                        done.append((now, sha.hexdigest()))
                    now, sha = bone, hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in done], pa.int32()), pa.array([s for _, s in done])], names=["bone", "sha"])
        if sha is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([sha.hexdigest()])], names=["bone", "sha"])

    dealt = runs.select(F.col("parent").alias("bone"), "conv_id", "ends").repartition("bone").sortWithinPartitions("bone", "conv_id")
    return dealt.mapInArrow(digest, "bone int, sha string")


def _reduce(spark: SparkSession, parts: DataFrame, skeleton: Skeleton) -> DataFrame:
    """Whole skeleton nodes, with ``bone``: parts added up by node, then sums over the skeleton's subtrees.

    The driver holds one row for each skeleton node."""
    own = parts.where("kind = 1").groupBy(F.col("parent").alias("bone")).agg(F.min("conv_id"), F.sum("n_convs"), F.sum("n_children"), F.sum("n_leaves"), F.sum("saved_tokens"), F.max("ends"))
    got = {r[0]: list(r[1:]) for r in own.collect()}
    sha = {r[0]: r[1] for r in _hash_runs(parts.where("kind = 2")).collect()}
    none = hashlib.sha256(b"").hexdigest()
    rows = []
    for bone in range(len(skeleton.parents) - 1, -1, -1):  # children have higher numbers than parents
        if bone not in got:
            continue
        first, members, children, leaves, saved, size = got[bone]
        if not children:
            leaves = 1
        saved += (members - 1) * int(size)
        above = skeleton.parents[bone]
        if above >= 0:
            up = got[above]
            up[2] += 1
            up[3] += leaves
            up[4] += saved
        rows.append((bone, first, skeleton.depths[bone], got[above][0] if above >= 0 else None, members, children, leaves, saved, sha.get(bone, none)))
    return spark.createDataFrame(rows, "bone int, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string")


def prefix_trie(rows: DataFrame, shard: int | None = None) -> DataFrame:
    """A row for each node of the trie of (conv_id, path, sizes) rows, one row a conversation.

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256); ``rows`` has to be a
    kept table, since it is read for the splitters and again for the ranges."""
    splitters = choose_splitters(rows, shard)
    skeleton = Skeleton(splitters)
    parts = scratch.table(_finish(_place(rows, splitters), skeleton, len(splitters) + 1), "trie-parts")
    bones = _reduce(rows.sparkSession, parts, skeleton)
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    above = bones.select(F.col("bone").alias("parent"), F.col("conv_id").alias("__above"))
    nodes = parts.where("kind = 0").withColumnRenamed("ends", "ends_sha256").join(above, "parent", "left").withColumn("parent_conv_id", F.coalesce("__above", "parent_conv_id"))
    return nodes.select(names).unionByName(bones.select(names))


def op12_prefix_trie(spark, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    talks = scratch.table(paths(turns), "paths")
    rows = scratch.table(rebuilt(talks), "rebuilt")
    scratch.discard(talks)
    return prefix_trie(rows)


def _crc(text: str) -> str:
    """DuckDB has no CRC-32: bytes are folded in, eight shifts each."""
    step = "xor(c, b)"
    for _ in range(8):
        step = f"list_transform([{step}], lambda z: xor(z >> 1, CASE WHEN z & 1 = 1 THEN 3988292384 ELSE 0 END))[1]"
    codes = f"list_transform(string_split({text}, ''), lambda s: CAST(ascii(s) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), lambda c, b: {step}), 4294967295)"


OP12_SQL = f"""
WITH t AS (
  SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS own FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT *, CAST({_crc("CAST(conv_id AS VARCHAR)")} % 6 AS INT) AS h FROM t),
r AS (
  SELECT h.conv_id, list_concat(coalesce(list_slice(b.own, 1, h.h), []), list_slice(h.own, h.h + 1, len(h.own))) AS p
  FROM h LEFT JOIN t b ON b.conv_id = h.conv_id - h.conv_id % 100),
m AS (SELECT conv_id, p AS whole, unnest(range(len(p) + 1)) AS depth FROM r),
n AS (
  SELECT list_slice(whole, 1, depth) AS p, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    coalesce(sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE len(whole) = depth), '')), '') AS ends_sha256
  FROM m GROUP BY ALL),
c AS (SELECT list_slice(p, 1, depth - 1) AS above, count(*) AS n FROM n WHERE depth > 0 GROUP BY 1),
w AS (
  SELECT n.*, coalesce(c.n, 0) AS n_children, CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * length(p[depth].t) END AS saved
  FROM n LEFT JOIN c ON c.above = n.p),
u AS (SELECT unnest(range(depth + 1)) AS d, p, saved, n_children FROM w),
s AS (SELECT list_slice(p, 1, d) AS p, d, sum(saved) AS saved, count(*) FILTER (WHERE n_children = 0) AS leaves FROM u GROUP BY ALL)
SELECT w.conv_id, w.depth, a.conv_id AS parent_conv_id, w.n_convs, w.n_children, s.leaves AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, w.ends_sha256
FROM w JOIN s ON s.p = w.p LEFT JOIN n a ON w.depth > 0 AND a.p = list_slice(w.p, 1, w.depth - 1)
"""
