"""Product codes of vectors: k-means by parts, with adaptive distance bounds kept between rounds.

Components become integers, vectors are cut into equal parts, and every part position has a
codebook of its own.  A round gives every part its nearest entry and moves each entry to the
mean of its parts.  Between rounds a row keeps for each part its entry, an upper bound of the
distance to it, the b next entries in order with a lower bound for each, and one outer bound for
all others.  A round moves the bounds by how far entries moved; lower bounds are made ordered
from the end, so that each holds for its entry and all after it.  Where the upper bound is below
the first of them nothing changes; else the distance is verified in integers against as many
entries as are not ruled out, or against all of them.  All bounds are integers, rounded to the
safe side, and ties go to the lower index, so codes are those of a plain search.

b starts at ``BOUNDS`` and shrinks: after each round it becomes the least number that leaves
at most one part in 64 to be compared with all entries.

Each round is one pass that writes rows with their new state, and for each task the sums of its
parts by entry, which are added up by slot.  The driver holds the codebooks and one sum for each of
their components.  The first codebook is the least ids' vectors, of which a task hands on as
many as a codebook has.

Defined results: vectors that are null or hold a null or non-finite component go, and so do those
of another length than the most frequent one that the parts divide (the longer of ties).  Rows
that repeat an id are coded one by one; for the first codebook an id counts once, with its least
vector, and null ids come last.  Fewer vectors than entries make a smaller codebook.  Components
beyond ``_limit`` (2 ** 26 for 64 components), whose squares no long could sum, stand for the limit.
An empty table gives no rows.  Null labels are one label.  Sums beyond a long are null.
Other columns are ignored, so names cannot clash.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm import scratch

PARTS = 4
ENTRIES = 256
ROUNDS = 4
#: Entries that a part keeps a lower bound of, at first.
BOUNDS = 16
#: Vectors that are worked on at once in a task.
STEP = 4096
_ROWS = "vec_id bigint, label string, ints binary, state binary, sums binary"
_FAR = (1 << 31) - 1  # beyond any distance; fits four bytes


def _limit(length: int) -> int:
    """Largest component whose squared differences add up to a long over a whole vector."""
    return 1 << min(27, (61 - int(np.ceil(np.log2(max(length, 1))))) // 2 - 1)


def _valid(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Flat values, starts and lengths of a list column; vectors to leave out have the length -1."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = column.offsets.to_numpy().astype(np.int64)
    child = column.values
    starts, lengths = offsets[:-1], np.diff(offsets)
    values = child.to_numpy(zero_copy_only=False).astype(np.float64)  # nulls read as nan
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    lengths = np.where(bad[starts + lengths] > bad[starts], -1, lengths)
    return values, starts, np.where(column.is_valid().to_numpy(zero_copy_only=False), lengths, -1)


def _integers(values: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    limit = _limit(length)
    found = values[starts[:, None] + np.arange(length)] if len(starts) else np.zeros((0, length))
    return np.clip(np.floor(found * 1024), -limit, limit).astype(np.int64)


def first_entries(vectors: DataFrame, parts: int, entries: int) -> tuple[int, np.ndarray]:
    """Length of the vectors to code, and the vectors of the least ids, as integers."""

    def least(batches):
        counts: Counter[int] = Counter()
        best: dict[int, dict] = {}
        for batch in batches:
            values, starts, lengths = _valid(batch.column(1))
            ids = batch.column(0).to_pylist()
            for length in np.unique(lengths[(lengths > 0) & (lengths % parts == 0)]).tolist():
                rows = np.flatnonzero(lengths == length)
                counts[length] += len(rows)
                held = best.setdefault(length, {})
                order = lambda i: (i is None, i or 0)
                worst = order(max(held, key=order)) if len(held) >= entries else None
                near = [r for r in rows.tolist() if worst is None or order(ids[r]) <= worst]
                for r, vector in zip(near, _integers(values, starts[near], length).tolist(), strict=True):
                    held[ids[r]] = min(held.get(ids[r], vector), vector)
                for i in sorted(held, key=order)[entries:]:
                    del held[i]
        for length, held in best.items():
            yield pa.RecordBatch.from_pydict(
                {"length": [length] * len(held), "n": [counts[length], *[0] * (len(held) - 1)], "vec_id": list(held), "vector": list(held.values())},
                schema=pa.schema([("length", pa.int32()), ("n", pa.int64()), ("vec_id", pa.int64()), ("vector", pa.list_(pa.int64()))]),
            )

    found = scratch.table(vectors.select(F.col("vec_id").cast("long"), "embedding").mapInArrow(least, "length int, n bigint, vec_id bigint, vector array<bigint>"), "first-entries")
    top = found.groupBy("length").agg(F.sum("n").alias("n")).orderBy(F.col("n").desc(), F.col("length").desc()).first()
    if top is None:
        return 0, np.zeros((0, 0), np.int64)
    first = found.where(F.col("length") == top["length"]).groupBy("vec_id").agg(F.min("vector").alias("vector")).orderBy(F.col("vec_id").asc_nulls_last()).limit(entries).collect()
    scratch.discard(found)
    return top["length"], np.array([r["vector"] for r in first], np.int64).reshape(len(first), top["length"])


def _root(squares: np.ndarray, up: bool = False) -> np.ndarray:
    """Integer square roots, rounded down or up."""
    r = np.sqrt(squares.astype(np.float64)).astype(np.int64)
    r -= r * r > squares
    r += (r + 1) * (r + 1) <= squares
    return r + (r * r < squares) if up else r


def _squares(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared distances of all rows to all entries; float products are exact while sums stay below 2 ** 53."""
    top = max(int(np.abs(x).max(initial=0)), int(np.abs(book).max(initial=0)))
    kind = np.float64 if 4 * top * top * x.shape[1] < 1 << 52 else np.int64
    a, b = x.astype(kind), book.astype(kind)
    return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]).astype(np.int64)


class Part:
    """State of one part position for some rows: entry, upper bound, ordered next entries with lower bounds, outer bound."""

    def __init__(self, entry, upper, near, lower, outer):
        self.entry, self.upper, self.near, self.lower, self.outer = entry, upper, near, lower, outer

    @classmethod
    def search(cls, x: np.ndarray, book: np.ndarray, b: int) -> tuple[Part, np.ndarray]:
        """All entries compared; the second value is the squared distance to the nearest."""
        k = len(book)
        squares, b = _squares(x, book), min(b, k - 1)
        if squares.max(initial=0) < 1 << 54:
            keys = squares * ENTRIES + np.arange(k)  # ties go to the lower index
            if b + 2 < k:
                keys = np.partition(keys, b + 1, axis=1)[:, : b + 2]
            keys.sort(axis=1)
            squares, which = keys // ENTRIES, keys % ENTRIES
        else:
            which = np.argsort(squares, axis=1, kind="stable")[:, : b + 2]
            squares = np.take_along_axis(squares, which, 1)
        outer = _root(squares[:, b + 1]) if squares.shape[1] > b + 1 else np.full(len(x), _FAR)
        return cls(which[:, 0], _root(squares[:, 0], up=True), which[:, 1 : b + 1], _root(squares[:, 1 : b + 1]), outer), squares[:, 0]

    def moved(self, moves: np.ndarray) -> None:
        """Bounds after entries have moved by ``moves`` at most; lower bounds are ordered from the end."""
        self.upper = self.upper + moves[self.entry]
        self.outer = np.where(self.outer >= _FAR, _FAR, self.outer - moves.max(initial=0))
        bounds = np.concatenate([self.lower - moves[self.near], self.outer[:, None]], axis=1)
        bounds = np.minimum.accumulate(bounds[:, ::-1], axis=1)[:, ::-1]
        self.lower, self.outer = bounds[:, :-1], bounds[:, -1]

    def open(self) -> np.ndarray:
        """How many of the next entries may be as near as the own one; one more than there are where others may."""
        return (self.lower <= self.upper[:, None]).sum(axis=1) + (self.outer <= self.upper)

    def verify(self, x: np.ndarray, book: np.ndarray) -> np.ndarray:
        """Integer distances where bounds don't decide; returns how many entries each row was compared with."""
        b = self.near.shape[1]
        rows = np.flatnonzero(self.open())
        count = np.zeros(len(x), np.int64)
        if not len(rows):
            return count
        own = ((x[rows] - book[self.entry[rows]]) ** 2).sum(1)
        self.upper[rows] = _root(own, up=True)
        need = self.open()[rows]
        count[rows] = need
        some = (need > 0) & (need <= b)
        at, own, need = rows[some], own[some], need[some]
        if len(at):
            most = int(need.max())
            ways = self.near[at, :most]
            tried = np.arange(most) < need[:, None]
            r, c = np.nonzero(tried)
            squares = np.full(ways.shape, 1 << 62) + np.arange(most)  # those not tried keep their order, at the end
            squares[r, c] = ((x[at[r]] - book[ways[r, c]]) ** 2).sum(1)
            all_ways = np.concatenate([self.entry[at][:, None], ways], axis=1)
            squares = np.concatenate([own[:, None], squares], axis=1)
            order = np.lexsort((all_ways, squares), axis=1)
            tried = np.concatenate([np.ones((len(at), 1), bool), tried], axis=1)
            known = np.where(tried, _root(np.where(tried, squares, 0)), np.concatenate([own[:, None], self.lower[at, :most]], axis=1))
            ways, known = np.take_along_axis(all_ways, order, 1), np.take_along_axis(known, order, 1)
            self.entry[at], self.near[at, :most], self.lower[at, :most] = ways[:, 0], ways[:, 1:], known[:, 1:]
            self.upper[at] = _root(np.take_along_axis(squares, order[:, :1], 1)[:, 0], up=True)
        full = rows[count[rows] > b]
        if len(full):
            found, _ = Part.search(x[full], book, b)
            self.entry[full], self.upper[full], self.near[full], self.lower[full], self.outer[full] = found.entry, found.upper, found.near, found.lower, found.outer
        return count

    def shrink(self, b: int) -> None:
        if b < self.near.shape[1]:
            self.outer = np.minimum(self.outer, self.lower[:, b])
            self.near, self.lower = self.near[:, :b], self.lower[:, :b]

    #: A row's state: entry, next entries, then bounds of four bytes each.
    def pack(self) -> np.ndarray:
        bounds = np.clip(np.concatenate([self.upper[:, None], self.lower, self.outer[:, None]], axis=1), -(1 << 31), (1 << 31) - 1).astype("<i4")
        return np.concatenate([self.entry[:, None].astype(np.uint8), self.near.astype(np.uint8), bounds.view(np.uint8)], axis=1)

    @classmethod
    def unpack(cls, data: np.ndarray, b: int) -> Part:
        bounds = np.ascontiguousarray(data[:, 1 + b :]).view("<i4").astype(np.int64)
        return cls(data[:, 0].astype(np.int64), bounds[:, 0], data[:, 1 : 1 + b].astype(np.int64), bounds[:, 1:-1], bounds[:, -1])


def _binary(rows: np.ndarray) -> pa.Array:
    """A binary column of equal lengths."""
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows).tobytes())])


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Bytes of a binary column of equal lengths."""
    _, offsets, data = column.buffers()
    first = np.frombuffer(offsets, np.int32)[column.offset]
    return np.frombuffer(data, np.uint8)[first : first + len(column) * width].reshape(len(column), width)


def _ints(column: pa.Array, length: int) -> np.ndarray:
    return _matrix(column, 4 * length).view("<i4").astype(np.int64)


class _Sums:
    """Sums and counts of parts by entry, and how many parts were compared with how many entries."""

    def __init__(self, parts: int, entries: int, length: int, b: int):
        width = length // parts
        self.total = np.zeros((parts, entries, width + 1), np.int64)
        self.open = np.zeros(b + 2, np.int64)

    def add(self, p: int, x: np.ndarray, entry: np.ndarray, count: np.ndarray | None) -> None:
        order = np.argsort(entry, kind="stable")
        heads = np.flatnonzero(np.diff(entry[order], prepend=-1))
        if len(heads):
            self.total[p, entry[order][heads], :-1] += np.add.reduceat(x[order], heads, axis=0)
            self.total[p, entry[order][heads], -1] += np.diff(np.append(heads, len(entry)))
        if count is not None:
            self.open += np.bincount(count, minlength=len(self.open))

    def flat(self) -> np.ndarray:
        return np.concatenate([self.total.ravel(), self.open])


def _sums_row(sums: _Sums) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.string()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()), pa.array([sums.flat().tobytes()], pa.binary())], names=["vec_id", "label", "ints", "state", "sums"])


def _first_round(vectors: DataFrame, books: list[np.ndarray], length: int, b: int) -> DataFrame:
    parts, width = len(books), length // len(books)

    def run(batches):
        sums = _Sums(parts, len(books[0]), length, b)
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                piece = batch.slice(at, STEP)
                values, starts, lengths = _valid(piece.column(2))
                rows = np.flatnonzero(lengths == length)
                x = _integers(values, starts[rows], length)
                state = []
                for p, book in enumerate(books):
                    own = x[:, p * width : (p + 1) * width]
                    found, _ = Part.search(own, book, b)
                    sums.add(p, own, found.entry, None)
                    state.append(found.pack())
                take = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0).take(take), piece.column(1).take(take), _binary(x.astype("<i4").view(np.uint8).reshape(len(x), 4 * length)), _binary(np.concatenate(state, axis=1)), pa.nulls(len(rows), pa.binary())],
                    names=["vec_id", "label", "ints", "state", "sums"],
                )
        yield _sums_row(sums)

    return vectors.mapInArrow(run, _ROWS)


def _update(batch: pa.RecordBatch, books: list[np.ndarray], moves: list[np.ndarray], length: int, b: int, fewer: int):
    """(values, state, compared) of each part position after the entries moved."""
    x, state = _ints(batch.column(2), length), _matrix(batch.column(3), len(books) * (1 + b + 4 * (b + 2)))
    width, size = length // len(books), 1 + b + 4 * (b + 2)
    for p, book in enumerate(books):
        own, part = x[:, p * width : (p + 1) * width], Part.unpack(state[:, p * size : (p + 1) * size], b)
        part.shrink(fewer)
        part.moved(moves[p])
        yield p, own, part, part.verify(own, book)


def _next_round(rows: DataFrame, books: list[np.ndarray], moves: list[np.ndarray], length: int, b: int, fewer: int) -> DataFrame:
    def run(batches):
        sums = _Sums(len(books), len(books[0]), length, fewer)
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                piece = batch.slice(at, STEP)
                state = []
                for p, own, part, count in _update(piece, books, moves, length, b, fewer):
                    sums.add(p, own, part.entry, count)
                    state.append(part.pack())
                yield pa.RecordBatch.from_arrays([*piece.columns[:3], _binary(np.concatenate(state, axis=1)), piece.column(4)], names=["vec_id", "label", "ints", "state", "sums"])
        yield _sums_row(sums)

    return rows.where("state IS NOT NULL").mapInArrow(run, _ROWS)


def _codes(rows: DataFrame, books: list[np.ndarray], moves: list[np.ndarray], length: int, b: int, fewer: int) -> DataFrame:
    """The last assignment: hex codes and squared errors."""
    digits = np.array([list(f"{i:02x}".encode()) for i in range(256)], np.uint8)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                piece = batch.slice(at, STEP)
                error, code = np.zeros(piece.num_rows, np.int64), []
                for p, own, part, _ in _update(piece, books, moves, length, b, fewer):
                    error += ((own - books[p][part.entry]) ** 2).sum(1)
                    code.append(digits[part.entry])
                text = _binary(np.concatenate(code, axis=1)).cast(pa.string())
                yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(1), text, pa.array(error)], names=["vec_id", "label", "code", "error"])

    return rows.where("state IS NOT NULL").mapInArrow(run, "vec_id bigint, label string, code string, error bigint")


def _total(rows: DataFrame, slots: int) -> np.ndarray:
    """The tasks' sums added up by slot."""

    def add(batches):
        total = np.zeros(slots, np.int64)
        for batch in batches:
            for cell in batch.column(0):
                total += np.frombuffer(cell.as_buffer(), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(slots, dtype=np.int32)), pa.array(total)], names=["slot", "total"])

    out = np.zeros(slots, object)
    found = rows.where("sums IS NOT NULL").select("sums").mapInArrow(add, "slot int, total bigint").where("total <> 0")
    for slot, total in found.groupBy("slot").agg(F.sum(F.col("total").cast("decimal(38,0)"))).collect():
        out[slot] = int(total)
    return out


def learn_and_code(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, bounds: int = BOUNDS, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, list[np.ndarray]]:
    """(vec_id, label, code, error) rows, kept, and the codebooks; at most 256 entries, so that a code is two hex digits."""
    if not 1 <= entries <= ENTRIES or rounds < 1:
        raise ValueError("one to 256 entries and one round at least")
    vectors = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).alias("embedding"))
    length, first = first_entries(vectors, parts, entries)
    if not length:
        return vectors.where("false").select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")), []
    width, k = length // parts, len(first)
    books = [first[:, p * width : (p + 1) * width] for p in range(parts)]
    b = fewer = min(bounds, k - 1)
    rows = scratch.table(_first_round(vectors, books, length, b), "bounds", compression="zstd")
    for turn in range(rounds):
        flat = _total(rows, parts * k * (width + 1) + fewer + 2)
        sums, seen = flat[: parts * k * (width + 1)].reshape(parts, k, width + 1), flat[parts * k * (width + 1) :]
        old, books = books, [np.where(s[:, -1:] > 0, s[:, :-1] // np.maximum(s[:, -1:], 1), o).astype(np.int64) for s, o in zip(sums, books, strict=True)]
        moves = [_root(((new - o) ** 2).sum(1), up=True) for new, o in zip(books, old, strict=True)]
        b, fewer = fewer, _fewer(seen, fewer)
        if turn < rounds - 1:
            before, rows = rows, scratch.table(_next_round(rows, books, moves, length, b, fewer), "bounds", compression="zstd")
        else:
            before, rows = rows, scratch.table(_codes(rows, books, moves, length, b, fewer), "codes", compression="zstd")
        scratch.discard(before)
    return rows, books


def _fewer(seen: np.ndarray, b: int) -> int:
    """The least number of bounds beyond which one part in 64 at most had to look."""
    total = int(seen.sum())
    if not total:
        return b
    beyond = total - np.cumsum(seen)
    return max(min(2, b), min(b, int(np.argmax(beyond * 64 <= total))))


def books_digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(x) for book in books for entry in book.tolist() for x in entry).encode()).hexdigest()


def op11_vector_codes(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    rows, books = learn_and_code(vectors)
    labels = scratch.table(rows.groupBy(F.col("label").alias("__l")).agg(F.try_sum("error").alias("label_error")), "label-errors")
    out = rows.join(labels, F.col("label").eqNullSafe(F.col("__l")))
    return out.select("vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"), "label")


def _op11_sql() -> str:
    """The same search without bounds, round after round."""
    book = lambda r: f"b{r}"
    near = lambda r: f"SELECT p.vec_id, p.part, min(struct_pack(d := list_sum(list_transform(list_zip(p.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), i := b.entry)) AS best FROM p JOIN {book(r)} b USING (part) GROUP BY ALL"
    ctes = [
        "v AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        "p AS MATERIALIZED (SELECT vec_id, part, list_slice(x, part * len(x) // 4 + 1, (part + 1) * len(x) // 4) AS x FROM v, range(4) r(part))",
        "first AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM v ORDER BY vec_id LIMIT 256)",
        "b0 AS MATERIALIZED (SELECT part, entry, x FROM p JOIN first USING (vec_id))",
    ]
    for r in range(ROUNDS):
        ctes += [
            f"a{r} AS MATERIALIZED ({near(r)})",
            f"m{r} AS (SELECT part, entry, list(m ORDER BY pos) AS x FROM (SELECT part, best.i AS entry, pos, CAST(floor(sum(y) / count(*)) AS BIGINT) AS m FROM (SELECT p.part, a.best, unnest(p.x) AS y, unnest(range(len(p.x))) AS pos FROM p JOIN a{r} a USING (vec_id, part)) GROUP BY ALL) GROUP BY ALL)",
            f"b{r + 1} AS MATERIALIZED (SELECT part, entry, coalesce(m.x, o.x) AS x FROM b{r} o LEFT JOIN m{r} m USING (part, entry))",
        ]
    last = book(ROUNDS)
    ctes += [
        f"z AS MATERIALIZED ({near(ROUNDS)})",
        "c AS MATERIALIZED (SELECT vec_id, string_agg(printf('%02x', best.i), '' ORDER BY part) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM z GROUP BY ALL)",
        f"s AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM {last})",
    ]
    return f"WITH {', '.join(ctes)} SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256, CAST(label AS VARCHAR) AS label FROM c JOIN v USING (vec_id), s"


OP11_SQL = _op11_sql()
