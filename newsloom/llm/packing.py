"""Best-fit packing of tokenised documents into sequences, planned over counts of lengths.

1. Tasks tokenise whole texts and cut documents longer than a sequence.  Each piece notes its
   rank among the pieces of its length in its task; the table of pieces is written once.
2. The histogram of lengths has at most ``width`` rows whatever the corpus.  From it the
   driver plans best-fit decreasing over counts: runs of equal sequences take equal pieces.
3. Pieces take planned slots by their rank within their length: the rank in the task plus the
   pieces of that length in earlier tasks.  A hot length needs no group in one task.

Defined results: a null or empty text is one piece that holds the end token alone; rows that
repeat a document are packed one by one; ties go by rank; an empty table gives no pieces.
Input columns beside the id and the text are ignored, so names cannot clash.
"""

from __future__ import annotations

import bisect
import os
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsloom.llm import scratch
from newsloom.llm import textbatch as tb

WIDTH = 2048
VOCABULARY = "word_bpe_49k.json"
#: Words, and pieces of words, that a Python worker notes before its older notes go, some 500 bytes for each word.
#: Fewer take less memory and more time; the ids are the same.
MEMO = 500_000
_PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, part int, rank bigint"


class _Memo(dict):
    """Ids by word, in two generations: when one is full the one before it goes; words met again stay."""

    def __init__(self, size: int):
        super().__init__()
        self.size, self.older = size, {}

    def __missing__(self, word: str) -> bytes:
        found = self.older[word]
        if len(self) < 2 * self.size:
            self[word] = found
        return found

    def missing(self, words: list[str]) -> list[str]:
        """The distinct words that aren't known; room is made first, so that those known stay until they are read."""
        distinct = dict.fromkeys(words)
        if len(self) + len(distinct) > self.size:
            self.older = dict(self)
            self.clear()
        return [w for w in distinct if w not in self and w not in self.older]


class WordTokenizer:
    """Ids of whole texts, looked up word by word.

    The vocabulary's pre-tokenizer never joins characters across white space, so the ids of a
    text are those of its words one after another, and frequent words are encoded once.  Words
    of characters below U+0180 are lower-cased and split first, which the normaliser would do
    the same way; all others go to the tokenizer as they are.
    """

    def __init__(self, path: str, memo: int = MEMO):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.parts = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        self.words, self.pieces = _Memo(memo), _Memo(memo)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def _encode_pieces(self, new: list[str]) -> None:
        """Encode pieces as one text of words; tokens that end a word part them again."""
        for first in range(0, len(new), 4096):
            part = new[first : first + 4096]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            ends = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            if len(ends) != len(part) or ends[-1] != 4 * len(ids):
                self._encode(self.pieces, part)
                continue
            data, start = ids.tobytes(), 0
            for piece, end in zip(part, ends, strict=True):
                self.pieces[piece] = data[start:end]
                start = end

    def _encode(self, known: dict[str, bytes], new: list[str]) -> None:
        for word, x in zip(new, self.tokenizer.encode_batch_fast(new, add_special_tokens=False), strict=True):
            known[word] = np.array(x.ids, "<u4").tobytes()

    def _learn(self, words: list[str]) -> None:
        plain, whole = {}, []
        for w in words:
            if (w.isascii() or max(w) < "ƀ") and "<|" not in w:
                plain[w] = self.parts.findall(w.lower())
            else:
                whole.append(w)
        self._encode(self.words, whole)
        self._encode_pieces(self.pieces.missing([p for ps in plain.values() for p in ps]))
        for w, ps in plain.items():
            self.words[w] = b"".join([self.pieces[p] for p in ps])

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):  # separators to Python, not to the vocabulary
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        words = text.split()
        try:
            return b"".join(map(self.words.__getitem__, words))
        except KeyError:
            self._learn(self.words.missing(words))
            return b"".join(map(self.words.__getitem__, words))


def tokenizer(path: str, memo: int = MEMO) -> WordTokenizer:
    """One for each worker process, kept between tasks until another operator's tasks drop it."""
    return tb.resident(("tokenizer", path, memo), lambda: WordTokenizer(path, memo))


def cut(docs: DataFrame, vocabulary: str, width: int, id_col: str = "doc_id", text_col: str = "text", memo: int = MEMO) -> DataFrame:
    """Pieces of the tokenised documents, with the task and the rank in the task by length."""

    def emit(batches):
        words = tokenizer(vocabulary, memo)
        part = TaskContext.get().partitionId()
        ranks: dict[int, int] = defaultdict(int)
        for batch in batches:
            out: list[tuple] = []
            column = batch.column("text")
            for i, doc in enumerate(batch.column("doc_id").to_pylist()):
                ids = words.ids(column[i].as_py() or "") + bytes(4)
                n = len(ids) // 4
                for piece, start in enumerate(range(0, n, width)):
                    length = min(width, n - start)
                    out.append((doc, piece, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), part, ranks[length]))
                    ranks[length] += 1
            if out:
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], [x.split()[0] for x in _PIECES.split(", ")])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(tb.trimmed(emit), _PIECES)


def plan(counts: dict[int, int], width: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts: (length, first rank, end rank, first sequence, pieces a sequence, offset).

    A run is a range of sequences with equal room.  The best fit for a length is the run with
    the least room that suffices; the room that a piece leaves there is smaller still, so a
    sequence takes as many pieces of the length as it can before the next one is looked at.
    """
    runs: dict[int, list[tuple[int, int]]] = defaultdict(list)
    rooms: list[int] = []  # sorted rooms that have runs
    slots, sequences = [], 0

    def put(room: int, first: int, n: int) -> None:
        if n and room:
            if not runs[room]:
                bisect.insort(rooms, room)
            runs[room].append((first, n))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, n = runs[room].pop()
                if not runs[room]:
                    del rooms[at]
            else:
                room, first, n = width, sequences, -(-left // (width // length))
                sequences += n
            each = room // length
            full = min(n, left // each)
            rest = left - full * each if full < n else 0
            for begin, bins, per in ((first, full, each), (first + full, int(rest > 0), rest)):
                if bins:
                    slots.append((length, rank, rank + bins * per, begin, per, width - room))
                    put(room - per * length, begin, bins)
                    rank += bins * per
                    left -= bins * per
            used = full + int(rest > 0)
            put(room, first + used, n - used)
    return slots


def pack(docs: DataFrame, vocabulary: str, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text", memo: int = MEMO) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    pieces = scratch.table(cut(docs, vocabulary, width, id_col, text_col, memo), "pieces")
    local = pieces.groupBy("part", "length").agg((F.max("rank") + 1).alias("n"))
    local = scratch.table(local, "piece-counts")
    counts = {r["length"]: r["n"] for r in local.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most width rows
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = local.select("part", "length", F.coalesce(before, F.lit(0)).alias("before"))
    # as an Arrow table, since a list would start Python workers of another kind, which stay beside those of the operators
    runs = np.array(plan(counts, width), np.int64).reshape(-1, 6)
    slots = spark.createDataFrame(pa.table({c: runs[:, i] for i, c in enumerate(("length", "first", "end", "sequence", "per", "base"))}))
    ranked = pieces.join(starts, ["part", "length"]).withColumn("rank", F.col("rank") + F.col("before"))
    # the plan's size depends on the width alone
    placed = ranked.join(F.broadcast(slots), (ranked["length"] == slots["length"]) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("end"))).drop(slots["length"])
    nth = F.col("rank") - F.col("first")
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("sequence") + F.floor(nth / F.col("per"))).cast("long").alias("sequence_id"), (F.col("base") + (nth % F.col("per")) * F.col("length")).cast("long").alias("offset"))


def op8_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), public_tokenizers.path(VOCABULARY))
