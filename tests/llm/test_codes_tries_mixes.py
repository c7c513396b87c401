"""Vector codes, prefix tries and source mixing against brute force, with edge cases."""

import hashlib
import math
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsloom.llm import mixture, prefixtrie, vectorcodes

VECTORS = "vec_id long, embedding array<float>, label int"


def plain_codes(rows, parts=4, entries=256, rounds=4):
    """Every distance in every round, in Python integers."""
    ok = [(i, [math.floor(1024 * float(np.float32(x))) for x in v], y) for i, v, y in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    lengths = [len(v) for _, v, _ in ok if v and len(v) % parts == 0]
    if not lengths:
        return {}, ""
    length = max(set(lengths), key=lambda n: (lengths.count(n), n))
    ok = [r for r in ok if len(r[1]) == length]
    width = length // parts
    firsts = {}
    for i, v, _ in sorted(ok, key=lambda r: ((r[0] is None, r[0] or 0), r[1])):
        firsts.setdefault(i, v)
    books = [[v[p * width : (p + 1) * width] for v in list(firsts.values())[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = defaultdict(list)
            for _, v, _ in ok:
                groups[nearest(v[p * width : (p + 1) * width], books[p])[1]].append(v[p * width : (p + 1) * width])
            for i, g in groups.items():
                books[p][i] = [sum(c) // len(g) for c in zip(*g, strict=True)]
    out = []
    for i, v, y in ok:
        found = [nearest(v[p * width : (p + 1) * width], books[p]) for p in range(parts)]
        out.append((i, None if y is None else str(y), "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found)))
    text = ",".join(str(x) for book in books for e in book for x in e)
    return sorted(out, key=repr), hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize(("entries", "bounds"), [(256, 16), (12, 3), (12, 0), (5, 16)])
def test_codes_against_plain_search(spark, entries, bounds):
    rng = np.random.default_rng(entries + bounds)
    centres = rng.normal(0, 1, (9, 8))
    rows = [(int(i), [float(x) for x in centres[rng.integers(9)] * rng.integers(1, 3) + np.round(rng.normal(0, 0.02, 8), 2)], int(rng.integers(3)) if i % 5 else None) for i in rng.permutation(400)]
    rows += [rows[0], rows[1], (7, [9.0] * 8, 1), (1000, None, 1), (1001, [1.0, None] * 4, 1), (1002, [float("nan")] + [1.0] * 7, 2), (1003, [float("inf")] + [1.0] * 7, 2), (1004, [], 1), (1005, [1.0] * 4, 1), (1006, [1.0] * 7, 1), (None, [0.5] * 8, 2)]
    frame = spark.createDataFrame(rows, VECTORS).withColumn("code", F.lit("clash")).withColumn("state", F.lit(1)).repartition(5)
    got, books = vectorcodes.learn_and_code(frame, entries=entries, bounds=bounds)
    want, digest = plain_codes(rows, entries=entries)
    assert sorted(map(tuple, got.collect()), key=repr) == want and vectorcodes.books_digest(books) == digest


def test_bounds_decide_most(spark):
    """Vectors in tight groups need few comparisons after the first round, and fewer bounds."""
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 4, (200, 16))
    x = np.floor(1024 * (centres[rng.integers(200, size=3000)] + rng.normal(0, 0.01, (3000, 16)))).astype(np.int64)
    book = np.floor(1024 * centres).astype(np.int64)
    part, _ = vectorcodes.Part.search(x, book, 16)
    part.moved(np.full(200, 3))
    count = part.verify(x, book + 1)
    assert (count == 0).mean() > 0.95
    assert vectorcodes._fewer(np.array([98, 1, 1, 0]), 2) == 1 or vectorcodes._fewer(np.array([9800, 100, 90, 10]), 2) == 2


def test_codes_of_empty_and_extreme(spark):
    empty, books = vectorcodes.learn_and_code(spark.createDataFrame([], VECTORS))
    assert empty.count() == 0 and books == []
    rows, _ = vectorcodes.learn_and_code(spark.createDataFrame([(1, [3e38, -3e38] * 4, None), (2, [0.0] * 8, None), (2, [0.0] * 8, None)], VECTORS))
    assert rows.count() == 3 and all(r["error"] == 0 for r in rows.collect())


def plain_trie(turns):
    own = defaultdict(list)
    for c, n, role, text in turns:
        if c is not None:
            d = hashlib.md5(f"{len(role or '')}:{role or ''}{text or ''}".encode()).hexdigest()
            own[c].append(((n is not None, n or 0), d, (role or "", text or "")))
    own = {c: [t[2] for t in sorted(ts)] for c, ts in own.items()}
    nodes = defaultdict(lambda: [[], [], set()])
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(math.fmod(c, 100))
        p = tuple(own.get(base, [])[:h] + ts[h:])
        for d in range(len(p) + 1):
            nodes[p[:d]][0].append(c)
            if d:
                nodes[p[: d - 1]][2].add(p[:d])
        nodes[p][1].append(c)
    out = []
    for p, (members, ends, kids) in nodes.items():
        under = [q for q in nodes if q[: len(p)] == p]
        saved = sum((len(nodes[q][0]) - 1) * len(q[-1][1]) for q in under if q)
        leaves = sum(not nodes[q][2] for q in under)
        sha = hashlib.sha256(",".join(map(str, sorted(ends))).encode()).hexdigest()
        out.append((min(members), len(p), min(nodes[p[:-1]][0]) if p else None, len(members), len(kids), leaves, saved, sha))
    return sorted(out, key=repr)


@pytest.mark.parametrize("shard", [3, 40, 10_000])
def test_trie_against_plain_nodes(spark, shard, monkeypatch):
    """Copies that span ranges, common first turns, turnless conversations, ties, nulls, long texts."""
    monkeypatch.setattr(prefixtrie, "RUN", 3)
    rng = np.random.default_rng(5)
    turns = []
    for c in [*range(-130, -100), *range(0, 330), 4000, 4001, 4002]:
        kind = rng.integers(4)
        n = 4 if kind == 0 else int(rng.integers(1, 8))
        for d in range(n):
            text = f"copy {d}" if kind == 0 else "hello" if d == 0 else f"t{rng.integers(3)}"
            turns.append((c, d if c % 7 else None, "user" if d % 2 == 0 else None, text if rng.random() > 0.05 else None))
    turns += [turns[3], (None, 0, "user", "nobody"), (5000, 0, "user", "x" * 200_000), (5000, 1, "", "é½日")]
    frame = spark.createDataFrame(turns, "conv_id long, turn int, role string, text string").withColumn("path", F.lit("clash")).repartition(6)
    rows = prefixtrie.scratch.table(prefixtrie.rebuilt(prefixtrie.paths(frame)), "rebuilt")
    got = prefixtrie.prefix_trie(rows, shard)
    assert sorted(map(tuple, got.collect()), key=repr) == plain_trie(turns)
    if shard == 3:
        assert len(prefixtrie.choose_splitters(rows, shard)) > 50


def test_empty_trie(spark):
    frame = spark.createDataFrame([], "conv_id long, turn int, role string, text string")
    rows = prefixtrie.scratch.table(prefixtrie.rebuilt(prefixtrie.paths(frame)), "rebuilt")
    assert prefixtrie.prefix_trie(rows).count() == 0


def plain_targets(sizes, weights=(3, 1, 2)):
    """Shares by weight; those above twice their size stop there and the excess is shared again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    capped, budget = set(), 1.5 * sum(sizes.values())
    while True:
        left = budget - sum(2 * sizes[s] for s in capped)
        w = sum(weight[s] for s in names if s not in capped)
        target = {s: 2 * sizes[s] if s in capped else left * weight[s] / w for s in names}
        more = {s for s in names if target[s] > 2 * sizes[s]}
        if not more:
            return target
        capped |= more


def mixed_rows():
    rng = np.random.default_rng(9)
    rows = [(i, ["b", "a", "é", None, "Z", ""][int(rng.choice(6, p=[0.4, 0.2, 0.2, 0.1, 0.05, 0.05]))], " ".join(["w"] * int(rng.integers(0, 60)))) for i in range(1500)]
    rows += [(7, "b", "one two three")] * 400 + [(None, "b", "x y"), (3, "a", None), (4, "a", " \t\n"), (5, "a", "w " * 50_000)]
    return rows


@pytest.mark.parametrize("group", [64, 4096])
def test_mixing_meets_targets(spark, monkeypatch, group):
    monkeypatch.setattr(mixture, "GROUP", group)
    monkeypatch.setattr(mixture, "FAN", 4)
    monkeypatch.setattr(mixture, "RUN", 50)
    rows = mixed_rows()
    frame = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("size", F.lit("clash")).withColumn("taken", F.lit(0))
    got = [tuple(r) for r in mixture.mix_sources(frame.repartition(7)).collect()]
    again = [tuple(r) for r in mixture.mix_sources(frame.repartition(3)).collect()]
    assert sorted(got, key=repr) == sorted(again, key=repr)
    sizes, most = defaultdict(int), defaultdict(int)
    words = lambda t: len((t or "").split())
    for _, s, t in rows:
        sizes[s] += words(t)
        most[s] = max(most[s], words(t))
    want = plain_targets(sizes)
    assert sorted(((i, s, n) for i, s, n, *_ in got), key=repr) == sorted(((i, s, words(t)) for i, s, t in rows), key=repr)
    taken = defaultdict(int)
    for _, s, n, total, target, copies, words_taken in got:
        assert total == sizes[s] and abs(target - want[s]) < 1e-6 and words_taken == copies * n and copies in (math.floor(target / total), math.ceil(target / total)) and copies <= 2
        taken[s] += words_taken
    for s, target in want.items():
        assert abs(taken[s] - target) <= most[s] / 2 + 1e-6


def test_mixing_leaves_every_document_its_chance(spark):
    """Over many seeds, each document is taken as often as its source's share says, whatever its size."""
    a, b, p, q = 7, 3, 0.3, 0.6
    draws = [mixture.meet(a, p, b, q, mixture._uniform(s, 1)) for s in range(20_000)]
    assert abs(np.mean([d[0] for d in draws]) - p) < 0.01 and abs(np.mean([d[1] for d in draws]) - q) < 0.01
    assert all(abs(a * x + b * y - (a * p + b * q)) < 1e-9 and (x in (0, 1) or y in (0, 1)) for x, y in draws)


def test_mixing_nothing(spark):
    frame = spark.createDataFrame([], "doc_id long, source string, text string")
    assert mixture.mix_sources(frame).count() == 0
    one = mixture.mix_sources(spark.createDataFrame([(1, None, None)], "doc_id long, source string, text string")).collect()
    assert [(r["target"], r["taken"]) for r in one] == [(0.0, 0)]
