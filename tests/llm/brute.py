"""Plain single-threaded statements of the contracts, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BLANK = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def contamination(docs, items):
    windows = defaultdict(set)
    for item, text in items:
        words = ALNUM.findall((text or "").translate(LOWER))
        k = min(13, len(words))
        for i in range(len(words) - k + 1 if k else 0):
            windows[tuple(words[i : i + k])].add(item)
    sizes = {len(w) for w in windows}
    out = {}
    for doc, text in docs:
        words = ALNUM.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for k in sizes:
            for i in range(len(words) - k + 1):
                if (w := tuple(words[i : i + k])) in windows:
                    hit.update(range(i, i + k))
                    found |= windows[w]
        out[doc] = (len(words), len(hit), len(found), sha(",".join(sorted(map(str, found)))), len(hit) > 0 and 20 * len(hit) >= len(words))
    return out


def shingles(text):
    words = BLANK.findall((text or "").translate(LOWER))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def components(docs):
    """{doc: (n_shingles, component)}"""
    sets = {d: shingles(t) for d, t in docs}
    by = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            by[x].append(d)
    common = Counter()
    for ds in by.values():
        for i, a in enumerate(ds):
            for b in ds[i + 1 :]:
                common[min(a, b), max(a, b)] += 1
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, b), n in common.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def links(docs):
    """{doc: other documents linked to it}"""
    sets = {d: shingles(t) for d, t in docs}
    by = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            by[x].append(d)
    out = {}
    for d, s in sets.items():
        common = Counter(e for x in s for e in by[x])
        out[d] = sum(4 * n >= 3 * (len(s) + len(sets[e]) - n) for e, n in common.items() if e != d)
    return out


def quality_base(text):
    words = BLANK.findall(text or "")
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if BLANK.search(line):
            dup += line in seen
            seen.add(line)
    grams = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    hit = set()
    for i in range(len(words) - 2):
        if grams[tuple(words[i : i + 3])] > 1:
            hit.update((i, i + 1, i + 2))
    failed = len(words) < 50 or 100 * len(hit) > 50 * len(words)
    return len(words), sum(map(len, words)), symbols, dup, len(hit), failed


def _luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


PII = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def personal(text):
    """[(kind, start, end)] by start, then kind as listed."""
    spans = []
    for k, (kind, pattern) in enumerate(PII.items()):
        for m in pattern.finditer(text or ""):
            digits = re.sub(r"[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and _luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            spans.append((m.start(), k, kind, m.end()))
    return [(kind, a, b) for a, _, kind, b in sorted(spans)]


def telling(docs, least, threshold, chance, left_out=frozenset()):
    """{doc: term spans}, by counting over distinct texts without near copies."""
    texts = {t or "" for _, t in docs} - left_out
    holders, terms = defaultdict(set), defaultdict(set)
    for t in texts:
        base = personal(t)
        for kind, a, b in base:
            value = t[a:b].lower() if kind in ("email", "ip") else re.sub(r"[^0-9]", "", t[a:b])
            group = {"email": value.split("@")[-1], "ip": ".".join(value.split(".")[:2]), "card": value[:6], "phone": value[:4]}[kind]
            holders[kind, value].add(t)
            holders[kind, "group", group].add(t)
    spans = lambda t: [(m.start(), m.end(), m[0].translate(LOWER)) for m in ALNUM.finditer(t.translate(LOWER)) if len(m[0]) >= least and not re.fullmatch("[0-9]+", m[0]) and not any(a < m.end() and b > m.start() for _, a, b in personal(t))]
    anywhere = {t: [(m.start(), m.end(), m[0]) for m in ALNUM.finditer(t.translate(LOWER)) if len(m[0]) >= least and not re.fullmatch("[0-9]+", m[0])] for t in texts}
    for t in texts:
        for _, _, w in anywhere[t]:
            terms[w].add(t)
    told, n = set(), len(texts)
    for held in holders.values():
        for w, c in Counter(w for t in held for w in {w for _, _, w in spans(t)}).items():
            expected = len(held) * len(terms[w]) / n
            likely = c * math.log(c / expected) - c + expected >= math.log(len(holders) / chance)
            if n > len(held) and likely and math.log(c / expected) >= threshold * math.log(n / len(held)):
                told.add(w)
    return {d: [(a, b) for a, b, w in spans(t or "") if w in told] for d, t in docs}


def held_out(doc):
    return zlib.crc32(str(doc).encode()) % 3 == 1


class KneserNey:
    """Interpolated Kneser-Ney models of the bytes of words, one for each class; orders up to ``shared`` pool both."""

    def __init__(self, words, order, shared):
        self.order, self.levels = order, {}
        grams = [Counter() for _ in words]
        for c, counts in enumerate(words):
            for w, n in counts.items():
                s = (1, *w.encode(), 2)
                for i in range(1, len(s)):
                    grams[c][s[max(0, i - order + 1) : i + 1]] += n
        above = None
        for k in range(order, 0, -1):
            own = [Counter({g: n for g, n in x.items() if len(g) == k}) for x in grams]
            for c, x in enumerate(above or ()):
                for g in x:
                    own[c][g[1:]] += 1
            above = own
            used = [own[0] + own[1]] * 2 if k <= shared else own
            level = []
            for x in used:
                once, twice = sum(n == 1 for n in x.values()), sum(n == 2 for n in x.values())
                totals, types = Counter(), Counter()
                for g, n in x.items():
                    totals[g[:-1]] += n
                    types[g[:-1]] += 1
                level.append((x, once / (once + 2 * twice) if once else 0.5, totals, types))
            self.levels[k] = level

    def chance(self, c, gram):
        if not gram:
            return 1 / 256
        x, discount, totals, types = self.levels[len(gram)][c]
        below, total = self.chance(c, gram[1:]), totals[gram[:-1]]
        return max(x[gram] - discount, 0) / total + discount * types[gram[:-1]] / total * below if total else below

    def log_chance(self, c, word):
        s = (1, *word.encode(), 2)
        return sum(math.log(self.chance(c, s[max(0, i - self.order + 1) : i + 1])) for i in range(1, len(s)))
