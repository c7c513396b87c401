"""URL filters: all wildcard rules run at once as one bit-parallel automaton.

Every rule is a glob over the canonical URL: a start mark, the lower-cased host, a boundary
mark and the path.  The globs are packed into the 64-bit words of a Shift-And state vector,
one bit for each pattern place: ``*`` is a self-loop on the place before it, ``?`` takes any
character.  One pass over the characters of a batch of URLs advances every pattern of every
URL together; the work a character needs does not depend on how many rules fit.

Rules named by host and path fit that host and its subdomains where the path starts with the
rule's; the longest rule wins, among equals the first.  Where none fits, the verdict is the
method's: ``block`` if a glob of the block list fits, else ``allow``.

Defined results: a null URL, or one without ``://``, has an empty host and path, no rule, and
the verdict for an empty URL.  Long URLs take one step a character, and tables of ``CELLS``
characters however long the longest is; rows that repeat an id are judged one by one; empty
tables give empty tables; other columns pass through, but columns named like the results are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.llm.lines import ascii_lower

#: Marks that no URL character equals: they lie beyond Unicode.
START, BOUNDARY, ANY, GAP = 0x110000, 0x110001, 0x110002, 0x110003

#: URLs that are advanced together, sorted by length, and characters looked up at once.
ROWS, CELLS = 4096, 1 << 20


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    def places(self) -> list[int]:
        """``*.host`` or ``host`` itself, the boundary, then the path's start and anything."""
        return [GAP, ord("."), *map(ord, self.host), BOUNDARY, *map(ord, self.path), GAP]


@dataclass(frozen=True)
class Glob:
    """A glob over the whole URL without scheme, query and fragment, such as ``*/ads/*``."""

    verdict: str
    glob: str

    @property
    def text(self) -> str:
        return self.glob

    def places(self) -> list[int]:
        special = {"*": GAP, "?": ANY, "|": BOUNDARY}
        return [GAP, *(special.get(c, ord(c)) for c in self.glob)]


class Automaton:
    """Multiword Shift-And over patterns of places."""

    def __init__(self, patterns: Sequence[Sequence[int]]):
        self.patterns = len(patterns)
        bits, loops, opens, finals, gaps_at_end = [], [], [], [], []
        for places in patterns:
            # the bit before a pattern's first character stands for "nothing read yet"
            opens.append(len(bits))
            loops.append(bool(places) and places[0] == GAP)
            bits.append(None)
            for place in places:
                if place == GAP:
                    loops[-1] = True
                else:
                    bits.append(place)
                    loops.append(False)
            finals.append(len(bits) - 1)
        self.words = (len(bits) + 63) // 64 or 1
        alphabet = sorted({b for b in bits if b is not None and b != ANY} | {START, BOUNDARY})
        self.alphabet = np.array(alphabet, np.int64)
        self.masks = np.zeros((len(alphabet) + 1, self.words), np.uint64)
        self.loops, self.start = np.zeros(self.words, np.uint64), np.zeros(self.words, np.uint64)
        self.finals = [(f >> 6, np.uint64(f & 63)) for f in finals]
        for i, (place, loop) in enumerate(zip(bits, loops, strict=True)):
            word, bit = i >> 6, np.uint64(1) << np.uint64(i & 63)
            if place == ANY:
                self.masks[:, word] |= bit
            elif place is not None:
                self.masks[alphabet.index(place), word] |= bit
            if loop:
                self.loops[word] |= bit
        for i in opens:
            self.start[i >> 6] |= np.uint64(1) << np.uint64(i & 63)

    def classes(self, codes: np.ndarray) -> np.ndarray:
        """Row of ``masks`` for each code point; the last row is for all other characters."""
        at = np.minimum(np.searchsorted(self.alphabet, codes), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == codes, at, len(self.alphabet))

    def run(self, texts: Sequence[Sequence[int]]) -> np.ndarray:
        """Which pattern matches which whole text."""
        out = np.zeros((len(texts), self.patterns), bool)
        lengths = np.array([len(t) for t in texts], np.int64)
        order = np.argsort(-lengths, kind="stable")
        for first in range(0, len(order), ROWS):
            rows = order[first : first + ROWS]
            state = np.tile(self.start, (len(rows), 1))
            step = max(1, CELLS // len(rows))
            for begin in range(0, int(lengths[rows[0]]), step):
                alive = np.searchsorted(-lengths[rows], -np.arange(begin, begin + step), side="left")  # texts longer than i
                table = np.zeros((step, alive[0]), np.uint16)
                for j, r in enumerate(rows[: alive[0]]):
                    codes = np.asarray(texts[r][begin : begin + step], np.int64)
                    table[: len(codes), j] = self.classes(codes)
                for i, n in enumerate(alive[: np.count_nonzero(alive)]):
                    now = state[:n]
                    shifted = now << np.uint64(1)
                    shifted[:, 1:] |= now[:, :-1] >> np.uint64(63)
                    state[:n] = (shifted & self.masks[table[i, :n]]) | (now & self.loops)
            for p, (word, bit) in enumerate(self.finals):
                out[rows, p] = (state[:, word] >> bit) & np.uint64(1)
        return out


#: Fixed values of the production rules: verdict, host, path.
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)
#: Block list for URLs that no rule names.
GLOBS = (
    Glob("block", "*|*/ads/*"),
    Glob("block", "*|*/adserver/*"),
    Glob("block", "*.doubleclick.???|*"),
    Glob("block", "*|*/wp-login.php*"),
    Glob("block", "*|*.exe"),
    Glob("block", "*casino*|*"),
)


def judge_urls(pages: DataFrame, rules: Sequence[Rule] = RULES, globs: Sequence[Glob] = GLOBS, url_col: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path``, the winning ``rule`` (or null) and the ``verdict``."""
    rest = F.when(F.instr(url_col, "://") > 0, F.expr(f"substring(`{url_col}`, instr(`{url_col}`, '://') + 3)")).otherwise(F.lit(""))
    host = F.regexp_extract("__rest", r"^([^/?#]*)", 1)
    path = F.regexp_extract("__rest", r"^[^/?#]*([^?#]*)", 1)
    out = pages.drop("host", "path", "rule", "verdict").withColumn("__rest", rest)
    out = out.withColumn("host", ascii_lower(F.coalesce(host, F.lit("")))).withColumn("path", F.coalesce(path, F.lit(""))).drop("__rest")
    kept = [f for f in out.schema.fields if f.name not in ("host", "path")]
    schema = T.StructType([*kept, T.StructField("host", T.StringType()), T.StructField("path", T.StringType()), T.StructField("rule", T.StringType()), T.StructField("verdict", T.StringType())])
    ranked = sorted(rules, key=lambda r: -len(r.text))
    patterns = [*(r.places() for r in ranked), *(g.places() for g in globs)]
    verdicts, names, n_rules, blocking = [r.verdict for r in ranked], [r.text for r in ranked], len(ranked), [g.verdict == "block" for g in globs]
    fields = [f.name for f in schema.fields]

    def judge(batches):
        automaton = Automaton(patterns)
        for batch in batches:
            hosts, paths = batch.column("host").to_pylist(), batch.column("path").to_pylist()
            texts = [[START, 0x2E, *map(ord, h), BOUNDARY, *map(ord, p)] for h, p in zip(hosts, paths, strict=True)]
            fits = automaton.run(texts)
            rule, verdict = [], []
            for row in fits:
                won = next((i for i in range(n_rules) if row[i]), None)
                rule.append(None if won is None else names[won])
                bad = any(b for b, x in zip(blocking, row[n_rules:], strict=True) if x)
                verdict.append(verdicts[won] if won is not None else "block" if bad else "allow")
            columns = [batch.column(f.name) for f in kept]
            columns += [batch.column("host"), batch.column("path"), pa.array(rule, pa.string()), pa.array(verdict, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, fields)

    return out.select([f.name for f in kept] + ["host", "path"]).mapInArrow(judge, schema)


def op1_url_filter(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge_urls(pages).select("page_id", "host", "path", "rule", "verdict")


OP1_SQL = """
WITH r AS (
  SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
w AS (
  SELECT page_id, host, path, CASE
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/'
  END AS rule FROM h)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
  WHEN path LIKE '%/ads/%' OR path LIKE '%/adserver/%' OR host LIKE '%.doubleclick.___' OR path LIKE '%/wp-login.php%'
    OR path LIKE '%.exe' OR host LIKE '%casino%' THEN 'block'
  ELSE 'allow' END AS verdict
FROM w
"""
