"""Names of people: normal forms, parts, variants."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Titles before a name.
HONORIFICS = ("sir", "dame", "dr", "mr", "mrs", "ms", "rev", "prof")


def _decompositions() -> tuple[str, str]:
    """Characters below U+3000 whose compatibility form is one base character, and those bases."""
    source, target = [], []
    for code in range(0x80, 0x3000):
        form = "".join(c for c in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(c))
        if len(form) == 1 and form != chr(code):
            source.append(chr(code))
            target.append(form)
    return "".join(source), "".join(target)


_FROM, _TO = _decompositions()
#: Ligatures found in names.
_LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl"}


def squeeze(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s+", " "))


def normalize_name(name: Column) -> Column:
    """Without parentheses, accents and case; null gives an empty name."""
    text = F.regexp_replace(F.coalesce(name, F.lit("")), r"(?U)\s*\([^)]*\)", "")
    for mark, letters in _LIGATURES.items():
        text = F.replace(text, F.lit(mark), F.lit(letters))
    return squeeze(F.lower(F.regexp_replace(F.translate(text, _FROM, _TO), r"\p{Mn}+", "")))


def last_name(name: Column) -> Column:
    return F.element_at(F.split(squeeze(name), " "), -1)


def name_tokens(name: Column) -> Column:
    return F.regexp_extract_all(name, F.lit(r"([A-Za-z0-9]+)"), F.lit(1))


def normalize_query(name: Column) -> Column:
    return squeeze(F.regexp_replace(F.coalesce(name, F.lit("")), r"\([^)]*\)", " "))


def name_variants(name: Column, nicknames: Column | None = None) -> Column:
    """Spellings to search for, in order and distinct: plain, untitled, turned round, ASCII, nicknames."""
    base = normalize_query(name)
    words = F.split(base, " ")
    titled = F.regexp_replace(F.lower(F.element_at(words, 1)), r"^\.+|\.+$", "").isin(*HONORIFICS)
    untitled = F.when(titled & (F.size(words) > 1), F.array_join(F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))), " "))
    turned = F.when(F.contains(base, F.lit(",")), F.trim(F.concat(F.trim(F.regexp_replace(base, "^[^,]*,", "")), F.lit(" "), F.trim(F.substring_index(base, ",", 1)))))
    plain = F.regexp_replace(base, r"[^\x00-\x7F]", "")
    out = F.array(base, untitled, turned, plain)
    if nicknames is not None:
        out = F.concat(out, F.coalesce(nicknames, F.array().cast("array<string>")))
    return F.array_distinct(F.filter(out, lambda v: v.isNotNull() & (v != "")))


def expand_nicknames(names, dim, name_col: str = "name"):
    """Rows of names with ``nicknames``: the first word exchanged for formal or short forms.

    dim: (nick, formal) in lower case, a small table of the user; both directions are looked
    up, formal names first, each in the dimension's order of names."""
    both = dim.select(F.lower("nick").alias("__from"), F.lower("formal").alias("to"), F.lit(0).alias("side")).unionByName(dim.select(F.lower("formal").alias("__from"), F.lower("nick").alias("to"), F.lit(1).alias("side")))
    both = both.groupBy("__from").agg(F.array_sort(F.collect_set(F.struct("side", "to"))).alias("__to"))
    first, rest = F.substring_index(F.col(name_col), " ", 1), F.regexp_replace(F.col(name_col), "^[^ ]+", "")
    joined = names.join(both, F.lower(first) == F.col("__from"), "left")
    made = F.transform("__to", lambda t: F.concat(F.initcap(t["to"]), rest))
    return joined.withColumn("nicknames", F.coalesce(made, F.array().cast("array<string>"))).drop("__from", "__to")
