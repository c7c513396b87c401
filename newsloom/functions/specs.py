"""Declared shapes of JSON responses, compiled to expressions over a variant.

A shape is built from kinds (``text()``, ``whole()``, ``record(...)``, ``listing(...)``); compiled
it is one column, the violations of a value in the order of the shape, as "path: what".  Nothing is
parsed row by row in Python: a response is parsed once, and the checks are built-in expressions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.text import bind

#: A kind turns a variant and its path into an array of violations.
Kind = Callable[[Column, Column], Column]


def _none() -> Column:
    return F.array().cast("array<string>")


def _say(at: Column, what: str) -> Column:
    return F.array(F.concat(at, F.lit(f": {what}")))


def _typed(test: Callable[[Column], Column], name: str, more: Kind | None = None) -> Kind:
    """A kind of one JSON type; further checks see only values of the type."""

    def check(value: Column, at: Column) -> Column:
        good = F.coalesce(test(F.schema_of_variant(value)), F.lit(False))
        return F.when(~good, _say(at, f"not {name}")).otherwise(more(value, at) if more else _none())

    return check


def text() -> Kind:
    return _typed(lambda t: t == "STRING", "text")


def flag() -> Kind:
    return _typed(lambda t: t == "BOOLEAN", "true or false")


def whole() -> Kind:
    return _typed(lambda t: (t == "BIGINT") | F.rlike(t, F.lit(r"^DECIMAL\(\d+,0\)$")), "a whole number")


def number(least: float | None = None, most: float | None = None) -> Kind:
    def bounds(value: Column, at: Column) -> Column:
        n = F.try_variant_get(value, "$", "double")
        low = F.when(n < least, _say(at, f"below {least:g}")).otherwise(_none()) if least is not None else _none()
        high = F.when(n > most, _say(at, f"above {most:g}")).otherwise(_none()) if most is not None else _none()
        return F.concat(low, high)

    return _typed(lambda t: t.isin("BIGINT", "DOUBLE", "FLOAT") | F.startswith(t, F.lit("DECIMAL")), "a number", bounds)


def one_of(*values: str) -> Kind:
    def known(value: Column, at: Column) -> Column:
        return F.when(F.try_variant_get(value, "$", "string").isin(*values), _none()).otherwise(_say(at, "not one of the values"))

    return _typed(lambda t: t == "STRING", "text", known)


def maybe(kind: Kind) -> Kind:
    """The kind, or JSON null."""
    return lambda value, at: F.when(F.schema_of_variant(value) == "VOID", _none()).otherwise(kind(value, at))


def listing(item: Kind, least: int = 0, most: int | None = None) -> Kind:
    """An array; each item is checked, with its place in the path."""

    def each(value: Column, at: Column) -> Column:
        def checked(items: Column) -> Column:
            few = F.when(F.size(items) < least, _say(at, f"fewer than {least} items")).otherwise(_none()) if least else _none()
            many = F.when(F.size(items) > most, _say(at, f"more than {most} items")).otherwise(_none()) if most is not None else _none()
            inner = F.flatten(F.transform(items, lambda x, i: item(x, F.concat(at, F.lit("["), i.cast("string"), F.lit("]")))))
            return F.concat(few, many, inner)

        return bind(F.try_variant_get(value, "$", "array<variant>"), checked)

    return _typed(lambda t: F.startswith(t, F.lit("ARRAY")), "a list", each)


def record(open_: bool = False, **fields: Kind) -> Kind:
    """An object that has all fields and, unless ``open_``, no others."""

    def each(value: Column, at: Column) -> Column:
        def checked(held: Column) -> Column:
            out = []
            for name, kind in fields.items():
                path = F.concat(at, F.lit(f".{name}"))
                there = F.map_contains_key(held, name)
                out.append(F.when(~there, _say(path, "missing")).otherwise(kind(F.try_element_at(held, F.lit(name)), path)))
            if not open_:
                extra = F.array_sort(F.filter(F.map_keys(held), lambda k: ~k.isin(*fields)))
                out.append(F.transform(extra, lambda k: F.concat(at, F.lit("."), k, F.lit(": not expected"))))
            return F.concat(*out)

        return bind(F.try_variant_get(value, "$", "map<string,variant>"), checked)

    return _typed(lambda t: F.startswith(t, F.lit("OBJECT")), "an object", each)


def violations(json: Column, kind: Kind) -> Column:
    """Violations of JSON text; text that doesn't parse has one."""
    whole_path = F.lit("$")
    return bind(F.try_parse_json(json), lambda v: F.when(v.isNull(), _say(whole_path, "no JSON")).otherwise(kind(v, whole_path)))


def validate(rows: DataFrame, json: str, kind: Kind, name: str = "violations") -> DataFrame:
    """``rows`` with the violations of a column of JSON text."""
    return rows.withColumn(name, violations(F.col(json), kind))


# Fields, values and bounds of the responses that models are asked for.
_TRIAGE = {
    "person_detected": flag(),
    "subject_name_as_written": maybe(text()),
    "subject_name_full": maybe(text()),
    "name_completeness": one_of("FULL_NAME", "SINGLE_TOKEN", "UNKNOWN"),
    "primary_focus": flag(),
    "gate1_decision": one_of("STRONG_PASS", "WEAK_PASS", "FAIL", "SKIP_GLOBALLY_KNOWN"),
    "reasoning_summary": listing(text(), 1, 2),
    "signal_type": one_of(
        "EDITORIAL_OBIT", "CAREER_PROFILE", "PUBLIC_ROLE", "NATIONAL_POLITICIAN", "AWARD_RECIPIENT", "MID_TIER_PROFESSIONAL", "SINGLE_EVENT", "COLLECTIVE", "GLOBALLY_FAMOUS", "OTHER"
    ),
    "confidence": one_of("high", "medium", "low"),
}
_VERDICT = {"rank": whole(), "about_subject": flag(), "confidence": number(0, 1), "reasoning": text()}
#: One triage decision; decisions of a batch, each with its event; a match; verdicts on listed and on other sources.
TRIAGE = record(**_TRIAGE)
TRIAGE_BATCH = record(items=listing(record(event_id=text(), **_TRIAGE), 1))
MATCH = record(status=one_of("HAS_PAGE", "MISSING", "UNCERTAIN"), matched_title=maybe(text()), confidence=number(0, 1), evidence=listing(text(), 1, 3))
LISTED_VERDICTS = record(results=listing(record(**_VERDICT)))
OTHER_VERDICTS = record(results=listing(record(is_reliable_source=flag(), **_VERDICT)))
