"""Model responses that arrive as text: salvage, validation, batches, decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def salvage_json(text: Column) -> Column:
    """(ok, value, error): the whole text, else from the first brace to the last one."""
    text = F.trim(F.coalesce(text, F.lit("")))
    inner = F.regexp_extract(text, r"(?s)\{.*\}", 0)
    whole, part = F.try_parse_json(text), F.try_parse_json(inner)
    good = F.when(whole.isNotNull() & F.startswith(text, F.lit("{")), text).when((inner != "") & part.isNotNull(), inner)
    error = F.when(text == "", "empty_output").when(good.isNotNull(), F.lit(None)).when(inner == "", "no_json_object_found").otherwise("json_decode_error")
    return F.struct(good.isNotNull().alias("ok"), good.alias("value"), error.alias("error"))


def violations(checks: dict[str, Column]) -> Column:
    """Names of the checks that fail or are null, in order."""
    return F.array_compact(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items())))


def explode_batch(batches: DataFrame, text_col: str, order_col: str) -> DataFrame:
    """(event_id, item, order) of {"items": [...]} or [...] responses; the last duplicate wins."""
    kind = "array<map<string,string>>"
    items = F.coalesce(F.from_json(F.get_json_object(text_col, "$.items"), kind), F.from_json(text_col, kind))
    rows = batches.select(F.col(order_col).alias("order"), F.posexplode(items).alias("at", "item")).withColumn("event_id", F.col("item")["event_id"])
    return rows.groupBy("event_id").agg(F.max_by("item", F.struct("order", "at")).alias("item"), F.max("order").alias("order"))


def match_status(ok: Column, value: Column) -> Column:
    """The response's status; uncertain where there is none."""
    return F.coalesce(F.when(ok, F.nullif(F.get_json_object(value, "$.status"), F.lit(""))), F.lit("UNCERTAIN"))


def trial_ok(error: Column, parsed: Column) -> Column:
    return (F.coalesce(error, F.lit("")) == "") & F.coalesce(parsed, F.lit(False))
