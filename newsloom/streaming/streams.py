"""Incremental forms: ingest, prefilter, running state and windowed digests."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from newsloom import schemas
from newsloom.functions.text import classify_event
from newsloom.functions.urls import canonical_url, url_key
from newsloom.operators import joins, ordered, rollups
from newsloom.sources import readers, shared, writers


def stream_entries(spark: SparkSession, landing: str, out: str, checkpoint: str) -> StreamingQuery:
    """Feed documents that land in a folder become entries, once for each URL key.

    Within a batch the first row by feed, URL and title wins; keys in ``out`` are left out, so a
    batch that is run again adds nothing."""
    docs = spark.readStream.text(landing, wholetext=True).select(F.col("_metadata.file_path").alias("feed_url"), F.col("value").alias("body"))

    def merge(batch: DataFrame, _: int) -> None:
        entries = readers.parse_feeds(batch).withColumn("url_key", url_key(canonical_url(F.col("entry_url_raw")))).where("url_key IS NOT NULL")
        entries = ordered.first_wins(entries, "url_key", ["feed_url", "entry_url_raw", "entry_title"])
        if shared.exists(batch.sparkSession, out):
            entries = joins.new_only(entries, batch.sparkSession.read.schema(entries.schema).parquet(out))
        writers.append(entries, out)

    return docs.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_new(entries: DataFrame, at: str, key: str, horizon: str) -> DataFrame:
    """The bounded form: a key is remembered for the horizon only."""
    return entries.withWatermark(at, horizon).dropDuplicatesWithinWatermark([key])


def stream_prefilter(events: DataFrame, known: DataFrame) -> DataFrame:
    return joins.flag_known(classify_event(events), known)


def stream_latest(trials: DataFrame) -> DataFrame:
    return trials.groupBy("event_id").agg(F.max_by("status", "seq").alias("status"), F.max("seq").alias("seq"))


def stream_upsert_known(trials: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Known names as keyed state of the stream, and a log of the names that changed, a folder for each batch.

    A batch costs what it changes, not what is known; one that is run again writes its folder anew.
    The state grows with the names, as a table of known names does; ``known_of`` reads the log."""
    value = F.struct(*(c for c in trials.columns if c not in ("normalized_name", "added_at_utc")))
    found = trials.where("normalized_name <> ''").groupBy("normalized_name").agg(F.max_by(value, "seq").alias("r"), F.min_by("added_at_utc", "seq").alias("added_at_utc"))

    def log(batch: DataFrame, number: int) -> None:
        writers.write_stage(batch.select("normalized_name", "r.*", "added_at_utc"), f"{path}/batch={number}", overwrite=True)

    return found.writeStream.outputMode("update").foreachBatch(log).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def known_of(spark: SparkSession, path: str) -> DataFrame:
    """The known names that a log ends with: each name's last row."""
    rows = spark.read.option("basePath", path).parquet(f"{path}/batch=*")
    columns = [c for c in rows.columns if c not in ("normalized_name", "batch")]
    return rows.groupBy("normalized_name").agg(F.max_by(F.struct(*columns), "batch").alias("r")).select("normalized_name", "r.*")


def stream_digest(trials: DataFrame, at: str, window: str = "24 hours", slide: str | None = None, late: str = "1 hour") -> DataFrame:
    """Verdict counts of event-time windows; rows later than the watermark are dropped."""
    bounds = F.window(at, window, slide or window)
    return trials.withWatermark(at, late).groupBy(bounds.alias("w"), "status").agg(F.count("*").alias("n")).select(F.col("w.start").alias("starts"), "status", "n")


_FETCH = [f.split()[0] for f in schemas.FETCH_STATE.split(", ")]
#: Groups of feeds whose states are kept together: a call of Python costs as much as hundreds of rows.
GROUPS = 4096
_STATE = pa.schema([(f.split()[0], pa.int32() if f.endswith(" INT") else pa.string()) if not f.endswith(" TIMESTAMP") else ("at", pa.int64()) for f in schemas.FETCH_STATE.split(", ")])


def stream_fetch_state(fetches: DataFrame, horizon_s: int, late: str = "0 seconds") -> DataFrame:
    """A log of the feeds' state: a row where a feed was fetched anew, and one with ``expired`` once it is forgotten.

    fetches: the columns of ``schemas.FETCH_STATE``.  Spark keeps the feeds' last fetches as keyed state, a table of
    feeds for each of ``GROUPS`` hashes; a feed is dropped when the watermark passes its fetch by the horizon.  Of
    fetches at one time the later batch's counts, then the larger hash, as in ``rollups.fetch_state``.  A batch
    writes the groups that it touches anew.  ``fetch_state_of`` reads the log."""
    kinds = {"last_status": "Int32", "at": "int64"}
    fields = ["at" if c == "last_fetch_at" else c for c in _FETCH]

    def update(_, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        known = pa.ipc.open_file(state.get[0]).read_all().to_pandas().astype(kinds) if state.exists else None
        held, fresh = known, set()
        if not state.hasTimedOut:
            held = known.assign(new=0, tie=0) if known is not None else None
            for rows in frames:
                fresh.update(rows["feed_url"])
                rows = rows[[*fields, "tie"]].astype(kinds).assign(new=1)
                held = rows if held is None else pd.concat([held, rows])
                held = held.sort_values(["at", "new", "tie"]).drop_duplicates("feed_url", keep="last")
        held = held[fields]
        gone = held["at"] // 1000 + horizon_s * 1000 <= state.getCurrentWatermarkMs()
        kept = held[~gone]
        if len(kept):
            table = pa.Table.from_pandas(kept, schema=_STATE, preserve_index=False)
            out = pa.BufferOutputStream()
            with pa.ipc.new_file(out, _STATE, options=pa.ipc.IpcWriteOptions(compression="zstd")) as file:
                file.write_table(table)
            state.update((out.getvalue().to_pybytes(),))
            state.setTimeoutTimestamp(int(kept["at"].min() // 1000 + horizon_s * 1000))
        elif state.exists:
            state.remove()
        told = held.assign(expired=gone)
        yield told[gone | told["feed_url"].isin(fresh)]

    at = F.unix_micros(F.col("last_fetch_at")).alias("at")
    rows = fetches.select(_FETCH).where("feed_url IS NOT NULL AND last_fetch_at IS NOT NULL").withWatermark("last_fetch_at", late)
    group = F.pmod(F.xxhash64("feed_url"), F.lit(GROUPS)).alias("group")
    rows = rows.select(group, "last_fetch_at", *(at if c == "last_fetch_at" else c for c in _FETCH), F.xxhash64(*_FETCH).alias("tie"))
    told = schemas.FETCH_STATE.replace("last_fetch_at TIMESTAMP", "at BIGINT") + ", expired BOOLEAN"
    log = rows.groupBy("group").applyInPandasWithState(update, told, "feeds BINARY", "append", GroupStateTimeout.EventTimeTimeout)
    return log.select(*(F.timestamp_micros("at").alias(c) if c == "last_fetch_at" else c for c in _FETCH), "expired")


def fetch_state_of(log: DataFrame) -> DataFrame:
    """The state that a log ends with: each feed's last fetch, unless it was forgotten since."""
    last = log.groupBy("feed_url").agg(F.max_by(F.struct(*_FETCH[1:], "expired"), F.struct("last_fetch_at", "expired")).alias("r"))
    return last.where("NOT r.expired").select("feed_url", "r.*").select(_FETCH)
