"""Schemas of the tables that the sources read."""

FEEDS = "url STRING, priority INT"
FEED_ENTRIES = (
    "event_id STRING, event_type STRING, ingested_at_utc STRING, source_feed_url_original STRING, source_feed_url_resolved STRING, source_feed_title STRING, "
    "entry_guid STRING, entry_title STRING, entry_url_raw STRING, entry_url_canonical STRING, published_at_utc STRING, fetched_at_utc STRING, summary STRING, author STRING, date_parse_error BOOLEAN, seq BIGINT"
)
KNOWN_PAGES = "entries MAP<STRING, STRUCT<pageid: BIGINT, title: STRING, fullurl: STRING, added_at_utc: STRING, source_event_id: STRING, source_run_id: STRING, source_stage: STRING>>"
RUNS = "run_id STRING, started_at STRING, finished_at STRING, stages ARRAY<STRUCT<name: STRING, duration_s: DOUBLE, exit_code: INT, notes: STRING, skipped: BOOLEAN>>, new_gate1_events INT"
SUMMARIES = "run_id STRING, generated_at STRING, likely_notable_count INT, possibly_notable_count INT, likely_notable ARRAY<STRUCT<subject_name: STRING, gate4b_status: STRING, confirmed_count: INT, source_article: STRING, source_urls: ARRAY<STRING>>>"
#: One entry of a feed of either dialect, by local names; what may repeat is an array, of which the first text counts.
_LINK = "ARRAY<STRUCT<_VALUE: STRING, _href: STRING, _rel: STRING>>"
_AUTHOR = "ARRAY<STRUCT<_VALUE: STRING, name: STRING>>"
_ONCE = ("guid", "id", "creator", "pubDate", "published", "updated", "date")
_OFTEN = ("title", "description", "summary", "content")
FEED_ENTRY = f"STRUCT<link: {_LINK}, author: {_AUTHOR}, {', '.join(f'{n}: STRING' for n in _ONCE)}, {', '.join(f'{n}: ARRAY<STRING>' for n in _OFTEN)}>"
RSS = f"channel STRUCT<title: ARRAY<STRING>, item: ARRAY<{FEED_ENTRY}>>"
ATOM = f"title ARRAY<STRING>, entry ARRAY<{FEED_ENTRY}>"
#: A feed's last fetch; the streaming form relies on the time and the error being last.
FETCH_STATE = "feed_url STRING, etag STRING, last_modified STRING, resolved_url STRING, last_status INT, last_fetch_at TIMESTAMP, last_error STRING"
