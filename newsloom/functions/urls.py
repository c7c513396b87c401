"""URL and identity expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Query keys that only track.
TRACKING_KEYS = ("fbclid", "gclid", "mc_cid", "mc_eid", "ref", "src")
TRACKING_PREFIX = "utm_"
_HOST = r"^(?i)(?:https?):\/\/(?:[^/?#@]*@)?([^/?#:]+)(?::(\d*))?(?=[/?#]|$)"


def _encode(text: Column) -> Column:
    """Form encoding that keeps ~ and escapes *."""
    return F.replace(F.replace(F.url_encode(text), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def canonical_url(url: Column) -> Column:
    """One spelling of equal addresses; null without a host or with an invalid port.

    Host and query keys are lower-cased, tracking keys, default ports, user data and fragments
    go, path slashes collapse, and the remaining parameters are sorted by key and value."""
    text = F.trim(url)
    text = F.when(F.startswith(text, F.lit("//")), F.concat(F.lit("https:"), text)).otherwise(text)
    scheme = F.lower(F.regexp_extract(text, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    rest = F.regexp_replace(text, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    authority = F.regexp_replace(F.regexp_extract(rest, r"^([^/?#]*)", 1), r"^.*@", "")
    host = F.lower(F.regexp_replace(authority, r":\d*$", ""))
    port = F.regexp_extract(authority, r":(\d*)$", 1)
    default = ((scheme == "http") & (port == "80")) | ((scheme == "https") & (port == "443"))
    valid = (scheme != "") & (host != "") & ~F.contains(host, F.lit(":")) & ((port == "") | (F.coalesce(F.expr("cast(null as int)"), port.try_cast("int"), F.lit(99999)) <= 65535))
    netloc = F.when((port == "") | default, host).otherwise(F.concat(host, F.lit(":"), port))
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), "/{2,}", "/")
    path = F.when(path.isin("", "/"), F.lit("/")).otherwise(F.regexp_replace(path, "/+$", ""))
    query = F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1)
    pairs = F.filter(F.split(query, "&"), lambda p: p != "")
    decode = lambda x: F.coalesce(F.try_url_decode(x), x)
    split = F.transform(pairs, lambda p: F.struct(F.lower(F.trim(decode(F.substring_index(p, "=", 1)))).alias("k"), decode(F.regexp_replace(p, "^[^=]*=?", "")).alias("v")))
    kept = F.filter(split, lambda p: ~p["k"].isin(*TRACKING_KEYS) & ~F.startswith(p["k"], F.lit(TRACKING_PREFIX)) & (p["k"] != ""))
    rebuilt = F.array_join(F.transform(F.array_sort(kept), lambda p: F.concat(_encode(p["k"]), F.lit("="), _encode(p["v"]))), "&")
    return F.when(valid, F.concat(scheme, F.lit("://"), netloc, path, F.when(rebuilt == "", F.lit("")).otherwise(F.concat(F.lit("?"), rebuilt))))


def url_key(canonical: Column) -> Column:
    return F.sha2(canonical, 256)


def event_id(canonical: Column, guid: Column, feed: Column, published: Column) -> Column:
    """Digest of address, guid, feed and day."""
    day = F.substring(F.coalesce(published, F.lit("unknown-date")), 1, 12)
    day = F.when(published.isNull(), F.lit("unknown-date")).otherwise(F.substring(day, 1, 10))
    return F.sha2(F.concat_ws("|", canonical, F.coalesce(guid, F.lit("")), feed, day), 256)


def source_domain(url: Column) -> Column:
    """Lower-cased network location with its port and without one leading www.; empty if there is none."""
    found = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    return F.regexp_replace(found, r"^www\.", "")


def resolve_domain(domain: Column, url: Column) -> Column:
    """The given domain, else the URL's host; null if both are empty."""
    host = F.regexp_replace(F.regexp_replace(source_domain(url), r"^.*@", ""), r":\d*$", "")
    given = F.regexp_replace(F.lower(F.trim(domain)), r"^www\.", "")
    return F.coalesce(F.nullif(given, F.lit("")), F.nullif(host, F.lit("")))
