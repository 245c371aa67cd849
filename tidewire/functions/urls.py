"""URL canonicalisation and the guard against unsafe addresses."""

from __future__ import annotations

import ipaddress
from urllib.parse import parse_qsl, quote, unquote, urlencode

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType

# Query parameters that say how a reader came, not what they read.
TRACKING_PARAMS = (
    "cmpid", "ref", "ref_src", "referrer", "source", "fbclid", "gclid", "dclid", "msclkid", "twclid", "igshid", "mc_cid", "mc_eid",
    "_hsenc", "_hsmi", "hsctatracking", "spm", "share", "sh", "smid", "cmp", "at_medium", "at_campaign", "ncid", "sr_share", "guccounter",
)
TRACKING_PREFIXES = ("utm_", "at_custom", "pk_", "piwik_", "mtm_")
PATH_SAFE = "/:@!$&'()*+,;=~-._"


def is_tracking_param(name: Column) -> Column:
    found = F.lower(name).isin(*TRACKING_PARAMS)
    for prefix in TRACKING_PREFIXES:
        found |= F.startswith(F.lower(name), F.lit(prefix))
    return found


@F.pandas_udf(StringType())
def _idna(host: pd.Series) -> pd.Series:
    def one(h: str | None) -> str | None:
        try:
            return None if h is None else h.encode("idna").decode("ascii")
        except UnicodeError:
            return h

    return host.map(one)


@F.pandas_udf(StringType())
def _requote_path(path: pd.Series) -> pd.Series:
    return path.map(lambda p: None if p is None else quote(unquote(p), safe=PATH_SAFE))


@F.pandas_udf(StringType())
def _requote_query(query: pd.Series) -> pd.Series:
    def one(q: str | None) -> str | None:
        return None if q is None else urlencode(parse_qsl(q, keep_blank_values=True))

    return query.map(one)


def canonical_host(host: Column, exact: bool = True) -> Column:
    """Lower case, no final dot, ASCII form, and no leading www. where a name remains."""
    h = F.lower(F.regexp_replace(F.trim(host), r"\.+$", ""))
    if exact:
        h = F.when(h.rlike(r"[^\x00-\x7F]"), _idna(h)).otherwise(h)
    return F.when(F.startswith(h, F.lit("www.")) & (F.regexp_count(h, F.lit(r"\.")) > 1), F.substr(h, F.lit(5))).otherwise(h)


def canonical_path(path: Column, exact: bool = True) -> Column:
    """One form of the percent-encoding, single slashes, no index page, no AMP suffix, no final slash."""
    p = F.coalesce(path, F.lit(""))
    if exact:
        p = F.when(p.rlike(r"[^A-Za-z0-9/:@!$&'()*+,;=~\-._]"), _requote_path(p)).otherwise(p)
    p = F.regexp_replace(p, "/{2,}", "/")
    p = F.regexp_replace(p, r"(?i)/index\.(html?|php|aspx?)$", "")
    p = F.regexp_replace(p, r"(?i)/amp/?$", "")
    p = F.regexp_replace(p, "/+$", "")
    return F.when(p == "", "/").otherwise(p)


def canonical_query(query: Column, exact: bool = True) -> Column:
    """The parameters that aren't tracking, sorted by name and value, in one form of the percent-encoding."""
    q = F.coalesce(query, F.lit(""))
    if exact:
        q = F.when(q.rlike(r"[^A-Za-z0-9=&._~\-]"), _requote_query(q)).otherwise(q)
    parts = F.filter(F.split(q, "&"), lambda p: p != "")
    pairs = F.transform(parts, lambda p: F.struct(F.substring_index(p, "=", 1).alias("name"), F.when(F.contains(p, F.lit("=")), F.substr(p, F.instr(p, "=") + 1)).otherwise("").alias("value")))
    kept = F.array_sort(F.filter(pairs, lambda p: ~is_tracking_param(p["name"])))
    return F.array_join(F.transform(kept, lambda p: F.concat(p["name"], F.lit("="), p["value"])), "&")


def canonicalize(url: Column, exact: bool = True) -> Column:
    """One https form for all variants of an address; a url without a host is only trimmed.

    ``exact`` re-encodes what lies beyond plain ASCII in Python, for those rows only.
    """
    u = F.trim(url)
    rest = F.regexp_replace(F.regexp_replace(u, r"#.*$", ""), r"^[A-Za-z][A-Za-z0-9+.\-]*://", "//")
    authority = F.regexp_extract(rest, r"^//([^/?]*)", 1)
    place = F.regexp_replace(authority, r"^.*@", "")
    host = F.when(F.startswith(place, F.lit("[")), F.regexp_extract(place, r"^(\[[^\]]*\])", 1)).otherwise(F.regexp_extract(place, r"^([^:]*)", 1))
    port = F.regexp_extract(place, r":(\d+)$", 1)
    scheme = F.lower(F.regexp_extract(u, r"^([A-Za-z][A-Za-z0-9+.\-]*)://", 1))
    plain = (port == "") | (port == "443") | ((port == "80") & (scheme == "http"))
    path = F.regexp_extract(rest, r"^//[^/?]*([^?]*)", 1)
    query = canonical_query(F.regexp_extract(rest, r"^[^?]*\?(.*)$", 1), exact)
    out = F.concat(F.lit("https://"), canonical_host(host, exact), F.when(plain, "").otherwise(F.concat(F.lit(":"), port)), canonical_path(path, exact))
    return F.when(host == "", u).otherwise(F.concat(out, F.when(query == "", "").otherwise(F.concat(F.lit("?"), query))))


@F.pandas_udf(BooleanType())
def _global(host: pd.Series) -> pd.Series:
    def one(h: str | None) -> bool:
        try:
            ip = ipaddress.ip_address((h or "").strip("[]"))
        except ValueError:
            return True  # a name: its addresses are checked where it is resolved
        inner = getattr(ip, "ipv4_mapped", None) or getattr(ip, "sixtofour", None)
        return ip.is_global and not ip.is_multicast and (inner is None or inner.is_global)

    return host.map(one)


def is_safe_url(url: Column) -> Column:
    """http or https, port 80 or 443, no credentials, no address that isn't public, no local name."""
    u = F.trim(url)
    authority = F.regexp_extract(u, r"^[A-Za-z]+://([^/?#]*)", 1)
    host = F.lower(F.regexp_replace(F.regexp_extract(authority, r"^(\[[^\]]*\]|[^:]*)", 1), r"\.+$", ""))
    port = F.regexp_extract(authority, r":(\d*)$", 1)
    shape = u.rlike(r"^(?i:https?)://") & (host != "") & ~F.contains(authority, F.lit("@")) & (port.isin("", "80", "443")) & ~u.rlike(r"[\x00-\x20]")
    local = (host == "localhost") | F.endswith(host, F.lit(".localhost")) | F.endswith(host, F.lit(".local")) | F.endswith(host, F.lit(".internal"))
    literal = host.rlike(r"^\[|^[0-9.]+$|^0x")
    return F.coalesce(shape & ~local & ~host.rlike(r"^(0x[0-9a-f]+|\d+)$") & F.when(literal, _global(host)).otherwise(True), F.lit(False))
