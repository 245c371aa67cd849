"""Feeds parsed in the engine: RSS and Atom as columns, without Python."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import bound
from .feeds import CONTENT_CHARS, ITEMS, SUMMARY_CHARS, TITLE_CHARS, enabled_sources

_TEXTS = ("title", "pubDate", "published", "date", "updated", "created", "description", "summary", "encoded", "content")
_ITEM = "struct<" + ",".join(f"{c}:array<string>" for c in _TEXTS) + ",link:array<struct<_VALUE:string,_href:string,_rel:string>>>"
_FEED = f"channel struct<item:array<{_ITEM}>>, item array<{_ITEM}>, entry array<{_ITEM}>, broken string"
_OPTIONS = {"mode": "PERMISSIVE", "ignoreNamespace": "true", "columnNameOfCorruptRecord": "broken"}

# Names of characters, of months and of zones.
NAMED = {
    "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " ", "hellip": "…", "ndash": "–", "mdash": "—", "lsquo": "‘", "rsquo": "’", "ldquo": "“", "rdquo": "”",
    "laquo": "«", "raquo": "»", "euro": "€", "pound": "£", "copy": "©", "reg": "®", "trade": "™", "middot": "·", "bull": "•", "times": "×", "deg": "°",
    "auml": "ä", "ouml": "ö", "uuml": "ü", "Auml": "Ä", "Ouml": "Ö", "Uuml": "Ü", "szlig": "ß", "eacute": "é", "egrave": "è", "agrave": "à", "ccedil": "ç", "ntilde": "ñ", "amp": "&",
}
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
ZONES = {"gmt": "+00:00", "utc": "+00:00", "ut": "+00:00", "z": "+00:00", "est": "-05:00", "edt": "-04:00", "cst": "-06:00", "cdt": "-05:00", "mst": "-07:00", "mdt": "-06:00", "pst": "-08:00", "pdt": "-07:00"}


def _map(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])


def unescaped(text: Column) -> Column:
    """Character references as characters: all numbers, and the names in NAMED; others stay.  Each is read once."""
    code = lambda n: F.when(F.lower(F.left(n, F.lit(1))) == "x", F.conv(F.substring(n, 2, 8), 16, 10)).otherwise(n).cast("int")
    char = lambda n: F.decode(F.unhex(F.lpad(F.hex(code(n).cast("bigint")), 8, "0")), "UTF-32")
    # "&amp;lt;" is "&lt;": references are cut out first, and what they stand for is put between the rest.
    pattern = "&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|" + "|".join(NAMED) + ");"

    def put(t: Column) -> Column:
        found = F.regexp_extract_all(t, F.lit(f"({pattern})"), F.lit(1))
        name = lambda r: F.regexp_extract(r, "^&#?(.*);$", 1)
        known = F.transform(found, lambda r: F.when(F.startswith(r, F.lit("&#")), char(name(r))).otherwise(F.try_element_at(_map(NAMED), name(r))))
        rest = F.split(t, pattern, -1)
        return F.array_join(F.flatten(F.transform(F.arrays_zip(rest.alias("a"), known.alias("b")), lambda z: F.array(z["a"], F.coalesce(z["b"], F.lit(""))))), "")

    return F.when(F.contains(text, F.lit("&")), bound(text, put)).otherwise(text)


def cleaned(text: Column, limit: int) -> Column:
    """The text without tags and with its character references read, single blanks, cut; null if nothing is left."""
    bare = unescaped(F.regexp_replace(text, "<[^>]+>", " "))
    return F.nullif(F.left(F.trim(F.regexp_replace(bare, r"(?U)\s+", " ")), F.lit(limit)), F.lit(""))


def feed_time(text: Column) -> Column:
    """A date of a feed, RFC 822 or ISO 8601, as UTC (timestamp_ntz); null if it is neither, UTC without a zone."""
    words = r"^(?:[A-Za-z]{3,9},?\s+)?(\d{1,2})\s+([A-Za-z]{3})[a-z]*\s+(\d{2,4})\s+(\d{1,2}):(\d{2})(?::(\d{2}))?\s*([A-Za-z]{1,4}|[+-]\d{4})?"
    part = lambda t, k: F.regexp_extract(t, words, k)
    year = lambda y: F.when(F.length(y) == 2, F.concat(F.when(y.cast("int") < 69, F.lit("20")).otherwise("19"), y)).otherwise(F.lpad(y, 4, "0"))
    month = lambda m: F.lpad(F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(m)).cast("string"), 2, "0")
    zone = lambda z: F.when(z.rlike(r"^[+-]\d{4}$"), F.concat(F.left(z, F.lit(3)), F.lit(":"), F.right(z, F.lit(2)))).otherwise(F.coalesce(F.try_element_at(_map(ZONES), F.lower(z)), F.lit("+00:00")))
    two = lambda c: F.lpad(F.when(c == "", "0").otherwise(c), 2, "0")
    mail = lambda t: F.concat(year(part(t, 3)), F.lit("-"), month(part(t, 2)), F.lit("-"), two(part(t, 1)), F.lit("T"), two(part(t, 4)), F.lit(":"), two(part(t, 5)), F.lit(":"), two(part(t, 6)), zone(part(t, 7)))
    iso = lambda t: F.when(t.rlike(r"(?:[zZ]|T.*[+-]\d{2}:?\d{2})$"), F.regexp_replace(t, r"([+-]\d{2})(\d{2})$", "$1:$2")).when(t.rlike(r"[T ]"), F.concat(t, F.lit("Z"))).otherwise(F.concat(t, F.lit("T00:00:00Z")))
    shape = r"^\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}.*)?$"
    read = bound(F.trim(text), lambda t: F.when(t.rlike(words), mail(t)).when(t.rlike(shape), iso(t)))
    return F.to_utc_timestamp(F.try_to_timestamp(read), F.current_timezone()).cast("timestamp_ntz")


def _first(values: Column) -> Column:
    """The first value that isn't blank, trimmed."""
    return F.get(F.filter(F.transform(values, lambda v: F.trim(v)), lambda v: v != ""), F.lit(0))


def _entry(item: Column) -> Column:
    text = lambda name: _first(item[name])
    alternate = lambda link: F.coalesce(link["_rel"], F.lit("alternate")) == "alternate"
    url = F.coalesce(_first(F.transform(item["link"], lambda link: F.when((F.coalesce(link["_href"], F.lit("")) != "") & alternate(link), link["_href"]).otherwise(link["_VALUE"]))), F.lit(""))
    summary = F.coalesce(text("description"), text("summary"))
    when = F.coalesce(*[text(c) for c in ("pubDate", "published", "date", "updated", "created")])
    return F.struct(
        url.alias("url"), cleaned(text("title"), TITLE_CHARS).alias("title"), when.alias("when"), cleaned(summary, SUMMARY_CHARS).alias("summary"),
        cleaned(F.coalesce(text("encoded"), text("content"), summary), CONTENT_CHARS).alias("content"),
    )


def _text(content: Column) -> Column:
    """The bytes as text: by the declared encoding if that is Latin-1 or UTF-16, else UTF-8; without a mark or declaration."""
    head = F.lower(F.decode(F.substring(content, 1, 100), "ISO-8859-1"))
    wide = F.hex(F.substring(content, 1, 2)).isin("FEFF", "FFFE")
    latin = head.rlike("encoding=[\"'](?:iso-8859-1|latin-1|windows-1252)[\"']")
    text = F.when(wide, F.decode(content, "UTF-16")).when(latin, F.decode(content, "ISO-8859-1")).otherwise(F.decode(content, "UTF-8"))
    return F.regexp_replace(text, r"^﻿?\s*(?:<\?xml[^>]*\?>)?", "")


def feed_entries(files: DataFrame, most: int = ITEMS, registry: DataFrame | None = None) -> DataFrame:
    """As :func:`feeds.parse_feeds`, by column functions alone: the valid entries of (source_id, content) rows.

    An entry needs a title and an http(s) link; the first ``most`` of a feed count (with a ``registry`` its sources' own
    limits), in the order of the feed, ``entry`` being its place among all.  A feed that isn't well-formed is one row with
    an ``error``; one without entries, or a null, is none.  ``published_at`` is a timestamp of UTC.
    """
    if registry is not None:
        limits = enabled_sources(registry).select(F.col("id").alias("source_id"), F.col("max_items_per_run").alias("most"))
        files = files.join(F.broadcast(limits), "source_id")  # a registry is a few hundred checked rows
    else:
        files = files.withColumn("most", F.lit(most))
    parsed = files.where("content IS NOT NULL").select("source_id", "most", F.from_xml(_text(F.col("content").cast("binary")), _FEED, _OPTIONS).alias("feed"))
    none = F.array().cast(f"array<{_ITEM}>")
    items = F.concat(F.coalesce("feed.channel.item", none), F.coalesce("feed.item", none), F.coalesce("feed.entry", none))
    made = F.transform(items, lambda item, at: F.struct(at.alias("entry"), _entry(item).alias("e")))
    valid = F.filter(made, lambda m: m["e"]["title"].isNotNull() & m["e"]["url"].rlike(r"^https?://[^/\s]+"))
    rows = parsed.select("source_id", F.col("feed.broken").alias("broken"), F.slice(valid, F.lit(1), F.col("most")).alias("entries"))
    good = rows.where("broken IS NULL").select("source_id", F.explode("entries").alias("m"))
    good = good.select("source_id", "m.entry", "m.e.url", "m.e.title", feed_time(F.col("m.e.when")).alias("published_at"), "m.e.summary", "m.e.content", F.lit(None).cast("string").alias("error"))
    bad = rows.where("broken IS NOT NULL").select("source_id", *[F.lit(None).cast(good.schema[c].dataType).alias(c) for c in good.columns[1:-1]], F.concat(F.lit("not well-formed: "), F.left("broken", F.lit(180))).alias("error"))
    return good.unionByName(bad)
