"""URL filter: site rules first, then a weighted vocabulary matched by an Aho-Corasick automaton.

A term counts only between boundaries: no letter directly before or after it (digits and signs are boundaries).  One
strict term, or several different soft ones, reject a url.  Terms are looked for in the whole url, query and fragment too.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Terms of which one is enough.
STRICT = ("casino", "viagra", "cialis", "porn", "xxx", "spam", "malware", "phishing", "warez", "escort", "jackpot", "roulette", "nsfw", "hentai", "camgirl")
#: Terms of which several different ones are needed.
SOFT = ("pills", "cheap", "win", "bonus", "bet", "poker", "loan", "loans", "replica", "discount", "adult", "dating", "free", "farm", "slots", "prize", "pharmacy", "weightloss", "crypto", "giveaway")
SOFT_NEEDED = 2
#: The vocabulary: terms by weight; a url is blocked from a weight of 1 on.
WEIGHTS = {**dict.fromkeys(STRICT, 1.0), **dict.fromkeys(SOFT, 1.0 / SOFT_NEEDED)}

#: (host, path, verdict): fits the host and its subdomains if the path starts with the rule's; the longest wins.
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host (A-Z lower-cased) and the path of a url; both empty without '://' or where it is null."""
    after = F.regexp_extract(url, r"(?s)\A.*?://(.*)\z", 1)
    host = F.translate(F.regexp_extract(after, r"(?s)\A([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(after, r"(?s)\A[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest fitting rule as text (host then path) and its verdict; null if none fits."""
    name = verdict = F.lit(None).cast("string")
    for site, start, what in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == site) | F.endswith(host, F.lit("." + site))) & F.startswith(path, F.lit(start))
        name, verdict = F.when(fits, site + start).otherwise(name), F.when(fits, what).otherwise(verdict)
    return name, verdict


def automaton(weights: Mapping[str, float]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for term, weight in weights.items():
        found.add_word(term, (term, weight))
    found.make_automaton()
    return found


def count_terms(machine: ahocorasick.Automaton, text: str) -> tuple[int, int, float]:
    """How many different strict (weight 1 and more) and soft terms stand between boundaries, and all their weight."""
    found: dict[str, float] = {}
    for end, (term, weight) in machine.iter(text):
        start = end + 1 - len(term)
        if (start == 0 or not text[start - 1].isalpha()) and (end + 1 == len(text) or not text[end + 1].isalpha()):
            found[term] = weight
    strict = sum(w >= 1 for w in found.values())
    return strict, len(found) - strict, sum(found.values())


def term_hits(url: Column, weights: Mapping[str, float]) -> Column:
    """(strict_hits, soft_hits, weight) of a url column, lower-cased, over all of it; nulls have none."""

    @F.arrow_udf("strict_hits int, soft_hits int, weight double")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        machine = automaton(weights)
        for urls in batches:
            hits = [count_terms(machine, (u or "").lower()) for u in urls.to_pylist()] if weights else [(0, 0, 0.0)] * len(urls)
            kinds = (pa.int32(), pa.int32(), pa.float64())
            yield pa.StructArray.from_arrays([pa.array([h[k] for h in hits], kinds[k]) for k in range(3)], names=["strict_hits", "soft_hits", "weight"])

    return of(url)


def judge_urls(pages: DataFrame, url: str = "url", keep: Sequence[str] = ("page_id",), rules: Sequence[tuple[str, str, str]] = RULES, weights: Mapping[str, float] = WEIGHTS) -> DataFrame:
    """The ``keep`` columns, host, path, rule, verdict (allow or block), strict_hits and soft_hits of each row.

    Where a rule fits, its verdict holds; else a url is blocked if the weights of the different terms in it, its query
    and fragment included, add up to 1: one strict term (weight 1) or several soft ones.  Null urls and those without
    '://' have an empty host and path; their text is judged all the same.  Repeated rows give a row each, very long
    urls are matched whole, other columns are ignored, and an empty table gives an empty table.
    """
    text = F.col(url).cast("string")
    host, path = host_and_path(text)
    base = pages.select(*keep, host.alias("host"), path.alias("path"), term_hits(text, weights).alias("hits"))
    name, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("hits.weight") >= 1 - 1e-9, "block").otherwise("allow")
    return base.select(*keep, "host", "path", name.alias("rule"), F.coalesce(verdict, own).alias("verdict"), "hits.strict_hits", "hits.soft_hits")
