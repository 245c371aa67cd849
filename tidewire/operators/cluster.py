"""Grouping articles into events that persist across days.

Articles join the best-scoring event so far or open a new one, in input order.  No article can join an event unless it
shares an entity of some weight with one of its members or a title of sufficient likeness, so the connected components of
those relations hold every event whole: components are found distributed, and the order-dependent part goes slice by slice
through each component.
"""

from __future__ import annotations

from array import array
from collections import deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.categories import classify
from ..functions.entities import DECISIVE_WEIGHT, GATE_WEIGHT, MODEL_FAMILIES, OTHER_WEIGHT, VERSIONED_WEIGHT, WEIGHTS, article_entities, weight
from ..functions.text import trigrams
from .lineage import components, lookup, stored
from .ranking import ranked
from .simjoin import similar_pairs


@dataclass(frozen=True)
class ClusterRules:
    """Score to join, blend of entities and wording, and the gates on wording."""

    threshold: float = 0.45
    entity_share: float = 0.55
    wording_alone: float = 0.60
    wording_least: float = 0.40
    wording_same_source: float = 0.60
    decisive: float = DECISIVE_WEIGHT
    gate: float = GATE_WEIGHT
    titles: int = 12


_HYPHENED = {f"model:{f}" for f in MODEL_FAMILIES if "-" in f}


def _weight(entity: str) -> float:
    kind, _, name = entity.partition(":")
    if kind == "model" and "-" in name and entity not in _HYPHENED:
        return VERSIONED_WEIGHT
    return WEIGHTS.get(kind, OTHER_WEIGHT)


def _versions(entities: set[str]) -> dict[str, set[str]]:
    found: dict[str, set[str]] = {}
    for e in entities:
        if e.startswith("model:") and _weight(e) == VERSIONED_WEIGHT:
            family, _, version = e.rpartition("-")
            found.setdefault(family, set()).add(version)
    return found


#: Weights as whole numbers, so that sums don't depend on their order.
_UNIT = 1000


def _units(entity: str) -> int:
    return round(_weight(entity) * _UNIT)


class _Titles:
    """Different titles by number, and how alike one is to all of them."""

    def __init__(self) -> None:
        self.sets: list[frozenset[str]] = []
        self.number: dict[frozenset[str], int] = {}
        self.grams: dict[str, array] = {}
        self.size = array("q")
        self.known: dict[frozenset[str], np.ndarray] = {}
        self.held = 0

    def put(self, grams: frozenset[str]) -> int:
        found = self.number.get(grams)
        if found is None:
            found = self.number[grams] = len(self.sets)
            self.sets.append(grams)
            self.size.append(len(grams))
            for g in grams:
                self.grams.setdefault(g, array("q")).append(found)
        return found

    def likeness(self, grams: frozenset[str]) -> np.ndarray:
        """The Dice with each title, and 0 for no title at the end; kept until a title is added."""
        out = self.known.get(grams)
        if out is not None and len(out) == len(self.sets) + 1:
            return out
        out = np.zeros(len(self.sets) + 1)
        posts = [np.frombuffer(self.grams[g], np.int64) for g in grams if g in self.grams]
        if posts:
            met = np.bincount(np.concatenate(posts), minlength=len(self.sets))
            out[:-1] = 2 * met / np.maximum(len(grams) + np.frombuffer(self.size, np.int64), 1)
        if self.held > 4_000_000:
            self.known, self.held = {}, 0
        self.known[grams] = out
        self.held += len(out)
        return out


def _at(kind: dict[str, array], name: str) -> np.ndarray:
    found = kind.get(name)
    return np.frombuffer(found, np.int64) if found else np.zeros(0, np.int64)


class _Fold:
    """The events of one component, in the order in which they were opened, and the scores of all of them at once.

    What repeats is computed once: how alike two titles are, and how an article's entities meet the events' until those change.
    """

    def __init__(self, rules: ClusterRules) -> None:
        self.rules, self.events, self.index = rules, [], _Titles()
        self.entities: dict[str, array] = {}
        self.families: dict[str, array] = {}
        self.sources: dict[str, array] = {}
        self.whole = array("q")
        self.places = np.full((16, rules.titles), -1, np.int64)  # numbers of each event's last titles
        self.read: dict[str, frozenset[str]] = {}
        self.facts: dict[frozenset[str], tuple[np.ndarray, ...]] = {}

    def _grams(self, row: dict) -> frozenset[str]:
        """Of a title's rows the first one has its trigrams."""
        name = row["title"] or ""
        if row["titles"] is not None:
            self.read[name] = frozenset(row["titles"][0])
        return self.read[name]

    def _place(self, k: int, grams: frozenset[str]) -> None:
        event = self.events[k]
        number = self.index.put(grams)
        self.places[k, event["told"] % self.rules.titles] = number
        event["told"] += 1
        event["titles"].append(number)

    def open(self, row: dict) -> None:
        """An event as it is: one that was stored, one that an earlier slice left, or one that an article opens."""
        # An event of one title has its own; of more, its last ones.
        titles = [self._grams(row)] if row["titles"] is None or len(row["titles"]) == 1 else row["titles"]
        k, event = len(self.events), dict(row)
        event["entities"], event["article_ids"], event["source_ids"] = set(), dict.fromkeys(row["article_ids"]), dict.fromkeys(row["source_ids"])
        event["titles"], event["told"] = deque(maxlen=self.rules.titles), 0
        self.events.append(event)
        if k == len(self.places):
            self.places = np.concatenate([self.places, np.full_like(self.places, -1)])
        for t in titles:
            self._place(k, frozenset(t))
        self.whole.append(0)
        self.facts = {}
        self._name(k, row["entities"])
        for s in event["source_ids"]:
            self.sources.setdefault(s, array("q")).append(k)

    def _name(self, k: int, entities: Iterable[str]) -> None:
        event = self.events[k]
        for e in set(entities) - event["entities"]:
            self.facts = {}
            event["entities"].add(e)
            self.entities.setdefault(e, array("q")).append(k)
            self.whole[k] += _units(e)
            for family in _versions({e}):
                if k not in _at(self.families, family)[-1:] and k not in _at(self.families, family):
                    self.families.setdefault(family, array("q")).append(k)

    def _shared(self, entities: frozenset[str]) -> tuple[np.ndarray, ...]:
        """By event, for an article's entities: their part of the score, the score without wording, the wording needed, and whether versions differ."""
        found = self.facts.get(entities)
        if found is not None:
            return found
        rules, n = self.rules, len(self.events)
        shared, strongest = np.zeros(n), np.zeros(n)
        for e in entities:
            at = _at(self.entities, e)
            shared[at] += _units(e)
            strongest[at] = np.maximum(strongest[at], _weight(e))
        apart = np.zeros(n, dtype=bool)
        for family, versions in _versions(set(entities)).items():
            other = np.zeros(n, dtype=bool)
            other[_at(self.families, family)] = True
            for v in versions:
                other[_at(self.entities, f"{family}-{v}")] = False
            apart |= other
        needed = np.where(strongest >= rules.decisive, 0.0, np.where(strongest >= rules.gate, rules.wording_least, max(rules.wording_alone, rules.wording_least)))
        whole = np.array(self.whole, np.int64) + sum(map(_units, entities)) - shared
        part = rules.entity_share * np.divide(shared, whole, out=np.zeros(n), where=whole > 0)
        found = self.facts[entities] = part, np.where(strongest >= rules.decisive, rules.threshold, 0.0), needed, apart
        return found

    def scores(self, entities: frozenset[str], grams: frozenset[str], source: str) -> np.ndarray:
        rules, n = self.rules, len(self.events)
        part, floor, needed, apart = self._shared(entities)
        wording = self.index.likeness(grams)[self.places[:n]].max(axis=1)
        same = self.sources.get(source)
        if same:
            same, needed = np.array(same, np.int64), needed.copy()
            needed[same] = np.maximum(needed[same], rules.wording_same_source)
        blend = part + (1 - rules.entity_share) * wording
        return np.where(apart | (wording < needed), 0.0, np.maximum(blend, np.where(wording >= rules.wording_alone, wording, floor)))

    def add(self, row: dict) -> None:
        entities, grams = frozenset(row["entities"]), self._grams(row)
        best = None
        if self.events:
            scores = self.scores(entities, grams, row["source_id"])
            best = len(scores) - 1 - int(np.argmax(scores[::-1]))  # of equal scores the one opened last
            best = best if scores[best] >= self.rules.threshold else None
        if best is None:
            self.open(row | {"id": f"evt_{row['id']}", "article_ids": [row["id"]], "source_ids": [row["source_id"]], "first_seen": row["at"], "last_updated": row["at"], "is_new": True, "touched": True})
            return
        event = self.events[best]
        if row["id"] in event["article_ids"]:
            return
        event["article_ids"][row["id"]] = None
        if row["source_id"] not in event["source_ids"]:
            event["source_ids"][row["source_id"]] = None
            self.sources.setdefault(row["source_id"], array("q")).append(best)
        self._place(best, grams)
        self._name(best, entities)
        event["first_seen"], event["last_updated"], event["touched"] = min(event["first_seen"], row["at"]), max(event["last_updated"], row["at"]), True
        if len(self.index.sets) > 2048 + 2 * self.rules.titles * len(self.events):
            self._drop_dead()

    def _drop_dead(self) -> None:
        """Titles that left their events' last ones go."""
        sets, self.index = self.index.sets, _Titles()
        for k, event in enumerate(self.events):
            last, event["told"] = [sets[t] for t in event["titles"]], 0
            for t in last:
                self._place(k, t)

    def out(self) -> Iterator[dict]:
        for e in self.events:
            yield e | {"entities": sorted(e["entities"]), "article_ids": list(e["article_ids"]), "source_ids": list(e["source_ids"]), "titles": [sorted(self.index.sets[t]) for t in e["titles"]]}


def fold_component(rows: Iterable[dict], rules: ClusterRules) -> Iterator[dict]:
    """All events of one component after its rows, events (``stored``) and articles, in order."""
    fold = _Fold(rules)
    for row in rows:
        if row["stored"]:
            fold.open(row)
        else:
            fold.add(row)
    return fold.out()


EVENT_SCHEMA = (
    "id string, canonical_title string, category string, entities array<string>, article_ids array<string>, source_ids array<string>, "
    "first_seen timestamp, last_updated timestamp, is_new boolean"
)


#: What passes from slice to slice: an event with the trigrams of its last titles, or an article, the first of a title with its trigrams.
_ROW = (
    "component bigint, ord bigint, stored boolean, id string, title string, category string, entities array<string>, titles array<array<string>>, source_id string, at timestamp, "
    "article_ids array<string>, source_ids array<string>, first_seen timestamp, last_updated timestamp, is_new boolean, touched boolean"
)
_NAMES = [c.split()[0] for c in _ROW.split(", ")]
#: Articles of a component that one task folds before the next slice goes on.
SLICE_ROWS = 100_000


def _components(nodes: DataFrame, rules: ClusterRules) -> DataFrame:
    """(node, component) of ``ord``: rows of different components never meet in one event.

    An article joins an event by an entity of the gate's weight that a member has, or by its wording alone.  The first
    rows of each such entity and of each title are connected with the others, and alike titles only where that has not
    put them together already.
    """
    each = nodes.select("ord", F.explode("entities").alias("entity")).where(weight(F.col("entity")) >= min(rules.gate, rules.decisive))
    named = stored(nodes.select("ord", F.col("title").alias("key")).unionByName(each.select("ord", F.concat(F.lit("\0"), "entity").alias("key"))), "names")
    first = named.groupBy("key").agg(F.min("ord").alias("first"))
    stars = lookup(named, first, "key").where("first < ord").select(F.col("first").alias("a"), F.col("ord").alias("b"))
    known = components(stars)
    titles = nodes.groupBy("title").agg(F.min("ord").alias("first")).withColumn("grams", trigrams(F.coalesce("title", F.lit(""))))
    apart = titles.join(known.select(F.col("node").alias("first"), "component"), "first", "left").withColumn("component", F.coalesce("component", "first"))
    pairs = similar_pairs(stored(apart, "titles"), "first", "grams", rules.wording_alone, apart="component").select("a", "b")
    return components(known.select(F.col("component").alias("a"), F.col("node").alias("b")).unionByName(pairs))


def _sliced(placed: DataFrame) -> DataFrame:
    """``placed`` with its ``slice`` of its component, about SLICE_ROWS rows each in order, and the component's ``last``.

    ``ord`` is unique, so a block of SLICE_ROWS numbers has no more rows; whole blocks make up slices.
    """
    block = F.floor(F.col("ord") / SLICE_ROWS)
    sizes = placed.groupBy("component", block.alias("block")).agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(W.partitionBy("component").orderBy("block")) - F.col("n")  # a row a block
    number = sizes.withColumn("slice", F.floor(before / SLICE_ROWS))
    cuts = number.groupBy("component", "slice").agg(F.min("block").alias("low"))
    cuts = cuts.withColumn("last", F.max("slice").over(W.partitionBy("component")))
    large = cuts.where("last > 0").groupBy("component").agg(F.sort_array(F.collect_list("low")).alias("lows"))
    out = lookup(placed, large, "component", "left")
    place = F.size(F.filter("lows", lambda x: x <= block)) - 1
    return out.select("*", F.when(F.col("lows").isNull(), 0).otherwise(place).alias("slice"), F.when(F.col("lows").isNull(), 0).otherwise(F.size("lows") - 1).alias("last")).drop("lows")


def _with_grams(placed: DataFrame) -> DataFrame:
    """``placed`` with a title's trigrams in ``titles`` of its first row in each slice of a component; the fold remembers them."""
    name = F.coalesce("title", F.lit("")).alias("name")
    first = placed.groupBy("component", "slice", name).agg(F.min("ord").alias("ord"))
    grams = placed.select(name).distinct().withColumn("grams", trigrams(F.col("name")))
    own = first.join(grams, "name").select("ord", F.array("grams").alias("titles"))
    return placed.drop("titles").join(own, "ord", "left")


def cluster_articles(articles: DataFrame, existing: DataFrame | None = None, rules: ClusterRules = ClusterRules()) -> DataFrame:
    """The events that ``articles`` open or extend: EVENT_SCHEMA's columns, one row an event.

    ``articles``: ord (unique), id, title, summary, source_id, published_at, fetched_at.  ``existing``: events as
    returned, each a possible home; they come before articles, newest last_updated first.  Ties between events go to the
    one that was opened last.  A null title has no trigrams.

    Each article may change the event that the next one looks at, so a component is folded in order; it is cut into
    slices of SLICE_ROWS rows, and a slice starts from the events that the one before it left.  No task holds more than a
    slice and its component's events; components run side by side.
    """
    none, untold = F.array().cast("array<string>"), F.lit(None).cast("array<array<string>>").alias("titles")
    node = articles.select(
        F.col("ord").cast("bigint").alias("ord"), F.lit(False).alias("stored"), "id", "title", classify(F.col("title"), F.col("summary"), F.col("source_id")).alias("category"),
        article_entities(F.col("title"), F.col("summary")).alias("entities"), untold, "source_id", F.coalesce("published_at", "fetched_at").alias("at"),
        none.alias("article_ids"), none.alias("source_ids"), F.lit(None).cast("timestamp").alias("first_seen"), F.lit(None).cast("timestamp").alias("last_updated"), F.lit(False).alias("is_new"), F.lit(False).alias("touched"),
    )
    if existing is not None:
        held = ranked(existing.select(*[c.split()[0] for c in EVENT_SCHEMA.split(", ")][:-1]), [F.desc("last_updated"), F.asc("id")])
        low = node.agg(F.min("ord")).first()[0] or 0
        count = existing.count()
        node = node.unionByName(held.select(
            (F.col("rank") - 1 - count + F.lit(low)).cast("bigint").alias("ord"), F.lit(True).alias("stored"), "id", F.col("canonical_title").alias("title"), "category", "entities", untold,
            F.lit("").alias("source_id"), F.col("last_updated").alias("at"), "article_ids", "source_ids", "first_seen", "last_updated", F.lit(False).alias("is_new"), F.lit(False).alias("touched"),
        ))
    node = stored(node, "articles")
    found = _components(node, rules)
    placed = node.join(found.withColumnRenamed("node", "ord"), "ord", "left").withColumn("component", F.coalesce("component", "ord"))
    placed = stored(_with_grams(stored(_sliced(stored(placed, "placed")), "slices")), "slices")

    def fold(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("ord")
        component = group["component"].iloc[0]
        rows = (dict(zip(_NAMES, r, strict=True)) for r in zip(*(group[c].tolist() for c in _NAMES), strict=True))
        made = [e | {"component": component, "stored": True} for e in fold_component(rows, rules)]
        return pd.DataFrame(made, columns=_NAMES)

    events = carried = None
    for k in range((placed.agg(F.max("last")).first()[0] or 0) + 1):
        rows = placed.where(F.col("slice") == k).select(*_NAMES)
        whole = rows if carried is None else rows.unionByName(carried)
        done = stored(whole.groupBy("component").applyInPandas(fold, _ROW), "events")
        ends = placed.where(F.col("last") == k).select("component").distinct()
        ended = done.where("touched").join(ends, "component", "left_semi")
        events = ended if events is None else events.unionByName(ended)
        carried = done.join(placed.where(F.col("last") > k).select("component").distinct(), "component", "left_semi")
    return events.select("id", F.col("title").alias("canonical_title"), "category", "entities", "article_ids", "source_ids", "first_seen", "last_updated", "is_new")


def cluster_stats(events: DataFrame) -> DataFrame:
    """One row: events, new, updated, from several sources, and articles an event (2 digits)."""
    n = F.count(F.lit(1))
    return events.agg(
        n.alias("events"), F.count_if("is_new").alias("events_new"), F.count_if(~F.col("is_new")).alias("events_updated"), F.count_if(F.size("source_ids") > 1).alias("multi_source"),
        F.when(n > 0, F.round(F.sum(F.size("article_ids")) / n, 2)).otherwise(0.0).alias("articles_per_event"),
    )


def merge_events(keep: DataFrame, drop: DataFrame, pairs: DataFrame) -> DataFrame:
    """Each pair (keep_id, drop_id) as one event: kept id, title and category, joined lists in order, widest dates."""
    k = keep.select(F.struct("*").alias("k"))
    d = drop.select(F.struct("*").alias("d"))
    both = pairs.join(k, F.col("k.id") == F.col("keep_id")).join(d, F.col("d.id") == F.col("drop_id"))
    joined = [F.array_union(f"k.{c}", f"d.{c}").alias(c) for c in ("entities", "article_ids", "source_ids")]
    return both.select("k.id", "k.canonical_title", "k.category", *joined, F.least("k.first_seen", "d.first_seen").alias("first_seen"), F.greatest("k.last_updated", "d.last_updated").alias("last_updated"))
