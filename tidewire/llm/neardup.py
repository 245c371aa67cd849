"""MinHash near-dedup: fast similarity sketches, banding, and exact confirmation of every link.

1. One pass over the texts makes each document's set of word shingles, a 128-bit digest of the whole set, and the
   band keys of its fast similarity sketch.  Only the digest and the keys are kept.
2. Documents with equal sets are one class; only classes go on, so copies cost one row each.
3. Classes that share a band key are candidates.  A bucket of any size gives one edge from its first class to each
   member (never all pairs), and the components of these edges are groups that may hold links.
4. In each group one class is the hub, the one that meets most others.  Every class is held against the hub, exactly,
   and what remains of it is its difference D = set (+) hub.  Two classes x, y are similar enough exactly if
   |D_x (+) D_y| <= tau (n_x + n_y), tau = (1 - J) / (1 + J).  If x and y share no element of their differences and
   are similar enough, both are linked to the hub already.  All other links have to share at least
       |D_x| - tau (1 + 1/J) n_x    and, where y is not linked to the hub,    (|D_x| - tau (n_x - n_hub)) / 2
   elements, c say, so they meet in the first |D_x| - c + 1 elements of any fixed order: the rarest first in large
   groups.  An equi-join on those finds them all without comparing all pairs of a group; sizes and positions are
   checked in the join and the exact overlap after it.  No bucket or group is capped.
5. What isn't linked to its hub goes round again, grouped by the band keys that are still shared, with hubs of its own:
   a second cluster in a group is a star of its own, not pairs of all its members.  Where the join of 4 would give few
   pairs for what is left, it is done at once and ends the rounds.
6. The confirmed links' components are the result.

With 25 bands of 5 coordinates a pair of similarity 0.85 shares a band with a probability of 1 - 4e-7.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import textops as T
from .common import components, forget, heavy_keys, lookup, only, small, stored
from .sketch import band_keys, fast_sketch

BANDS, ROWS = 25, 5
#: Groups of so many classes count how often their elements occur, to order them; smaller ones are all rare.
ORDERED = 16
#: Tasks that the members of a large group are dealt to, each with a copy of the hub's set.
SPREAD = 32
#: What isn't linked to its hub is joined with itself if that gives at most so many pairs for each.
PAIRS_EACH = 4
#: After so many hubs in turn, or a turn that links less than one in so many rows to its hub, it is joined with itself
#: however many pairs that gives: further hubs would settle as little, and no link is lost either way.
MOST_ROUNDS = 8


def _sets(column: pa.Array, width: int) -> Iterator[list[np.ndarray]]:
    only(("sets",))
    data, offsets = T.utf8(column)
    for i, j in T.row_slices(offsets):
        cut = data[offsets[i] : offsets[j]]
        yield T.sorted_sets(*T.shingles(*T.words(cut, offsets[i : j + 1] - offsets[i]), width))


def _digest(one: np.ndarray) -> bytes:
    return hashlib.blake2b(one.tobytes(), digest_size=16).digest()


def sketches(docs: DataFrame, width: int = 5, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, n_shingles, set_key, bands) of (doc_id, text); set_key is null where there is no word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for sets in _sets(batch.column(1), width):
                sizes = np.array([len(s) for s in sets], dtype=np.int64)
                bounds = np.concatenate(([0], np.cumsum(sizes)))
                keys = band_keys(fast_sketch(np.concatenate(sets), bounds, bands * rows), bands, rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(sets)),
                        pa.array(sizes),
                        pa.array([_digest(s) if len(s) else None for s in sets], pa.binary()),
                        pa.ListArray.from_arrays(np.arange(len(sets) + 1, dtype=np.int32) * bands, keys.view(np.int64).ravel()),
                    ],
                    names=["doc_id", "n_shingles", "set_key", "bands"],
                )
                at += len(sets)

    schema = "doc_id bigint, n_shingles bigint, set_key binary, bands array<bigint>"
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, schema)


def shingle_sets(docs: DataFrame, width: int = 5) -> DataFrame:
    """(set_key, elements) of (doc_id, text) rows with words: the sorted 64-bit shingles, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sets in _sets(batch.column(0), width):
                sets = [s for s in sets if len(s)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_digest(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())],
                    names=["set_key", "elements"],
                )

    return docs.select(F.col("text").cast("string")).mapInArrow(run, "set_key binary, elements binary")


def _u64(value: bytes) -> np.ndarray:
    return np.frombuffer(value, dtype=np.uint64)


def _differences(rows: DataFrame, num: int, den: int) -> DataFrame:
    """Each class against its group's hub: link, difference, and how much of it other links have to meet in.

    ``rest`` has the difference's d elements, those outside of the hub first.  ``lone`` of them are enough to meet
    classes that aren't linked to the hub, ``most`` to meet any.
    """
    tau, ratio = (den - num) / (den + num), num / den

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group, node, hub, size, mine, other = (batch.column(k).to_pylist() for k in range(6))
            out: list[tuple] = []
            for g, x, h, s, a, b in zip(group, node, hub, size, map(_u64, mine), map(_u64, other), strict=True):
                extra = np.setdiff1d(a, b, assume_unique=True)
                missing = np.setdiff1d(b, a, assume_unique=True)
                n, nh, d = len(a), len(b), len(extra) + len(missing)
                shared = n - len(extra)
                linked = den * shared >= num * (n + nh - shared)
                far = d - tau * (1 + 1 / ratio) * n
                half = (d - tau * (n - nh)) / 2
                # Rounded down by a little: one element more in a prefix is harmless, one less isn't.
                lone = d + 1 - max(1, int(np.ceil(max(far, half) - 1e-6)))
                most = lone if linked else d + 1 - max(1, int(np.ceil(far - 1e-6)))
                out.append((g, x, n, d, linked, lone, most, s, np.concatenate((extra, missing)).tobytes(), None if x == h else h))
            cols = list(zip(*out, strict=True)) if out else [[]] * 10
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

    schema = "grp binary, node binary, n bigint, d bigint, linked boolean, lone bigint, most bigint, size bigint, rest binary, hub binary"
    names = [part.split()[0] for part in schema.split(", ")]
    kinds = (pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
    return rows.select("grp", "node", "hub", "size", "elements", "hub_elements").mapInArrow(run, schema)


def _exploded(rest: DataFrame, whole: bool) -> DataFrame:
    """A row for each element of the differences, or of the part that has to meet others, with its position."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [_u64(v)[: None if whole else max(0, a, b)] for v, a, b in zip(*(batch.column(k).to_pylist() for k in (7, 5, 6)), strict=True)]
            sizes = np.array([len(v) for v in lists], dtype=np.int64)
            take = pa.array(np.repeat(np.arange(len(lists)), sizes))
            flat = np.concatenate([*lists, np.zeros(0, np.uint64)]).view(np.int64)
            places = np.concatenate([*(np.arange(k) for k in sizes.tolist()), np.zeros(0, np.int64)]).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*(batch.column(k).take(take) for k in range(7)), pa.array(flat), pa.array(places)], names=names)

    schema = "grp binary, node binary, n bigint, d bigint, linked boolean, lone bigint, most bigint, element bigint, at bigint"
    names = [part.split()[0] for part in schema.split(", ")]
    return rest.select(*names[:7], "rest").mapInArrow(run, schema)


def _indexed(rest: DataFrame) -> DataFrame:
    """The elements by which links are found, in one order within each group: large groups' rarest elements first."""
    plain = _exploded(rest.where(F.col("size") < ORDERED), whole=False)
    large = _exploded(rest.where(F.col("size") >= ORDERED), whole=True).drop("at")
    often = large.groupBy("grp", "element").agg(F.count(F.lit(1)).alias("often"))
    place = F.row_number().over(W.partitionBy("grp", "node").orderBy("often", "element")) - 1
    ranked = large.join(often, ["grp", "element"]).withColumn("at", place.cast("bigint")).drop("often")
    return plain.unionByName(ranked).where(F.col("at") < F.greatest("lone", "most"))


def _confirmed(pairs: DataFrame, num: int, den: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for n, m, a, b in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4, 5)), strict=True):
                a, b = _u64(a), _u64(b)
                apart = len(a) + len(b) - 2 * len(np.intersect1d(a, b, assume_unique=True))
                keep.append((den + num) * apart <= (den - num) * (n + m))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("a", "b", "n", "m", "ra", "rb").mapInArrow(run, "a binary, b binary")


def _with_hub(groups: DataFrame, sets: DataFrame, hub_sets: DataFrame) -> DataFrame:
    """(grp, set_key, elements) of ``groups`` (grp, node) with its group's hub, a row each.

    Members of large groups are dealt to SPREAD tasks.
    """
    own = groups.select("grp", F.col("node").alias("set_key"))
    heavy = heavy_keys(own, "grp")
    if heavy is None:
        return own.join(sets, "set_key").join(hub_sets, "grp")
    few = F.broadcast(heavy)
    part = F.pmod(F.xxhash64("set_key"), F.lit(SPREAD)).cast("int")
    members = own.join(few, "grp", "left_semi").join(sets, "set_key").withColumn("part", part)
    copies = hub_sets.join(few, "grp", "left_semi").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    return members.join(copies, ["grp", "part"]).drop("part").unionByName(own.join(few, "grp", "left_anti").join(sets, "set_key").join(hub_sets, "grp"))


def _shared_buckets(rows: DataFrame) -> DataFrame:
    """(bucket, set_key, size, first) of the rows (bucket, set_key) whose bucket has more than one."""
    rows = stored(rows, "bands")
    shared = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.min("set_key").alias("first")).where("size > 1")
    found = stored(lookup(rows, shared, "bucket"), "buckets")
    forget(rows)
    return found


def _groups(members: DataFrame) -> DataFrame:
    """(node, grp, meets) of the classes in shared buckets.

    A class goes with the smallest of its buckets' first classes; only those first classes are then connected.
    """
    own = members.groupBy(F.col("set_key").alias("node")).agg(F.min("first").alias("label"), F.sum("size").alias("meets"), F.collect_set("first").alias("firsts"))
    own = stored(own, "labels")
    edges = own.select(F.col("label").alias("a"), F.explode("firsts").alias("b")).where("a <> b").distinct()
    found = components(edges)
    groups = lookup(own.select("node", "label", "meets"), found.withColumnRenamed("node", "label"), "label", "left")
    groups = stored(groups.select("node", F.coalesce("component", "label").alias("grp"), "meets"), "groups")
    forget(own, found)
    return groups


def links(classes: DataFrame, elements_of, num: int, den: int) -> DataFrame:
    """(a, b): confirmed links between classes (set_key, bands), enough to connect all that are connected.

    ``elements_of`` gives (set_key, elements) for a table of set keys.
    """
    tau, ratio = (den - num) / (den + num), num / den
    # A pair's first common element lies early enough for as many to follow as a link needs.
    needed = (F.col("d") + F.col("e") - tau * (F.col("n") + F.col("m"))) / 2
    close = (F.col("n") >= ratio * F.col("m") - 1e-6) & (F.col("m") >= ratio * F.col("n") - 1e-6)
    close &= F.least(F.col("d") - F.col("i"), F.col("e") - F.col("j")) >= needed - 1e-6

    def side(rows: DataFrame, node: str, n: str, d: str, at: str) -> DataFrame:
        return rows.select("grp", "element", F.col("node").alias(node), F.col("n").alias(n), F.col("d").alias(d), F.col("at").alias(at))

    members = _shared_buckets(classes.select("set_key", F.explode("bands").alias("bucket")))
    groups = _groups(members)
    sets = stored(elements_of(groups.select(F.col("node").alias("set_key"))), "sets")
    found = None
    for turn in range(1, MOST_ROUNDS + 1):
        hubs = groups.groupBy("grp").agg(F.max(F.struct("meets", "node")).getField("node").alias("hub"), F.count(F.lit(1)).alias("size"))
        hub_sets = stored(hubs.join(sets.select(F.col("set_key").alias("hub"), F.col("elements").alias("hub_elements")), "hub"), "hubs")
        rest = stored(_differences(_with_hub(groups, sets, hub_sets).withColumnRenamed("set_key", "node"), num, den), "differences")
        index = stored(_indexed(rest), "index")
        lone, linked = index.where("NOT linked AND at < most"), index.where("linked AND at < most")
        pairs = side(lone, "a", "n", "d", "i").join(side(linked, "b", "m", "e", "j"), ["grp", "element"]).where(close)
        alone = index.where("NOT linked AND at < lone")
        rows, left = rest.agg(F.count(F.lit(1)), F.count_if(~F.col("linked"))).first()
        meet = alone.groupBy("grp", "element").agg(F.count(F.lit(1)).cast("double").alias("c")).agg(F.sum(F.col("c") * (F.col("c") - 1) / 2)).first()[0] or 0.0
        last = meet <= PAIRS_EACH * left or turn == MOST_ROUNDS or MOST_ROUNDS * (rows - left) < rows
        if last and meet:
            both = side(alone, "a", "n", "d", "i").join(side(alone, "b", "m", "e", "j"), ["grp", "element"]).where(close & (F.col("a") < F.col("b")))
            pairs = pairs.unionByName(both)
        pairs = pairs.select("a", "b", "n", "m").distinct()
        texts = rest.select("node", "rest")
        pairs = pairs.join(texts.withColumnsRenamed({"node": "a", "rest": "ra"}), "a").join(texts.withColumnsRenamed({"node": "b", "rest": "rb"}), "b")
        own = rest.where("linked AND hub IS NOT NULL").select(F.col("node").alias("a"), F.col("hub").alias("b")).unionByName(_confirmed(pairs, num, den))
        own = stored(own, "links")
        found = own if found is None else found.unionByName(own)
        old = (hub_sets, rest, index, members, groups)
        if not last:
            members = _shared_buckets(members.select("set_key", "bucket").join(rest.where("NOT linked").select(F.col("node").alias("set_key")), "set_key", "left_semi"))
            groups = _groups(members)
        forget(*old)
        if last:
            forget(sets)
            return found
    raise AssertionError("the last turn returns")


def near_duplicates(docs: DataFrame, percent: int = 85, width: int = 5, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, n_copies) for each row of ``docs`` (doc_id, text).

    Documents are linked if 100 * |A & B| >= percent * |A | B| for their sets of ``width``-word shingles (A-Z
    lower-cased; fewer words are one shingle); component_id is the smallest doc_id that links lead to.  Null, empty
    and wordless texts have an empty set, are linked with nothing and are kept.  Repeated rows are copies of each
    other and give a row each; a row whose doc_id is null links others but is never a representative, has the
    component of its copies (null without any) and is not kept unless nothing stands for it.  Other columns are
    ignored; an empty table gives an empty table.
    """
    made = stored(sketches(docs, width, bands, rows), "sketches")
    classes = _resolved(docs, made, percent, width)
    rows_ = lookup(made.select("doc_id", "n_shingles", "set_key"), classes.select("set_key", "cid", "n_copies"), "set_key", "left")
    component = F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("cid"))
    kept = F.coalesce(F.col("doc_id") == component, component.isNull(), F.lit(False))
    return rows_.select("doc_id", "n_shingles", component.alias("component_id"), kept.alias("kept"), F.coalesce("n_copies", F.lit(1).cast("bigint")).alias("n_copies"))


def _resolved(docs: DataFrame, made: DataFrame, percent: int, width: int) -> DataFrame:
    """(set_key, first, n_copies, cid, head) of the classes of the sketches ``made`` of ``docs``.

    ``first`` is the smallest doc_id of the class, ``cid`` is the smallest of the component,
    null if no row of it has one; ``head`` tells the one class of the component that stands for it.
    """
    one = F.min(F.struct(F.col("doc_id").isNull().alias("late"), "doc_id")).getField("doc_id").alias("first")
    classes = made.where("set_key IS NOT NULL").groupBy("set_key").agg(one, F.count(F.lit(1)).alias("n_copies"), F.first("bands").alias("bands"))
    classes = stored(classes, "classes")

    def elements_of(keys: DataFrame) -> DataFrame:
        # The texts of one document of each class; rows without a doc_id are read too, they have no other handle.
        wanted = classes.select("set_key", "first").join(keys, "set_key")
        ids = small(stored(wanted.where("first IS NOT NULL").select(F.col("first").alias("doc_id")).distinct(), "ids"))
        texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
        texts = texts.join(ids, "doc_id", "left_semi").unionByName(texts.where("doc_id IS NULL"))
        sets = shingle_sets(texts.select("doc_id", "text"), width)
        return sets.groupBy("set_key").agg(F.first("elements").alias("elements")).join(keys, "set_key", "left_semi")

    joined = components(links(classes, elements_of, percent, 100))
    firsts = joined.join(classes.select(F.col("set_key").alias("node"), "first"), "node")
    # Nulls last; of equal ids the smaller set_key.
    best = firsts.groupBy("component").agg(F.min(F.struct(F.col("first").isNull().alias("late"), "first", "node")).alias("best"))
    best = best.select("component", F.col("best.first").alias("cid"), F.col("best.node").alias("head"))
    of_class = small(stored(lookup(joined, best, "component").select(F.col("node").alias("set_key"), "cid", "head"), "of-class"))
    out = classes.select("set_key", "first", "n_copies").join(of_class, "set_key", "left")
    own = F.col("head").isNull()
    out = out.select("set_key", "first", "n_copies", F.when(own, F.col("first")).otherwise(F.col("cid")).alias("cid"), (own | (F.col("head") == F.col("set_key"))).alias("head"))
    return stored(out, "resolved")


def set_keys(text: Column, width: int = 5) -> Column:
    """The digest of a text column's set of shingles; null where there is no word."""

    @F.arrow_udf("binary")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([_digest(s) if len(s) else None for sets in _sets(texts, width) for s in sets], pa.binary())

    return of(text.cast("string"))


def keep_first(docs: DataFrame, percent: int = 85, width: int = 5) -> DataFrame:
    """One row of each component of :func:`near_duplicates`, with all its columns, whatever their names.

    That is a row of the smallest doc_id; where a component has none, any row of one text.  Two different texts under
    one doc_id are two texts: each is kept or dropped with its own component.  Wordless texts are kept, repeated rows
    of them (doc_id, text) once.
    """
    made = stored(sketches(docs, width), "sketches")
    heads = _resolved(docs, made, percent, width).where("head").select("set_key", "first")
    # Rows that could stand for their class: of repeated ones there is more than one.
    rows = lookup(made.select("doc_id", "set_key"), heads, "set_key").where(F.col("doc_id").eqNullSafe(F.col("first")))
    heads = stored(rows.groupBy("set_key", "first").agg(F.count(F.lit(1)).alias("rows")), "heads")
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")  # user columns can't clash with those made here
    doc_id = F.col("doc_id").cast("bigint").alias("doc_id")
    keyed = docs.select(row, doc_id, set_keys(F.col("text"), width).alias("set_key"))

    def standing(some: DataFrame) -> DataFrame:
        some = small(some.select(F.col("set_key").alias("head"), "first"))
        return keyed.join(some, (F.col("set_key") == F.col("head")) & F.col("doc_id").eqNullSafe(F.col("first")), "left_semi")

    once = standing(heads.where("rows = 1"))
    more = standing(heads.where("rows > 1")).dropDuplicates(["set_key"])
    wordless = keyed.where("set_key IS NULL")
    wordless = wordless.withColumn("text", F.col("row.text")).dropDuplicates(["doc_id", "text"]).drop("text")
    return once.unionByName(more).unionByName(wordless).select("row.*")
