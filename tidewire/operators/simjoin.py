"""Similarity join of arrays of distinct tokens by their Dice coefficient, exact."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .lineage import components, contract, lookup, stored


def prefix_size(n: Column, threshold: float) -> Column:
    """How many of n tokens, in one order for all rows, have to be indexed so that no pair is missed."""
    shared = F.ceil(n * (threshold / (2 - threshold)) - 1e-9)
    return n - shared + 1


def similar_pairs(df: DataFrame, key: str, tokens: str, threshold: float, same: Sequence[str] = (), apart: str | None = None, length: str | None = None) -> DataFrame:
    """(a, b, similarity) with a < b for all pairs of rows whose Dice is at least ``threshold``.

    ``key`` is unique.  ``same`` are columns that have to agree.  ``apart`` is one that has to differ: tokens that only
    rows of one value have are not joined at all.  ``length`` is a number whose bound 2 * least / sum has to reach the
    threshold as well.  From ``PARTS_FROM`` on, sets that have equal parts are compared in blocks; with ``apart``, tokens are
    ordered by their number of rows, rarest first, and only each row's prefix is indexed.  Below, where most sets share a
    token of their prefixes, sketches of all sets that may be alike are held against each other.  All miss nothing, and the
    exact coefficient is computed on the candidates.  Rows without tokens are similar to nothing.
    """
    rows, keys = _rows(df, key, tokens, threshold, same, apart, length)
    if threshold >= PARTS_FROM and not apart:
        if dict(rows.dtypes)["k"] == "bigint":
            return _compared(_blocks(rows.withColumnRenamed("k", "id"), threshold, keys), threshold, False)
        # The number goes with the row, so it is written before it is used twice.
        rows = stored(rows.withColumn("id", F.monotonically_increasing_id()), "keys")
        pairs = _compared(_blocks(rows.drop("k"), threshold, keys), threshold, False)
        side = lambda p: rows.select(F.col("id").alias(p), F.col("k").alias(f"k_{p}"))
        found = pairs.join(side("a"), "a").join(side("b"), "b")
        return found.select(F.least("k_a", "k_b").alias("a"), F.greatest("k_a", "k_b").alias("b"), "similarity")
    if threshold < PARTS_FROM:
        rows = stored(rows, "sets")
        pairs = stored(_near_sketches(rows, threshold, keys, bool(apart)), "candidates")
    else:
        pairs = _common_prefixes(rows, threshold, keys, bool(apart))
    side = lambda p: rows.select(F.col("k").alias(p), *[F.col(c).alias(f"{c}_{p}") for c in ("k", "tokens", "length", *keys)])
    found = pairs.join(side("a"), "a").join(side("b"), "b")
    for c in keys:
        found = found.where(F.col(f"{c}_a") == F.col(f"{c}_b"))
    if length:
        found = found.where(2.0 * F.least("length_a", "length_b") / (F.col("length_a") + F.col("length_b")) >= threshold)
    score = 2.0 * F.size(F.array_intersect("tokens_a", "tokens_b")) / (F.size("tokens_a") + F.size("tokens_b"))
    found = found.select("k_a", "k_b", score.alias("similarity")).where(F.col("similarity") >= threshold)
    return found.select(F.least("k_a", "k_b").alias("a"), F.greatest("k_a", "k_b").alias("b"), "similarity")


def similar_counts(df: DataFrame, key: str, tokens: str, threshold: float) -> DataFrame:
    """(key, links): how many pairs of :func:`similar_pairs` a row is in, if in any; ``key`` is a bigint and no pair is written."""
    if threshold < PARTS_FROM:
        raise ValueError(f"counts without pairs need a threshold of at least {PARTS_FROM}")
    rows, keys = _rows(df, key, tokens, threshold, (), None, None)
    each = _compared(_blocks(rows.withColumnRenamed("k", "id"), threshold, keys), threshold, True)
    return each.groupBy(F.col("id").alias(key)).agg(F.sum("links").alias("links"))


def _rows(df: DataFrame, key: str, tokens: str, threshold: float, same: Sequence[str], apart: str | None, length: str | None) -> tuple[DataFrame, list[str]]:
    if not 0 < threshold <= 1:
        raise ValueError("the threshold has to be within 0 and 1, and not 0")
    size = F.col(length).cast("int") if length else F.lit(1)
    rows = df.select(F.col(key).alias("k"), F.col(tokens).alias("tokens"), size.alias("length"), *[F.col(c).alias(f"same_{i}") for i, c in enumerate(same)], *([F.col(apart).alias("apart")] if apart else [])).where(F.size("tokens") > 0)
    return rows, [f"same_{i}" for i in range(len(same))]


#: Sets of one side are sent to the other side's tasks if there are at most so many.
SENT_SETS = 2000


def similar_to(rows: DataFrame, items: DataFrame, row: str, item: str, tokens: str, threshold: float) -> DataFrame:
    """(row, item) for every row of ``rows`` and ``items`` (a bigint key and tokens each) whose Dice is at least ``threshold``.

    Few items (counted) are sent to the tasks of the rows, which are held against all of them, with no shuffle; more go
    through :func:`similar_pairs`.
    """
    whole = lambda df, key: df.where(F.size(tokens) > 0).select(F.col(key).alias("k"), F.transform(tokens, lambda t: F.xxhash64(t)).alias("h"))
    sent = whole(items, item).limit(SENT_SETS + 1).collect()  # at most SENT_SETS + 1 rows
    if len(sent) > SENT_SETS:
        sides = [df.select(F.concat(F.lit(c), F.col(key).cast("string")).alias("k"), tokens, F.lit(c).alias("side")) for df, key, c in ((rows, row, "r"), (items, item, "i"))]
        pairs = similar_pairs(sides[0].unionByName(sides[1]), "k", tokens, threshold, apart="side")
        number = lambda c: F.substr(F.col(c), F.lit(2)).cast("bigint")
        return pairs.select(number("b").alias(row), number("a").alias(item))
    keys, sets = np.array([r.k for r in sent], np.int64), [np.array(r.h, np.int64) for r in sent]
    found = whole(rows, row).mapInArrow(lambda batches: _met(batches, keys, sets, threshold), "row long, item long")
    return found.select(F.col("row").alias(row), F.col("item").alias(item))


def _met(batches: Iterator[pa.RecordBatch], keys: np.ndarray, sets: list[np.ndarray], threshold: float) -> Iterator[pa.RecordBatch]:
    if not len(keys):
        return
    sizes = np.array([len(s) for s in sets])
    names, code = np.unique(np.concatenate(sets), return_inverse=True)
    of = np.repeat(np.arange(len(sets)), sizes)
    for whole in batches:
        for start in range(0, whole.num_rows, BLOCK_ROWS):
            batch = whole.slice(start, BLOCK_ROWS)
            ids = batch.column(0).to_numpy()
            values, own = _lists(batch.column(1))
            place = np.minimum(np.searchsorted(names, values), len(names) - 1)
            known = names[place] == values
            row, place = np.repeat(np.arange(len(ids)), own)[known], place[known]
            met = np.zeros((len(ids), len(keys)), np.float32)
            for low in range(0, len(names), BLOCK_TOKENS):
                left, right = (np.zeros((n, BLOCK_TOKENS), np.float32) for n in (len(ids), len(keys)))
                at, to = (place >= low) & (place < low + BLOCK_TOKENS), (code >= low) & (code < low + BLOCK_TOKENS)
                left[row[at], place[at] - low] = 1
                right[of[to], code[to] - low] = 1
                met += left @ right.T
            x, y = np.nonzero(2.0 * met.astype(np.float64) / (own[:, None] + sizes[None, :]) >= threshold)
            yield pa.record_batch([pa.array(ids[x]), pa.array(keys[y])], ["row", "item"])


#: Rows of one side of a unit in which sketches are held against each other; a row there has about 60 bytes.
SKETCH_ROWS = 8192


def _near_sketches(rows: DataFrame, threshold: float, keys: Sequence[str], apart: bool) -> DataFrame:
    """(a, b) of rows (k, tokens, ``keys``, apart; stored) whose sketches differ in no more bits than alike sets may.

    The number of comparisons is that of the pairs of rows with different ``apart``, so quadratic, but one is a few
    instructions, and they are dealt out: rows lie in blocks of SKETCH_ROWS, a value of ``apart`` with more rows in blocks
    of its own, and every two blocks that may hold pairs are a unit of work.  Only sketches are sent to the units.
    """
    spark = rows.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    same = F.xxhash64(*keys) if keys else F.lit(0).cast("bigint")
    told = F.xxhash64("apart") if apart else F.lit(0).cast("bigint")
    k = rows.schema["k"].dataType.simpleString()
    hashed = rows.repartition(tasks).select("k", same.alias("same"), told.alias("apart"), F.transform("tokens", lambda t: F.xxhash64(t)).alias("h"))
    drawn = stored(hashed.mapInArrow(_drawn, f"k {k}, same long, apart long, n int, {_SKETCH}"), "sketches")
    sizes = drawn.groupBy("apart").agg(F.count(F.lit(1)).alias("n"))
    large = sizes.where(F.col("n") > SKETCH_ROWS).collect() if apart else []  # at most a row for SKETCH_ROWS
    rest, places, count = drawn.count() - sum(r.n for r in large), [], 0
    for r in large:
        places.append((r.apart, count, -(-r.n // SKETCH_ROWS)))
        count += places[-1][2]
    others = max(1, -(-rest // SKETCH_ROWS))
    placed = drawn.join(F.broadcast(spark.createDataFrame(places, "apart long, low int, blocks int")), "apart", "left")
    block = F.coalesce("low", F.lit(count)) + F.pmod(F.xxhash64("k"), F.coalesce("blocks", F.lit(others))).cast("int")
    all_ = F.sequence(F.lit(0), F.lit(count + others - 1))
    met = F.when(F.col("low").isNull(), all_).otherwise(F.filter(all_, lambda x: (x < F.col("low")) | (x >= F.col("low") + F.col("blocks"))))
    each = placed.withColumn("block", block).withColumn("other", F.explode(met))
    each = each.select(F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "k", "same", "apart", "n", *[f"s{x}" for x in range(4)])
    units = each.repartition(tasks, "i", "j").sortWithinPartitions("i", "j")
    return units.mapInArrow(lambda batches: _near(batches, threshold, apart), f"a {k}, b {k}")


def _drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values, sizes = _lists(batch.column(3))
        sketch = _sketches(values.view(np.uint64), np.repeat(np.arange(batch.num_rows), sizes), batch.num_rows)
        own = [pa.array(np.ascontiguousarray(sketch[:, c]).view(np.int64)) for c in range(4)]
        yield pa.record_batch([*batch.columns[:3], pa.array(sizes.astype(np.int32)), *own], ["k", "same", "apart", "n", "s0", "s1", "s2", "s3"])


def _sketches(values: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    sketch = np.zeros((rows, 4), np.uint64)
    bit = _mixed(values)
    np.bitwise_xor.at(sketch, (row, (bit % np.uint64(4)).astype(np.int64)), np.uint64(1) << (bit >> np.uint64(58)))
    return sketch


def _near(batches: Iterator[pa.RecordBatch], threshold: float, apart: bool) -> Iterator[pa.RecordBatch]:
    for (i, j), held in _units(batches, 2):
        table = pa.Table.from_batches(held).combine_chunks()
        k, block = table.column("k").chunk(0), table.column("block").to_numpy()
        same, told, n = (table.column(c).to_numpy() for c in ("same", "apart", "n"))
        sketch = np.stack([table.column(f"s{c}").to_numpy() for c in range(4)], 1).view(np.uint64)
        left, right = (np.arange(len(k)),) * 2 if i == j else (np.flatnonzero(block == i), np.flatnonzero(block == j))
        words = [np.ascontiguousarray(sketch[right, c]) for c in range(4)]
        n, own = n.astype(np.float32), n[right].astype(np.float32)
        for low in range(0, len(left), 64):
            some = left[low : low + 64]
            differ = np.zeros((len(some), len(right)), np.uint16)
            for c in range(4):
                differ += np.bitwise_count(sketch[some, c][:, None] ^ words[c][None, :])
            x, y = np.nonzero(differ <= (1 - threshold) * (n[some][:, None] + own[None, :]) + 1e-3)
            a, b = some[x], right[y]
            may = (same[a] == same[b]) & (2.0 * np.minimum(n[a], n[b]) >= threshold * (n[a] + n[b]) - 1e-3)
            may &= (told[a] != told[b]) if apart else True
            may &= (a < b) if i == j else True
            if may.any():
                yield pa.record_batch([k.take(pa.array(a[may])), k.take(pa.array(b[may]))], ["a", "b"])


def _units(batches: Iterator[pa.RecordBatch], columns: int) -> Iterator[tuple[tuple, list[pa.RecordBatch]]]:
    """The rows of each unit of work: equal values of the first ``columns`` columns, by which rows are sorted."""
    held, unit = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        place = np.stack([batch.column(c).to_numpy() for c in range(columns)], 1)
        cuts = [0, *(np.flatnonzero((place[1:] != place[:-1]).any(axis=1)) + 1).tolist(), len(place)]
        for low, high in zip(cuts, cuts[1:], strict=False):
            if held and unit != tuple(place[low]):
                yield unit, held
                held = []
            unit = tuple(place[low])
            held.append(batch.slice(low, high - low))
    if held:
        yield unit, held


def _common_prefixes(rows: DataFrame, threshold: float, keys: Sequence[str], apart: bool) -> DataFrame:
    """(a, b) of rows (k, tokens, ``keys``, apart) that share a token of their prefixes and may share enough others."""
    told = ["apart"] if apart else []
    each = rows.select("k", *keys, *told, F.size("tokens").alias("n"), F.explode("tokens").alias("token"))
    often = each.groupBy("token").agg(F.count(F.lit(1)).alias("often"))
    place = F.row_number().over(W.partitionBy("k").orderBy("often", "token"))
    index = each.join(often, "token").withColumn("place", place).where(F.col("place") <= prefix_size(F.col("n"), threshold))
    index = index.select("k", *keys, *told, "n", "token", "place")
    if apart:
        mixed = index.groupBy("token", *keys).agg((F.min("apart") != F.max("apart")).alias("mixed")).where("mixed").drop("mixed")
        index = index.join(mixed, ["token", *keys], "left_semi")
    left = index.select(F.col("k").alias("a"), *keys, *[F.col(c).alias("apart_a") for c in told], F.col("n").alias("na"), "token", F.col("place").alias("pa"))
    right = index.select(F.col("k").alias("b"), *keys, *[F.col(c).alias("apart_b") for c in told], F.col("n").alias("nb"), "token", F.col("place").alias("pb"))
    least = math.nextafter(threshold, 0) * (F.col("na") + F.col("nb")) / 2 - 1e-9
    room = F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb")) + 1
    return left.join(right, ["token", *keys]).where((F.col("a") < F.col("b")) & (room >= least) & ((F.col("apart_a") != F.col("apart_b")) if apart else F.lit(True))).select("a", "b").distinct()


#: Lower thresholds would need parts of two or three tokens, which unlike sets share.
PARTS_FROM = 0.8

#: By the differences that a part may have: into how many cells it is dealt, and the choices of cells without one.
_CELLS = tuple((1 if k == 0 else k + 3, [[0]] if k == 0 else [list(c) for c in combinations(range(k + 3), 3)]) for k in range(4))


def size_steps(threshold: float, most: int = 2**31 - 2) -> list[int]:
    """Sizes from 1 up: of two sets of that Dice, the smaller one's step is the larger one's or the one before."""
    steps, wider = [1], max((2 - threshold) / threshold, 1.2)
    while steps[-1] <= most:
        steps.append(int(steps[-1] * wider) + 1)
    return steps


#: Rows of one side of a block, and tokens of which products are summed at a time.
BLOCK_ROWS, BLOCK_TOKENS = 1000, 4096

#: A bit of 256 for each token's hash, those of a set added modulo 2: sets of D differences differ in D bits at most.
_SKETCH = ", ".join(f"s{k} long" for k in range(4))


def _blocks(rows: DataFrame, threshold: float, keys: Sequence[str]) -> DataFrame:
    """The rows (id, tokens, length, ``keys``) in blocks (component, i, j), sorted by them, in which all alike pairs meet once.

    Sets of at most u tokens with that Dice differ in D = (1 - threshold) * 2u tokens at most.  Tokens are dealt by their
    hash to D // 4 + 1 parts, so one part has at most three differences, and each part to six cells (fewer for fewer
    differences), of which three then have none: any three cells of a part are a signature, and alike sets share one.  A
    signature stands for about ten tokens, so unlike sets hardly meet, however common their tokens are.  Each set signs in
    its step of sizes and in the next one.  Sets of a signature are linked with few of them (:func:`_linked`), so no pairs
    are made; alike sets lie in one component of these links.  A component is dealt by hash to blocks of about BLOCK_ROWS,
    and each pair of blocks is a unit of work.
    """
    spark = rows.sparkSession
    steps = size_steps(threshold)
    # Comparing is work for all cores, however few bytes the sets have.
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    same = F.xxhash64(*keys) if keys else F.lit(0).cast("bigint")
    hashed = stored(rows.repartition(tasks).select("id", same.alias("same"), "length", F.transform("tokens", lambda t: F.xxhash64(t)).alias("h")), "sets")
    step = F.size(F.filter(F.array(*map(F.lit, steps)), lambda s: s <= F.size("h")))
    used = sorted(r[0] for r in hashed.select(step.alias("step")).distinct().collect())  # at most one number a step
    signed = hashed.select("id", "same", "h").mapInArrow(lambda batches: _signed(batches, threshold, used), f"signature long, id long, differ int, {_SKETCH}")
    stars = signed.repartition(tasks, "signature").sortWithinPartitions("signature", "id").mapInArrow(lambda batches: contract(_stars(batches)), "a long, b long")
    found = stored(components(stars), "components")
    sizes = found.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("blocks"))
    placed = lookup(found, sizes, "component").select(F.col("node").alias("id"), "component", "blocks", F.pmod(F.xxhash64("node"), "blocks").cast("int").alias("block"))
    each = hashed.join(placed, "id").select("component", "block", "id", "same", "length", "h", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    each = each.select("component", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "id", "same", "length", "h")
    return each.repartition(tasks, "component", "i", "j").sortWithinPartitions("component", "i", "j")


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of an array of lists one after the other, and the size of each list."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.diff(column.offsets.to_numpy()).astype(np.int64)


def _signed(batches: Iterator[pa.RecordBatch], threshold: float, used: Sequence[int]) -> Iterator[pa.RecordBatch]:
    """(signature, id) of rows (id, same, h) in the steps of sizes that are used."""
    steps = np.array(size_steps(threshold))
    for whole in batches:
        for start in range(0, whole.num_rows, 1000):
            batch = whole.slice(start, 1000)
            ids, same = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
            values, sizes = _lists(batch.column(2))
            values, row = values.view(np.uint64), np.repeat(np.arange(len(ids)), sizes)
            step = np.searchsorted(steps, sizes, "right")
            sketch = _sketches(values, row, len(ids))
            for level in used:
                differ = int((1 - threshold) * 2 * (int(steps[level]) - 1) + 1e-6)
                parts = differ // 4 + 1
                cells, choices = _CELLS[differ // parts]
                rows = np.flatnonzero((step == level) | (step == level - 1))
                if not len(rows):
                    continue
                place = np.full(len(ids), -1)
                place[rows] = np.arange(len(rows))
                at = place[row] >= 0
                sums = np.zeros((len(rows), parts * cells), np.uint64)
                np.bitwise_xor.at(sums, (place[row[at]], (values[at] % np.uint64(parts * cells)).astype(np.int64)), values[at])
                sums = sums.reshape(len(rows), parts, cells)
                for k, choice in enumerate(choices):
                    seed = _mixed(np.arange(parts, dtype=np.uint64) + np.uint64((level * 64 + k) << 32))
                    x = _mixed(same[rows].view(np.uint64)[:, None] ^ seed[None, :])
                    for c in choice:
                        x = _mixed(x ^ sums[:, :, c])
                    whose = np.repeat(rows, parts)
                    own = [pa.array(np.ascontiguousarray(sketch[whose, c]).view(np.int64)) for c in range(4)]
                    yield pa.record_batch([pa.array(x.reshape(-1).view(np.int64)), pa.array(ids[whose]), pa.array(np.full(len(whose), differ, np.int32)), *own], ["signature", "id", "differ", "s0", "s1", "s2", "s3"])


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b): links of each signature's ids, of rows sorted by it; no more than one signature's rows and a batch are held."""
    held: list[np.ndarray] = []
    for batch in batches:
        if batch.num_rows:
            held.append(np.stack([batch.column(c).to_numpy().astype(np.int64) for c in range(7)], 1))
            if held[0][0, 0] != held[-1][-1, 0]:  # the last signature may go on
                rows = np.concatenate(held)
                cut = int(np.flatnonzero(rows[:, 0] != rows[-1, 0])[-1]) + 1
                yield from _links(rows[:cut])
                held = [rows[cut:]]
    if held:
        yield from _links(np.concatenate(held))


def _links(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
    ids, sketch = rows[:, 1], np.ascontiguousarray(rows[:, 3:]).view(np.uint64)
    cuts = np.flatnonzero(np.concatenate([[True], rows[1:, 0] != rows[:-1, 0], [True]]))
    sizes = np.diff(cuts)
    two = cuts[:-1][sizes == 2]
    near = two[np.bitwise_count(sketch[two] ^ sketch[two + 1]).sum(axis=1) <= rows[two, 2]]
    found = [np.stack([ids[near], ids[near + 1]], 1)]
    for k in np.flatnonzero(sizes > 2).tolist():
        found += _linked(ids[cuts[k] : cuts[k + 1]], sketch[cuts[k] : cuts[k + 1]], int(rows[cuts[k], 2]))
    edges = np.unique(np.concatenate(found), axis=0)
    for low in range(0, len(edges), 100_000):
        some = edges[low : low + 100_000]
        yield pa.record_batch([pa.array(some[:, 0].copy()), pa.array(some[:, 1].copy())], ["a", "b"])


def _linked(ids: np.ndarray, sketch: np.ndarray, differ: int) -> Iterator[np.ndarray]:
    """Links (a, b) that connect all ids of sketches which differ in ``differ`` bits at most.

    One id after the other is a hub and takes all that are so near out of the others.  What is near one of those is at
    most twice as far from the hub: it is linked too, and stays for hubs to come.
    """
    while len(ids) > 1:
        far = np.bitwise_count(sketch ^ sketch[0]).sum(axis=1)
        near, next_ = far <= differ, np.flatnonzero((far > differ) & (far <= 2 * differ))
        if near.sum() * len(next_) <= 1_000_000 and len(next_):
            least = np.bitwise_count(sketch[next_][:, None, :] ^ sketch[near][None, :, :]).sum(axis=2).min(axis=1)
            next_ = next_[least <= differ]
        to = np.concatenate([np.flatnonzero(near)[1:], next_])
        yield np.stack([np.full(len(to), ids[0]), ids[to]], 1)
        ids, sketch = ids[~near], sketch[~near]


def _compared(blocks: DataFrame, threshold: float, counted: bool) -> DataFrame:
    """(a, b, similarity) of :func:`_blocks`, or the links (id, links) that each block has for its rows."""
    out = "id long, links long" if counted else "a long, b long, similarity double"
    return blocks.mapInArrow(lambda batches: _pairs(batches, threshold, counted), out)


def _pairs(batches: Iterator[pa.RecordBatch], threshold: float, counted: bool) -> Iterator[pa.RecordBatch]:
    for _, held in _units(batches, 3):
        yield from _block_pairs(held, threshold, counted)


def _block_pairs(held: list[pa.RecordBatch], threshold: float, counted: bool) -> Iterator[pa.RecordBatch]:
    table = pa.Table.from_batches(held).combine_chunks()
    i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
    block, ids, same, length = (table.column(c).to_numpy() for c in ("block", "id", "same", "length"))
    values, sizes = _lists(table.column("h").chunk(0))
    row = np.repeat(np.arange(len(ids)), sizes)
    _, code, often = np.unique(values, return_inverse=True, return_counts=True)
    # Tokens of one row are in no intersection.
    number = np.cumsum(often > 1) - 1
    row, code = row[often[code] > 1], number[code[often[code] > 1]]
    left, right = (np.arange(len(ids)),) * 2 if i == j else (np.flatnonzero(block == i), np.flatnonzero(block == j))
    met = np.zeros((len(left), len(right)), np.float32)
    for low in range(0, int((often > 1).sum()), BLOCK_TOKENS):
        at = (code >= low) & (code < low + BLOCK_TOKENS)
        has = np.zeros((len(ids), BLOCK_TOKENS if len(ids) > 64 else int(code[at].max()) - low + 1), np.float32)
        has[row[at], code[at] - low] = 1
        met += has[left] @ has[right].T
    links = np.zeros(len(ids), np.int64)
    for low in range(0, len(left), 256):
        some = left[low : low + 256]
        dice = 2.0 * met[low : low + 256].astype(np.float64) / (sizes[some][:, None] + sizes[right][None, :])
        bound = 2.0 * np.minimum(length[some][:, None], length[right][None, :]) / (length[some].astype(np.int64)[:, None] + length[right][None, :])
        alike = (dice >= threshold) & (bound >= threshold) & (same[some][:, None] == same[right][None, :])
        if i == j:
            alike &= ids[some][:, None] < ids[right][None, :]
        x, y = np.nonzero(alike)
        if counted:
            links += np.bincount(some[x], minlength=len(ids)) + np.bincount(right[y], minlength=len(ids))
        elif len(x):
            a, b = ids[some[x]], ids[right[y]]
            yield pa.record_batch([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(dice[x, y])], ["a", "b", "similarity"])
    if links.any():
        yield pa.record_batch([pa.array(ids[links > 0]), pa.array(links[links > 0])], ["id", "links"])


def set_classes(df: DataFrame, key: str, tokens: str, by: Sequence[str] = ()) -> DataFrame:
    """(class_id, tokens, ``by``, set) for each different set of tokens (and values of ``by``): its smallest key names it.

    A null array counts as an empty one.  ``set`` is the digest by which :func:`class_members` finds a row's class.
    """
    rows = _with_digest(df, key, tokens, by)
    return rows.groupBy("set").agg(F.min(key).alias("class_id"), *[F.any_value(c).alias(c) for c in (tokens, *by)])


def class_members(df: DataFrame, key: str, tokens: str, pairs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(key, class_id, links) for every row: its class of equal sets, and how many other classes ``pairs`` (a, b) has with it.

    A set that a large part of the rows has is looked up where they are.
    """
    both = pairs.select(F.col("a").alias("class_id")).unionByName(pairs.select(F.col("b").alias("class_id")))
    return class_links(df, key, tokens, both.groupBy("class_id").agg(F.count(F.lit(1)).alias("links")), by)


def class_links(df: DataFrame, key: str, tokens: str, links: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """:func:`class_members` of links (class_id, links) that are counted already."""
    classes = set_classes(df, key, tokens, by).select("set", "class_id").join(links, "class_id", "left")
    rows = stored(_with_digest(df, key, tokens, by).select(key, "set"), "members")
    return lookup(rows, classes, "set").select(key, "class_id", F.coalesce("links", F.lit(0)).cast("bigint").alias("links"))


def class_equals(df: DataFrame, key: str, tokens: str, by: Sequence[str] = ()) -> DataFrame:
    """(a, b): each class of :func:`set_classes`, and every other row of it; empty sets are equal to nothing."""
    whole = df.where(F.size(F.coalesce(F.col(tokens), F.array().cast("array<string>"))) > 0)
    rows = stored(_with_digest(whole, key, tokens, by).select(key, "set"), "members")
    classes = rows.groupBy("set").agg(F.min(key).alias("a"))
    return lookup(rows, classes, "set").where(F.col(key) != F.col("a")).select("a", F.col(key).alias("b"))


def _with_digest(df: DataFrame, key: str, tokens: str, by: Sequence[str]) -> DataFrame:
    whole = F.coalesce(F.col(tokens), F.array().cast("array<string>"))
    rows = df.select(key, whole.alias(tokens), *by)
    return rows.withColumn("set", F.sha2(F.to_json(F.struct(F.array_sort(F.col(tokens)).alias("t"), *by)), 256))


def _windows(words: Column, width: Column | int) -> Column:
    """Each distinct run of ``width`` words; the words are bound once, not made anew for each run."""
    n = lambda w: F.size(w) - width + 1
    runs = lambda w: F.when(n(w) > 0, F.transform(F.sequence(F.lit(1), n(w)), lambda i: F.array_join(F.slice(w, i, width), " "))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.flatten(F.transform(F.array(words), runs)))


#: Runs of items are sent to the texts' tasks if there are at most so many.
SENT_RUNS = 200_000


def containing(texts: DataFrame, items: DataFrame, text: str, item: str, anchor: int = 5) -> DataFrame:
    """The pairs of keys of ``texts`` and ``items`` (key, norm) where a text holds all of an item's words in a row.

    Items are indexed by that run of ``anchor`` words which the fewest items have (by all words, where they are fewer);
    a text meets an item by that run, and its whole text is then looked for.  The items' runs are sent to the texts if
    they are few (counted), so only runs that an item has leave a text's task.  Items without a word are in no pair.
    """
    words = items.where("norm <> ''").select(item, F.col("norm").alias("__item"), F.split("norm", " ").alias("__words"))
    sized = words.withColumn("__width", F.least(F.size("__words"), F.lit(anchor)))
    runs = sized.select(item, "__item", "__width", F.explode(_windows(F.col("__words"), F.col("__width"))).alias("__run"))
    often = runs.groupBy("__run").agg(F.count(F.lit(1)).alias("__n"))
    rarest = runs.join(often, "__run").groupBy(item, "__item", "__width").agg(F.min(F.struct("__n", "__run")).getField("__run").alias("__run"))
    rarest = stored(rarest, "runs")
    widths = sorted(r[0] for r in rarest.select("__width").distinct().collect())  # at most ``anchor`` of them
    few = rarest.limit(SENT_RUNS + 1).count() <= SENT_RUNS
    split = F.split("norm", " ")
    found = F.flatten(F.array(*[_windows(split, w) for w in widths])) if widths else F.array().cast("array<string>")
    each = texts.where("norm <> ''").select(text, F.explode(found).alias("__run"))
    if few:
        each = each.join(F.broadcast(rarest.select("__run").distinct()), "__run", "left_semi")
    met = each.join(F.broadcast(rarest) if few else rarest, "__run").select(text, item, "__item")
    whole = texts.select(text, F.concat(F.lit(" "), "norm", F.lit(" ")).alias("__text"))
    return met.join(whole, text).where(F.contains("__text", F.concat(F.lit(" "), "__item", F.lit(" ")))).select(text, item)
