"""Mixing sources to target weights by iterative proportional fitting.

Tokens are summed by cell (source, language, topic) and the cells are raked, margin after margin, until the sums by
source, by language and by topic meet their targets.  Probabilities of keeping a document follow from its cell's raked
weight, scaled so that the expected number of tokens is the budget; a cell whose probability would pass 1 is held
there and the others are raked on, so the calibration stays within what the corpus has.  A document is then kept by a
hash of itself: the choice is the same on every run and in every partition.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textops as T
from .common import checked, only, small, stored

#: Up to so many cells are raked on the driver (a few dozen bytes each), more by DataFrames.
DRIVER_CELLS = 200_000
_BUCKETS = 512
#: Unit vectors are held in whole steps of 1 / _STEPS: products and sums are then exact in doubles, in any order.
_STEPS = float(1 << 24)
_LOGS = np.log1p(np.arange(256)).astype(np.float32)
MARGINS = ("source", "lang", "topic")
#: Raking ends after so many rounds, or where no probability moves by more.
ROUNDS, TOLERANCE = 200, 1e-9


def word_counts(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed word counts, and the number of words, of the texts bounds[k]:bounds[k+1]."""
    only(("mixing",))
    n = len(bounds) - 1
    hashes, words = T.words(data, bounds)
    count = np.diff(words)
    row = np.repeat(np.arange(n), count)
    return np.bincount(row * _BUCKETS + (hashes % np.uint64(_BUCKETS)).astype(np.int64), minlength=n * _BUCKETS).reshape(n, _BUCKETS), count


def _unit(counts: np.ndarray) -> np.ndarray:
    """Unit vectors of word counts (damped)."""
    out = _LOGS[counts] if counts.dtype == np.uint8 else np.log1p(counts).astype(np.float32)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def vectors(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors of hashed word counts (damped), and the number of words, of the texts bounds[k]:bounds[k+1]."""
    counts, count = word_counts(data, bounds)
    return _unit(counts), count


def _described(rows: DataFrame) -> DataFrame:
    """(x): the word counts of (text), a byte for each bucket, or four where one is above 255."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = T.utf8(batch.column(0))
            for i, j in T.row_slices(offsets):
                counts, _ = word_counts(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                few, wide = counts.astype(np.uint8), counts.astype(np.uint32)
                high = counts.max(axis=1, initial=0) > 255
                yield pa.RecordBatch.from_arrays([pa.array([(wide if h else few)[k].tobytes() for k, h in enumerate(high)], pa.binary())], names=["x"])

    return rows.select("text").mapInArrow(run, "x binary")


def _steps(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """The unit vectors of (x), in steps."""
    rows = batch.column(0).to_pylist()
    for kind, width in ((np.uint8, _BUCKETS), (np.uint32, 4 * _BUCKETS)):
        some = b"".join(r for r in rows if len(r) == width)
        if some:
            yield np.rint(_unit(np.frombuffer(some, kind).reshape(-1, _BUCKETS)).astype(np.float64) * _STEPS)


def _least_alike(x: DataFrame, centres: np.ndarray) -> np.ndarray | None:
    """The vector that ``centres`` resemble least, the first in the order of its bytes among equals; of none, the first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: tuple[float, bytes] | None = None
        for batch in batches:
            for steps in _steps(batch):
                near = (steps @ centres.T).max(axis=1) if len(centres) else np.zeros(len(steps))
                low = near.min()
                if best is None or low <= best[0]:
                    found = (float(low), min(v.tobytes() for v in steps[near == low].astype(np.uint32)))
                    best = found if best is None else min(best, found)
        if best is not None:
            yield pa.RecordBatch.from_arrays([pa.array([best[0]]), pa.array([best[1]], pa.binary())], names=["near", "x"])

    found = min(((r.near, bytes(r.x)) for r in x.mapInArrow(run, "near double, x binary").collect()), default=None)
    return None if found is None else np.frombuffer(found[1], np.uint32).astype(np.float64)


def _sums(x: DataFrame, centres: np.ndarray) -> np.ndarray:
    """The sum of the vectors nearest to each centre: one partial sum a partition and topic reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(centres), _BUCKETS), np.int64)
        for batch in batches:
            for steps in _steps(batch):
                own = (steps @ centres.T).argmax(axis=1)
                total += (np.eye(len(centres))[own].T @ steps).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["total"])

    found = np.zeros((len(centres), _BUCKETS), np.int64)
    for r in x.mapInArrow(run, "total binary").collect():
        found += np.frombuffer(bytes(r.total), np.int64).reshape(found.shape)
    return found


def fit_topics(docs: DataFrame, topics: int = 8, rounds: int = 12) -> np.ndarray:
    """(topics, _BUCKETS) centres by spherical k-means over all documents with text, those of equal word counts once.

    Word counts are made once, where the texts are; each step is one pass over them.  Sums are exact, so the centres
    are the same in any partitioning.
    """
    texts = docs.where(F.length("text") > 0).select(F.col("text").cast("string").alias("text"))
    x = stored(_described(texts).distinct(), "words")
    first = _least_alike(x, np.zeros((0, _BUCKETS)))
    if first is None:
        return np.zeros((topics, _BUCKETS), np.float32)
    c = first[None]
    while len(c) < topics:  # the text that those chosen resemble least
        c = np.vstack([c, _least_alike(x, c)])
    for _ in range(rounds):
        # A topic without texts has no sum (nor has that of the wordless ones): it stays.
        total = _sums(x, c).astype(np.float64)
        size = np.linalg.norm(total, axis=1, keepdims=True)
        after = np.where(size > 0, np.rint(total / np.maximum(size, 1.0) * _STEPS), c)
        if (after == c).all():
            break
        c = after
    return (c / _STEPS).astype(np.float32)


def topic_and_tokens(centres: np.ndarray, text: Column) -> Column:
    """(topic, tokens) of a text column: the nearest centre, and its words and one for the text itself."""

    @F.arrow_udf("topic int, tokens bigint")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            data, offsets = T.utf8(texts)
            topic, tokens = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
            for i, j in T.row_slices(offsets):
                x, count = vectors(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                topic.append((x @ centres.T).argmax(axis=1).astype(np.int32))
                tokens.append(count + 1)
            yield pa.StructArray.from_arrays([pa.array(np.concatenate(topic)), pa.array(np.concatenate(tokens).astype(np.int64))], names=["topic", "tokens"])

    return of(text.cast("string"))


def _draw() -> Column:
    """A number in [0, 1) that follows from a document alone."""
    return F.xxhash64("doc_id", "text", F.lit(29)).bitwiseAND(F.lit((1 << 52) - 1)) / float(1 << 52)


def described(docs: DataFrame, centres: np.ndarray, *more: Column) -> DataFrame:
    """source, lang, topic, tokens, draw of ``docs`` (doc_id, text, source, lang), and ``more`` columns."""
    seen = docs.select(*more, F.col("source").alias("source"), F.col("lang").alias("lang"), _draw().alias("draw"), topic_and_tokens(centres, F.col("text")).alias("found"))
    kept = [c for c in seen.columns if c != "found"]
    return seen.select(*kept, "found.topic", "found.tokens")


def tempered(totals: dict, power: float = 0.5) -> dict:
    """Target shares between the corpus's own (power 1) and equal ones (power 0)."""
    raised = {k: v**power for k, v in totals.items() if v > 0}
    whole = sum(raised.values())
    return {k: v / whole for k, v in raised.items()}


def _raised(budget: float, level: float, full: float, open_part: float) -> float:
    """The next level: what the full values leave of the budget, by the part of the others."""
    return max(level, (budget - full) / open_part) if open_part > 0 else level


def feasible(parts: np.ndarray, available: np.ndarray, budget: float) -> np.ndarray:
    """Token goals of one margin: parts of the budget, but none above what is available; the rest goes to the others.

    That is min(level * part, available) with the level at which the goals sum up to the budget, or everything that
    values with a part have.
    """
    level = budget
    while True:
        full = level * parts >= available
        after = _raised(budget, level, float(available[full & (parts > 0)].sum()), float(parts[~full].sum()))
        if after <= level * (1 + 1e-12):
            return np.minimum(level * parts, available)
        level = after


def _feasible_frame(goals: DataFrame, budget: float) -> DataFrame:
    """:func:`feasible` for (key, part, available): ``share`` is the goal by the budget."""
    level = budget
    while True:
        full = F.col("part") * level >= F.col("available")
        sums = goals.agg(F.sum(F.when(full & (F.col("part") > 0), F.col("available"))).alias("full"), F.sum(F.when(~full, F.col("part"))).alias("rest")).first()
        after = _raised(budget, level, float(sums.full or 0.0), float(sums.rest or 0.0))
        if after <= level * (1 + 1e-12):
            return goals.select("key", (F.least(F.col("part") * level, F.col("available")) / max(budget, 1e-12)).alias("share"))
        level = after


def rake(tokens: np.ndarray, codes: Sequence[np.ndarray], targets: Sequence[np.ndarray], budget: float, rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> np.ndarray:
    """Each cell's probability: margins of tokens * p meet targets * budget as far as no p passes 1.

    The reference of :func:`probabilities` for one machine.
    """
    p = np.full(len(tokens), min(1.0, budget / max(tokens.sum(), 1e-12)))
    factors = [np.ones(len(t)) for t in targets]
    base = p.copy()
    for _ in range(rounds):
        before = p
        for k, (code, target) in enumerate(zip(codes, targets, strict=True)):
            now = np.bincount(code, tokens * p, minlength=len(target))
            factors[k] = factors[k] * np.divide(target * budget, now, out=np.ones(len(target)), where=now > 0)
            factors[k] = np.minimum(factors[k], 1e12)
            raw = base.copy()
            for c, f in zip(codes, factors, strict=True):
                raw = raw * f[c]
            p = np.minimum(raw, 1.0)
        if np.abs(p - before).max(initial=0.0) < tolerance:
            break
    return p


def _rake_frames(cells: DataFrame, targets: Sequence[DataFrame], budget: float, rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> DataFrame:
    """:func:`rake` for more cells than fit the driver: factors and cells stay DataFrames."""
    base = F.least(F.lit(1.0), F.lit(budget) / F.greatest(F.lit(cells.agg(F.sum("tokens")).first()[0]), F.lit(1e-12)))
    state = cells.withColumns({"base": base, "p": base, **{f"f_{name}": F.lit(1.0) for name in MARGINS}})
    raw = F.col("base")
    for name in MARGINS:
        raw = raw * F.col(f"f_{name}")
    for _ in range(rounds):
        state = state.withColumn("was", F.col("p"))
        for name, target in zip(MARGINS, targets, strict=True):
            now = state.groupBy(F.col(name).alias("__m")).agg(F.sum(F.col("tokens") * F.col("p")).alias("now"))
            f = F.when(F.col("now") > 0, F.coalesce("share", F.lit(0.0)) * budget / F.col("now")).otherwise(1.0)
            step = now.join(target, now["__m"].eqNullSafe(target.key), "left").select("__m", f.alias("f"))
            state = state.join(step, state[name].eqNullSafe(step["__m"])).withColumn(f"f_{name}", F.least(F.col(f"f_{name}") * F.col("f"), F.lit(1e12)))
            state = state.withColumn("p", F.least(raw, F.lit(1.0))).drop("__m", "f")
        state = checked(state)
        if state.where(F.abs(F.col("p") - F.col("was")) >= tolerance).isEmpty():
            break
    return state.select(*cells.columns, "p")


def probabilities(cells: DataFrame, share: float = 0.7, targets: dict[str, dict] | None = None, power: float = 0.5, driver_cells: int = DRIVER_CELLS) -> DataFrame:
    """(source, lang, topic, tokens, p) of cells (source, lang, topic, tokens).

    ``share`` of all tokens is the budget.  ``targets`` maps a margin to its shares by value; margins without targets
    are tempered by ``power``; values without a target get none of the budget.  A value that has fewer tokens than its
    target is wanted whole, and the others share what it leaves (:func:`feasible`); :func:`attained` tells the sums
    that raking reached.  More than ``driver_cells`` cells are raked by DataFrames, by the same rule.
    """
    spark = cells.sparkSession
    cells = checked(cells)
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    names = [*MARGINS, "tokens"]
    if cells.limit(driver_cells + 1).count() <= driver_cells:
        rows = sorted(cells.select(*names).collect(), key=lambda r: tuple((v is not None, str(v)) for v in r[:3]))
        tokens = np.array([r.tokens for r in rows], dtype=float)
        codes, goals = [], []
        for k, margin in enumerate(MARGINS):
            values = list(dict.fromkeys(r[k] for r in rows))
            code = np.array([values.index(r[k]) for r in rows], dtype=np.int64) if len(values) < 64 else np.array(list(map({v: i for i, v in enumerate(values)}.get, (r[k] for r in rows))), dtype=np.int64)
            sums = np.bincount(code, tokens, minlength=len(values)) if len(rows) else np.zeros(0)
            wanted = (targets or {}).get(margin) or tempered(dict(zip(values, sums.tolist(), strict=True)), power)
            codes.append(code)
            goals.append(feasible(np.array([wanted.get(v, 0.0) for v in values]), sums, share * total) / max(share * total, 1e-12))
        p = rake(tokens, codes, goals, share * total)
        kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cells.select(*names).schema.fields)
        return spark.createDataFrame([(*r, float(x)) for r, x in zip(rows, p.tolist(), strict=True)], f"{kinds}, p double")
    goals = []
    for margin in MARGINS:
        sums = cells.groupBy(F.col(margin).alias("key")).agg(F.sum("tokens").cast("double").alias("available"))
        if targets and margin in targets:
            given = spark.createDataFrame(list(targets[margin].items()), f"goal {dict(cells.dtypes)[margin]}, part double")
            sums = sums.join(given, F.col("key").eqNullSafe(F.col("goal")), "left").select("key", "available", F.coalesce("part", F.lit(0.0)).alias("part"))
        else:
            whole = sums.agg(F.sum(F.col("available") ** power)).first()[0] or 1.0
            sums = sums.withColumn("part", F.col("available") ** power / whole)
        goals.append(_feasible_frame(checked(sums), share * total))
    return _rake_frames(cells.select(*names), goals, share * total)


def _with_probability(seen: DataFrame, cells: DataFrame) -> DataFrame:
    cells = small(cells.select(F.col("source").alias("of_source"), F.col("lang").alias("of_lang"), F.col("topic").alias("of_topic"), F.col("p").alias("probability")))
    same = F.col("source").eqNullSafe(F.col("of_source")) & F.col("lang").eqNullSafe(F.col("of_lang")) & (F.col("topic") == F.col("of_topic"))
    return seen.join(cells, same).drop("of_source", "of_lang", "of_topic")


def _cells(seen: DataFrame) -> DataFrame:
    return seen.groupBy("source", "lang", "topic").agg(F.sum("tokens").alias("tokens"))


def mix(docs: DataFrame, share: float = 0.7, targets: dict[str, dict] | None = None, power: float = 0.5, topics: int = 8) -> DataFrame:
    """(doc_id, source, lang, topic, tokens, probability, weight, kept) of each row of ``docs`` (doc_id, text, source, lang).

    Null sources and languages are values of their own; null and empty texts have one token and the first topic.
    Repeated rows are kept or dropped together.  ``weight`` is 1 / probability, for estimates from the kept rows.
    Other columns are ignored; an empty table gives an empty table.  :func:`attained` tells which targets were met.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "source", "lang")
    seen = stored(described(rows, fit_topics(rows, topics), F.col("doc_id")), "topics")
    out = _with_probability(seen, probabilities(_cells(seen), share, targets, power))
    weight = F.when(F.col("probability") > 0, 1 / F.col("probability"))
    return out.select("doc_id", "source", "lang", "topic", "tokens", "probability", weight.alias("weight"), (F.col("draw") < F.col("probability")).alias("kept"))


def attained(cells: DataFrame, share: float = 0.7, targets: dict[str, dict] | None = None, power: float = 0.5) -> DataFrame:
    """(margin, value, available, target, expected) of cells with p, tokens each: what raking reached.

    ``target`` is the plain one, before values that can't meet it leave the rest to others.
    """
    total = F.lit(float(cells.agg(F.sum("tokens")).first()[0] or 0))
    found = None
    for margin in MARGINS:
        sums = cells.groupBy(F.col(margin).cast("string").alias("value")).agg(F.sum("tokens").cast("double").alias("available"), F.sum(F.col("tokens") * F.col("p")).alias("expected"))
        if targets and margin in targets:
            goals = cells.sparkSession.createDataFrame([(None if k is None else str(k), float(v)) for k, v in targets[margin].items()], "goal string, part double")
            sums = sums.join(goals, F.col("value").eqNullSafe(F.col("goal")), "left").withColumn("part", F.coalesce("part", F.lit(0.0)))
        else:
            whole = sums.agg(F.sum(F.col("available") ** power)).first()[0] or 1.0
            sums = sums.withColumn("part", F.col("available") ** power / whole)
        one = sums.select(F.lit(margin).alias("margin"), "value", "available", (F.col("part") * share * total).alias("target"), "expected")
        found = one if found is None else found.unionByName(one)
    return found


def keep_mixed(docs: DataFrame, share: float = 0.7, targets: dict[str, dict] | None = None, power: float = 0.5, topics: int = 8) -> DataFrame:
    """The rows of ``docs`` that :func:`mix` keeps, with all their columns, whatever their names.

    Nulls, empty texts and empty tables are as there; equal rows (ties) are kept or dropped together.
    """
    centres = fit_topics(docs, topics)
    cells = _cells(described(docs, centres))
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")  # user columns can't clash with those made here
    seen = described(docs, centres, row)
    return _with_probability(seen, probabilities(cells, share, targets, power)).where(F.col("draw") < F.col("probability")).select("row.*")
