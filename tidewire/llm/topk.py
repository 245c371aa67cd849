"""Exact top-k inner products with multi-resolution segment statistics.

A vector is cut into 1, 2, 4, ... segments; of each, the sums of its mean and its deviation bound any inner product:
over a segment of length L, <q, x> <= L (mean_q mean_x + dev_q dev_x), by Cauchy-Schwarz on the centred parts (the
same as a lower bound on the distance).  Each query first scores the candidates that the finest bounds favour, which
gives it a floor; then, from coarse to fine, every pair of a query and a candidate that cannot reach the query's k-th
best score so far is dropped at the first resolution that shows it, and the surviving pairs' scores are exact integers.  Queries go in blocks of a fixed size, so what is broadcast has a proven bound; every block meets every
candidate, in one pass over the table a block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stored

#: Queries in a block, and bytes of it: what is broadcast at a time.
BLOCK, BLOCK_BYTES = 8192, 32 << 20
_CELLS = 1 << 21  # scores held at once by a worker


def _levels(x: np.ndarray, segments: int) -> np.ndarray:
    """Features whose inner product bounds that of the vectors: sqrt(L) times each segment's mean and deviation."""
    found = []
    for part in np.array_split(np.arange(x.shape[1]), min(segments, x.shape[1])):
        cut = x[:, part]
        found += [cut.mean(axis=1) * np.sqrt(len(part)), cut.std(axis=1) * np.sqrt(len(part))]
    return np.stack(found, axis=1)


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products: by floating point where every sum stays under 2**53, else in 64-bit integers."""
    if len(a) and len(b) and np.abs(a).max() * np.abs(b).max() * a.shape[1] < 2.0**53:
        return (a @ b.T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def scaled(vectors: DataFrame, scale: int = 1024, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, v): floor(scale * component) as doubles; rows with a null, non-finite or missing part are left out."""
    x = F.col(embedding).cast("array<double>")
    fit = F.col(vec_id).isNotNull() & (F.size(x) > 0) & F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    return vectors.where(F.coalesce(fit, F.lit(False))).select(F.col(vec_id).cast("bigint").alias("vec_id"), F.transform(x, lambda e: F.floor(e * scale).cast("double")).alias("v"))


class _Best:
    """The k best (score, smaller id first) of some queries so far, duplicates and the query itself left out.

    ``pairs`` counts the pairs of a query and a candidate that came, ``scored`` those whose product was needed.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int, segments: tuple[int, ...]) -> None:
        self.ids, self.vectors, self.k = ids, vectors, k
        self.features = [_levels(vectors, s) for s in segments]
        self.segments = segments
        self.found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # query row, candidate id, score
        self.floor = np.full(len(ids), -np.inf)
        self.held = self.pairs = self.scored = 0

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        step = max(1, _CELLS // max(1, len(self.ids)))
        for at in range(0, len(ids), step):
            self._block(ids[at : at + step], vectors[at : at + step])

    def _block(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.pairs += len(ids) * len(self.ids)
        fine = _levels(vectors, self.segments[-1])
        if len(ids) > 8 * self.k and not np.isfinite(self.floor).all():
            # Floors to prune by: each query's most promising candidates first.
            open_ = np.flatnonzero(~np.isfinite(self.floor))
            bound = self.features[-1][open_] @ fine.T
            most = np.argpartition(-bound, 2 * self.k, axis=1)[:, : 2 * self.k]
            seeds = np.zeros((len(self.ids), len(ids)), dtype=bool)
            seeds[open_[:, None], most] = True
            self._score(seeds, ids, vectors)
            self.shrink()
            live = ~seeds
        else:
            live = np.ones((len(self.ids), len(ids)), dtype=bool)
        for s, mine in zip(self.segments, self.features, strict=True):
            rows, cols = np.flatnonzero(live.any(axis=1)), np.flatnonzero(live.any(axis=0))
            if not len(rows):
                return
            theirs = fine if s == self.segments[-1] else _levels(vectors, s)
            bound = mine[rows] @ theirs[cols].T
            live[np.ix_(rows, cols)] &= bound * (1 + 1e-9) + 1e-6 + np.abs(bound) * 1e-9 >= self.floor[rows, None]
        self._score(live, ids, vectors)
        if self.held > _CELLS:
            self.shrink()

    def _score(self, wanted: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
        """Exact scores of the wanted pairs: all at once where they are many, else pair by pair."""
        q, c = np.nonzero(wanted)
        self.scored += len(q)
        if 4 * len(q) > wanted.size:
            score = _scores(self.vectors, vectors)[q, c]
        else:
            score = np.zeros(len(q), dtype=np.int64)
            exact = len(q) and np.abs(self.vectors).max() * np.abs(vectors).max() * vectors.shape[1] < 2.0**53
            for at in range(0, len(q), 1 << 15):
                left, right = self.vectors[q[at : at + (1 << 15)]], vectors[c[at : at + (1 << 15)]]
                if not exact:
                    left, right = left.astype(np.int64), right.astype(np.int64)
                score[at : at + (1 << 15)] = np.einsum("ij,ij->i", left, right)
        keep = (score >= self.floor[q]) & (self.ids[q] != ids[c])
        self.found.append((q[keep], ids[c[keep]], score[keep]))
        self.held += int(keep.sum())

    def shrink(self) -> None:
        if not self.found:
            return
        row, ids, score = (np.concatenate(x) for x in zip(*self.found, strict=True))
        order = np.lexsort((ids, -score, row))
        row, ids, score = row[order], ids[order], score[order]
        first = np.searchsorted(row, np.arange(len(self.ids)))
        keep = np.arange(len(row)) - first[row] < self.k
        full = np.bincount(row, minlength=len(self.ids)) >= self.k
        kth = first + self.k - 1
        self.floor[full] = score[kth[full]]
        self.found, self.held = [(row[keep], ids[keep], score[keep])], int(keep.sum())


def _partial(candidates: DataFrame, queries: Broadcast, k: int, segments: tuple[int, ...]) -> DataFrame:
    """Each partition's own k best for a block of queries: (length, ids, vectors) arrays by length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = {n: _Best(ids, vectors, k, segments) for n, ids, vectors in queries.value}
        for batch in batches:
            ids, lists = batch.column(0).to_numpy(), batch.column(1)
            sizes = np.asarray(lists.value_lengths())
            flat, offsets = lists.flatten().to_numpy(), np.concatenate(([0], np.cumsum(sizes)))
            for n, best in lengths.items():
                rows = np.flatnonzero(sizes == n)
                if len(rows):
                    best.add(ids[rows], flat[offsets[rows][:, None] + np.arange(n)])
                    best.shrink()
        for best in lengths.values():
            best.shrink()
            for row, ids, score in best.found:
                yield pa.RecordBatch.from_arrays([pa.array(best.ids[row]), pa.array(ids), pa.array(score)], names=["query_id", "vec_id", "score"])

    return candidates.mapInArrow(run, "query_id bigint, vec_id bigint, score bigint")


def _arrays(rows: pa.Table) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(length, ids, vectors) of (vec_id, v) by the vectors' length; 8 bytes a component."""
    ids, lists = rows.column(0).to_numpy(), rows.column(1).combine_chunks()
    sizes = np.asarray(lists.value_lengths())
    flat, offsets = lists.flatten().to_numpy(), np.concatenate(([0], np.cumsum(sizes)))
    out = []
    for n in np.unique(sizes).tolist():
        own = np.flatnonzero(sizes == n)
        out.append((n, ids[own], flat[offsets[own][:, None] + np.arange(n)]))
    return out


def top_k(vectors: DataFrame, is_query, k: int = 10, scale: int = 1024, segments: tuple[int, ...] = (1, 4, 16), block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest integer inner products, ties to the smaller vec_id.

    ``is_query`` is a condition on vec_id; candidates are all rows with another vec_id than the query's.  Components
    become floor(scale * component); null vectors, those with a null or non-finite component, empty ones and null
    ids take no part, and vectors of different lengths don't meet.  Fewer candidates than k give fewer rows.  Of
    repeated rows with one vec_id each counts as a candidate, queries count once (the first by components).  Scores
    have to fit 64 bits.  Other columns are ignored; an empty table gives an empty table.

    Queries go in blocks of at most ``block`` of them and BLOCK_BYTES; a block's own best are stored before the next
    one is sent, and what was sent is freed.
    """
    spark = vectors.sparkSession
    ready = stored(scaled(vectors, scale), "vectors")
    queries = ready.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v"))
    queries = stored(queries, "queries")
    size = queries.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("widest")).first()
    if not size.n:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    block = max(1, min(block, BLOCK_BYTES // (8 * size.widest + 8)))
    ends = queries.select(F.percentile_approx("vec_id", [j / -(-size.n // block) for j in range(1, -(-size.n // block))], 10 * -(-size.n // block))).first()[0] if size.n > block else []
    cuts = [None, *sorted(set(ends)), None]
    found = None
    for low, high in zip(cuts, cuts[1:], strict=False):
        own = queries
        if low is not None:
            own = own.where(F.col("vec_id") > low)
        if high is not None:
            own = own.where(F.col("vec_id") <= high)
        rows = own.select("vec_id", "v").toArrow()
        for at in range(0, rows.num_rows, block):  # ranges are about a block; none is sent that is larger
            sent = spark.sparkContext.broadcast(_arrays(rows.slice(at, block)))
            part = stored(_best(_partial(ready, sent, k, segments), k), "best")
            sent.unpersist()
            found = part if found is None else found.unionByName(part)
    return found


def _best(partial: DataFrame, k: int) -> DataFrame:
    ranked = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return partial.withColumn("rank", ranked).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
