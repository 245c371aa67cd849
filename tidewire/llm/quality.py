"""Quality classifier with hierarchical empirical Bayes over sites.

A logistic model of a text's form gives each document's evidence as a log-likelihood ratio.  The documents' soft
labels are then aggregated by path (site and section), by host and over everything; host rates are shrunk toward the
global rate and path rates toward their host's, as strongly as the spread between groups asks for (method of moments),
so sparse sites follow the prior and large ones their own record.  A document's posterior is its evidence on top of
its path's rate, from which its own soft label has been taken out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textops as T
from .common import checked, held_out, only, small, stored

#: At most so many labelled documents of each class are learnt from, the first in the order of a hash of doc_id.
GOOD_SAMPLE = BAD_SAMPLE = 4000
#: A prior counts for so many documents at least and at most.
LEAST_STRENGTH, MOST_STRENGTH = 0.1, 1e4

_KINDS = np.zeros(256, dtype=np.int64)  # letter and the rest
_KINDS[65:91] = 1
_KINDS[48:58] = 2
_KINDS[[33, 63]] = 3
_KINDS[[44, 46, 58, 59, 39, 34, 40, 41, 45]] = 4
_KINDS[[35, 36, 37, 38, 42, 43, 60, 61, 62, 64, 91, 92, 93, 94, 95, 96, 123, 125, 126]] = 5
_KINDS[124] = 6
_KINDS[[9, 10, 11, 12, 13, 32]] = 7
_KINDS[128:] = 8
FEATURES = 22


def features(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """(n, FEATURES): shares of character kinds, lengths, repetition of words, of word pairs and of lines."""
    only(("quality",))
    n, size = len(bounds) - 1, np.diff(bounds)
    row = np.repeat(np.arange(n), size)
    kinds = np.bincount(row * 9 + _KINDS[data], minlength=n * 9).reshape(n, 9)
    hashes, words = T.words(data, bounds)
    count = np.diff(words)
    owner = np.repeat(np.arange(n), count)
    distinct = np.array([len(s) for s in T.sorted_sets(hashes, words)], dtype=float)
    pairs, pair_bounds = T.shingles(hashes, words, 5)
    fresh = np.array([len(s) for s in T.sorted_sets(pairs, pair_bounds)], dtype=float)
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[bounds] = True
    starts = np.flatnonzero(edge[:-1] | np.concatenate(([False], data[:-1] == 10))) if len(data) else np.zeros(0, np.int64)
    ends = np.append(starts[1:], len(data))
    lines = T.span_hashes(data, starts, ends) if len(starts) else np.zeros(0, np.uint64)
    line_bounds = np.searchsorted(starts, bounds)
    n_lines = np.diff(line_bounds)
    unlike = np.array([len(s) for s in T.sorted_sets(lines, line_bounds)], dtype=float)
    twice = np.zeros(n)
    if len(hashes) > 1:
        np.add.at(twice, owner[1:], ((hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])).astype(float))
    safe, w, ln = np.maximum(size, 1), np.maximum(count, 1), np.maximum(n_lines, 1)
    shares = kinds / safe[:, None]
    letters = np.maximum(kinds[:, 0] + kinds[:, 1] + kinds[:, 8] / 2, 1)
    out = [*shares.T, kinds[:, 1] / letters, kinds[:, 5] / w, kinds[:, 3] / w, kinds[:, 6] / w, kinds[:, 4] / w]
    out += [np.log1p(size) / 10, size / w / 10, distinct / w, fresh / np.maximum(np.diff(pair_bounds), 1), unlike / ln, np.log1p(w / ln) / 5, twice / w, (size == 0).astype(float)]
    return np.stack(out, axis=1)


@dataclass(frozen=True)
class Classifier:
    """Logistic weights on standardised features and their squares; gives log-likelihood ratios."""

    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def _design(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.centre) / self.scale, -6, 6)
        return np.hstack((z, z * z, np.ones((len(z), 1))))

    def evidence(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self._design(x) @ self.weights, -12, 12)


def train(x: np.ndarray, good: Sequence[int]) -> Classifier:
    """Fits features with both classes at equal weight, so the linear score is the evidence without a prior."""
    y = np.array(good, dtype=float)
    if not 0 < y.sum() < len(y):
        return Classifier(np.zeros(FEATURES), np.ones(FEATURES), np.zeros(2 * FEATURES + 1))
    model = Classifier(x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3), np.zeros(2 * FEATURES + 1))
    z = model._design(x)
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    w = model.weights
    ridge = np.append(np.full(2 * FEATURES, 1.0), 1e-6)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (weight * p * (1 - p))[:, None]).T @ z + np.diag(ridge), z.T @ (weight * (p - y)) + ridge * w)
        w = w - step
        if np.abs(step).max() < 1e-7:
            break
    return Classifier(model.centre, model.scale, w)


def _described(rows: DataFrame) -> DataFrame:
    """(good, x): the features of (good, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = T.utf8(batch.column(1))
            x = np.concatenate([*(features(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]) for i, j in T.row_slices(offsets)), np.zeros((0, FEATURES))])
            lists = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * FEATURES, x.ravel())
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["good", "x"])

    return rows.select("good", "text").mapInArrow(run, "good int, x array<double>")


def _usable(labels: DataFrame) -> DataFrame:
    """(doc_id, good) of the labels that aren't held out; of several labels of a document the worse."""
    rows = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("good"))
    return rows.where(F.col("doc_id").isNotNull() & F.col("good").isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("good").alias("good"))


def fit(docs: DataFrame, labels: DataFrame) -> Classifier:
    """Learns from (doc_id, quality) labels that aren't held out, a bounded sample of each class.

    The features are made where the texts are; the driver gets FEATURES numbers for each document of the sample.
    """
    usable = _usable(labels)
    order = F.xxhash64("doc_id", F.lit(13))
    some = usable.where("good = 1").orderBy(order).limit(GOOD_SAMPLE).unionByName(usable.where("good = 0").orderBy(order).limit(BAD_SAMPLE))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = sorted((list(r.x), r.good) for r in _described(texts.join(small(some), "doc_id")).distinct().collect())
    return train(np.array([x for x, _ in rows]).reshape(-1, FEATURES), [g for _, g in rows])


def evidence(model: Classifier, text: Column) -> Column:
    """The log-likelihood ratio of a text column for good quality; only the text goes to Python, only numbers return."""

    @F.arrow_udf("double")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            data, offsets = T.utf8(texts)
            found = [model.evidence(features(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])) for i, j in T.row_slices(offsets)]
            yield pa.array(np.concatenate([*found, np.zeros(0)]))

    return of(text.cast("string"))


def base_rate(labels: DataFrame) -> float:
    """The share of good ones among the labels that may be used; a half without any."""
    return _usable(labels).agg(F.avg("good")).first()[0] or 0.5


def strength(between: float, groups: int, spread: float, within: float, degrees: int) -> float:
    """How many documents a prior counts for: the variance inside groups over that of the groups' own rates.

    ``between`` is the sum of n (mean - upper mean)^2 over groups, whose number less that of their upper groups is
    ``groups`` and whose effective number of documents is ``spread``; ``within`` the sum of squares inside groups with
    ``degrees`` of freedom.  What the groups' means vary by sampling alone is taken off.  Without two documents in a
    group, or without a second group, nothing says that rates differ: the most.
    """
    if degrees <= 0 or groups <= 0 or spread <= 0:
        return MOST_STRENGTH
    noise = max(within, 0.0) / degrees
    own = (between - groups * noise) / spread
    return float(np.clip(noise / own, LEAST_STRENGTH, MOST_STRENGTH)) if own > 0 else MOST_STRENGTH


def site_rates(soft: DataFrame) -> DataFrame:
    """(host, path, n, total, host_n, host_total, rate_host, all_n, all_total, k_host, k) of soft labels (host, path, p).

    Per path what a document's prior needs, and the host's rate with all of its documents.  Grouped aggregation only: paths first, then hosts from the paths, then
    everything from the hosts, so a host with a third of all rows is summed in parts.  Null hosts and paths are groups of
    their own; an empty table gives an empty table.
    """
    one = F.count(F.lit(1))
    paths = checked(soft.groupBy("host", "path").agg(one.alias("n"), F.sum("p").alias("total"), F.sum(F.col("p") * F.col("p")).alias("squares")))
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("total").alias("host_total"), one.alias("paths"), F.sum(F.col("total") ** 2 / F.col("n")).alias("of_paths"), F.sum(F.col("n") * F.col("n")).alias("sizes"), F.sum("squares").alias("squares"))
    hosts = checked(hosts)
    s = hosts.agg(
        one.alias("hosts"), F.sum("paths").alias("paths"), F.sum("host_n").alias("n"), F.sum("host_total").alias("total"), F.sum("squares").alias("squares"), F.sum("of_paths").alias("of_paths"),
        F.sum(F.col("host_total") ** 2 / F.col("host_n")).alias("of_hosts"), F.sum(F.col("sizes") / F.col("host_n")).alias("path_sizes"), F.sum(F.col("host_n") * F.col("host_n")).alias("host_sizes"),
    ).first()
    if not s.n:
        k_host = k = MOST_STRENGTH
    else:
        k = strength(s.of_paths - s.of_hosts, s.paths - s.hosts, s.n - s.path_sizes, s.squares - s.of_paths, s.n - s.paths)
        k_host = strength(s.of_hosts - s.total**2 / s.n, s.hosts - 1, s.n - s.host_sizes / s.n, s.squares - s.of_hosts, s.n - s.hosts)
    hosts = hosts.select(F.col("host").alias("site"), "host_n", "host_total")
    joined = paths.join(small(hosts), F.col("host").eqNullSafe(F.col("site"))).select("host", "path", "n", "total", "host_n", "host_total")
    mean = s.total / s.n if s.n else 0.5
    rate_host = (k_host * mean + F.col("host_total")) / (k_host + F.col("host_n"))
    return joined.withColumns({"rate_host": rate_host, "all_n": F.lit(s.n or 0).cast("bigint"), "all_total": F.lit(s.total or 0.0), "k_host": F.lit(k_host), "k": F.lit(k)})


def _logit(p: Column) -> Column:
    p = F.greatest(F.lit(1e-4), F.least(F.lit(1 - 1e-4), p))
    return F.log(p / (1 - p))


def posterior(seen: DataFrame, rates: DataFrame, prior: float) -> DataFrame:
    """``seen`` (host, path, evidence and others) with site_rate and score, the posterior of good quality.

    A document's own soft label is taken out of its path, its host and the whole before they are its prior, so its
    evidence counts once: alone on its host it has the rate of all others.
    """
    own = _soft(prior)
    top = F.when(F.col("all_n") > 1, (F.col("all_total") - own) / (F.col("all_n") - 1)).otherwise(F.lit(prior))
    host = (F.col("k_host") * top + F.col("host_total") - own) / (F.col("k_host") + F.col("host_n") - 1)
    rate = (F.col("k") * host + F.col("total") - own) / (F.col("k") + F.col("n") - 1)
    rates = rates.withColumnsRenamed({"host": "of_host", "path": "of_path"})
    joined = seen.join(rates, F.col("host").eqNullSafe(F.col("of_host")) & F.col("path").eqNullSafe(F.col("of_path")), "left")
    joined = joined.withColumn("site_rate", rate).withColumn("score", 1 / (1 + F.exp(-(F.col("evidence") + _logit(F.col("site_rate"))))))
    return joined.drop("of_host", "of_path", "n", "total", "host_n", "host_total", "rate_host", "all_n", "all_total", "k_host", "k")


def _soft(prior: float) -> Column:
    """A document's soft label: its evidence on top of the base rate."""
    prior = min(max(prior, 1e-3), 1 - 1e-3)
    return 1 / (1 + F.exp(-(F.col("evidence") + math.log(prior / (1 - prior)))))


def _rates(seen: DataFrame, prior: float) -> DataFrame:
    return small(checked(site_rates(seen.select("host", "path", _soft(prior).alias("p")))))


def quality(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", threshold: float = 0.5, prior: float | None = None, model: Classifier | None = None) -> DataFrame:
    """(doc_id, host, path, evidence, site_rate, score, kept) of each row of ``docs`` (doc_id, text, host, path).

    A document is kept if its posterior reaches ``threshold``; ``prior`` is the base rate of the soft labels that the
    sites are rated by, if not given that of the labels.  Null hosts and paths are groups of their own.  Null and empty
    texts are judged by the form of an empty text.  Repeated rows give a row each; other columns are ignored; an empty
    table gives an empty table.  Without labels of both kinds the evidence is 0 and every document has the base rate.
    """
    model = model or fit(docs, labels)
    prior = base_rate(labels) if prior is None else prior
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(host).alias("host"), F.col(path).alias("path"), evidence(model, F.col("text")).alias("evidence"))
    seen = stored(rows, "evidence")
    return posterior(seen, _rates(seen, prior), prior).select("doc_id", "host", "path", "evidence", "site_rate", "score", (F.col("score") >= threshold).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", threshold: float = 0.5, prior: float | None = None) -> DataFrame:
    """The rows of ``docs`` that :func:`quality` keeps, with all their columns, whatever their names.

    Nulls, empty texts, repeated rows and empty tables are as there; equal rows are kept or dropped together.
    """
    model = fit(docs, labels)
    prior = base_rate(labels) if prior is None else prior
    fields = [*docs.columns]
    row = F.struct(*(F.col("`" + c.replace("`", "``") + "`") for c in fields)).alias("row")  # user columns can't clash with those made here
    seen = docs.select(row, F.col(host).alias("host"), F.col(path).alias("path"), evidence(model, F.col("text")).alias("evidence"))
    rates = _rates(seen.drop("row"), prior)
    return posterior(seen, rates, prior).where(F.col("score") >= threshold).select("row.*")
