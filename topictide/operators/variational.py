"""Variational Bayes for LDA models of many slices at once (Blei, Ng, Jordan 2003; Hoffman, Blei, Bach 2010).

A model has one row of topic weights for every (slice, term) of the vocabularies, all slices stacked. The expectation step runs over the documents
where they lie: a task adds up what its documents say about each row, Spark sums the rows by number, and the next model is
these sums plus the prior. So an iteration is one aggregation however many slices there are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DOCUMENT_ROUNDS = 100
TOLERANCE = 1e-3  # mean change of a document's topic counts at which its rounds end
BATCH_ENTRIES = 1 << 18  # terms of documents handled at once
FEW_LEFT = 64  # documents of a block that go on with those left of the other blocks
LATE_BLOCKS = 2  # blocks that these make up


def digamma(x: np.ndarray) -> np.ndarray:
    x = np.asarray(x, np.float64)
    # 1 / x + ... + 1 / (x + 9), the first and the last, the second and the last but one, ... together
    ends, product, part = 2 * x + 9, x * (x + 9), np.empty_like(x)
    z = x + 10
    y = 1 / (z * z)
    out = np.log(z) - 0.5 / z - y * (1 / 12 - y * (1 / 120 - y * (1 / 252 - y * (1 / 240 - y / 132))))
    for i in range(5):
        np.add(product, i * (9 - i), out=part)
        np.divide(ends, part, out=part)
        out -= part
    return out


def log_gamma(x: np.ndarray) -> np.ndarray:
    x = np.array(x, np.float64)
    out = np.zeros_like(x)
    for _ in range(10):
        small = x < 10
        out[small] -= np.log(x[small])
        x[small] += 1
    y = 1 / (x * x)
    return out + (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + (1 / 12 - y * (1 / 360 - y * (1 / 1260 - y / 1680))) / x


def expected_log(weights: np.ndarray) -> np.ndarray:
    """Expected logarithms of Dirichlet shares, row by row."""
    both = digamma(np.concatenate([weights, weights.sum(axis=1)[:, None]], axis=1))
    return both[:, :-1] - both[:, -1:]


def _rounds(
    docs: np.ndarray, few: int, gamma: np.ndarray, done: np.ndarray, sizes: np.ndarray, starts: np.ndarray, own: np.ndarray, counts: np.ndarray, alpha: float
) -> np.ndarray:
    """Topic counts ``gamma`` of ``docs``, round by round, and in ``done`` how many rounds these took; a document ends by itself. As soon as no more than
    ``few`` documents are open they are given back."""
    w = int(sizes[docs].max())
    inside = np.arange(w)[None] < sizes[docs][:, None]
    at = np.where(inside, starts[docs][:, None] + np.arange(w)[None], 0)
    b, c, g = own[at], np.where(inside, counts[at], 0.0), gamma[docs]
    live = done[docs] < DOCUMENT_ROUNDS
    while live.sum() > few:
        theta = np.exp(expected_log(g))
        norm = np.matmul(b, theta[:, :, None])[:, :, 0] + 1e-100
        new = alpha + theta * np.matmul((c / norm)[:, None, :], b)[:, 0]
        change = np.abs(new - g).sum(axis=1)
        g[live] = new[live]
        done[docs[live]] += 1
        live &= (change >= TOLERANCE * g.shape[1]) & (done[docs] < DOCUMENT_ROUNDS)
        if 4 * live.sum() < 3 * len(live):  # finished documents stay as they are until they go
            gamma[docs[~live]] = g[~live]
            docs, b, c, g = docs[live], b[live], c[live], g[live]
            live = np.ones(len(docs), bool)
    gamma[docs] = g
    return docs[live]


def infer(rows: np.ndarray, counts: np.ndarray, sizes: np.ndarray, beta: np.ndarray, alpha: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Topic counts of documents, each entry's share by topic times its count, and the bound's part of every document.

    ``rows`` are the model's rows of all entries, ``sizes`` the entries of each document (at least one), ``beta`` the
    exponentials of the expected logarithms. A document's result does not depend on those beside it."""
    n, k = len(sizes), beta.shape[1]
    own = beta[rows]
    owner = np.repeat(np.arange(n), sizes)
    gamma = np.ones((n, k))
    starts = np.cumsum(sizes) - sizes
    # documents of like length share a block, filled up with entries of count 0; when few of them are left, all of these go on together
    width = 1 << np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64)
    rounds, late = np.zeros(n, np.int64), []
    for docs in [np.flatnonzero(width == w) for w in np.unique(width)]:
        late.append(_rounds(docs, FEW_LEFT, gamma, rounds, sizes, starts, own, counts, alpha))
    left = np.concatenate(late) if late else np.empty(0, np.int64)
    if len(left):
        left = left[np.argsort(sizes[left], kind="stable")]
        for docs in np.array_split(left, min(LATE_BLOCKS, len(left))):
            _rounds(docs, 0, gamma, rounds, sizes, starts, own, counts, alpha)
    log_theta = expected_log(gamma)
    theta = np.exp(log_theta)
    shares = theta[owner] * own
    norm = shares.sum(axis=1) + 1e-100
    bound = np.bincount(owner, weights=counts * np.log(norm), minlength=n)
    bound += ((alpha - gamma) * log_theta + log_gamma(gamma)).sum(axis=1) - log_gamma(gamma.sum(axis=1))
    bound += log_gamma(np.array([alpha * k]))[0] - k * log_gamma(np.array([alpha]))[0]
    return gamma, shares * (counts / norm)[:, None], bound


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Small batches put together: rounds of many documents cost little more than those of few."""
    held: list[pa.RecordBatch] = []
    entries = 0
    for batch in batches:
        held.append(batch)
        entries += len(batch.column("rows").flatten())
        if entries >= BATCH_ENTRIES:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, entries = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of documents with a bounded number of entries: (rows of the batch, model rows, counts, sizes)."""
    for batch in _joined(batches):
        sizes = np.diff(batch.column("rows").offsets.to_numpy())
        ends = np.cumsum(sizes)
        at = 0
        while at < len(sizes):
            done = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, done + BATCH_ENTRIES, side="right")))
            part = batch.slice(at, stop - at)
            rows, counts = part.column("rows").flatten().to_numpy(), part.column("counts").flatten().to_numpy()
            yield part, rows, counts.astype(np.float64), sizes[at:stop]
            at = stop


@dataclass(frozen=True)
class StackedModel:
    """Topic weights of all rows; slice ``i`` has the rows ``bounds[i]`` to ``bounds[i + 1]``."""

    weights: np.ndarray
    bounds: np.ndarray

    def parts(self) -> list[np.ndarray]:
        return [self.weights[a:b] for a, b in zip(self.bounds[:-1], self.bounds[1:])]

    def beta(self) -> np.ndarray:
        out = np.empty_like(self.weights)
        for a, b in zip(self.bounds[:-1], self.bounds[1:]):
            out[a:b] = np.exp(expected_log(self.weights[a:b].T).T)
        return out

    def topic_bound(self, eta: float) -> np.ndarray:
        """The bound's part of the topics, by slice."""
        out = np.zeros(len(self.bounds) - 1)
        for i, w in enumerate(self.parts()):
            if len(w):
                logs = expected_log(w.T).T
                out[i] = ((eta - w) * logs + log_gamma(w) - log_gamma(np.array([eta]))[0]).sum()
                out[i] += w.shape[1] * log_gamma(np.array([eta * len(w)]))[0] - log_gamma(w.sum(axis=0)).sum()
        return out


def start_model(sizes: list[int], seeds: list[int], k: int, seed: int) -> StackedModel:
    """Random weights around 1; a slice's depend on ``seed`` and on the slice's own number alone."""
    parts = [np.random.default_rng([seed, abs(s), int(s < 0)]).gamma(100.0, 0.01, (n, k)) for n, s in zip(sizes, seeds)]
    return StackedModel(np.concatenate([np.empty((0, k)), *parts]), np.r_[0, np.cumsum(sizes)].astype(np.int64))


def iterate(docs: DataFrame, model: StackedModel, alpha: float, eta: float) -> tuple[StackedModel, np.ndarray]:
    """The next model, and by slice the bound on the log likelihood under ``model``.

    ``docs``: (slice_no, rows array<int>, counts array<double>), documents without entries left out. The driver gets one row
    for each row of the model."""
    context = docs.sparkSession.sparkContext
    k, n_rows = model.weights.shape[1], len(model.weights)
    shared = context.broadcast(model.beta())
    columns = [f"s{i}" for i in range(k)]

    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        beta = shared.value
        total: np.ndarray | None = None
        bounds: dict[int, float] = {}
        for part, rows, counts, sizes in _documents(batches):
            _, stats, bound = infer(rows, counts, sizes, beta, alpha)
            total = np.zeros((n_rows, k)) if total is None else total
            order = np.argsort(rows, kind="stable")
            firsts = np.flatnonzero(np.diff(rows[order], prepend=-1))
            total[rows[order][firsts]] += np.add.reduceat(stats[order], firsts)
            for number, value in zip(part.column("slice_no").to_pylist(), bound.tolist()):
                bounds[number] = bounds.get(number, 0.0) + value
        if total is None:
            return
        used = np.flatnonzero(total.any(axis=1))
        ids = np.r_[used, [-1 - s for s in bounds]].astype(np.int64)
        values = np.concatenate([total[used], np.array([[v] + [0.0] * (k - 1) for v in bounds.values()])])
        yield pa.RecordBatch.from_arrays([pa.array(ids), *[pa.array(values[:, i]) for i in range(k)]], names=["id", *columns])

    schema = "id long, " + ", ".join(f"{c} double" for c in columns)
    sums = docs.select("slice_no", "rows", "counts").mapInArrow(expect, schema).groupBy("id").agg(*[F.sum(c).alias(c) for c in columns])
    found = sums.toPandas().to_numpy(np.float64).reshape(-1, k + 1)
    shared.destroy()
    ids = found[:, 0].astype(np.int64)
    weights = np.full_like(model.weights, eta)
    weights[ids[ids >= 0]] += found[ids >= 0, 1:]
    bound = model.topic_bound(eta)
    bound[-1 - ids[ids < 0]] += found[ids < 0, 1]
    return StackedModel(weights, model.bounds), bound


def mixtures(docs: DataFrame, model: StackedModel, alpha: float, keep: list[str]) -> DataFrame:
    """``keep`` columns and ``mixture``, the topic shares of every document of ``docs``; zeros without entries."""
    k = model.weights.shape[1]
    shared = docs.sparkSession.sparkContext.broadcast(model.beta())

    def share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows, counts, sizes in _documents(batches):
            out = np.zeros((len(sizes), k))
            full = sizes > 0
            if full.any():
                gamma, _, _ = infer(rows, counts, sizes[full], shared.value, alpha)
                out[full] = gamma / gamma.sum(axis=1, keepdims=True)
            columns = [part.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(list(out), pa.list_(pa.float64()))], names=[*keep, "mixture"])

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*keep, "rows", "counts").mapInArrow(share, f"{kinds}, mixture array<double>")
