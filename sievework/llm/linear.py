"""Hashed sparse linear models trained by follow-the-regularised-leader (McMahan et al., 2013).

Training takes a bounded sample of labelled rows: at most about ``train_rows`` (a
parameter, whatever the corpus' size), dealt over shards of at least ``SHARD_ROWS`` rows
whose weights are averaged.  A shard's rows are put in an order of their own first, so the
weights do not depend on how rows arrive, and a shard that is trained again gives the same.  Scoring is a sparse dot product over whole texts in one
narrow pass over all documents.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textkernels as tk
from .common import ship_package, written

BITS = 18
DIMS = 1 << BITS  # then the bias and any dense extras
SHARD_ROWS = 3000
MOST_SHARDS = 8
TRAIN_ROWS = 24_000

Sparse = tuple[np.ndarray, np.ndarray]  # feature numbers and values of one document


def slots(h: np.ndarray, salt: int) -> np.ndarray:
    """Feature numbers of hashes; each salt is a feature family of its own."""
    return (tk.mix(h ^ np.uint64(salt * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) >> np.uint64(64 - BITS)).astype(np.int64)


def bigrams(words: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if len(words) < 2:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    same = rows[1:] == rows[:-1]
    return tk.gram_hashes(words, 2)[same], rows[:-1][same]


def distinct(parts: list[tuple[np.ndarray, np.ndarray]], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct feature numbers of ``n`` rows one after the other, their counts and the rows' offsets, from (numbers, rows) parts."""
    slot = np.concatenate([p[0] for p in parts])
    row = np.concatenate([p[1] for p in parts])
    keys, counts = np.unique(row << BITS | slot, return_counts=True)
    return keys & DIMS - 1, counts, np.searchsorted(keys, np.arange(n + 1) << BITS)


def grouped(parts: list[tuple[np.ndarray, np.ndarray]], n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct feature numbers and their counts for each of ``n`` rows."""
    slot, counts, cuts = distinct(parts, n)
    return [(slot[a:b], counts[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


class Flat(Sequence):
    """Rows of 0/1 features in one array of numbers with offsets, each with a bias and dense extras.

    A row's own arrays are made when it is asked for, so many rows cost four bytes a feature.
    """

    def __init__(self, slot: np.ndarray, cuts: np.ndarray, dense: np.ndarray, chosen: np.ndarray | None = None):
        self.slot, self.cuts, self.dense = slot, cuts, dense
        self.chosen = np.arange(len(cuts) - 1) if chosen is None else chosen
        self.tail = (DIMS + np.arange(1 + dense.shape[1])).astype(slot.dtype)

    def only(self, chosen: np.ndarray) -> Flat:
        return Flat(self.slot, self.cuts, self.dense, self.chosen[chosen])

    def __len__(self) -> int:
        return len(self.chosen)

    def __getitem__(self, k: int) -> Sparse:
        r = self.chosen[k]
        i = np.concatenate([self.slot[self.cuts[r] : self.cuts[r + 1]], self.tail])
        x = np.ones(len(i), np.float32)
        x[len(i) - self.dense.shape[1] :] = self.dense[r]
        return i, x


def margins(w: np.ndarray, slot: np.ndarray, cuts: np.ndarray, dense: np.ndarray) -> np.ndarray:
    """Dot products of a model with rows of 0/1 features, their bias and dense extras."""
    n = len(cuts) - 1
    own = np.bincount(np.repeat(np.arange(n), np.diff(cuts)), w[slot].astype(float), n)
    return own + float(w[DIMS]) + dense @ w[DIMS + 1 :].astype(float)


def sigmoids(s: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(s, -35.0, 35.0)))


def epochs(rows: int, updates: int = 24_000) -> int:
    """Passes over a shard: more over a small one, so that each model sees about as many updates."""
    return max(3, min(40, updates // max(rows, 1)))


def sigmoid(s: float) -> float:
    return 1.0 / (1.0 + np.exp(-min(max(s, -35.0), 35.0)))


class Ftrl:
    """Per-coordinate FTRL-Proximal for logistic loss; coordinates from ``DIMS`` on are not L1-penalised."""

    def __init__(self, extras: int = 0, alpha: float = 0.3, beta: float = 1.0, l1: float = 0.5, l2: float = 1.0):
        self.z, self.n = np.zeros(DIMS + 1 + extras), np.zeros(DIMS + 1 + extras)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at=slice(None)) -> np.ndarray:
        z, l1 = self.z[at], np.full(len(self.z), self.l1)
        l1[DIMS:] = 0
        return -np.sign(z) * np.maximum(np.abs(z) - l1[at], 0) / ((self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2)

    def fit(self, rows: Sequence[Sparse], y: np.ndarray, epochs: int, seed: int = 7) -> np.ndarray:
        rng = np.random.default_rng(seed)
        for _ in range(epochs):
            for k in rng.permutation(len(rows)).tolist():
                i, x = rows[k]
                z, root = self.z[i], np.sqrt(self.n[i])
                w = -np.sign(z) * np.maximum(np.abs(z) - np.where(i < DIMS, self.l1, 0.0), 0) / ((self.beta + root) / self.alpha + self.l2)
                g = (sigmoid(float(w @ x)) - y[k]) * x
                n = self.n[i] + g * g
                self.z[i] = z + g - (np.sqrt(n) - root) / self.alpha * w
                self.n[i] = n
        return self.weights()


def labelled_sample(docs: DataFrame, labels: DataFrame, targets: dict[str, Column], train_rows: int, id_col: str = "doc_id", text: str = "text", most_shards: int = MOST_SHARDS) -> tuple[DataFrame, int]:
    """(shard, order, id, text, a 0/1 column for each target) of a hash sample of the labelled rows, and the number of shards.

    Each labelled id counts once, however many rows have it (the least text stands for it).  The sample has ``train_rows`` rows on average at most,
    which bounds what is broadcast and what a training task holds.
    """
    rows = labels.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(*[F.max(c.cast("int")).alias(k) for k, c in targets.items()]).dropna()
    n = rows.count()
    ppm = 1_000_000 if n <= train_rows else int(1_000_000 * train_rows / n)
    shards = max(1, min(most_shards, min(n, train_rows) // SHARD_ROWS))
    h = F.xxhash64(F.col(id_col).cast("string"), F.lit("sample"))
    rows = rows.where(F.pmod(h, F.lit(1_000_000)) < ppm).withColumn("shard", F.pmod(F.shiftright(h, 20), F.lit(shards)).cast("int"))
    texts = docs.select(F.col(f"`{id_col}`").alias(id_col), F.coalesce(F.col(text), F.lit("")).alias("text"))
    met = texts.join(F.broadcast(rows), id_col).groupBy(id_col).agg(F.min("text").alias("text"), *[F.first(c).alias(c) for c in ("shard", *targets)])
    ident = F.col(id_col).cast("string")
    return met.select("shard", F.xxhash64(ident, F.lit("order")).alias("order"), ident.alias("id"), "text", *targets), shards


def train(sample: DataFrame, shards: int, fit: Callable[[pa.Table], dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    """Run ``fit`` on each shard and average the weights by model name.

    What comes to the driver is the models' non-zero weights, bounded by their size.
    """

    def trained(table: pa.Table) -> Iterator[pa.RecordBatch]:
        for name, w in fit(table).items():
            yield weight_rows(name, w)

    # ranges and not hashes of the few shard numbers, so that no two shards share a task
    dealt = sample.repartitionByRange(shards, "shard").sortWithinPartitions("shard", "order", "id")
    return mean_weights(written(by_group(dealt, trained, WEIGHTS), "weights"), shards)


WEIGHTS = "model string, slot long, w double, size long"


def weight_rows(name: str, w: np.ndarray) -> pa.RecordBatch:
    """The non-zero weights of a model; its last one tells the size."""
    at = np.union1d(np.flatnonzero(w), [len(w) - 1])
    return pa.RecordBatch.from_pydict({"model": [name] * len(at), "slot": at, "w": w[at], "size": np.full(len(at), len(w))})


def mean_weights(rows: DataFrame, shards: int) -> dict[str, np.ndarray]:
    """The average over the shards, in an order of summation of its own."""
    mean = rows.groupBy("model", "slot").agg(F.aggregate(F.sort_array(F.collect_list("w")), F.lit(0.0), lambda a, x: a + x).alias("w"), F.max("size").alias("size"))
    out: dict[str, np.ndarray] = {}
    for r in mean.toLocalIterator():
        out.setdefault(r["model"], np.zeros(r["size"]))[r["slot"]] = r["w"] / shards
    return out


def by_group(dealt: DataFrame, each: Callable[[pa.Table], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``each`` on the rows of every value of the first column, which come sorted by it."""
    ship_package(dealt.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            own = b.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(own[1:] != own[:-1]) + 1).tolist(), len(own)]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                if held and held[-1].column(0)[0].as_py() != own[lo]:
                    yield from each(pa.Table.from_batches(held))
                    held = []
                if hi > lo:
                    held.append(b.slice(lo, hi - lo))
        if held:
            yield from each(pa.Table.from_batches(held))

    return dealt.mapInArrow(run, schema)


def mapped(docs: DataFrame, id_col: str, text: str, score: Callable[[pa.Array], dict[str, np.ndarray]], schema: str) -> DataFrame:
    """One row per input row: ``id_col`` and the columns that ``score`` gives."""
    ship_package(docs.sparkSession)
    wanted = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(text).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = score(b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, got.values())], [id_col, *got])

    return wanted.mapInArrow(run, f"`{id_col}` {wanted.schema[0].dataType.simpleString()}, {schema}")
