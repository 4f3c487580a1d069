"""Benchmark decontamination (operator 3): SimHash of item-sized windows, multi-index Hamming blocks, exact check.

Words are lower-cased runs of letters and digits (any non-ASCII byte counts as a letter;
Unicode lower case by one function for items and documents), so case and punctuation do not hide a copy.  For an item of w words, all windows of w
words of a document are candidates as follows:

1. A window's fingerprint is the SimHash of its five-word shingles: for each bit, whether
   more than half of their hashes have it.  Sums of bits along the text give every window's
   in the same time, however long it is.
2. Eight blocks of eight bits index the items of each size: sorted block values, in which
   a pattern's items are found by bisection.  Two fingerprints within ``RADIUS`` = 23 bits
   differ by at most two bits in some block, so looking up the 37 patterns within two bits
   of each block finds every item within the radius.
3. A candidate within the radius is verified: the weight of the shingles that window and
   item share, over the item's weight, must reach ``threshold``; a shingle found in few items
   weighs more than one found in many.  An item that shares no
   shingle with the document is no candidate.

A window that shares no shingle with an item of its size can never pass step 3, so only
windows around a shared shingle are fingerprinted; this loses nothing.

The benchmark is a stated query set, used in blocks of about ``BLOCK_CHARS`` characters, each
broadcast (some 60 MB) and given up before the next, so what driver and tasks hold is bounded
however many items there are.  A weight counts the items of the whole benchmark: one block
counts its own, and of several each gets the counts of its own shingles from a table that
Spark has made of all.  Fingerprints have no weights, so no result depends on the blocks.

Defined results: null or empty texts have no windows; an item of fewer than five words is
one shingle (its whole sequence); items without words are ignored; a document shorter
than an item is one window; repeated items and rows are each reported; an empty table on
either side gives no findings.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from . import textkernels as tk
from .common import giving_back, ship_package, written

SHINGLE = 5
THRESHOLD = 0.8
RADIUS = 23
BLOCK_CHARS = 8_000_000
PAIRS = 2_000_000  # pairs of windows and items that a task looks up at once,
STRETCH = 1 << 16  # and the positions whose bits it sums
FILTER_BITS = 22


def _words(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """(first row, word hashes, their rows in the chunk, rows) of each chunk."""
    for row, data, offsets in tk.chunks(column):
        data = tk.LOWER[data]
        starts, ends, rows = tk.word_bounds(data, offsets, tk.IS_PUNCT)
        yield row, tk.word_hashes(data, starts, ends), rows, len(offsets) - 1


_NEAR = np.array([m for m in range(256) if m.bit_count() <= RADIUS // 8], np.uint8)


def _shingles(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The words and the shingles of each item."""
    for _, h, rows, n in _words(_lowered(column)):
        for w in np.split(h, np.searchsorted(rows, np.arange(1, n))):
            yield w, tk.gram_hashes(w, min(SHINGLE, len(w))) if len(w) else w


def shingle_counts(benchmark: DataFrame, text: str = "text") -> tuple[int, DataFrame]:
    """The items with words, and (g, n) of the shingles that several of them hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for w, grams in _shingles(b.column(0)):
                if len(w):
                    keys = np.unique(grams).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.append(keys, 0)), pa.array(np.append(np.ones(len(keys), bool), False))], ["g", "real"])

    ship_package(benchmark.sparkSession)
    counted = benchmark.select(F.col(text).alias("t")).mapInArrow(giving_back(run), "g long, real boolean").groupBy("real", "g").agg(F.count("*").alias("n"))
    counted = written(counted.where("n > 1 OR NOT real"), "shingle-counts")
    return counted.where("NOT real").agg(F.max("n")).first()[0] or 0, counted.where("real").select("g", "n")


def _counts_of(keys: np.ndarray, counted: DataFrame) -> np.ndarray:
    """How many items hold each of a block's shingles, by a join with the counts of all; as many rows as keys at most."""
    own = counted.sparkSession.createDataFrame(pa.table({"g": keys.view(np.int64)}))
    found = counted.join(F.broadcast(own), "g").toArrow()
    out = np.ones(len(keys), np.int64)
    out[np.searchsorted(keys, found.column("g").to_numpy().view(np.uint64))] = found.column("n").to_numpy()
    return out


def prints(grams: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """SimHashes of the windows of ``size`` shingles at ascending starts, by differences of running sums, eight bits at a time."""
    out = np.zeros((len(starts), 8), np.uint8)
    at = 0
    while at < len(starts):
        first = int(starts[at])
        to = int(np.searchsorted(starts, first + STRETCH))
        mixed = tk.mix(grams[first : int(starts[to - 1]) + size].copy()).view(np.uint8).reshape(-1, 8)
        s = starts[at:to] - first
        for b in range(8):
            sums = np.zeros((len(mixed) + 1, 8), np.int32)
            np.cumsum(np.unpackbits(mixed[:, b : b + 1], axis=1, bitorder="little"), axis=0, out=sums[1:])
            out[at:to, b] = np.packbits(2 * (sums[s + size] - sums[s]) > size, axis=1, bitorder="little")[:, 0]
        at = to
    return out.view("<u8").ravel()


class BenchmarkIndex:
    """Items by shingle and, for each size in words, by fingerprint blocks."""

    def __init__(self, item_ids: list, texts: list[str], n_items: int | None = None, counted: DataFrame | None = None):
        words, grams = zip(*_shingles(pa.array(texts, pa.string())), strict=True) if texts else ((), ())
        some = [k for k, w in enumerate(words) if len(w)]
        self.ids = [item_ids[k] for k in some]
        self.sizes = np.array([len(words[k]) for k in some], np.int64)
        grams = [grams[k] for k in some]
        distinct = [np.unique(g, return_counts=True) for g in grams]
        every = np.concatenate([d[0] for d in distinct]) if distinct else np.zeros(0, np.uint64)
        self.keys, held = np.unique(every, return_counts=True)
        if counted is not None:
            held = _counts_of(self.keys, counted)
        weights = np.log1p((len(some) if n_items is None else n_items) / held)
        owner = np.repeat(np.arange(len(some)), [len(d[0]) for d in distinct]) if some else np.zeros(0, np.int64)
        order = np.argsort(every, kind="stable")
        self.owner, self.first = owner[order], np.append(np.searchsorted(every[order], self.keys), len(every))
        self.items = [(k, c, weights[np.searchsorted(self.keys, k)]) for k, c in distinct]
        self.totals = np.array([float((c * w).sum()) for _, c, w in self.items])
        self.prints = np.array([prints(g, np.zeros(1, np.int64), len(g))[0] for g in grams], np.uint64)
        # for each size: its items and, for each block, the block values in order with the items that have them
        self.blocks = {}
        for size in np.unique(self.sizes).tolist():
            mine = np.flatnonzero(self.sizes == size).astype(np.int32)
            values = [(self.prints[mine] >> np.uint64(8 * b)).astype(np.uint8) for b in range(8)]
            by = [np.argsort(v, kind="stable").astype(np.int32) for v in values]
            self.blocks[size] = (mine, [(v[o], o) for v, o in zip(values, by, strict=True)])
        self.filters = {g: self._filter(g) for g in {min(SHINGLE, s) for s in self.sizes.tolist()}}

    def _filter(self, gram: int) -> np.ndarray:
        """A bit table that passes every item shingle of ``gram`` words."""
        out = np.zeros(1 << FILTER_BITS, bool)
        own = [k for (k, _, _), s in zip(self.items, self.sizes.tolist(), strict=True) if min(SHINGLE, s) == gram]
        out[(np.concatenate(own) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
        return out

    def near_items(self, size: int, prints: np.ndarray, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, item, distance) of all pairs of this size within the radius, by block lookup; only ``wanted`` items, if given."""
        mine, tables = self.blocks[size]
        found = [np.zeros(0, np.int64)]
        allowed = np.ones(len(mine), bool) if wanted is None else np.isin(mine, wanted)
        for b, (values, items) in enumerate(tables):
            probes = (prints >> np.uint64(8 * b)).astype(np.uint8)[:, None] ^ _NEAR[None, :]
            lo, hi = np.searchsorted(values, probes.ravel(), "left"), np.searchsorted(values, probes.ravel(), "right")
            n = hi - lo
            win = np.repeat(np.repeat(np.arange(len(prints)), len(_NEAR)), n)
            at = items[np.arange(n.sum()) + np.repeat(lo - (np.cumsum(n) - n), n)]
            ok = allowed[at]
            found.append(win[ok] * len(mine) + at[ok])
        win, at = np.divmod(np.unique(np.concatenate(found)), len(mine))
        apart = np.bitwise_count(prints[win] ^ self.prints[mine[at]])
        ok = apart <= RADIUS
        return win[ok], mine[at[ok]], apart[ok]

    def similarities(self, grams: np.ndarray, starts: np.ndarray, size: int, item: int) -> np.ndarray:
        """For each window of ``size`` shingles: the weight of those shared with the item (with repeats), over the item's weight."""
        keys, counts, weights = self.items[item]
        first = int(starts[0])
        part = grams[first : int(starts[-1]) + size]
        slot = np.minimum(np.searchsorted(keys, part), len(keys) - 1)
        slot = np.where(keys[slot] == part, slot, len(keys))
        out = np.empty(len(starts))
        for k, s in enumerate((starts - first).tolist()):
            n = np.bincount(slot[s : s + size], minlength=len(keys) + 1)[:-1]
            out[k] = (np.minimum(counts, n) * weights).sum() / self.totals[item]
        return out

    def anchors(self, words: np.ndarray, rows: np.ndarray) -> dict[tuple[int, int], tuple[list[int], set[int]]]:
        """(row, size in words) -> word positions where the row shares a shingle with items of that size, and those items."""
        found: dict[tuple[int, int], tuple[list[int], set[int]]] = defaultdict(lambda: ([], set()))
        for gram, table in self.filters.items():
            h = tk.gram_hashes(words, gram)
            at = np.flatnonzero(table[(h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
            at = at[rows[at] == rows[at + gram - 1]]
            slot = np.minimum(np.searchsorted(self.keys, h[at]), len(self.keys) - 1)
            real = self.keys[slot] == h[at]
            for p, s in zip(at[real].tolist(), slot[real].tolist(), strict=True):
                owners = self.owner[self.first[s] : self.first[s + 1]]
                sizes = self.sizes[owners]
                for size in np.unique(sizes).tolist():
                    if min(SHINGLE, size) == gram:
                        places, items = found[int(rows[p]), size]
                        places.append(p)
                        items.update(owners[sizes == size].tolist())
        return found

    def search(self, column: pa.Array, threshold: float) -> list[tuple[int, int, int, int, int, float]]:
        """(row, item, first word, words, distance, similarity): the best window of each row and item."""
        best: dict[tuple[int, int], tuple] = {}
        if not self.ids:
            return []
        for row0, words, rows, n in _words(column):
            ends = np.cumsum(tk.row_counts(rows, n))
            for (row, size), (points, items) in self.anchors(words, rows).items():
                lo, hi = int(ends[row - 1]) if row else 0, int(ends[row])
                span = min(size, hi - lo)
                gram = min(SHINGLE, size)
                if span < gram:
                    continue
                wide = span - gram + 1
                edge = np.zeros(hi - lo - span + 2, np.int32)  # starts whose window holds a shared shingle
                at = np.array(points) - lo
                np.add.at(edge, np.clip(at - wide + 1, 0, len(edge) - 1), 1)
                np.add.at(edge, np.minimum(at + 1, len(edge) - 1), -1)
                starts = np.flatnonzero(np.cumsum(edge)[:-1] > 0)
                grams = tk.gram_hashes(words[lo:hi], gram)
                wanted = np.array(sorted(items))
                step = max(1, PAIRS // (len(_NEAR) * len(self.blocks[size][0])))
                for s in np.split(starts, np.arange(step, len(starts), step)):
                    win, found, apart = self.near_items(size, prints(grams, s, wide), wanted)
                    for item in np.unique(found).tolist():
                        mine = found == item
                        sims = self.similarities(grams, s[win[mine]], wide, item)
                        sim, near, first = max(zip(sims.tolist(), (-apart[mine].astype(np.int64)).tolist(), (-s[win[mine]]).tolist(), strict=True))
                        if sim >= threshold:
                            key = (row0 + row, item)
                            best[key] = max(best.get(key, (0.0,)), (sim, near, first, span))
        return [(row, item, -at, span, -apart, sim) for (row, item), (sim, apart, at, span) in sorted(best.items())]


def _blocks(benchmark: DataFrame, id_col: str, text: str) -> Iterator[tuple[BenchmarkIndex, bool]]:
    """The benchmark in blocks of bounded size, streamed to the driver one partition at a time; and whether more follow."""
    ids, texts, held, counted = [], [], 0, (None, None)
    for r in benchmark.select(F.col(f"`{id_col}`").alias("i"), F.col(f"`{text}`").alias("t")).toLocalIterator():
        if held >= BLOCK_CHARS:
            if counted[1] is None:
                counted = shingle_counts(benchmark, text)
            yield BenchmarkIndex(ids, texts, *counted), True
            ids, texts, held = [], [], 0
        ids.append(r["i"])
        texts.append(r["t"])
        held += len(r["t"] or "")
    if ids:
        yield BenchmarkIndex(ids, texts, *counted), False


def _lowered(column: pa.Array) -> pa.Array:
    return pc.utf8_lower(column.fill_null("") if column.null_count else column)


def find_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, start_word, n_words, hamming, similarity): one row per leaking document and item."""
    spark = docs.sparkSession
    ship_package(spark)
    wanted = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(text).alias("_text"))
    kinds = wanted.schema[0].dataType.simpleString(), benchmark.schema[item_col].dataType.simpleString()
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, start_word long, n_words long, hamming long, similarity double"
    item_type = to_arrow_type(benchmark.schema[item_col].dataType)
    out = spark.createDataFrame([], schema)
    for index, more in _blocks(benchmark, item_col, item_text):
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            ix = shared.value
            for b in batches:
                found = ix.search(_lowered(b.column(1)), threshold)
                if found:
                    row, item, at, n, apart, sim = zip(*found, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(pa.array(row)), pa.array([ix.ids[i] for i in item], item_type), pa.array(at, pa.int64()), pa.array(n, pa.int64()), pa.array(apart, pa.int64()), pa.array(sim)],
                        ["doc_id", "item_id", "start_word", "n_words", "hamming", "similarity"],
                    )

        part = wanted.mapInArrow(giving_back(run), schema)
        if more:
            part = written(part, "leaks")
            shared.destroy()
        out = out.union(part)
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, text: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The documents in which no benchmark item is found; rows pass by, so nothing is shuffled or joined."""
    ship_package(docs.sparkSession)
    out, at = docs, docs.columns.index(text)
    for index, more in _blocks(benchmark, item_col, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for b in batches:
                keep = np.ones(b.num_rows, bool)
                keep[[f[0] for f in shared.value.search(_lowered(b.column(at)), threshold)]] = False
                yield b.filter(pa.array(keep))

        out = out.mapInArrow(giving_back(run), docs.schema)
        if more:
            out = written(out, "clean")
            shared.destroy()
    return out


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
