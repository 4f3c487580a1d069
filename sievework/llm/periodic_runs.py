"""Periodic run detection (operator 11): string synchronising sets at dyadic scales.

A run is a maximal stretch of words with smallest period q that is at least
``min_exponent`` periods and ``min_length`` words long.  Runs are found inside one text, so
the operator is one narrow pass without a shuffle; a task handles its texts in chunks, each
a sequence of exact word numbers with a symbol of its own behind every text.

* Periods below ``SMALL`` are found by comparing the sequence with itself, shifted.
* Scale t = 4, 8, 16, ... is in charge of the periods from t to 2t - 1.  A position i is in
  the synchronising set if the least hash of the t-word windows at i ... i + t stands at i
  or at i + t (Kempa and Kociumaka, 2019).  Windows in regions of a period up to t / 4 do
  not count: those regions are runs already found at smaller scales.  Whether a position is
  chosen depends on its 2t words alone, and every stretch of 3t - 1 words whose period is
  over t / 4 has a chosen one among its first t.
* In a run of period q, t <= q < 2t, a chosen position is followed by one with the same 2t
  words exactly q later.  So the nearest pairs of chosen positions with equal contexts
  propose the periods; proposals of one run are chained, and the chain's ends are
  extended to both sides by comparing prefix hashes.
* Every run is then compared word by word with itself; where a hash was wrong, its extent
  is found by plain comparison.

Defined results: null, empty and blank texts have no words and no runs; repeated rows and
null ids give a row each; texts of any length are handled whole, in memory that is linear in
their words; only the id and text columns are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textkernels as tk
from .common import giving_back, ship_package

MIN_LENGTH = 6
MIN_EXPONENT = 4
SMALL = 4
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_LEFT, _RIGHT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def word_numbers(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, gap: np.ndarray) -> np.ndarray:
    """Equal numbers for equal words, by content and not by hash."""
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[~gap])])
    return words.dictionary_encode().indices.to_numpy().astype(np.int64)


def _stretches(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the maximal stretches of true."""
    edge = np.flatnonzero(np.diff(np.concatenate(([False], flags, [False])).view(np.int8)))
    return edge[::2], edge[1::2] - edge[::2]


def _small(x: np.ndarray, q: int, exponent: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of period q < 4."""
    if len(x) <= q:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    start, n = _stretches(x[:-q] == x[q:])
    keep = n >= (exponent - 1) * q
    start, n = start[keep], n[keep]
    if q > 1 and len(start):  # 2 and 3 have no divisor but 1
        keep = np.any([x[start] != x[start + k] for k in range(1, q)], axis=0)
        start, n = start[keep], n[keep]
    return start, start + n + q


class _Prefixes:
    """Common extensions of two places by prefix hashes and bisection, all pairs at once."""

    def __init__(self, values: np.ndarray):
        self.sums, self.n = tk.prefix_hash(values), len(values)

    def _same(self, i: np.ndarray, j: np.ndarray, n: np.ndarray) -> np.ndarray:
        return tk.span_hash(self.sums, i, i + n) == tk.span_hash(self.sums, j, j + n)

    def _most(self, limit: np.ndarray, holds) -> np.ndarray:
        low, high = np.zeros(len(limit), np.int64), limit.copy()
        while np.any(low < high):
            mid = (low + high + 1) // 2
            ok = holds(mid)
            low, high = np.where(ok, mid, low), np.where(ok, high, mid - 1)
        return low

    def after(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols from i and from j > i on agree."""
        return self._most(self.n - j, lambda m: self._same(i, j, m))

    def before(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols before i and before j > i agree."""
        return self._most(i, lambda m: self._same(i - m, j - m, m))


def _plain(x: np.ndarray, at: int, q: int) -> tuple[int, int]:
    """The stretch of period q around ``at`` by plain comparison."""
    lo, hi = at, at + q
    while lo > 0 and x[lo - 1] == x[lo - 1 + q]:
        lo -= 1
    while hi < len(x) and x[hi] == x[hi - q]:
        hi += 1
    return lo, hi


def _least(h: np.ndarray, t: int) -> np.ndarray:
    """The least of h[i] ... h[i + t] for each i; t is a power of two."""
    width = 1
    while width < t:
        h = np.minimum(h[:-width], h[width:])
        width *= 2
    return np.minimum(h[:-1], h[1:])


def find_runs(x: np.ndarray, longest: int, exponent: int = MIN_EXPONENT) -> np.ndarray:
    """(start, end, period) of every run of at least ``exponent`` >= 4 periods in a sequence of symbols.

    ``longest`` bounds the length of a run (that of the longest text).
    """
    n = len(x)
    found = []
    for q in range(1, SMALL):
        a, b = _small(x, q, exponent)
        found.append(np.stack([a, b, np.full(len(a), q)], axis=1))
    runs = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    if longest < exponent * SMALL or n < 2 * SMALL:
        return runs
    values = tk.mix(x.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019))
    prefixes = None
    h, t = values, 1
    while exponent * t <= longest and 2 * t <= n:
        double = tk.mix(h[:-t] * _LEFT + (h[t:] ^ (h[t:] >> np.uint64(31))) * _RIGHT)  # hashes of 2t symbols
        if t < SMALL:
            h, t = double, 2 * t
            continue
        ids = h
        inner = runs[(4 * runs[:, 2] <= t) & (runs[:, 1] - runs[:, 0] >= t)]
        if len(inner):
            mark = np.zeros(n + 1, np.int32)
            np.add.at(mark, inner[:, 0], 1)
            np.add.at(mark, inner[:, 1] - t + 1, -1)
            ids = np.where(np.cumsum(mark)[: len(h)] > 0, _NONE, h)
        least = _least(ids, t)
        chosen = np.flatnonzero((least != _NONE) & ((least == ids[: len(least)]) | (least == ids[t : t + len(least)])))
        context = double[chosen]
        order = np.argsort(context, kind="stable")
        one, two = chosen[order[:-1]], chosen[order[1:]]
        period = two - one
        near = (context[order[:-1]] == context[order[1:]]) & (period >= t) & (period < 2 * t)
        one, period = one[near], period[near]
        if len(one):
            by = np.lexsort((one, period))
            one, period = one[by], period[by]
            link = (period[1:] == period[:-1]) & (one[1:] - one[:-1] <= 2 * t)
            first = np.flatnonzero(np.concatenate(([True], ~link)))
            last = np.concatenate((first[1:], [len(one)])) - 1
            prefixes = prefixes or _Prefixes(values)
            q = period[first]
            a = one[first] - prefixes.before(one[first], one[first] + q)
            b = one[last] + q + prefixes.after(one[last], one[last] + q)
            keep = b - a >= exponent * q
            more = np.stack([a[keep], b[keep], q[keep]], axis=1)
            for k, (lo, hi, p) in enumerate(more.tolist()):
                open_left = lo > 0 and x[lo - 1] == x[lo - 1 + p]
                open_right = hi < n and x[hi] == x[hi - p]
                if open_left or open_right or not np.array_equal(x[lo : hi - p], x[lo + p : hi]):
                    more[k, :2] = _plain(x, int(one[first][keep][k]), p)
            more = more[more[:, 1] - more[:, 0] >= exponent * more[:, 2]]
            runs = np.concatenate([runs, np.unique(more, axis=0)])
        h, t = double, 2 * t
    return runs


def _texts(runs: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray, n: int) -> pa.Array:
    """Each row's words without those a run repeats, joined by one space; ``runs`` in word numbers of the chunk."""
    mark = np.zeros(len(starts) + 1, np.int32)
    np.add.at(mark, runs[:, 0] + runs[:, 2], 1)
    np.add.at(mark, runs[:, 1], -1)
    kept = np.flatnonzero(np.cumsum(mark)[:-1] == 0)
    inside = np.concatenate(([False], rows[kept][1:] == rows[kept][:-1])) if len(kept) else np.zeros(0, bool)
    begin = starts[kept] - inside  # with the gap's last byte, which becomes the space
    out = data.copy()
    out[begin[inside]] = 0x20
    edge = np.zeros(len(data) + 1, np.int32)
    edge[begin] += 1
    np.add.at(edge, ends[kept], -1)
    size = np.bincount(rows[kept], weights=(ends[kept] - begin), minlength=n).astype(np.int64)
    offsets = np.zeros(n + 1, np.int64)
    np.cumsum(size, out=offsets[1:])
    return pa.Array.from_buffers(pa.large_string(), n, [None, pa.py_buffer(offsets), pa.py_buffer(out[np.cumsum(edge)[:-1] > 0])]).cast(pa.string())


def _chunk(data: np.ndarray, offsets: np.ndarray, min_length: int, exponent: int) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Number of words, runs and collapsed text of every row of a chunk."""
    n = len(offsets) - 1
    starts, ends, rows = tk.word_bounds(data, offsets, tk.IS_SPACE)
    counts = tk.row_counts(rows, n)
    numbers = word_numbers(data, starts, ends, tk.IS_SPACE[data])
    first = np.concatenate(([0], np.cumsum(counts)))  # of each row in words; with the symbols behind texts it is first + row
    x = np.empty(len(numbers) + n, np.int64)
    x[np.arange(len(numbers)) + rows] = numbers
    x[first[1:] + np.arange(n)] = -1 - np.arange(n)
    runs = find_runs(x, int(counts.max()) if n else 0, exponent)
    runs = runs[runs[:, 1] - runs[:, 0] >= min_length]
    of = np.searchsorted(first[:-1] + np.arange(n), runs[:, 0], "right") - 1
    order = np.lexsort((runs[:, 2], runs[:, 0], of))
    runs, of = runs[order], of[order]
    start = runs[:, 0] - (first[of] + of)
    ends_of = np.concatenate(([0], np.cumsum(np.bincount(of, minlength=n)))).astype(np.int32)
    parts = [pa.array(v, pa.int64()) for v in (start, runs[:, 1] - runs[:, 0], runs[:, 2])]
    lists = pa.ListArray.from_arrays(pa.array(ends_of), pa.StructArray.from_arrays(parts, ["start", "length", "period"]))
    in_words = runs - np.stack([of, of, np.zeros_like(of)], axis=1)
    return pa.array(counts, pa.int64()), lists, _texts(in_words, data, starts, ends, rows, n)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """(id, n_words, runs, collapsed) for each row.

    ``runs`` is an array of (start, length, period) in words, by start and then period;
    ``collapsed`` are the words that no run holds after its first period, joined by one space.
    """
    if min_exponent < 4:
        raise ValueError("scales in powers of two find runs of four periods or more")
    ship_package(docs.sparkSession)
    source = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("text"))
    kind = dict(source.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("id"), batch.column("text")
            for row, data, offsets in tk.chunks(texts):
                n_words, runs, collapsed = _chunk(data, offsets, min_length, min_exponent)
                part = ids.slice(row, len(n_words))
                yield pa.RecordBatch.from_arrays([part, n_words, runs.cast(_RUNS), collapsed], ["id", "n_words", "runs", "collapsed"])

    out = source.mapInArrow(giving_back(run), f"id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")
    return out.withColumnRenamed("id", id_col)


def planted(doc_id: Column, text: Column) -> Column:
    """The text, or for one id in ten (by the CRC-32 of its digits) its words with a periodic tail."""
    t = F.coalesce(text, F.lit(""))
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split(t, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n = F.size(words)

    def tail(w: Column) -> Column:
        a = F.pmod(g, F.size(w)).cast("int")
        p = (1 + F.floor((F.size(w) - a) / (3 + F.pmod(g, F.lit(8))))).cast("int")
        return F.array_join(F.transform(F.sequence(F.lit(0), F.size(w) - 1), lambda i: F.get(w, F.when(i < a, i).otherwise(a + (i - a) % p))), " ")

    # the words enter through a one-element array, so that they are split once
    rewritten = F.get(F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, tail(w)).otherwise(t)), 0)
    return F.when(h % 10 == 0, rewritten).otherwise(t)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = periodic_runs(docs.select("doc_id", planted(F.col("doc_id"), F.col("text")).alias("text")))
    # greatest length, then smallest start, then smallest period
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    out = found.withColumn("_best", best)
    length, period = F.col("_best.length"), -F.col("_best.period")
    return out.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("_best.start")).alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.expr("(1000 * _best.length) div (-_best.period)").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
