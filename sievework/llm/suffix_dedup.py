"""Suffix-array dedup (operator 8): long repeats found with a logarithmic index family of suffix arrays.

A byte goes if a string of ``MATCH`` bytes that covers it also starts anywhere else.
Texts are UTF-8 bytes and matches never cross documents.

Sparse suffix arrays.  A full suffix array of a corpus is many times its size, so suffixes
are sampled: a window is a start with the ``MATCH`` bytes after it, and its anchor is the
place in it of the ``GRAM``-byte string with the least hash.  Equal windows have their anchors
at the same place inside, so looking at anchors loses no repeat; neighbouring windows
mostly share theirs, which leaves about one suffix for 50 bytes.  A suffix array holds the
suffixes that begin at anchors in the order of their letters: their heads (first ``GRAM``
letters), with the number of suffixes that have this head and the least and greatest
fingerprint of the segments (runs of windows with one anchor) around them.

The family.  Each batch of documents gets a suffix array of its own, range-partitioned and
sorted by letters.  A new array is merge-scanned against the levels it does not merge with
for heads that both have (no string of ``MATCH`` bytes repeats without its anchor's head);
levels of equal size merge, so n batches make at most log2(n) + 1 levels and each suffix is
rewritten log2(n) times.

Long matches.  A head with one suffix cannot repeat.  Where all suffixes of a head have one
segment, all its windows repeat.  Else one segment for each distinct content is fetched, in
the order of letters, and a task builds the suffix array of their windows by doubling
prefixes (8, 16, ... letters): windows of one rank agree in all ``MATCH`` letters, bytes and
not hashes deciding.  Copies never gather in one task.  A head whose segments are more than
``HOT_BYTES`` is split by more letters: a window that holds the head has ``REACH`` letters more
on its right or on its left, so segments are compared where they agree in either.  What is
still larger is compared by counting 128-bit window fingerprints in a shuffle.

Contents of segments with one head are told apart by 64-bit fingerprints.

Defined results: a null text is empty; documents under ``MATCH`` bytes lose nothing; rows
that repeat in full count as two places; null ids are ordinary; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textkernels as tk
from .common import discard, join_heavy, ship_package, written

MATCH = 200
GRAM = 32
BATCH_SUFFIXES = 1 << 28  # about 16 GB of text
SLOTS = 63  # folders of the table of suffixes; a batch has one or more
HOT_BYTES = 1 << 17  # of distinct segments that a task compares in one group
REACH = (MATCH - GRAM + 1) // 2  # letters that a window has right or left of a head in it


def sliding(values: np.ndarray, width: int, op: np.ufunc, fill: int) -> np.ndarray:
    """``op`` (minimum or maximum) over each ``width`` neighbouring values, in a few passes."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, values.dtype)
    padded = np.full(-(-len(values) // width) * width, fill, values.dtype)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = op.accumulate(blocks, axis=1).ravel()
    behind = op.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return op(behind[:n], ahead[width - 1 : width - 1 + n])


def segments(data: np.ndarray, offsets: np.ndarray, match: int = MATCH, gram: int = GRAM):
    """(row, start, windows, anchor, content, tied) of the segments of a chunk's rows; ``anchor`` is a place in the chunk.

    ``tied``: the anchor's string occurs more than once in the row, so windows of one segment may be equal.
    """
    width = match - gram + 1
    n = len(data) - match + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none, none, none, none, np.zeros(0, np.uint64), np.zeros(0, bool)
    prefix = tk.prefix_hash(tk.BYTES[data])
    grams = tk.mix((prefix[gram:] - prefix[:-gram]) * tk.powers(len(prefix))[1][: len(prefix) - gram])
    key = sliding(grams, width, np.minimum, (1 << 64) - 1)
    # windows that stay inside a row
    long = np.diff(offsets) >= match
    edge = np.zeros(n + 1, np.int8)
    edge[offsets[:-1][long]] += 1
    edge[offsets[1:][long] - match + 1] -= 1
    valid = np.cumsum(edge[:n], dtype=np.int8) > 0
    new = np.ones(n, bool)
    new[1:] = key[1:] != key[:-1]
    new[offsets[:-1][long]] = True
    start = np.flatnonzero(valid & new)
    row = np.searchsorted(offsets, start, "right") - 1
    stop = np.minimum(np.append(start[1:], n), offsets[row + 1] - match + 1)
    count = stop - start
    content = tk.mix(tk.span_hash(prefix, start, stop + match - 1) ^ count.astype(np.uint64))
    k = key[start]
    # strings that are the least of some window; those that recur in a row tie
    shown = np.where(valid, key, np.uint64(0))
    most = sliding(np.concatenate([np.zeros(width - 1, np.uint64), shown, np.zeros(width - 1, np.uint64)]), width, np.maximum, 0)
    least = np.flatnonzero(grams == most[: len(grams)])
    # a segment's anchor is the first place from its start on that has its least hash
    at = np.searchsorted(least, start)
    while (late := np.flatnonzero(grams[least[at]] != k)).size:
        at[late] += 1
    own = np.searchsorted(offsets, least, "right") - 1
    salted = np.sort(tk.mix(grams[least] ^ (own.astype(np.uint64) << np.uint64(32))))
    again = np.unique(salted[1:][salted[1:] == salted[:-1]])
    tied = np.isin(tk.mix(k ^ (row.astype(np.uint64) << np.uint64(32))), again) if len(again) else np.zeros(len(k), bool)
    return row, start - offsets[row], count, least[at], content, tied


def _rows(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """(_id, uid, text): id and text hash name a row's text; ranges found for them hold for it."""
    t = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(f"`{id_col}`").alias("_id"), F.xxhash64(t).alias("uid"), t.alias("text"))


def _fixed_binary(rows: np.ndarray) -> pa.Array:
    n, width = rows.shape
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((np.arange(n + 1) * width).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(rows))])


def suffixes(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(_id, uid, start, windows, head, content, tied): the sampled suffixes of all rows."""
    ship_package(docs.sparkSession)
    wanted = _rows(docs, id_col, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, data, offsets in tk.chunks(b.column(2)):
                row, start, count, anchor, content, tied = segments(data, offsets)
                if len(row):
                    heads = np.lib.stride_tricks.sliding_window_view(data, GRAM)[anchor]
                    own = pa.array(first + row)
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(own), b.column(1).take(own), pa.array(start.astype(np.int32)), pa.array(count.astype(np.int32)), _fixed_binary(heads), pa.array(content.view(np.int64)), pa.array(tied)],
                        ["_id", "uid", "start", "windows", "head", "content", "tied"],
                    )

    return wanted.mapInArrow(run, f"_id {wanted.schema['_id'].dataType.simpleString()}, uid long, start int, windows int, head binary, content long, tied boolean")


class LevelFamily:
    """Suffix arrays (head, n, low, high, tied) in the order of letters, in levels of doubling size."""

    def __init__(self) -> None:
        self.levels: list[tuple[int, DataFrame]] = []  # (batches merged, array)
        self.matches: list[DataFrame] = []

    @staticmethod
    def _array(rows: DataFrame) -> DataFrame:
        """Equal heads as one entry (counted where they are first), all in the order of letters."""
        heads = rows.groupBy("head").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), F.max("tied").alias("tied"))
        return written(heads.repartitionByRange("head").sortWithinPartitions("head"), "suffix-array")

    def add(self, batch: DataFrame) -> None:
        """Index a batch of suffixes: scan its array against the levels and merge equal ones."""
        array, size = self._array(batch.select("head", F.lit(1).cast("long").alias("n"), F.col("content").alias("low"), F.col("content").alias("high"), "tied")), 1
        merging, at = [], size
        for s, level in reversed(self.levels):
            if s != at:
                break
            merging.append(level)
            at *= 2
        kept = self.levels[: len(self.levels) - len(merging)]
        for _, level in kept:
            met = array.join(level.toDF("head", "n_", "low_", "high_", "tied_").hint("merge"), "head")
            both = met.select("head", F.col("n") + F.col("n_"), F.least("low", "low_"), F.greatest("high", "high_"), F.col("tied") | F.col("tied_"))
            self.matches.append(written(both.toDF("head", "n", "low", "high", "tied"), "suffix-matches"))
        for level in merging:  # merging meets every head of both arrays, so it is their scan as well
            merged = self._array(array.union(level))
            discard(array, level)
            array, size = merged, size * 2
        self.levels = [*kept, (size, array)]

    def shared(self) -> DataFrame:
        """(head, n, same): heads of more than one suffix, or of one that may repeat itself; ``same``: all have one segment."""
        rows = None
        for part in [*(r.where("n > 1 OR tied") for _, r in self.levels), *self.matches]:
            rows = part if rows is None else rows.union(part)
        # a head's n counts a level once for each scan that met it; more than one suffix is what matters
        heads = rows.groupBy("head").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), F.max("tied").alias("tied"))
        return heads.select("head", "n", ((F.col("low") == F.col("high")) & (F.col("n") > 1)).alias("same"))

    def drop(self) -> None:
        discard(*(r for _, r in self.levels), *self.matches)


def _places(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place in the data, row, window number) of all windows of the rows."""
    count = np.maximum(np.diff(offsets) - MATCH + 1, 0)
    row = np.repeat(np.arange(len(count)), count)
    number = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    return offsets[:-1][row] + number, row, number


def letter_ranks(data: np.ndarray, at: np.ndarray, length: int = MATCH) -> np.ndarray:
    """The rank of each string ``data[a : a + length]`` among all in the order of letters; equal strings share it.

    Ranks of 8 letters are made from the bytes, and ranks of w letters, taken w apart, give those of 2 w.
    """
    width = 8
    padded = np.append(data, np.zeros(width, np.uint8)).astype(np.uint64)
    first = np.zeros(len(data), np.uint64)
    for k in range(width):
        first = first << np.uint64(8) | padded[k : k + len(data)]
    rank = np.unique(first, return_inverse=True)[1]
    while 2 * width <= length:
        rank = np.unique(rank[:-width] * (rank.max(initial=0) + 1) + rank[width:], return_inverse=True)[1]
        width *= 2
    return np.unique(rank[at] * (rank.max(initial=0) + 1) + rank[at + length - width], return_inverse=True)[1]


def _runs(row: np.ndarray, number: np.ndarray, n: int) -> list[list[tuple[int, int]]]:
    """Byte ranges covered by the given windows of each row."""
    out: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    if len(row):
        cut = np.flatnonzero((row[1:] != row[:-1]) | (number[1:] != number[:-1] + 1)) + 1
        for a, b in zip(np.append(0, cut).tolist(), np.append(cut, len(row)).tolist(), strict=True):
            out[row[a]].append((int(number[a]), int(number[b - 1]) + MATCH))
    return out


_CONTEXT = "head binary, content long, n long, bytes binary"
_FOUND = "head binary, content long, n long, ranges array<struct<s:int,e:int>>"


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, head, content, n, bytes) in the order of keys -> (head, content, n, ranges)."""

    def settle(rows: list[tuple]) -> pa.RecordBatch:
        keys, heads, contents, counts, raw = zip(*rows, strict=True)
        whole = np.array(counts) > 1
        data = np.frombuffer(b"".join(raw), np.uint8)
        at, row, number = _places(np.append(0, np.cumsum([len(x) for x in raw])))
        # a context is under a key once, so a rank met twice under a key is met in two places
        numbers = {k: i for i, k in enumerate(dict.fromkeys(keys))}
        group = np.array([numbers[k] for k in keys], np.int64)[row]
        _, back, met = np.unique(letter_ranks(data, at) * len(numbers) + group, return_inverse=True, return_counts=True)
        hit = (met[back] > 1) | whole[row]
        ranges = _runs(row[hit], number[hit], len(rows))
        return _ranges_batch(heads, contents, counts, ranges)

    held: list[tuple] = []
    size = 0
    for b in batches:
        for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if held and size > 1 << 20 and r[0] != held[-1][0]:
                yield settle(held)
                held, size = [], 0
            held.append(r)
            size += len(r[4])
    if held:
        yield settle(held)


def _ranges_batch(heads, contents, counts, ranges: list[list[tuple[int, int]]]) -> pa.RecordBatch:
    lists = pa.array([[{"s": s, "e": e} for s, e in r] for r in ranges], pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())])))
    return pa.RecordBatch.from_arrays([pa.array(heads, pa.binary()), pa.array(contents, pa.int64()), pa.array(counts, pa.int64()), lists], ["head", "content", "n", "ranges"])


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, head, content, n, bytes) -> the same under a key for each extension of the head by ``REACH`` letters, right and left."""
    for b in batches:
        at, keys = [], []
        for k, (head, raw) in enumerate(zip(b.column(1).to_pylist(), b.column(4).to_pylist(), strict=True)):
            found, q = set(), raw.find(head)
            while q >= 0:
                if q + GRAM + REACH <= len(raw):
                    found.add(b"r" + raw[q : q + GRAM + REACH])
                if q >= REACH:
                    found.add(b"l" + raw[q - REACH : q + GRAM])
                q = raw.find(head, q + 1)
            keys += [hashlib.md5(x, usedforsecurity=False).digest() for x in sorted(found)]
            at += [k] * len(found)
        own = pa.array(at, pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), *(c.take(own) for c in b.columns[1:])], b.schema.names)


_OTHER = tk.byte_table(4711)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, head, content, n, bytes) -> (head, content, n, number, h, g) of every window; h and g are independent fingerprints."""
    for b in batches:
        for first in range(0, b.num_rows, 256):
            part = b.slice(first, 256)
            raw = part.column(4).to_pylist()
            data = np.frombuffer(b"".join(raw), np.uint8)
            at, row, number = _places(np.append(0, np.cumsum([len(x) for x in raw])))
            h, g = (tk.span_hash(tk.prefix_hash(table[data]), at, at + MATCH).view(np.int64) for table in (tk.BYTES, _OTHER))
            own = pa.array(row)
            yield pa.RecordBatch.from_arrays([*(c.take(own) for c in part.columns[1:4]), pa.array(number.astype(np.int32)), pa.array(h), pa.array(g)], ["head", "content", "n", "number", "h", "g"])


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(head, content, n, window numbers) -> (head, content, n, ranges)."""
    for b in batches:
        lists = [np.unique(x.values.to_numpy()) for x in b.column(3)]
        row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        yield _ranges_batch(b.column(0), b.column(1), b.column(2), _runs(row, np.concatenate(lists), len(lists)))


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, wanted segments) -> (head, content, n, bytes) of each segment with its windows' bytes."""
    names = ["head", "content", "n", "bytes"]
    kinds = [pa.binary(), pa.int64(), pa.int64(), pa.binary()]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    held: list[tuple] = []
    for b in batches:
        for text, wanted in zip(b.column(0), b.column(1), strict=True):
            raw = text.as_py().encode()
            for w in wanted.as_py():
                held.append((w["head"], w["content"], w["n"], raw[w["start"] : w["start"] + w["windows"] + MATCH - 1]))
            if len(held) >= 4096:
                yield batch(held)
                held = []
    if held:
        yield batch(held)


def _same_row(a: str, b: str):
    return (F.col(f"{a}.uid") == F.col(f"{b}.uid")) & F.col(f"{a}._id").eqNullSafe(F.col(f"{b}._id"))


def index_in_batches(every: DataFrame, batches: int) -> LevelFamily:
    """The family of the suffixes; a batch reads its own folders of a table that is partitioned by ``slot``."""
    family = LevelFamily()
    if "slot" not in every.columns:
        every = every.withColumn("slot", F.pmod(F.xxhash64("_id", "uid"), F.lit(SLOTS)))
    for k in range(batches):
        family.add(every.where(F.col("slot") % batches == k))
    return family


def repeated_ranges(docs: DataFrame, batches: int | None = None, id_col: str = "doc_id", text: str = "text", hot_bytes: int = HOT_BYTES) -> DataFrame:
    """(_id, uid, ranges): the byte ranges of each row that repeat elsewhere, for rows that have any.

    ``batches``: how many batches the family is built from; by default a number that grows
    with the suffixes up to ``SLOTS`` and leaves at least two levels standing (3, 7, ... 63); then batches grow.
    """
    # a task writes to one slot, so there are as many files as tasks
    every = written(suffixes(docs, id_col, text).withColumn("slot", F.spark_partition_id() % SLOTS), "suffixes", partition_by="slot")
    total = every.count()
    if batches is None:
        batches = min(SLOTS, max(3, (1 << (total // BATCH_SUFFIXES).bit_length()) - 1))
    family = index_in_batches(every, batches)
    shared = written(family.shared(), "shared-heads")
    family.drop()
    met = written(join_heavy(every, shared, "head", "n", total), "shared-suffixes")
    discard(every, shared)

    # one segment for each distinct content of the heads that need a comparison
    distinct = met.where("NOT same").groupBy("head", "content").agg(F.count("*").alias("n"), F.first(F.struct("_id", "uid", "start", "windows")).alias("r"))
    distinct = written(distinct.select("head", "content", "n", "r.*"), "contents")
    wanted = distinct.groupBy("_id", "uid").agg(F.collect_list(F.struct("head", "content", "n", "start", "windows")).alias("wanted"))
    # equal rows give equal segments, whose n tells that there are several
    texts = _rows(docs, id_col, text).alias("t").join(wanted.alias("w"), _same_row("t", "w")).select("t.text", "w.wanted")
    contexts = written(texts.mapInArrow(_contexts, _CONTEXT), "contexts")
    found, tables = [], [contexts, distinct]
    left = contexts.select(F.col("head").alias("key"), "head", "content", "n", "bytes")
    for deeper in (True, False):
        hot = written(left.groupBy("key").agg(F.sum(F.length("bytes")).alias("size")).where(F.col("size") > hot_bytes).select("key"), "hot-heads")
        tables.append(hot)
        some_hot = not hot.isEmpty()
        mild = left.join(hot, "key", "left_anti") if some_hot else left
        found.append(written(mild.repartitionByRange("key").sortWithinPartitions("key").mapInArrow(_compare, _FOUND), "content-ranges"))
        if not some_hot:
            break
        many = left.join(hot, "key", "left_semi").select(left.columns)
        if deeper:
            left = written(many.mapInArrow(_split, f"key binary, {_CONTEXT}"), "split-contexts")
            tables.append(left)
        else:
            windows = written(many.dropDuplicates(["head", "content"]).mapInArrow(_windows, "head binary, content long, n long, number int, h long, g long"), "hot-windows")
            twice = written(windows.groupBy("h", "g").agg(F.count("*").alias("c")).where("c > 1"), "repeated-windows")
            met_twice = join_heavy(windows.where("n = 1"), twice, ["h", "g"], "c", windows.count())
            hits = windows.where("n > 1").drop("h", "g").unionByName(met_twice.drop("h", "g"))
            found.append(written(hits.groupBy("head", "content", "n").agg(F.collect_list("number").alias("numbers")).mapInArrow(_joined, _FOUND), "content-ranges"))
            tables += [windows, twice]
    every_range = reduce(DataFrame.union, found).where(F.size("ranges") > 0)
    ranges = written(every_range.groupBy("head", "content").agg(F.max("n").alias("n"), F.flatten(F.collect_list("ranges")).alias("ranges")), "ranges")
    discard(*tables, *found)

    whole = met.where("same").select("_id", "uid", F.struct(F.col("start").alias("s"), (F.col("start") + F.col("windows") + MATCH - 1).alias("e")).alias("r"))
    parts = join_heavy(met.where("NOT same").select("_id", "uid", "start", "head", "content"), ranges, ["head", "content"], "n", total)
    moved = parts.select("_id", "uid", "start", F.explode("ranges").alias("q")).select("_id", "uid", F.struct((F.col("start") + F.col("q.s")).alias("s"), (F.col("start") + F.col("q.e")).alias("e")).alias("r"))
    out = written(whole.union(moved).groupBy("_id", "uid").agg(F.collect_list("r").alias("ranges")), "row-ranges")
    discard(met, ranges)
    return out


def remove_repeats(docs: DataFrame, batches: int | None = None, id_col: str = "doc_id", text: str = "text", with_bytes: bool = True) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256[, kept]): each row without its repeated bytes."""
    ranges = repeated_ranges(docs, batches, id_col, text)
    joined = _rows(docs, id_col, text).alias("t").join(ranges.alias("r"), _same_row("t", "r"), "left").select("t._id", "t.text", "r.ranges")
    kind = joined.schema[0].dataType.simpleString()

    def run(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches_:
            lists = b.column(2)
            spans = lists.flatten()
            lo, hi = spans.field(0).to_numpy(zero_copy_only=False), spans.field(1).to_numpy(zero_copy_only=False)
            sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes)
            for first, data, offsets in tk.chunks(b.column(1)):
                n = len(offsets) - 1
                mark = np.zeros(len(data) + 1, np.int32)
                a, z = int(ends[first - 1]) if first else 0, int(ends[first + n - 1])
                base = np.repeat(offsets[:-1], sizes[first : first + n])
                np.add.at(mark, base + lo[a:z], 1)
                np.add.at(mark, base + hi[a:z], -1)
                gone = np.cumsum(mark[:-1]) > 0
                before = np.append(0, np.cumsum(gone))
                opens = gone.copy()
                opens[1:] &= ~gone[:-1]
                inner = offsets[:-1][offsets[:-1] < len(data)]
                opens[inner] = gone[inner]
                runs = np.append(0, np.cumsum(opens))
                kept = [data[p:q][~gone[p:q]].tobytes() if before[q] > before[p] else data[p:q].tobytes() for p, q in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
                columns = [b.column(0).slice(first, n), pa.array(np.diff(offsets)), pa.array(np.diff(before[offsets])), pa.array(np.diff(runs[offsets])), pa.array([hashlib.sha256(k).hexdigest() for k in kept])]
                if with_bytes:
                    columns.append(pa.array(kept, pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, [id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][: len(columns)])

    return joined.mapInArrow(run, f"`{id_col}` {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_bytes)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_repeats(docs, with_bytes=False)
