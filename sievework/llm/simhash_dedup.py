"""SimHash near-duplicates (operator 4) through a Gray-order hierarchical index.

Fingerprints are folded to distinct values with one representative.  The index is a
hierarchy of nodes, each standing for a masked bit pattern that its fingerprints share:

* Upper nodes fix one block of bits.  Two fingerprints within ``radius`` bits agree on
  at least one of ``radius + 1`` blocks, so every link lies below some upper node with no
  difference there, and nodes with other patterns are never compared.  A link goes to the first block
  it agrees on: those before it have taken a difference each, and what is left of the radius
  bounds the bits after it.  The nodes are shuffle keys.  A node with too many fingerprints is
  split by what its bits may still differ in (a child of the i-th block has radius - i + 1 children
  and not radius + 1), again and again, which deals hot groups over many tasks.
* Below an upper node, the task sorts the fingerprints by Gray rank and factors runs of
  them into group nodes (mask of the bits all share, pattern under the mask).  Two groups
  whose patterns differ on more than ``radius`` commonly masked bits are pruned whole.

Groups emit links to one representative of each local component, never all pairs; the
components are then joined across nodes.  No link is lost and none is invented.

Defined results: a null or empty text has fingerprint 0 and links like any other; a null
doc_id is never a component's name unless the component has only null ids (then null);
repeated rows keep a row each; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textkernels as tk
from .common import discard, giving_back, join_heavy, ship_package, written
from .components import connected_components

RADIUS = 4
NODE_LIMIT = 4096  # fingerprints below an upper node before it is split
GROUP = 64  # fingerprints in a group node
COMMON = 4  # documents of the sample that hold a shingle before it is sorted last
COMMON_LIMIT = 200_000  # shingles known to be common
SLICE = 256  # rows whose shingles are held at once
BLOCK = 500_000  # shingles in a block of a candidate group; a task holds two
UNPACKED = 1 << 18  # shingles whose bits are unpacked at once


# ---- fingerprints ------------------------------------------------------------------


def _shingle_spans(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The lower-cased bytes with single spaces between words, and (start, end, row) of each shingle."""
    data = tk.LOWER[data]
    starts, ends, rows = tk.word_bounds(data, offsets, tk.IS_SPACE)
    n = len(offsets) - 1
    if not len(starts):
        none = np.zeros(0, np.int64)
        return data, none, none, none
    # keep word bytes and the gap byte right before each word but the first of a row
    keep = ~tk.IS_SPACE[data]
    inner = starts[1:][rows[1:] == rows[:-1]]
    keep[inner - 1] = True
    data = np.where(tk.IS_SPACE[data], np.uint8(32), data)[keep]
    place = np.zeros(len(keep) + 1, np.int64)
    np.cumsum(keep, out=place[1:])
    starts, ends = place[starts], place[ends]
    counts = tk.row_counts(rows, n)
    first = np.cumsum(counts) - counts
    full = np.flatnonzero(rows[: len(rows) - size + 1] == rows[size - 1 :]) if len(rows) >= size else np.zeros(0, np.int64)
    short = np.flatnonzero((counts > 0) & (counts < size))
    s = np.concatenate([starts[full], starts[first[short]]])
    e = np.concatenate([ends[full + size - 1], ends[first[short] + counts[short] - 1]])
    r = np.concatenate([rows[full], short])
    order = np.argsort(r, kind="stable")
    return data, s[order], e[order], r[order]


def _majority(h: np.ndarray, r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, SimHash) of the rows that have hashes; ``r``, the row of each hash, is in order."""
    first = np.flatnonzero(np.concatenate([[True], r[1:] != r[:-1]]))
    ends = np.append(first[1:], len(r))
    ones = np.zeros((len(first), 64), np.int64)
    lo = 0
    while lo < len(first):  # bounds the unpacked bits
        a = first[lo]
        hi = max(lo + 1, int(np.searchsorted(ends, a + UNPACKED, "right")))
        bits = np.unpackbits(h[a : ends[hi - 1]].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones[lo:hi] = np.add.reduceat(bits, first[lo:hi] - a, axis=0, dtype=np.int32)
        lo = hi
    major = np.packbits(2 * ones > (ends - first)[:, None], axis=1, bitorder="little")
    return r[first], np.ascontiguousarray(major).view("<u8").ravel()


def fingerprints(column: pa.Array, size: int) -> np.ndarray:
    """64-bit SimHash of each row over word shingles, repeats included; no words: 0."""
    out = np.zeros(len(column), np.uint64)
    digest = xxhash.xxh64_intdigest
    for row, data, offsets in tk.chunks(column):
        data, s, e, r = _shingle_spans(data, offsets, size)
        if not len(s):
            continue
        raw = data.tobytes()
        h = np.array([digest(raw[a:b], 42) for a, b in zip(s.tolist(), e.tolist(), strict=True)], np.uint64)
        at, code = _majority(h, r)
        out[row + at] = code
    return out


def with_fingerprint(docs: DataFrame, columns: list[str], size: int, text: str = "text") -> DataFrame:
    """``columns`` and ``fp`` (the fingerprint as a signed long)."""
    ship_package(docs.sparkSession)
    n = len(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = fingerprints(b.column(n), size).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns[:n], pa.array(fp)], [*columns, "fp"])

    wanted = docs.select(*[F.col(f"`{c}`") for c in columns], F.col(text).alias("_text"))
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in wanted.schema[:n]], "fp long"])
    return wanted.mapInArrow(giving_back(run), schema)


# ---- the hierarchical index --------------------------------------------------------


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The place of each code in the reflected Gray sequence."""
    r = codes.copy()
    for k in (1, 2, 4, 8, 16, 32):
        r ^= r >> np.uint64(k)
    return r


def _block_widths(width: int, blocks: int) -> list[int]:
    return [width // blocks + (i < width % blocks) for i in range(blocks)]


def local_roots(codes: np.ndarray, radius: int) -> np.ndarray:
    """For fingerprints below one node: the index of each one's component representative."""
    order = np.argsort(gray_rank(codes), kind="stable")
    c = codes[order]
    n = len(c)
    label = np.arange(n)
    edges = np.arange(0, n, GROUP)
    # a group's mask has the bits on which all of its members agree
    every, some = np.bitwise_and.reduceat(c, edges), np.bitwise_or.reduceat(c, edges)
    mask, pattern = ~(every ^ some), every
    for g, lo in enumerate(edges):
        hi = min(lo + GROUP, n)
        apart = np.bitwise_count((pattern[g] ^ pattern[g:]) & mask[g] & mask[g:])
        near = g + np.flatnonzero(apart <= radius)
        cand = (near[:, None] * GROUP + np.arange(GROUP)).ravel()
        cand = cand[cand < n]
        close = np.bitwise_count(c[lo:hi, None] ^ c[cand][None, :]) <= radius
        if np.count_nonzero(close) == hi - lo:
            continue  # each only meets itself
        for i in range(hi - lo):
            met = np.unique(label[cand[close[i]]])
            if len(met) > 1:
                label[np.isin(label, met)] = met[0]
    out = np.empty(n, np.int64)
    out[order] = order[label]
    return out


def _node_links(radius: int):
    """Arrow batches of (path, fp) with each path's rows together -> (a, b) links to representatives."""

    def emit(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        root = codes[local_roots(codes, radius)]
        moved = root != codes
        return codes[moved], root[moved]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, held = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            codes = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
            a, b = [], []
            for k, part in zip(keys[np.append(0, cuts)], np.split(codes, cuts), strict=True):
                if k != path:
                    whole = np.concatenate(held) if held else np.zeros(0, np.uint64)
                    if len(whole) > 1:
                        x, y = emit(whole)
                        a.append(x)
                        b.append(y)
                    path, held = k, []
                held.append(part)
            if a:
                yield _pairs(np.concatenate(a), np.concatenate(b))
        whole = np.concatenate(held) if held else np.zeros(0, np.uint64)
        if len(whole) > 1:
            yield _pairs(*emit(whole))

    return run


def _pairs(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])


Segment = tuple[int, int, int]  # lowest bit, width, differences that may still fall into it


def _splits(segments: tuple[Segment, ...]) -> list[tuple[int, int, tuple[Segment, ...]]]:
    """(lowest bit, width, segments left) of the block that each child of a node fixes.

    The first segment has ``r`` differences at most, so of its ``r + 1`` blocks one has none.
    Child j is where block j is the first without: the j blocks before it have taken a
    difference each, which leaves ``r - j`` for the bits after it and ``r - j + 1`` for each of them.
    A segment with more bits than differences can be split again.
    """
    (off, width, r), *rest = segments
    at, before, out = off + width, [], []
    for j, w in enumerate(_block_widths(width, r + 1)):
        at -= w
        left = [(off, at - off, r - j), *((o, n, r - j + 1) for o, n in before), *rest]
        out.append((at, w, tuple(s for s in left if s[1] > s[2])))
        before.append((at, w))
    return out


def _below(nodes: DataFrame, kinds: list[tuple[Segment, ...]]) -> tuple[DataFrame, list[tuple[Segment, ...]]]:
    """Each fingerprint below the child nodes of its node: (path, kind, fp), and the segments by kind.

    A child's path is its parent's followed by the block's number and its bits.
    """
    made: list[tuple[Segment, ...]] = []
    children = None
    for k, segments in enumerate(kinds):
        own = []
        for j, (at, w, left) in enumerate(_splits(segments)):
            key = F.shiftrightunsigned("fp", at).bitwiseAND(F.lit((1 << w) - 1))
            own.append(F.struct(F.concat_ws(".", "path", F.lit(str(j)), key.cast("string")).alias("path"), F.lit(len(made)).alias("kind")))
            made.append(left)
        mine = F.col("kind") == k
        children = F.when(mine, F.array(*own)) if children is None else children.when(mine, F.array(*own))
    return nodes.select("fp", F.explode(children).alias("n")).select("n.path", "n.kind", "fp"), made


def hamming_links(codes: DataFrame, radius: int = RADIUS, node_limit: int = NODE_LIMIT) -> DataFrame:
    """``codes`` (fp long, distinct) -> links (a, b) whose components are those of all pairs within ``radius`` bits."""
    ship_package(codes.sparkSession)
    nodes, kinds, links = codes.select(F.lit("").alias("path"), F.lit(0).alias("kind"), "fp"), [((0, 64, radius),)], None
    while True:
        nodes, made = _below(nodes, kinds)
        # every split fixes bits, so splitting ends by itself
        ends = [k for k, left in enumerate(made) if not left]
        large = nodes.groupBy("path", "kind").count().where((F.col("count") > node_limit) & ~F.col("kind").isin(ends))
        hot = written(large.select("path", "kind"), "hot-nodes")
        open_ = sorted(r["kind"] for r in hot.select("kind").distinct().collect())  # of a few dozen kinds
        cold = nodes
        if open_:
            renamed = F.create_map(*[F.lit(x) for k in enumerate(open_) for x in reversed(k)])[F.col("kind")]
            paths = hot.select("path")
            cold, nodes = nodes.join(paths, "path", "left_anti"), written(nodes.join(paths, "path", "left_semi").withColumn("kind", renamed), "split-nodes")
            kinds = [made[k] for k in open_]
        sorted_ = cold.select("path", "fp").repartition("path").sortWithinPartitions("path")
        part = sorted_.mapInArrow(giving_back(_node_links(radius)), "a long, b long")
        links = part if links is None else links.union(part)
        if not open_:
            return links


def near_duplicates(docs: DataFrame, columns: list[str], size: int = 4, radius: int = RADIUS, text: str = "text") -> DataFrame:
    """``columns`` (the first is the id), ``fp`` and ``component`` (the smallest id reachable), a row per input row."""
    rows = written(with_fingerprint(docs, columns, size, text), "fingerprints")
    ident = F.col(f"`{columns[0]}`")
    distinct = written(rows.groupBy("fp").agg(F.min(ident).alias("_least"), F.count("*").alias("_n")), "codes")
    comps = written(connected_components(hamming_links(distinct.select("fp"), radius)), "components")
    named = comps.join(distinct, comps["node"] == distinct["fp"]).groupBy("root").agg(F.min("_least").alias("_name"), F.count("*").alias("_c"))
    moved = join_heavy(comps, written(named, "roots"), "root", "_c", comps.count()).select(F.col("node").alias("fp"), "_name")
    lookup = written(distinct.join(moved, "fp", "left").select("fp", "_n", F.coalesce("_name", "_least").alias("component")), "names")
    return join_heavy(rows, lookup, "fp", "_n", rows.count()).select(*[f"`{c}`" for c in columns], "fp", "component")


# ---- near copies of the pipeline: the index, an exact check, and the pairs beyond its radius ----


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of ``SLICE`` rows, so that not all shingles of a batch are held at once."""
    for b in batches:
        for lo in range(0, b.num_rows, SLICE):
            yield b.slice(lo, SLICE)


def shingle_sets(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct word shingles of each row, in order of both."""
    rows, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    digest = xxhash.xxh64_intdigest
    for row, data, offsets in tk.chunks(column):
        data, s, e, r = _shingle_spans(data, offsets, size)
        if not len(s):
            continue
        raw = data.tobytes()
        h = np.array([digest(raw[a:b], 42) for a, b in zip(s.tolist(), e.tolist(), strict=True)], np.uint64)
        order = np.lexsort((h, r))
        h, r = h[order], r[order]
        new = np.concatenate([[True], (h[1:] != h[:-1]) | (r[1:] != r[:-1])])
        rows.append(row + r[new])
        hashes.append(h[new])
    return np.concatenate(rows), np.concatenate(hashes)


def _common_shingles(texts: DataFrame, size: int) -> np.ndarray:
    """Hashes of shingles that many documents seem to hold, the rarer first; from one document in 16.

    They come last in the order of a prefix.  Any order finds every pair, so the sample and the limit only save work.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            yield pa.RecordBatch.from_arrays([pa.array(shingle_sets(b.column(0), size)[1].view(np.int64))], ["g"])

    some = texts.where(F.pmod("_h", F.lit(16)) == 0).select("_text").mapInArrow(giving_back(run), "g long")
    found = some.groupBy("g").count().where(F.col("count") >= COMMON).orderBy(F.desc("count"), "g").limit(COMMON_LIMIT)
    return np.ascontiguousarray(found.toArrow().column("g").to_numpy()[::-1]).view(np.uint64)


def _with_prefix(keyed: DataFrame, size: int, common: np.ndarray) -> DataFrame:
    """_id, _h, ``node`` (digest of the shingle set), ``fp`` (its SimHash), ``n`` (its size), ``prefix`` and ``common`` (how many of the prefix, its last ones, are common).

    Two sets with a similarity of 0.8 share at least 0.8 n shingles of either, so whatever
    the order, the first n // 5 + 1 of one and of the other have one in common.
    """
    by_hash = np.argsort(common)
    known = common[by_hash]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            r, h = shingle_sets(b.column(2), size)
            n = np.bincount(r, minlength=b.num_rows)
            ends = np.cumsum(n)
            raw = h.tobytes()
            node = np.array([xxhash.xxh64_intdigest(raw[8 * (e - k) : 8 * e], 7) if k else 0 for k, e in zip(n.tolist(), ends.tolist(), strict=True)], np.uint64)
            fp = np.zeros(b.num_rows, np.uint64)
            if len(h):
                at, code = _majority(h, r)
                fp[at] = code
            rank = np.zeros(len(h), np.int64)
            if len(known):
                at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                rank = np.where(known[at] == h, by_hash[at] + 1, 0)
            order = np.lexsort((h, rank, r))
            order = order[np.arange(len(h)) - (ends - n)[r] <= n[r] // 5]
            first, late = h[order], np.bincount(r[order], rank[order] > 0, minlength=b.num_rows).astype(np.int64)
            cuts = np.concatenate([[0], np.cumsum(np.where(n > 0, n // 5 + 1, 0))]).astype(np.int32)
            prefix = pa.ListArray.from_arrays(pa.array(cuts), pa.array(first.view(np.int64)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(node.view(np.int64)), pa.array(fp.view(np.int64)), pa.array(n.astype(np.int64)), prefix, pa.array(late)], ["_id", "_h", "node", "fp", "n", "prefix", "common"])

    return keyed.select("_id", "_h", "_text").mapInArrow(giving_back(run), f"_id {keyed.schema['_id'].dataType.simpleString()}, _h long, node long, fp long, n long, prefix array<long>, common long")


def _index_links(sets: DataFrame, radius: int) -> DataFrame:
    """(a, b): sets to the representative of their fingerprint, and those along the links of the Gray-order index."""
    codes = written(sets.groupBy("fp").agg(F.min("node").alias("b"), F.count("*").alias("_c")), "codes")
    own = join_heavy(sets.select("fp", F.col("node").alias("a")), codes, "fp", "_c", sets.count()).select("a", "b")
    one, two = (codes.select(F.col("fp").alias(c), F.col("b").alias("n" + c)) for c in "ab")
    near = hamming_links(codes.select("fp"), radius).distinct().join(one, "a").join(two, "b").select("na", "nb")
    return own.union(near).where("a <> b").distinct()


def _candidates(sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b), and chains (a, b) of sets to be compared among each other; with them and the links that gave ``root``, all components at 0.8.

    Sets of one ``root`` are joined already and do not meet again.  Sets with a similarity of
    0.8 differ in at most a ninth of their sizes' sum.  Pairs that meet in a shingle not
    known as common are counted, and go where their prefixes alone differ in more: up to the
    lesser of the prefixes' ends all of that prefix is seen, and the other up to its last shared place.
    Common shingles are only left in prefixes of sets that have little else; those are chained.
    """
    held = sets.select("node", "root", "n", "common", F.size("prefix").alias("p"), F.posexplode("prefix").alias("at", "g"))
    rare = held.where("at < p - common").select("g", "node", "root", "n", "common", "p", "at")
    one, two = (rare.select("g", *[F.col(c).alias(c + k) for c in rare.columns[1:]]) for k in "12")
    met = one.join(two, "g").where("node1 < node2 AND root1 <> root2 AND 5 * least(n1, n2) >= 4 * greatest(n1, n2)")
    same = [F.first(c + k).alias(c + k) for k in "12" for c in ("n", "common", "p")]
    met = met.groupBy("node1", "node2").agg(F.count("*").alias("both"), F.max("at1").alias("at1"), F.max("at2").alias("at2"), *same)
    met = met.where("9 * (least(p1 + at2 + 1, at1 + 1 + p2) - 2 * (both + least(common1, common2))) <= n1 + n2")
    # sizes whose ratio is 0.8 or more are in one class or in two that follow each other
    late = written(held.where("at >= p - common").select("g", F.floor(F.log("n") / F.log(F.lit(1.25))).alias("s"), "node"), "common-shingles")
    first = written(late.groupBy("g", "s").agg(F.min("node").alias("b"), F.count("*").alias("_c")), "first-of-class")
    own = join_heavy(late, first, ["g", "s"], "_c", late.count()).select(F.col("node").alias("a"), "b")
    following = first.select("g", (F.col("s") + 1).alias("s"), F.col("b").alias("a")).join(first, ["g", "s"]).select("a", "b")
    return met.select(F.col("node1").alias("a"), F.col("node2").alias("b")), own.union(following).where("a <> b").distinct()


def _same_document(a: str, b: str):
    return F.col(f"{a}._id").eqNullSafe(F.col(f"{b}._id")) & (F.col(f"{a}._h") == F.col(f"{b}._h"))


def _whole_sets(keyed: DataFrame, sets: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """(node, grams): all shingles of the given nodes."""
    wanted = sets.join(nodes, "node", "left_semi").select("node", "best._id", "best._h").alias("w")
    texts = keyed.alias("k").join(wanted, _same_document("k", "w")).select("w.node", "k._text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            r, h = shingle_sets(b.column(1), size)
            cuts = np.append(0, np.cumsum(np.bincount(r, minlength=b.num_rows))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(cuts), pa.array(h.view(np.int64)))], ["node", "grams"])

    # rows that repeat in full give a node twice
    return texts.mapInArrow(giving_back(run), "node long, grams array<long>").dropDuplicates(["node"])


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()


def _verified(pairs: DataFrame, whole: DataFrame) -> DataFrame:
    """The pairs whose sets have a similarity of 0.8, by intersection."""
    a, b = whole.toDF("a", "ga"), whole.toDF("b", "gb")
    both = pairs.join(a, "a").join(b, "b").select("a", "b", F.size("ga").alias("na"), F.size("gb").alias("nb"), F.size(F.array_intersect("ga", "gb")).alias("both"))
    return both.where("5 * both >= 4 * (na + nb - both)").select("a", "b")


def _pair_links(pairs: DataFrame, whole: DataFrame, found: DataFrame) -> DataFrame:
    """Links that with those ``found`` before have the components of all true pairs.

    First each node's first pair (in the order of a hash) is verified; pairs inside the
    components that this gives need no look, so a group of near copies costs as many
    comparisons as it has members and not as it has pairs.  All other pairs are verified next.
    """
    order = F.xxhash64("a", "b")
    firsts = [pairs.groupBy(k).agg(F.min_by(F.struct("a", "b"), order).alias("p")).select("p.a", "p.b") for k in "ab"]
    chosen = written(firsts[0].union(firsts[1]).distinct(), "first-pairs")
    sure = written(_verified(chosen, whole), "links")
    label = written(connected_components(sure.union(found)), "labels")
    la, lb = label.toDF("a", "ra"), label.toDF("b", "rb")
    open_ = pairs.join(la, "a", "left").join(lb, "b", "left").where("coalesce(ra, a) <> coalesce(rb, b)").select("a", "b")
    rest = written(_verified(written(open_.join(chosen, ["a", "b"], "left_anti"), "open-pairs"), whole), "links")
    return sure.union(rest)


def similar_roots(owner: np.ndarray, hashes: np.ndarray, m: int) -> np.ndarray:
    """For ``m`` sets given as (owner, hash) in order of owner: a representative of each one's component at 0.8.

    A search from a set looks only at those that no component has yet, so groups of near copies do not compare all pairs.
    """
    n = np.bincount(owner, minlength=m)
    ends = np.cumsum(n)
    ids = np.unique(hashes, return_inverse=True)[1]
    alive, root = np.ones(m, bool), np.arange(m)
    left, indexed, place, post = m, None, None, None
    for s in range(m):
        if not alive[s]:
            continue
        alive[s], left, todo = False, left - 1, [s]
        while todo and left:
            if indexed is None or 2 * left < indexed:
                kept = np.flatnonzero(alive[owner])
                kept = kept[np.argsort(ids[kept], kind="stable")]
                post, indexed = owner[kept], left
                place = np.searchsorted(ids[kept], np.arange(ids.max(initial=0) + 2))
            i = todo.pop()
            mine = ids[ends[i] - n[i] : ends[i]]
            count = place[mine + 1] - place[mine]
            at = np.repeat(place[mine] - np.cumsum(count) + count, count) + np.arange(count.sum())
            both = np.bincount(post[at], minlength=m)
            hit = np.flatnonzero(alive & (5 * both >= 4 * (n[i] + n - both)))
            alive[hit], root[hit] = False, s
            left -= len(hit)
            todo.extend(hit.tolist())
    return root


def _similar_links(size: int):
    """Arrow batches of (part, node, text) with each part's rows together -> (a, b) links to representatives."""

    def emit(held: list) -> pa.RecordBatch:
        nodes = np.concatenate([x[0] for x in held])
        base = np.cumsum([0, *[len(x[0]) for x in held]])
        owner = np.concatenate([x[1] + at for x, at in zip(held, base, strict=False)])
        root = similar_roots(owner, np.concatenate([x[2] for x in held]), len(nodes))
        moved = nodes != nodes[root]
        return _pairs(nodes[moved], nodes[root][moved])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = None, []
        for b in _slices(batches):
            keys = b.column(0).to_numpy(zero_copy_only=False)
            nodes = b.column(1).to_numpy(zero_copy_only=False)
            r, h = shingle_sets(b.column(2), size)
            cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                if keys[lo] != part:
                    if held:
                        yield emit(held)
                    part, held = keys[lo], []
                x, y = np.searchsorted(r, [lo, hi])
                held.append((nodes[lo:hi], r[x:y] - lo, h[x:y]))
        if held:
            yield emit(held)

    return run


def _group_links(keyed: DataFrame, sets: DataFrame, chains: DataFrame, size: int, block: int) -> DataFrame:
    """Links of sets inside chained groups, compared exactly in parts of two blocks of about ``block`` shingles."""
    groups = written(connected_components(chains).join(sets.select("node", "best", "n"), "node"), "groups")
    blocks = written(groups.groupBy("root").agg(F.ceil(F.sum("n") / F.lit(block)).cast("int").alias("k"), F.count("*").alias("_c")), "group-sizes")
    mine = F.pmod(F.xxhash64("node"), F.col("k")).cast("int")
    others = F.filter(F.sequence(F.lit(0), F.col("k") - 1), lambda j: j != F.col("mine"))
    parts = F.when(F.col("k") == 1, F.array(F.lit("0.0"))).otherwise(F.transform(others, lambda j: F.concat_ws(".", F.least(j, "mine"), F.greatest(j, "mine"))))
    dealt = join_heavy(groups, blocks, "root", "_c", groups.count()).withColumn("mine", mine)
    dealt = written(dealt.select("root", "node", "best._id", "best._h", parts.alias("parts")), "parts")
    texts = keyed.alias("k").join(dealt.alias("d"), _same_document("k", "d")).select(F.explode("d.parts").alias("part"), "d.root", "d.node", "k._text")
    texts = texts.select(F.concat_ws(".", "root", "part").alias("part"), "node", "_text")
    return texts.repartition("part").sortWithinPartitions("part").mapInArrow(giving_back(_similar_links(size)), "a long, b long")


def keep_one(docs: DataFrame, size: int = 5, id_col: str = "doc_id", text: str = "text", block: int = BLOCK, radius: int = RADIUS) -> DataFrame:
    """The input without near copies: of each group the row with the least id stays (a null id only if no other).

    Groups are the components of all pairs whose sets of ``size``-word shingles have a Jaccard
    similarity of 0.8 or more.  SimHash fingerprints of the sets go through the Gray-order
    index, and its links within ``radius`` bits are verified by intersection.  Pairs of 0.8 that no
    such radius is sure to reach are completed exactly between the components found so far: candidates from
    prefixes of the sets, verified alike; sets that hold little but very common shingles are
    compared group by group, in parts of two blocks of about ``block`` shingles.  Of equal rows one stays.

    Defined results: texts without words are equal to each other; case of A-Z and white space do
    not matter; an empty table gives an empty result; columns are the input's whatever their names.
    """
    ship_package(docs.sparkSession)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    keyed = docs.select(row, F.col(f"`{id_col}`").alias("_id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("_h"), F.col(text).alias("_text"))
    first = F.min(F.struct(F.col("_id").isNull().alias("n"), F.col("_id").alias("_id"), F.col("_h").alias("_h")))
    rows = _with_prefix(keyed, size, _common_shingles(keyed.select("_h", "_text"), size))
    values = [F.first(c).alias(c) for c in ("fp", "n", "prefix", "common")]
    distinct = written(rows.groupBy("node").agg(first.alias("best"), *values), "distinct-sets")

    near = written(_index_links(distinct, radius), "index-links")
    whole = written(_whole_sets(keyed, distinct, _ends(near), size), "whole-sets")
    found = written(_verified(near, whole), "near-links")
    label = written(connected_components(found), "near-labels")
    sets = written(distinct.join(label, "node", "left").withColumn("root", F.coalesce("root", "node")), "sets")
    discard(distinct, near, whole, label)

    pairs, chains = (written(x, "candidates") for x in _candidates(sets))
    whole = written(_whole_sets(keyed, sets, _ends(pairs), size), "whole-sets")
    links = found.union(_pair_links(pairs, whole, found))
    if not chains.isEmpty():
        links = links.union(_group_links(keyed, sets, chains, size, block))
    comps = written(connected_components(links), "components")

    grouped = sets.select("node", "best").join(comps, "node", "left").groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("best").alias("best"))
    chosen = written(grouped.select(F.col("best._id").alias("_cid"), F.col("best._h").alias("_ch")), "chosen")
    discard(sets, pairs, chains, whole, comps)
    met = keyed.drop("_text").join(chosen, F.col("_id").eqNullSafe(F.col("_cid")) & (F.col("_h") == F.col("_ch")))
    return met.dropDuplicates(["_cid", "_ch"]).select("_row.*")


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = near_duplicates(docs, ["doc_id"])
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("component").alias("component_id"))
