"""Phrase collocation mining (operator 13): SETM, the set-oriented relational miner.

Level k has a relation R_k of the occurrences of frequent k-word phrases, sorted by piece and
position, and a table G_k of those phrases with their counts (Houtsma and Swami, 1995):

* R_1 is written from the texts.  A row holds a block: some texts of one language, their
  distinct words, and one 32-bit number for each position in piece order, -1 between pieces.
* G_k: Spark groups and sums the phrases, counted inside each block before they are moved,
  and keeps the frequent ones, each with a number of its own.
* R_k keeps the phrases of G_k, and is written with the infrequent positions as -1.  The words
  of each block (not every occurrence) are semi-joined with G_1.  From two words on nothing is
  joined: the places of a phrase in its blocks are sorted together and counted as one group,
  and those of a frequent group stay, as SETM does it.
* R_k merge-joined with itself on piece and adjacent position gives the candidates of level
  k + 1: blocks are sorted, so a position meets the next one by a single scan.  A longer
  phrase is the pair of numbers of its first and its last k words.

Nothing whole passes through one task: a block is bounded by ``BLOCK_BYTES`` (or one text),
grouping and joining are Spark's, a group has one row for each block, and G_1 is broadcast only
when its counted rows are at most ``BROADCAST_ROWS``; beyond it the same join is a shuffle join.

Defined results: null and empty texts have no words; a null language is ``und``; phrases never
cross pieces or texts; equal scores go by count and then by phrase; repeated rows count as
often as they stand there; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import textkernels as tk
from .common import discard, giving_back, ship_package, written

BLOCK_BYTES = 8 << 20
BROADCAST_ROWS = 1_000_000
SALTS = 16

_PIECE = np.zeros(256, bool)
_PIECE[[*map(ord, ".,;:!?"), *range(0x0A, 0x0E)]] = True
_GAP = _PIECE.copy()
_GAP[[0x20, 0x09]] = True
_OCCURRENCES = "block long, lang string, n_words long, words array<string>, counts array<long>, seq binary"
_LEVEL = "block long, lang string, seq binary, ids array<long>"
_CANDIDATES = "block long, place long, left long, right long, n long"


def _numbered(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, int]:
    """The distinct lower-cased words of texts, their counts, and the sequence of their numbers with -1 between pieces."""
    data, offsets = tk.text_buffer(texts)
    data = tk.LOWER[data]
    starts, ends, rows = tk.word_bounds(data, offsets, _GAP)
    n = len(starts)
    marks = np.zeros(len(data) + 1, np.int32)
    np.cumsum(_PIECE[data], out=marks[1:])
    cut = np.flatnonzero((rows[1:] != rows[:-1]) | (marks[starts[1:]] > marks[ends[:-1]])) + 1 if n else np.zeros(0, np.int64)
    word_offsets = np.zeros(n + 1, np.int64)
    np.cumsum(ends - starts, out=word_offsets[1:])
    words = pa.Array.from_buffers(pa.large_string(), n, [None, pa.py_buffer(word_offsets), pa.py_buffer(data[~_GAP[data]])]).dictionary_encode()
    numbers = words.indices.to_numpy()
    return words.dictionary.cast(pa.string()), np.bincount(numbers, minlength=len(words.dictionary)), np.insert(numbers.astype(np.int32), cut, -1), n


def _one(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """R_1: texts are gathered by language until a block is full."""
    held: dict[str, list[pa.Array]] = {}
    size: dict[str, int] = {}
    number = TaskContext.get().partitionId() << 32

    def flush(lang: str) -> pa.RecordBatch:
        nonlocal number
        words, counts, seq, n = _numbered(pa.concat_arrays(held.pop(lang)))
        size.pop(lang)
        number += 1
        columns = [pa.array([number]), pa.array([lang]), pa.array([n]), _one(words), _one(pa.array(counts, pa.int64())), pa.array([seq.astype("<i4").tobytes()], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["block", "lang", "n_words", "words", "counts", "seq"])

    for batch in batches:
        langs = batch.column("lang").dictionary_encode()
        of = langs.indices.to_numpy()
        for k, lang in enumerate(langs.dictionary.to_pylist()):
            texts = batch.column("text").take(pa.array(np.flatnonzero(of == k))).fill_null("")
            ends = tk.text_buffer(texts)[1][1:]
            at = 0
            while at < len(texts):
                before = int(ends[at - 1]) if at else 0
                to = max(at + 1, int(np.searchsorted(ends, before + BLOCK_BYTES - size.get(lang, 0), "right")))
                held.setdefault(lang, []).append(texts.slice(at, to - at))
                size[lang] = size.get(lang, 0) + int(ends[to - 1]) - before
                at = to
                if size[lang] >= BLOCK_BYTES or at < len(texts):
                    yield flush(lang)
        while sum(size.values()) > 2 * BLOCK_BYTES:  # many languages, each below a block
            yield flush(max(size, key=size.get))
    for lang in list(held):
        yield flush(lang)


def _pairs(seq: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The merge-join of a block with itself at adjacent positions: places, and the pair that stands there as one number."""
    at = np.flatnonzero((seq[:-1] >= 0) & (seq[1:] >= 0))
    left, right = seq[at].astype(np.int64), seq[at + 1].astype(np.int64)
    return at, left * k + right


def _candidates(batches: Iterator[pa.RecordBatch], rows: int = 1 << 17) -> Iterator[pa.RecordBatch]:
    """Candidates of the next level: the distinct pairs of each block by their place in it, with their counts."""
    for batch in batches:
        for i in range(batch.num_rows):
            seq = np.frombuffer(batch.column("seq")[i].as_buffer(), "<i4")
            ids = batch.column("ids")[i].values.to_numpy(zero_copy_only=False)
            u, n = np.unique(_pairs(seq, len(ids))[1], return_counts=True)
            for at in range(0, len(u), rows):
                code = u[at : at + rows]
                columns = [np.full(len(code), batch.column("block")[i].as_py()), np.arange(at, at + len(code)), ids[code // len(ids)], ids[code % len(ids)], n[at : at + rows]]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["block", "place", "left", "right", "n"])


def _recoded(pairs: bool):
    """R_k after the semi-join: the sequence numbers frequent phrases only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                seq = np.frombuffer(batch.column("seq")[i].as_buffer(), "<i4")
                kept = batch.column("kept")[i].values
                place = kept.field("place").to_numpy()
                if pairs:
                    at, code = _pairs(seq, len(batch.column("ids")[i]))
                    u, inverse = np.unique(code, return_inverse=True)
                    seq = np.full(len(seq), -1, np.int32)
                    seq[at] = inverse
                    size = len(u)
                else:
                    size = int(seq.max(initial=-1)) + 1
                new = np.full(size + 1, -1, np.int32)  # the last entry is for -1
                new[place] = np.arange(len(place))
                columns = [batch.column("block").slice(i, 1), batch.column("lang").slice(i, 1), pa.array([new[seq].astype("<i4").tobytes()], pa.binary()), _one(kept.field("id").cast(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, ["block", "lang", "seq", "ids"])

    return run


def _stored(df: DataFrame, label: str) -> DataFrame:
    return written(df, label, compression="zstd")


def _frequent(rows: DataFrame, keys: list[str], least: int, label: str) -> DataFrame:
    """G_k: (keys, f, id) of the phrases with at least ``least`` occurrences."""
    g = rows.groupBy(*keys).agg(F.sum("n").alias("f")).where(F.col("f") >= least)
    return written(g.withColumn("id", F.monotonically_increasing_id()), label)


def _frequent_places(rows: DataFrame, least: int, label: str) -> DataFrame:
    """G_k with its places in R_k: (block, place, left, right, f, id, first), the candidates of each block that are frequent.

    A phrase is named by the least number of its rows, and ``first`` marks that row.
    """
    phrase = Window.partitionBy("left", "right")
    counted = rows.withColumn("_row", F.monotonically_increasing_id()).withColumns({"f": F.sum("n").over(phrase), "id": F.min("_row").over(phrase)})
    return _stored(counted.where(F.col("f") >= least).select("block", "place", "left", "right", "f", "id", (F.col("_row") == F.col("id")).alias("first")), label)


def _semi_join(members: DataFrame, groups: DataFrame, keys: list[str], broadcast_rows: int) -> DataFrame:
    """(block, place, id) of the members that are in G_k."""
    g = groups.select(*keys, "id")
    if g.count() <= broadcast_rows:
        g = F.broadcast(g)
    return members.join(g, keys)


def _with_kept(level: DataFrame, places: DataFrame) -> DataFrame:
    """Each block of a level with ``kept``: the places of its frequent phrases and their ids."""
    return level.join(places.groupBy("block").agg(F.collect_list(F.struct("place", "id")).alias("kept")), "block")


def frequent_phrases(docs: DataFrame, max_words: int = 3, least: int = 10, text: str = "text", lang: str = "lang", broadcast_rows: int = BROADCAST_ROWS) -> tuple[list[DataFrame], DataFrame]:
    """([G_1 ... G_max], n): the frequent phrases by length with the counts of their parts, and the words of each language.

    G_k has (lang, id, phrase, last, f, pre, suf, left, right): ``pre[j]`` and ``suf[j]`` count the
    first and the last j + 1 words of the phrase, ``left`` and ``right`` name its first and last
    k - 1 words in G_(k-1).
    """
    ship_package(docs.sparkSession)
    source = docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"), F.col(f"`{text}`").alias("text"))
    level = _stored(source.mapInArrow(giving_back(_blocks), _OCCURRENCES), "occurrences-1")
    n = written(level.groupBy("lang").agg(F.sum("n_words").alias("n")), "words")
    words = level.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("_w")).select("lang", F.col("_w.words").alias("phrase"), F.col("_w.counts").alias("n"))
    g = _frequent(words, ["lang", "phrase"], least, "groups-1")
    found = [g.select("lang", "id", "phrase", F.col("phrase").alias("last"), "f", F.array("f").alias("pre"), F.array("f").alias("suf"), F.lit(None).cast("long").alias("left"), F.lit(None).cast("long").alias("right"))]
    members = level.select("block", "lang", F.posexplode("words").alias("place", "phrase"))
    joined = _with_kept(level.select("block", "lang", "seq"), _semi_join(members, g, ["lang", "phrase"], broadcast_rows))
    spent = [level]
    for k in range(2, max_words + 1):
        level = _stored(joined.mapInArrow(giving_back(_recoded(pairs=k > 2)), _LEVEL), f"occurrences-{k - 1}")
        discard(*spent)
        spent = [level]
        rows = level.mapInArrow(giving_back(_candidates), _CANDIDATES)
        if k < max_words:
            places = _frequent_places(rows, least, f"places-{k}")
            spent.append(places)
            joined = _with_kept(level, places)
            g = places.where("first").select("left", "right", "f", "id")
        else:
            g = _frequent(rows, ["left", "right"], least, f"groups-{k}")
        one = found[-1].select("lang", F.col("id").alias("left"), F.col("phrase").alias("_head"), F.col("pre").alias("_pre"))
        two = found[-1].select(F.col("id").alias("right"), "last", F.col("suf").alias("_suf"))
        whole = g.join(one, "left").join(two, "right")
        found.append(written(whole.select("lang", "id", F.concat_ws(" ", "_head", "last").alias("phrase"), "last", "f", F.concat("_pre", F.array("f")).alias("pre"), F.concat("_suf", F.array("f")).alias("suf"), "left", "right"), f"phrases-{k}"))
    discard(*spent)
    return found, n


#: The cut with the least score, ties to the shortest first part; decimals of 38 digits hold all products.
_CUT = """array_min(transform(sequence(1, size(pre) - 1), j -> named_struct(
  'score', (cast(f AS decimal(19,0)) * cast(f AS decimal(19,0)) * 1000000) div (cast(pre[j - 1] AS decimal(19,0)) * cast(suf[size(suf) - j - 1] AS decimal(19,0))),
  'k', j, 'l', pre[j - 1], 'r', suf[size(suf) - j - 1])))"""


def collocations(docs: DataFrame, max_words: int = 3, least: int = 10, share: int = 50, top: int = 2000, **how) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of each language by score.

    A phrase is left out if a longer one that holds it has at least ``share`` percent of its count.
    """
    found, n = frequent_phrases(docs, max_words, least, **how)
    parts = []
    for k in range(2, max_words + 1):
        g = found[k - 1].select("lang", "id", "phrase", "f", F.expr(_CUT).alias("_c"))
        if k < max_words:  # longer ones than the next length are held by one of it with no smaller count
            longer = found[k].select(F.explode(F.array("left", "right")).alias("id"), "f").groupBy("id").agg(F.max("f").alias("_longer"))
            g = g.join(longer, "id", "left").where(F.col("_longer").isNull() | (100 * F.col("_longer") < share * F.col("f")))
        parts.append(g.select("lang", "phrase", "f", "_c"))
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    every = every.select("lang", "phrase", F.col("f").alias("a"), F.col("_c.l").alias("l"), F.col("_c.r").alias("r"), F.col("_c.score").alias("score"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    first = every.withColumn("_salt", salt).withColumn("_r", F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*order))).where(F.col("_r") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(F.broadcast(n), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet").select("text", "lang"))


OP13_SQL = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
s AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS s FROM d),
p AS (SELECT lang, list_filter(string_split_regex(s, '[\x20\x09]+'), lambda x: x <> '') AS w FROM s),
f1 AS (SELECT lang, w, count(*) AS f FROM (SELECT lang, unnest(w) AS w FROM p) GROUP BY ALL),
nn AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f1 GROUP BY lang),
f2 AS (SELECT lang, w[i] AS x, w[i + 1] AS y, count(*) AS f FROM (SELECT lang, w, unnest(range(1, len(w))) AS i FROM p WHERE len(w) > 1) GROUP BY ALL HAVING count(*) >= 10),
f3 AS (SELECT lang, w[i] AS x, w[i + 1] AS y, w[i + 2] AS z, count(*) AS f FROM (SELECT lang, w, unnest(range(1, len(w) - 1)) AS i FROM p WHERE len(w) > 2) GROUP BY ALL HAVING count(*) >= 10),
c2 AS (SELECT f2.lang, x || ' ' || y AS phrase, f2.f AS a, u.f AS l, v.f AS r, 1 AS k FROM f2 JOIN f1 u ON u.lang = f2.lang AND u.w = x JOIN f1 v ON v.lang = f2.lang AND v.w = y
  WHERE NOT EXISTS (SELECT 1 FROM f3 WHERE f3.lang = f2.lang AND f3.x = f2.x AND f3.y = f2.y AND 100 * f3.f >= 50 * f2.f) AND NOT EXISTS (SELECT 1 FROM f3 WHERE f3.lang = f2.lang AND f3.y = f2.x AND f3.z = f2.y AND 100 * f3.f >= 50 * f2.f)),
c3 AS (SELECT f3.lang, f3.x || ' ' || f3.y || ' ' || f3.z AS phrase, f3.f AS a, u.f AS l, v.f AS r, 1 AS k FROM f3 JOIN f1 u ON u.lang = f3.lang AND u.w = f3.x JOIN f2 v ON v.lang = f3.lang AND v.x = f3.y AND v.y = f3.z
  UNION ALL SELECT f3.lang, f3.x || ' ' || f3.y || ' ' || f3.z, f3.f, u.f, v.f, 2 FROM f3 JOIN f2 u ON u.lang = f3.lang AND u.x = f3.x AND u.y = f3.y JOIN f1 v ON v.lang = f3.lang AND v.w = f3.z),
c AS (SELECT *, (1000000::HUGEINT * a * a) // (l::HUGEINT * r) AS score FROM (SELECT * FROM c2 UNION ALL SELECT * FROM c3)),
b AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
q AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM b)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM q JOIN nn USING (lang) WHERE rank <= 2000
"""
