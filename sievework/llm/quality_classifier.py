"""Quality classifier (operator 5): hashed word n-gram logistic regression, trained by FTRL, scored as sparse dot products.

Features are hashed uni- and bigrams of the words as written, of their shapes (letters,
capitals, digits and symbols with runs folded, so that unseen words still tell), and of
the words' repeat classes (whether a trigram recurs in its text).  Values are dampened
counts over the vector's length.  Labels, language, source and id are never inputs.

Defined results: null and empty texts are scored by the bias alone; without any labelled
row every score is 0.5; ids that recur are scored row by row; a label that is null is no label.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import linear as li
from . import textkernels as tk

THRESHOLD = 0.3

#: A byte's class in word shapes: a letter, a capital, a digit, or itself.
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[[*range(97, 123), *range(128, 256)]] = ord("a")
_SHAPE[65:91] = ord("A")
_SHAPE[48:58] = ord("0")


def shapes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each word's classes with runs folded."""
    kind = _SHAPE[data]
    keep = np.ones(len(kind), bool)
    keep[1:] = kind[1:] != kind[:-1]
    keep[starts] = True
    place = np.zeros(len(kind) + 1, np.int64)
    np.cumsum(keep, out=place[1:])
    return tk.word_hashes(kind[keep], place[starts], place[ends])


def _repeat_classes(words: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each word trigram of a row, a token for how often it occurs there (1, 2-3, 4-7, ...)."""
    if len(words) < 3:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    same = rows[2:] == rows[:-2]
    r = rows[:-2][same]
    _, back, n = np.unique(tk.mix(tk.gram_hashes(words, 3)[same] ^ r.astype(np.uint64)), return_inverse=True, return_counts=True)
    return tk.mix(np.log2(n[back]).astype(np.uint64) + np.uint64(1)), r


def features(column: pa.Array) -> list[li.Sparse]:
    out: list[li.Sparse] = []
    for _, data, offsets in tk.chunks(column):
        n = len(offsets) - 1
        starts, ends, rows = tk.word_bounds(data, offsets, tk.IS_SPACE)
        parts = []
        words = tk.word_hashes(data, starts, ends)
        for salt, w in ((1, words), (3, shapes(data, starts, ends))):
            two, two_rows = li.bigrams(w, rows)
            parts += [(li.slots(w, salt), rows), (li.slots(two, salt + 1), two_rows)]
        again, again_rows = _repeat_classes(words, rows)
        parts.append((li.slots(again, 5), again_rows))
        for slot, count in li.grouped(parts, n):
            x = np.log1p(count)
            x /= max(float(np.sqrt(x @ x)), 1e-9)
            out.append((np.append(slot, li.DIMS), np.append(x, 1.0)))
    return out


def _fit(table: pa.Table) -> dict[str, np.ndarray]:
    rows = features(table.column("text").combine_chunks())
    y = table.column("quality").to_numpy().astype(float)
    return {"quality": li.Ftrl(alpha=0.5, l1=0.05, l2=0.1).fit(rows, y, li.epochs(len(rows), 72_000))}


def train_quality(docs: DataFrame, labels: DataFrame, train_rows: int = li.TRAIN_ROWS, id_col: str = "doc_id") -> np.ndarray:
    """Weights of the quality model, learnt from ``labels`` (id, quality); all zero without labelled rows."""
    sample, shards = li.labelled_sample(docs, labels, {"quality": F.col("quality")}, train_rows, id_col)
    return li.train(sample, shards, _fit).get("quality", np.zeros(li.DIMS + 1))


def score_quality(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, score): the probability of quality label 1 for each row."""
    shared = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))

    def score(column: pa.Array) -> dict[str, np.ndarray]:
        w = shared.value
        return {"score": np.array([li.sigmoid(float(w[i] @ x)) for i, x in features(column)], float)}

    return li.mapped(docs, id_col, text, score, "score double")


def held_out(id_: str = "doc_id"):
    """Rows whose crc32 of the id as text is divisible by five."""
    return F.coalesce(F.crc32(F.col(id_).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out())
    scored = score_quality(docs, train_quality(docs, labels))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
