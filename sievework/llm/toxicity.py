"""Toxicity (operator 9): a classifier chain over toxicity categories.

Categories are predicted one after the other; each later linear model also gets the
earlier categories' probabilities as inputs.  While training, those are out-of-fold
predictions (the rows of each fold are predicted by models that never saw them), so later
models learn how far earlier ones can be trusted.  Features are the presence of hashed
lower-cased words, of words' first four to six characters (which tell unseen forms of a
known stem), and of word pairs.

Categories come from the labels: ``junk`` (quality 0), ``toxic``, and ``toxic_prose``
(toxic though of quality 1).  The decision threshold of ``toxic`` is the one of best
balance (F1) over the out-of-fold predictions.

Defined results: null and empty texts are scored by the biases; without labelled rows all
probabilities are 0.5 and nothing is toxic; rows are scored one by one, repeated or not; a
labelled id counts once in training however many rows have it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import linear as li
from . import textkernels as tk
from .common import giving_back, written

FOLDS = 3
MOST_SHARDS = 3
#: The chain in its order: category and its label.
CATEGORIES: dict[str, Column | str] = {"junk": "quality = 0", "toxic": "toxic = 1", "toxic_prose": "toxic = 1 AND quality = 1"}


def features(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The distinct feature numbers of each chunk of whole texts, and the offsets of its rows."""
    for _, data, offsets in tk.chunks(column):
        data = tk.LOWER[data]
        starts, ends, rows = tk.word_bounds(data, offsets, tk.IS_PUNCT)
        prefix = tk.prefix_hash(tk.BYTES[data])
        words = tk.span_hash(prefix, starts, ends)
        two, two_rows = li.bigrams(words, rows)
        parts = [(li.slots(words, 11), rows), (li.slots(two, 12), two_rows)]
        for k in (4, 5, 6):
            longer = ends - starts > k
            parts.append((li.slots(tk.span_hash(prefix, starts[longer], starts[longer] + k), 12 + k), rows[longer]))
        slot, _counts, cuts = li.distinct(parts, len(offsets) - 1)
        yield slot.astype(np.int32), cuts  # narrow: a task holds a shard of them


def _flat(column: pa.Array, earlier: np.ndarray) -> li.Flat:
    """All rows of a column, with earlier categories' probabilities as dense inputs."""
    parts = list(features(column))
    ends = np.cumsum([0, *(len(slot) for slot, _ in parts)])
    cuts = np.concatenate([[0], *(c[1:] + end for (_, c), end in zip(parts, ends[:-1], strict=True))])
    return li.Flat(np.concatenate([np.zeros(0, np.int32), *(slot for slot, _ in parts)]), cuts, dense(earlier))


def dense(p: np.ndarray) -> np.ndarray:
    return 2 * p - 1


def _model(extras: int) -> li.Ftrl:
    return li.Ftrl(extras, alpha=0.1, l1=1.0, l2=1.0)


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The probability from which on "toxic" has the best F1, held between 0.15 and 0.5; above 1 where no row is toxic.

    Out-of-fold models saw fewer rows and are less sure than the final one, hence the floor.
    """
    if not y.any():
        return 1.01
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(p) + 1) + y.sum())
    k = int(np.argmax(f1))
    below = p[order[k + 1]] if k + 1 < len(p) else 0.0
    return min(max(float((p[order[k]] + below) / 2), 0.15), 0.5)


def _fit_part(k: int, name: str):
    """Train category ``k`` on a part of a shard: all rows, or all but a fold whose rows are then predicted."""

    def each(table: pa.Table) -> Iterator[pa.RecordBatch]:
        part = table.column("part")[0].as_py() % (FOLDS + 1)
        earlier = np.array(table.column("earlier").to_pylist(), float).reshape(table.num_rows, k)
        rows = _flat(table.column("text").combine_chunks(), earlier)
        y = table.column("y").to_numpy().astype(float)
        inside = table.column("order").to_numpy() % FOLDS == part
        chosen = np.flatnonzero(~inside)
        w = _model(k).fit(rows.only(chosen), y[chosen], li.epochs(len(chosen)))
        if part == FOLDS:
            b = li.weight_rows(name, w)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.nulls(b.num_rows, pa.string()), pa.nulls(b.num_rows, pa.float64())], [*b.schema.names, "id", "p"])
        elif inside.any():
            at = np.flatnonzero(inside)
            p = li.sigmoids(li.margins(w, rows.slot, rows.cuts, rows.dense))[at]
            none = [pa.nulls(len(at), t) for t in (pa.string(), pa.int64(), pa.float64(), pa.int64())]
            yield pa.RecordBatch.from_arrays([*none, table.column("id").combine_chunks().take(pa.array(at)), pa.array(p)], ["model", "slot", "w", "size", "id", "p"])

    return giving_back(each)


def train_chain(docs: DataFrame, labels: DataFrame, train_rows: int = li.TRAIN_ROWS, categories: dict[str, str] | None = None, id_col: str = "doc_id", most_shards: int = MOST_SHARDS) -> dict[str, np.ndarray]:
    """Weights of each category's model, and ``threshold`` for the category ``toxic``.

    Each category is one Spark stage: every shard's folds and its final model are parts of
    their own, and out-of-fold predictions are joined back as inputs of the next category.
    """
    wanted = categories or CATEGORIES
    names = list(wanted)
    sample, shards = li.labelled_sample(docs, labels, {k: F.expr(c) for k, c in wanted.items()}, train_rows, id_col, most_shards=most_shards)
    rows = written(sample.select("shard", "order", "id", "text", *names).withColumn("earlier", F.expr("cast(array() as array<double>)")), "chain-rows")
    out, threshold = {}, np.array([1.01])
    for k, name in enumerate(names):
        parts = rows.select(F.col("shard"), "order", "id", "text", "earlier", F.col(name).alias("y"), F.explode(F.sequence(F.lit(0 if k + 1 < len(names) or name == "toxic" else FOLDS), F.lit(FOLDS))).alias("f"))  # nothing follows the last one
        parts = parts.select((F.col("shard") * (FOLDS + 1) + F.col("f")).alias("part"), "order", "id", "text", "earlier", "y")
        dealt = parts.repartitionByRange(shards * (FOLDS + 1), "part").sortWithinPartitions("part", "order", "id")
        found = written(li.by_group(dealt, _fit_part(k, name), f"{li.WEIGHTS}, id string, p double"), "chain")
        out |= li.mean_weights(found.where("model IS NOT NULL").select("model", "slot", "w", "size"), shards)
        predicted = found.where("model IS NULL").select("id", "p")
        if name == "toxic":  # at most the sample's rows, which train_rows bounds
            got = predicted.join(rows.select("id", F.col(name).alias("y")), "id").select("p", "y").toArrow()
            threshold = np.array([best_threshold(got.column("p").to_numpy(), got.column("y").to_numpy().astype(float))]) if got.num_rows else threshold
        if k + 1 < len(names):
            rows = written(rows.join(predicted, "id", "left").withColumn("earlier", F.concat("earlier", F.array(F.coalesce("p", F.lit(0.5))))).drop("p"), "chain-rows")
    return {c: out.get(c, np.zeros(li.DIMS + 1 + k)) for k, c in enumerate(names)} | {"threshold": threshold}


def score_chain(docs: DataFrame, models: dict[str, np.ndarray], id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, ``p_<category>`` for each category of the chain)."""
    shared = docs.sparkSession.sparkContext.broadcast({k: w.astype(np.float32) for k, w in models.items() if k != "threshold"})
    names = [k for k in models if k != "threshold"]

    def score(column: pa.Array) -> dict[str, np.ndarray]:
        p, row = np.zeros((len(column), len(names))), 0
        for slot, cuts in features(column):
            own = p[row : row + len(cuts) - 1]
            for k, name in enumerate(names):
                own[:, k] = li.sigmoids(li.margins(shared.value[name], slot, cuts, dense(own[:, :k])))
            row += len(own)
        return {f"p_{c}": np.ascontiguousarray(p[:, k]) for k, c in enumerate(names)}

    return li.mapped(docs, id_col, text, score, ", ".join(f"`p_{c}` double" for c in names))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    models = train_chain(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score_chain(docs, models)
    toxic = (F.col("p_toxic") >= float(models["threshold"][0])).cast("int")
    return scored.select("doc_id", F.col("p_toxic").alias("score"), toxic.alias("toxic"), "p_junk", "p_toxic_prose")
