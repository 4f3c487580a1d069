"""Near duplicates by TF-IDF cosine and tool-set similarity inside each task.

Rows are (example_id, pos, task_id, text, tools array<string>).  The similarity join
(``similarity``) compares the vectors of a task in blocks, by products of sketches that bound
a pair's cosine from above; what they leave is verified, and no pair is lost.
Equal texts are folded to one representative before the join, so copies never multiply.
Clusters take no list of all pairs: ``leader_scan`` counts a row's similar rows, and lists
them only where there are few.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.io import stored
from . import similarity as sim

POSTINGS = 1_000_000  # weights of a block of vectors
LINKS = 100  # similar rows for each linked row, up to which they are listed


def tfidf_vectors(rows: DataFrame, max_features: int = 5000, stop_words: tuple[str, ...] | str = ()) -> DataFrame:
    """(task_id, example_id, term, w): unit vectors; tasks with one row of text have none.

    Terms are lower-cased runs of two or more letters, digits or underscores; the ``max_features`` most
    frequent of a task count (ties by term); idf = ln((1 + n) / (1 + df)) + 1.  ``stop_words``
    are left out: a tuple, or the name of one of Spark's own lists ("english").
    """
    text = rows.where(F.trim("text") != "")
    n = text.groupBy("task_id").agg(F.count("*").alias("n")).where("n > 1")
    words = text.select("task_id", "example_id", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}_]{2,}"), F.lit(0))).alias("term"))
    if isinstance(stop_words, str):
        stop_words = tuple(StopWordsRemover.loadDefaultStopWords(stop_words))
    if stop_words:
        words = words.where(~F.col("term").isin(*stop_words))
    tf = stored(words.groupBy("task_id", "example_id", "term").agg(F.count("*").alias("tf")), "term-counts")
    terms = tf.groupBy("task_id", "term").agg(F.count("*").alias("df"), F.sum("tf").alias("total"))
    rank = F.row_number().over(Window.partitionBy("task_id").orderBy(F.desc("total"), "term"))
    vocabulary = terms.withColumn("_r", rank).where(F.col("_r") <= max_features).join(n, "task_id").select("task_id", "term", (F.log((F.lit(1.0) + F.col("n")) / (F.lit(1.0) + F.col("df"))) + 1).alias("idf"))
    raw = tf.join(vocabulary, ["task_id", "term"]).select("task_id", "example_id", "term", (F.col("tf") * F.col("idf")).alias("x"))
    norm = F.sqrt(F.sum(F.col("x") * F.col("x")).over(Window.partitionBy("example_id", "task_id")))  # of one document's terms
    return raw.select("task_id", "example_id", "term", (F.col("x") / norm).alias("w"))


def _packed(vectors: DataFrame, threshold: float, tool_threshold: float | None = None) -> DataFrame:
    """Blocks of vectors, and what makes two of them similar."""
    blocks = sim.packed(vectors, threshold, POSTINGS, tool_threshold is not None)
    blocks._asked = threshold, tool_threshold
    return blocks


def _met(one: DataFrame, two: DataFrame | None) -> DataFrame:
    """(task_id, a, b, cosine): similar pairs, a < b within the blocks of ``one``, or a of ``one`` and b of ``two``."""
    return sim.pairs(one, two, *one._asked)


def cosine_pairs(vectors: DataFrame, threshold: float = 0.85) -> DataFrame:
    """(task_id, a, b, cosine) with a < b, of all pairs at or above the threshold; exact."""
    terms = vectors.groupBy("task_id", "term").agg(F.count("*").alias("df"))
    numbers = terms.select("task_id", "term", (F.row_number().over(Window.partitionBy("task_id").orderBy(F.desc("df"), "term")) - 1).alias("no"))
    lists = vectors.join(numbers, ["task_id", "term"]).groupBy("task_id", "example_id").agg(F.sort_array(F.collect_list(F.struct("no", "w"))).alias("v"))
    rows = lists.select("task_id", "example_id", F.col("example_id").alias("pos"), F.expr("cast(null as array<string>)").alias("tools"), F.col("v.no").alias("no"), F.col("v.w").alias("w"))
    return _met(_packed(sim.written(rows, "vectors"), threshold), None)


def fold_copies(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Representatives (least pos of equal task, text and tools) and (example_id, rep) of all rows."""
    tools = F.array_join(F.sort_array("tools"), "|")
    keyed = rows.withColumn("_k", F.sha2(F.concat_ws("\x01", "text", tools), 256))
    reps = keyed.groupBy("task_id", "_k").agg(F.min_by("example_id", "pos").alias("rep"))
    membership = keyed.join(reps, ["task_id", "_k"]).select("example_id", "pos", "task_id", "rep")
    return rows.join(reps.select(F.col("rep").alias("example_id")), "example_id", "left_semi"), membership


def _prepared(rows: DataFrame, how: dict) -> tuple[DataFrame, DataFrame]:
    """Representatives with their tools, and those that have a vector with it; counts and idf are over all rows."""
    reps = stored(fold_copies(rows)[0].select("task_id", "example_id", "pos", "tools"), "representatives")
    return reps, sim.term_rows(rows, reps, **how)


def duplicate_pairs(rows: DataFrame, threshold: float = 0.85, tool_threshold: float | None = 0.8, **how) -> DataFrame:
    """(task_id, a, b, cosine) of representatives whose texts and tool sets are both similar; any tool sets if ``tool_threshold`` is None."""
    vectors = _prepared(rows, how)[1]
    blocks = _packed(vectors, threshold, tool_threshold)
    sim.discard(vectors)
    return _met(blocks, None)


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The greedy scan over the edges of one partition: the nodes that an earlier leader absorbs."""
    found = [b.to_pandas() for b in batches]
    edges = pd.concat(found).sort_values(["pv", "v"], kind="stable") if found else pd.DataFrame(columns=["u", "v"])
    absorbed: set = set()
    for v, earlier in edges.groupby("v", sort=False)["u"]:
        if not absorbed.issuperset(earlier):
            absorbed.add(v)
    yield pa.RecordBatch.from_pydict({"n": pa.array(list(absorbed), pa.int64())})


def _settled(open_: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(leaders, absorbed): the nodes that paths of forced choices reach from a node without earlier neighbours.

    A node with one open earlier neighbour leads if and only if that one does not.  Such nodes
    form trees of pointers, which are doubled until they end; the parity of the way decides.
    """
    into = open_.groupBy("v").agg(F.count("*").alias("c"), F.first("u").alias("u"))
    several = into.where("c > 1").select(F.col("v").alias("end"))
    way = stored(into.where("c = 1").select(F.col("v").alias("n"), F.col("u").alias("end"), F.lit(True).alias("odd")), "pointers")
    while True:
        on = way.select(F.col("n").alias("end"), F.col("end").alias("_e"), F.col("odd").alias("_o"))
        further = way.join(on, "end", "left")
        if further.where("_e IS NOT NULL").isEmpty():
            break
        way = stored(further.select("n", F.coalesce("_e", "end").alias("end"), F.when(F.col("_o"), ~F.col("odd")).otherwise(F.col("odd")).alias("odd")), "pointers")
    ends = open_.select(F.col("u").alias("n")).distinct().join(into.select(F.col("v").alias("n")), "n", "left_anti").select("n", F.lit(False).alias("odd"))
    known = stored(way.join(several, "end", "left_anti").select("n", "odd").union(ends), "known")
    leaders = known.where("NOT odd").select("n")
    beside = open_.join(leaders.withColumnRenamed("n", "u"), "u", "left_semi").select(F.col("v").alias("n"))
    return leaders, known.where("odd").select("n").union(beside).distinct()


def leader_clusters(nodes: DataFrame, edges: DataFrame, finish_edges: int = 200_000) -> DataFrame:
    """(example_id, leader): scanning in order of pos, each free node leads and absorbs its free later neighbours.

    The leaders are the lexicographically first maximal independent set and every other
    node goes to its earliest adjacent leader; it is *not* a connected component.  Each
    round settles all nodes that forced choices reach (a path of any length in a logarithmic
    number of steps) and their neighbours, until at most ``finish_edges`` edges between open
    nodes are left, which one task scans; every round settles at least the first open node.
    """
    pos = nodes.select("example_id", "pos")
    pa_, pb = pos.toDF("a", "_pa"), pos.toDF("b", "_pb")
    e = edges.join(pa_, "a").join(pb, "b")
    first_a = F.struct("_pa", "a") < F.struct("_pb", "b")
    pick = lambda p, q: F.when(first_a, F.col(p)).otherwise(F.col(q))
    # earlier -> later
    e = stored(e.where("a <> b").select(pick("a", "b").alias("u"), pick("_pa", "_pb").alias("pu"), pick("b", "a").alias("v"), pick("_pb", "_pa").alias("pv")).distinct(), "edges")
    gone, open_ = [], e
    while (left := open_.count()) > 0:
        if left <= finish_edges:
            gone.append(stored(open_.select("u", "v", "pv").coalesce(1).mapInArrow(_finish, "n long"), "absorbed"))
            break
        leaders, absorbed = _settled(open_)
        absorbed = stored(absorbed, "absorbed")
        gone.append(absorbed)
        done = leaders.union(absorbed).distinct()
        open_ = stored(open_.join(done.withColumnRenamed("n", "u"), "u", "left_anti").join(done.withColumnRenamed("n", "v"), "v", "left_anti").select("u", "pu", "v", "pv"), "open")
    if not gone:
        return nodes.select("example_id", F.col("example_id").alias("leader"))
    absorbed = reduce(DataFrame.union, gone).distinct()
    # an absorbed node has an earlier leader beside it, any other node leads
    own = e.join(absorbed.withColumnRenamed("n", "u"), "u", "left_anti").join(absorbed.withColumnRenamed("n", "v"), "v", "left_semi").groupBy("v").agg(F.min_by("u", F.struct("pu", "u")).alias("leader"))
    return nodes.select("example_id").join(own.withColumnRenamed("v", "example_id"), "example_id", "left").select("example_id", F.coalesce("leader", "example_id").alias("leader"))


def leader_scan(rows: DataFrame, threshold: float = 0.85, tool_threshold: float = 0.8, budget: float = 200_000, **how) -> DataFrame:
    """(example_id, leader) of the representatives, as ``leader_clusters`` of ``duplicate_pairs`` gives it, without listing all pairs.

    A round counts the similar rows before and after each open row.  If there are at most
    ``LINKS`` for each linked row, or ``budget``, they are listed and scanned.  Otherwise
    the rows with none before them lead, what they reach is absorbed, and the others stay
    open; a group of k near copies takes one round and lists nothing.  In the end each absorbed
    row finds its first leader.  Every round settles at least the first open row of each task.
    """
    reps, open_ = _prepared(rows, how)
    blocks, linked, gone = _packed(open_, threshold, tool_threshold), None, []
    while True:
        links = sim.written(sim.link_counts(blocks, threshold, tool_threshold), "links")
        sim.discard(blocks)
        total, n = links.agg(F.coalesce(F.sum("before"), F.lit(0)), F.count("*")).first()
        if not total:
            break
        open_ = sim.written(open_.join(links, "example_id"), "linked")
        linked = linked or open_
        if total <= max(budget, LINKS * n):
            listed = sim.written(_met(_packed(open_.drop("before", "after"), threshold, tool_threshold), None), "pairs")
            last = leader_clusters(open_.select("example_id", "pos"), listed)
            if not gone:
                return reps.select("example_id").join(last, "example_id", "left").select("example_id", F.coalesce("leader", "example_id").alias("leader"))
            gone.append(last.where("leader <> example_id").select("example_id"))
            break
        leads, others = open_.where("before = 0"), open_.where("before > 0")
        blocks = [_packed(x.drop("before", "after"), threshold, tool_threshold) for x in (leads, others)]
        absorbed = sim.written(sim.first_links(*blocks, threshold, tool_threshold), "absorbed").select("example_id")
        for x in blocks:
            sim.discard(x)
        gone.append(absorbed)
        open_ = sim.written(others.drop("before", "after").join(absorbed, "example_id", "left_anti"), "open")
        blocks = _packed(open_, threshold, tool_threshold)
    if not gone:
        return reps.select("example_id", F.col("example_id").alias("leader"))
    absorbed = sim.written(reduce(DataFrame.union, gone), "absorbed")
    both = [_packed(linked.drop("before", "after").join(absorbed, "example_id", kind), threshold, tool_threshold) for kind in ("left_anti", "left_semi")]
    led = sim.first_links(*both, threshold, tool_threshold)
    return reps.select("example_id").join(led, "example_id", "left").select("example_id", F.coalesce("leader", "example_id").alias("leader"))


def clusters(rows: DataFrame, threshold: float = 0.85, tool_threshold: float = 0.8, **how) -> DataFrame:
    """(example_id, pos, task_id, cluster) of all rows; copies share their representative's cluster."""
    _, membership = fold_copies(rows)
    led = leader_scan(rows, threshold, tool_threshold, **how)
    return membership.join(led.toDF("rep", "cluster"), "rep").select("example_id", "pos", "task_id", "cluster")


def dedup(scored: DataFrame, clustered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Kept rows (best score of each cluster, first on ties) and removed ids."""
    c = clustered.select("example_id", "cluster")
    rank = F.row_number().over(Window.partitionBy("cluster").orderBy(F.desc("score"), "pos"))
    ranked = scored.join(c, "example_id").withColumn("_rank", rank)
    return ranked.where("_rank = 1").drop("_rank"), ranked.where("_rank > 1").select("example_id", "cluster")


def dedup_report(rows: DataFrame, removed: DataFrame, warn_pct: float = 30.0) -> DataFrame:
    """By split: before, after, removed, percent (one decimal) and whether it is over the warning share."""
    gone = removed.select("example_id").withColumn("_gone", F.lit(1))
    g = rows.join(gone, "example_id", "left").groupBy("split").agg(F.count("*").alias("before"), F.count("_gone").alias("removed"))
    pct = F.bround(F.col("removed") * 100.0 / F.col("before"), 1)
    return g.select("split", "before", (F.col("before") - F.col("removed")).alias("after"), "removed", pct.alias("pct"), (pct > warn_pct).alias("warn"))


def first_clusters(clustered: DataFrame, k: int = 20, shown: int = 3) -> DataFrame:
    """The first ``k`` clusters of more than one member, with their size and first members."""
    g = clustered.groupBy("cluster").agg(F.count("*").alias("size"), F.min("pos").alias("pos"), F.slice(F.sort_array(F.collect_list("example_id")), 1, shown).alias("members"))
    return g.where("size > 1").orderBy("pos").limit(k)


def exact_duplicates(rows: DataFrame) -> DataFrame:
    """(example_id, original): later rows with the task, text and tools of an earlier one; empty texts never count."""
    _, m = fold_copies(rows.where(F.trim("text") != ""))
    return m.where("example_id <> rep").select("example_id", F.col("rep").alias("original"))
