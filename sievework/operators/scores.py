"""Score joins, filters with floors, rebalancing, splits and score statistics (J, F, W, A07-A09).

Examples here are flat: (example_id, pos, task_id, user_prefix, source, ...); scores are
(task_id, user_prefix, score) with one row per key.  "The first k of a task" never sorts a
task's rows in one place: see ``mark_first``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.io import stored

KEY = ["task_id", "user_prefix"]
SKETCH = 16_384  # size of a rank sketch: a rank is off by about 0.03 percent of the rows
STEPS = 8000  # ranks at which a sketch is read; two positions that are up to seven of them apart hold the one looked for


def hash_position(order: Column) -> Column:
    """The place of a hexadecimal hash: its first fifteen digits as a number."""
    return F.conv(F.substring(order, 1, 15), 16, 10).cast("long")


def mark_first(df: DataFrame, key: list[str], order: list[Column], position: Column, limits: DataFrame | None = None, n_first: Column | None = None) -> DataFrame:
    """``df`` with ``_in``: whether the row is among the first k of its ``key`` by ``order``.

    k is ``n_first``, over ``_n`` (the key's rows) and the columns of ``limits`` (one row per
    key).  ``position`` is a whole number that rises with the order.  Sketches, summed by key before they are moved,
    give two positions around the k-th row; the rows before them are counted and only those
    between them, under a thousandth of the key's, are ranked, which gives the k-th row itself.
    Every row is then compared with it where it is, so a key with a third of all rows is no
    hot task.  Where a sketch has missed the k-th row, all rows of the key are ranked.
    Rows that are equal in all of ``order`` are taken together.
    """
    least, most = F.lit(-(2**63)).cast("long"), F.lit(2**63 - 1).cast("long")
    own = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    narrow = stored(df.select(*key, F.coalesce(position.cast("long"), least).alias("_p"), own.alias("_o")), "order")
    per = narrow.groupBy(*key).agg(F.count("*").alias("_n"), F.kll_sketch_agg_bigint("_p", F.lit(SKETCH)).alias("_s"))
    if limits is not None:
        per = per.join(limits, key, "left")
    k, n = n_first.cast("long"), F.col("_n")
    ranks = F.split(F.lit(" ".join(repr(i / STEPS) for i in range(STEPS + 1))), " ").cast("array<double>")  # the function takes constants only
    step = F.least(F.lit(STEPS), F.greatest(F.lit(0), F.floor(k / n * STEPS))).cast("int")
    read = per.select(*key, k.alias("_k"), F.coalesce(k >= n, F.lit(False)).alias("_all"), step.alias("_i"), F.kll_sketch_get_quantile_bigint("_s", ranks).alias("_q"))
    low, high = F.get("_q", F.greatest(F.lit(0), F.col("_i") - 3)), F.get("_q", F.least(F.lit(STEPS), F.col("_i") + 4))
    bounds = stored(read.select(*key, "_k", "_all", low.alias("_low"), high.alias("_high")), "bounds")
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"p.{c}")) for c in key]
    open_ = bounds.where((F.col("_k") > 0) & ~F.col("_all"))
    beside = lambda plan, *columns: narrow.alias("r").join(plan.alias("p"), same).select("r.*", *columns)
    counted = beside(open_, "_low", "_high", "_k").groupBy(*key).agg(F.count_if(F.col("_p") < F.col("_low")).alias("_c"), F.count_if(F.col("_p") <= F.col("_high")).alias("_d"), *[F.first(c).alias(c) for c in ("_k", "_low", "_high")])
    hit = (F.col("_c") < F.col("_k")) & (F.col("_d") >= F.col("_k"))
    edge = counted.select(*key, F.when(hit, F.col("_low")).otherwise(least).alias("_low"), F.when(hit, F.col("_high")).otherwise(most).alias("_high"), F.when(hit, F.col("_k") - F.col("_c")).otherwise(F.col("_k")).alias("_left"))
    near = beside(edge, "_low", "_high", "_left").where(F.col("_p").between(F.col("_low"), F.col("_high")))
    rank = F.row_number().over(Window.partitionBy(*key).orderBy("_o"))
    cut = near.withColumn("_r", rank).where(F.col("_r") == F.col("_left")).select(*key, F.col("_o").alias("_cut"))
    plan = bounds.alias("r").join(cut.alias("p"), same, "left").select(*[f"r.{c}" for c in key], "_all", "_cut")
    plan = stored(plan, "cuts")
    met = df.withColumn("_o", own).alias("r").join(plan.alias("p"), same, "left")
    inside = F.coalesce(F.col("p._all") | (F.col("r._o") <= F.col("p._cut")), F.lit(False))
    return met.select("r.*", inside.alias("_in")).drop("_o")


def with_scores(examples: DataFrame, scores: DataFrame, default: float | None = 3.0) -> DataFrame:
    """Left join on the two-column key; ``scored`` tells a found score from the default."""
    s = scores.select(*KEY, F.col("score").cast("double").alias("_s"))
    joined = examples.join(s, KEY, "left")
    score = F.coalesce("_s", F.lit(default).cast("double")) if default is not None else F.col("_s")
    return joined.withColumn("score", score).withColumn("scored", F.col("_s").isNotNull()).drop("_s")


def prune_stale_scores(scores: DataFrame, examples: DataFrame) -> DataFrame:
    return scores.join(examples.select(*KEY), KEY, "left_semi")


def unscored(examples: DataFrame, scores: DataFrame) -> DataFrame:
    return examples.join(scores.select(*KEY), KEY, "left_anti")


def filter_by_task(examples: DataFrame, task: str) -> DataFrame:
    return examples.where(F.col("task_id") == task)


def remove_tasks(examples: DataFrame, tasks: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """Kept rows, and removed counts by task."""
    gone = F.col("task_id").isin(*tasks)
    return examples.where(~F.coalesce(gone, F.lit(False))), examples.where(gone).groupBy("task_id").agg(F.count("*").alias("removed"))


def filter_min_score(examples: DataFrame, scores: DataFrame, least: float = 3.0) -> DataFrame:
    """Unscored rows count as 5 and stay."""
    return with_scores(examples, scores, 5.0).where(F.col("score") >= least)


def keep_with_floor(scored: DataFrame, least: float, floor: Column | int, limits: DataFrame | None = None) -> DataFrame:
    """Low-scored rows go, unless they are among the first ``floor`` of their task in file order.

    The closed form of a running "keep while fewer than floor are kept": unscored, or score
    >= least, or rank <= floor.  ``floor`` may use ``_n`` (the task's rows) and columns of ``limits``.
    """
    limit = F.lit(floor) if isinstance(floor, int) else floor
    marked = mark_first(scored, ["task_id"], [F.col("pos"), F.col("example_id")], F.col("pos"), limits, limit)
    return marked.where(~F.col("scored") | (F.col("score") >= least) | F.col("_in")).drop("_in")


def filter_score_baseline(examples: DataFrame, scores: DataFrame, baseline: DataFrame, least: float = 3.0, tasks: tuple[str, ...] | None = None, slack: int = 5, min_per_task: int = 30) -> DataFrame:
    """As ``keep_with_floor`` with the per-task baseline count (task_id, n) as floor.

    Tasks outside ``tasks``, and tasks with at most ``min_per_task + slack`` rows, are untouched.
    """
    df = with_scores(examples, scores, None)
    held = F.col("_n") <= min_per_task + slack
    if tasks is not None:
        held = held | ~F.col("task_id").isin(*tasks)
    floor = F.when(held, F.col("_n")).otherwise(F.coalesce("_floor", F.lit(0)))
    return keep_with_floor(df, least, floor, baseline.select("task_id", F.col("n").alias("_floor")))


def filter_score_force(examples: DataFrame, scores: DataFrame, least: float = 3.0, tasks: tuple[str, ...] | None = None, floor: int = 15) -> DataFrame:
    df = with_scores(examples, scores, None)
    if tasks is None:
        return keep_with_floor(df, least, floor)
    return keep_with_floor(df, least, F.when(F.col("task_id").isin(*tasks), F.lit(floor)).otherwise(F.lit(2**31 - 1)))


def borderline(examples: DataFrame, scores: DataFrame, low: int = 2, high: int = 3, cap: int = 30) -> DataFrame:
    """Repair candidates: the lowest, first ``cap`` rows with a score in the band."""
    return with_scores(examples, scores, None).where(F.col("score").between(low, high)).orderBy("score", "pos").limit(cap)


def low_scores(scores: DataFrame, most: int = 2, k: int = 10) -> DataFrame:
    return scores.where(F.col("score") <= most).orderBy("score", *KEY).limit(k)


def rebalance(scored: DataFrame, target: int) -> DataFrame:
    """At most ``target`` rows of each task: originals first, then by score, then in file order."""
    original = F.coalesce(F.col("source"), F.lit("original")) == "original"
    rank = F.row_number().over(Window.partitionBy("task_id").orderBy(F.desc(original), F.desc("score"), "pos"))
    return scored.withColumn("_rank", rank).where(F.col("_rank") <= target).drop("_rank")


def rebalance_plan(examples: DataFrame, target: int) -> DataFrame:
    """(task_id, before, after, change) and a total row, without rebalancing."""
    per = examples.groupBy("task_id").agg(F.count("*").alias("before")).withColumn("after", F.least("before", F.lit(target)))
    out = per.rollup("task_id").agg(F.sum("before").alias("before"), F.sum("after").alias("after"))
    return out.select(F.coalesce("task_id", F.lit("TOTAL")).alias("task_id"), "before", "after", (F.col("after") - F.col("before")).alias("change"))


def trim_first_n(examples: DataFrame, task: str, n: int) -> DataFrame:
    """The first ``n`` rows of one task in each split file; other tasks untouched."""
    mine = F.coalesce(F.col("task_id") == task, F.lit(False))
    own = examples.where(mine)
    first = mark_first(own, ["split"], [F.col("pos"), F.col("example_id")], F.col("pos"), None, F.lit(n)).where("_in").drop("_in")
    return examples.where(~mine).unionByName(first)


def shuffle_order(id_col: str, seed: str) -> Column:
    """A reproducible shuffle: the MD5 of id and seed."""
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(seed)))


def _split(examples: DataFrame, n_val: Column, seed: str, limits: DataFrame | None = None) -> DataFrame:
    h = shuffle_order("example_id", seed)
    marked = mark_first(examples, ["task_id"], [h, F.col("example_id")], hash_position(h), limits, n_val)
    return marked.withColumn("split", F.when(F.col("_in"), F.lit("val")).otherwise(F.lit("train"))).drop("_in")


def stratified_split(examples: DataFrame, share: float = 0.1, least: int = 2, seed: str = "s") -> DataFrame:
    """Per task min(n, max(least, round-half-even(share * n))) rows to ``val``."""
    return _split(examples.drop("split"), F.least(F.col("_n"), F.greatest(F.lit(least), F.bround(F.col("_n") * F.lit(share)))), seed)


def split_new_batch(examples: DataFrame, target: int = 50, share: float = 0.1, seed: str = "s") -> DataFrame:
    """A new batch gives val min(max(2, round(target * share)), max(1, n // 5)) rows."""
    goal = max(2, round(target * share))
    return _split(examples.drop("split"), F.least(F.lit(goal), F.greatest(F.lit(1), F.floor(F.col("_n") / 5))), seed)


def split_fill_val(new: DataFrame, existing: DataFrame, target: int = 50, share: float = 0.1, seed: str = "s") -> DataFrame:
    """Fill each task's val up to max(2, round(target * share)) given the rows it has."""
    goal = max(2, round(target * share))
    has = existing.where("split = 'val'").groupBy("task_id").agg(F.count("*").alias("_has"))
    return _split(new.drop("split"), F.greatest(F.lit(0), F.lit(goal) - F.coalesce("_has", F.lit(0))), seed, has)


def best_in_cluster(members: DataFrame) -> DataFrame:
    """(cluster, example_id, score, pos) -> the best scored, first on ties."""
    rank = F.row_number().over(Window.partitionBy("cluster").orderBy(F.desc("score"), "pos"))
    return members.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def random_sample(examples: DataFrame, n: int, seed: str = "s") -> DataFrame:
    """``n`` rows of each task in the reproducible shuffle."""
    rank = F.row_number().over(Window.partitionBy("task_id").orderBy(shuffle_order("example_id", seed), "example_id"))
    return examples.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def dedup_latest_by_key(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The last row of each key."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(order)))
    return rows.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def judge_report(scores: DataFrame) -> DataFrame:
    """One row: n, avg, share >= 3 and >= 4 in percent, and a histogram of 5 to 1."""
    s = F.col("score")
    share = lambda k: F.count_if(s >= k) * 100.0 / F.count("*")
    return scores.where("score > 0").agg(F.count("*").alias("n"), F.avg(s).alias("avg_score"), share(3).alias("pct_3"), share(4).alias("pct_4"), *[F.count_if(s == k).alias(f"n_{k}") for k in (5, 4, 3, 2, 1)])


def judge_per_task(scores: DataFrame, flag: float = 3.0) -> DataFrame:
    out = scores.where("score > 0").groupBy("task_id").agg(F.avg("score").alias("avg_score"), F.min("score").alias("min_score"), F.count("*").alias("n"))
    return out.withColumn("flagged", F.col("avg_score") < flag)


def top_issues(scores: DataFrame, k: int = 10, chars: int = 80) -> DataFrame:
    """``scores`` with ``issues`` array -> the most frequent issues by their first characters."""
    return scores.select(F.explode("issues").alias("i")).select(F.substring("i", 1, chars).alias("issue")).groupBy("issue").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "issue").limit(k)


def outcome(old: Column, new: Column) -> Column:
    return F.when(new.isNull(), "failed").when(new > old, "improved").when(new == old, "unchanged").otherwise("degraded")


def apply_repairs(examples: DataFrame, repairs: DataFrame) -> DataFrame:
    """``repairs`` (task_id, user_prefix, old_score, new_score, ...): the new score where it is better."""
    r = repairs.select(*KEY, "old_score", "new_score")
    better = F.col("new_score") > F.col("old_score")
    return examples.join(r, KEY, "left").withColumn("repaired", F.coalesce(better, F.lit(False))).withColumn("score", F.when(better, F.col("new_score")).otherwise(F.col("old_score")))


def repair_outcomes(repairs: DataFrame) -> DataFrame:
    """One row: improved, unchanged, degraded, failed, and the success rate in percent (one decimal, half-even)."""
    o = outcome(F.col("old_score"), F.col("new_score"))
    names = ("improved", "unchanged", "degraded", "failed")
    out = repairs.agg(*[F.count_if(o == k).alias(k) for k in names], F.count("*").alias("total"))
    return out.withColumn("success_rate", F.bround(F.col("improved") * 100.0 / F.col("total"), 1))
