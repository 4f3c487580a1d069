"""Model versions, runs and dataset snapshots: comparisons and histories."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .running import running, sliding


def count_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """(task_id, old_n, new_n, delta) of two count tables, tasks of either."""
    j = old.select("task_id", F.col("n").alias("old_n")).join(new.select("task_id", F.col("n").alias("new_n")), "task_id", "full_outer").fillna(0, ["old_n", "new_n"])
    return j.withColumn("delta", F.col("new_n") - F.col("old_n"))


def previous_scores(bench: DataFrame, version: int) -> DataFrame:
    """(task_id, prev_version, prev_score): the latest version before ``version``, as of each task."""
    return bench.where(F.col("version") < version).groupBy("task_id").agg(F.max("version").alias("prev_version"), F.max_by("score", "version").alias("prev_score"))


def task_alignment(external: DataFrame, registry: DataFrame) -> DataFrame:
    """(task_id, status): aligned, missing (registry only) or orphaned (external only)."""
    a, b = external.select("task_id").distinct().withColumn("e", F.lit(1)), registry.select("task_id").distinct().withColumn("r", F.lit(1))
    j = a.join(b, "task_id", "full_outer")
    return j.select("task_id", F.when(F.col("e").isNull(), "missing").when(F.col("r").isNull(), "orphaned").otherwise("aligned").alias("status"))


def gold_compare(gold: DataFrame, current: DataFrame, bench: DataFrame) -> DataFrame:
    """(task_id, gold, current, delta, bench, pct_lost, verdict) with protected, improve and rebuild zones."""
    d = count_diff(gold, current).withColumnsRenamed({"old_n": "gold", "new_n": "current"}).join(bench.select("task_id", F.col("score").alias("bench")), "task_id", "left").fillna(0.0, ["bench"])
    lost = F.when((F.col("gold") > 0) & (F.col("delta") < 0), -F.col("delta") * 100.0 / F.col("gold"))
    d = d.withColumn("pct_lost", lost)
    verdict = (
        F.when((F.col("bench") >= 0.7) & (F.col("pct_lost") > 10), "PROTECTED")
        .when((F.col("bench") >= 0.3) & (F.col("pct_lost") > 20), "LOST")
        .when(F.col("pct_lost") > 20, "NOTE")
        .otherwise("OK")
    )
    return d.withColumn("verdict", verdict)


def gold_integrity(compared: DataFrame) -> DataFrame:
    """One row: totals, warnings, and whether training is safe."""
    warn = F.col("verdict").isin("PROTECTED", "LOST")
    return compared.agg(
        F.sum("gold").alias("gold_total"), F.sum("current").alias("current_total"), F.count_if(F.col("delta") < 0).alias("reduced"), F.count_if(F.col("delta") > 0).alias("added"),
        F.count_if(warn).alias("warnings"), F.count_if(F.col("verdict") == "NOTE").alias("notes"), (F.count_if(warn) == 0).alias("safe_to_train"),
    )


def restore_tasks(current: DataFrame, gold: DataFrame, tasks: DataFrame) -> DataFrame:
    """The current rows with the given tasks' rows replaced by the gold ones."""
    return current.join(tasks, "task_id", "left_anti").unionByName(gold.join(tasks, "task_id", "left_semi"))


def compare_runs(original: DataFrame, runs: DataFrame) -> DataFrame:
    """(task_id, original, run_avg, delta, verdict): YES below -0.3, maybe below -0.1."""
    avg = runs.groupBy("task_id").agg(F.avg("score").alias("run_avg"))
    j = original.select("task_id", F.col("score").alias("original")).join(avg, "task_id", "full_outer").fillna(0.0, ["original", "run_avg"])
    j = j.withColumn("delta", F.col("run_avg") - F.col("original"))
    return j.withColumn("verdict", F.when(F.col("delta") < -0.3, "YES").when(F.col("delta") < -0.1, "maybe").otherwise(""))


def version_pivot(counts: DataFrame, versions: list[int]) -> DataFrame:
    """Tasks by the given versions (columns v<version>) and the change from first to last."""
    p = counts.where(F.col("version").isin(versions)).groupBy("task_id").pivot("version", versions).agg(F.sum("n")).fillna(0)
    p = p.select("task_id", *[F.col(f"`{v}`").alias(f"v{v}") for v in versions])
    return p.withColumn("delta", F.col(f"v{versions[-1]}") - F.col(f"v{versions[0]}"))


def biggest_changes(pivoted: DataFrame, k: int = 10) -> DataFrame:
    return pivoted.orderBy(F.desc(F.abs("delta")), "task_id").limit(k)


def score_version_table(bench: DataFrame, last: int = 3) -> DataFrame:
    """(task_id, s1..s<last> oldest first, change): the change of the last two versions, ``=`` within 0.05."""
    recent = bench.select("version").distinct().orderBy(F.desc("version")).limit(last)
    ranked = recent.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("version"))))
    rows = bench.join(F.broadcast(ranked), "version")
    p = rows.groupBy("task_id").pivot("rank", list(range(last, 0, -1))).agg(F.first("score"))
    p = p.select("task_id", *[F.col(f"`{last - i}`").alias(f"s{i + 1}") for i in range(last)])
    diff = F.col(f"s{last}") - F.col(f"s{last - 1}")
    return p.withColumn("change", F.when(diff.isNull(), F.lit(None)).when(F.abs(diff) <= 0.05, F.lit("=")).when(diff > 0, F.lit("up")).otherwise(F.lit("down")))


def snapshot_range(counts: DataFrame) -> DataFrame:
    return counts.groupBy("version").agg(F.sum("n").alias("total"), F.min("n").alias("min_n"), F.max("n").alias("max_n"))


def consistently_weak(bench: DataFrame, last: int = 5, least: int = 2, below: float = 0.5) -> DataFrame:
    """Tasks with at least ``least`` scores in the last versions and a mean under ``below``, with their history."""
    recent = bench.select("version").distinct().orderBy(F.desc("version")).limit(last)
    rows = bench.join(F.broadcast(recent), "version")
    hist = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("version", F.floor(F.col("score") * 100).alias("p")))), lambda x: F.concat(F.lit("v"), x["version"].cast("string"), F.lit(":"), x["p"].cast("string"))), " ")
    return rows.groupBy("task_id").agg(F.count("*").alias("n"), F.avg("score").alias("avg_score"), hist.alias("history")).where((F.col("n") >= least) & (F.round("avg_score", 9) < below))


def eval_rollup(bench: DataFrame) -> DataFrame:
    """(version, avg_score, is_best): the best is the earliest of the highest."""
    avg = bench.groupBy("version").agg(F.avg("score").alias("avg_score"))
    best = avg.agg(F.min_by("version", F.struct(-F.col("avg_score"), F.col("version"))).alias("best"))
    return avg.join(F.broadcast(best), how="cross").select("version", "avg_score", (F.col("version") == F.col("best")).alias("is_best"))


def run_variance(runs: DataFrame) -> DataFrame:
    """(task_id, run0, run1, delta): the absolute difference of two runs."""
    p = runs.groupBy("task_id").pivot("run", [0, 1]).agg(F.avg("score"))
    p = p.select("task_id", F.col("`0`").alias("run0"), F.col("`1`").alias("run1"))
    return p.withColumn("delta", F.abs(F.col("run0") - F.col("run1")))


def weak_tasks(bench: DataFrame, below: float = 0.5, target: float = 0.85) -> DataFrame:
    """(task_id, score, weak, strong, zero)."""
    s = F.col("score")
    return bench.select("task_id", "score", (s < below).alias("weak"), (s >= target).alias("strong"), (s == 0).alias("zero"))


def passing_failing(bench: DataFrame, least: float = 0.5) -> DataFrame:
    """All tasks by score, best first, marked as passing or failing."""
    return bench.select("task_id", "score", F.when(F.col("score") >= least, "passing").otherwise("failing").alias("side")).orderBy(F.desc("score"), "task_id")


def budget_spend(actions: DataFrame, budget: float) -> DataFrame:
    """Running spend and what remains, by session and turn."""
    return running(actions, "session_id", "turn", spent=("sum", F.col("cost"))).withColumn("remaining", F.lit(budget) - F.col("spent"))


def token_cost(tokens_in, tokens_out, price_in: float = 3.0, price_out: float = 15.0):
    """Price of a call in dollars, from tokens and prices per million."""
    return (tokens_in * price_in + tokens_out * price_out) / 1_000_000


def last_k_events(actions: DataFrame, k: int) -> DataFrame:
    """The last ``k`` actions of each session, counted back from 1; found from counts, without ordering a session."""
    per = actions.groupBy("session_id").agg(F.count("*").alias("_n"))
    met = running(actions, "session_id", "turn", _i=("sum", F.lit(1))).alias("r").join(per.alias("p"), F.col("r.session_id").eqNullSafe(F.col("p.session_id")))
    return met.select(*[f"r.{c}" for c in actions.columns], (F.col("p._n") - F.col("r._i") + 1).cast("int").alias("back")).where(F.col("back") <= k)


def loop_detection(actions: DataFrame, window: int = 15, least: int = 8) -> DataFrame:
    """Turns at which the last ``window`` actions hold ``least`` successful, non-empty generations and no training."""
    gen = (F.col("action") == "generate_data") & (F.col("status") == "success") & (F.col("added") > 0)
    numbered = running(actions, "session_id", "turn", _i=("sum", F.lit(1)))
    df = sliding(numbered, "session_id", "_i", window, n=F.count("*"), gens=F.count_if(gen), trains=F.count_if(F.col("action") == "train")).drop("_i")
    return df.withColumn("looping", (F.col("n") >= window) & (F.col("gens") >= least) & (F.col("trains") == 0))


def consecutive_failures(actions: DataFrame) -> DataFrame:
    """Errors since the last success at each turn; blocked actions neither count nor reset."""
    errors = running(actions, "session_id", "turn", _errors=("sum", F.when(F.col("status") == "error", 1).otherwise(0)))
    at = running(errors, "session_id", "turn", _then=("max", F.when(F.col("status") == "success", F.col("_errors"))))
    return at.withColumn("failures", F.col("_errors") - F.coalesce("_then", F.lit(0))).drop("_errors", "_then")


def regression_check(averages: DataFrame, threshold_pct: float = 15.0) -> DataFrame:
    """(version, avg_score, best_so_far, pct_below, regressed) against all earlier versions.

    One row for each model version, so the single ordered window is over few rows.
    """
    w = Window.orderBy("version").rowsBetween(Window.unboundedPreceding, -1)
    df = averages.withColumn("best_so_far", F.max("avg_score").over(w))
    pct = F.when(F.col("best_so_far") > 0, (F.col("best_so_far") - F.col("avg_score")) / F.col("best_so_far") * 100)
    return df.withColumn("pct_below", pct).withColumn("regressed", F.coalesce(pct > threshold_pct, F.lit(False)))


def count_snapshot(examples: DataFrame, version: int) -> DataFrame:
    return examples.groupBy("task_id").agg(F.count("*").alias("n")).select(F.lit(version).alias("version"), "task_id", "n")


def changelog(actions: DataFrame, mutating: tuple[str, ...] = ("generate_data", "filter_data", "repair_data", "dedup_data", "rebalance_data", "restore_gold_data")) -> DataFrame:
    """(session_id, changes): the session's successful data-changing actions in order."""
    rows = actions.where(F.col("action").isin(*mutating) & (F.col("status") == "success"))
    return rows.groupBy("session_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("turn", "action"))), lambda x: F.concat(x["turn"].cast("string"), F.lit(":"), x["action"])).alias("changes"))
