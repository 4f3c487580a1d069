"""Decision tables and gates (X01-X10): ordered CASE ladders over joined signals, many datasets at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import refdata as rd


def decide(external: tuple[str, ...] = rd.EXTERNAL_TASKS) -> Column:
    """The action for a row of signals (task_id, bench, judge, n, prev, regressed).

    The order of the tests is part of the meaning.  After the tests on n (under 30, and 80
    or more) only 30 <= n < 80 is left, so later tests on n < 30 or n > 100 could never
    fire and are left out.
    """
    bench, judge, n = F.col("bench"), F.col("judge"), F.col("n")
    low = bench <= 0.3
    return (
        F.when(n < 30, "GENERATE")
        .when((n >= 80) & low & (n > 100), "TRIM")
        .when((n >= 80) & low, "REGENERATE")
        .when(n >= 80, "LEAVE_ALONE")
        .when(F.col("regressed") & (F.col("prev") > 0), "INVESTIGATE")
        .when(bench >= 0.8, "LEAVE_ALONE")
        .when((bench == 0) & (n >= 50) & (judge >= 4.5) & F.col("task_id").isin(*external), "INFRASTRUCTURE")
        .when((bench == 0) & (n >= 50) & (judge >= 4.5), "REGENERATE")
        .when(low & (judge > 0) & (judge < 3.5), "REGENERATE")
        .when(low & (n >= 50) & ((judge >= 4.5) | (judge == 0)), "ADVERSARIAL")
        .when(low, "GENERATE")
        .otherwise("LEAVE_ALONE")
    )


def signals(tasks: DataFrame, counts: DataFrame, judge: DataFrame, bench: DataFrame, previous: DataFrame, drop: float = 0.2) -> DataFrame:
    """The registry with count, judge mean, benchmark score, previous score, and whether it fell by ``drop``."""
    df = (
        tasks.select("task_id")
        .join(counts.select("task_id", "n"), "task_id", "left")
        .join(judge.select("task_id", F.col("avg_score").alias("judge")), "task_id", "left")
        .join(bench.select("task_id", F.col("score").alias("bench")), "task_id", "left")
        .join(previous.select("task_id", F.col("prev_score").alias("prev")), "task_id", "left")
        .fillna(0, ["n"])
        .fillna(0.0, ["judge", "bench", "prev"])
    )
    return df.withColumn("regressed", (F.col("prev") - F.col("bench")) >= drop)


def recommend_actions(signal_rows: DataFrame) -> DataFrame:
    return signal_rows.withColumn("recommendation", decide())


def recommendation_summary(recommended: DataFrame) -> DataFrame:
    return recommended.groupBy("recommendation").agg(F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_list("task_id")), "|").alias("tasks"))


def tasks_needing_action(recommended: DataFrame, actions: tuple[str, ...] = ("GENERATE", "REGENERATE", "ADVERSARIAL", "TRIM", "INVESTIGATE")) -> DataFrame:
    return recommended.where(F.col("recommendation").isin(*actions))


def coverage_gate(counts: DataFrame, least: int = 30) -> DataFrame:
    """One row: passed, and the tasks to fix (without rows, or with fewer than ``least``)."""
    n = F.col("n")
    tasks = lambda c: F.array_join(F.sort_array(F.collect_list(F.when(c, F.col("task_id")))), "|")
    return counts.agg((F.count_if(n < least) == 0).alias("passed"), tasks(n == 0).alias("missing"), tasks((n > 0) & (n < least)).alias("below"))


def quality_gate(report: DataFrame, least: float = 90.0) -> DataFrame:
    """``report`` with total and clean -> clean percent and whether it suffices."""
    pct = F.col("clean") * 100.0 / F.nullif("total", F.lit(0))
    return report.select("total", "clean", pct.alias("clean_pct"), F.coalesce(pct >= least, F.lit(False)).alias("passed"))


def train_gate(coverage: DataFrame, quality: DataFrame, gold: DataFrame) -> DataFrame:
    """The gates as rows (gate, passed) with an overall one."""
    rows = coverage.select(F.lit("coverage").alias("gate"), "passed").union(quality.select(F.lit("quality"), "passed")).union(gold.select(F.lit("gold"), "safe_to_train"))
    return rows.union(rows.agg(F.lit("train").alias("gate"), F.bool_and("passed").alias("passed")))


def generation_guard(recommended: DataFrame, baseline: DataFrame, cap: int = 20) -> DataFrame:
    """Tasks that may still be generated for: no action against it, and under ``cap`` new rows since the baseline."""
    df = recommended.join(baseline.select("task_id", F.col("n").alias("base")), "task_id", "left")
    allowed = ~F.col("recommendation").isin("LEAVE_ALONE", "INFRASTRUCTURE", "TRIM")
    capped = F.coalesce(F.col("n") - F.col("base") >= cap, F.lit(False))
    return df.where(allowed & ~capped).select("task_id", "n", "recommendation")


def diagnosis_gate(actions: DataFrame) -> DataFrame:
    """(session_id, blocked): after a benchmark with zeros, until a diagnosis succeeds.

    ``actions`` has ``zeros``, the number of tasks that scored 0 in a benchmark row.
    """
    ok = F.col("status") == "success"
    bench = ok & (F.col("action") == "benchmark") & (F.col("zeros") > 0)
    cured = ok & F.col("action").isin("diagnose", "read_transcript")
    g = actions.groupBy("session_id").agg(F.max(F.when(bench, F.col("turn"))).alias("b"), F.max(F.when(cured, F.col("turn"))).alias("c"))
    return g.select("session_id", (F.col("b").isNotNull() & (F.coalesce("c", F.lit(-1)) < F.col("b"))).alias("blocked"))


def allocate_plan(targets: DataFrame, target: float = 0.85, pool: int = 300, per_task: int = 30, most: int = 120, price: float = 0.04, group: str = "version") -> DataFrame:
    """Examples to make for each task: shares of ``pool`` by the gap to 1, capped by task, by its total, and overall.

    ``targets`` (group, task_id, score, n, priority): if the caps leave more than ``pool``,
    lower priorities (greater numbers) are cut first, then smaller gaps.
    """
    open_ = targets.where(F.col("score") < target).withColumn("gap", 1 - F.col("score"))
    share = F.floor(F.lit(pool) * F.col("gap") / F.sum("gap").over(Window.partitionBy(group)))
    want = open_.withColumn("want", F.greatest(F.lit(0), F.least(F.greatest(share, F.lit(1)), F.lit(per_task), F.lit(most) - F.col("n"))))
    w = Window.partitionBy(group).orderBy("priority", F.desc("gap"), "task_id").rowsBetween(Window.unboundedPreceding, 0)
    cut = want.withColumn("upto", F.sum("want").over(w)).withColumn("alloc", F.greatest(F.lit(0), F.least("want", F.lit(pool) - (F.col("upto") - F.col("want")))))
    return cut.where("alloc > 0").select(group, "task_id", "alloc", (F.col("alloc") * price).alias("cost"))


def score_zone(score: Column) -> Column:
    return F.when(score >= 0.7, "PROTECTED").when(score >= 0.3, "IMPROVE").otherwise("REBUILD")


def below_by_registry(counts: DataFrame, least: int = 30) -> DataFrame:
    """Tasks without rows or under ``least``, in the registry's order."""
    return counts.where(F.col("n") < least).select("task_id", "ordinal", "n", (F.col("n") == 0).alias("zero")).orderBy("ordinal")
