"""Counts, dataset statistics, diversity and completeness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import refdata as rd
from ..functions import text as tx
from . import features as ft


def count_per_task(examples: DataFrame) -> DataFrame:
    return examples.groupBy(F.coalesce("task_id", F.lit("unknown")).alias("task_id")).agg(F.count("*").alias("n"))


def zero_fill(counts: DataFrame, tasks: DataFrame) -> DataFrame:
    """Every task of the registry with its count or 0 (the registry is a fixed, small dimension)."""
    return tasks.join(counts, "task_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))


def unknown_tasks(examples: DataFrame, tasks: DataFrame) -> DataFrame:
    return examples.select("task_id").distinct().join(tasks, "task_id", "left_anti")


def dataset_stats(examples: DataFrame) -> DataFrame:
    """By task: rows in train, val and total, mean turns, mean characters, tokens (chars // 4)."""
    df = ft.size_features(examples)
    return df.groupBy("task_id").agg(
        F.count_if(F.col("split") == "train").alias("train"), F.count_if(F.col("split") == "val").alias("val"), F.count("*").alias("total"),
        F.avg("turns").alias("avg_turns"), F.avg("total_chars").alias("avg_chars"), F.floor(F.sum("total_chars") / 4).alias("tokens"),
    )


def _list(when: Column) -> Column:
    return F.array_join(F.sort_array(F.collect_list(F.when(when, F.col("task_id")))), "|")


def balance(counts: DataFrame, target: int) -> DataFrame:
    """One row over the registry's counts: min, max, ratio, and overweight, underweight and missing tasks."""
    n = F.col("n")
    out = counts.agg(F.min(n).alias("min_n"), F.max(n).alias("max_n"), _list(n > 1.5 * target).alias("overweight"), _list((n > 0) & (n < 0.5 * target)).alias("underweight"), _list(n == 0).alias("missing"))
    return out.withColumn("ratio", F.bround(F.col("min_n") / F.nullif("max_n", F.lit(0)), 3))


def data_summary(counts: DataFrame, least: int = 40) -> DataFrame:
    n = F.col("n")
    return counts.agg(F.sum(n).alias("total"), _list(n == 0).alias("missing"), _list((n > 0) & (n < least)).alias("below"))


def tasks_below(counts: DataFrame, least: int) -> DataFrame:
    return counts.where(F.col("n") < least).select("task_id", "n")


def deficits(counts: DataFrame, target: int, min_per_task: int = 0) -> DataFrame:
    """max(target - n, min_per_task) where positive."""
    return counts.select("task_id", F.greatest(F.lit(target) - F.col("n"), F.lit(min_per_task), F.lit(0)).alias("deficit")).where("deficit > 0")


def per_call(task: Column, hard: tuple[str, ...] = rd.HARD_TASKS, easy: int = 3) -> Column:
    """Examples asked for in one generation call."""
    return F.when(task.isin(*hard), F.lit(1)).otherwise(F.lit(easy))


def deficit_cost(short: DataFrame, price: float = 0.015) -> DataFrame:
    """One row: new examples, batch calls and their price."""
    calls = F.ceil(F.col("deficit") / per_call(F.col("task_id")))
    return short.agg(F.sum("deficit").alias("new_examples"), F.sum(calls).alias("calls")).withColumn("cost", F.col("calls") * F.lit(price))


def generation_requests(short: DataFrame, variations: DataFrame) -> DataFrame:
    """One request for each call: (task_id, request_no, n_examples, variation_id), variations in turn."""
    epc = per_call(F.col("task_id"))
    calls = short.withColumn("calls", F.ceil(F.col("deficit") / epc).cast("int")).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("calls") - 1)))
    n = variations.count()  # the fixed variation table
    return calls.withColumn("variation_no", (F.col("i") % n).cast("int")).join(F.broadcast(variations), "variation_no").select("task_id", F.col("i").alias("request_no"), F.least(epc, F.col("deficit") - F.col("i") * epc).cast("int").alias("n_examples"), "variation_id")


def diversity(examples: DataFrame) -> DataFrame:
    """By task: n, unique prompts, tool combinations, turn range, score (mean of up to four parts), issues, flagged.

    Parts: share of unique prompts; turn spread (doubled, at most 1); share of tool
    combinations (doubled); length variation (doubled, only for more than two examples).
    """
    m = F.col("messages")
    prompt = F.get(tx.of_role(m, "user"), 0)["content"]
    chars = F.aggregate(m, F.lit(0).cast("long"), lambda a, x: a + F.coalesce(F.length(x["content"]), F.lit(0)))
    rows = examples.select("task_id", prompt.alias("prompt"), F.size(m).alias("turns"), tx.joined(F.array_distinct(ft.call_names(m))).alias("tools"), chars.alias("chars"))
    g = rows.groupBy("task_id").agg(
        F.count("*").alias("n"), F.count_distinct("prompt").alias("unique_prompts"), F.count("prompt").alias("prompts"), F.min("turns").alias("min_turns"), F.max("turns").alias("max_turns"),
        F.count_distinct("tools").alias("unique_tool_combos"), F.avg("chars").alias("mean_chars"), F.stddev_samp("chars").alias("sd"),
    )
    unique = F.coalesce(F.col("unique_prompts") / F.nullif("prompts", F.lit(0)), F.lit(0.0))
    spread = F.coalesce((F.col("max_turns") - F.col("min_turns")) / F.nullif("max_turns", F.lit(0)), F.lit(0.0))
    combos = F.col("unique_tool_combos") / F.col("n")
    cv = F.coalesce(F.col("sd") / F.nullif("mean_chars", F.lit(0)), F.lit(0.0))
    three = unique + F.least(spread * 2, F.lit(1.0)) + F.least(combos * 2, F.lit(1.0))
    many = F.col("n") > 2
    issues = F.array_compact(F.array(F.when(unique < 0.8, "low prompt diversity"), F.when(spread < 0.2, "low turn diversity"), F.when(combos < 0.3, "low tool diversity"), F.when(many & (cv < 0.15), "uniform length")))
    out = g.withColumn("score", F.when(many, (three + F.least(cv * 2, F.lit(1.0))) / 4).otherwise(three / 3)).withColumn("issues", issues)
    return out.withColumn("flagged", F.col("score") < 0.5).select("task_id", "n", "unique_prompts", "min_turns", "max_turns", "unique_tool_combos", "score", "issues", "flagged")


def _behaviour(examples: DataFrame) -> DataFrame:
    m = F.col("messages")
    calls = F.flatten(F.transform(tx.of_role(m, "assistant"), lambda x: F.regexp_extract_all(x["content"], F.lit(tx.CALL_PATTERN), F.lit(1))))
    parsed = F.filter(F.transform(calls, lambda raw: tx.strict_json(raw, ft.CALL)), lambda c: c.isNotNull())
    wrote = F.exists(parsed, lambda c: c["name"].isin("write_file", "create_directory") & (F.coalesce(c["arguments"]["path"], F.lit("")) != ""))
    names = ft.call_names(m, invalid=None)
    chars = F.aggregate(m, F.lit(0).cast("long"), lambda a, x: a + F.coalesce(F.length(x["content"]), F.lit(0)))
    return examples.select(
        "task_id", F.size(names).alias("calls"), wrote.alias("wrote"), ft.has_final_summary(m).alias("summary"), ft.has_error_recovery(m).alias("recovery"), ft.ends_with_write(m).alias("ends"),
        tx.joined(F.array_distinct(names)).alias("combo"), F.substring(F.get(tx.of_role(m, "user"), 0)["content"], 1, 80).alias("prompt"), chars.alias("chars"),
    )


def _pct(c: str | Column) -> Column:
    return F.avg((F.col(c) if isinstance(c, str) else c).cast("double")) * 100


def statistical_check(examples: DataFrame, exempt: tuple[str, ...] = rd.EXEMPT_TASKS) -> DataFrame:
    """By task: patterns of tool use and summaries, and what is out of bounds."""
    g = _behaviour(examples).groupBy("task_id").agg(
        F.count("*").alias("n"), F.avg("calls").alias("avg_tools"), _pct(F.col("calls") <= 1).alias("pct_single_tool"), _pct("wrote").alias("pct_write"), _pct("summary").alias("pct_summary"),
        _pct("recovery").alias("pct_error_recovery"), F.count_distinct("combo").alias("unique_tool_combos"), F.count_distinct("prompt").alias("unique_prompts"),
    )
    held = ~F.col("task_id").isin(*exempt)
    big = F.col("n") > 10
    issues = F.array_compact(
        F.array(
            F.when(held & (F.col("pct_single_tool") > 40), "single tool"), F.when(held & (F.col("pct_write") < 50), "few writes"), F.when(F.col("pct_summary") < 70, "few summaries"),
            F.when(big & (F.col("unique_tool_combos") < 3), "few tool combinations"), F.when(big & (F.col("unique_prompts") < F.col("n") * 0.7), "repeated prompts"),
        )
    )
    return g.withColumn("issues", issues)


def completeness(examples: DataFrame, exempt: tuple[str, ...] = rd.EXEMPT_TASKS) -> DataFrame:
    """By task: means and shares, with the flags HIGH-1TOOL, LOW-WRITE and NO-SUMMARY."""
    g = _behaviour(examples).groupBy("task_id").agg(
        F.count("*").alias("n"), F.avg("calls").alias("avg_tools"), _pct(F.col("calls") <= 1).alias("pct_single"), _pct("ends").alias("pct_write"), _pct("summary").alias("pct_summary"), _pct("recovery").alias("pct_error"), F.avg("chars").alias("avg_chars")
    )
    flags = F.array_compact(F.array(F.when(F.col("pct_single") > 30, "HIGH-1TOOL"), F.when((F.col("pct_write") < 50) & ~F.col("task_id").isin(*exempt), "LOW-WRITE"), F.when(F.col("pct_summary") < 50, "NO-SUMMARY")))
    return g.withColumn("flags", flags)


def _lengths(converted: DataFrame) -> DataFrame:
    chars = F.aggregate("messages", F.lit(0).cast("long"), lambda a, x: a + F.length(x["content"]))
    return converted.select(F.floor(chars / 4).alias("tokens"))


def sft_length_stats(converted: DataFrame) -> DataFrame:
    """One row: min, sorted[n // 2], sorted[int(.9 n)] and max of the token estimate.

    Positions come from counts by length (few distinct values), so no global sort of rows is made.
    """
    by = _lengths(converted).groupBy("tokens").agg(F.count("*").alias("c"))
    w = Window.orderBy("tokens").rowsBetween(Window.unboundedPreceding, 0)
    upto = by.withColumn("upto", F.sum("c").over(w))
    total = by.agg(F.sum("c").alias("n"))
    at = lambda pos: F.min(F.when(F.col("upto") > pos, F.col("tokens")))
    return upto.join(F.broadcast(total), how="cross").agg(F.max("n").alias("n"), F.min("tokens").alias("min_tokens"), at(F.floor(F.col("n") / 2)).alias("median_tokens"), at(F.floor(F.col("n") * F.lit(0.9))).alias("p90_tokens"), F.max("tokens").alias("max_tokens"))


def sft_length_histogram(converted: DataFrame, edges: tuple[int, ...] = (512, 1024, 2048, 4096)) -> DataFrame:
    bucket = F.lit(f"{edges[-1]}+")
    for low, high in reversed(list(zip((0, *edges[:-1]), edges, strict=True))):
        bucket = F.when(F.col("tokens") < high, F.lit(f"{low}-{high}")).otherwise(bucket)
    return _lengths(converted).groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))


def bad_examples_by_task(found: DataFrame, k: int = 10) -> DataFrame:
    """Top tasks by examples with critical or high issues, each with its issue histogram."""
    bad = found.where(F.col("severity").isin("critical", "high"))
    n = bad.groupBy("task_id").agg(F.count_distinct("example_id").alias("n_bad")).orderBy(F.desc("n_bad"), "task_id").limit(k)
    return bad.groupBy("task_id", "check").agg(F.count("*").alias("n")).join(F.broadcast(n), "task_id")


def tool_jaccard(a: Column, b: Column) -> Column:
    """Of two sets; both empty: 1, one empty: 0."""
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b)).cast("double"))


def novelty_check(new: DataFrame, existing: DataFrame, least: int = 5) -> DataFrame:
    """(task_id, is_novel): whether new examples' signatures hold one that existing ones lack; tasks with fewer than ``least`` existing examples are left out."""
    known = existing.groupBy("task_id").agg(F.count("*").alias("n")).where(F.col("n") >= least).select("task_id")
    sig = lambda df: ft.tool_sequence(df).select("task_id", F.array_join("signature", ">").alias("signature")).distinct()
    fresh = sig(new).join(sig(existing).withColumn("seen", F.lit(True)), ["task_id", "signature"], "left")
    return fresh.groupBy("task_id").agg(F.max(F.col("seen").isNull()).alias("is_novel")).join(known, "task_id", "left_semi")
