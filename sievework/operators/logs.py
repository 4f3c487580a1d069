"""Mining benchmark and training logs (P27-P33, P36, A22); logs are tables (run_id, line_no, line), many runs at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .running import running

#: Score lines in their dialects: a fraction of 1.0 or of 100, a bare number after the task, "task = number".
SCORE_PATTERNS = (
    (r"(task_\d{2}\w*):\s*([0-9.]+)/1\.0", 1.0),
    (r"(task_\d{2}\w*):\s*([0-9.]+)/100", 100.0),
    (r"(task_\d{2}\w*)\s*=\s*([01](?:\.\d+)?)", 1.0),
    (r"(task_\d{2}\w*)[\"\s:]*\s+([01](?:\.\d+)?)(?![\d/])", 1.0),
)
START = "starting task: "


def model_version(name: Column) -> Column:
    """The number after ``-v`` at the end of a model's name; null without one."""
    return F.nullif(F.regexp_extract(name, r"-v(\d+)$", 1), F.lit("")).cast("int")


def scores_of_lines(log: DataFrame, tasks: DataFrame) -> DataFrame:
    """(run_id, task_id, score): the last score that any dialect gives for a known task."""
    found = None
    for rank, (pattern, scale) in enumerate(SCORE_PATTERNS):
        task = F.regexp_extract("line", pattern, 1)
        rows = log.select("run_id", "line_no", task.alias("task_id"), (F.nullif(F.regexp_extract("line", pattern, 2), F.lit("")).try_cast("double") / scale).alias("score"), F.lit(rank).alias("rank"))
        rows = rows.where((F.col("task_id") != "") & F.col("score").isNotNull())
        found = rows if found is None else found.union(rows)
    # a line's first dialect that matches counts, and a task's last line
    best = found.groupBy("run_id", "task_id").agg(F.max_by("score", F.struct("line_no", -F.col("rank"))).alias("score"))
    return best.join(F.broadcast(tasks.select("task_id")), "task_id", "left_semi").select("run_id", "task_id", "score")


def scores_of_blobs(log: DataFrame, tasks: DataFrame) -> DataFrame:
    """(run_id, task_id, score) from JSON objects on log lines, the last one counts."""
    blobs = log.select("run_id", "line_no", F.explode(F.regexp_extract_all("line", F.lit(r'\{[^{}]*"task_\d{2}\w*"[^{}]*\}'), F.lit(0))).alias("blob"))
    rows = blobs.select("run_id", "line_no", F.explode(F.from_json("blob", "map<string,double>")).alias("task_id", "score")).where("score IS NOT NULL")
    best = rows.groupBy("run_id", "task_id").agg(F.max_by("score", "line_no").alias("score"))
    return best.join(F.broadcast(tasks.select("task_id")), "task_id", "left_semi")


def resolve_task_prefix(names: DataFrame, tasks: DataFrame) -> DataFrame:
    """(name, task_id): names that are a task id, or the prefix of exactly one.

    The registry is a fixed small dimension, so the prefix join broadcasts it.
    """
    t = F.broadcast(tasks.select("task_id"))
    pairs = names.select("name").distinct().join(t, F.startswith(F.col("task_id"), F.col("name")))
    g = pairs.groupBy("name").agg(F.count("*").alias("n"), F.min("task_id").alias("only"), F.max(F.col("task_id") == F.col("name")).alias("exact"))
    return g.where("n = 1 OR exact").select("name", F.when(F.col("exact"), F.col("name")).otherwise(F.col("only")).alias("task_id"))


def section_lines(log: DataFrame) -> DataFrame:
    """(run_id, section, task_id, line_no, line): lines numbered by the ``starting task:`` before them; earlier ones are left out.

    Starts are counted in blocks of a run, so one long log is spread over many tasks.
    """
    start = F.contains("line", F.lit(START))
    numbered = running(log.select("run_id", "line_no", "line"), "run_id", "line_no", section=("sum", F.when(start, 1).otherwise(0))).where("section > 0")
    names = numbered.where(start).select("run_id", "section", F.regexp_extract("line", START + r"(\S+)", 1).alias("task_id"))
    n, t = numbered.alias("n"), names.alias("t")
    return n.join(t, F.col("n.run_id").eqNullSafe(F.col("t.run_id")) & (F.col("n.section") == F.col("t.section"))).select("n.run_id", "n.section", "t.task_id", "n.line_no", "n.line")


def log_sections(log: DataFrame) -> DataFrame:
    """(run_id, section, task_id, lines): runs cut at ``starting task:``; for long sections take ``section_lines``."""
    g = section_lines(log).groupBy("run_id", "section", "task_id").agg(F.sort_array(F.collect_list(F.struct("line_no", "line"))).alias("_l"))
    return g.select("run_id", "section", "task_id", F.transform("_l", lambda x: x["line"]).alias("lines"))


def failure_patterns(lines: DataFrame, notes_chars: int = 500, error_chars: int = 200) -> DataFrame:
    """Sections, given as ``section_lines``, with six flags, judge notes and error lines; sums and maxima over lines only."""
    # The words and counts by which a section shows a failure.
    low = F.lower(F.col("line"))
    some = lambda *words: F.max(_any([F.contains(low, F.lit(w)) for w in words]))
    count = lambda p: F.sum(F.regexp_count(low, F.lit(p)))
    notes = F.min_by("line", F.when(F.startswith("line", F.lit("Notes:")), F.col("line_no")))
    error = F.when(F.col("line").rlike(r"\bERROR\b"), F.struct("line_no", F.substring(F.trim("line"), 1, error_chars).alias("line")))
    g = lines.groupBy("run_id", "section", "task_id").agg(
        (count("tool_call") > 10).alias("excessive_tool_calls"), (some("loop") | (count("read_file") > 5)).alias("looping"), some("not found", "no such file").alias("wrong_filename"),
        (some("pk") & some("bytes")).alias("binary_as_text"), some("truncat", "cut off").alias("truncation"), some("failed to parse transcript", "malformed").alias("malformed_output"),
        F.substring(F.regexp_replace(F.coalesce(F.when(F.max(F.startswith("line", F.lit("Notes:"))), notes), F.lit("")), r"^Notes:\s*", ""), 1, notes_chars).alias("notes"), F.sort_array(F.collect_list(error)).alias("_e"),
    )
    return g.select(*[c for c in g.columns if c != "_e"], F.transform("_e", lambda x: x["line"]).alias("errors"))


def _any(tests: list[Column]) -> Column:
    out = tests[0]
    for t in tests[1:]:
        out = out | t
    return out


def categorise_failure(score: Column, notes: Column) -> Column:
    """PASS, PARTIAL, or the keyword categories of the judge's notes joined by `` | ``."""
    n = F.lower(notes)
    has = lambda *w: _any([F.contains(n, F.lit(x)) for x in w])
    # The keywords of each category, and the bounds of a pass and of a part of one.
    found = F.array_compact(
        F.array(
            F.when(has("truncated", "only shows", "partial"), "INCOMPLETE"),
            F.when(has("no evidence", "did not", "never"), "MISSING_OUTPUT"),
            F.when(has("error") & has("stopped", "gave up"), "ERROR_QUIT"),
            F.when(has("wrong", "incorrect"), "WRONG_OUTPUT"),
            F.when(has("one") & has("file", "read", "attempt"), "ONE_STEP"),
        )
    )
    other = F.when(score == 0, F.array(F.lit("ZERO"))).otherwise(F.array(F.lit("LOW_QUALITY")))
    return F.when(score >= 0.9, "PASS").when(score >= 0.5, "PARTIAL").otherwise(F.array_join(F.when(F.size(found) > 0, found).otherwise(other), " | "))


def failure_pattern_groups(categorised: DataFrame, below: float = 0.5) -> DataFrame:
    """Categories among tasks under ``below``, most frequent first."""
    rows = categorised.where(F.col("score") < below).select(F.explode(F.split("category", r" \| ")).alias("category"))
    return rows.groupBy("category").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "category")


def final_loss(log: DataFrame) -> DataFrame:
    """(run_id, loss): the last ``'loss': x`` of each training log."""
    x = F.nullif(F.regexp_extract("line", r"'loss': ([0-9.]+)", 1), F.lit("")).cast("double")
    return log.select("run_id", "line_no", x.alias("loss")).where("loss IS NOT NULL").groupBy("run_id").agg(F.max_by("loss", "line_no").alias("loss"))
