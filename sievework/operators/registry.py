"""All operators by name, and the hook for scorers of one's own.

``OPERATORS`` holds every public function of the operator modules that takes a DataFrame
first, so a job can name its steps: ``apply(df, "filter_min_score", scores=s, least=3)``.
"""

from __future__ import annotations

import inspect
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from . import aggregates, decisions, dedup, features, logs, parsing, scores, validate, versions


def _operators() -> dict[str, Callable]:
    found: dict[str, Callable] = {}
    for module in (features, parsing, logs, validate, scores, aggregates, versions, decisions, dedup):
        for name, f in vars(module).items():
            if inspect.isfunction(f) and f.__module__ == module.__name__ and not name.startswith("_"):
                first = next(iter(inspect.signature(f).parameters.values()), None)
                if first is not None and first.annotation in (DataFrame, "DataFrame"):
                    found[name] = f
    return found


OPERATORS: dict[str, Callable] = _operators()


def apply(df: DataFrame, name: str, **params):
    """Run an operator by name; an unknown name is an error that lists what there is."""
    if name not in OPERATORS:
        raise KeyError(f"no operator {name!r}; there are {', '.join(sorted(OPERATORS))}")
    return OPERATORS[name](df, **params)


SCORED = "struct<score:int,issues:array<string>,reasoning:string,error:string>"


def score_with(examples: DataFrame, scorer: Callable[[pd.Series], pd.DataFrame], known: DataFrame | None = None, text: str = "text") -> DataFrame:
    """(task_id, user_prefix, score, issues, reasoning, error): ``known`` scores and those of all other keys, from ``scorer``.

    ``scorer`` takes a batch of texts and gives a frame with score, issues, reasoning and error.
    Keys that ``known`` has are not scored again, so a job that stopped goes on where its
    written scores end; one row of each key is scored, the first by ``pos``.  The texts of a batch that
    raises are tried one by one; one that raises by itself gets score 0 and the error, as an unreadable reply would.
    """
    rows = examples if known is None else scores.unscored(examples, known)
    todo = rows.groupBy(*scores.KEY).agg(F.min_by(text, "pos").alias("_text"))

    columns = ("score", "issues", "reasoning", "error")

    def frame(got: pd.DataFrame, n: int) -> pd.DataFrame:
        return pd.DataFrame({c: list(got[c]) if c in got else [None] * n for c in columns})

    def scored(b: pd.Series) -> pd.DataFrame:
        try:
            return frame(scorer(b), len(b))
        except Exception as e:  # noqa: BLE001  a scorer is foreign code
            if len(b) > 1:
                return pd.concat([scored(b.iloc[k : k + 1]) for k in range(len(b))], ignore_index=True)
            return pd.DataFrame([(0, [], "", str(e))], columns=list(columns))

    @F.pandas_udf(SCORED)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield scored(b)

    new = todo.select(*scores.KEY, run("_text").alias("s")).select(*scores.KEY, "s.*")
    if known is None:
        return new
    old = known.select(*scores.KEY, *[F.col(c) if c in known.columns else F.lit(None).alias(c) for c in ("score", "issues", "reasoning", "error")])
    return old.unionByName(new)


REVIEW = "verdict string, reasoning string, issues array<string>, missing_behaviors array<string>, recommendation string"


def review_with(examples: DataFrame, truth: DataFrame, reviewer: Callable[[pd.DataFrame], list[str]], known: DataFrame | None = None, sample: int = 3, seed: str = "r") -> DataFrame:
    """(task_id, verdict, reasoning, issues, missing_behaviors, recommendation, skipped): ``known`` verdicts and those of all other tasks.

    ``reviewer`` takes a frame of tasks (task_id, truth, n, sample) and gives a reply for each;
    ``sample`` holds ``sample`` examples of the task as (example_id, user, tools, written, final),
    by a hash of their ids, so that a rerun shows the same.  ``truth`` is (task_id, truth); a task
    without one is skipped.  Replies are JSON, in a code fence or not; any other reply is the
    verdict UNKNOWN with its first 500 characters.  The tasks of a batch that raises are tried
    one by one; one that raises by itself is skipped with the error.
    """
    todo = examples if known is None else examples.join(known.select("task_id"), "task_id", "left_anti")
    m = F.col("messages")
    # only the first of a task reach its window: Spark limits each input partition to them before the shuffle
    rank = F.row_number().over(Window.partitionBy("task_id").orderBy(scores.shuffle_order("example_id", seed), "example_id"))
    first = todo.withColumn("_r", rank).where(F.col("_r") <= sample)
    calls = features.tool_calls(first).where("valid")
    made = calls.groupBy("example_id").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("turn", "call_no", "name"))), lambda c: c["name"]).alias("tools"),
        F.sort_array(F.collect_set(F.when(F.col("name").isin("write_file", "create_directory"), F.col("arguments")["path"]))).alias("written"),
    )
    shown = first.join(made, "example_id", "left").select(
        "task_id", F.struct("_r", "example_id", F.substring(tx.first_user(m), 1, 200).alias("user"), F.coalesce("tools", F.array().cast("array<string>")).alias("tools"), F.coalesce("written", F.array().cast("array<string>")).alias("written"), F.substring(F.coalesce(tx.last_assistant(m), F.lit("")), 1, 200).alias("final")).alias("s")
    )
    size = todo.groupBy("task_id").agg(F.count("*").alias("n"))
    tasks = shown.groupBy("task_id").agg(F.sort_array(F.collect_list("s")).alias("sample")).join(size, "task_id").join(truth.select("task_id", "truth"), "task_id", "left")

    def replies(f: pd.DataFrame) -> list[tuple[str | None, str | None]]:
        try:
            return [(r, None) for r in reviewer(f)]
        except Exception as e:  # noqa: BLE001  a reviewer is foreign code
            return [replies(f.iloc[k : k + 1])[0] for k in range(len(f))] if len(f) > 1 else [(None, str(e))]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if len(f):
                yield pd.DataFrame([(t, *r) for t, r in zip(f["task_id"], replies(f.reset_index(drop=True)), strict=True)], columns=["task_id", "reply", "skipped"])

    new = tasks.where("truth IS NOT NULL").mapInPandas(run, "task_id string, reply string, skipped string").unionByName(tasks.where("truth IS NULL").select("task_id", F.lit(None).cast("string").alias("reply"), F.lit("no ground truth").alias("skipped")))
    text = F.regexp_replace(F.regexp_replace(F.trim("reply"), r"(?m)^```(?:json)?\s*", ""), r"(?m)\s*```$", "")
    new = new.withColumn("_v", F.from_json(text, f"{REVIEW}, _bad string", {"columnNameOfCorruptRecord": "_bad"}))
    read = F.col("_v._bad").isNull() & text.rlike(r"^\s*\{")
    fields = [f.split()[0] for f in REVIEW.split(", ")]
    plain = {"verdict": F.lit("UNKNOWN"), "reasoning": F.substring(text, 1, 500), "issues": F.array().cast("array<string>"), "missing_behaviors": F.array().cast("array<string>")}
    out = new.select("task_id", *[F.when(F.col("reply").isNotNull() & read, F.col(f"_v.{c}")).when(F.col("reply").isNotNull(), plain.get(c, F.lit(None))).alias(c) for c in fields], "skipped")
    if known is None:
        return out
    return known.select("task_id", *[F.col(c) if c in known.columns else F.lit(None).alias(c) for c in (*fields, "skipped")]).unionByName(out)
