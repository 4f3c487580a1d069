"""Validators: every check is a row generator into one ``issues`` table.

``issues(examples)`` gives (example_id, task_id, severity, check, detail).  All checks on
messages are array expressions over one scan and all checks on calls share one exploded
view, so the whole validation is two narrow passes and the few groupings by example.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import refdata as rd
from ..functions import text as tx
from ..sources.io import stored
from . import scores
from .features import CALL, call_names, tool_calls

BAD = ("critical", "high")


def _issue(when: Column, severity: str, check: str, detail: Column) -> Column:
    return F.when(when, F.struct(F.lit(severity).alias("severity"), F.lit(check).alias("check"), detail.alias("detail")))


def message_issues(examples: DataFrame, exempt: tuple[str, ...] = rd.EXEMPT_TASKS) -> DataFrame:
    """Checks on the messages alone."""
    m = F.col("messages")
    none = F.coalesce(F.size(m), F.lit(0)) == 0
    some = ~none
    user = F.get(tx.of_role(m, "user"), 0)
    blank = lambda c: tx.strip(F.coalesce(c, F.lit(""))) == ""
    said = F.coalesce(tx.last_assistant(m), F.lit(""))
    end = F.right(tx.rstrip(said), F.lit(1))
    empty_said = F.size(F.filter(tx.of_role(m, "assistant"), lambda x: blank(x["content"])))
    chars = F.aggregate(m, F.lit(0).cast("long"), lambda a, x: a + F.coalesce(F.length(x["content"]), F.lit(0)))
    held = ~F.col("task_id").isin(*exempt)
    single = F.array(
        _issue(none, "critical", "empty_messages", F.lit("Example has no messages")),
        _issue(some & (F.get(m, 0)["role"] != "system"), "warning", "missing_system", F.lit("First message is not system role")),
        _issue(some & (tx.last_role(m) != "assistant"), "high", "no_final_assistant", F.concat(F.lit("Last message role is "), tx.last_role(m))),
        _issue(some & user.isNull(), "critical", "no_user_message", F.lit("No user message found")),
        _issue(some & user.isNotNull() & blank(user["content"]), "critical", "empty_user_message", F.lit("User message is empty")),
        _issue(some & (F.length(said) > 100) & ~F.contains(F.lit(rd.TERMINALS), end), "medium", "truncated_response", F.concat(F.lit("Ends with "), end)),
        _issue(some & (empty_said > 0), "high", "empty_assistant", F.concat(empty_said.cast("string"), F.lit(" assistant message(s) have empty content"))),
        _issue(some & held & (F.size(m) < 4), "medium", "too_short", F.concat(F.lit("Only "), F.size(m).cast("string"), F.lit(" messages"))),
        _issue(some & held & (chars < 200), "medium", "very_short_content", F.concat(F.lit("Total content only "), chars.cast("string"), F.lit(" chars"))),
    )
    results = tx.of_role(m, "tool", "tool_result")
    each = F.flatten(
        F.transform(
            results,
            lambda r: F.array(
                _issue(blank(r["content"]), "medium", "empty_tool_result", F.lit("Tool result is empty")),
                _issue(tx.strip(r["content"]).isin(*rd.PLACEHOLDERS), "high", "placeholder_tool_result", F.concat(F.lit("Placeholder: "), tx.strip(r["content"]))),
            ),
        )
    )
    found = F.filter(F.concat(single, F.coalesce(each, F.array().cast("array<struct<severity:string,check:string,detail:string>>"))), lambda i: i.isNotNull())
    return examples.select("example_id", "task_id", F.explode(found).alias("i")).select("example_id", "task_id", "i.*")


def call_issues(calls: DataFrame, signatures=rd.TOOL_SIGNATURES, typos=rd.TOOL_TYPOS) -> DataFrame:
    """Checks on single tool calls."""
    names = F.array(*[F.lit(t) for t in signatures])
    lists = lambda k: F.create_map(*[x for t, s in signatures.items() for x in (F.lit(t), F.array(*map(F.lit, s[k])).cast("array<string>"))])
    name = F.coalesce("name", F.lit(""))
    known = F.col("valid") & F.array_contains(names, name)
    keys = F.coalesce(F.map_keys("arguments"), F.expr("cast(array() as array<string>)"))
    df = calls.select("*", name.alias("_name"), known.alias("_known"), keys.alias("_keys"))
    df = df.withColumn("_req", F.when(F.col("_known"), F.element_at(lists(0), F.col("_name")))).withColumn("_opt", F.when(F.col("_known"), F.element_at(lists(1), F.col("_name"))))
    issue = lambda severity, check: (lambda detail: F.struct(F.lit(severity).alias("severity"), F.lit(check).alias("check"), detail.alias("detail")))
    nothing = F.expr("cast(array() as array<struct<severity:string,check:string,detail:string>>)")
    meant = F.coalesce(F.element_at(F.create_map(*[x for k, v in typos.items() for x in (F.lit(k), F.lit(v))]), F.col("_name")), F.lit("unknown"))
    covered = F.arrays_overlap("_opt", "_keys")
    missing = F.transform(F.when(covered, F.expr("cast(array() as array<string>)")).otherwise(F.array_except("_req", "_keys")), lambda a: issue("medium", "missing_required_arg")(F.concat("_name", F.lit(": "), a)))
    unknown = F.transform(F.array_except("_keys", F.concat("_req", "_opt")), lambda a: issue("medium", "unknown_arg")(F.concat("_name", F.lit(": "), a)))
    empty = F.transform(F.map_keys(F.map_filter("arguments", lambda k, v: F.coalesce(v, F.lit("")) == "")), lambda a: issue("medium", "empty_arg")(F.concat("_name", F.lit(": "), a)))
    found = (
        F.when(~F.col("valid"), F.array(issue("high", "invalid_tool_json")(F.substring("raw", 1, 100))))
        .when(~F.col("_known"), F.array(issue("critical", "invalid_tool_name")(F.concat("_name", F.lit(" -> "), meant))))
        .otherwise(F.concat(*[F.coalesce(x, nothing) for x in (missing, unknown, empty)]))
    )
    return df.select("example_id", "task_id", F.explode(found).alias("i")).select("example_id", "task_id", "i.*")


def required_tool_issues(examples: DataFrame, required: dict[str, tuple[str, ...]] = rd.REQUIRED_TOOLS) -> DataFrame:
    """Tools that an example's task asks for and it never calls (unknown names count as called)."""
    wanted = F.element_at(F.create_map(*[x for t, r in required.items() for x in (F.lit(t), F.array(*map(F.lit, r)).cast("array<string>"))]), F.col("task_id"))
    lacking = F.array_except(wanted, call_names(F.col("messages"), invalid=None))
    rows = examples.where(F.size("messages") > 0).select("example_id", "task_id", F.explode(lacking).alias("detail"))
    return rows.select("example_id", "task_id", F.lit("high").alias("severity"), F.lit("missing_required_tool").alias("check"), "detail")


def repetition_issues(calls: DataFrame, same_call: int = 3, same_name: int = 20) -> DataFrame:
    """The same call more than ``same_call`` times, the same tool more than ``same_name`` times, per example.

    Calls are the same if their JSON is, by its first 200 characters with sorted keys at every depth: the order of keys
    and white space don't count, types do (1 is not "1", but 1 is 1.0).  A call that has a key twice is compared
    by its arguments as text.  Both counts come from one aggregate, so calls are parsed and shuffled once.
    """
    entries = F.transform(F.array_sort(F.map_entries(F.coalesce("arguments", F.expr("cast(map() as map<string,string>)")))), lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("null"))))
    name = F.coalesce("name", F.lit(""))
    shown = F.substring(F.concat(name, F.lit("("), F.array_join(entries, ","), F.lit(")")), 1, 200)
    same = F.substring(F.coalesce(F.to_json(F.try_parse_json("raw")), shown), 1, 200)
    key = ["example_id", "task_id", "name"]
    counted = calls.where("valid").select("example_id", "task_id", name.alias("name"), same.alias("same"), shown.alias("call")).groupBy(*key, "same").agg(F.count("*").alias("n"), F.min("call").alias("call"))
    many = counted.groupBy(*key).agg(F.sum("n").alias("n")).where(F.col("n") > same_name)
    found = lambda rows, severity, check, of: rows.select("example_id", "task_id", F.lit(severity).alias("severity"), F.lit(check).alias("check"), F.concat(F.col("n").cast("string"), F.lit(" x "), of).alias("detail"))
    return found(counted.where(F.col("n") > same_call), "high", "repetitive_tool_calls", F.substring("call", 1, 100)).unionByName(found(many, "medium", "excessive_tool_calls", F.col("name")))


def issues(examples: DataFrame) -> DataFrame:
    """All checks: (example_id, task_id, severity, check, detail)."""
    calls = tool_calls(examples)
    return reduce(DataFrame.unionByName, [message_issues(examples), call_issues(calls), required_tool_issues(examples), repetition_issues(calls)])


def validate_report(examples: DataFrame, found: DataFrame) -> DataFrame:
    """(kind, name, n): examples, clean, with issues, critical or high, and counts by severity and by check."""
    per = found.groupBy("example_id").agg(F.max(F.col("severity").isin(*BAD)).alias("bad"))
    head = examples.select("example_id").join(per, "example_id", "left").agg(
        F.count("*").alias("total"), F.count_if(F.col("bad").isNull()).alias("clean"), F.count_if(F.col("bad").isNotNull()).alias("with_issues"), F.count_if("bad").alias("critical_high")
    )
    top = head.select(F.explode(F.create_map(*[x for c in ("total", "clean", "with_issues", "critical_high") for x in (F.lit(c), F.col(c))])).alias("name", "n")).select(F.lit("examples").alias("kind"), "name", "n")
    by = [found.groupBy(F.col(c).alias("name")).agg(F.count("*").alias("n")).select(F.lit(c).alias("kind"), "name", "n") for c in ("severity", "check")]
    return top.union(by[0]).union(by[1])


def worst_tasks(found: DataFrame, k: int = 10, checks: int = 3) -> DataFrame:
    """Top ``k`` tasks by issues, each with its top checks: (task_id, n, rank, check, check_n, check_rank)."""
    per = found.groupBy("task_id", "check").agg(F.count("*").alias("check_n"))
    tasks = per.groupBy("task_id").agg(F.sum("check_n").alias("n")).orderBy(F.desc("n"), "task_id").limit(k)
    tasks = tasks.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), "task_id")))
    ranked = per.withColumn("check_rank", F.row_number().over(Window.partitionBy("task_id").orderBy(F.desc("check_n"), "check"))).where(F.col("check_rank") <= checks)
    return tasks.join(ranked, "task_id")


def bad_ids(found: DataFrame) -> DataFrame:
    return found.where(F.col("severity").isin(*BAD)).select("example_id").distinct()


def validate_fix(examples: DataFrame, found: DataFrame, tasks: tuple[str, ...] | None = None) -> DataFrame:
    """Without examples that have a critical or high issue; rows outside the task filter stay."""
    bad = bad_ids(found if tasks is None else found.where(F.col("task_id").isin(*tasks)))
    return examples.join(bad, "example_id", "left_anti")


def bad_examples_detail(examples: DataFrame, found: DataFrame, chars: int = 200) -> DataFrame:
    """(example_id, task_id, user_message, issues, calls) of examples with a critical or high issue."""
    found = found.repartition("example_id", "check")
    listed = found.groupBy("example_id").agg(F.sort_array(F.collect_list(F.concat_ws(":", "severity", "check"))).alias("issues"))
    calls = tool_calls(examples).groupBy("example_id").agg(
        F.sort_array(F.collect_list(F.concat(F.coalesce("name", F.lit("?")), F.lit("("), F.coalesce(F.array_join(F.sort_array(F.map_keys("arguments")), ","), F.lit("")), F.lit(")")))).alias("calls")
    )
    bad = examples.join(bad_ids(found), "example_id", "left_semi").select("example_id", "task_id", F.substring(tx.first_user(F.col("messages")), 1, chars).alias("user_message"))
    return bad.join(listed, "example_id").join(calls, "example_id", "left")


def record_check(examples: DataFrame) -> DataFrame:
    """The second, independent validator: one boolean for each structural fault."""
    m = F.col("messages")
    has = lambda r: F.exists(m, lambda x: x["role"] == r)
    return examples.select(
        "example_id", "task_id",
        (~has("system")).alias("no_system"), (~has("user")).alias("no_user"), (~has("assistant")).alias("no_assistant"),
        F.coalesce(tx.last_role(m) != "assistant", F.lit(False)).alias("last_not_assistant"),
        F.exists(m, lambda x: (x["role"] == "user") & (tx.strip(F.coalesce(x["content"], F.lit(""))) == "")).alias("empty_user"),
    )


def no_tool_call(examples: DataFrame, tasks: tuple[str, ...] = rd.TOOL_REQUIRED_TASKS) -> DataFrame:
    """Examples of tool-required tasks without any call."""
    called = F.exists("messages", lambda x: (x["role"] == "assistant") & F.contains(x["content"], F.lit("<tool_call>")))
    return examples.where(F.col("task_id").isin(*tasks) & ~called).select("example_id", "task_id")


def unknown_tools(examples: DataFrame, signatures=rd.TOOL_SIGNATURES) -> DataFrame:
    """(example_id, unknown, n_invalid): names outside the registry and calls that are no JSON."""
    names = call_names(F.col("messages"))
    known = F.array(*[F.lit(t) for t in [*signatures, "__INVALID_JSON__"]])
    out = examples.select("example_id", F.array_except(names, known).alias("unknown"), F.size(F.filter(names, lambda n: n == "__INVALID_JSON__")).alias("n_invalid"))
    return out.where((F.size("unknown") > 0) | (F.col("n_invalid") > 0))


def missing_expected_values(examples: DataFrame, expected: dict[str, tuple[str, ...]] = rd.EXPECTED_VALUES) -> DataFrame:
    """(example_id, task_id, value) that a task's examples should contain somewhere and do not."""
    wanted = F.element_at(F.create_map(*[x for t, v in expected.items() for x in (F.lit(t), F.array(*map(F.lit, v)))]), F.col("task_id"))
    text = F.array_join(F.transform("messages", lambda m: m["content"]), " ")
    rows = examples.where(F.col("task_id").isin(*expected)).select("example_id", "task_id", text.alias("_text"), F.explode(wanted).alias("value"))
    return rows.where(~F.contains("_text", "value")).select("example_id", "task_id", "value")


def short_or_truncated(examples: DataFrame, least: int = 200) -> DataFrame:
    """(example_id, short, truncated) by the second validator's rules, for examples with either."""
    m = F.col("messages")
    chars = F.aggregate(m, F.lit(0).cast("long"), lambda a, x: a + F.coalesce(F.length(x["content"]), F.lit(0)))
    last = F.coalesce(tx.last_assistant(m), F.lit(""))
    end = F.right(tx.rstrip(last), F.lit(1))
    out = examples.select("example_id", (chars < least).alias("short"), ((F.length(last) > 100) & ~F.contains(F.lit(rd.TERMINALS_RECORD), end)).alias("truncated"))
    return out.where("short OR truncated")


def issue_breakdown(found: DataFrame) -> DataFrame:
    return found.groupBy("check").agg(F.count("*").alias("n"), F.count_distinct("example_id").alias("examples"))


def clean_and_resplit(examples: DataFrame, found: DataFrame, share: float = 0.1, least: int = 2, seed: str = "s") -> tuple[DataFrame, DataFrame]:
    """The examples without any issue, split anew into train and val by task, and the breakdown of the issues; these are stored once for both."""
    found = stored(found, "issues")
    clean = examples.join(found.select("example_id").distinct(), "example_id", "left_anti")
    return scores.stratified_split(clean, share, least, seed), issue_breakdown(found)


def structural_summary(examples: DataFrame, found: DataFrame) -> DataFrame:
    """One row: total, clean (no issue at all) and critical (any critical issue)."""
    per = found.groupBy("example_id").agg(F.max(F.col("severity") == "critical").alias("critical"))
    return examples.select("example_id").join(per, "example_id", "left").agg(F.count("*").alias("total"), F.count_if(F.col("critical").isNull()).alias("clean"), F.count_if("critical").alias("critical"))


def exec_quality_signals(log: DataFrame) -> DataFrame:
    """Signals of a replayed trace from its log (example_id, step, tool, status, stderr, empty_file)."""
    of = lambda *t: F.col("tool").isin(*t)
    ok = F.col("status") != "error"
    return log.groupBy("example_id").agg(
        F.coalesce(F.bool_and(F.when(of("write_file"), ok)), F.lit(True)).alias("all_writes_ok"),
        F.coalesce(F.bool_and(F.when(of("run_python", "run_bash", "bash"), ok)), F.lit(True)).alias("all_code_ok"),
        F.bool_and(~F.contains(F.lower("stderr"), F.lit("no such file"))).alias("no_file_not_found"),
        F.coalesce(F.bool_and(F.when(of("write_file"), ~F.col("empty_file"))), F.lit(True)).alias("files_nonempty"),
        F.count("*").alias("n_calls"),
        F.count_distinct("tool").alias("unique_tools"),
        (F.max_by("status", "step") != "error").alias("trace_completed"),
    )


def trace_quality_filter(signals: DataFrame, most_calls: int = 15) -> DataFrame:
    return signals.where(F.col("all_writes_ok") & F.col("all_code_ok") & (F.col("n_calls") <= most_calls) & F.col("trace_completed"))
