"""Projections of conversations and tool calls (the shared views of all later operators).

An *example* is a row (example_id, task_id, messages array<struct<role,content>>, ...).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..refdata import WRITE_TOOLS

CALL = "struct<name:string,arguments:map<string,string>>"


def messages(examples: DataFrame) -> DataFrame:
    """One row per message: (example_id, task_id, turn, role, content)."""
    return examples.select("example_id", "task_id", F.posexplode("messages").alias("turn", "m")).select("example_id", "task_id", "turn", "m.role", "m.content")


def tool_calls(examples: DataFrame) -> DataFrame:
    """One row per ``<tool_call>`` block of assistant messages, invalid ones kept.

    (example_id, task_id, turn, call_no, raw, valid, name, arguments); ``raw`` of an
    invalid call is cut to 200 characters, ``name`` and ``arguments`` are then null.
    """
    said = examples.select("example_id", "task_id", F.posexplode("messages").alias("turn", "m")).where("m.role = 'assistant'")
    blocks = said.select("example_id", "task_id", "turn", F.posexplode(F.regexp_extract_all("m.content", F.lit(tx.CALL_PATTERN), F.lit(1))).alias("call_no", "raw"))
    parsed = blocks.withColumn("call", tx.strict_json(F.col("raw"), CALL))
    valid = F.col("call").isNotNull()
    return parsed.select(
        "example_id", "task_id", "turn", "call_no", F.when(valid, F.col("raw")).otherwise(F.substring("raw", 1, 200)).alias("raw"), valid.alias("valid"), F.col("call.name").alias("name"), F.col("call.arguments").alias("arguments")
    )


def first_user_message(examples: DataFrame) -> DataFrame:
    return examples.withColumn("user_message", tx.first_user(F.col("messages")))


def score_key(examples: DataFrame) -> DataFrame:
    """Add the two-column score key (task_id, user_prefix)."""
    return examples.withColumn("user_prefix", F.substring(tx.first_user(F.col("messages")), 1, tx.FIRST_USER))


def call_names(messages_: Column, invalid: str | None = "__INVALID_JSON__") -> Column:
    """Names of all tool calls in order; blocks that are no JSON give ``invalid`` or are left out."""
    blocks = F.flatten(F.transform(tx.of_role(messages_, "assistant"), lambda m: F.regexp_extract_all(m["content"], F.lit(tx.CALL_PATTERN), F.lit(1))))
    calls = F.transform(blocks, lambda raw: F.struct(tx.strict_json(raw, CALL).alias("c")))
    if invalid is None:
        calls = F.filter(calls, lambda c: c["c"].isNotNull())
        return F.transform(calls, lambda c: F.coalesce(c["c"]["name"], F.lit("")))
    return F.transform(calls, lambda c: F.when(c["c"].isNull(), F.lit(invalid)).otherwise(F.coalesce(c["c"]["name"], F.lit(""))))


def tool_names(examples: DataFrame) -> DataFrame:
    return examples.withColumn("tool_names", call_names(F.col("messages")))


def name_set(messages_: Column) -> Column:
    """Distinct ``"name": "..."`` values anywhere in assistant text, also inside arguments."""
    found = F.transform(tx.of_role(messages_, "assistant"), lambda m: F.regexp_extract_all(m["content"], F.lit(r'"name"\s*:\s*"(\w+)"'), F.lit(1)))
    return F.array_distinct(F.flatten(found))


def tool_name_set_regex(examples: DataFrame) -> DataFrame:
    return examples.withColumn("tool_set", name_set(F.col("messages")))


def written_files(calls: DataFrame) -> DataFrame:
    """(example_id, path) of files and folders that an example creates."""
    return calls.where(F.col("valid") & F.col("name").isin("write_file", "create_directory")).select("example_id", F.col("arguments")["path"].alias("path")).where("path <> ''")


def tool_sequence(examples: DataFrame) -> DataFrame:
    """Valid calls' names in order and the signature of the first three."""
    seq = call_names(F.col("messages"), invalid=None)
    return examples.withColumn("tool_sequence", seq).withColumn("signature", F.slice("tool_sequence", 1, 3))


def last_assistant_message(examples: DataFrame) -> DataFrame:
    return examples.withColumn("last_assistant", tx.last_assistant(F.col("messages")))


def has_final_summary(messages_: Column) -> Column:
    last = tx.last_assistant(messages_)
    return F.coalesce(~F.contains(last, F.lit("<tool_call>")) & (F.length(last) > 20), F.lit(False))


def has_error_recovery(messages_: Column) -> Column:
    return F.exists(messages_, lambda m: m["role"].isin("tool") & F.lower(m["content"]).rlike("error|failed|not found"))


def ends_with_write(messages_: Column, write_tools: tuple[str, ...] = WRITE_TOOLS) -> Column:
    names = call_names(messages_, invalid=None)
    tail = F.when(F.size(names) >= 2, F.slice(names, -2, 2)).otherwise(names)
    return F.arrays_overlap(tail, F.array(*map(F.lit, write_tools)))


def size_features(examples: DataFrame) -> DataFrame:
    """turns, assistant_turns, total_chars, token_estimate (chars // 4), n_tool_calls, single_tool (at most one)."""
    m = F.col("messages")
    out = examples.select(
        "*",
        F.size(m).alias("turns"),
        F.size(tx.of_role(m, "assistant")).alias("assistant_turns"),
        F.aggregate(m, F.lit(0).cast("long"), lambda a, x: a + F.coalesce(F.length(x["content"]), F.lit(0))).alias("total_chars"),
        F.size(call_names(m)).alias("n_tool_calls"),
    )
    return out.withColumn("token_estimate", F.floor(F.col("total_chars") / 4)).withColumn("single_tool", F.col("n_tool_calls") <= 1)


def sft_convert(examples: DataFrame) -> DataFrame:
    """Chat format for fine-tuning: contents stripped, tool results as user turns in a tag, equal neighbours merged."""
    plain = F.transform(
        "messages",
        lambda m: F.when(
            m["role"].isin("tool"), F.struct(F.lit("user").alias("role"), F.concat(F.lit("<tool_result>\n"), tx.strip(m["content"]), F.lit("\n</tool_result>")).alias("content"))
        ).otherwise(F.struct(m["role"].alias("role"), tx.strip(m["content"]).alias("content"))),
    )

    def fold(acc: Column, m: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        merged = F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(m["role"].alias("role"), F.concat(last["content"], F.lit("\n\n"), m["content"]).alias("content"))))
        return F.when(last["role"] == m["role"], merged).otherwise(F.concat(acc, F.array(m)))

    empty = F.expr("cast(array() as array<struct<role:string,content:string>>)")
    return examples.withColumn("messages", F.aggregate(plain, empty, fold))


def sft_keep(examples: DataFrame) -> DataFrame:
    """Examples fit for fine-tuning: a leading system message, and both user (or tool) and assistant turns."""
    m = F.col("messages")
    return examples.where((F.size(m) > 0) & (F.get(m, 0)["role"] == "system") & F.exists(m, lambda x: x["role"].isin("user", "tool")) & F.exists(m, lambda x: x["role"] == "assistant"))


def render_transcript(examples: DataFrame, cap: int = 1500) -> DataFrame:
    """A judge's view: no system message, long messages cut with a marker, blocks headed by the role."""

    def block(m: Column) -> Column:
        body = F.when(F.length(m["content"]) > cap, F.concat(F.substring(m["content"], 1, cap), F.lit("\n[... "), (F.length(m["content"]) - cap).cast("string"), F.lit(" chars truncated ...]"))).otherwise(m["content"])
        return F.concat(F.lit("["), F.upper(m["role"]), F.lit("]\n"), body)

    shown = F.filter("messages", lambda m: m["role"] != "system")
    return examples.withColumn("transcript", F.array_join(F.transform(shown, block), "\n\n"))


def head_tail(c: Column, budget: int, marker: str = "\n... [truncated] ...\n") -> Column:
    """A text over ``budget`` keeps its first third and its last two thirds of it."""
    return F.when(F.length(c) > budget, F.concat(F.substring(c, 1, budget // 3), F.lit(marker), F.right(c, F.lit(budget * 2 // 3)))).otherwise(c)
