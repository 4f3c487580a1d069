"""Parsing generator output, judge responses and task documents."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..shipping import ship_package

MSG = "array<struct<role:string,content:string>>"
GENERATED = f"struct<user_message:string,user:string,prompt:string,turns:{MSG},conversation:{MSG}>"
JUDGE = "struct<score:int,criteria_met:array<int>,issues:array<string>,reasoning:string>"
TOOL_ROLES = ("tool", "tool_result", "function")
_DECODER = json.JSONDecoder()
# Code fences around a reply.
_FENCE_OPEN = re.compile(r"^```(?:json)?\s*", re.MULTILINE)
_FENCE_CLOSE = re.compile(r"\s*```$", re.MULTILINE)


def json_arrays(raw: Column, item: str = GENERATED) -> Column:
    """All JSON arrays of a model's reply merged: those in fenced blocks, else bare ones, else the whole text; null if none parses."""
    kind = f"array<{item}>"
    parse = lambda x: F.from_json(x, kind, {"allowSingleQuotes": "false"})
    merged = lambda texts: F.flatten(F.filter(F.transform(texts, parse), lambda a: a.isNotNull()))
    fenced = merged(F.regexp_extract_all(raw, F.lit(r"(?s)```(?:json)?\s*(\[.*?\])\s*```"), F.lit(1)))
    bare = merged(F.regexp_extract_all(raw, F.lit(r"(?s)\[\s*\{.*\}\s*\]"), F.lit(0)))
    return F.when(F.size(fenced) > 0, fenced).when(F.size(bare) > 0, bare).otherwise(parse(raw))


def parse_example(item: Column) -> Column:
    """A generated object's messages: the user's, then the turns, with tool aliases made one; null under three messages."""
    user = tx.falsy_coalesce(item["user_message"], item["user"], item["prompt"])
    turns = F.coalesce(F.when(F.size(item["turns"]) > 0, item["turns"]), item["conversation"], F.expr(f"cast(array() as {MSG})"))
    known = F.filter(turns, lambda t: t["role"].isin("assistant", "user", *TOOL_ROLES) & (F.coalesce(t["content"], F.lit("")) != ""))
    rest = F.transform(known, lambda t: F.struct(F.when(t["role"].isin(*TOOL_ROLES), "tool").otherwise(t["role"]).alias("role"), t["content"].alias("content")))
    messages = F.concat(F.array(F.struct(F.lit("user").alias("role"), user.alias("content"))), rest)
    return F.when(user.isNotNull() & (F.size(messages) >= 3), messages)


def request_id(c: Column) -> dict[str, Column]:
    """Columns of ``kind__task__variation__number``."""
    p = F.split(c, "__")
    return {"kind": F.get(p, 0), "task_id": F.get(p, 1), "variation_id": F.get(p, 2), "request_no": F.get(p, 3).try_cast("int")}


def parse_generated(replies: DataFrame) -> DataFrame:
    """(custom_id, status, raw_text) -> one row per example object: task_id, messages (null if it cannot be used), source.

    Replies that failed or hold no array give one row with null ``item_no``.
    """
    df = replies.withColumns(request_id(F.col("custom_id"))).withColumn("items", F.when(F.col("status") == "succeeded", json_arrays(F.col("raw_text"))))
    rows = df.select("custom_id", "status", "task_id", "variation_id", "items", F.posexplode_outer("items").alias("item_no", "item"))
    return rows.select("custom_id", "status", "task_id", "variation_id", F.col("items").isNotNull().alias("parsed"), "item_no", parse_example(F.col("item")).alias("messages"), F.lit("generated").alias("source"))


def collect_report(parsed: DataFrame, val_share: int = 5, most_val: int = 5) -> DataFrame:
    """By task: API errors, parse failures, rejected objects, added rows and how they split into train and val."""
    once = F.coalesce("item_no", F.lit(0)) == 0
    g = parsed.groupBy("task_id").agg(
        F.count_if(once & (F.col("status") != "succeeded")).alias("api_errors"),
        F.count_if(once & (F.col("status") == "succeeded") & ~F.col("parsed")).alias("parse_failures"),
        F.count_if(F.col("item_no").isNotNull() & F.col("messages").isNull()).alias("rejected"),
        F.count("messages").alias("added"),
    )
    val = F.when(F.col("added") > 0, F.least(F.lit(most_val), F.greatest(F.lit(1), F.floor(F.col("added") / val_share)))).otherwise(F.lit(0))
    return g.withColumn("val", val).withColumn("train", F.col("added") - F.col("val"))


def normalise_judge_response(raw: Column) -> Column:
    """A judge's reply as a struct; what cannot be parsed has score 0 and an error."""
    bare = F.regexp_replace(raw, r"^\s*```(?:json)?\s*|\s*```\s*$", "")
    p = tx.strict_json(bare, JUDGE)
    return F.struct(
        F.coalesce(p["score"], F.lit(0)).alias("score"), F.coalesce(p["criteria_met"], F.expr("cast(array() as array<int>)")).alias("criteria_met"), F.coalesce(p["issues"], F.expr("cast(array() as array<string>)")).alias("issues"),
        F.coalesce(p["reasoning"], F.lit("")).alias("reasoning"), F.when(p.isNull(), "unparsable reply").alias("error"),
    )


def first_object(text: str | None) -> str | None:
    """The first JSON object in a text, as canonical JSON; null where there is none.

    Code fences at line starts and line ends go.  Then the whole text is tried, every brace in
    turn as the start of an object, and at last the span from the first to the last brace
    without its trailing commas.
    """
    bare = _FENCE_CLOSE.sub("", _FENCE_OPEN.sub("", (text or "").strip()).strip()).strip()
    value = _parsed(bare)
    at = bare.find("{")
    first, last = at, bare.rfind("}")
    while value is None and at >= 0:
        try:
            value = _DECODER.raw_decode(bare, at)[0]
        except (ValueError, RecursionError):
            at = bare.find("{", at + 1)
    if value is None and 0 <= first < last:
        value = _parsed(re.sub(r",\s*([}\]])", r"\1", bare[first : last + 1]))
    return None if value is None else json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def _parsed(text: str) -> dict | None:
    try:
        value = json.loads(text)
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def extract_json_object(df: DataFrame, raw: str, into: str = "object") -> DataFrame:
    """Add the first JSON object of a text column (the brace scan needs an Arrow batch function)."""

    ship_package(df.sparkSession)

    @F.pandas_udf("string")
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield b.map(first_object)

    return df.withColumn(into, scan(F.col(raw)))


# ---- task documents ----------------------------------------------------------------


def front_matter(body: Column) -> Column:
    """``key: value`` lines between leading ``---`` lines, as a map (a later key wins)."""
    block = F.regexp_extract(body, r"(?s)\A---\n(.*?)\n---", 1)
    pairs = F.filter(F.transform(F.split(block, "\n"), lambda x: F.split(x, r":\s*", 2)), lambda p: F.size(p) == 2)
    entries = F.transform(pairs, lambda p: F.struct(F.trim(F.get(p, 0)).alias("key"), F.trim(F.get(p, 1)).alias("value")))
    last = F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.size(entries)), lambda o: o["key"] == e["key"]))
    return F.map_from_entries(last)


def sections(docs: DataFrame) -> DataFrame:
    """(doc_id, heading, content): markdown sections of levels 1 to 3 by lower-cased heading; the last of a name counts."""
    body = F.regexp_replace("body", r"(?s)\A---\n.*?\n---\n?", "")
    parts = docs.select("doc_id", F.posexplode(F.split(body, r"(?m)^(?=#{1,3} )")).alias("no", "part")).where(F.col("part").rlike(r"^#{1,3} "))
    rows = parts.select("doc_id", "no", F.lower(F.trim(F.regexp_extract("part", r"^#{1,3} +([^\n]*)", 1))).alias("heading"), tx.strip(F.regexp_replace("part", r"^#{1,3} [^\n]*\n?", "")).alias("content"))
    return rows.groupBy("doc_id", "heading").agg(F.max_by("content", "no").alias("content"))


#: Where documents name the files they expect.  ``[^\n]`` stands for a dot, since Java's dot also stops at other line ends.
FILE_PATTERNS = (
    r"(?i)(?:Output|File|Save|Write|Create)[^\n]*?[`\"]([a-zA-Z0-9_./\-]+\.[a-z]{1,5})[`\"]",
    r"(?i)(?:save|write|create)[^\n]*?(?:as|to|called)\s+[`\"]?([a-zA-Z0-9_./\-]+\.[a-z]{1,5})[`\"]?",
    r"(?i)\*\*(?:Output|File)\*\*:\s*`([^`]+)`",
)


def expected_files(body: Column) -> Column:
    found = F.concat(*[F.regexp_extract_all(body, F.lit(p), F.lit(1)) for p in FILE_PATTERNS])
    return F.array_distinct(F.filter(found, lambda x: ~F.startswith(x, F.lit("http"))))


def expected_values(body: Column) -> Column:
    """Answers in table rows ``| number | answer |`` and quoted words after expected, must, should or correct (fixed patterns)."""
    cells = F.filter(F.transform(F.regexp_extract_all(body, F.lit(r"\|\s*\d+\s*\|\s*([^\n]+?)\s*\|"), F.lit(1)), tx.strip), lambda v: (v != "") & (v != "Expected Answer") & ~F.startswith(v, F.lit("---")))
    quoted = F.transform(F.regexp_extract_all(body, F.lit(r"(?i)(?:expected|must|should|correct)[^\n]*?[`\"]([^`\"]+)[`\"]"), F.lit(1)), tx.strip)
    return F.concat(cells, F.filter(quoted, lambda v: (v != "") & (F.length(v) < 100)))


def map_task_ids(rows: DataFrame, mapping: DataFrame, column: str = "task_id") -> DataFrame:
    """External ids to internal ones by a small mapping (external, internal); others stay."""
    m = F.broadcast(mapping.select(F.col("external").alias(column), F.col("internal").alias("_internal")))
    return rows.join(m, column, "left").withColumn(column, F.coalesce("_internal", column)).drop("_internal")


def flatten_diagnosis(causes: DataFrame, fixes: DataFrame) -> DataFrame:
    """``causes`` (diagnosis_id, cause, fix, task_id) and ``fixes`` (task_id, action, reason) -> one row per task.

    Several causes are joined by ``; ``; the last fix gives action and reason; a task with a
    fix alone takes its reason as cause.
    """
    each = lambda c: F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("diagnosis_id", c))), lambda x: x[c]), "; ")
    a = causes.distinct().groupBy("task_id").agg(each("cause").alias("root_cause"), each("fix").alias("fix"))
    b = fixes.groupBy("task_id").agg(F.max_by("action", "reason").alias("action"), F.max("reason").alias("reason"))
    j = a.join(b, "task_id", "full_outer")
    return j.select("task_id", F.coalesce("root_cause", "reason").alias("root_cause"), F.coalesce("fix", F.concat(F.lit("Action: "), "action")).alias("fix"), F.coalesce("reason", F.lit("")).alias("reason"), "action")
