"""Hand-written cases and small models of the order-dependent operators."""

import random

import pytest
from pyspark.sql import functions as F

from sievework.operators import decisions as de
from sievework.operators import dedup as dd
from sievework.operators import features as ft
from sievework.operators import logs as lg
from sievework.operators import parsing as ps
from sievework.operators import scores as sc
from sievework.operators import validate as va
from sievework.sources import io

EX = "example_id long, pos long, task_id string, split string, source string, messages array<struct<role:string,content:string>>"


def example(spark, *chats, task="task_05"):
    return spark.createDataFrame([(i, i, task, "train", None, m) for i, m in enumerate(chats)], EX)


def call(name, args):
    return f'<tool_call>{{"name": "{name}", "arguments": {args}}}</tool_call>'


def checks(spark, chat, task="task_05"):
    return sorted(r["check"] for r in va.issues(example(spark, chat, task=task)).collect())


GOOD = [("system", "s" * 200), ("user", "do it"), ("assistant", call("read_file", '{"path": "a"}')), ("tool", "ok"), ("assistant", call("write_file", '{"path": "a", "content": "b"}')), ("tool", "ok"), ("assistant", "Done.")]


def swap(i, *m):
    return [*GOOD[:i], *m, *GOOD[i + 1 :]]


@pytest.mark.parametrize(
    ("chat", "found"),
    [
        (GOOD, []),
        ([], ["empty_messages"]),
        (GOOD[1:], ["missing_system", "very_short_content"]),
        (GOOD[:-1], ["no_final_assistant"]),
        (swap(1, ("user", " \n")), ["empty_user_message"]),
        (swap(1), ["no_user_message"]),
        (swap(2, ("assistant", "<tool_call>{'name': 'read_file'}</tool_call>")), ["invalid_tool_json", "missing_required_tool"]),
        (swap(2, ("assistant", '<tool_call>{"name": "read_file"} junk</tool_call>')), ["invalid_tool_json", "missing_required_tool"]),
        (swap(2, ("assistant", call("read", '{"path": "a"}'))), ["invalid_tool_name", "missing_required_tool"]),
        (swap(2, ("assistant", call("read_file", '{"file_path": "a"}'))), []),
        (swap(2, ("assistant", call("read_file", "{}"))), ["missing_required_arg"]),
        (swap(2, ("assistant", call("read_file", '{"path": null, "x": "1"}'))), ["empty_arg", "unknown_arg"]),
        (swap(2, *[("assistant", call("read_file", '{"path": "a"}'))] * 3), []),
        (swap(2, *[("assistant", call("read_file", '{"path": "a"}'))] * 4), ["repetitive_tool_calls"]),
        (swap(2, *[("assistant", call("read_file", f'{{"path": "{i}"}}')) for i in range(20)]), []),
        (swap(2, *[("assistant", call("read_file", f'{{"path": "{i}"}}')) for i in range(21)]), ["excessive_tool_calls"]),
        (swap(6, ("assistant", "w" * 100)), []),
        (swap(6, ("assistant", "w" * 101)), ["truncated_response"]),
        *[(swap(6, ("assistant", "w" * 101 + c + " \n")), []) for c in ".!?\"')}>"],
        (swap(6, ("assistant", " ")), ["empty_assistant"]),
        (swap(3, ("tool", "")), ["empty_tool_result"]),
        (swap(3, ("tool", " TODO ")), ["placeholder_tool_result"]),
    ],
)
def test_validators(spark, chat, found):
    assert checks(spark, chat) == found


def test_short_conversations_and_the_exempt_task(spark):
    chat = [("system", "s"), ("user", "u"), ("assistant", "a")]
    assert checks(spark, chat, "task_12") == ["too_short", "very_short_content"]
    assert checks(spark, chat, "task_00") == []


def test_sft_fold(spark):
    chat = [("system", " s "), ("user", "a"), ("tool", "t\n"), ("user", "b"), ("assistant", "x"), ("assistant", "y")]
    r = ft.sft_convert(example(spark, chat)).first()["messages"]
    assert [(m["role"], m["content"]) for m in r] == [("system", "s"), ("user", "a\n\n<tool_result>\nt\n</tool_result>\n\nb"), ("assistant", "x\n\ny")]


@pytest.mark.parametrize("seed", range(3))
def test_keep_with_floor_is_the_running_counter(spark, seed):
    r = random.Random(seed)
    rows = [(i, i, f"t{r.randint(0, 3)}", r.choice([None, 1.0, 2.0, 3.0, 5.0])) for i in range(200)]
    want, kept = [], {}
    for i, _, task, score in rows:
        if score is None or score >= 3 or kept.get(task, 0) < 12:
            want.append(i)
            kept[task] = kept.get(task, 0) + 1
    df = spark.createDataFrame(rows, "example_id long, pos long, task_id string, score double").withColumn("scored", F.col("score").isNotNull())
    assert sorted(x["example_id"] for x in sc.keep_with_floor(df, 3, 12).collect()) == want


def test_split_sizes_round_half_even(spark):
    sizes = {1: 1, 2: 2, 20: 2, 25: 2, 35: 4, 45: 4}
    df = spark.createDataFrame([(n * 100 + i, i, f"t{n}") for n in sizes for i in range(n)], "example_id long, pos long, task_id string")
    got = {r["task_id"]: r["n"] for r in sc.stratified_split(df).where("split = 'val'").groupBy("task_id").agg(F.count("*").alias("n")).collect()}
    assert got == {f"t{n}": v for n, v in sizes.items()}


def greedy(n, edges):
    leader, near = {}, {i: set() for i in range(n)}
    for a, b in edges:
        near[a].add(b)
        near[b].add(a)
    for i in range(n):
        if i not in leader:
            leader[i] = i
            for j in near[i]:
                if j > i and j not in leader:
                    leader[j] = i
    return leader


@pytest.mark.parametrize("seed", range(4))
def test_leader_clusters_are_the_greedy_scan(spark, seed):
    r = random.Random(seed)
    n = 30
    edges = sorted({tuple(sorted(r.sample(range(n), 2))) for _ in range(25)}) if seed else [(0, 1), (1, 2), (2, 3), (3, 4)]
    nodes = spark.createDataFrame([(i, i) for i in range(n)], "example_id long, pos long")
    got = {x["example_id"]: x["leader"] for x in dd.leader_clusters(nodes, spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == greedy(n, edges)


def leaders(spark, n, edges, **how):
    nodes = spark.createDataFrame([(i, i) for i in range(n)], "example_id long, pos long")
    return {x["example_id"]: x["leader"] for x in dd.leader_clusters(nodes, spark.createDataFrame(edges, "a long, b long"), **how).collect()}


@pytest.mark.parametrize("finish_edges", [0, 200_000])
def test_leaders_of_a_long_chain(spark, finish_edges):
    edges = [(i, i + 1) for i in range(999)]
    assert leaders(spark, 1000, edges, finish_edges=finish_edges) == greedy(1000, edges)


@pytest.mark.parametrize("seed", range(2))
def test_leaders_in_rounds_are_the_greedy_scan(spark, seed):
    """Trees of chains with some nodes of several earlier neighbours, settled without the last scan."""
    r = random.Random(seed)
    edges = [(max(0, i - r.choice([1, 1, 1, 7])), i) for i in range(1, 120)]
    edges += [tuple(sorted(r.sample(range(120), 2))) for _ in range(10)]
    assert leaders(spark, 120, edges, finish_edges=10 * seed) == greedy(120, edges)


@pytest.mark.parametrize("seed", range(2))
def test_prefix_filter_loses_no_pair(spark, seed):
    r = random.Random(seed)
    rows = [(i, i, "t", " ".join(r.choices([f"w{k}" for k in range(40)], weights=[40 - k for k in range(40)], k=14)), ["a"]) for i in range(60)]
    df = spark.createDataFrame(rows, "example_id long, pos long, task_id string, text string, tools array<string>")
    vectors = dd.tfidf_vectors(df)
    got = {(x["a"], x["b"]) for x in dd.cosine_pairs(vectors, 0.5).collect()}
    by = {}
    for x in vectors.collect():
        by.setdefault(x["example_id"], {})[x["term"]] = x["w"]
    want = {(a, b) for a in by for b in by if a < b and sum(w * by[b].get(t, 0) for t, w in by[a].items()) >= 0.5 - 1e-9}
    assert got == want and want


def near_copies(n, groups, seed=0):
    """Texts of some groups, each with a few words changed, and texts of their own; two tool sets."""
    r = random.Random(seed)
    roots = [r.choices([f"w{k}" for k in range(300)], k=30) for _ in range(groups)]
    out = []
    for i in range(n):
        words = list(r.choice(roots)) if r.random() < 0.8 else r.choices([f"w{k}" for k in range(300)], k=30)
        for _ in range(r.randrange(3)):
            words[r.randrange(30)] = f"x{r.randrange(50)}"
        out.append((i, n - i if i % 2 else i, f"t{i % 2}", " ".join(words), ["a"] if i % 3 else ["a", "b"]))
    return out


TEXTS = "example_id long, pos long, task_id string, text string, tools array<string>"


@pytest.mark.parametrize("budget", [0, 300, 10**9])
def test_leader_scan_is_the_scan_of_all_pairs(spark, budget):
    rows = spark.createDataFrame([*near_copies(120, 4), (900, 900, "t0", " ", []), (901, 901, "t9", "alone", [])], TEXTS)
    reps, _ = dd.fold_copies(rows)
    want = {tuple(x) for x in dd.leader_clusters(reps, dd.duplicate_pairs(rows)).collect()}
    assert {tuple(x) for x in dd.leader_scan(rows, budget=budget).collect()} == want
    assert len({x for _, x in want}) < len(want)


def test_a_group_of_near_copies_does_not_make_all_pairs(spark, monkeypatch):
    """Twenty thousand near copies of a text: the rows that the joins make are counted."""
    twice = [F.when(F.col("id").bitwiseAND(1 << k) > 0, F.lit(f" w{k}")).otherwise(F.lit("")) for k in range(15)]
    text = F.concat(F.lit(" ".join(f"w{k}" for k in range(40))), *twice)
    ids = spark.range(20_000).select(F.col("id").alias("example_id"), F.col("id").alias("pos"), F.lit("t").alias("task_id"), text.alias("text"), F.array(F.lit("a")).alias("tools"))
    made, met = [], dd._met
    monkeypatch.setattr(dd, "_met", lambda one, two: (made.append(met(one, two).count()), met(one, two))[1])
    got = dd.leader_scan(ids).groupBy("leader").count().collect()
    assert [tuple(r) for r in got] == [(0, 20_000)] and sum(made) < 1_000_000


SIGNALS = [
    ("t", 0.9, 5.0, 29, 0.0, False, "GENERATE"),
    ("t", 0.3, 5.0, 101, 0.0, False, "TRIM"),
    ("t", 0.3, 5.0, 100, 0.0, False, "REGENERATE"),
    ("t", 0.31, 5.0, 80, 0.9, True, "LEAVE_ALONE"),
    ("t", 0.5, 5.0, 79, 0.7, True, "INVESTIGATE"),
    ("t", 0.8, 5.0, 30, 0.0, False, "LEAVE_ALONE"),
    ("task_02", 0.0, 4.5, 50, 0.0, False, "INFRASTRUCTURE"),
    ("t", 0.0, 4.5, 50, 0.0, False, "REGENERATE"),
    ("t", 0.2, 3.4, 40, 0.0, False, "REGENERATE"),
    ("t", 0.2, 0.0, 50, 0.0, False, "ADVERSARIAL"),
    ("t", 0.2, 3.5, 50, 0.0, False, "GENERATE"),
    ("t", 0.5, 3.5, 50, 0.0, False, "LEAVE_ALONE"),
]


def test_decisions(spark):
    df = spark.createDataFrame(SIGNALS, "task_id string, bench double, judge double, n int, prev double, regressed boolean, want string")
    assert [r["recommendation"] for r in de.recommend_actions(df).collect()] == [s[-1] for s in SIGNALS]


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ('```json\n{"a": 1}\n```', '{"a":1}'),
        ('noise {"a": {"b": "}"}} more }', '{"a":{"b":"}"}}'),
        ('{"a": [1, 2,], }', '{"a":[1,2]}'),
        ('{"a": "\\"}"} x', '{"a":"\\"}"}'),
        ("[1, 2]", None),
        ("", None),
        (None, None),
    ],
)
def test_first_object(text, found):
    assert ps.first_object(text) == found


def test_json_arrays(spark):
    one = '{"user_message": "u", "turns": []}'
    cases = [f"```json\n[{one}]\n``` and ```\n[{one}, {one}]\n```", f"text [{one}] text", f"[{one}]", "[{broken", ""]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, raw string")
    got = df.select("i", F.size(ps.json_arrays(F.col("raw"))).alias("n")).orderBy("i").collect()
    assert [max(r["n"], 0) if r["n"] is not None else 0 for r in got] == [3, 1, 1, 0, 0]


def test_score_dialects(spark):
    lines = ["Task task_01: 0.53/1.0 (53%)", "Task task_02: 40/100 (40%)", "task_03 = 0.7", '"task_04": 1.0', "task_99: 0.5/1.0", "Task task_01: 0.6/1.0"]
    log = spark.createDataFrame([(1, i, x) for i, x in enumerate(lines)], "run_id int, line_no int, line string")
    tasks = spark.createDataFrame([(f"task_{i:02d}",) for i in range(5)], "task_id string")
    assert {r["task_id"]: r["score"] for r in lg.scores_of_lines(log, tasks).collect()} == {"task_01": 0.6, "task_02": 0.4, "task_03": 0.7, "task_04": 1.0}


def test_scans_of_bad_lines(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"task_id": "t", "messages": []}\n\n{bad json\n{"messages": []}\n')
    path = f"file://{tmp_path}/a.jsonl"
    assert io.scan_tolerant(spark, path).count() == 2
    assert {r["task_id"]: r["n"] for r in io.scan_corrupt_counts(spark, path).collect()} == {"t": 1, "__corrupt__": 1, "unknown": 1}
    with pytest.raises(Exception, match="(?i)malformed|failfast"):
        io.scan_strict(spark, path).collect()


def test_task_documents(spark, tmp_path):
    (tmp_path / "task_01.md").write_text("---\nid: task_01\nname: x: y\n---\n# Prompt\nSave as `a.txt`\n## Prompt\nlater\n### Check\n| 1 | 42 |\n")
    (tmp_path / "other.md").write_text("no")
    docs = io.scan_task_docs(spark, f"file://{tmp_path}").withColumn("doc_id", F.lit(1))
    r = docs.select(ps.front_matter(F.col("body")).alias("m"), ps.expected_files(F.col("body")).alias("f"), ps.expected_values(F.col("body")).alias("v")).collect()
    assert len(r) == 1 and r[0]["m"] == {"id": "task_01", "name": "x: y"} and r[0]["f"] == ["a.txt"] and r[0]["v"] == ["42"]
    assert {x["heading"]: x["content"] for x in ps.sections(docs).collect()} == {"prompt": "later", "check": "| 1 | 42 |"}


def test_latest_log(spark, tmp_path):
    import os

    for i, name in enumerate(("b.log", "a.log")):
        (tmp_path / name).write_text(f"one\n{name}\n")
        os.utime(tmp_path / name, (1000 + i, 1000 + i))
    rows = io.scan_log(spark, f"file://{tmp_path}", latest=True).orderBy("line_no").collect()
    assert [(r["run_id"], r["line_no"], r["line"]) for r in rows] == [("a.log", 0, "one"), ("a.log", 1, "a.log")]


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ('I use {foo} first. {"a": 1}', '{"a":1}'),
        ('{"a": "```json"}', '{"a":"```json"}'),
        ('{ open {"a": {"b": 2}} and {', '{"a":{"b":2}}'),
        ('x {"a": [1,], } y', '{"a":[1]}'),
        ('first {"a": 1} then {"b": 2}', '{"a":1}'),
        ("{" * 5000, None),
    ],
)
def test_every_brace_is_tried(text, found):
    assert ps.first_object(text) == found


@pytest.mark.parametrize("limit", [0, 1, 7, 60, 1000])
def test_mark_first_is_a_rank(spark, limit):
    r = random.Random(limit)
    rows = [(i, r.choice(["hot", "hot", "a", "b", None]), r.randint(0, 10**9)) for i in range(300)]
    df = spark.createDataFrame(rows, "i long, k string, o long")
    got = {x["i"] for x in sc.mark_first(df, ["k"], [F.col("o"), F.col("i")], F.floor(F.col("o") / 1e8), None, F.lit(limit)).where("_in").collect()}
    want = set()
    for k in {x[1] for x in rows}:
        want |= {i for _, i in sorted((o, i) for i, own, o in rows if own == k)[:limit]}
    assert got == want


def test_first_rows_of_a_task_whose_positions_have_gaps(spark, monkeypatch):
    """Positions in partitions 2**33 apart, as monotonic ids have: few rows are ranked for one task with most rows."""
    df = spark.range(0, 40_000, 1, 8).select(F.monotonically_increasing_id().alias("pos"), F.col("id").alias("example_id"), F.when(F.col("id") % 10 == 0, "b").otherwise("hot").alias("task_id"))
    tables = {}
    monkeypatch.setattr(sc, "stored", lambda x, label: tables.setdefault(label, io.stored(x, label)))
    got = sc.mark_first(df, ["task_id"], [F.col("pos"), F.col("example_id")], F.col("pos"), None, F.lit(12_345))
    assert {r["task_id"]: r["count"] for r in got.where("_in").groupBy("task_id").count().collect()} == {"hot": 12_345, "b": 4000}
    want = df.where("task_id = 'hot'").orderBy("pos").limit(12_345).agg(F.max("pos")).first()[0]
    assert got.where("_in AND task_id = 'hot'").agg(F.max("pos")).first()[0] == want
    near = tables["order"].join(tables["bounds"].where("NOT _all"), "task_id").where("_p BETWEEN _low AND _high").count()
    assert 0 < near <= 36  # of 36,000 rows, a thousandth


@pytest.mark.parametrize("width", [1, 7, 10_000])
def test_running_values_are_those_of_one_window(spark, width):
    from sievework.operators import running as ru

    r = random.Random(width)
    rows = [(r.choice([1, 1, 1, 2, None]), i * r.choice([1, 1, 50]) + 1000 * i, r.randint(-5, 9), r.choice([None, 1, 5, 9])) for i in range(200)]
    df = spark.createDataFrame(rows, "k long, t long, x long, y long")
    w = sc.Window.partitionBy("k").orderBy("t").rowsBetween(sc.Window.unboundedPreceding, 0)
    want = df.withColumns({"s": F.sum("x").over(w), "m": F.max("y").over(w)}).collect()
    got = ru.running(df, "k", "t", width * 500, s=("sum", F.col("x")), m=("max", F.col("y"))).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    numbered = ru.running(df, "k", "t", 5, i=("sum", F.lit(1)))
    three = sc.Window.partitionBy("k").orderBy("t").rowsBetween(-2, 0)
    got = ru.sliding(numbered, "k", "i", 3, max(width, 3), n=F.count("*"), s=F.sum("x")).drop("i").collect()
    assert sorted(map(repr, got)) == sorted(map(repr, df.withColumns({"n": F.count("*").over(three), "s": F.sum("x").over(three)}).collect()))


def test_sections_of_one_long_log(spark):
    """A million lines of one run: every task numbers a part of them."""
    n = 1_000_000
    line = F.when(F.col("id") % 1000 == 5, F.concat(F.lit("starting task: task_"), (F.col("id") % 23).cast("string"))).when(F.col("id") % 1000 == 9, "Notes: fine").otherwise("tool_call")
    log = spark.range(n).select(F.lit("r").alias("run_id"), F.col("id").alias("line_no"), line.alias("line"))
    found = lg.failure_patterns(lg.section_lines(log))
    row = found.agg(F.count("*"), F.max("section"), F.count_if("excessive_tool_calls"), F.count_if(F.col("notes") == "fine")).first()
    assert tuple(row) == (1000, 1000, 1000, 1000)
    assert lg.section_lines(log).count() == n - 5


def test_a_map_in_one_file_is_read_by_several_tasks(spark, tmp_path):
    """200,000 scores with keys and texts that hold every sign the reader cuts or counts by."""
    import json

    odd = ['a, "b" {c} [d]', "\\\\", 'end\\\\"', "x,y,,", "}{", '"', "é,漢", "line\nbreak, and tab\t"]
    scores = {f"task_{i % 23:02d}|{odd[i % 8]} {i}": {"score": i % 6, "issues": [odd[(i + k) % 8] for k in range(i % 3)], "error": odd[i % 5] if i % 7 == 0 else None} for i in range(200_000)}
    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "scores.json").write_text(json.dumps(scores, indent=2))
    spark.conf.set("spark.sql.files.maxPartitionBytes", 1 << 20)
    try:
        got = io.scan_scores(spark, f"file://{tmp_path}/s")
        assert spark.read.option("lineSep", ",").text(f"file://{tmp_path}/s").rdd.getNumPartitions() >= 8
        rows = {f"{r['task_id']}|{r['user_prefix']}": (r["score"], r["issues"], r["error"]) for r in got.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert rows == {k: (v["score"], v["issues"], v["error"]) for k, v in scores.items()}
    for n, text in enumerate(["{}", " {\n}\n", '{"m": 0.5}', '{"a":1.0,"b":0.25}\n']):
        (tmp_path / f"m_run{n}.scores.json").write_text(text)
    got = io.scan_run_scores(spark, f"file://{tmp_path}/m_run*.scores.json").collect()
    assert sorted(tuple(r) for r in got) == [("m", 2, "m", 0.5), ("m", 3, "a", 1.0), ("m", 3, "b", 0.25)]


def test_long_posting_lists_meet_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(dd, "POSTINGS", 3)
    test_prefix_filter_loses_no_pair(spark, 5)


def test_operators_by_name(spark):
    from sievework.operators.registry import OPERATORS, apply

    assert {"validate_fix", "rebalance", "filter_min_score", "cosine_pairs", "scores_of_lines"} <= set(OPERATORS)
    df = spark.createDataFrame([("a", 1), ("b", 2)], "task_id string, x int")
    assert apply(df, "filter_by_task", task="b").collect()[0]["x"] == 2
    with pytest.raises(KeyError):
        apply(df, "no_such_operator")


def test_score_with_resumes_and_survives_a_bad_scorer(spark):
    import pandas as pd

    from sievework.operators.registry import score_with

    ex = spark.createDataFrame([(0, "t", "p", "x"), (1, "t", "p", "y"), (2, "t", "q", "zz")], "pos long, task_id string, user_prefix string, text string")
    known = spark.createDataFrame([("t", "p", 4)], "task_id string, user_prefix string, score int")
    rows = score_with(ex, lambda b: pd.DataFrame({"score": b.str.len()}), known).collect()
    assert sorted((r["user_prefix"], r["score"]) for r in rows) == [("p", 4), ("q", 2)]

    def broken(batch):
        raise ValueError("no model")

    assert {(r["score"], r["error"]) for r in score_with(ex, broken).collect()} == {(0, "no model")}

    def picky(batch):
        if "y" in set(batch):
            raise ValueError("not this one")
        return pd.DataFrame({"score": batch.str.len()})

    many = spark.createDataFrame([(i, "t", f"p{i}", "y" if i == 3 else "x" * i) for i in range(1, 9)], ex.schema).coalesce(1)
    got = {r["user_prefix"]: (r["score"], r["error"]) for r in score_with(many, picky).collect()}
    assert got == {f"p{i}": (i, None) if i != 3 else (0, "not this one") for i in range(1, 9)}


def test_reviews_by_task(spark):
    """Replies of all kinds; a reviewer that fails for one task costs that task alone."""
    from sievework.operators.registry import review_with

    chats = [(i, i, t, "train", None, GOOD) for i, t in enumerate(["a"] * 9 + ["b"] * 2 + ["c", "d", "e"])]
    ex = spark.createDataFrame(chats, EX)
    truth = spark.createDataFrame([(t, f"do {t}") for t in "abc"], "task_id string, truth string")

    def reviewer(tasks):
        if "c" in set(tasks["task_id"]):
            raise ValueError("no model for c")
        assert all(len(s) <= 3 and list(s[0]["tools"]) == ["read_file", "write_file"] and list(s[0]["written"]) == ["a"] and s[0]["final"] == "Done." for s in tasks["sample"])
        return ['```json\n{"verdict": "NEEDS_WORK", "issues": ["i"], "recommendation": "r"}\n```' if t == "a" else "[1] is no verdict" for t in tasks["task_id"]]

    known = spark.createDataFrame([("e", "BAD")], "task_id string, verdict string")
    got = {r["task_id"]: r for r in review_with(ex, truth, reviewer, known).collect()}
    assert {k: (r["verdict"], r["skipped"]) for k, r in got.items()} == {"a": ("NEEDS_WORK", None), "b": ("UNKNOWN", None), "c": (None, "no model for c"), "d": (None, "no ground truth"), "e": ("BAD", None)}
    assert got["a"]["issues"] == ["i"] and got["a"]["recommendation"] == "r" and got["b"]["reasoning"] == "[1] is no verdict"


def test_same_calls_by_their_typed_arguments(spark):
    """Key order and space don't tell calls apart, also inside arguments; types do; a doubled key falls back to text."""
    nested = ['{"q": {"a": 1, "b": [1, null]}, "r": "x"}', '{"r":"x","q":{"b":[1,null],"a":1}}', '{"q": {"b": [1, null], "a": 1}, "r": "x"}', '{"r": "x", "q": {"a": 1,   "b": [1, null]}}']
    cases = {
        "nested": nested,
        "types": ['{"k": 1}', '{"k": "1"}'] * 2,
        "nulls": ['{"k": null}', '{"k": "null"}'] * 2,
        "numbers": ['{"k": 1}', '{"k": 1.0}'] * 2,
        "lists": ['{"k": [1, 2]}', '{"k": [2, 1]}'] * 2,
        "twice": ['{"k": 1, "k": 2}'] * 4,
        "no object": ["[1]"] * 4,
    }
    for what, args in cases.items():
        got = va.repetition_issues(ft.tool_calls(example(spark, [("assistant", call("bash", a)) for a in args]))).collect()
        assert [r["check"] for r in got] == (["repetitive_tool_calls"] if what in ("nested", "numbers", "twice", "no object") else []), what
    several = example(spark, [("assistant", call("bash", f'{{"k": {i}}}')) for i in range(21)] + [("assistant", call("bash", '{"k": 0}'))] * 4)
    assert sorted(r["detail"] for r in va.repetition_issues(ft.tool_calls(several)).collect()) == ["25 x bash", "5 x bash(k=0)"]
