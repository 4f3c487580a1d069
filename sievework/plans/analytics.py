"""Queries on counts, statistics, versions, decisions and gates (A, J, F08-F10, L, U, W09-W12, X)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import refdata as rd
from ..functions import text as tx
from ..operators import aggregates as ag
from ..operators import decisions as de
from ..operators import features as ft
from ..operators import scores as sc
from ..operators import validate as va
from ..operators import versions as ve
from .conversation import _SFT, CALLS, ISSUES
from .fixtures import agent_examples, agent_table, examples, fx, nested, sql

Q: dict = {}
SQL: dict[str, str] = {}


def query(name: str, text: str | None = None):
    def add(f):
        Q[name] = f
        if text:
            SQL[name] = text
        return f

    return add


def _round(df, *cols, digits: int = 6):
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in cols})


def _tasks(spark):
    return rd.task_table(spark)


def _registry(tasks):
    return f"reg(task_id, ordinal) AS (VALUES {', '.join(f'({chr(39)}{t}{chr(39)}, {i})' for i, t in enumerate(tasks))})"


_REG = _registry(rd.TASK_IDS)
_WIDE = tuple(f"task_{i:02d}" for i in range(26))  # with tasks that have no rows
_FILL = f", {_registry(_WIDE)}, cnt AS (SELECT r.task_id, r.ordinal, coalesce(c.n, 0) AS n FROM reg r LEFT JOIN (SELECT task_id, count(*) AS n FROM fx_ex GROUP BY task_id) c ON r.task_id = c.task_id)"


def _counts(spark, d):
    return ag.zero_fill(ag.count_per_task(fx(spark, d, "fx_ex")), rd.task_table(spark, _WIDE))


@query("a01_count_per_task", sql("fx_ex", " SELECT task_id, count(*) AS n FROM fx_ex GROUP BY task_id"))
def a01(spark, d):
    return ag.count_per_task(fx(spark, d, "fx_ex"))


@query("j04_zero_fill", sql("fx_ex", _FILL + " SELECT task_id, CAST(ordinal AS INT) AS ordinal, n FROM cnt"))
def j04(spark, d):
    return _counts(spark, d).select("task_id", "ordinal", "n")


@query("a02_dataset_stats", sql("fx_ex fx_msgs", """, m AS (SELECT example_id, count(*) AS turns, sum(length(content)) AS chars FROM fx_msgs GROUP BY example_id)
  SELECT task_id, count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'val') AS val, count(*) AS total, round(avg(turns), 6) AS avg_turns, round(avg(chars), 6) AS avg_chars, CAST(sum(chars) AS BIGINT) // 4 AS tokens FROM fx_ex e JOIN m ON e.example_id = m.example_id GROUP BY task_id"""))
def a02(spark, d):
    return _round(ag.dataset_stats(examples(spark, d)), "avg_turns", "avg_chars")


_LIST = "coalesce(string_agg(task_id, '|' ORDER BY task_id) FILTER ({}), '')"


@query("a03_balance", sql("fx_ex", _FILL + f" SELECT min(n) AS min_n, max(n) AS max_n, {_LIST.format('n > 1.5 * 4')} AS overweight, {_LIST.format('n > 0 AND n < 0.5 * 4')} AS underweight, {_LIST.format('n = 0')} AS missing, round_even(min(n) / CAST(max(n) AS DOUBLE), 3) AS ratio FROM cnt"))
def a03(spark, d):
    return ag.balance(_counts(spark, d), 4)


@query("a04_data_summary", sql("fx_ex", _FILL + f" SELECT CAST(sum(n) AS BIGINT) AS total, {_LIST.format('n = 0')} AS missing, {_LIST.format('n > 0 AND n < 4')} AS below FROM cnt"))
def a04(spark, d):
    return ag.data_summary(_counts(spark, d), 4)


_DEF = _FILL + ", df AS (SELECT task_id, greatest(6 - n, 0) AS deficit, CASE WHEN task_id IN ('task_02', 'task_09', 'task_16') THEN 1 ELSE 3 END AS epc FROM cnt WHERE n < 6)"


@query("a05_deficits", sql("fx_ex", _DEF + " SELECT task_id, deficit FROM df"))
def a05(spark, d):
    return ag.deficits(_counts(spark, d), 6)


@query("a06_deficit_cost", sql("fx_ex", _DEF + " SELECT CAST(sum(deficit) AS BIGINT) AS new_examples, CAST(sum(ceil(deficit / CAST(epc AS DOUBLE))) AS BIGINT) AS calls, round(sum(ceil(deficit / CAST(epc AS DOUBLE))) * 0.015, 6) AS cost FROM df"))
def a06(spark, d):
    return _round(ag.deficit_cost(ag.deficits(_counts(spark, d), 6)), "cost")


@query("j13_generation_requests", sql("fx_ex", _DEF + f""", v(variation_no, variation_id) AS (VALUES {', '.join(f"({i}, '{k}')" for i, k in enumerate(rd.VARIATIONS))}),
  c AS (SELECT *, unnest(range(0, CAST(ceil(deficit / CAST(epc AS DOUBLE)) AS BIGINT))) AS i FROM df)
  SELECT task_id, CAST(i AS INT) AS request_no, CAST(least(epc, deficit - i * epc) AS INT) AS n_examples, variation_id FROM c JOIN v ON v.variation_no = c.i % 9"""))
def j13(spark, d):
    return ag.generation_requests(ag.deficits(_counts(spark, d), 6), rd.variation_table(spark))


@query("f10_tasks_below", sql("fx_ex", _FILL + " SELECT task_id, n FROM cnt WHERE n < 4"))
def f10(spark, d):
    return ag.tasks_below(_counts(spark, d), 4)


@query("l05_below_by_registry", sql("fx_ex", _FILL + " SELECT task_id, CAST(ordinal AS INT) AS ordinal, n, n = 0 AS zero FROM cnt WHERE n < 4"))
def l05(spark, d):
    return de.below_by_registry(_counts(spark, d), 4)


@query("u05_unknown_tasks", sql("fx_docs", f", {_REG} SELECT DISTINCT task_id FROM fx_docs WHERE task_id NOT IN (SELECT task_id FROM reg)"))
def u05(spark, d):
    return ag.unknown_tasks(fx(spark, d, "fx_docs"), _tasks(spark))


_BEH = CALLS + """, bc AS (SELECT example_id, count(*) FILTER (valid) AS good, count(*) AS every, bool_or(valid AND name IN ('write_file', 'create_directory') AND coalesce(CASE WHEN json_valid(raw0) THEN json_extract_string(raw0, '$.arguments.path') END, '') <> '') AS wrote,
      list(coalesce(name, '') ORDER BY turn, call_no) FILTER (valid) AS good_names, list(CASE WHEN valid THEN coalesce(name, '') ELSE '__INVALID_JSON__' END) AS all_names FROM calls GROUP BY example_id),
  bm AS (SELECT example_id, count(*) AS turns, sum(length(content)) AS chars, arg_min(content, turn) FILTER (role = 'user') AS prompt, arg_max(content, turn) FILTER (role = 'assistant') AS said,
      bool_or(role = 'tool' AND regexp_matches(lower(content), 'error|failed|not found')) AS rec FROM fx_agent_msgs GROUP BY example_id),
  beh AS (SELECT e.example_id, e.task_id, coalesce(turns, 0) AS turns, coalesce(chars, 0) AS chars, prompt, coalesce(good, 0) AS calls, coalesce(wrote, false) AS wrote, coalesce(NOT contains(said, '<tool_call>') AND length(said) > 20, false) AS summary, coalesce(rec, false) AS rec,
      coalesce(list_has_any(good_names[-2:], ['write_file', 'draft_email', 'create_calendar_event', 'generate_image', 'write_memory']), false) AS ends, coalesce(array_to_string(list_sort(list_distinct(good_names)), '|'), '') AS combo, coalesce(array_to_string(list_sort(list_distinct(all_names)), '|'), '') AS tools
    FROM fx_agent_ex e LEFT JOIN bc ON e.example_id = bc.example_id LEFT JOIN bm ON e.example_id = bm.example_id)"""
_AG = "fx_agent_ex fx_agent_msgs"


@query("a10_diversity", sql(_AG, _BEH + """, g AS (SELECT task_id, count(*) AS n, count(DISTINCT prompt) AS unique_prompts, count(prompt) AS prompts, min(turns) AS a, max(turns) AS b, count(DISTINCT tools) AS combos, avg(chars) AS mean, stddev_samp(chars) AS sd FROM beh GROUP BY task_id),
  p AS (SELECT *, coalesce(unique_prompts / CAST(nullif(prompts, 0) AS DOUBLE), 0) AS u, coalesce((b - a) / CAST(nullif(b, 0) AS DOUBLE), 0) AS s, combos / CAST(n AS DOUBLE) AS c, coalesce(sd / nullif(mean, 0), 0) AS cv FROM g),
  r AS (SELECT *, CASE WHEN n > 2 THEN (u + least(2 * s, 1) + least(2 * c, 1) + least(2 * cv, 1)) / 4 ELSE (u + least(2 * s, 1) + least(2 * c, 1)) / 3 END AS sc FROM p)
  SELECT task_id, n, unique_prompts, CAST(a AS INT) AS min_turns, CAST(b AS INT) AS max_turns, combos AS unique_tool_combos, round(sc, 6) AS score,
    concat_ws('|', CASE WHEN u < 0.8 THEN 'low prompt diversity' END, CASE WHEN s < 0.2 THEN 'low turn diversity' END, CASE WHEN c < 0.3 THEN 'low tool diversity' END, CASE WHEN n > 2 AND cv < 0.15 THEN 'uniform length' END) AS issues, sc < 0.5 AS flagged FROM r"""))
def a10(spark, d):
    return _round(ag.diversity(agent_examples(spark, d)), "score").withColumn("issues", F.array_join("issues", "|"))


_P = "round(avg(CAST({} AS DOUBLE)) * 100, 6)"


@query("a11_statistical_check", sql(_AG, _BEH + f""", g AS (SELECT task_id, count(*) AS n, round(avg(calls), 6) AS avg_tools, {_P.format('CAST(calls <= 1 AS INT)')} AS pct_single_tool, {_P.format('CAST(wrote AS INT)')} AS pct_write, {_P.format('CAST(summary AS INT)')} AS pct_summary, {_P.format('CAST(rec AS INT)')} AS pct_error_recovery,
    count(DISTINCT combo) AS unique_tool_combos, count(DISTINCT substr(prompt, 1, 80)) AS unique_prompts FROM beh GROUP BY task_id)
  SELECT *, concat_ws('|', CASE WHEN task_id <> 'task_00' AND pct_single_tool > 40 THEN 'single tool' END, CASE WHEN task_id <> 'task_00' AND pct_write < 50 THEN 'few writes' END, CASE WHEN pct_summary < 70 THEN 'few summaries' END,
    CASE WHEN n > 10 AND unique_tool_combos < 3 THEN 'few tool combinations' END, CASE WHEN n > 10 AND unique_prompts < n * 0.7 THEN 'repeated prompts' END) AS issues FROM g"""))
def a11(spark, d):
    out = ag.statistical_check(agent_examples(spark, d)).withColumn("issues", F.array_join("issues", "|"))
    return _round(out, "avg_tools", "pct_single_tool", "pct_write", "pct_summary", "pct_error_recovery")


@query("a12_completeness", sql(_AG, _BEH + f""", g AS (SELECT task_id, count(*) AS n, round(avg(calls), 6) AS avg_tools, {_P.format('CAST(calls <= 1 AS INT)')} AS pct_single, {_P.format('CAST(ends AS INT)')} AS pct_write, {_P.format('CAST(summary AS INT)')} AS pct_summary, {_P.format('CAST(rec AS INT)')} AS pct_error, round(avg(chars), 6) AS avg_chars FROM beh GROUP BY task_id)
  SELECT *, concat_ws('|', CASE WHEN pct_single > 30 THEN 'HIGH-1TOOL' END, CASE WHEN pct_write < 50 AND task_id <> 'task_00' THEN 'LOW-WRITE' END, CASE WHEN pct_summary < 50 THEN 'NO-SUMMARY' END) AS flags FROM g"""))
def a12(spark, d):
    out = ag.completeness(agent_examples(spark, d)).withColumn("flags", F.array_join("flags", "|"))
    return _round(out, "avg_tools", "pct_single", "pct_write", "pct_summary", "pct_error", "avg_chars")


def _converted(spark, d):
    return ft.sft_convert(nested(fx(spark, d, "fx_msgs_tool"), "task_id"))


_TOK = _SFT + ", tk AS (SELECT sum(length(content)) // 4 AS t FROM sft GROUP BY example_id), o AS (SELECT t, row_number() OVER (ORDER BY t) - 1 AS i, count(*) OVER () AS n FROM tk)"


@query("a13_sft_length_stats", sql("fx_msgs_tool", _TOK + " SELECT any_value(n) AS n, CAST(min(t) AS BIGINT) AS min_tokens, CAST(max(t) FILTER (i = n // 2) AS BIGINT) AS median_tokens, CAST(max(t) FILTER (i = CAST(floor(n * 0.9::DOUBLE) AS BIGINT)) AS BIGINT) AS p90_tokens, CAST(max(t) AS BIGINT) AS max_tokens FROM o"))
def a13(spark, d):
    return ag.sft_length_stats(_converted(spark, d))


@query("a14_sft_length_histogram", sql("fx_msgs_tool", _TOK + " SELECT CASE WHEN t < 512 THEN '0-512' WHEN t < 1024 THEN '512-1024' WHEN t < 2048 THEN '1024-2048' WHEN t < 4096 THEN '2048-4096' ELSE '4096+' END AS bucket, count(*) AS n FROM tk GROUP BY bucket"))
def a14(spark, d):
    return ag.sft_length_histogram(_converted(spark, d))


@query("a15_bad_examples_by_task", sql(_AG, ISSUES + """, b AS (SELECT * FROM issues WHERE severity IN ('critical', 'high')), t AS (SELECT task_id, count(DISTINCT example_id) AS n_bad FROM b GROUP BY task_id ORDER BY n_bad DESC, task_id LIMIT 10)
  SELECT b.task_id, "check", count(*) AS n, any_value(n_bad) AS n_bad FROM b JOIN t ON b.task_id = t.task_id GROUP BY b.task_id, "check" """))
def a15(spark, d):
    return ag.bad_examples_by_task(va.issues(agent_table(spark, d)))


@query("u03_tool_set_jaccard", sql(_AG, r""", s AS (SELECT e.example_id, e.task_id, coalesce(list_distinct(flatten(list(regexp_extract_all(content, '"name"\s*:\s*"(\w+)"', 1)) FILTER (role = 'assistant'))), []) AS t FROM fx_agent_ex e LEFT JOIN fx_agent_msgs m ON e.example_id = m.example_id GROUP BY e.example_id, e.task_id),
  f AS (SELECT task_id, arg_min(t, example_id) AS t0 FROM s GROUP BY task_id)
  SELECT example_id, round(CASE WHEN len(t) = 0 AND len(t0) = 0 THEN 1 ELSE len(list_intersect(t, t0)) / CAST(len(list_distinct(list_concat(t, t0))) AS DOUBLE) END, 6) AS jaccard FROM s JOIN f ON s.task_id = f.task_id"""))
def u03(spark, d):
    sets = agent_examples(spark, d).select("example_id", "task_id", ft.name_set(F.col("messages")).alias("t"))
    first = sets.groupBy("task_id").agg(F.min_by("t", "example_id").alias("t0"))
    return _round(sets.join(first, "task_id").select("example_id", ag.tool_jaccard(F.col("t"), F.col("t0")).alias("jaccard")), "jaccard")


@query("u04_novelty_check", sql(_AG, CALLS + """, sg AS (SELECT e.example_id, e.task_id, e.split, coalesce(array_to_string((list(coalesce(name, '') ORDER BY turn, call_no) FILTER (valid))[:3], '>'), '') AS s FROM fx_agent_ex e LEFT JOIN calls c ON e.example_id = c.example_id GROUP BY e.example_id, e.task_id, e.split)
  SELECT task_id, bool_or((task_id, s) NOT IN (SELECT (task_id, s) FROM sg WHERE split = 'train')) AS is_novel FROM sg WHERE split = 'val' AND task_id IN (SELECT task_id FROM sg WHERE split = 'train' GROUP BY task_id HAVING count(*) >= 5) GROUP BY task_id"""))
def u04(spark, d):
    e = agent_table(spark, d)
    return ag.novelty_check(e.where("split = 'val'"), e.where("split = 'train'"))


@query("u01_union_of_splits", sql("fx_ex", " SELECT example_id, split FROM fx_ex"))
def u01(spark, d):
    e = fx(spark, d, "fx_ex").select("example_id", "split")
    return e.where("split = 'train'").unionByName(e.where("split = 'val'"))


@query("u02_task_ids_of_versions", sql("fx_snapshot", " SELECT task_id FROM fx_snapshot WHERE version = 20 UNION SELECT task_id FROM fx_snapshot WHERE version = 21"))
def u02(spark, d):
    s = fx(spark, d, "fx_snapshot")
    return s.where("version = 20").select("task_id").union(s.where("version = 21").select("task_id")).distinct()


# ---- versions ----------------------------------------------------------------------


@query("j05_count_diff", sql("fx_snapshot", " SELECT coalesce(a.task_id, b.task_id) AS task_id, coalesce(a.n, 0) AS old_n, coalesce(b.n, 0) AS new_n, coalesce(b.n, 0) - coalesce(a.n, 0) AS delta FROM (SELECT * FROM fx_snapshot WHERE version = 20) a FULL JOIN (SELECT * FROM fx_snapshot WHERE version = 21) b ON a.task_id = b.task_id"))
def j05(spark, d):
    s = fx(spark, d, "fx_snapshot")
    return ve.count_diff(s.where("version = 20"), s.where("version = 21"))


@query("j06_previous_scores", sql("fx_bench", " SELECT task_id, max(version) AS prev_version, round(arg_max(score, version), 6) AS prev_score FROM fx_bench WHERE version < 30 GROUP BY task_id"))
def j06(spark, d):
    return _round(ve.previous_scores(fx(spark, d, "fx_bench"), 30), "prev_score")


@query("j09_task_alignment", sql("fx_taskdocs", f", {_REG}, e AS (SELECT DISTINCT regexp_extract(body, 'id: (task_[0-9]+)', 1) AS task_id FROM fx_taskdocs) SELECT coalesce(e.task_id, r.task_id) AS task_id, CASE WHEN e.task_id IS NULL THEN 'missing' WHEN r.task_id IS NULL THEN 'orphaned' ELSE 'aligned' END AS status FROM e FULL JOIN reg r ON e.task_id = r.task_id"))
def j09(spark, d):
    external = fx(spark, d, "fx_taskdocs").select(F.regexp_extract("body", "id: (task_[0-9]+)", 1).alias("task_id"))
    return ve.task_alignment(external, _tasks(spark))


_GOLD = """, g AS (SELECT task_id, count(*) AS n FROM fx_gold GROUP BY task_id), c AS (SELECT task_id, count(*) AS n FROM fx_current GROUP BY task_id), be AS (SELECT task_id, score FROM fx_bench WHERE version = 15),
  j AS (SELECT coalesce(g.task_id, c.task_id) AS task_id, coalesce(g.n, 0) AS gold, coalesce(c.n, 0) AS current FROM g FULL JOIN c ON g.task_id = c.task_id),
  q AS (SELECT j.*, current - gold AS delta, coalesce(score, 0) AS bench, CASE WHEN gold > 0 AND current < gold THEN (gold - current) * 100.0::DOUBLE / gold END AS pct_lost FROM j LEFT JOIN be ON j.task_id = be.task_id),
  v AS (SELECT *, CASE WHEN bench >= 0.7 AND pct_lost > 10 THEN 'PROTECTED' WHEN bench >= 0.3 AND pct_lost > 20 THEN 'LOST' WHEN pct_lost > 20 THEN 'NOTE' ELSE 'OK' END AS verdict FROM q)"""
_GV = "fx_gold fx_current fx_bench"


def _gold(spark, d):
    return ve.gold_compare(ag.count_per_task(fx(spark, d, "fx_gold")), ag.count_per_task(fx(spark, d, "fx_current")), fx(spark, d, "fx_bench").where("version = 15"))


@query("j10_gold_compare", sql(_GV, _GOLD + " SELECT task_id, gold, current, delta, round(bench, 6) AS bench, round(pct_lost, 6) AS pct_lost, verdict FROM v"))
def j10(spark, d):
    return _round(_gold(spark, d), "bench", "pct_lost")


@query("x03_gold_integrity", sql(_GV, _GOLD + " SELECT CAST(sum(gold) AS BIGINT) AS gold_total, CAST(sum(current) AS BIGINT) AS current_total, count(*) FILTER (delta < 0) AS reduced, count(*) FILTER (delta > 0) AS added, count(*) FILTER (verdict IN ('PROTECTED', 'LOST')) AS warnings, count(*) FILTER (verdict = 'NOTE') AS notes, count(*) FILTER (verdict IN ('PROTECTED', 'LOST')) = 0 AS safe_to_train FROM v"))
def x03(spark, d):
    return ve.gold_integrity(_gold(spark, d))


@query("j11_selective_restore", sql("fx_gold fx_current", " SELECT example_id, task_id FROM fx_current WHERE task_id NOT IN ('task_01', 'task_02') UNION ALL SELECT example_id, task_id FROM fx_gold WHERE task_id IN ('task_01', 'task_02')"))
def j11(spark, d):
    tasks = spark.createDataFrame([("task_01",), ("task_02",)], "task_id string")
    return ve.restore_tasks(fx(spark, d, "fx_current"), fx(spark, d, "fx_gold"), tasks)


@query("j12_compare_runs", sql("fx_bench fx_runs", """, a AS (SELECT task_id, score AS original FROM fx_bench WHERE version = 15), r AS (SELECT task_id, avg(score) AS run_avg FROM fx_runs WHERE version = 22 GROUP BY task_id),
  j AS (SELECT coalesce(a.task_id, r.task_id) AS task_id, coalesce(original, 0) AS original, coalesce(run_avg, 0) AS run_avg FROM a FULL JOIN r ON a.task_id = r.task_id)
  SELECT task_id, round(original, 6) AS original, round(run_avg, 6) AS run_avg, round(run_avg - original, 6) AS delta, CASE WHEN run_avg - original < -0.3 THEN 'YES' WHEN run_avg - original < -0.1 THEN 'maybe' ELSE '' END AS verdict FROM j"""))
def j12(spark, d):
    out = ve.compare_runs(fx(spark, d, "fx_bench").where("version = 15"), fx(spark, d, "fx_runs").where("version = 22"))
    return _round(out, "original", "run_avg", "delta")


_PIV = ", p AS (SELECT task_id, CAST(coalesce(sum(n) FILTER (version = 20), 0) AS BIGINT) AS v20, CAST(coalesce(sum(n) FILTER (version = 21), 0) AS BIGINT) AS v21, CAST(coalesce(sum(n) FILTER (version = 22), 0) AS BIGINT) AS v22 FROM fx_snapshot WHERE version IN (20, 21, 22) GROUP BY task_id)"


@query("a16_version_pivot", sql("fx_snapshot", _PIV + " SELECT *, v22 - v20 AS delta FROM p"))
def a16(spark, d):
    return ve.version_pivot(fx(spark, d, "fx_snapshot"), [20, 21, 22])


@query("l04_biggest_changes", sql("fx_snapshot", _PIV + " SELECT task_id, v22 - v20 AS delta FROM p ORDER BY abs(v22 - v20) DESC, task_id LIMIT 10"))
def l04(spark, d):
    return ve.biggest_changes(ve.version_pivot(fx(spark, d, "fx_snapshot"), [20, 21, 22])).select("task_id", "delta")


_LAST3 = ", lv AS (SELECT version, row_number() OVER (ORDER BY version DESC) AS r FROM (SELECT DISTINCT version FROM fx_bench))"


@query("a17_score_version_table", sql("fx_bench", _LAST3 + """, p AS (SELECT task_id, max(score) FILTER (r = 3) AS s1, max(score) FILTER (r = 2) AS s2, max(score) FILTER (r = 1) AS s3 FROM fx_bench b JOIN lv ON b.version = lv.version WHERE r <= 3 GROUP BY task_id)
  SELECT task_id, round(s1, 6) AS s1, round(s2, 6) AS s2, round(s3, 6) AS s3, CASE WHEN s3 - s2 IS NULL THEN NULL WHEN abs(s3 - s2) <= 0.05 THEN '=' WHEN s3 > s2 THEN 'up' ELSE 'down' END AS change FROM p"""))
def a17(spark, d):
    return _round(ve.score_version_table(fx(spark, d, "fx_bench")), "s1", "s2", "s3")


@query("a18_snapshot_range", sql("fx_snapshot", " SELECT version, CAST(sum(n) AS BIGINT) AS total, min(n) AS min_n, max(n) AS max_n FROM fx_snapshot GROUP BY version"))
def a18(spark, d):
    return ve.snapshot_range(fx(spark, d, "fx_snapshot"))


@query("a19_consistently_weak", sql("fx_bench", _LAST3 + """ SELECT task_id, count(*) AS n, round(avg(score), 6) AS avg_score, string_agg('v' || b.version || ':' || CAST(floor(score * 100) AS BIGINT), ' ' ORDER BY b.version) AS history FROM fx_bench b JOIN lv ON b.version = lv.version WHERE r <= 5 GROUP BY task_id HAVING count(*) >= 2 AND round(avg(score), 9) < 0.5"""))
def a19(spark, d):
    return _round(ve.consistently_weak(fx(spark, d, "fx_bench")), "avg_score")


@query("a20_eval_rollup", sql("fx_bench", ", a AS (SELECT version, avg(score) AS s FROM fx_bench GROUP BY version) SELECT version, round(s, 6) AS avg_score, version = (SELECT version FROM a ORDER BY s DESC, version LIMIT 1) AS is_best FROM a"))
def a20(spark, d):
    return _round(ve.eval_rollup(fx(spark, d, "fx_bench")), "avg_score")


@query("a21_run_variance", sql("fx_runs", ", p AS (SELECT task_id, avg(score) FILTER (run = 0) AS a, avg(score) FILTER (run = 1) AS b FROM fx_runs GROUP BY task_id) SELECT task_id, round(a, 6) AS run0, round(b, 6) AS run1, round(abs(a - b), 6) AS delta FROM p"))
def a21(spark, d):
    return _round(ve.run_variance(fx(spark, d, "fx_runs")), "run0", "run1", "delta")


@query("a24_budget_spend", sql("fx_actions", " SELECT session_id, turn, round(sum(cost) OVER (PARTITION BY session_id ORDER BY turn ROWS UNBOUNDED PRECEDING), 4) AS spent, round(1000 - sum(cost) OVER (PARTITION BY session_id ORDER BY turn ROWS UNBOUNDED PRECEDING), 4) AS remaining FROM fx_actions"))
def a24(spark, d):
    out = ve.budget_spend(fx(spark, d, "fx_actions"), 1000.0).select("session_id", "turn", "spent", "remaining")
    return _round(out, "spent", "remaining", digits=4)


@query("f08_weak_tasks", sql("fx_bench", " SELECT version, task_id, round(score, 6) AS score, score < 0.5 AS weak, score >= 0.85 AS strong, score = 0 AS zero FROM fx_bench"))
def f08(spark, d):
    b = fx(spark, d, "fx_bench")
    return _round(b.select("version", "task_id", "score", (F.col("score") < 0.5).alias("weak"), (F.col("score") >= 0.85).alias("strong"), (F.col("score") == 0).alias("zero")), "score")


@query("l03_passing_failing", sql("fx_bench", " SELECT task_id, round(score, 6) AS score, CASE WHEN score >= 0.5 THEN 'passing' ELSE 'failing' END AS side FROM fx_bench WHERE version = 15"))
def l03(spark, d):
    return _round(ve.passing_failing(fx(spark, d, "fx_bench").where("version = 15")), "score")


@query("s15_count_snapshot", sql("fx_ex fx_actions", """ SELECT 'count' AS kind, task_id AS name, count(*) AS n, '' AS detail FROM fx_ex GROUP BY task_id
  UNION ALL SELECT 'changelog', CAST(session_id AS VARCHAR), count(*), string_agg(turn || ':' || action, ',' ORDER BY turn) FROM fx_actions WHERE action IN ('generate_data', 'filter_data') AND status = 'success' GROUP BY session_id"""))
def s15(spark, d):
    counts = ve.count_snapshot(fx(spark, d, "fx_ex"), 1).select(F.lit("count").alias("kind"), F.col("task_id").alias("name"), "n", F.lit("").alias("detail"))
    log = ve.changelog(fx(spark, d, "fx_actions"))
    return counts.union(log.select(F.lit("changelog"), F.col("session_id").cast("string"), F.size("changes").cast("long"), F.array_join("changes", ",")))


# ---- guardrails --------------------------------------------------------------------


@query("w09_last_k_events", sql("fx_actions", ", r AS (SELECT session_id, turn, action, row_number() OVER (PARTITION BY session_id ORDER BY turn DESC) AS back FROM fx_actions) SELECT session_id, turn, action, CAST(back AS INT) AS back FROM r WHERE back <= 5"))
def w09(spark, d):
    return ve.last_k_events(fx(spark, d, "fx_actions"), 5).select("session_id", "turn", "action", "back")


_W15 = "OVER (PARTITION BY session_id ORDER BY turn ROWS BETWEEN 14 PRECEDING AND CURRENT ROW)"


@query("w10_loop_detection", sql("fx_actions", f" SELECT session_id, turn, count(*) {_W15} >= 15 AND count(*) FILTER (action = 'generate_data' AND status = 'success' AND added > 0) {_W15} >= 3 AND count(*) FILTER (action = 'train') {_W15} = 0 AS looping FROM fx_actions"))
def w10(spark, d):
    return ve.loop_detection(fx(spark, d, "fx_actions"), least=3).select("session_id", "turn", "looping")


@query("w11_consecutive_failures", sql("fx_actions", """, g AS (SELECT *, count(*) FILTER (status = 'success') OVER (PARTITION BY session_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS grp FROM fx_actions)
  SELECT session_id, turn, count(*) FILTER (status = 'error') OVER (PARTITION BY session_id, grp ORDER BY turn ROWS UNBOUNDED PRECEDING) AS failures FROM g"""))
def w11(spark, d):
    return ve.consecutive_failures(fx(spark, d, "fx_actions")).select("session_id", "turn", "failures")


_AVG = ", a AS (SELECT version, avg(score) AS s FROM fx_bench GROUP BY version), b AS (SELECT *, max(s) OVER (ORDER BY version ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM a)"


@query("w12_regression_check", sql("fx_bench", _AVG + " SELECT version, round(s, 6) AS avg_score, round(m, 6) AS best_so_far, round(CASE WHEN m > 0 THEN (m - s) / m * 100 END, 6) AS pct_below, coalesce(CASE WHEN m > 0 THEN (m - s) / m * 100 END > 15, false) AS regressed FROM b"))
def w12(spark, d):
    avg = fx(spark, d, "fx_bench").groupBy("version").agg(F.avg("score").alias("avg_score"))
    return _round(ve.regression_check(avg), "avg_score", "best_so_far", "pct_below")


# ---- decisions ---------------------------------------------------------------------

# many datasets at once: one for each snapshot version, scores rescaled to span all branches
_SIG = """, sg AS (SELECT b.version, b.task_id, s.n * 2 AS n, least(1.0::DOUBLE, b.score * 2) AS bench, CASE CAST(right(b.task_id, 2) AS INT) % 4 WHEN 0 THEN 0.0::DOUBLE WHEN 1 THEN 3.0::DOUBLE WHEN 2 THEN 4.0::DOUBLE ELSE 4.8::DOUBLE END AS judge,
      coalesce(lag(least(1.0::DOUBLE, b.score * 2)) OVER (PARTITION BY b.task_id ORDER BY b.version), 0) AS prev FROM fx_bench b JOIN fx_snapshot s ON b.version = s.version AND b.task_id = s.task_id),
  s2 AS (SELECT *, prev - bench >= 0.2 AS regressed FROM sg),
  rec AS (SELECT *, CASE WHEN n < 30 THEN 'GENERATE' WHEN n >= 80 AND bench <= 0.3 AND n > 100 THEN 'TRIM' WHEN n >= 80 AND bench <= 0.3 THEN 'REGENERATE' WHEN n >= 80 THEN 'LEAVE_ALONE' WHEN regressed AND prev > 0 THEN 'INVESTIGATE' WHEN bench >= 0.8 THEN 'LEAVE_ALONE'
      WHEN bench = 0 AND n >= 50 AND judge >= 4.5 THEN CASE WHEN task_id IN ('task_02', 'task_04', 'task_06', 'task_13', 'task_18') THEN 'INFRASTRUCTURE' ELSE 'REGENERATE' END
      WHEN bench <= 0.3 AND judge > 0 AND judge < 3.5 THEN 'REGENERATE' WHEN bench <= 0.3 AND n >= 50 AND (judge >= 4.5 OR judge = 0) THEN 'ADVERSARIAL' WHEN bench <= 0.3 THEN 'GENERATE' ELSE 'LEAVE_ALONE' END AS recommendation FROM s2)"""
_SV = "fx_bench fx_snapshot"


def _signals(spark, d):
    from pyspark.sql import Window

    b, s = fx(spark, d, "fx_bench"), fx(spark, d, "fx_snapshot")
    k = F.right("task_id", F.lit(2)).cast("int") % 4
    judge = F.when(k == 0, 0.0).when(k == 1, 3.0).when(k == 2, 4.0).otherwise(4.8)
    j = b.join(s, ["version", "task_id"]).select("version", "task_id", (F.col("n") * 2).alias("n"), F.least(F.lit(1.0), F.col("score") * 2).alias("bench"), judge.alias("judge"))
    j = j.withColumn("prev", F.coalesce(F.lag("bench").over(Window.partitionBy("task_id").orderBy("version")), F.lit(0.0)))
    return j.withColumn("regressed", F.col("prev") - F.col("bench") >= 0.2)


@query("x01_recommend_actions", sql(_SV, _SIG + " SELECT version, task_id, n, round(bench, 6) AS bench, judge, recommendation FROM rec"))
def x01(spark, d):
    return _round(de.recommend_actions(_signals(spark, d)).select("version", "task_id", "n", "bench", "judge", "recommendation"), "bench")


@query("x02_recommendation_summary", sql(_SV, _SIG + " SELECT recommendation, count(*) AS n, string_agg(task_id, '|' ORDER BY task_id) AS tasks FROM rec GROUP BY recommendation"))
def x02(spark, d):
    return de.recommendation_summary(de.recommend_actions(_signals(spark, d)))


@query("f09_tasks_needing_action", sql(_SV, _SIG + " SELECT version, task_id, recommendation FROM rec WHERE recommendation IN ('GENERATE', 'REGENERATE', 'ADVERSARIAL', 'TRIM', 'INVESTIGATE')"))
def f09(spark, d):
    return de.tasks_needing_action(de.recommend_actions(_signals(spark, d))).select("version", "task_id", "recommendation")


@query("x04_coverage_gate", sql("fx_ex", _FILL + f" SELECT count(*) FILTER (n < 4) = 0 AS passed, {_LIST.format('n = 0')} AS missing, {_LIST.format('n > 0 AND n < 4')} AS below FROM cnt"))
def x04(spark, d):
    return de.coverage_gate(_counts(spark, d), 4)


_QG = ISSUES + ", per AS (SELECT DISTINCT example_id FROM issues), qg AS (SELECT count(*) AS total, count(*) FILTER (p.example_id IS NULL) AS clean FROM fx_agent_ex e LEFT JOIN per p ON e.example_id = p.example_id)"


def _quality(spark, d):
    e = agent_table(spark, d)
    return de.quality_gate(va.structural_summary(e, va.issues(e)))


@query("x05_quality_gate", sql(_AG, _QG + " SELECT total, clean, round(clean * 100.0::DOUBLE / total, 6) AS clean_pct, clean * 100.0::DOUBLE / total >= 90 AS passed FROM qg"))
def x05(spark, d):
    return _round(_quality(spark, d), "clean_pct")


@query("x06_train_gate", sql(f"{_AG} fx_ex {_GV}", _QG + _FILL + _GOLD.replace(", c AS", ", cc AS").replace("FULL JOIN c ON g.task_id = c.task_id", "FULL JOIN cc c ON g.task_id = c.task_id").replace(" v AS", " vv AS") + """,
  gates AS (SELECT 'coverage' AS gate, count(*) FILTER (n < 4) = 0 AS passed FROM cnt UNION ALL SELECT 'quality', clean * 100.0::DOUBLE / total >= 90 FROM qg UNION ALL SELECT 'gold', count(*) FILTER (verdict IN ('PROTECTED', 'LOST')) = 0 FROM vv)
  SELECT * FROM gates UNION ALL SELECT 'train', bool_and(passed) FROM gates"""))
def x06(spark, d):
    return de.train_gate(de.coverage_gate(_counts(spark, d), 4), _quality(spark, d), ve.gold_integrity(_gold(spark, d)))


@query("x07_generation_guard", sql(_SV, _SIG + ", bl AS (SELECT task_id, n * 2 AS n FROM fx_snapshot WHERE version = 20) SELECT rec.task_id, rec.n, recommendation FROM rec LEFT JOIN bl ON rec.task_id = bl.task_id WHERE rec.version = 21 AND recommendation NOT IN ('LEAVE_ALONE', 'INFRASTRUCTURE', 'TRIM') AND NOT coalesce(rec.n - bl.n >= 20, false)"))
def x07(spark, d):
    base = fx(spark, d, "fx_snapshot").where("version = 20").select("task_id", (F.col("n") * 2).alias("n"))
    return de.generation_guard(de.recommend_actions(_signals(spark, d)).where("version = 21"), base)


@query("x08_diagnosis_gate", sql("fx_actions", ", m AS (SELECT session_id, max(turn) FILTER (status = 'success' AND action = 'benchmark' AND added > 0) AS b, max(turn) FILTER (status = 'success' AND action = 'diagnose') AS c FROM fx_actions GROUP BY session_id) SELECT session_id, b IS NOT NULL AND coalesce(c, -1) < b AS blocked FROM m"))
def x08(spark, d):
    return de.diagnosis_gate(fx(spark, d, "fx_actions").withColumnRenamed("added", "zeros"))


@query("x09_allocate_plan", sql("fx_targets", """, o AS (SELECT *, 1 - score AS gap, floor(300 * (1 - score) / sum(1 - score) OVER (PARTITION BY version)) AS share FROM fx_targets WHERE score < 0.85),
  w AS (SELECT *, greatest(0, least(greatest(share, 1), 30, 120 - n)) AS want FROM o), u AS (SELECT *, sum(want) OVER (PARTITION BY version ORDER BY priority, gap DESC, task_id ROWS UNBOUNDED PRECEDING) AS upto FROM w),
  al AS (SELECT version, task_id, CAST(greatest(0, least(want, 300 - (upto - want))) AS BIGINT) AS alloc FROM u) SELECT version, task_id, alloc, round(alloc * 0.04, 6) AS cost FROM al WHERE alloc > 0"""))
def x09(spark, d):
    return _round(de.allocate_plan(fx(spark, d, "fx_targets")), "cost")


@query("x10_score_zone", sql("fx_bench", " SELECT version, task_id, CASE WHEN score * 2 >= 0.7 THEN 'PROTECTED' WHEN score * 2 >= 0.3 THEN 'IMPROVE' ELSE 'REBUILD' END AS zone FROM fx_bench"))
def x10(spark, d):
    return fx(spark, d, "fx_bench").select("version", "task_id", de.score_zone(F.col("score") * 2).alias("zone"))
