"""Queries on conversations and tool calls: projections (P01-P20, P35) and validators."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import refdata as rd
from ..functions import text as tx
from ..operators import features as ft
from ..operators import registry
from ..operators import validate as va
from ..sources.io import stored
from .fixtures import agent_examples, agent_table, examples, fx, nested, sql

Q: dict = {}
SQL: dict[str, str] = {}


def query(name: str, text: str | None = None):
    """Register a query and its DuckDB twin."""

    def add(f):
        Q[name] = f
        if text:
            SQL[name] = text
        return f

    return add


_STRIP = r"regexp_replace(regexp_replace({}, '^\s+', ''), '\s+$', '')"

#: Calls of the agent conversations, as DuckDB sees them.
CALLS = r""", calls AS (
  SELECT example_id, task_id, turn, CAST(k - 1 AS INT) AS call_no, raws[k] AS raw0, json_valid(raws[k]) AS valid,
    CASE WHEN json_valid(raws[k]) THEN json_extract_string(raws[k], '$.name') END AS name, CASE WHEN json_valid(raws[k]) THEN json_keys(raws[k], '$.arguments') END AS keys
  FROM (SELECT example_id, task_id, turn, regexp_extract_all(content, '<tool_call>\s*(.*?)\s*</tool_call>', 1, 's') AS raws FROM fx_agent_msgs WHERE role = 'assistant'),
       LATERAL (SELECT unnest(range(1, len(raws) + 1)) AS k))"""
_EX = "fx_agent_ex fx_agent_msgs"
_NAMES = CALLS + ", names AS (SELECT example_id, list(CASE WHEN valid THEN coalesce(name, '') ELSE '__INVALID_JSON__' END ORDER BY turn, call_no) AS names, list(coalesce(name, '') ORDER BY turn, call_no) FILTER (valid) AS good FROM calls GROUP BY example_id)"


@query("p01_first_user_message", sql("fx_agent_ex fx_agent_msgs", """
  SELECT e.example_id, coalesce(u.content, '') AS user_message FROM fx_agent_ex e
  LEFT JOIN (SELECT example_id, arg_min(content, turn) AS content FROM fx_agent_msgs WHERE role = 'user' GROUP BY example_id) u ON e.example_id = u.example_id"""))
def p01(spark, d):
    return ft.first_user_message(agent_examples(spark, d)).select("example_id", "user_message")


@query("p02_score_key", sql("fx_msgs", "SELECT example_id, task_id, substr(arg_min(content, turn), 1, 80) AS user_prefix FROM fx_msgs WHERE role = 'user' GROUP BY ALL"))
def p02(spark, d):
    return ft.score_key(examples(spark, d)).select("example_id", "task_id", "user_prefix").where("user_prefix <> ''")


@query("p03_extract_tool_calls", sql(_EX, CALLS + """ SELECT example_id, task_id, CAST(turn AS INT) AS turn, call_no, CASE WHEN valid THEN raw0 ELSE substr(raw0, 1, 200) END AS raw, valid, name, array_to_string(list_sort(keys), '|') AS arg_keys FROM calls"""))
def p03(spark, d):
    calls = ft.tool_calls(agent_examples(spark, d))
    return calls.select("example_id", "task_id", "turn", "call_no", "raw", "valid", "name", tx.joined(F.map_keys("arguments")).alias("arg_keys"))


@query("p04_tool_names", sql(_EX, _NAMES + " SELECT e.example_id, coalesce(array_to_string(names, '|'), '') AS tool_names FROM fx_agent_ex e LEFT JOIN names n ON e.example_id = n.example_id"))
def p04(spark, d):
    return ft.tool_names(agent_examples(spark, d)).select("example_id", F.array_join("tool_names", "|").alias("tool_names"))


@query("p05_tool_name_set_regex", sql(_EX, r""", s AS (
  SELECT example_id, array_to_string(list_sort(list_distinct(flatten(list(regexp_extract_all(content, '"name"\s*:\s*"(\w+)"', 1))))), '|') AS tool_set FROM fx_agent_msgs WHERE role = 'assistant' GROUP BY example_id)
  SELECT e.example_id, coalesce(tool_set, '') AS tool_set FROM fx_agent_ex e LEFT JOIN s ON e.example_id = s.example_id"""))
def p05(spark, d):
    return ft.tool_name_set_regex(agent_examples(spark, d)).select("example_id", tx.joined(F.col("tool_set")).alias("tool_set"))


@query("p06_written_files", sql(_EX, CALLS + " SELECT example_id, json_extract_string(raw0, '$.arguments.path') AS path FROM calls WHERE valid AND name IN ('write_file', 'create_directory') AND json_extract_string(raw0, '$.arguments.path') <> ''"))
def p06(spark, d):
    return ft.written_files(ft.tool_calls(agent_examples(spark, d)))


@query("p07_tool_sequence", sql(_EX, _NAMES + " SELECT e.example_id, coalesce(array_to_string(good, '>'), '') AS sequence, coalesce(array_to_string(good[:3], '>'), '') AS signature FROM fx_agent_ex e LEFT JOIN names n ON e.example_id = n.example_id"))
def p07(spark, d):
    return ft.tool_sequence(agent_examples(spark, d)).select("example_id", F.array_join("tool_sequence", ">").alias("sequence"), F.array_join("signature", ">").alias("signature"))


_LAST = ", la AS (SELECT example_id, arg_max(content, turn) AS said FROM fx_agent_msgs WHERE role = 'assistant' GROUP BY example_id)"


@query("p08_last_assistant_message", sql(_EX, _LAST + " SELECT e.example_id, said AS last_assistant FROM fx_agent_ex e LEFT JOIN la ON e.example_id = la.example_id"))
def p08(spark, d):
    return ft.last_assistant_message(agent_examples(spark, d)).select("example_id", "last_assistant")


@query("p09_has_final_summary", sql(_EX, _LAST + " SELECT e.example_id, coalesce(NOT contains(said, '<tool_call>') AND length(said) > 20, false) AS has_final_summary FROM fx_agent_ex e LEFT JOIN la ON e.example_id = la.example_id"))
def p09(spark, d):
    return agent_examples(spark, d).select("example_id", ft.has_final_summary(F.col("messages")).alias("has_final_summary"))


@query("p10_has_error_recovery", sql(_EX, """
  SELECT e.example_id, coalesce(bool_or(role = 'tool' AND regexp_matches(lower(content), 'error|failed|not found')), false) AS has_error_recovery
  FROM fx_agent_ex e LEFT JOIN fx_agent_msgs m ON e.example_id = m.example_id GROUP BY e.example_id"""))
def p10(spark, d):
    return agent_examples(spark, d).select("example_id", ft.has_error_recovery(F.col("messages")).alias("has_error_recovery"))


_WRITES = ", ".join(f"'{t}'" for t in rd.WRITE_TOOLS)


@query("p11_ends_with_write", sql(_EX, _NAMES + f" SELECT e.example_id, coalesce(list_has_any(good[-2:], [{_WRITES}]), false) AS ends_with_write FROM fx_agent_ex e LEFT JOIN names n ON e.example_id = n.example_id"))
def p11(spark, d):
    return agent_examples(spark, d).select("example_id", ft.ends_with_write(F.col("messages")).alias("ends_with_write"))


@query("p12_size_features", sql(_EX, CALLS + """
  SELECT e.example_id, CAST(count(m.role) AS INT) AS turns, CAST(count(*) FILTER (role = 'assistant') AS INT) AS assistant_turns, CAST(coalesce(sum(length(content)), 0) AS BIGINT) AS total_chars,
    CAST(coalesce(sum(length(content)), 0) AS BIGINT) // 4 AS token_estimate, CAST(any_value(coalesce(c.n, 0)) AS INT) AS n_tool_calls, any_value(coalesce(c.n, 0)) <= 1 AS single_tool
  FROM fx_agent_ex e LEFT JOIN fx_agent_msgs m ON e.example_id = m.example_id LEFT JOIN (SELECT example_id, count(*) AS n FROM calls GROUP BY example_id) c ON e.example_id = c.example_id GROUP BY e.example_id"""))
def p12(spark, d):
    return ft.size_features(agent_examples(spark, d)).select("example_id", "turns", "assistant_turns", "total_chars", "token_estimate", "n_tool_calls", "single_tool")


_SFT = r""", plain AS (SELECT example_id, turn, CASE WHEN role = 'tool' THEN 'user' ELSE role END AS role, CASE WHEN role = 'tool' THEN '<tool_result>' || chr(10) || c || chr(10) || '</tool_result>' ELSE c END AS content
  FROM (SELECT *, """ + _STRIP.format("content") + r""" AS c FROM fx_msgs_tool)),
  marked AS (SELECT *, CASE WHEN role = lag(role) OVER (PARTITION BY example_id ORDER BY turn) THEN 0 ELSE 1 END AS new FROM plain),
  grouped AS (SELECT *, sum(new) OVER (PARTITION BY example_id ORDER BY turn) AS g FROM marked),
  sft AS (SELECT example_id, g, any_value(role) AS role, string_agg(content, chr(10) || chr(10) ORDER BY turn) AS content FROM grouped GROUP BY example_id, g)"""


@query("p13_sft_convert", sql("fx_msgs_tool", _SFT + " SELECT example_id, CAST(g - 1 AS INT) AS turn, role, content FROM sft"))
def p13(spark, d):
    out = ft.sft_convert(nested(fx(spark, d, "fx_msgs_tool"), "task_id"))
    return ft.messages(out).select("example_id", "turn", "role", "content")


@query("p14_sft_keep", sql("fx_msgs_tool", """
  , k AS (SELECT example_id, arg_min(role, turn) = 'system' AND bool_or(role IN ('user', 'tool')) AND bool_or(role = 'assistant') AS keep FROM fx_msgs_tool GROUP BY example_id)
  SELECT count(*) AS total, count(*) FILTER (NOT keep) AS skipped FROM k"""))
def p14(spark, d):
    every = nested(fx(spark, d, "fx_msgs_tool"), "task_id")
    kept = ft.sft_keep(every).agg(F.count("*").alias("kept"))
    return every.agg(F.count("*").alias("total")).join(F.broadcast(kept), how="cross").select("total", (F.col("total") - F.col("kept")).alias("skipped"))


@query("p19_render_transcript", sql("fx_msgs", """
  SELECT example_id, string_agg('[' || upper(role) || ']' || chr(10) || CASE WHEN length(content) > 1500 THEN substr(content, 1, 1500) || chr(10) || '[... ' || (length(content) - 1500) || ' chars truncated ...]' ELSE content END, chr(10) || chr(10) ORDER BY turn) AS transcript
  FROM fx_msgs WHERE role <> 'system' GROUP BY example_id"""))
def p19(spark, d):
    return ft.render_transcript(examples(spark, d)).select("example_id", "transcript").where("transcript <> ''")


@query("p20_head_tail_truncate", sql("fx_docs", "SELECT example_id, CASE WHEN length(user_message) > 600 THEN substr(user_message, 1, 200) || chr(10) || '... [truncated] ...' || chr(10) || right(user_message, 400) ELSE user_message END AS cut FROM fx_docs"))
def p20(spark, d):
    return fx(spark, d, "fx_docs").select("example_id", ft.head_tail(F.col("user_message"), 600).alias("cut"))


_EXEC = """, sig AS (
  SELECT example_id, coalesce(bool_and(status <> 'error') FILTER (tool = 'write_file'), true) AS all_writes_ok, coalesce(bool_and(status <> 'error') FILTER (tool IN ('run_python', 'run_bash', 'bash')), true) AS all_code_ok,
    bool_and(NOT contains(lower(stderr), 'no such file')) AS no_file_not_found, coalesce(bool_and(NOT empty_file) FILTER (tool = 'write_file'), true) AS files_nonempty,
    count(*) AS n_calls, count(DISTINCT tool) AS unique_tools, arg_max(status, step) <> 'error' AS trace_completed FROM fx_exec GROUP BY example_id)"""


@query("p35_exec_quality_signals", sql("fx_exec", _EXEC + " SELECT * FROM sig"))
def p35(spark, d):
    return va.exec_quality_signals(fx(spark, d, "fx_exec"))


@query("v30_trace_quality_filter", sql("fx_exec", _EXEC + " SELECT example_id, n_calls FROM sig WHERE all_writes_ok AND all_code_ok AND n_calls <= 15 AND trace_completed"))
def v30(spark, d):
    return va.trace_quality_filter(va.exec_quality_signals(fx(spark, d, "fx_exec"))).select("example_id", "n_calls")


# ---- validators: DuckDB computes the whole issues table, each query takes its check ----


def _pairs(d: dict) -> str:
    return ", ".join(f"('{k}', '{v}')" for k, v in d.items())


_SIG = [(t, a, r) for t, (req, opt) in rd.TOOL_SIGNATURES.items() for a, r in [*[(x, 1) for x in req], *[(x, 0) for x in opt]]]
ISSUES = CALLS + rf""",
  sig(tool, arg, req) AS (VALUES {", ".join(f"('{t}', '{a}', {r})" for t, a, r in _SIG)}),
  tools(tool) AS (VALUES {", ".join(f"('{t}')" for t in rd.TOOL_SIGNATURES)}),
  typos(wrong, meant) AS (VALUES {_pairs(rd.TOOL_TYPOS)}),
  reqd(task_id, tool) AS (VALUES {", ".join(f"('{t}', '{x}')" for t, r in rd.REQUIRED_TOOLS.items() for x in r)}),
  m AS (SELECT *, {_STRIP.format("content")} AS c FROM fx_agent_msgs),
  h AS (SELECT example_id, any_value(task_id) AS task_id, count(*) AS n, arg_min(role, turn) AS r0, arg_max(role, turn) AS r9, arg_min(c, turn) FILTER (role = 'user') AS u0, coalesce(arg_max(content, turn) FILTER (role = 'assistant'), '') AS said,
          count(*) FILTER (role = 'assistant' AND c = '') AS blank, sum(length(content)) AS chars FROM m GROUP BY example_id),
  ca AS (SELECT *, row_number() OVER () AS cid FROM calls WHERE valid),
  ok AS (SELECT ca.* FROM ca JOIN tools ON ca.name = tools.tool),
  a AS (SELECT ok.*, u.key AS key FROM ok, LATERAL (SELECT unnest(keys) AS key) u),
  rep AS (SELECT example_id, task_id, count(*) AS n, name || '(' || coalesce((SELECT string_agg(k || '=' || json_extract_string(raw0, '$.arguments.' || k), ',' ORDER BY k) FROM (SELECT unnest(keys) AS k)), '') || ')' AS call FROM ca GROUP BY example_id, task_id, call HAVING count(*) > 3),
  issues AS (
    SELECT e.example_id, e.task_id, 'critical' AS severity, 'empty_messages' AS "check", 'Example has no messages' AS detail FROM fx_agent_ex e LEFT JOIN h ON e.example_id = h.example_id WHERE h.n IS NULL
    UNION ALL SELECT example_id, task_id, 'warning', 'missing_system', 'First message is not system role' FROM h WHERE r0 <> 'system'
    UNION ALL SELECT example_id, task_id, 'high', 'no_final_assistant', 'Last message role is ' || r9 FROM h WHERE r9 <> 'assistant'
    UNION ALL SELECT example_id, task_id, 'critical', 'no_user_message', 'No user message found' FROM h WHERE u0 IS NULL
    UNION ALL SELECT example_id, task_id, 'critical', 'empty_user_message', 'User message is empty' FROM h WHERE u0 = ''
    UNION ALL SELECT example_id, task_id, 'medium', 'truncated_response', 'Ends with ' || right(regexp_replace(said, '\s+$', ''), 1) FROM h WHERE length(said) > 100 AND NOT contains('.!?"'')}}>', right(regexp_replace(said, '\s+$', ''), 1))
    UNION ALL SELECT example_id, task_id, 'high', 'empty_assistant', blank || ' assistant message(s) have empty content' FROM h WHERE blank > 0
    UNION ALL SELECT example_id, task_id, 'medium', 'too_short', 'Only ' || n || ' messages' FROM h WHERE n < 4 AND task_id <> 'task_00'
    UNION ALL SELECT example_id, task_id, 'medium', 'very_short_content', 'Total content only ' || chars || ' chars' FROM h WHERE chars < 200 AND task_id <> 'task_00'
    UNION ALL SELECT example_id, task_id, 'medium', 'empty_tool_result', 'Tool result is empty' FROM m WHERE role = 'tool' AND c = ''
    UNION ALL SELECT example_id, task_id, 'high', 'placeholder_tool_result', 'Placeholder: ' || c FROM m WHERE role = 'tool' AND c IN ('...', 'TODO', 'placeholder', 'result')
    UNION ALL SELECT example_id, task_id, 'high', 'invalid_tool_json', substr(raw0, 1, 100) FROM calls WHERE NOT valid
    UNION ALL SELECT example_id, task_id, 'critical', 'invalid_tool_name', name || ' -> ' || coalesce(meant, 'unknown') FROM ca LEFT JOIN typos ON name = wrong WHERE name NOT IN (SELECT tool FROM tools)
    UNION ALL SELECT example_id, task_id, 'medium', 'missing_required_arg', name || ': ' || arg FROM ok JOIN sig ON name = tool AND req = 1 WHERE NOT list_contains(keys, arg) AND NOT EXISTS (SELECT 1 FROM sig o WHERE o.tool = name AND o.req = 0 AND list_contains(keys, o.arg))
    UNION ALL SELECT example_id, task_id, 'medium', 'unknown_arg', name || ': ' || key FROM a WHERE NOT EXISTS (SELECT 1 FROM sig s WHERE s.tool = name AND s.arg = key)
    UNION ALL SELECT example_id, task_id, 'medium', 'empty_arg', name || ': ' || key FROM a WHERE coalesce(json_extract_string(raw0, '$.arguments.' || key), '') = ''
    UNION ALL SELECT h.example_id, h.task_id, 'high', 'missing_required_tool', tool FROM h JOIN reqd ON h.task_id = reqd.task_id WHERE NOT EXISTS (SELECT 1 FROM ca WHERE ca.example_id = h.example_id AND ca.name = tool)
    UNION ALL SELECT example_id, task_id, 'high', 'repetitive_tool_calls', n || ' x ' || substr(call, 1, 100) FROM rep
    UNION ALL SELECT example_id, task_id, 'medium', 'excessive_tool_calls', count(*) || ' x ' || name FROM ca GROUP BY example_id, task_id, name HAVING count(*) > 20)"""

CHECKS = ("empty_messages missing_system no_final_assistant no_user_message empty_user_message invalid_tool_json invalid_tool_name missing_required_arg unknown_arg empty_arg "
          "missing_required_tool repetitive_tool_calls excessive_tool_calls truncated_response empty_assistant empty_tool_result placeholder_tool_result too_short very_short_content").split()  # fmt: skip

#: The operator that makes each check's rows.
_MAKERS = {
    va.message_issues: "empty_messages missing_system no_final_assistant no_user_message empty_user_message truncated_response empty_assistant empty_tool_result placeholder_tool_result too_short very_short_content".split(),
    lambda e: va.call_issues(ft.tool_calls(e)): "invalid_tool_json invalid_tool_name missing_required_arg unknown_arg empty_arg".split(),
    va.required_tool_issues: ["missing_required_tool"],
    lambda e: va.repetition_issues(ft.tool_calls(e)): "repetitive_tool_calls excessive_tool_calls".split(),
}
for _make, _names in _MAKERS.items():
    for _c in _names:
        _key = f"v{CHECKS.index(_c) + 1:02d}_{_c}"
        Q[_key] = lambda spark, d, make=_make, c=_c: make(agent_examples(spark, d)).where(F.col("check") == c)
        SQL[_key] = sql(_EX, ISSUES + f""" SELECT * FROM issues WHERE "check" = '{_c}'""")


def _issues(e):
    """The issues as a stored table, for reports that read it several times."""
    return stored(va.issues(e), "issues")


@query("v20_validate_report", sql(_EX, ISSUES + """, per AS (SELECT example_id, bool_or(severity IN ('critical', 'high')) AS bad FROM issues GROUP BY example_id)
  SELECT 'examples' AS kind, unnest(['total', 'clean', 'with_issues', 'critical_high']) AS name, unnest([count(*), count(*) FILTER (bad IS NULL), count(bad), count(*) FILTER (bad)]) AS n FROM fx_agent_ex e LEFT JOIN per ON e.example_id = per.example_id
  UNION ALL SELECT 'severity', severity, count(*) FROM issues GROUP BY severity UNION ALL SELECT 'check', "check", count(*) FROM issues GROUP BY "check" """))
def v20(spark, d):
    e = agent_table(spark, d)
    return va.validate_report(e, _issues(e))


@query("l01_worst_tasks", sql(_EX, ISSUES + """, per AS (SELECT task_id, "check", count(*) AS check_n FROM issues GROUP BY ALL),
  t AS (SELECT task_id, CAST(sum(check_n) AS BIGINT) AS n FROM per GROUP BY task_id ORDER BY n DESC, task_id LIMIT 10),
  t2 AS (SELECT *, row_number() OVER (ORDER BY n DESC, task_id) AS rank FROM t),
  c AS (SELECT *, row_number() OVER (PARTITION BY task_id ORDER BY check_n DESC, "check") AS check_rank FROM per)
  SELECT t2.task_id, n, CAST(rank AS INT) AS rank, "check", check_n, CAST(check_rank AS INT) AS check_rank FROM t2 JOIN c ON t2.task_id = c.task_id WHERE check_rank <= 3"""))
def l01(spark, d):
    return va.worst_tasks(_issues(agent_table(spark, d))).select("task_id", "n", "rank", "check", "check_n", "check_rank")


@query("v21_validate_fix", sql(_EX, ISSUES + " SELECT example_id FROM fx_agent_ex WHERE example_id NOT IN (SELECT example_id FROM issues WHERE severity IN ('critical', 'high'))"))
def v21(spark, d):
    e = agent_table(spark, d)
    return va.validate_fix(e, va.issues(e)).select("example_id")


@query("v22_bad_examples_detail", sql(_EX, ISSUES + """, b AS (SELECT DISTINCT example_id FROM issues WHERE severity IN ('critical', 'high')),
  u AS (SELECT example_id, arg_min(content, turn) AS content FROM fx_agent_msgs WHERE role = 'user' GROUP BY example_id),
  i AS (SELECT example_id, string_agg(severity || ':' || "check", '|' ORDER BY severity || ':' || "check") AS issues FROM issues GROUP BY example_id),
  c AS (SELECT example_id, list(coalesce(name, '?') || '(' || coalesce(array_to_string(list_sort(keys), ','), '') || ')') AS l FROM calls GROUP BY example_id)
  SELECT b.example_id, e.task_id, substr(coalesce(u.content, ''), 1, 200) AS user_message, i.issues, array_to_string(list_sort(l), '|') AS calls
  FROM b JOIN fx_agent_ex e ON b.example_id = e.example_id LEFT JOIN u ON b.example_id = u.example_id JOIN i ON b.example_id = i.example_id LEFT JOIN c ON b.example_id = c.example_id"""))
def v22(spark, d):
    e = agent_table(spark, d)
    out = va.bad_examples_detail(e, _issues(e))
    return out.select("example_id", "task_id", "user_message", F.array_join("issues", "|").alias("issues"), F.array_join("calls", "|").alias("calls"))


@query("v23_record_check", sql(_EX, r"""
  SELECT e.example_id, e.task_id, coalesce(NOT bool_or(role = 'system'), true) AS no_system, coalesce(NOT bool_or(role = 'user'), true) AS no_user, coalesce(NOT bool_or(role = 'assistant'), true) AS no_assistant,
    coalesce(arg_max(role, turn) <> 'assistant', false) AS last_not_assistant, coalesce(bool_or(role = 'user' AND regexp_matches(content, '^\s*$')), false) AS empty_user
  FROM fx_agent_ex e LEFT JOIN fx_agent_msgs m ON e.example_id = m.example_id GROUP BY e.example_id, e.task_id"""))
def v23(spark, d):
    return va.record_check(agent_examples(spark, d))


@query("v24_no_tool_call", sql("fx_msgs", f"""
  SELECT example_id, task_id FROM fx_msgs WHERE task_id NOT IN ('task_00', 'task_03') GROUP BY example_id, task_id HAVING NOT bool_or(role = 'assistant' AND contains(content, '<tool_call>'))"""))
def v24(spark, d):
    return va.no_tool_call(examples(spark, d))


@query("v25_unknown_tools", sql(_EX, ISSUES + """
  SELECT example_id, array_to_string(list_sort(list_distinct(list(name) FILTER (valid AND name NOT IN (SELECT tool FROM tools)))), '|') AS unknown, CAST(count(*) FILTER (NOT valid) AS INT) AS n_invalid
  FROM calls GROUP BY example_id HAVING count(*) FILTER (NOT valid) > 0 OR count(*) FILTER (valid AND name NOT IN (SELECT tool FROM tools)) > 0"""))
def v25(spark, d):
    return va.unknown_tools(agent_examples(spark, d)).select("example_id", F.when(F.size("unknown") > 0, tx.joined(F.col("unknown"))).alias("unknown"), "n_invalid")


#: Values that the derived conversations have in part.
_EXPECTED = {"task_08": ("f1.txt",), "task_19": ("c0", "c1"), "task_21": ("f2.txt", *rd.EXPECTED_VALUES["task_21"])}


@query("v26_missing_expected_values", sql(_EX, f""", v(task_id, value) AS (VALUES {", ".join(f"('{t}', '{x}')" for t, r in _EXPECTED.items() for x in r)}),
  x AS (SELECT e.example_id, e.task_id, coalesce(string_agg(content, ' '), '') AS txt FROM fx_agent_ex e LEFT JOIN fx_agent_msgs m ON e.example_id = m.example_id GROUP BY e.example_id, e.task_id)
  SELECT example_id, x.task_id, value FROM x JOIN v ON x.task_id = v.task_id WHERE NOT contains(txt, value)"""))
def v26(spark, d):
    return va.missing_expected_values(agent_examples(spark, d), _EXPECTED)


@query("v27_short_or_truncated", sql(_EX, r""", h AS (SELECT e.example_id, coalesce(sum(length(content)), 0) AS chars, coalesce(arg_max(content, turn) FILTER (role = 'assistant'), '') AS said FROM fx_agent_ex e LEFT JOIN fx_agent_msgs m ON e.example_id = m.example_id GROUP BY e.example_id),
  r AS (SELECT example_id, chars < 200 AS short, length(said) > 100 AND NOT contains('.!?")}''`', right(regexp_replace(said, '\s+$', ''), 1)) AS truncated FROM h) SELECT * FROM r WHERE short OR truncated"""))
def v27(spark, d):
    return va.short_or_truncated(agent_examples(spark, d))


@query("v28_issue_breakdown", sql(_EX, ISSUES + ' SELECT "check", count(*) AS n, count(DISTINCT example_id) AS examples FROM issues GROUP BY "check"'))
def v28(spark, d):
    return va.issue_breakdown(va.issues(agent_table(spark, d)))


@query("v28_clean_resplit", sql(_EX, ISSUES + """, c AS (SELECT example_id, task_id, row_number() OVER (PARTITION BY task_id ORDER BY md5(CAST(example_id AS VARCHAR) || 's'), example_id) AS r, count(*) OVER (PARTITION BY task_id) AS n FROM fx_agent_ex WHERE example_id NOT IN (SELECT example_id FROM issues))
  SELECT example_id, task_id, CASE WHEN r <= least(n, greatest(2, round_even(n * 0.1::DOUBLE, 0))) THEN 'val' ELSE 'train' END AS split FROM c"""))
def v28_clean_resplit(spark, d):
    e = agent_table(spark, d)
    return va.clean_and_resplit(e, va.issues(e))[0].select("example_id", "task_id", "split")


_REVIEWED = f"""{CALLS}, tv AS (SELECT example_id, count(*) FILTER (valid) AS k FROM calls GROUP BY example_id),
  rk AS (SELECT e.example_id, e.task_id, coalesce(k, 0) AS k, row_number() OVER (PARTITION BY e.task_id ORDER BY md5(CAST(e.example_id AS VARCHAR) || 'r'), e.example_id) AS r, count(*) OVER (PARTITION BY e.task_id) AS n FROM fx_agent_ex e LEFT JOIN tv ON e.example_id = tv.example_id),
  tk AS (SELECT task_id, any_value(n) AS n, string_agg(CAST(example_id AS VARCHAR), ',' ORDER BY r) || ' ' || sum(k) AS shown, CAST(right(task_id, 2) AS INT) % 5 AS m FROM rk WHERE r <= 3 GROUP BY task_id)
  SELECT task_id, CASE WHEN m = 0 THEN NULL WHEN m = 1 THEN 'GOOD' WHEN n % 3 = 0 THEN 'UNKNOWN' WHEN n % 3 = 1 THEN 'GOOD' ELSE 'BAD' END AS verdict,
    CASE WHEN m IN (0, 1) THEN NULL WHEN n % 3 = 0 THEN 'no verdict on ' || shown ELSE shown END AS reasoning, CASE WHEN m = 0 THEN 'no ground truth' END AS skipped FROM tk"""


@query("v30_review_with", sql(_EX, _REVIEWED))
def v30_review_with(spark, d):
    """The reviewer hook with a reviewer that looks at sizes alone; some tasks have a verdict, some no ground truth."""

    def reviewer(tasks):
        import json

        out = []
        for n, sample in zip(tasks["n"], tasks["sample"], strict=True):
            shown = f"{','.join(str(s['example_id']) for s in sample)} {sum(len(s['tools']) for s in sample)}"
            reply = json.dumps({"verdict": "GOOD" if n % 3 == 1 else "BAD", "reasoning": shown, "issues": ["x"]})
            out.append(f"no verdict on {shown}" if n % 3 == 0 else f"```json\n{reply}\n```" if n % 2 else reply)
        return out

    e = agent_table(spark, d)
    number = F.right("task_id", F.lit(2)).cast("int") % 5
    tasks = e.select("task_id").distinct()
    known = tasks.where(number == 1).select("task_id", F.lit("GOOD").alias("verdict"))
    out = registry.review_with(e, tasks.where(number != 0).select("task_id", F.lit("a task").alias("truth")), reviewer, known)
    return out.select("task_id", "verdict", "reasoning", "skipped")


@query("v29_structural_summary", sql(_EX, ISSUES + """, per AS (SELECT example_id, bool_or(severity = 'critical') AS c FROM issues GROUP BY example_id)
  SELECT count(*) AS total, count(*) FILTER (c IS NULL) AS clean, count(*) FILTER (c) AS critical FROM fx_agent_ex e LEFT JOIN per ON e.example_id = per.example_id"""))
def v29(spark, d):
    e = agent_table(spark, d)
    return va.structural_summary(e, va.issues(e))
