"""Views over the given tables, written in SQL that Spark and DuckDB both run.

Each query reads the tables through these views, and its DuckDB twin starts with the same
text, so both engines see the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.io import stored

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "labels", "conversations", "benchmark", "pages", "embeddings")

_TASK = "'task_' || lpad(CAST({} % 23 AS STRING), 2, '0')"

#: name: (views and tables it reads, text)
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    # conversations as messages of examples
    "fx_msgs": (("conversations",), f"""
        SELECT conv_id AS example_id, conv_id AS pos, {_TASK.format("conv_id")} AS task_id, CASE WHEN conv_id % 10 = 0 THEN 'val' ELSE 'train' END AS split,
               CASE WHEN conv_id % 3 = 0 THEN 'original' ELSE 'generated' END AS source, turn, role, text AS content FROM conversations"""),
    "fx_ex": (("fx_msgs",), "SELECT DISTINCT example_id, pos, task_id, split, source FROM fx_msgs"),
    "fx_msgs_tool": (("fx_msgs",), "SELECT example_id, pos, task_id, split, source, turn, CASE WHEN turn % 3 = 1 THEN 'tool' ELSE role END AS role, content FROM fx_msgs"),
    # events as tool calls
    "fx_calls0": (("events",), f"""
        SELECT event_id, user_id, event_type, CASE WHEN user_id % 3 = 0 THEN user_id * 100 ELSE user_id * 100 + day(ts) END AS example_id, {_TASK.format("user_id")} AS task_id,
               CASE event_type WHEN 'click' THEN 'read_file' WHEN 'error' THEN 'read_file' WHEN 'view' THEN 'list_files' WHEN 'purchase' THEN 'write_file' ELSE 'bash' END AS tool,
               CAST(CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) % 3 AS STRING) AS k FROM events"""),
    "fx_calls": (("fx_calls0",), """
        SELECT event_id, user_id, event_type, example_id, task_id, tool, k, row_number() OVER (PARTITION BY example_id ORDER BY event_id) AS call_no,
               '<tool_call>' || '{"name": "' || tool || '", "arguments": ' || CASE event_id % 5 WHEN 0 THEN '{"path": "f' || k || '.txt"}}' WHEN 1 THEN '{"path": "", "content": "x"}}'
                 WHEN 2 THEN '{"k": ' || k || '}}' WHEN 3 THEN '{"path": "a", "content": "c' || k || '"}}' ELSE '{"path": "f' END || '</tool_call>' AS text,
               CASE WHEN event_type = 'error' THEN 'Error: file not found' WHEN event_id % 7 = 0 THEN ' ' WHEN event_id % 11 = 0 THEN 'TODO' ELSE 'ok ' || CAST(event_id % 100 AS STRING) END AS result
        FROM fx_calls0"""),
    "fx_agent_ex": (("fx_calls",), f"""
        SELECT DISTINCT example_id, example_id AS pos, task_id, CASE WHEN example_id % 10 = 0 THEN 'val' ELSE 'train' END AS split FROM fx_calls
        UNION ALL SELECT DISTINCT 90000000 + user_id, 90000000 + user_id, {_TASK.format("user_id")}, 'train' FROM fx_calls WHERE user_id % 10 = 0"""),
    "fx_agent_raw": (("fx_calls", "fx_agent_ex"), """
        SELECT example_id, 0 AS o, 'system' AS role, 'You are an agent with tools.' AS content FROM fx_agent_ex WHERE example_id % 7 <> 0 AND example_id < 90000000
        UNION ALL SELECT example_id, 1, 'user', CASE WHEN example_id % 13 = 0 THEN ' ' ELSE 'Please do job ' || CAST(example_id % 50 AS STRING) || ' now' END FROM fx_agent_ex WHERE example_id % 17 <> 0 AND example_id < 90000000
        UNION ALL SELECT example_id, 2 * call_no, 'assistant', text FROM fx_calls
        UNION ALL SELECT example_id, 2 * call_no + 1, 'tool', result FROM fx_calls
        UNION ALL SELECT example_id, 1000000, 'assistant', CASE example_id % 4 WHEN 0 THEN 'Done. All the files were written and checked.' WHEN 1 THEN 'Done' WHEN 2 THEN repeat('word ', 30) ELSE '' END
          FROM fx_agent_ex WHERE example_id % 11 <> 0 AND example_id < 90000000"""),
    "fx_agent_msgs": (("fx_agent_raw", "fx_agent_ex"), """
        SELECT r.example_id, e.pos, e.task_id, e.split, row_number() OVER (PARTITION BY r.example_id ORDER BY o) - 1 AS turn, role, content FROM fx_agent_raw r JOIN fx_agent_ex e ON r.example_id = e.example_id"""),
    # documents as scored examples
    "fx_docs": (("documents",), "SELECT doc_id AS example_id, doc_id AS pos, source AS task_id, lang, text AS user_message, substr(text, 1, 80) AS user_prefix, CASE WHEN doc_id % 4 = 0 THEN 'original' ELSE 'generated' END AS source FROM documents"),
    "fx_scores0": (("documents", "labels"), """
        SELECT d.doc_id, d.source AS task_id, substr(d.text, 1, 80) AS user_prefix,
               CASE WHEN quality = 1 AND toxic = 0 THEN 5 WHEN quality = 1 THEN 3 WHEN toxic = 0 THEN 2 ELSE 1 END AS score, quality, toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id"""),
    "fx_scores": (("fx_scores0",), """
        SELECT task_id, user_prefix, score, quality, toxic, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY task_id, user_prefix ORDER BY doc_id DESC) AS rn FROM fx_scores0) t WHERE rn = 1"""),
    # orders as benchmark runs and dataset snapshots
    "fx_orders": (("orders",), f"SELECT o_orderkey, (year(o_orderdate) - 1992) * 4 + quarter(o_orderdate) AS version, {_TASK.format('o_custkey')} AS task_id, CASE WHEN o_orderstatus = 'F' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS hit FROM orders"),
    "fx_bench": (("fx_orders",), "SELECT version, task_id, avg(hit) AS score FROM fx_orders GROUP BY version, task_id"),
    "fx_snapshot": (("fx_orders",), "SELECT version, task_id, count(*) AS n FROM fx_orders GROUP BY version, task_id"),
    "fx_runs": (("fx_orders",), "SELECT version, o_orderkey % 2 AS run, task_id, avg(hit) AS score FROM fx_orders GROUP BY version, o_orderkey % 2, task_id"),
    "fx_log": (("fx_bench",), """
        SELECT version AS run_id, row_number() OVER (PARTITION BY version ORDER BY task_id, part) AS line_no, line FROM (
          SELECT version, task_id, 1 AS part, 'INFO starting task: ' || task_id AS line FROM fx_bench
          UNION ALL SELECT version, task_id, 2, CASE CAST(right(task_id, 2) AS INT) % 4 WHEN 0 THEN 'agent read_file read_file read_file read_file read_file read_file loop' WHEN 1 THEN 'error: file not found' WHEN 2 THEN 'output was truncated, malformed json' ELSE 'fine' END FROM fx_bench
          UNION ALL SELECT version, task_id, 3, 'Task ' || task_id || ': ' || CAST(CAST(floor(score * 100) AS INT) AS STRING) || '/100 (' || CAST(CAST(floor(score * 100) AS INT) AS STRING) || '%)' FROM fx_bench
          UNION ALL SELECT version, task_id, 4, 'Notes: ' || CASE CAST(right(task_id, 2) AS INT) % 3 WHEN 0 THEN 'missing output file' WHEN 1 THEN 'wrong format of the answer' ELSE 'tool call failed' END FROM fx_bench) t"""),
    # events as an action log and as an execution log
    "fx_actions": (("events",), """
        SELECT user_id AS session_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS turn, event_id,
               CASE event_type WHEN 'click' THEN 'generate_data' WHEN 'purchase' THEN 'train' WHEN 'view' THEN 'benchmark' WHEN 'signup' THEN 'diagnose' ELSE 'filter_data' END AS action,
               CASE WHEN event_type = 'error' THEN 'error' WHEN event_id % 19 = 0 THEN 'blocked' ELSE 'success' END AS status, event_id % 6 AS added, value AS cost, ts FROM events"""),
    "fx_exec": (("fx_calls",), """
        SELECT example_id, call_no AS step, tool, CASE WHEN event_type = 'error' THEN 'error' ELSE 'ok' END AS status, CASE WHEN event_type = 'error' THEN 'No such file or directory' ELSE '' END AS stderr, event_id % 9 = 0 AS empty_file FROM fx_calls"""),
    # old and new repair scores, and row-level gold and current datasets
    "fx_repairs": (("fx_docs", "fx_scores"), """
        SELECT d.example_id, d.task_id, d.user_prefix, s.score AS old_score, CASE WHEN d.example_id % 11 = 0 THEN NULL ELSE 1 + d.example_id % 5 END AS new_score
        FROM fx_docs d JOIN fx_scores s ON d.task_id = s.task_id AND d.user_prefix = s.user_prefix"""),
    "fx_gold": (("fx_orders",), "SELECT o_orderkey AS example_id, task_id FROM fx_orders WHERE version = 20"),
    "fx_current": (("fx_orders",), "SELECT o_orderkey AS example_id, task_id FROM fx_orders WHERE version = 21"),
    # model output, task documents and diagnoses
    "fx_generated": (("conversations",), """
        SELECT conv_id, 'dynamic__task_' || lpad(CAST(conv_id % 23 AS STRING), 2, '0') || '__terse__' || lpad(CAST(conv_id AS STRING), 6, '0') AS custom_id,
               CASE WHEN conv_id % 13 = 0 THEN 'errored' ELSE 'succeeded' END AS status,
               CASE WHEN conv_id % 7 = 0 THEN '```json' || chr(10) || '[{"user_message": "u' || CAST(conv_id AS STRING) ELSE
                 '```json' || chr(10) || '[{"user_message": "u' || CAST(conv_id AS STRING) || '", "turns": [{"role": "assistant", "content": "t' || CAST(n AS STRING) || '"}, {"role": "tool_result", "content": "r"}, {"role": "assistant", "content": "end"}]}]' || chr(10) || '```' END AS raw_text
        FROM (SELECT conv_id, count(*) AS n FROM conversations GROUP BY conv_id) c"""),
    "fx_taskdocs": (("part",), """
        SELECT p_partkey AS doc_id, '---' || chr(10) || 'id: task_' || lpad(CAST(p_partkey % 30 AS STRING), 2, '0') || chr(10) || 'name: ' || p_name || chr(10) || 'category: ' || p_brand || chr(10) || '---' || chr(10) ||
               '# Prompt' || chr(10) || 'Save the list as `file_' || CAST(p_size AS STRING) || '.txt` please.' || chr(10) || '## Expected Behavior' || chr(10) || '| price | ' || CAST(CAST(p_retailprice AS INT) AS STRING) || ' |' || chr(10) || 'It says "' || p_type || '" there.' AS body FROM part"""),
    # the same of many shapes: parts that are missing, repeated, misplaced or malformed
    "fx_taskdocs_mixed": (("part",), """
        SELECT p_partkey AS doc_id, CASE WHEN p_partkey % 4 = 0 THEN '' ELSE '---' || chr(10) || 'id: task' || chr(10) || '---' || chr(10) END || 'Text before any heading' || chr(10) ||
               CASE p_partkey % 3 WHEN 0 THEN '# Prompt' WHEN 1 THEN '##  PROMPT ' ELSE '### prompt' END || chr(10) || 'Save the list as `file_' || CAST(p_size AS STRING) || '.txt`.' || chr(10) ||
               CASE WHEN p_partkey % 6 = 0 THEN '#### Notes' || chr(10) || 'keep # this' || chr(10) ELSE chr(10) END ||
               '## Expected  Behavior' || chr(10) || CASE p_partkey % 8 WHEN 0 THEN '**Output**: `http://host/a.txt`' WHEN 1 THEN '**File**: `dir/b b.txt`' ELSE '#none' END || chr(10) ||
               CASE WHEN p_partkey % 5 = 0 THEN '# Prompt' || chr(10) || 'Again, create "other_' || CAST(p_size AS STRING) || '.csv".' || chr(10) ELSE '' END ||
               CASE WHEN p_partkey % 7 = 0 THEN '## Empty' ELSE '' END AS body,
               '| # | Expected Answer |' || chr(10) || '|---|---|' || chr(10) || '| 1 | ' || CAST(p_size AS STRING) || ' |' || chr(10) || '|  22 |' || CASE WHEN p_partkey % 3 = 0 THEN '---none' ELSE p_brand END || '|' || chr(10) ||
               'It Should say "' || p_type || '" or `not this`' || chr(10) || 'correct: ' || CASE WHEN p_partkey % 4 = 0 THEN '"' || repeat('y', 120) || '"' ELSE '` c_' || CAST(p_size AS STRING) || ' `' END AS answers, p_size, p_brand, p_type FROM part"""),
    "fx_request_ids": (("conversations",), """
        SELECT conv_id, CASE conv_id % 5 WHEN 0 THEN 'dynamic__task_01__terse__000' || CAST(conv_id AS STRING) WHEN 1 THEN 'dynamic__task_02' WHEN 2 THEN 'topup____terse__abc' WHEN 3 THEN 'gap__task_03__terse__7__extra' ELSE 'plain' END AS custom_id
        FROM (SELECT DISTINCT conv_id FROM conversations) c"""),
    "fx_blob_log": (("fx_bench",), """
        SELECT version AS run_id, 4 * CAST(right(task_id, 2) AS INT) + part AS line_no, line FROM (
          SELECT version, task_id, 0 AS part, 'INFO {"' || task_id || '": 0.125, "other": 2} {"' || task_id || '_x": 1} done' AS line FROM fx_bench
          UNION ALL SELECT version, task_id, 1, '{"task_99": 0.5} then {"a": 1, "' || task_id || '": ' || CAST(CAST(floor(score * 100) AS INT) AS STRING) || '}' FROM fx_bench WHERE CAST(right(task_id, 2) AS INT) % 3 = 0
          UNION ALL SELECT version, task_id, 2, '{"' || task_id || '": null}' FROM fx_bench WHERE CAST(right(task_id, 2) AS INT) % 4 = 0
          UNION ALL SELECT version, task_id, 3, 'cut {"' || task_id || '": 0.9' FROM fx_bench WHERE CAST(right(task_id, 2) AS INT) % 5 = 0) t"""),
    "fx_causes": (("nation", "region"), "SELECT r_regionkey AS diagnosis_id, r_name AS cause, 'fix ' || lower(r_name) AS fix, 'task_' || lpad(CAST(n_nationkey % 23 AS STRING), 2, '0') AS task_id FROM nation JOIN region ON n_regionkey = r_regionkey"),
    "fx_fixes": (("nation",), "SELECT 'task_' || lpad(CAST(n_nationkey % 23 AS STRING), 2, '0') AS task_id, 'regenerate' AS action, 'reason ' || lower(n_name) AS reason FROM nation WHERE n_nationkey % 3 = 0"),
    "fx_targets": (("fx_bench", "fx_snapshot"), """
        SELECT b.version, b.task_id, b.score, s.n, CAST(right(b.task_id, 2) AS INT) % 3 + 1 AS priority FROM fx_bench b JOIN fx_snapshot s ON b.version = s.version AND b.task_id = s.task_id"""),
}


def _order(names: tuple[str, ...], done: list[str]) -> list[str]:
    for n in names:
        if n in VIEWS and n not in done:
            _order(VIEWS[n][0], done)
            done.append(n)
    return done


def _tables(views: list[str]) -> list[str]:
    return sorted({t for v in views for t in VIEWS[v][0] if t in TABLES})


def fx(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view as a DataFrame over the tables in ``sf_dir``."""
    views = _order((name,), [])
    parts = [f"{t} AS (SELECT * FROM parquet.`{sf_dir}/{t}.parquet`)" for t in _tables(views)] + [f"{v} AS ({VIEWS[v][1]})" for v in views]
    return spark.sql(f"WITH {', '.join(parts)} SELECT * FROM {name}")


def sql(views: str, text: str) -> str:
    """A DuckDB query that starts with the named views (space-separated); ``text`` may begin with more of its own (``, x AS (...) SELECT``)."""
    parts = ", ".join(f"{v} AS ({VIEWS[v][1]})" for v in _order(tuple(views.split()), []))
    body = text.strip()
    return f"WITH {parts} {body}" if parts else (f"WITH {body[1:]}" if body.startswith(",") else body)


def nested(flat: DataFrame, *columns: str) -> DataFrame:
    """Examples with ``messages`` from the flat message form."""
    rows = flat.groupBy("example_id", *columns).agg(F.sort_array(F.collect_list(F.struct("turn", "role", "content"))).alias("m"))
    return rows.select("example_id", *columns, F.transform("m", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).alias("messages"))


def examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested(fx(spark, sf_dir, "fx_msgs"), "pos", "task_id", "split", "source")


def agent_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as a stored table, for queries that read it several times."""
    return stored(agent_examples(spark, sf_dir), "agent-examples")


def agent_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tool-using conversations, some of them without any message."""
    some = nested(fx(spark, sf_dir, "fx_agent_msgs"), "pos", "task_id", "split")
    head = fx(spark, sf_dir, "fx_agent_ex")
    none = F.expr("cast(array() as array<struct<role:string,content:string>>)")
    return head.join(some.select("example_id", "messages"), "example_id", "left").withColumn("messages", F.coalesce("messages", none))
