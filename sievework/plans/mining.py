"""Queries on logs, model output, task documents, near duplicates, files and streams (P15-P36, A22, A23, N, S, R, L02)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import refdata as rd
from ..operators import dedup as dd
from ..operators import logs as lg
from ..operators import parsing as ps
from ..operators import scores as sc
from ..sources import io
from ..streaming import streams as st
from .fixtures import examples, fx, sql

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


# ---- logs --------------------------------------------------------------------------


def _log(spark, d):
    return fx(spark, d, "fx_log")


_SCORED = r""", sl AS (SELECT run_id, regexp_extract(line, '(task_\d{2}\w*):\s*([0-9.]+)/100', 1) AS task_id, CAST(regexp_extract(line, '(task_\d{2}\w*):\s*([0-9.]+)/100', 2) AS DOUBLE) / 100 AS score FROM fx_log WHERE regexp_matches(line, '(task_\d{2}\w*):\s*([0-9.]+)/100'))"""


@query("p27_parse_model_version", sql("fx_bench", " SELECT version, task_id, CASE WHEN version % 4 < 2 THEN version END AS parsed FROM fx_bench"))
def p27(spark, d):
    v = F.col("version").cast("string")
    names = F.array(F.concat(F.lit("agent-8b-v"), v), F.concat(F.lit("agent-v2-v"), v), F.concat(F.lit("agent-v"), v, F.lit("-beta")), F.concat(F.lit("agentv"), v))
    named = fx(spark, d, "fx_bench").withColumn("name", F.element_at(names, (F.col("version") % 4 + 1).cast("int")))
    return named.select("version", "task_id", lg.model_version(F.col("name")).cast("long").alias("parsed"))


@query("p28_parse_scores_regex", sql("fx_log", _SCORED + " SELECT run_id, task_id, score FROM sl"))
def p28(spark, d):
    return lg.scores_of_lines(_log(spark, d), rd.task_table(spark))


@query("p29_parse_scores_json_blob", sql("fx_bench", " SELECT version AS run_id, task_id, round(score, 4) AS score FROM fx_bench"))
def p29(spark, d):
    blob = F.concat(F.lit('INFO {"'), "task_id", F.lit('": '), F.round("score", 4).cast("string"), F.lit("} done"))
    log = fx(spark, d, "fx_bench").select(F.col("version").alias("run_id"), F.right("task_id", F.lit(2)).cast("int").alias("line_no"), blob.alias("line"))
    return lg.scores_of_blobs(log, rd.task_table(spark))


@query("p29_blobs_of_many_shapes", sql("fx_bench", """
  SELECT version AS run_id, task_id, CASE WHEN CAST(right(task_id, 2) AS INT) % 3 = 0 THEN floor(score * 100)::DOUBLE ELSE 0.125::DOUBLE END AS score FROM fx_bench"""))
def p29_many_shapes(spark, d):
    """Two objects on a line, later lines, nulls, unknown tasks and objects that are cut off."""
    return lg.scores_of_blobs(fx(spark, d, "fx_blob_log"), rd.task_table(spark))


@query("p30_resolve_task_prefix", """WITH n AS (SELECT DISTINCT 'task_' || CAST(p_partkey % 40 AS VARCHAR) AS name FROM part), r AS (SELECT 'task_' || lpad(CAST(i AS VARCHAR), 2, '0') AS task_id FROM range(0, 23) t(i)),
  m AS (SELECT name, count(*) AS c, min(task_id) AS first_id, bool_or(task_id = name) AS exact FROM n JOIN r ON starts_with(task_id, name) GROUP BY name) SELECT name, CASE WHEN exact THEN name ELSE first_id END AS task_id FROM m WHERE c = 1 OR exact""")
def p30(spark, d):
    names = spark.read.parquet(f"{d}/part.parquet").select(F.concat(F.lit("task_"), (F.col("p_partkey") % 40).cast("string")).alias("name"))
    return lg.resolve_task_prefix(names, rd.task_table(spark))


_SEC = ", se AS (SELECT *, sum(CASE WHEN contains(line, 'starting task: ') THEN 1 ELSE 0 END) OVER (PARTITION BY run_id ORDER BY line_no) AS section FROM fx_log), sx AS (SELECT run_id, CAST(section AS BIGINT) AS section, regexp_extract(arg_min(line, line_no), 'starting task: (\\S+)', 1) AS task_id, string_agg(line, chr(10) ORDER BY line_no) AS txt FROM se WHERE section > 0 GROUP BY run_id, section)".replace("\\\\", "\\")


@query("p31_log_sections", sql("fx_log", _SEC + " SELECT run_id, section, task_id, txt AS lines FROM sx"))
def p31(spark, d):
    return lg.log_sections(_log(spark, d)).withColumn("lines", F.array_join("lines", "\n"))


@query("p32_failure_patterns", sql("fx_log", _SEC + r""", lo AS (SELECT *, lower(txt) AS t FROM sx) SELECT run_id, section, task_id, len(regexp_extract_all(t, 'tool_call')) > 10 AS excessive_tool_calls, contains(t, 'loop') OR len(regexp_extract_all(t, 'read_file')) > 5 AS looping,
  contains(t, 'not found') OR contains(t, 'no such file') AS wrong_filename, contains(t, 'pk') AND contains(t, 'bytes') AS binary_as_text, contains(t, 'truncat') OR contains(t, 'cut off') AS truncation, contains(t, 'failed to parse transcript') OR contains(t, 'malformed') AS malformed_output,
  substr(regexp_extract(txt, 'Notes:\s*([^\n]*)', 1), 1, 500) AS notes FROM lo"""))
def p32(spark, d):
    return lg.failure_patterns(lg.section_lines(_log(spark, d))).drop("errors")


_CAT = _SEC + _SCORED + r""", nc AS (SELECT sx.run_id, sx.task_id, sl.score, lower(regexp_extract(txt, 'Notes:\s*([^\n]*)', 1)) AS n FROM sx JOIN sl ON sx.run_id = sl.run_id AND sx.task_id = sl.task_id),
  ca AS (SELECT run_id, task_id, score, concat_ws(' | ', CASE WHEN contains(n, 'truncated') OR contains(n, 'only shows') OR contains(n, 'partial') THEN 'INCOMPLETE' END, CASE WHEN contains(n, 'no evidence') OR contains(n, 'did not') OR contains(n, 'never') THEN 'MISSING_OUTPUT' END,
      CASE WHEN contains(n, 'error') AND (contains(n, 'stopped') OR contains(n, 'gave up')) THEN 'ERROR_QUIT' END, CASE WHEN contains(n, 'wrong') OR contains(n, 'incorrect') THEN 'WRONG_OUTPUT' END, CASE WHEN contains(n, 'one') AND (contains(n, 'file') OR contains(n, 'read') OR contains(n, 'attempt')) THEN 'ONE_STEP' END) AS k FROM nc),
  cx AS (SELECT run_id, task_id, score, CASE WHEN score >= 0.9 THEN 'PASS' WHEN score >= 0.5 THEN 'PARTIAL' WHEN k <> '' THEN k WHEN score = 0 THEN 'ZERO' ELSE 'LOW_QUALITY' END AS category FROM ca)"""


def _categorised(spark, d):
    log = _log(spark, d)
    sections = lg.failure_patterns(lg.section_lines(log)).select("run_id", "task_id", "notes")
    scored = sections.join(lg.scores_of_lines(log, rd.task_table(spark)), ["run_id", "task_id"])
    return scored.select("run_id", "task_id", "score", lg.categorise_failure(F.col("score"), F.col("notes")).alias("category"))


@query("p33_categorise_failure", sql("fx_log", _CAT + " SELECT * FROM cx"))
def p33(spark, d):
    return _categorised(spark, d)


@query("a22_failure_pattern_groups", sql("fx_log", _CAT + " SELECT category, count(*) AS n FROM (SELECT unnest(string_split(category, ' | ')) AS category FROM cx WHERE score < 0.5) t GROUP BY category"))
def a22(spark, d):
    return lg.failure_pattern_groups(_categorised(spark, d))


@query("p36_parse_final_loss", "SELECT user_id AS run_id, CAST(arg_max(round(value, 2), event_id) AS DOUBLE) AS loss FROM events WHERE event_type <> 'error' GROUP BY user_id")
def p36(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet")
    line = F.when(F.col("event_type") == "error", "step skipped").otherwise(F.concat(F.lit("{'loss': "), F.round("value", 2).cast("string"), F.lit(", 'epoch': 1}")))
    return lg.final_loss(e.select(F.col("user_id").alias("run_id"), F.col("event_id").alias("line_no"), line.alias("line")))


# ---- model output and task documents -------------------------------------------------


@query("p15_parse_generated", sql("fx_generated", " SELECT custom_id, 'u' || conv_id AS user_message, 4 AS n FROM fx_generated WHERE conv_id % 7 <> 0 AND status = 'succeeded'"))
def p15(spark, d):
    out = ps.parse_generated(fx(spark, d, "fx_generated")).where("messages IS NOT NULL")
    return out.select("custom_id", F.get("messages", 0)["content"].alias("user_message"), F.size("messages").alias("n"))


@query("p16_extract_json_array", sql("fx_generated", " SELECT custom_id, CASE WHEN conv_id % 7 = 0 THEN 0 WHEN conv_id % 3 = 0 THEN 3 WHEN conv_id % 3 = 1 THEN 2 ELSE 1 END AS n FROM fx_generated"))
def p16(spark, d):
    array = F.regexp_extract("raw_text", r"(?s)(\[.*\])", 1)
    item = F.regexp_extract("raw_text", r"(?s)\[(.*)\]", 1)
    two = F.concat(F.lit("["), item, F.lit(", "), item, F.lit("]"))
    fenced = F.concat("raw_text", F.lit("\nand\n```\n"), two, F.lit("\n```"))  # two blocks, three objects
    raw = F.expr("conv_id % 7 = 0"), F.expr("conv_id % 3 = 0"), F.expr("conv_id % 3 = 1")
    shaped = F.when(raw[0], F.col("raw_text")).when(raw[1], fenced).when(raw[2], F.concat(F.lit("Sure: "), two, F.lit(" done"))).otherwise(array)
    out = fx(spark, d, "fx_generated").select("custom_id", F.coalesce(F.size(ps.json_arrays(shaped)), F.lit(0)).alias("n"))
    return out.withColumn("n", F.greatest("n", F.lit(0)))


@query("p17_extract_json_object", """SELECT event_id, CASE event_id % 6 WHEN 0 THEN '{"k":' || k || '}' WHEN 1 THEN '{"a":{"k":' || k || '}}' WHEN 2 THEN '{"k":' || k || ',"t":"```json {"}' WHEN 3 THEN '{"k":[' || k || ',' || event_id || ']}' WHEN 4 THEN '{"k":' || k || ',"text":"}"}' END AS object
  FROM (SELECT event_id, regexp_extract(props, '([0-9]+)', 1) AS k FROM events) t""")
def p17(spark, d):
    k, event = F.regexp_extract("props", "([0-9]+)", 1), F.col("event_id").cast("string")
    shapes = [
        F.concat(F.lit("Here it is: "), F.regexp_replace("props", r"\}", ",}"), F.lit(" hope it helps")),  # a trailing comma
        F.concat(F.lit("I use {foo} first. "), F.lit('{"a": '), "props", F.lit("} and {bar}")),  # stray braces on both sides
        F.concat(F.lit('```json\n{"t": "```json {", "k": '), k, F.lit("}\n```")),  # a fence inside a string
        F.concat(F.lit('{"k": ['), k, F.lit(", "), event, F.lit(",], }")),  # several trailing commas
        F.concat(F.lit('{ not yet {"text": "}", "k": '), k, F.lit("} the end")),  # a brace that never closes
        F.concat(F.lit("no object { in "), k),
    ]
    raw = F.element_at(F.array(*shapes), (F.col("event_id") % 6 + 1).cast("int"))
    e = spark.read.parquet(f"{d}/events.parquet").select("event_id", raw.alias("raw"))
    return ps.extract_json_object(e, "raw").select("event_id", "object")


@query("p18_normalise_judge_response", sql("fx_scores", " SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN 0 ELSE score END AS score, CASE WHEN doc_id % 9 = 0 THEN 0 ELSE 1 END AS n_issues, doc_id % 9 = 0 AS failed FROM fx_scores"))
def p18(spark, d):
    body = F.concat(F.lit('```json\n{"score": '), F.col("score").cast("string"), F.lit(', "issues": ["x"], "reasoning": "r"'), F.when(F.expr("doc_id % 9 = 0"), "").otherwise("}"), F.lit("\n```"))
    out = fx(spark, d, "fx_scores").select("doc_id", ps.normalise_judge_response(body).alias("j"))
    return out.select("doc_id", "j.score", F.size("j.issues").alias("n_issues"), F.col("j.error").isNotNull().alias("failed"))


@query("p21_parse_front_matter", sql("fx_taskdocs", " SELECT doc_id, regexp_extract(body, 'id: ([^\\n]*)', 1) AS id, regexp_extract(body, 'name: ([^\\n]*)', 1) AS name, regexp_extract(body, 'category: ([^\\n]*)', 1) AS category FROM fx_taskdocs".replace("\\\\", "\\")))
def p21(spark, d):
    m = fx(spark, d, "fx_taskdocs").select("doc_id", ps.front_matter(F.col("body")).alias("m"))
    return m.select("doc_id", *[F.col("m")[k].alias(k) for k in ("id", "name", "category")])


@query("p22_extract_sections", "SELECT p_partkey AS doc_id, 'prompt' AS heading, 'Save the list as `file_' || p_size || '.txt` please.' AS content FROM part UNION ALL SELECT p_partkey, 'expected behavior', '| price | ' || CAST(CAST(trunc(p_retailprice) AS INT) AS VARCHAR) || ' |' || chr(10) || 'It says \"' || p_type || '\" there.' FROM part")
def p22(spark, d):
    return ps.sections(fx(spark, d, "fx_taskdocs"))


@query("p23_extract_expected_files", "SELECT p_partkey AS doc_id, 'file_' || p_size || '.txt' AS files FROM part")
def p23(spark, d):
    return fx(spark, d, "fx_taskdocs").select("doc_id", F.array_join(ps.expected_files(F.col("body")), "|").alias("files"))


@query("p24_extract_expected_values", "SELECT p_partkey AS doc_id, p_size || '|' || p_type AS vals FROM part")
def p24(spark, d):
    body = F.concat(F.lit("| 1 | "), F.col("p_size").cast("string"), F.lit(' |\nIt must say "'), "p_type", F.lit('" there.'))
    return spark.read.parquet(f"{d}/part.parquet").select(F.col("p_partkey").alias("doc_id"), F.array_join(ps.expected_values(body), "|").alias("vals"))


@query("p22_sections_of_many_shapes", sql("fx_taskdocs_mixed", """
  SELECT doc_id, 'prompt' AS heading, CASE WHEN doc_id % 5 = 0 THEN 'Again, create "other_' || p_size || '.csv".' ELSE 'Save the list as `file_' || p_size || '.txt`.' || CASE WHEN doc_id % 6 = 0 THEN chr(10) || '#### Notes' || chr(10) || 'keep # this' ELSE '' END END AS content FROM fx_taskdocs_mixed
  UNION ALL SELECT doc_id, 'expected  behavior', CASE doc_id % 8 WHEN 0 THEN '**Output**: `http://host/a.txt`' WHEN 1 THEN '**File**: `dir/b b.txt`' ELSE '#none' END FROM fx_taskdocs_mixed
  UNION ALL SELECT doc_id, 'empty', '' FROM fx_taskdocs_mixed WHERE doc_id % 7 = 0"""))
def p22_many_shapes(spark, d):
    """With and without front matter, headings of three levels, repeated (the last counts), empty, and deeper ones that are content."""
    return ps.sections(fx(spark, d, "fx_taskdocs_mixed"))


@query("p23_files_of_many_shapes", sql("fx_taskdocs_mixed", """
  SELECT doc_id, concat_ws('|', 'file_' || p_size || '.txt', CASE WHEN doc_id % 5 = 0 THEN 'other_' || p_size || '.csv' END, CASE WHEN doc_id % 8 = 1 THEN 'dir/b b.txt' END) AS files FROM fx_taskdocs_mixed"""))
def p23_many_shapes(spark, d):
    """One to three files in the patterns' order, each once; an address is none."""
    return fx(spark, d, "fx_taskdocs_mixed").select("doc_id", F.array_join(ps.expected_files(F.col("body")), "|").alias("files"))


@query("p24_values_of_many_shapes", sql("fx_taskdocs_mixed", """
  SELECT doc_id, concat_ws('|', p_size::VARCHAR, CASE WHEN doc_id % 3 <> 0 THEN p_brand END, p_type, CASE WHEN doc_id % 4 <> 0 THEN 'c_' || p_size END) AS vals FROM fx_taskdocs_mixed"""))
def p24_many_shapes(spark, d):
    """A table's head and rule, cells of dashes and quotes of 100 letters or more are no values."""
    return fx(spark, d, "fx_taskdocs_mixed").select("doc_id", F.array_join(ps.expected_values(F.col("answers")), "|").alias("vals"))


@query("p25_map_task_ids", sql("fx_taskdocs", " SELECT doc_id, CASE WHEN id = 'task_29' THEN 'task_00' WHEN id = 'task_28' THEN 'task_01' ELSE id END AS task_id FROM (SELECT doc_id, regexp_extract(body, 'id: (task_[0-9]+)', 1) AS id FROM fx_taskdocs) t"))
def p25(spark, d):
    docs = fx(spark, d, "fx_taskdocs").select("doc_id", ps.front_matter(F.col("body"))["id"].alias("task_id"))
    return ps.map_task_ids(docs, spark.createDataFrame([("task_29", "task_00"), ("task_28", "task_01")], "external string, internal string"))


@query("p26_split_request_id", sql("fx_generated", " SELECT custom_id, 'dynamic' AS kind, 'task_' || lpad(CAST(conv_id % 23 AS VARCHAR), 2, '0') AS task_id, 'terse' AS variation_id, CAST(conv_id AS INT) AS request_no FROM fx_generated"))
def p26(spark, d):
    return fx(spark, d, "fx_generated").select("custom_id", *[c.alias(k) for k, c in ps.request_id(F.col("custom_id")).items()])


@query("p26_request_ids_of_many_shapes", sql("fx_request_ids", """
  SELECT conv_id, CASE conv_id % 5 WHEN 2 THEN 'topup' WHEN 3 THEN 'gap' WHEN 4 THEN 'plain' ELSE 'dynamic' END AS kind, CASE conv_id % 5 WHEN 0 THEN 'task_01' WHEN 1 THEN 'task_02' WHEN 2 THEN '' WHEN 3 THEN 'task_03' END AS task_id,
    CASE WHEN conv_id % 5 IN (0, 2, 3) THEN 'terse' END AS variation_id, CASE conv_id % 5 WHEN 0 THEN CAST(conv_id AS INT) WHEN 3 THEN 7 END AS request_no FROM fx_request_ids"""))
def p26_many_shapes(spark, d):
    """Ids with one to five parts, an empty one, and a number that is none."""
    return fx(spark, d, "fx_request_ids").select("conv_id", *[c.alias(k) for k, c in ps.request_id(F.col("custom_id")).items()])


@query("p34_flatten_diagnosis", sql("fx_causes fx_fixes", """, a AS (SELECT task_id, string_agg(cause, '; ' ORDER BY diagnosis_id) AS root_cause, string_agg(fix, '; ' ORDER BY diagnosis_id) AS fix FROM (SELECT DISTINCT * FROM fx_causes) GROUP BY task_id), b AS (SELECT task_id, arg_max(action, reason) AS action, max(reason) AS reason FROM fx_fixes GROUP BY task_id)
  SELECT coalesce(a.task_id, b.task_id) AS task_id, coalesce(root_cause, reason) AS root_cause, coalesce(fix, 'Action: ' || action) AS fix, coalesce(reason, '') AS reason, action FROM a FULL JOIN b ON a.task_id = b.task_id"""))
def p34(spark, d):
    return ps.flatten_diagnosis(fx(spark, d, "fx_causes"), fx(spark, d, "fx_fixes"))


@query("a23_collect_report", sql("fx_generated", """, g AS (SELECT 'task_' || lpad(CAST(conv_id % 23 AS VARCHAR), 2, '0') AS task_id, count(*) FILTER (status <> 'succeeded') AS api_errors, count(*) FILTER (status = 'succeeded' AND conv_id % 7 = 0) AS parse_failures, count(*) FILTER (status = 'succeeded' AND conv_id % 7 <> 0) AS added FROM fx_generated GROUP BY 1)
  SELECT task_id, api_errors, parse_failures, CAST(0 AS BIGINT) AS rejected, added, CASE WHEN added > 0 THEN least(5, greatest(1, added // 5)) ELSE 0 END AS val, added - CASE WHEN added > 0 THEN least(5, greatest(1, added // 5)) ELSE 0 END AS train FROM g"""))
def a23(spark, d):
    return ps.collect_report(ps.parse_generated(fx(spark, d, "fx_generated")))


# ---- near duplicates -----------------------------------------------------------------


def _texts(spark, d):
    """Documents as one-message examples, grouped by language, with a tool set that has two kinds."""
    tools = F.when(F.col("example_id") % 2 == 0, F.array(F.lit("read_file"))).otherwise(F.array(F.lit("read_file"), F.lit("write_file")))
    return fx(spark, d, "fx_docs").select("example_id", "pos", F.col("lang").alias("task_id"), F.col("user_message").alias("text"), tools.alias("tools"))


_VEC = r""", tk AS (SELECT example_id, lang AS task_id, unnest(regexp_extract_all(lower(user_message), '[\p{L}\p{N}_]{2,}')) AS term FROM fx_docs), tn AS (SELECT lang AS task_id, count(*) AS n FROM fx_docs GROUP BY lang),
  tf AS (SELECT task_id, example_id, term, count(*) AS tf FROM tk GROUP BY ALL), tv AS (SELECT task_id, term, df FROM (SELECT *, row_number() OVER (PARTITION BY task_id ORDER BY total DESC, term) AS r FROM (SELECT task_id, term, count(*) AS df, sum(tf) AS total FROM tf GROUP BY ALL)) WHERE r <= 5000),
  tx AS (SELECT tf.task_id, example_id, term, tf * (ln((1.0::DOUBLE + n) / (1 + df)) + 1) AS x FROM tf JOIN tv USING (task_id, term) JOIN tn USING (task_id)),
  vec AS (SELECT task_id, example_id, term, x / sqrt(sum(x * x) OVER (PARTITION BY task_id, example_id)) AS w FROM tx)"""


@query("n01_tfidf_vectors", sql("fx_docs", _VEC + " SELECT task_id, example_id, count(*) AS n_terms, round(sum(w), 4) AS sum_w, round(max(w), 4) AS max_w FROM vec GROUP BY ALL"))
def n01(spark, d):
    out = dd.tfidf_vectors(_texts(spark, d)).groupBy("task_id", "example_id").agg(F.count("*").alias("n_terms"), F.sum("w").alias("sum_w"), F.max("w").alias("max_w"))
    return _round(out, "sum_w", "max_w", digits=4)


_FOLD = ", rp AS (SELECT min(example_id) AS example_id FROM fx_docs GROUP BY lang, user_message, example_id % 2)"
_COS = _VEC + _FOLD + ", vr AS (SELECT * FROM vec WHERE example_id IN (SELECT example_id FROM rp)), cp AS (SELECT a.task_id, a.example_id AS a, b.example_id AS b, sum(a.w * b.w) AS cosine FROM vr a JOIN vr b ON a.task_id = b.task_id AND a.term = b.term AND a.example_id < b.example_id GROUP BY ALL HAVING sum(a.w * b.w) >= 0.85 - 1e-9)"


@query("n02_cosine_pairs", sql("fx_docs", _COS + " SELECT task_id, a, b, round(cosine, 4) AS cosine FROM cp"))
def n02(spark, d):
    return _round(dd.duplicate_pairs(_texts(spark, d), tool_threshold=None), "cosine", digits=4)


_DUP = sql("fx_docs", _COS + " SELECT task_id, a, b, round(cosine, 4) AS cosine FROM cp WHERE a % 2 = b % 2")


@query("n03_duplicate_pairs", _DUP)
@query("j07_near_duplicate_join", _DUP)
def n03(spark, d):
    return _round(dd.duplicate_pairs(_texts(spark, d)), "cosine", digits=4)


#: The greedy scan in SQL: one step for each document with an earlier neighbour, in order; it is absorbed if one of those leads.
_LEAD = _COS + """, ed AS MATERIALIZED (SELECT a, b FROM cp WHERE a % 2 = b % 2), od AS MATERIALIZED (SELECT b AS n, list(a) AS earlier, row_number() OVER (ORDER BY b) AS i FROM ed GROUP BY b),
  sc AS (SELECT 0::BIGINT AS i, []::BIGINT[] AS absorbed UNION ALL SELECT od.i, CASE WHEN list_has_all(absorbed, earlier) THEN absorbed ELSE list_append(absorbed, od.n) END FROM sc JOIN od ON od.i = sc.i + 1),
  ab AS MATERIALIZED (SELECT unnest(arg_max(absorbed, i)) AS n FROM sc), own AS (SELECT b AS n, min(a) AS leader FROM ed WHERE b IN (SELECT n FROM ab) AND a NOT IN (SELECT n FROM ab) GROUP BY b),
  ld AS (SELECT example_id, coalesce(leader, example_id) AS leader FROM rp LEFT JOIN own ON example_id = n),
  mb AS (SELECT example_id, pos, lang, min(example_id) OVER (PARTITION BY lang, user_message, example_id % 2) AS rep FROM fx_docs), cl AS (SELECT mb.example_id, pos, lang, leader AS cluster FROM mb JOIN ld ON rep = ld.example_id)"""


def _scan(views: str, text: str) -> str:
    return sql(views, _LEAD + text).replace("WITH ", "WITH RECURSIVE ", 1)


@query("n04_leader_clusters", _scan("fx_docs", " SELECT example_id, leader FROM ld"))
def n04(spark, d):
    return dd.leader_scan(_texts(spark, d))


@query("n05_dedup", _scan("fx_docs fx_scores", """, sd AS (SELECT d.example_id, d.pos, d.task_id, coalesce(CAST(s.score AS DOUBLE), 3.0::DOUBLE) AS score FROM fx_docs d LEFT JOIN fx_scores s ON d.task_id = s.task_id AND d.user_prefix = s.user_prefix)
  SELECT example_id, task_id, score FROM (SELECT sd.*, row_number() OVER (PARTITION BY cluster ORDER BY score DESC, sd.pos) AS r FROM sd JOIN cl USING (example_id)) WHERE r = 1"""))
def n05(spark, d):
    rows = _texts(spark, d)
    scored = sc.with_scores(fx(spark, d, "fx_docs").drop("user_message"), fx(spark, d, "fx_scores"))
    kept, _ = dd.dedup(scored, dd.clusters(rows))
    return kept.select("example_id", "task_id", "score")


@query("n06_dedup_report", _scan("fx_docs", """, rk AS (SELECT CASE WHEN example_id % 10 = 0 THEN 'val' ELSE 'train' END AS split, row_number() OVER (PARTITION BY cluster ORDER BY pos) AS r FROM cl),
  g AS (SELECT split, count(*) AS before, count(*) FILTER (r > 1) AS removed FROM rk GROUP BY split)
  SELECT split, before, before - removed AS after, removed, round_even(removed * 100.0::DOUBLE / before, 1) AS pct, round_even(removed * 100.0::DOUBLE / before, 1) > 30 AS warn FROM g"""))
def n06(spark, d):
    rows = _texts(spark, d).withColumn("split", F.when(F.col("example_id") % 10 == 0, "val").otherwise("train"))
    _, removed = dd.dedup(rows.withColumn("score", F.lit(3.0)).drop("text", "tools"), dd.clusters(rows))
    return dd.dedup_report(rows, removed)


@query("n07_exact_duplicates", sql("fx_docs", ", f AS (SELECT example_id, min(example_id) OVER (PARTITION BY lang, user_message, example_id % 2) AS original FROM fx_docs) SELECT example_id, original FROM f WHERE example_id <> original"))
def n07(spark, d):
    return dd.exact_duplicates(_texts(spark, d))


@query("l02_first_clusters", _scan("fx_docs", """ SELECT cluster, count(*) AS size, min(pos) AS pos, array_to_string(list_sort(list(example_id))[1:3], '|') AS members FROM cl GROUP BY cluster HAVING count(*) > 1 ORDER BY min(pos) LIMIT 20"""))
def l02(spark, d):
    return dd.first_clusters(dd.clusters(_texts(spark, d))).withColumn("members", F.array_join("members", "|"))


# ---- files ---------------------------------------------------------------------------


def _jsonl(spark, d, split: str | None = None, corrupt: bool = True) -> str:
    """The conversations as JSON lines in the shared folder, every 17th line broken."""
    e = examples(spark, d)
    e = e if split is None else e.where(F.col("split") == split)
    line = F.to_json(F.struct("task_id", "source", "messages"))
    broken = F.when(F.col("example_id") % 17 == 0, F.substring(line, 1, 40)).otherwise(line) if corrupt else line
    path = io.fresh_path(spark, "examples")
    e.select(broken.alias("value")).write.text(path)
    return path


_GOOD = "fx_ex"


@query("s01_scan_examples_tolerant", sql(_GOOD, " SELECT task_id, source, count(*) AS n FROM fx_ex WHERE example_id % 17 <> 0 GROUP BY ALL"))
def s01(spark, d):
    return io.scan_tolerant(spark, _jsonl(spark, d)).groupBy("task_id", "source").agg(F.count("*").alias("n"))


@query("s02_scan_examples_strict", sql(_GOOD, " SELECT task_id, count(*) AS n FROM fx_ex GROUP BY ALL"))
def s02(spark, d):
    return io.scan_strict(spark, _jsonl(spark, d, corrupt=False)).groupBy("task_id").agg(F.count("*").alias("n"))


@query("s03_scan_corrupt_counts", sql(_GOOD, " SELECT CASE WHEN example_id % 17 = 0 THEN '__corrupt__' ELSE task_id END AS task_id, count(*) AS n FROM fx_ex GROUP BY 1"))
def s03(spark, d):
    return io.scan_corrupt_counts(spark, _jsonl(spark, d))


@query("s04_scan_with_split", sql(_GOOD, " SELECT split, task_id, count(*) AS n FROM fx_ex WHERE example_id % 17 <> 0 GROUP BY ALL"))
def s04(spark, d):
    return io.scan_with_split(spark, _jsonl(spark, d, "train"), _jsonl(spark, d, "val")).groupBy("split", "task_id").agg(F.count("*").alias("n"))


@query("s05_scan_scores", sql("fx_scores", " SELECT task_id, user_prefix, score FROM fx_scores"))
def s05(spark, d):
    path = io.fresh_path(spark, "scores")
    entry = F.struct(F.concat_ws("|", "task_id", "user_prefix").alias("key"), F.struct("score").alias("value"))
    rows = fx(spark, d, "fx_scores")
    parts = rows.groupBy("task_id").agg(F.ceil(F.count("*") / 1000).alias("parts"))  # map files of about 1000 entries
    part = F.pmod(F.xxhash64("user_prefix"), F.col("parts")).alias("part")
    maps = rows.join(parts, "task_id").groupBy(F.col("task_id").alias("task"), part).agg(F.to_json(F.map_from_entries(F.collect_list(entry))).alias("value"))
    maps.repartition("task", "part").write.partitionBy("task", "part").text(path)
    return io.scan_scores(spark, path).select("task_id", "user_prefix", "score")


@query("s06_scan_model_history", sql("fx_bench", " SELECT version, task_id, round(score, 6) AS score FROM fx_bench"))
def s06(spark, d):
    b = fx(spark, d, "fx_bench").groupBy("version").agg(F.map_from_entries(F.collect_list(F.struct("task_id", "score"))).alias("scores"))
    run = F.struct(F.col("version"), F.concat(F.lit("m-v"), F.col("version").cast("string")).alias("ollama_name"), "scores", F.lit("2024-01-01T00:00:00").alias("timestamp"))
    path = io.fresh_path(spark, "state")
    b.agg(F.to_json(F.struct(F.collect_list(run).alias("model_history"))).alias("value")).coalesce(1).write.text(path)
    return _round(io.scan_model_history(spark, path).select(F.col("version").cast("long").alias("version"), "task_id", "score"), "score")


@query("s07_scan_bench_log", sql("fx_log", " SELECT CAST(run_id AS VARCHAR) AS run_id, count(*) AS n_lines, count(*) FILTER (contains(line, 'starting task')) AS n_tasks FROM fx_log GROUP BY run_id"))
def s07(spark, d):
    path = io.fresh_path(spark, "logs")
    _log(spark, d).repartition("run_id").sortWithinPartitions("run_id", "line_no").select(F.col("run_id").alias("run_id"), F.col("line").alias("value")).write.partitionBy("run_id").text(path)
    return io.scan_log(spark, path).groupBy("run_id").agg(F.count("*").alias("n_lines"), F.count_if(F.contains("line", F.lit("starting task"))).alias("n_tasks"))


@query("s08_scan_task_defs", "SELECT 'task_' || lpad(CAST(p_partkey % 30 AS VARCHAR), 2, '0') AS id, count(DISTINCT p_size) AS n_files FROM part GROUP BY p_partkey % 30")
def s08(spark, d):
    path = io.fresh_path(spark, "task-docs")
    task = F.concat(F.lit("task_"), F.lpad((F.col("p_partkey") % 30).cast("string"), 2, "0"))
    line = F.concat(F.lit("Save it as `file_"), F.col("p_size").cast("string"), F.lit(".txt` now."))
    docs = spark.read.parquet(f"{d}/part.parquet").groupBy(task.alias("id")).agg(F.array_join(F.collect_set(line), "\n").alias("lines"))
    docs.select(F.col("id").alias("doc"), F.concat(F.lit("---\nid: "), "id", F.lit("\n---\n# Prompt\n"), "lines").alias("value")).write.partitionBy("doc").text(path)
    found = io.scan_task_docs(spark, path, "*.txt")
    return found.select(ps.front_matter(F.col("body"))["id"].alias("id"), F.size(ps.expected_files(F.col("body"))).cast("long").alias("n_files"))


@query("s09_scan_snapshots", sql("fx_snapshot", " SELECT CAST(version AS INT) AS version, task_id, n FROM fx_snapshot"))
def s09(spark, d):
    path = io.fresh_path(spark, "snapshots")
    per = fx(spark, d, "fx_snapshot").groupBy("version").agg(F.to_json(F.struct(F.map_from_entries(F.collect_list(F.struct("task_id", "n"))).alias("per_task"))).alias("value"))
    per.write.partitionBy("version").text(path)
    return io.scan_snapshots(spark, path)


@query("s10_scan_run_scores", sql("fx_runs", " SELECT 'm-v' || version AS model, CAST(run AS INT) AS run, task_id, round(score, 6) AS score FROM fx_runs"))
def s10(spark, d):
    path = io.fresh_path(spark, "run-scores")
    per = fx(spark, d, "fx_runs").groupBy(F.concat(F.lit("m-v"), F.col("version").cast("string")).alias("model"), "run").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("task_id", "score")))).alias("value"))
    per.write.partitionBy("model", "run").text(path)
    return _round(io.scan_run_scores(spark, path), "score")


@query("s11_sink_overwrite", sql(_GOOD, " SELECT split, task_id, count(*) AS n FROM fx_ex GROUP BY ALL"))
def s11(spark, d):
    return spark.read.parquet(io.sink_overwrite(examples(spark, d), io.fresh_path(spark, "versions"), 1)).groupBy("split", "task_id").agg(F.count("*").alias("n"))


@query("s12_sink_append", sql(_GOOD, " SELECT task_id, 2 * count(*) AS n FROM fx_ex GROUP BY ALL"))
def s12(spark, d):
    path = io.fresh_path(spark, "appended")
    for _ in range(2):
        io.sink_append(fx(spark, d, "fx_ex"), path)
    return spark.read.parquet(path).groupBy("task_id").agg(F.count("*").alias("n"))


@query("s13_sink_report", sql(_GOOD, " SELECT task_id, count(*) AS n FROM fx_ex GROUP BY ALL"))
def s13(spark, d):
    path = io.fresh_path(spark, "report")
    io.sink_report(fx(spark, d, "fx_ex").groupBy("task_id").agg(F.count("*").alias("n")), path)
    return spark.read.schema("task_id string, n long").json(path)


@query("s14_snapshot", sql(_GOOD, " SELECT split, count(*) AS n FROM fx_ex GROUP BY ALL"))
def s14(spark, d):
    root = io.fresh_path(spark, "labelled")
    io.snapshot(examples(spark, d), root, "before-filter", "20240101T000000")
    return spark.read.parquet(root).where("label = 'before-filter'").groupBy("split").agg(F.count("*").alias("n"))


@query("s16_version_artifacts", sql("fx_bench fx_snapshot", " SELECT b.version, b.task_id, round(score, 6) AS score, n FROM fx_bench b JOIN fx_snapshot s ON b.version = s.version AND b.task_id = s.task_id"))
def s16(spark, d):
    root = io.fresh_path(spark, "artifacts")
    io.version_artifacts(fx(spark, d, "fx_bench"), fx(spark, d, "fx_snapshot"), root)
    both = spark.read.parquet(f"{root}/scores").join(spark.read.parquet(f"{root}/counts"), ["version", "task_id"])
    return _round(both.select(F.col("version").cast("long").alias("version"), "task_id", "score", "n"), "score")


# ---- streams -------------------------------------------------------------------------


@query("r01_stream_ingest_examples", sql(_GOOD, " SELECT task_id, count(*) AS n FROM fx_ex WHERE example_id % 17 <> 0 GROUP BY ALL"))
def r01(spark, d):
    source, sink, check = _jsonl(spark, d), io.fresh_path(spark, "ingested"), io.fresh_path(spark, "stream")
    for _ in range(2):  # a restart from the same checkpoint adds nothing
        st.ingest_examples(spark, source, sink, check).awaitTermination()
    return spark.read.schema(io.EXAMPLE).parquet(sink).groupBy("task_id").agg(F.count("*").alias("n"))


def _run(spark, frame, mode: str, schema: str):
    """Run a stream until it has caught up, each batch written to the shared folder; all batches' rows."""
    out, check = io.fresh_path(spark, "batches"), io.fresh_path(spark, "stream")
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.set(provider, st.STATE_PROVIDER)
    run = frame.writeStream.outputMode(mode).option("checkpointLocation", check).trigger(availableNow=True).foreachBatch(lambda b, i: b.withColumn("batch", F.lit(i)).write.mode("overwrite").parquet(f"{out}/no={i}")).start()
    spark.conf.set(provider, before)  # a query keeps the settings it was started with
    run.awaitTermination()
    return spark.read.schema(f"{schema}, batch long").parquet(out)


def _event_stream(spark, d, view: str):
    """A view of the events as a file stream of two batches, the earlier half of the events first."""
    rows = fx(spark, d, view)
    rows = rows.withColumn("ts", F.col("ts").cast("timestamp")) if "ts" in rows.columns else rows
    path = io.fresh_path(spark, "events")
    half = rows.approxQuantile("event_id", [0.5], 0.01)[0]
    for part in (F.col("event_id") <= half, F.col("event_id") > half):
        rows.where(part).repartitionByRange(4, "event_id").write.mode("append").parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 4).parquet(path)


@query("r02_stream_task_counts", sql("fx_calls", " SELECT task_id, count(*) AS n FROM fx_calls GROUP BY task_id"))
def r02(spark, d):
    rows = _run(spark, st.task_counts(_event_stream(spark, d, "fx_calls")), "update", "task_id string, n long")
    return rows.groupBy("task_id").agg(F.max_by("n", "batch").alias("n"))


@query("r03_stream_dedup_keys", sql("fx_actions", " SELECT DISTINCT session_id, action FROM fx_actions"))
def r03(spark, d):
    # the delay covers the whole log, so that each key's first row is the only one
    frame = st.first_by_key(_event_stream(spark, d, "fx_actions"), ["session_id", "action"], "ts", "60 days").select("session_id", "action")
    return _run(spark, frame, "append", "session_id long, action string").select("session_id", "action")


@query("r04_stream_guardrails", sql("fx_actions", """, g AS (SELECT *, count(*) FILTER (status = 'success') OVER (PARTITION BY session_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS grp FROM fx_actions)
  SELECT session_id, turn, CAST(count(*) FILTER (status = 'error') OVER (PARTITION BY session_id, grp ORDER BY turn ROWS UNBOUNDED PRECEDING) AS INT) AS failures,
    count(*) OVER w >= 15 AND count(*) FILTER (action = 'generate_data' AND status = 'success' AND added > 0) OVER w >= 3 AND count(*) FILTER (action = 'train') OVER w = 0 AS looping FROM g WINDOW w AS (PARTITION BY session_id ORDER BY turn ROWS BETWEEN 14 PRECEDING AND CURRENT ROW)"""))
def r04(spark, d):
    # sessions are as long as the log, so none is idle
    stream = _event_stream(spark, d, "fx_actions").select("session_id", F.col("turn").cast("long").alias("turn"), "action", "status", "added", "ts")
    rows = _run(spark, st.guardrails(stream, least=3, delay="60 days", idle_ms=60 * 86_400_000), "append", st.GUARDRAILS)
    return rows.where("NOT closed").select("session_id", "turn", "failures", "looping")
