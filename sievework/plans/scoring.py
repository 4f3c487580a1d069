"""Queries on scored examples: filters, score joins, windows, splits and score statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import registry
from ..operators import scores as sc
from .fixtures import fx, sql

Q: dict = {}
SQL: dict[str, str] = {}


def query(name: str, text: str | None = None):
    def add(f):
        Q[name] = f
        if text:
            SQL[name] = text
        return f

    return add


def _docs(spark, d):
    return fx(spark, d, "fx_docs").drop("user_message", "lang")


_DS = "fx_docs fx_scores"
_J = ", js AS (SELECT d.example_id, d.pos, d.task_id, d.user_prefix, d.source, CAST(s.score AS DOUBLE) AS score FROM fx_docs d LEFT JOIN fx_scores s ON d.task_id = s.task_id AND d.user_prefix = s.user_prefix)"


@query("j01_examples_with_scores", sql(_DS, _J + " SELECT example_id, task_id, coalesce(score, 3.0::DOUBLE) AS score, score IS NOT NULL AS scored FROM js"))
def j01(spark, d):
    return sc.with_scores(_docs(spark, d), fx(spark, d, "fx_scores")).select("example_id", "task_id", "score", "scored")


@query("j02_prune_stale_scores", sql(_DS, ", ss AS (SELECT task_id, user_prefix, score FROM fx_scores UNION ALL SELECT 'old-' || task_id, user_prefix, score + 1 FROM fx_scores) SELECT task_id, user_prefix, score FROM ss WHERE EXISTS (SELECT 1 FROM fx_docs d WHERE d.task_id = ss.task_id AND d.user_prefix = ss.user_prefix)"))
def j02(spark, d):
    scores = fx(spark, d, "fx_scores").select("task_id", "user_prefix", "score")
    stale = scores.select(F.concat(F.lit("old-"), "task_id").alias("task_id"), "user_prefix", (F.col("score") + 1).alias("score"))
    return sc.prune_stale_scores(scores.union(stale), _docs(spark, d))


@query("j03_unscored_examples", sql(_DS, _J + " SELECT example_id, task_id FROM js WHERE score IS NULL"))
def j03(spark, d):
    return sc.unscored(_docs(spark, d), fx(spark, d, "fx_scores")).select("example_id", "task_id")


@query("j03_score_with", sql(_DS, _J + """, k AS (SELECT task_id, user_prefix, CAST(length(arg_min(d.user_message, d.pos)) % 5 + 1 AS INT) AS score FROM fx_docs d WHERE NOT EXISTS (SELECT 1 FROM fx_scores s WHERE s.task_id = d.task_id AND s.user_prefix = d.user_prefix) GROUP BY task_id, user_prefix)
  SELECT task_id, user_prefix, CAST(score AS INT) AS score, false AS fresh FROM fx_scores UNION ALL SELECT task_id, user_prefix, score, true FROM k"""))
def j03_score_with(spark, d):
    """Resume: keys without a score go through a scorer (here one that looks at the length alone)."""

    def scorer(texts):
        import pandas as pd

        return pd.DataFrame({"score": texts.str.len() % 5 + 1, "reasoning": "length"})

    known = fx(spark, d, "fx_scores").select("task_id", "user_prefix", "score")
    out = registry.score_with(fx(spark, d, "fx_docs"), scorer, known, "user_message")
    return out.select("task_id", "user_prefix", "score", F.col("reasoning").isNotNull().alias("fresh"))


@query("f01_filter_by_task", sql("fx_docs", " SELECT example_id, task_id FROM fx_docs WHERE task_id = 'src3'"))
def f01(spark, d):
    return sc.filter_by_task(_docs(spark, d), "src3").select("example_id", "task_id")


@query("f02_remove_tasks", sql("fx_docs", " SELECT 'kept' AS kind, task_id, count(*) AS n FROM fx_docs WHERE task_id NOT IN ('src0', 'src5') GROUP BY task_id UNION ALL SELECT 'removed', task_id, count(*) FROM fx_docs WHERE task_id IN ('src0', 'src5') GROUP BY task_id"))
def f02(spark, d):
    kept, gone = sc.remove_tasks(_docs(spark, d), ("src0", "src5"))
    return kept.groupBy(F.lit("kept").alias("kind"), "task_id").agg(F.count("*").alias("n")).union(gone.select(F.lit("removed"), "task_id", "removed"))


@query("f03_filter_min_score", sql(_DS, _J + " SELECT example_id FROM js WHERE coalesce(score, 5) >= 3"))
def f03(spark, d):
    return sc.filter_min_score(_docs(spark, d), fx(spark, d, "fx_scores")).select("example_id")


@query("f03_apply_by_name", sql(_DS, _J + " SELECT task_id, count(*) AS n FROM js WHERE coalesce(score, 5) >= 4 GROUP BY task_id"))
def f03_apply_by_name(spark, d):
    """Operators chained by name, as a configuration would: rows with a score of four or none, counted by task."""
    kept = registry.apply(_docs(spark, d), "filter_min_score", scores=fx(spark, d, "fx_scores"), least=4)
    return registry.apply(kept, "count_per_task").select("task_id", F.col("n"))


_RANK = _J + ", rk AS (SELECT *, row_number() OVER (PARTITION BY task_id ORDER BY pos) AS rn, count(*) OVER (PARTITION BY task_id) AS n FROM js)"


@query("f04_filter_score_baseline", sql(_DS, _RANK + ", b AS (SELECT task_id, CAST(count(*) // 2 AS BIGINT) AS f FROM fx_docs WHERE task_id <> 'src7' GROUP BY task_id) SELECT example_id, rk.task_id FROM rk LEFT JOIN b ON rk.task_id = b.task_id WHERE score IS NULL OR score >= 3 OR rn <= coalesce(f, 0) OR n <= 35 OR rk.task_id NOT IN ('src1', 'src2', 'src7')"))
def f04(spark, d):
    docs = _docs(spark, d)
    base = docs.where("task_id <> 'src7'").groupBy("task_id").agg(F.floor(F.count("*") / 2).alias("n"))
    return sc.filter_score_baseline(docs, fx(spark, d, "fx_scores"), base, tasks=("src1", "src2", "src7")).select("example_id", "task_id")


@query("f05_filter_score_force", sql(_DS, _RANK + " SELECT example_id, task_id FROM rk WHERE score IS NULL OR score >= 3 OR rn <= 15"))
def f05(spark, d):
    return sc.filter_score_force(_docs(spark, d), fx(spark, d, "fx_scores")).select("example_id", "task_id")


@query("f06_borderline", sql(_DS, _J + " SELECT example_id, score FROM js WHERE score BETWEEN 2 AND 3 ORDER BY score, pos LIMIT 30"))
def f06(spark, d):
    return sc.borderline(_docs(spark, d), fx(spark, d, "fx_scores")).select("example_id", "score")


@query("f07_low_scores", sql("fx_scores", " SELECT task_id, user_prefix, score FROM fx_scores WHERE score <= 2 ORDER BY score, task_id, user_prefix LIMIT 10"))
def f07(spark, d):
    return sc.low_scores(fx(spark, d, "fx_scores").select("task_id", "user_prefix", "score"))


@query("w01_keep_with_floor", sql(_DS, _RANK + " SELECT example_id, task_id FROM rk WHERE score IS NULL OR score >= 4 OR rn <= 10"))
def w01(spark, d):
    return sc.keep_with_floor(sc.with_scores(_docs(spark, d), fx(spark, d, "fx_scores"), None), 4, 10).select("example_id", "task_id")


@query("w02_rebalance", sql(_DS, _J + """, rb AS (SELECT *, row_number() OVER (PARTITION BY task_id ORDER BY (source = 'original') DESC, coalesce(score, 3) DESC, pos) AS rn FROM js) SELECT example_id, task_id FROM rb WHERE rn <= 40"""))
def w02(spark, d):
    return sc.rebalance(sc.with_scores(_docs(spark, d), fx(spark, d, "fx_scores")), 40).select("example_id", "task_id")


@query("w03_rebalance_plan", sql("fx_docs", """, c AS (SELECT task_id, count(*) AS b, least(count(*), 40) AS a FROM fx_docs GROUP BY task_id)
  SELECT task_id, b AS before, a AS after, a - b AS change FROM c UNION ALL SELECT 'TOTAL', CAST(sum(b) AS BIGINT), CAST(sum(a) AS BIGINT), CAST(sum(a) - sum(b) AS BIGINT) FROM c"""))
def w03(spark, d):
    return sc.rebalance_plan(_docs(spark, d), 40)


@query("w04_trim_first_n", sql("fx_ex", ", r AS (SELECT *, row_number() OVER (PARTITION BY split, task_id ORDER BY pos) AS rn FROM fx_ex) SELECT example_id, task_id, split FROM r WHERE task_id <> 'task_03' OR rn <= 2"))
def w04(spark, d):
    return sc.trim_first_n(fx(spark, d, "fx_ex"), "task_03", 2).select("example_id", "task_id", "split")


_SPLIT = ", sp AS (SELECT *, count(*) OVER (PARTITION BY task_id) AS n, row_number() OVER (PARTITION BY task_id ORDER BY md5(CAST(example_id AS VARCHAR) || 's'), example_id) AS rn FROM fx_docs)"


@query("w05_stratified_split", sql("fx_docs", _SPLIT + " SELECT example_id, task_id, CASE WHEN rn <= least(n, greatest(2, round_even(n * 0.1::DOUBLE, 0))) THEN 'val' ELSE 'train' END AS split FROM sp"))
def w05(spark, d):
    return sc.stratified_split(_docs(spark, d)).select("example_id", "task_id", "split")


@query("w06_split_new_batch", sql("fx_docs", _SPLIT + " SELECT example_id, task_id, CASE WHEN rn <= least(5, greatest(1, n // 5)) THEN 'val' ELSE 'train' END AS split FROM sp"))
def w06(spark, d):
    return sc.split_new_batch(_docs(spark, d)).select("example_id", "task_id", "split")


@query("w07_split_fill_val", sql("fx_docs", _SPLIT.replace("FROM fx_docs)", "FROM fx_docs WHERE pos % 2 = 1)") + ", h AS (SELECT task_id, count(*) AS has FROM fx_docs WHERE pos % 64 = 0 GROUP BY task_id) SELECT example_id, sp.task_id, CASE WHEN rn <= greatest(0, 5 - coalesce(has, 0)) THEN 'val' ELSE 'train' END AS split FROM sp LEFT JOIN h ON sp.task_id = h.task_id"))
def w07(spark, d):
    docs = _docs(spark, d)
    existing = docs.where("pos % 2 = 0").withColumn("split", F.when(F.expr("pos % 64 = 0"), "val").otherwise("train"))
    return sc.split_fill_val(docs.where("pos % 2 = 1"), existing).select("example_id", "task_id", "split")


@query("w08_best_in_cluster", sql(_DS, _J + ", r AS (SELECT *, row_number() OVER (PARTITION BY task_id, user_prefix ORDER BY coalesce(score, 3) DESC, pos) AS rn FROM js) SELECT example_id, task_id FROM r WHERE rn = 1"))
def w08(spark, d):
    members = sc.with_scores(_docs(spark, d), fx(spark, d, "fx_scores")).withColumn("cluster", F.struct("task_id", "user_prefix"))
    return sc.best_in_cluster(members).select("example_id", "task_id")


@query("w13_random_sample", sql("fx_docs", _SPLIT + " SELECT example_id, task_id FROM sp WHERE rn <= 3"))
def w13(spark, d):
    return sc.random_sample(_docs(spark, d), 3).select("example_id", "task_id")


@query("w14_dedup_latest_by_key", sql("fx_scores0", " SELECT task_id, user_prefix, arg_max(score, doc_id) AS score, max(doc_id) AS doc_id FROM fx_scores0 GROUP BY task_id, user_prefix"))
def w14(spark, d):
    return sc.dedup_latest_by_key(fx(spark, d, "fx_scores0"), sc.KEY, "doc_id").select("task_id", "user_prefix", "score", "doc_id")


@query("a07_judge_report", sql("fx_scores", """ SELECT count(*) AS n, round(avg(score), 6) AS avg_score, round(count(*) FILTER (score >= 3) * 100.0::DOUBLE / count(*), 6) AS pct_3, round(count(*) FILTER (score >= 4) * 100.0::DOUBLE / count(*), 6) AS pct_4,
  count(*) FILTER (score = 5) AS n_5, count(*) FILTER (score = 4) AS n_4, count(*) FILTER (score = 3) AS n_3, count(*) FILTER (score = 2) AS n_2, count(*) FILTER (score = 1) AS n_1 FROM fx_scores WHERE score > 0"""))
def a07(spark, d):
    out = sc.judge_report(fx(spark, d, "fx_scores"))
    return out.withColumns({c: F.round(F.col(c).cast("double"), 6) for c in ("avg_score", "pct_3", "pct_4")})


@query("a08_judge_per_task", sql("fx_scores", " SELECT task_id, round(avg(score), 6) AS avg_score, min(score) AS min_score, count(*) AS n, avg(score) < 3 AS flagged FROM fx_scores WHERE score > 0 GROUP BY task_id"))
def a08(spark, d):
    return sc.judge_per_task(fx(spark, d, "fx_scores")).withColumn("avg_score", F.round("avg_score", 6))


_ISS = "list_concat(CASE WHEN quality = 0 THEN ['low quality of ' || task_id] ELSE [] END, CASE WHEN toxic = 1 THEN ['toxic words'] ELSE [] END)"


@query("a09_top_issues", sql("fx_scores", f", x AS (SELECT substr(unnest({_ISS}), 1, 80) AS issue FROM fx_scores) SELECT issue, count(*) AS n FROM x GROUP BY issue ORDER BY n DESC, issue LIMIT 10"))
def a09(spark, d):
    issues = F.array_compact(F.array(F.when(F.expr("quality = 0"), F.concat(F.lit("low quality of "), "task_id")), F.when(F.expr("toxic = 1"), F.lit("toxic words"))))
    return sc.top_issues(fx(spark, d, "fx_scores").withColumn("issues", issues))


@query("j08_apply_repairs", sql("fx_repairs", " SELECT example_id, coalesce(new_score > old_score, false) AS repaired, CAST(CASE WHEN new_score > old_score THEN new_score ELSE old_score END AS BIGINT) AS score FROM (SELECT *, row_number() OVER (PARTITION BY task_id, user_prefix ORDER BY example_id DESC) AS rn FROM fx_repairs) t WHERE rn = 1"))
def j08(spark, d):
    r = sc.dedup_latest_by_key(fx(spark, d, "fx_repairs"), sc.KEY, "example_id")
    return sc.apply_repairs(r.select("example_id", *sc.KEY), r).select("example_id", "repaired", F.col("score").cast("long").alias("score"))


@query("x11_repair_outcomes", sql("fx_repairs", """ SELECT count(*) FILTER (new_score > old_score) AS improved, count(*) FILTER (new_score = old_score) AS unchanged, count(*) FILTER (new_score < old_score) AS degraded, count(*) FILTER (new_score IS NULL) AS failed, count(*) AS total,
  round_even(count(*) FILTER (new_score > old_score) * 100.0::DOUBLE / count(*), 1) AS success_rate FROM fx_repairs"""))
def x11(spark, d):
    return sc.repair_outcomes(fx(spark, d, "fx_repairs")).withColumn("success_rate", F.col("success_rate").cast("double"))
