"""Sources and sinks (S01-S14, S16): examples, scores, states, logs and documents as files; versioned writes.

Writes always go to a new path, never onto an input of the same plan.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.running import running

EXAMPLE = "task_id string, source string, messages array<struct<role:string,content:string>>"
SCORE = "struct<score:int,criteria_met:array<int>,issues:array<string>,reasoning:string,error:string,task_id:string,source:string>"
STATE = "struct<model_history:array<struct<version:int,ollama_name:string,avg_score:double,scores:map<string,double>,timestamp:string>>>"

_OWN: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``; a temporary one only where it is unset (local runs)."""
    base = spark.conf.get("spark.checkpoint.dir", "") or ""
    if not base:
        app = spark.sparkContext.applicationId
        if app not in _OWN:
            _OWN[app] = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
            spark.sparkContext.setCheckpointDir(_OWN[app])
        base = _OWN[app]
    return base.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table that is read several times to the shared folder, and read it from there."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    schema = f"{EXAMPLE}, _corrupt_record string"
    lines = spark.read.text(path).where(F.trim("value") != "")
    return lines.select(F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}).alias("r")).select("r.*")


def scan_tolerant(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines without blank and corrupt ones."""
    return _lines(spark, path).where("_corrupt_record IS NULL").drop("_corrupt_record")


def scan_strict(spark: SparkSession, path: str) -> DataFrame:
    """Fails on a bad line."""
    return spark.read.schema(EXAMPLE).option("mode", "FAILFAST").json(path)


def scan_corrupt_counts(spark: SparkSession, path: str) -> DataFrame:
    """Rows by task; bad lines count under ``__corrupt__``, rows without a task under ``unknown``."""
    key = F.when(F.col("_corrupt_record").isNotNull(), F.lit("__corrupt__")).otherwise(F.coalesce("task_id", F.lit("unknown")))
    return _lines(spark, path).groupBy(key.alias("task_id")).agg(F.count("*").alias("n"))


def scan_with_split(spark: SparkSession, train: str, val: str) -> DataFrame:
    return scan_tolerant(spark, train).withColumn("split", F.lit("train")).unionByName(scan_tolerant(spark, val).withColumn("split", F.lit("val")))


def _numbered(raw: DataFrame, *columns) -> DataFrame:
    """Rows of a text scan with their number in their file: the place in the split plus the rows of earlier splits."""
    meta = F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    rows = stored(raw.select(*columns, *meta, F.monotonically_increasing_id().alias("id")), "numbered")  # ids are fixed from here on
    blocks = rows.groupBy("file", "block").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = blocks.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).select("file", "block", "base")
    return rows.join(base, ["file", "block"]).withColumn("no", F.col("id") + F.col("base")).drop("id", "base", "block")


def scan_map(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Files of one JSON object each as (file, key, value), an object of any size read in splits.

    The text is cut at commas.  Whether a piece begins inside a string, and how deep, follows
    from the quotes and brackets before it, counted in blocks of a file; the pieces between two commas of
    the outer object are one entry, which is parsed by itself (``kind`` is the type of its value).
    A key that stands twice gives two rows.
    """
    pieces = _numbered(spark.read.option("lineSep", ",").text(path), F.col("value").alias("piece"))
    bare = pieces.withColumn("_e", F.regexp_replace("piece", r"(?s)\\.", ""))
    quotes = F.length("_e") - F.length(F.replace("_e", F.lit('"')))
    quoted = running(bare, "file", "no", _q=("sum", quotes))
    inside = (F.col("_q") - quotes) % 2 == 1
    outer = F.regexp_replace(F.when(inside, F.regexp_replace("_e", r'^[^"]*("|$)', "")).otherwise(F.col("_e")), r'"[^"]*("|$)', "")
    marked = quoted.select("file", "no", "piece", inside.alias("_in"), (F.regexp_count(outer, F.lit(r"[{\[]")) - F.regexp_count(outer, F.lit(r"[}\]]"))).alias("_d"))
    deep = running(marked, "file", "no", depth=("sum", F.col("_d"))).withColumn("_before", F.col("depth") - F.col("_d"))
    starts = running(deep, "file", "no", entry=("sum", F.when(~F.col("_in") & (F.col("_before") <= 1), 1).otherwise(0)))
    whole = starts.groupBy("file", "entry").agg(F.sort_array(F.collect_list(F.struct("no", "piece"))).alias("_p"), F.min("_before").alias("_first"), F.min("depth").alias("_last"))
    text = F.array_join(F.transform("_p", lambda x: x["piece"]), ",")
    text = F.when(F.col("_first") == 0, F.regexp_replace(text, r"^[^{]*\{", "")).otherwise(text)
    text = F.when(F.col("_last") == 0, F.regexp_replace(text, r"\}\s*$", "")).otherwise(text)
    return whole.select("file", F.explode(F.from_json(F.concat(F.lit("{"), text, F.lit("}")), f"map<string,{kind}>")).alias("key", "value"))


def scan_scores(spark: SparkSession, path: str) -> DataFrame:
    """A map file ``"task|prefix" -> score`` (either separator) as rows (task_id, user_prefix, score, issues, error)."""
    rows = scan_map(spark, path, SCORE).select("key", F.col("value").alias("s"))
    prefix = F.regexp_replace("key", r"(?s)^[^|:]*(?:\||::)", "")
    return rows.select(F.coalesce("s.task_id", F.regexp_extract("key", r"^([^|:]*)", 1)).alias("task_id"), prefix.alias("user_prefix"), "s.score", "s.issues", "s.error")


def scan_model_history(spark: SparkSession, path: str) -> DataFrame:
    """State files as (version, task_id, score, ts)."""
    text = spark.read.text(path, wholetext=True)
    runs = text.select(F.explode(F.from_json("value", STATE)["model_history"]).alias("r"))
    return runs.select("r.version", F.explode("r.scores").alias("task_id", "score"), F.col("r.timestamp").cast("timestamp").alias("ts"))


def scan_log(spark: SparkSession, path: str, latest: bool = False) -> DataFrame:
    """Text logs as (run_id, line_no, line), one run per file; ``latest``: the file modified last.

    The run is the folder's ``run_id=`` or else the file's name.  Large logs are read in
    splits: a line's number is its place in its split plus the lines of earlier splits, so no
    file is gathered or sorted by one task.
    """
    raw = spark.read.text(path)
    run = F.col("run_id").cast("string") if "run_id" in raw.columns else F.col("_metadata.file_name")
    meta = F.col("_metadata.file_modification_time").alias("at"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    lines = raw.select(run.alias("run_id"), *meta, F.monotonically_increasing_id().alias("id"), F.col("value").alias("line"))
    if latest:
        newest = raw.select(F.col("_metadata.file_modification_time").alias("at"), run.alias("run_id")).agg(F.max(F.struct("at", "run_id")).alias("m"))
        lines = lines.join(F.broadcast(newest.select("m.run_id")), "run_id", "left_semi")
    lines = stored(lines, "log-lines")  # ids are fixed from here on
    blocks = lines.groupBy("file", "block").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = blocks.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).select("file", "block", "base")
    return lines.join(base, ["file", "block"]).select("run_id", (F.col("id") + F.col("base")).cast("int").alias("line_no"), "line")


def scan_task_docs(spark: SparkSession, path: str, glob: str = "task_*.md") -> DataFrame:
    """Whole task documents as (path, body)."""
    return spark.read.option("pathGlobFilter", glob).text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("body"))


def scan_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """Count files as (version, task_id, n); the version is in the name (``..._v<version>.json``) or the folder (``version=``)."""
    text = spark.read.text(path, wholetext=True)
    per = F.from_json("value", "struct<per_task:map<string,bigint>>")["per_task"]
    return text.select(F.regexp_extract("_metadata.file_path", r"(?:_v|version=)(\d+)(?:\.json$|/)", 1).cast("int").alias("version"), F.explode(per).alias("task_id", "n"))


def scan_run_scores(spark: SparkSession, path: str) -> DataFrame:
    """Score files as (model, run, task_id, score); named ``<model>_run<k>.scores.json`` or in folders ``model=``/``run=``."""
    of = lambda p: F.regexp_extract("file", p, 1)
    model = F.coalesce(F.nullif(of(r"model=([^/]+)/"), F.lit("")), of(r"([^/]+)_run\d+\.scores\.json$"))
    return scan_map(spark, path, "double").select(model.alias("model"), of(r"(?:_run|/run=)(\d+)(?:\.scores\.json$|/)").cast("int").alias("run"), F.col("key").alias("task_id"), F.col("value").alias("score"))


def sink_overwrite(examples: DataFrame, root: str, version: int) -> str:
    """Write a dataset version, partitioned by split; returns its path."""
    path = f"{root}/version={version}"
    examples.write.mode("overwrite").partitionBy("split").parquet(path)
    return path


def sink_append(examples: DataFrame, path: str) -> None:
    examples.write.mode("append").parquet(path)


def sink_report(report: DataFrame, path: str) -> None:
    """A report (few rows) as one JSON file."""
    report.coalesce(1).write.mode("overwrite").json(path)


def snapshot(examples: DataFrame, root: str, label: str, ts: str) -> str:
    """A labelled, timestamped copy of both splits."""
    path = f"{root}/label={label}/ts={ts}"
    examples.write.mode("errorifexists").partitionBy("split").parquet(path)
    return path


def version_artifacts(scores: DataFrame, counts: DataFrame, root: str) -> None:
    """Scores and counts side by side, partitioned by version; rewriting a version replaces it alone."""
    for name, df in (("scores", scores), ("counts", counts)):
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("version").parquet(f"{root}/{name}")
