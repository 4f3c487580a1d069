"""Secret scans (operator 1): an incremental, content-addressed blob ledger.

Every version of a text is addressed by the SHA-256 of its bytes.  The ledger holds,
for each blob, which rule versions have scanned it and what they found.  A scan looks
only at (blob, rule version) pairs that the ledger lacks, each blob once however many
paths hold it, and joins the findings back to all paths.  Spark SQL functions only.

Spans are code points with an exclusive end.  Starts come from splitting the text at
the rule's matches: piece and match lengths add up to every match's position.

Defined results: a null text is an empty text (it has an address and no findings);
null path ids and repeated rows each keep a row of their own; an empty table gives an
empty result; columns of the input other than id and text are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import work_dir


@dataclass(frozen=True)
class SecretRule:
    """``pattern`` matches leftmost and non-overlapping; a match counts if its ``group`` has ``min_chars``.

    ``hints`` are lower-case strings of which every match contains one; texts without any
    are not searched by the pattern.  They speed the search up and never change its result.
    """

    kind: str
    pattern: str
    min_chars: int
    group: int = 0
    hints: tuple[str, ...] = ()
    version: int = 1
    base: bool = True

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


RULES = (
    SecretRule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2, ("passw", "secret", "token", "apikey", "api_key")),
    SecretRule("access", r"AKIA[A-Z0-9]+", 18, hints=("akia",)),
    SecretRule("hex", r"[0-9a-f]{16,}", 16),  # maximal runs, so the length may stand in the pattern
    SecretRule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 30, hints=("eyj",), base=False),
    SecretRule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 20, hints=("private key-----",), base=False),
)

SALTS = 16
_FINDING = "struct<kind:string,start:int,end:int>"


def _spans(text: Column, lowered: Column, rule: SecretRule) -> Column:
    """All counted matches of one rule as array<struct<kind, start, end>>."""
    pattern = F.lit(rule.pattern)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    tested = matches if rule.group == 0 else F.regexp_extract_all(text, pattern, F.lit(rule.group))
    parts = F.arrays_zip(F.transform(F.split(text, rule.pattern, -1), F.length).alias("gap"), F.transform(matches, F.length).alias("len"), F.transform(tested, F.length).alias("tested"))
    zero = F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() as array<{_FINDING}>)").alias("found"))

    def step(acc: Column, p: Column) -> Column:
        start = acc["at"] + p["gap"]
        end = start + F.coalesce(p["len"], F.lit(0))
        one = F.array(F.struct(F.lit(rule.kind).alias("kind"), start.alias("start"), end.alias("end")))
        found = F.when(F.coalesce(p["tested"], F.lit(0)) >= rule.min_chars, F.concat(acc["found"], one)).otherwise(acc["found"])
        return F.struct(end.alias("at"), found.alias("found"))

    found = F.aggregate(parts, zero, step, lambda acc: acc["found"])
    if not rule.hints:
        return F.when(F.regexp_like(text, F.lit(rule.pattern)), found)
    hinted = F.lit(False)
    for h in rule.hints:
        hinted = hinted | F.contains(lowered, F.lit(h))
    return F.when(hinted, found)


class BlobLedger:
    """Findings by content address, kept as Parquet: one row for each blob and scan.

    Columns: blob, rules (keys ``kind@version`` scanned then), findings.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, rules: tuple[SecretRule, ...] = RULES):
        self.spark, self.rules = spark, rules
        self.path = path or work_dir(spark, "secret-ledger")

    def rows(self) -> DataFrame | None:
        """The ledger so far, None before the first scan."""
        from pyspark.errors import AnalysisException

        try:
            return self.spark.read.schema(f"blob string, rules array<string>, findings array<{_FINDING}>").parquet(self.path)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return None

    def scan(self, versions: DataFrame, text: str = "text") -> None:
        """Scan the unseen (blob, rule version) pairs of ``versions`` and append the findings."""
        keys = [r.key for r in self.rules]
        t = F.coalesce(F.col(text), F.lit(""))
        # equal texts share a blob: map-side combine sends each content once from each task
        blobs = versions.select(F.sha2(t, 256).alias("blob"), t.alias("text")).groupBy("blob").agg(F.first("text").alias("text"))
        known = self.rows()
        if known is None:
            todo = blobs.withColumn("todo", F.array(*map(F.lit, keys)))
        else:
            seen = known.select("blob", F.explode("rules").alias("rule")).groupBy("blob").agg(F.collect_set("rule").alias("seen"))
            todo = blobs.join(seen, "blob", "left").withColumn("todo", F.array_except(F.array(*map(F.lit, keys)), F.coalesce("seen", F.expr("cast(array() as array<string>)"))))
            todo = todo.where(F.size("todo") > 0)
        lowered = todo.withColumn("lowered", F.lower("text"))
        none = F.expr(f"cast(array() as array<{_FINDING}>)")
        found = [F.coalesce(F.when(F.array_contains("todo", r.key), _spans(F.col("text"), F.col("lowered"), r)), none) for r in self.rules]
        lowered.select("blob", F.col("todo").alias("rules"), F.concat(*found).alias("findings")).write.mode("append").parquet(self.path)

    def findings(self, versions: DataFrame, ids: list[str], text: str = "text") -> DataFrame:
        """``ids`` and all findings of each path's blob under the current rule versions."""
        current = F.array(*[F.lit(r.key) for r in self.rules])
        current_kinds = [r.kind for r in self.rules]
        rows = self.rows()
        live = rows.where(F.arrays_overlap("rules", current) & (F.size("findings") > 0))
        # a scan row may hold findings of superseded rule versions beside current ones
        versions_of = F.transform(F.col("rules"), lambda r: r)
        one = live.select("blob", F.explode("findings").alias("f"), versions_of.alias("rules"))
        key_of = F.create_map(*[x for r in self.rules for x in (F.lit(r.kind), F.lit(r.key))])
        one = one.where(F.col("f.kind").isin(*current_kinds) & F.array_contains(F.col("rules"), F.element_at(key_of, F.col("f.kind"))))
        by_blob = one.groupBy("blob").agg(F.collect_set("f").alias("findings"))
        paths = versions.select(*ids, F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("blob"))
        # a blob may have very many paths: they are salted, and the few blobs with findings repeated for each salt
        salted = paths.withColumn("_salt", F.pmod(F.xxhash64(*ids), F.lit(SALTS)).cast("int"))
        each = by_blob.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = salted.join(each, ["blob", "_salt"], "left").drop("_salt")
        return joined.withColumn("findings", F.coalesce("findings", F.expr(f"cast(array() as array<{_FINDING}>)")))


def _ordered(findings: Column, rules: tuple[SecretRule, ...]) -> Column:
    """Sorted by start, then by the rules' order."""
    rank = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(i))])
    keyed = F.transform(findings, lambda f: F.struct(f["start"].alias("start"), F.element_at(rank, f["kind"]).alias("rank"), f["end"].alias("end"), f["kind"].alias("kind")))
    return F.sort_array(keyed)


def _joined(ordered: Column) -> Column:
    return F.array_join(F.transform(ordered, lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))), ",")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fresh ledger takes every version in ``documents``; one row per path."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    ledger = BlobLedger(spark)
    ledger.scan(docs)
    found = ledger.findings(docs, ["doc_id"]).withColumn("o", _ordered(F.col("findings"), RULES))
    base = F.filter("o", lambda f: f["kind"].isin(*[r.kind for r in RULES if r.base]))
    count = lambda kind: F.size(F.filter("o", lambda f: f["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("o")).alias("spans"),
    )


def _sql_spans(kind: str, rank: int, pattern: str, group: int, least: int, options: str = "c") -> str:
    """Match k starts after the first k + 1 pieces and the first k matches."""
    p = pattern.replace("'", "''")
    return f"""
  SELECT rid, '{kind}' AS kind, {rank} AS rank, CAST(list_sum(g[:k]) + coalesce(list_sum(n[:k - 1]), 0) AS BIGINT) AS s, n[k] AS len
  FROM (SELECT rid, list_transform(regexp_split_to_array(t, '{p}', '{options}'), lambda x: length(x)) AS g, list_transform(regexp_extract_all(t, '{p}', 0, '{options}'), lambda x: length(x)) AS n,
               list_transform(regexp_extract_all(t, '{p}', {group}, '{options}'), lambda x: length(x)) AS c FROM d WHERE regexp_matches(t, '{p}', '{options}')),
       LATERAL (SELECT unnest(range(1, len(n) + 1)) AS k) WHERE c[k] >= {least}"""


_ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""

OP1_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
f AS ({_sql_spans("assign", 0, _ASSIGN, 2, 12, "i")} UNION ALL {_sql_spans("access", 1, "AKIA[A-Z0-9]+", 0, 18)} UNION ALL {_sql_spans("hex", 2, "[0-9a-f]+", 0, 16)}
  UNION ALL {_sql_spans("jwt", 3, r"eyJ[A-Za-z0-9_-]+[.]eyJ[A-Za-z0-9_-]+[.][A-Za-z0-9_-]+", 0, 30)} UNION ALL {_sql_spans("pem", 4, "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 20)}),
g AS (
  SELECT rid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(kind || ':' || s || ':' || (s + len), ',' ORDER BY s, rank) FILTER (rank < 3) AS base,
    string_agg(kind || ':' || s || ':' || (s + len), ',' ORDER BY s, rank) AS spans FROM f GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (rid)
"""
