"""Quality rules (operator 6): a threshold table compiled into one Spark projection.

All counts come from built-in functions over the whole text, so the operator is one
narrow projection: no shuffle, no user function, one pass over the scan.

Defined results: a null text counts as empty (all counts 0, ``base_failed`` true, not
kept); columns of the input named like a metric are replaced by it, all others stay
whatever their names (``keep_good`` keeps all columns as they are); null ids, repeated
rows and empty tables pass through row by row.  Stop words are those of English, French,
German and Spanish: for other languages take a rule table without ``stop_words``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SYMBOLS = "#*$%&|<>"
SPACES = "\t\n\x0b\x0c\r "

# Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to in a is that for it as with on be by this are was or an at from not have has "
    "le la les de des du et en un une que qui dans pour par sur est au aux pas avec ce il elle "
    "der die das und den von zu mit ist im nicht ein eine auf für sich dem des auch als "
    "el los las del y se con su para al lo como más o pero sus una"
).split()


@dataclass(frozen=True)
class Rule:
    """A row of the threshold table: ``low <= value <= high``, tested on texts of at least ``from_words`` words."""

    name: str
    value: str
    low: float | None = None
    high: float | None = None
    from_words: int = 0


#: Each value is a SQL expression over the metrics; ratios are null where their base is 0, and null passes.
RULES = (
    Rule("symbols", "n_symbols / nullif(n_words, 0)", high=0.25),
    Rule("mean_word_chars", "word_chars / nullif(n_words, 0)", low=1.5, high=20.0),
    Rule("stop_words", "n_stop_words / nullif(n_words, 0)", low=0.02, from_words=50),
    Rule("shouted_words", "n_shouted / nullif(n_words, 0)", high=0.3),
    Rule("repeated_lines", "n_dup_lines / nullif(n_lines, 0)", high=0.5),
)


def _words(text: Column) -> Column:
    one_space = F.translate(text, SPACES, " " * len(SPACES))
    return F.array_remove(F.split(one_space, " "), "")


def _repeat_words(words: Column, n_words: Column, grams: Column) -> Column:
    """Words in 3-word windows that occur twice or more.

    A window is packed as hash bits above position bits, so sorting one array of longs
    puts equal windows side by side; neighbours are then compared word by word.
    """
    bits = F.length(F.bin(n_words)).cast("int")
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - F.lit(1).cast("long")
    packed = F.sort_array(F.transform(grams, lambda h, i: F.call_function("shiftleft", h, bits).bitwiseOR(i.cast("long"))))

    def same(all_, x: Column, i: Column) -> Column:
        other = F.get(all_, i)
        p, q = x.bitwiseAND(mask).cast("int"), other.bitwiseAND(mask).cast("int")
        equal = F.call_function("shiftright", x, bits) == F.call_function("shiftright", other, bits)
        for k in range(3):
            equal = equal & (F.get(words, p + k) == F.get(words, q + k))
        return F.coalesce(equal, F.lit(False))

    def positions(all_: Column) -> Column:
        found = F.filter(all_, lambda x, i: same(all_, x, i - 1) | same(all_, x, i + 1))
        return F.sort_array(F.transform(found, lambda x: x.bitwiseAND(mask)))

    start = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))

    def cover(acc: Column, p: Column) -> Column:
        return F.struct((p + 3).alias("end"), (acc["n"] + p + 3 - F.greatest(acc["end"], p)).alias("n"))

    # the packed array enters through a one-element array, so that it is computed once
    counted = F.transform(F.array(packed), lambda a: F.aggregate(positions(a), start, cover, lambda acc: acc["n"]))
    repeated = F.size(F.array_distinct(grams)) < F.size(grams)
    return F.when(repeated, F.get(counted, 0)).otherwise(F.lit(0)).cast("long")


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_stop_words, n_shouted, n_repeat_words``."""
    metrics = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_stop_words", "n_shouted", "n_repeat_words"]
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in metrics]
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: F.length(F.translate(x, SPACES, "")) > 0)
    base = docs.select(
        F.struct(*kept).alias("_row"),
        _words(t).alias("_words"),
        lines.alias("_lines"),
        F.length(F.translate(t, SPACES, "")).cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
    )
    w = F.col("_words")
    grams = F.transform(F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))), lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
    counted = base.select(
        "*",
        F.size(w).cast("long").alias("n_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter(w, lambda x: F.lower(x).isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
        F.size(F.filter(w, lambda x: F.endswith(x, F.lit("!!")))).cast("long").alias("n_shouted"),
        grams.alias("_grams"),
    )
    found = F.struct(*metrics[:-1], _repeat_words(F.col("_words"), F.col("n_words"), F.col("_grams")).alias("n_repeat_words"))
    # a one-row generator keeps later filters from being pushed into, and copying, these expressions
    return counted.select("_row", F.explode_outer(F.array(found)).alias("_m")).select("_row.*", "_m.*")


def compile_rules(rules: tuple[Rule, ...] = RULES) -> Column:
    """One boolean expression that is true where every rule of the table passes."""
    passed = F.lit(True)
    for r in rules:
        value = F.expr(r.value)
        ok = F.lit(True)
        if r.low is not None:
            ok = ok & (value >= r.low)
        if r.high is not None:
            ok = ok & (value <= r.high)
        passed = passed & (F.coalesce(ok, F.lit(True)) | (F.col("n_words") < r.from_words))
    return passed


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)


def apply_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """Metrics plus ``base_failed`` and ``kept``, one row per input row."""
    df = measure(docs.drop("base_failed", "kept"), text)
    return df.select("*", base_failed().alias("base_failed"), (~base_failed() & compile_rules(rules)).alias("kept"))


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The documents that pass, with their own columns only (a metric's name in the input survives)."""
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("text").alias("_text"))
    return apply_rules(inner, rules, "_text").where("kept").select("_row.*")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return apply_rules(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines", "n_stop_words", "n_shouted")


_STOP_LIST = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))

OP6_SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l
  FROM documents),
win AS (
  SELECT rid, doc_id, i, w[i] || chr(1) || w[i + 1] || chr(1) || w[i + 2] AS g
  FROM (SELECT row_number() OVER () AS rid, * FROM d), LATERAL (SELECT unnest(range(1, len(w) - 1)) AS i)),
dup AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c >= 2),
rep AS (
  SELECT rid, CAST(count(DISTINCT p) AS BIGINT) AS n_repeat_words
  FROM (SELECT rid, i AS p FROM dup UNION ALL SELECT rid, i + 1 FROM dup UNION ALL SELECT rid, i + 2 FROM dup) GROUP BY rid),
m AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words,
    CAST(len(l) AS BIGINT) AS n_lines,
    CAST(len(list_filter(w, lambda x: list_contains([{_STOP_LIST}], lower(x)))) AS BIGINT) AS n_stop_words,
    CAST(len(list_filter(w, lambda x: x LIKE '%!!')) AS BIGINT) AS n_shouted
  FROM (SELECT row_number() OVER () AS rid, * FROM d) LEFT JOIN rep USING (rid)),
b AS (SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM m)
SELECT *, (NOT base_failed
  AND coalesce(n_symbols / nullif(n_words, 0) <= 0.25, true)
  AND coalesce(word_chars / nullif(n_words, 0) BETWEEN 1.5 AND 20.0, true)
  AND coalesce(n_stop_words / nullif(n_words, 0) >= 0.02, true)
  AND coalesce(n_shouted / nullif(n_words, 0) <= 0.3, true)
  AND coalesce(n_dup_lines / nullif(n_lines, 0) <= 0.5, true)) AS kept
FROM b
"""
