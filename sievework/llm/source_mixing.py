"""Mixing sources to target weights (operator 10): temperature mixing, Spark SQL functions only.

A source's weight is its token share raised to an exponent in [0, 1] and normalised; 1
keeps the natural mix and 0 is uniform.  The exponent is bisected until the mix reaches a
target entropy, and raised again where a source would repeat more often than allowed.
The weights are realised under a token budget: a source's documents are hashed into
blocks, each epoch takes the blocks in a permutation of its own, and only the block at
the end of the budget is cut, inside its own permuted order.

Nothing but a few aggregate rows per bisection step reaches the driver.  Documents are dealt
over blocks, so a source with a third of all rows is dealt over many tasks; only a source's
blocks, at most ``MOST_BLOCKS`` rows, are ordered in one.  Every text is split into words
once; where the texts go on to the result, those of the cut blocks are split again.

Defined results: a null source is the source ''; a null or empty text has one token (its
end), so every document can be drawn; a null id is placed by its text; repeated rows are
drawn independently of each other's place; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import written

SPACES = "\t\n\x0b\x0c\r "
SEED = "mix1"
LEVELS, PASSES = 5, 6  # bisection steps settled in one Spark job, and jobs
BLOCK_TOKENS = 1 << 16
MOST_BLOCKS = 1 << 16  # of a source; beyond, blocks grow


def token_count(text: Column) -> Column:
    """White-space words and one end token."""
    t = F.translate(F.coalesce(text, F.lit("")), SPACES, " " * len(SPACES))
    return (F.size(F.array_remove(F.split(t, " "), "")) + 1).cast("long")


def source_totals(docs: DataFrame) -> DataFrame:
    """Tokens of each source, from ``_source`` and ``_tokens``."""
    return docs.groupBy("_source").agg(F.sum("_tokens").alias("tokens"))


def _profile(shares: DataFrame, exponents: list[float], keep_all: bool, budget_ratio: float) -> list:
    """Entropy and highest repetition of the mix at each exponent (one small job).

    ``keep_all``: the budget is the least that shows every source once, else a multiple of the corpus.
    """
    e = F.col("e")
    grid = shares.select("p", F.explode(F.array(*map(F.lit, exponents))).alias("e"))
    sums = grid.groupBy("e").agg(
        F.sum(F.pow("p", e)).alias("z"), F.sum(F.pow("p", e) * F.log("p")).alias("s"), F.max(F.pow("p", e - 1)).alias("most"), F.min(F.pow("p", e - 1)).alias("least")
    )
    repeats = F.col("most") / F.col("least") if keep_all else F.col("most") / F.col("z") * budget_ratio
    return sums.select("e", (F.log("z") - e * F.col("s") / F.col("z")).alias("entropy"), repeats.alias("repeats")).orderBy("e").collect()


def bisect(shares: DataFrame, holds, keep_all: bool, budget_ratio: float, low_holds: bool) -> float:
    """The exponent where ``holds(row)`` changes, to 2**-30.

    ``low_holds``: it holds at 0 and the largest such exponent is wanted; else it holds at
    1 and the smallest is wanted.  Each job evaluates the midpoints of five steps at once.
    """
    ends = _profile(shares, [0.0, 1.0], keep_all, budget_ratio)
    if low_holds and holds(ends[1]):
        return 1.0
    if not low_holds and holds(ends[0]):
        return 0.0
    low, high, parts = 0.0, 1.0, 1 << LEVELS
    for _ in range(PASSES):
        width = (high - low) / parts
        inner = [low + i * width for i in range(1, parts)]
        ok = [holds(r) for r in _profile(shares, inner, keep_all, budget_ratio)]
        k = sum(ok) if low_holds else parts - 1 - sum(ok)
        low, high = low + k * width, low + (k + 1) * width
    return low if low_holds else high


def temperature(shares: DataFrame, n_sources: int, entropy_share: float | None, max_repeats: float | None, keep_all: bool, budget_ratio: float) -> float:
    """The exponent, rounded to six decimals: flattest within the repetition limit, no flatter than the target entropy asks."""
    import math

    flat = 1.0 if entropy_share is not None else 0.0
    if entropy_share is not None and n_sources > 1:
        target = entropy_share * math.log(n_sources)
        flat = bisect(shares, lambda r: r["entropy"] >= target, keep_all, budget_ratio, low_holds=True)
    limited = 0.0
    if max_repeats is not None:
        limited = bisect(shares, lambda r: r["repeats"] <= max_repeats, keep_all, budget_ratio, low_holds=False)
    return round(max(flat, limited), 6)


def _hash(*parts: Column | str) -> Column:
    """60 bits of an MD5 over the parts, as a long; the same number in any engine."""
    text = F.concat_ws("|", *[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def mix_sources(
    docs: DataFrame,
    entropy_share: float | None = 0.95,
    max_repeats: float | None = 4.0,
    budget_ratio: float | None = 1.0,
    block_tokens: int = BLOCK_TOKENS,
    id_col: str = "doc_id",
    keep: list[str] | None = None,
) -> DataFrame:
    """One row for each drawn copy: ``_row`` (the input's columns, or those in ``keep`` without the texts), _tokens, _source, _epoch, _block, _block_order, _doc_order.

    ``budget_ratio``: the budget as a multiple of the corpus tokens; None takes the least
    budget that shows every document at least once.
    """
    h = _hash(F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("null:"), F.md5(F.coalesce(F.col("text"), F.lit(""))))), SEED)
    placed_by = F.coalesce(F.col("source"), F.lit("")).alias("_source"), F.col("text").alias("_text"), h.alias("_h")
    if keep is not None:
        rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row"), *placed_by)
    else:
        rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), *placed_by)
    if keep is not None:  # without the texts: a small table of its own
        rows = head = written(rows.withColumn("_tokens", token_count(F.col("_text"))).drop("_text"), "mix-rows")
    else:
        head = written(rows.select("_source", "_h", token_count(F.col("_text")).alias("_tokens")), "mix-rows")
    totals = written(source_totals(head), "mix-totals")
    n, total = totals.agg(F.count("*"), F.coalesce(F.sum("tokens"), F.lit(0))).first()
    if not n:
        new = {"_epoch": F.lit(0), "_block": F.lit(0).cast("long"), "_block_order": F.lit(0).cast("long"), "_doc_order": F.col("_h"), "_tokens": F.lit(0).cast("long")}
        return rows.withColumns({k: c for k, c in new.items() if k not in rows.columns}).select("_row", "_source", "_tokens", "_epoch", "_block", "_block_order", "_doc_order")
    keep_all = budget_ratio is None
    shares = totals.select("_source", "tokens", (F.col("tokens") / F.lit(float(total))).alias("p"))
    e = temperature(shares, n, entropy_share, max_repeats, keep_all, budget_ratio or 1.0)

    z, least = shares.agg(F.sum(F.pow("p", F.lit(e))), F.min(F.pow("p", F.lit(e - 1)))).first()
    budget = total * z / least if keep_all else total * budget_ratio
    # a relative 1e-9 absorbs rounding, so that a source meant to be shown once is not short of a token
    quota = F.floor(F.pow("p", F.lit(e)) / F.lit(z) * F.lit(float(budget)) * F.lit(1 + 1e-9)).cast("long")
    plan = shares.select(
        "_source",
        F.floor(quota / F.col("tokens")).cast("int").alias("_full"),
        (quota % F.col("tokens")).alias("_rest"),
        F.least(F.ceil(F.col("tokens") / F.lit(block_tokens)).cast("long"), F.lit(MOST_BLOCKS)).alias("_blocks"),
    )
    plan = written(plan, "mix-plan")
    dealt, heads = (r.join(plan, "_source").withColumn("_block", F.col("_h") % F.col("_blocks")) for r in (rows, head))

    # order the blocks for the last, partial epoch and find where the quota ends
    sizes = heads.groupBy("_source", "_block").agg(F.sum("_tokens").alias("size"), F.first("_full").alias("_f"), F.first("_rest").alias("_r"))
    order = _hash(F.col("_source"), F.col("_block"), F.col("_f"), SEED)
    upto = Window.partitionBy("_source").orderBy("order", "_block").rowsBetween(Window.unboundedPreceding, 0)
    cut = sizes.withColumn("order", order).withColumn("end", F.sum("size").over(upto)).select(
        "_source",
        "_block",
        (F.col("end") <= F.col("_r")).alias("_whole"),
        F.when((F.col("end") > F.col("_r")) & (F.col("end") - F.col("size") < F.col("_r")), F.col("_r") - F.col("end") + F.col("size")).alias("_left"),
    )
    cut = written(cut, "mix-blocks")
    placed = dealt.join(cut, ["_source", "_block"])
    inside = Window.partitionBy("_source", "_block").orderBy("_h", "_tokens").rowsBetween(Window.unboundedPreceding, 0)
    if keep is None:  # after the join, so that only texts of cut blocks are split here
        placed = placed.withColumn("_tokens", token_count(F.col("_text"))).drop("_text")
    whole = placed.where(F.col("_left").isNull()).withColumn("_n", F.col("_full") + F.col("_whole").cast("int"))
    edge = placed.where(F.col("_left").isNotNull()).withColumn("_n", F.col("_full") + (F.sum("_tokens").over(inside) <= F.col("_left")).cast("int"))
    drawn = whole.unionByName(edge).where("_n > 0")
    copies = drawn.select("_row", "_source", "_tokens", "_block", "_h", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("_epoch"))
    return copies.select(
        "_row", "_source", "_tokens", "_epoch", "_block",
        _hash(F.col("_source"), F.col("_block"), F.col("_epoch"), SEED).alias("_block_order"), F.col("_h").alias("_doc_order"),
    )


def mixed_documents(docs: DataFrame, max_repeats: float = 1.25) -> DataFrame:
    """Every document at least once, rarer sources up to ``max_repeats`` times: the input's columns, copies as rows."""
    return mix_sources(docs, entropy_share=None, max_repeats=max_repeats, budget_ratio=None).select("_row.*")


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus' own token budget at 95 % of the highest entropy, at most four repeats."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    mixed = mix_sources(docs, keep=["doc_id"])
    return mixed.select("_row.doc_id", F.col("_source").alias("source"), F.col("_tokens").alias("n_tokens"), F.col("_epoch").alias("epoch"), F.col("_block").alias("block"), F.col("_block_order").alias("block_order"), F.col("_doc_order").alias("doc_order"))


def _h(*parts: str) -> str:
    return f"CAST('0x' || substr(md5(concat_ws('|', {', '.join(parts)}, '{SEED}')), 1, 15) AS BIGINT)"


OP10_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(source, '') AS source, CAST(len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')) + 1 AS BIGINT) AS n_tokens,
    {_h("coalesce(CAST(doc_id AS VARCHAR), 'null:' || md5(coalesce(text, '')))")} AS h FROM documents),
s AS (SELECT source, CAST(sum(n_tokens) AS BIGINT) AS tokens FROM d GROUP BY source),
t AS (SELECT CAST(sum(tokens) AS BIGINT) AS total, count(*) AS n FROM s),
p AS (SELECT source, tokens, CAST(tokens AS DOUBLE) / CAST(total AS DOUBLE) AS p FROM s, t),
ent(step, lo, hi) AS (
  SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
  UNION ALL
  SELECT step + 1, CASE WHEN ok THEN m ELSE lo END, CASE WHEN ok THEN hi ELSE m END
  FROM (SELECT step, lo, hi, m, (SELECT ln(sum(pow(p, m))) - m * sum(pow(p, m) * ln(p)) / sum(pow(p, m)) FROM p) >= 0.95 * (SELECT ln(n) FROM t) AS ok
        FROM (SELECT *, (lo + hi) / 2 AS m FROM ent WHERE step < 30))),
rep(step, lo, hi) AS (
  SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
  UNION ALL
  SELECT step + 1, CASE WHEN ok THEN lo ELSE m END, CASE WHEN ok THEN m ELSE hi END
  FROM (SELECT step, lo, hi, m, (SELECT max(pow(p, m - 1)) / sum(pow(p, m)) FROM p) <= 4.0 AS ok
        FROM (SELECT *, (lo + hi) / 2 AS m FROM rep WHERE step < 30))),
e AS (
  SELECT round(greatest(
    CASE WHEN (SELECT n FROM t) <= 1 OR (SELECT -sum(p * ln(p)) FROM p) >= 0.95 * (SELECT ln(n) FROM t) THEN 1.0 ELSE (SELECT lo FROM ent WHERE step = 30) END,
    CASE WHEN (SELECT max(1 / p) / count(*) FROM p) <= 4.0 THEN 0.0 ELSE (SELECT hi FROM rep WHERE step = 30) END), 6) AS e),
q AS (
  SELECT source, tokens, CAST(floor(pow(p, e) / (SELECT sum(pow(p, e)) FROM p, e) * CAST((SELECT total FROM t) AS DOUBLE) * (1 + 1e-9)) AS BIGINT) AS quota,
    least(CAST(ceil(tokens / {BLOCK_TOKENS}) AS BIGINT), {MOST_BLOCKS}) AS blocks FROM p, e),
b AS (SELECT d.*, quota // tokens AS f, quota % tokens AS r, h % blocks AS block FROM d JOIN q USING (source)),
z AS (SELECT source, block, sum(n_tokens) AS size, any_value(f) AS f, any_value(r) AS r, {_h("source", "block", "any_value(f)")} AS o FROM b GROUP BY source, block),
c AS (SELECT source, block, size, sum(size) OVER (PARTITION BY source ORDER BY o, block ROWS UNBOUNDED PRECEDING) AS fin FROM z),
k AS (
  SELECT b.*, fin, size, sum(n_tokens) OVER (PARTITION BY source, block ORDER BY h, n_tokens ROWS UNBOUNDED PRECEDING) AS upto
  FROM b JOIN c USING (source, block)),
g AS (SELECT *, f + CASE WHEN fin <= r THEN 1 WHEN fin - size < r AND upto <= r - fin + size THEN 1 ELSE 0 END AS copies FROM k)
SELECT doc_id, source, n_tokens, CAST(epoch AS INTEGER) AS epoch, block, {_h("source", "block", "CAST(epoch AS INTEGER)")} AS block_order, h AS doc_order
FROM g, LATERAL (SELECT unnest(range(0, copies)) AS epoch)
"""
