"""Every registered query of the corpus operators on the smallest tables: against its SQL, or against brute force."""

import zlib
from collections import Counter

import corpus_pipeline
import duckdb
import numpy as np
import pytest
from edge import TEXTS, docs, empty
from test_duplicates import brute_fingerprint, brute_kept, brute_repeats, components
from test_tokens_and_leaks import brute_ids, brute_leaks

from sievework.llm import decontamination, queries, quality_rules

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows():
    return duckdb.execute(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()


def plain(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", list(queries.ORACLE_SQL))
def test_sql_gives_the_same_rows(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    want = con.execute(queries.ORACLE_SQL[name])
    at = [d[0] for d in want.description]
    assert sorted(at) == columns
    got = sorted(repr(tuple(map(plain, r))) for r in df.select(*columns).collect())
    assert got == sorted(repr(tuple(plain(r[at.index(c)]) for c in columns)) for r in want.fetchall())


def test_op2_is_the_tokenizer(spark, rows):
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in queries.QUERIES["op2_token_files"](spark, SF).collect()}
    start, want = 0, {}
    for i, t in rows:
        ids = brute_ids(t)
        want[i] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert got == want


def test_op3_is_brute_force(spark, rows):
    items = duckdb.execute(f"SELECT item_id, text FROM '{SF}/benchmark.parquet' ORDER BY item_id").fetchall()
    got = {(r["doc_id"], r["item_id"]) for r in queries.QUERIES["op3_benchmark_decontamination"](spark, SF).collect()}
    want = set(brute_leaks(rows, items))
    assert got <= want and len(got) >= 0.95 * len(want)


def test_op4_is_brute_force(spark, rows):
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in queries.QUERIES["op4_simhash_near_dedup"](spark, SF).collect()}
    codes = [brute_fingerprint(t) for _, t in rows]
    root = components(codes, 4)
    name = {}
    for (i, _), r in zip(rows, root, strict=True):
        name[r] = min(i, name.get(r, i))
    assert got == {i: (f"{c:016x}", name[r]) for (i, _), c, r in zip(rows, codes, root, strict=True)}


def test_op5_and_op9_score_every_row(spark, rows):
    for name, flag in (("op5_quality_classifier", "predicted"), ("op9_toxicity", "toxic")):
        got = queries.QUERIES[name](spark, SF).collect()
        assert sorted(r["doc_id"] for r in got) == [i for i, _ in rows]
        assert all(0 <= r["score"] <= 1 and r[flag] in (0, 1) for r in got)


def test_op8_is_brute_force(spark, rows):
    got = [(r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in queries.QUERIES["op8_suffix_dedup"](spark, SF).collect()]
    assert sorted(got) == brute_repeats(rows)


def test_pipeline_stage_by_stage(spark, rows):
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    texts = dict(rows)
    stages = dict(corpus_pipeline.STAGES)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    good = {r[0] for r in con.execute(f"SELECT doc_id FROM ({queries.ORACLE_SQL['op6_quality_rules']}) WHERE kept").fetchall()}
    one = stages["quality_rules"](spark, frame, SF)
    assert one.columns == frame.columns and {r["doc_id"] for r in one.collect()} == good
    two = stages["simhash_near_dedup"](spark, one, SF)
    kept = [r["doc_id"] for r in two.collect()]
    assert sorted(kept) == brute_kept([(i, texts[i]) for i in sorted(good)])
    leaks = {r["doc_id"] for r in decontamination.find_leaks(two, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    three = stages["benchmark_decontamination"](spark, two, SF)
    assert {r["doc_id"] for r in three.collect()} == set(kept) - leaks
    four = stages["source_mixing"](spark, three, SF)
    copies = Counter(r["doc_id"] for r in four.collect())
    assert copies.keys() == set(kept) - leaks and max(copies.values()) <= 2 and four.columns == frame.columns
    got = corpus_pipeline.run(spark, SF).select("doc_id", "n_tokens", "ids_crc32").collect()
    want = {i: (len(x := brute_ids(texts[i])), zlib.crc32(np.array(x, "<u4").tobytes())) for i in copies}
    assert Counter(r["doc_id"] for r in got) == copies and all((r["n_tokens"], r["ids_crc32"]) == want[r["doc_id"]] for r in got)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_on_edges(spark, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    assert stage(spark, empty(spark), SF).count() == 0
    out = stage(spark, docs(spark), SF)
    if name != "token_files":
        assert out.columns == docs(spark).columns
    n = out.count()
    assert n == 0 if name == "quality_rules" else n >= len(TEXTS) - 5 if name == "simhash_near_dedup" else n >= len(TEXTS)


def test_rules_without_stop_words_keep_other_languages(spark):
    text = " ".join(f"slovo{i} jiné" for i in range(60))
    rules = tuple(r for r in quality_rules.RULES if r.name != "stop_words")
    assert quality_rules.keep_good(docs(spark, [(1, text)])).count() == 0
    assert quality_rules.keep_good(docs(spark, [(1, text)]), rules).count() == 1
