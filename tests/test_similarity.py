"""The similarity join against brute force, and what it shuffles."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyarrow import fs

from sievework.operators import dedup as dd
from sievework.operators import similarity as sim

TEXTS = "example_id long, pos long, task_id string, text string, tools array<string>"


def common_words(n, seed=0):
    """Long texts of the same few words, every tenth a near copy of the one before."""
    r, out = random.Random(seed), []
    for i in range(n):
        words = [*out[-1][3].split()[:-2], "other", "end"] if i % 10 == 9 else r.choices([f"w{k}" for k in range(400)], k=90)
        out.append((i, n - i if i % 2 else i, "t", " ".join(words), ["a"] if i % 20 < 10 else ["a", "b"]))
    return out


def brute(vectors, threshold):
    by = {}
    for x in vectors.collect():
        by.setdefault(x["task_id"], {}).setdefault(x["example_id"], {})[x["term"]] = x["w"]
    return {(a, b): c for docs in by.values() for a in docs for b in docs if a < b and (c := sum(w * docs[b].get(t, 0) for t, w in docs[a].items())) >= threshold - 1e-9}


def shuffled(spark):
    return spark.sparkContext._jsc.sc().statusStore().executorList(True).apply(0).totalShuffleWrite()


@pytest.mark.parametrize("threshold", [0.85, 0.3])
def test_a_common_word_is_not_shuffled_by_pair(spark, threshold):
    rows = spark.createDataFrame(common_words(400), TEXTS)
    before = shuffled(spark)
    got = {(x["a"], x["b"]): x["cosine"] for x in dd.duplicate_pairs(rows, threshold, 0.8).collect()}
    made = shuffled(spark) - before
    want = {p: c for p, c in brute(dd.tfidf_vectors(rows), threshold).items() if p[0] % 20 // 10 == p[1] % 20 // 10}
    assert got.keys() == want.keys() and len(want) >= 40 and all(abs(got[p] - want[p]) < 1e-9 for p in want)
    assert made < 2_000_000


def test_pairs_of_any_tools(spark):
    rows = spark.createDataFrame(common_words(60), TEXTS)
    got = {(x["a"], x["b"]) for x in dd.duplicate_pairs(rows, 0.3, None).collect()}
    assert got == set(brute(dd.tfidf_vectors(rows), 0.3)) and any(a % 20 // 10 != b % 20 // 10 for a, b in got)


ODD = ["", " ", None, "a b c", "Ünï_9 ÜNÏ_9 ñ ññ", "x1 X1 x1", "ΣΑΣ σας", "中文 字", "tab\tnew\nline,dash-dash", "٣٤ ٣ ½½ _ __", "İstanbul istanbul", "the the word", "áb́ e—f gh", "word other word"]


@pytest.mark.parametrize("how", [{}, {"max_features": 3}, {"stop_words": "english"}, {"stop_words": ("x1", "word")}])
def test_rows_are_the_vectors(spark, how):
    rows = spark.createDataFrame([(i, i, f"t{i % 2}", x, []) for i, x in enumerate(ODD)] + [(90, 90, "one", "alone here", []), (91, 91, None, "no task", [])], TEXTS)
    got, want = {}, {}
    for x in sim.term_rows(rows, rows, **how).collect():
        got[x["task_id"], x["example_id"]] = sorted(x["w"])
    for x in dd.tfidf_vectors(rows, **how).collect():
        want.setdefault((x["task_id"], x["example_id"]), []).append(x["w"])
    assert got.keys() == want.keys() and want
    for k, w in want.items():
        assert np.allclose(got[k], sorted(w), rtol=1e-12)


def block(path, rows, threshold):
    """A block of (weights by term, tool set) as ``packed`` writes it."""
    need = [next(k + 1 for k, s in enumerate(np.cumsum(sorted((x * x for x in w.values()), reverse=True))) if s >= (threshold - 1e-9) ** 2 - 1e-6) for w, _ in rows]
    batch = pa.RecordBatch.from_pydict({
        "example_id": pa.array(range(len(rows)), pa.int64()), "pos": pa.array(range(len(rows)), pa.int64()), "tools": pa.array([t for _, t in rows], pa.list_(pa.string())),
        "no": pa.array([sorted(w) for w, _ in rows], pa.list_(pa.int32())), "w": pa.array([[w[k] for k in sorted(w)] for w, _ in rows], pa.list_(pa.float64())), "need": pa.array(need, pa.int32())})
    with pa.OSFile(str(path), "wb") as sink, pa.ipc.new_file(sink, batch.schema) as file:
        file.write_batch(batch)
    return sim._Block(fs.LocalFileSystem(), str(path))


@pytest.mark.parametrize("limits", [{}, {"COLUMNS": 4}, {"COLUMNS": 4, "LOOKUP": 10**9}, {"LOOKUP": 10**9, "TILE": 7}, {"LOOKUP": 0, "ENTRIES": 50}, {"LOOKUP": 10**9, "SLACK": 2.0}])
def test_every_way_through_a_unit(tmp_path, monkeypatch, limits):
    for k, v in limits.items():
        monkeypatch.setattr(sim, k, v)
    r = np.random.default_rng(1)

    def some(n):
        out = []
        for _ in range(n):
            terms = r.choice(900, r.integers(1, 30), replace=False) if r.random() < 0.3 else r.choice(12, r.integers(1, 12), replace=False)
            w = r.random(len(terms)) + 0.01
            w /= np.sqrt((w * w).sum())
            out.append((dict(zip(terms.tolist(), w.tolist(), strict=True)), [["a"], ["a", "b"], [], None][r.integers(4)]))
        return out

    one, two = some(60), some(45)
    like = lambda p, q: p is not None and q is not None and p == q
    dot = lambda p, q: sum(w * q.get(t, 0.0) for t, w in p.items())
    x, y = block(tmp_path / "x", one, 0.5), block(tmp_path / "y", two, 0.5)
    for other, rows in ((x, one), (y, two)):
        for least in (None, 0.8):
            want = {(i, j): c for i, (p, s) in enumerate(one) for j, (q, u) in enumerate(rows) if (other is y or i < j) and (least is None or like(s, u)) and (c := dot(p, q)) >= 0.5 - 1e-9}
            found = [z for i, j, c in sim._near(x, other, 0.5, least, True) for z in zip(i.tolist(), j.tolist(), c.tolist(), strict=True)]
            assert {(i, j) for i, j, _ in found} == set(want) and len(found) == len(want) > 10
            assert all(abs(c - want[i, j]) < 1e-12 for i, j, c in found)
            assert {p for i, j, _ in sim._near(x, other, 0.5, least, False) for p in zip(i.tolist(), j.tolist(), strict=True)} == set(want)


@pytest.mark.parametrize("links", [0, 1, 100])
def test_rounds_of_leaders(spark, monkeypatch, links):
    """Chains and groups; with few links allowed, leaders come in rounds."""
    monkeypatch.setattr(dd, "LINKS", links)
    r, rows = random.Random(links), []
    words = [f"w{k}" for k in range(200)]
    for g in range(6):
        text = r.choices(words, k=30)
        for _ in range(25):
            text = [*text]
            text[r.randrange(30)] = r.choice(words)
            rows.append((len(rows), r.randrange(40), f"t{g % 2}", " ".join(text), ["a"] if r.random() < 0.8 else ["b"]))
    df = spark.createDataFrame(rows, TEXTS)
    pairs = dd.duplicate_pairs(df, 0.8)
    want = {tuple(x) for x in dd.leader_clusters(dd.fold_copies(df)[0], pairs).collect()}
    rounds, first = [], sim.first_links
    monkeypatch.setattr(sim, "first_links", lambda *a: (rounds.append(1), first(*a))[1])
    assert {tuple(x) for x in dd.leader_scan(df, 0.8, budget=0).collect()} == want
    assert len({x for _, x in want}) < len(want) and (len(rounds) > 1) == (links < 100)


def test_rows_without_links_take_one_round(spark):
    rows = spark.createDataFrame([x for x in common_words(600) if x[0] % 10 != 9], TEXTS)
    spark.sparkContext.setJobGroup("one-round", "")
    assert dd.leader_scan(rows, budget=0).where("example_id <> leader").isEmpty()
    made = len(spark.sparkContext.statusTracker().getJobIdsForGroup("one-round"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert made < 60


def test_first_clusters_in_one_round(spark):
    rows = common_words(300)
    spark.sparkContext.setJobGroup("first-clusters", "")
    got = [tuple(x) for x in dd.first_clusters(dd.clusters(spark.createDataFrame(rows, TEXTS), budget=0), k=5).select("cluster", "size", "pos", "members").collect()]
    made = len(spark.sparkContext.statusTracker().getJobIdsForGroup("first-clusters"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    pairs = [min(rows[i - 1 : i + 1], key=lambda x: x[1]) for i in range(9, 300, 10)]
    assert got == [(x[0], 2, x[1], [x[0] // 10 * 10 + 8, x[0] // 10 * 10 + 9]) for x in sorted(pairs, key=lambda x: x[1])[:5]]
    assert made < 120
