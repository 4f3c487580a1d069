"""Operator 11 against a plain search for runs."""

import hashlib
import re
import zlib

import duckdb
import numpy as np
import pytest
from edge import LONG, TEXTS, docs, empty
from hypothesis import given, settings
from hypothesis import strategies as st

from sievework.llm import periodic_runs as pr

SF = "/root/testdata/sf0.001"


def brute_runs(words, exponent=4, least=6):
    """Every maximal stretch by period, periods that a divisor explains left out."""
    x = np.unique(np.array(words, dtype=object), return_inverse=True)[1] if len(words) else np.zeros(0, int)
    out = []
    for q in range(1, len(x) // exponent + 1):
        start, n = pr._stretches(x[:-q] == x[q:])
        for s, m in zip(start.tolist(), n.tolist(), strict=True):
            if m + q < max(least, exponent * q):
                continue
            w = x[s : s + 2 * q]
            if not any(q % d == 0 and np.array_equal(w[:-d], w[d:]) for d in range(1, q)):
                out.append((s, m + q, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def planted(doc_id, text):
    words = words_of(text)
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 or not n or doc_id is None:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def row(doc_id, text):
    words = planted(doc_id, text)
    runs = brute_runs(words)
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    top = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *top, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(collapsed(words, runs)))


def found(spark, rows):
    got = pr.periodic_runs(docs(spark, rows)).collect()
    return sorted(((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in got), key=repr)


def expected(rows):
    return sorted(((i, len(w), brute_runs(w), collapsed(w, brute_runs(w))) for i, t in rows for w in [words_of(t)]), key=repr)


def periodic_texts(seed, n=60):
    """Texts of few words with periods of many sizes, nested, touching and cut short."""
    rng = np.random.default_rng(seed)
    for k in range(n):
        parts = []
        for _ in range(rng.integers(1, 5)):
            root = rng.integers(0, rng.integers(1, 6), rng.integers(1, 40))
            if rng.random() < 0.4:
                root = np.concatenate([np.tile(root[: rng.integers(1, 5)], rng.integers(3, 8)), root])
            total = int(len(root) * rng.uniform(2, 9))
            parts.append(np.resize(root, total))
            parts.append(rng.integers(0, 9, rng.integers(0, 9)))
        yield k, " ".join(f"w{i}" for i in np.concatenate(parts))


@pytest.mark.parametrize("seed", range(4))
def test_runs_are_those_of_a_plain_search(spark, seed):
    rows = list(periodic_texts(seed))
    assert found(spark, rows) == expected(rows)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=20), st.integers(1, 9)), max_size=6))
def test_kernel_on_any_sequence(parts):
    x = np.array([v for root, times in parts for v in root * times], np.int64)
    got = sorted((a, b - a, q) for a, b, q in pr.find_runs(x, len(x)).tolist() if b - a >= 6)
    assert got == sorted(brute_runs(x.tolist()))


def test_run_extents_are_right_even_if_every_hash_were_wrong(monkeypatch):
    x = np.tile(np.arange(5), 40)
    x[150:] = 9
    monkeypatch.setattr(pr._Prefixes, "_most", lambda self, limit, holds: limit)
    assert (0, 150, 5) in {(a, b, q) for a, b, q in pr.find_runs(x, len(x)).tolist()}


def test_long_periods_and_long_texts(spark):
    rng = np.random.default_rng(7)
    root = [f"w{i}" for i in rng.integers(0, 5000, 3000)]
    rows = [(1, " ".join(root * 5 + root[:1000])), (2, LONG), (3, "a " * 50_000), (4, " ".join(root * 3))]
    got = found(spark, rows)
    assert got[0][2] == [(0, 16_000, 3000)] and got[0][3] == " ".join(root)
    assert got[2][2] == [(0, 50_000, 1)] and got[2][3] == "a"
    assert got[3][2] == []
    assert got[1][2] == brute_runs(words_of(LONG))


def test_edges(spark):
    assert pr.periodic_runs(empty(spark)).count() == 0
    assert found(spark, TEXTS) == expected(TEXTS)
    with pytest.raises(ValueError):
        pr.periodic_runs(docs(spark), min_exponent=3)


def test_runs_never_cross_texts(spark):
    rows = [(i, "a b c a") for i in range(50)]
    assert all(r[2] == [] for r in found(spark, rows))


def test_query_is_brute_force(spark):
    rows = duckdb.execute(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    got = [tuple(r) for r in pr.op11_periodic_runs(spark, SF).collect()]
    assert sorted(got) == sorted(row(i, t) for i, t in rows)
    assert sum(r[1] for r in got) > 10


def test_planted_texts_on_edges(spark, tmp_path):
    docs(spark).write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in pr.op11_periodic_runs(spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == sorted((row(i, t) for i, t in TEXTS), key=repr)
