"""Operator 13 against plain counting, and its edges."""

import re
from collections import Counter

import pytest
from edge import TEXTS, docs, empty

from sievework.llm import phrase_mining as pm


def brute(rows, max_words=3, least=10, share=50, top=2000):
    """rows of (text, lang) -> the operator's rows."""
    f, n = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        counts = f.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, max_words + 1):
                counts.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        held = Counter()
        for q, a in cand.items():
            for k in range(2, len(q)):
                for i in range(len(q) - k + 1):
                    held[q[i : i + k]] = max(held[q[i : i + k]], a)
        scored = []
        for p, a in cand.items():
            if held[p] and 100 * held[p] >= share * a:
                continue
            score, k = min((1000000 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(scored)[:top])]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(t, lang, 1, "x") for t, lang in rows], "text string, lang string, n long, phrase string")


ROWS = [
    ("New York City is big. New York is a city, new york; New\tYork! of the new", "en"),
    ("a a a a a a a. b a a b a a b", "en"),
    ("In\nthe end: in the end in  the end", None),
    ("in the end", "und"),
    ("ÉTÉ été Été été, ÉTÉ été", "fr"),
    (None, "fr"),
    ("", None),
    ("the of the of the of the of the of", "en"),
] * 7


@pytest.mark.parametrize("how", [{}, {"broadcast_rows": 0}, {"max_words": 4, "least": 3}, {"max_words": 2}, {"top": 2}, {"least": 1, "max_words": 5}])
def test_rows_are_those_of_plain_counting(spark, how, monkeypatch):
    monkeypatch.setattr(pm, "BLOCK_BYTES", 200)
    got = sorted(tuple(r) for r in pm.collocations(frame(spark, ROWS), **how).collect())
    assert got == brute(ROWS, **{k: v for k, v in how.items() if k != "broadcast_rows"})


def test_blocks_hold_whole_texts_of_one_language(spark):
    level = frame(spark, ROWS).repartition(3).select("lang", "text").where("lang IS NOT NULL")
    rows = level.mapInArrow(pm._blocks, pm._OCCURRENCES).collect()
    assert len({r["block"] for r in rows}) == len(rows) and sum(sum(r["counts"]) for r in rows) == sum(r["n_words"] for r in rows)


def test_products_beyond_64_bits(spark):
    f = 4_000_000_000_000
    row = spark.createDataFrame([(f, [f + 1, f], [f + 3, f])], "f long, pre array<long>, suf array<long>").selectExpr(f"{pm._CUT}.score AS s").first()
    assert row["s"] == 1000000 * f * f // ((f + 1) * (f + 3))


def test_edges(spark):
    assert pm.collocations(empty(spark)).count() == 0
    rows = [(t, "en") for _, t in TEXTS]
    assert sorted(tuple(r) for r in pm.collocations(docs(spark)).collect()) == brute(rows)
    assert pm.collocations(frame(spark, [(None, None), ("one", "en"), ("...", "fr")])).count() == 0


def test_phrases_of_a_block_are_not_joined_with_their_groups(spark, monkeypatch):
    monkeypatch.setattr(pm, "BLOCK_BYTES", 200)
    rows, kind, seen = frame(spark, ROWS), type(spark.range(0)), []
    join = kind.join
    monkeypatch.setattr(kind, "join", lambda self, other, on=None, *how: seen.append(on) or join(self, other, on, *how))
    found, _ = pm.frequent_phrases(rows, max_words=4, least=3)
    assert seen and ["left", "right"] not in seen
    for g in found:
        assert len({r["id"] for r in g.collect()}) == g.count() > 0


def test_places_of_frequent_candidates_stay(spark):
    n = {(1, 2): [6, 4], (2, 1): [9], (1, 3): [10], (2, 3): [1] * 10, (3, 2): [3, 3, 3]}
    rows = [(block, 10 * left + right, left, right, c) for (left, right), counts in n.items() for block, c in enumerate(counts)]
    got = pm._frequent_places(spark.createDataFrame(rows, pm._CANDIDATES).repartition(5), 10, "places").collect()
    assert sorted((r["block"], r["place"], r["left"], r["right"], r["f"]) for r in got) == sorted((*r[:4], 10) for r in rows if sum(n[r[2:4]]) >= 10)
    assert {(r["left"], r["right"]) for r in got if r["first"]} == {(1, 2), (1, 3), (2, 3)} and sum(r["first"] for r in got) == len({r["id"] for r in got}) == 3
