"""Operators 4 and 8: SimHash components and long repeats."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from edge import TEXTS, docs, empty

from pyspark.sql import functions as F

from sievework.llm import simhash_dedup as s
from sievework.llm import suffix_dedup as x
from sievework.llm.components import connected_components


def brute_fingerprint(text, size=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h))


def components(codes, radius):
    parent = list(range(len(codes)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(codes)):
        for j in range(i):
            if bin(codes[i] ^ codes[j]).count("1") <= radius:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(codes))]


def test_fingerprints_and_edges(spark):
    rows = [*TEXTS, (30, "A b C d e"), (31, "x\ty  z"), (32, "one two three four")]
    got = s.near_duplicates(docs(spark, rows), ["doc_id"]).collect()
    assert sorted((str(r["doc_id"]), r["fp"] & (1 << 64) - 1) for r in got) == sorted((str(i), brute_fingerprint(t)) for i, t in rows)
    by = {r["doc_id"]: r["component"] for r in got if r["doc_id"] is not None}
    assert by[1] == by[6] == 1 and by[2] == by[3] == by[4] == 2
    assert s.near_duplicates(empty(spark), ["doc_id"]).count() == 0


@pytest.mark.parametrize("share", [1, 3, 1000])
def test_heavy_keys_join_like_any_other(spark, monkeypatch, share):
    from sievework.llm import common

    monkeypatch.setattr(common, "HEAVY_SHARE", share)
    rows = spark.createDataFrame([(i, 0 if i < 20 else i) for i in range(40)], "i long, k long")
    lookup = rows.groupBy("k").count().selectExpr("k", "k + 1 AS v", "count")
    got = common.join_heavy(rows, lookup, "k", "count", 40).collect()
    assert sorted((r["i"], r["v"]) for r in got) == [(i, (0 if i < 20 else i) + 1) for i in range(40)]


def family(n, seed):
    r = random.Random(seed)
    out = []
    for _ in range(n):
        base = r.getrandbits(64)
        out += [base ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 6))) for _ in range(r.randint(1, 12))]
    return sorted(set(out))


@pytest.mark.parametrize("limit", [4096, 8])
def test_links_give_the_components_of_all_pairs(spark, limit):
    codes = family(40, limit)
    frame = spark.createDataFrame([(c - (1 << 64) if c >> 63 else c,) for c in codes], "fp long")
    found = connected_components(s.hamming_links(frame, node_limit=limit)).collect()
    root = {r["node"] & (1 << 64) - 1: r["root"] for r in found}
    want = components(codes, 4)
    got = [root.get(c, c) for c in codes]
    assert len(set(zip(got, want, strict=True))) == len(set(got)) == len(set(want))


def test_local_roots_prune_nothing_that_links():
    codes = np.array(family(120, 5), np.uint64)
    got = s.local_roots(codes, 4)
    want = components([int(c) for c in codes], 4)
    assert len(set(zip(got.tolist(), want, strict=True))) == len(set(want)) == len(set(got.tolist()))


def test_gray_rank_orders_the_gray_sequence():
    i = np.arange(512, dtype=np.uint64)
    assert (s.gray_rank(i ^ (i >> np.uint64(1))) == i).all()


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(200, 200), (301, 300), (300, 301)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 160)}, 300: 300, 301: 300}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_keep_one(spark):
    kept = s.keep_one(docs(spark))
    assert kept.columns == docs(spark).columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(1) == 1 and 6 not in ids and 2 in ids and 3 not in ids and ids.count(None) == 1
    assert s.keep_one(empty(spark)).count() == 0


def jaccard_rows():
    """Documents with near copies at similarities about 0.8, the way that edits of words make them."""
    r = random.Random(5)
    rows = []
    for group in range(12):
        words = [f"w{r.randrange(5000)}" for _ in range(r.choice([30, 120, 400]))]
        for _ in range(6):
            copy = list(words)
            for _ in range(r.randrange(1, max(2, len(words) // 30))):
                copy[r.randrange(len(copy))] = f"x{r.randrange(10**6)}"
            rows.append((len(rows) * 7 % 72, " ".join(copy)))
    return rows


def brute_kept(rows, size=5):
    sets = []
    for _, t in rows:
        w = t.lower().split()
        sets.append({" ".join(w[i : i + size]) for i in range(len(w) - size + 1)})
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 5 * both >= 4 * (len(sets[i]) + len(sets[j]) - both):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    return sorted(min(rows[k][0] for k in range(len(rows)) if group[k] == g) for g in set(group))


@pytest.mark.parametrize("block", [500_000, 300])
def test_keep_one_is_the_join_at_080(spark, block):
    rows = jaccard_rows()
    want = brute_kept(rows)
    assert 12 < len(want) < len(rows)
    assert sorted(r["doc_id"] for r in s.keep_one(docs(spark, rows), block=block).collect()) == want


def set_fingerprint(grams):
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h))


def test_keep_one_takes_its_links_from_the_index(spark, monkeypatch):
    words = [f"w{i * 7919 % 3001}" for i in range(900)]
    rows = [(i, " ".join([*words[: 90 * i], "edit", *words[90 * i :]])) for i in range(5)]
    rows += [(9, " ".join(words[:450] + [f"z{i}" for i in range(450)]))]
    seen = []
    links = s.hamming_links

    def recorded(codes, *a):
        seen.extend(r["fp"] & (1 << 64) - 1 for r in codes.collect())
        return links(codes, *a)

    monkeypatch.setattr(s, "hamming_links", recorded)
    monkeypatch.setattr(s, "_candidates", lambda sets: (spark.createDataFrame([], "a long, b long"),) * 2)
    assert sorted(r["doc_id"] for r in s.keep_one(docs(spark, rows)).collect()) == [0, 9]
    w = [t.split() for _, t in rows]
    assert sorted(seen) == sorted({set_fingerprint({" ".join(x[i : i + 5]) for i in range(len(x) - 4)}) for x in w})


def test_keep_one_checks_the_links_of_the_index(spark):
    rows = jaccard_rows()
    for radius in (1, 16):  # few links, and many below 0.8
        assert sorted(r["doc_id"] for r in s.keep_one(docs(spark, rows), radius=radius).collect()) == brute_kept(rows)


def test_joined_sets_do_not_meet_again(spark):
    one = [(k, root, 5, 0, [1, 2]) for k, root in ((1, 1), (2, 1), (3, 3))]
    sets = spark.createDataFrame(one, "node long, root long, n long, common long, prefix array<long>")
    assert sorted(tuple(r) for r in s._candidates(sets)[0].collect()) == [(1, 3), (2, 3)]


def brute_repeats(rows, match=200):
    raw = [(t or "").encode() for _, t in rows]
    seen = Counter(b[i : i + match] for b in raw for i in range(len(b) - match + 1))
    out = []
    for b in raw:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - match + 1):
            if seen[b[i : i + match]] > 1:
                gone[i : i + match] = True
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out.append((len(b), int(gone.sum()), int((np.diff(np.append(0, gone.astype(int))) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def repeat_rows():
    r = random.Random(2)
    letters = "abcdefghij klmnop éß\n"
    text = lambda n: "".join(r.choice(letters) for _ in range(n))
    shared, line = text(450), text(230)
    rows = [(i, text(r.randint(0, 900))) for i in range(12)]
    rows += [(20, text(100) + shared + text(50)), (21, shared[:260] + text(300) + shared[200:]), (22, shared), (23, line + line), (24, text(90) + line[:199]), (25, line[20:] + text(300))]
    rows += [(30, "a" * 700), (31, "ab" * 300), (32, "a" * 199), (33, "xyz" * 67), (34, shared), (34, shared), (35, None), (36, ""), (None, shared[5:300])]
    rows += [(40 + i, shared[: 230 + 3 * i] + text(40)) for i in range(8)]
    return rows


@pytest.mark.parametrize(("batches", "hot"), [(1, 1 << 20), (None, 1 << 20), (2, 1), (7, 3000), (3, 1000), (3, 8000)])
def test_repeats_match_brute_force(spark, monkeypatch, batches, hot):
    rows = repeat_rows()
    frame = docs(spark, rows)
    ranges = x.repeated_ranges
    monkeypatch.setattr(x, "repeated_ranges", lambda *a: ranges(*a, hot_bytes=hot))
    got = x.remove_repeats(frame, batches).collect()
    assert sorted((r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == brute_repeats(rows)
    for r in got:
        assert hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] and len(r["kept"]) == r["n_bytes"] - r["n_removed"]


def test_levels_merge_geometrically(spark):
    every = x.suffixes(docs(spark, repeat_rows()))
    family_ = x.index_in_batches(every, 7)
    assert [n for n, _ in family_.levels] == [4, 2, 1] and len(family_.matches) == 5
    heads = Counter(bytes(r["head"]) for r in every.collect())
    for _, level in family_.levels:  # in the order of letters, file by file
        for part in level.withColumn("file", F.input_file_name()).groupBy("file").agg(F.collect_list("head").alias("h")).collect():
            assert part["h"] == sorted(part["h"])
    assert {bytes(r["head"]) for r in family_.shared().collect()} >= {h for h, n in heads.items() if n > 1}


def test_ranks_are_those_of_the_letters():
    r = random.Random(4)
    data = bytes(r.choice(b"ab") for _ in range(60)) * 9
    at = np.arange(len(data) - 200)
    rank = x.letter_ranks(np.frombuffer(data, np.uint8), at)
    order = {s: k for k, s in enumerate(sorted({data[i : i + 200] for i in at}))}
    assert rank.tolist() == [order[data[i : i + 200]] for i in at]


def test_repeat_edges(spark):
    assert x.remove_repeats(empty(spark)).count() == 0
    assert x.remove_repeats(docs(spark)).count() == len(TEXTS)


def test_common_shingles_lose_no_pair(spark, monkeypatch):
    import pyarrow as pa

    rows = jaccard_rows()
    h, n = np.unique(np.concatenate([s.shingle_sets(pa.array([t]), 5)[1] for _, t in rows]), return_counts=True)
    known = h[n >= 2][np.argsort(n[n >= 2], kind="stable")]
    monkeypatch.setattr(s, "_common_shingles", lambda texts, size: known)
    assert sorted(r["doc_id"] for r in s.keep_one(docs(spark, rows), block=300).collect()) == brute_kept(rows)
