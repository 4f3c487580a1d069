"""Operators 2 and 3: token files and benchmark decontamination."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  pa.compute
import pytest
from edge import TEXTS, docs, empty
from tokenizers import Tokenizer

from sievework.llm import decontamination as d
from sievework.llm import token_files as t
from sievework.llm.common import work_dir


def brute_ids(text):
    return Tokenizer.from_file(t.default_tokenizer()).encode(text or "", add_special_tokens=False).ids + [0]


def test_piecewise_ids_are_the_tokenizers_ids():
    r = random.Random(3)
    letters = [*"ab .\n\t\r 1'é!\x1c\x0b", "\u00a0", "\u3000", "\u2028", "<|endoftext|>", " ", "Ġ"]
    texts = ["", " ", "\n", "a  b", "a   b", " \n a", "a \n", "it's  'tis\n\n  x", "“a” b…　 c", "a\nb\n", *["".join(r.choice(letters) for _ in range(r.randint(0, 12))) for _ in range(1500)]]
    encoder, got = t.encoder(t.default_tokenizer()), []
    for ids, n in encoder.encode(pa.array(texts), 0):
        got += np.split(ids, np.cumsum(n)[:-1])
    whole = Tokenizer.from_file(t.default_tokenizer())
    for x, ids in zip(texts, got, strict=True):
        assert ids.tolist() == whole.encode(x, add_special_tokens=False).ids + [0], repr(x)


def test_forgetting_pieces_changes_nothing(monkeypatch):
    monkeypatch.setattr(t, "MOST_PIECES", 50)
    encoder = t.PieceEncoder(t.default_tokenizer())
    for k in range(4):
        x = " ".join(f"w{i * (k + 1) % 90}" for i in range(60))
        (ids, _), = encoder.encode(pa.array([x]), 0)
        assert ids.tolist() == brute_ids(x)


def test_memory_of_pieces_is_bounded(monkeypatch):
    monkeypatch.setattr(t, "POOL_BYTES", 40_000)
    monkeypatch.setattr(t, "MOST_PIECES", 3000)
    encoder = t.PieceEncoder(t.default_tokenizer())
    for k in range(60):  # indented and CRLF texts, no two alike, and long runs without a blank
        texts = [f"def f{k}_{i}():\r\n    return  {k * i}\r\n\tx{i}  =  'a{k}'\n\n" + "z" * (90 + i) for i in range(40)]
        for ids, n in encoder.encode(pa.array(texts), 0):
            pass
        assert encoder.held_bytes() <= 40_000 + 40 * 400 and len(encoder.rows) <= 3000
        assert max(encoder.lengths.view(), default=0) <= t.LONGEST_PIECE
    assert np.split(ids, np.cumsum(n)[:-1])[-1].tolist() == brute_ids(texts[-1])


def test_equal_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(t.tk, "word_hashes", lambda data, starts, ends, table=None: (ends - starts).astype(np.uint64) % np.uint64(3))
    encoder = t.PieceEncoder(t.default_tokenizer())
    for x in ("one two six ten", "abc de fgh", "two one abc", "one two six ten"):
        (ids, _), = encoder.encode(pa.array([x]), 0)
        assert ids.tolist() == brute_ids(x)


def test_files_round_trip(spark):
    frame, path = docs(spark), work_dir(spark, "tokens")
    manifest = t.write_token_files(frame, path, t.default_tokenizer(), seq_len=64)
    got = sorted(t.read_documents(manifest, path).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted((i for i, _ in TEXTS), key=lambda i: (i is not None, i or 0))
    start = 0
    for r in got:
        assert r["start"] == start
        start += r["n_tokens"]
    want = sorted((i or -1, len(x := brute_ids(text)), zlib.crc32(np.array(x, "<u4").tobytes())) for i, text in TEXTS)
    assert sorted((r["doc_id"] or -1, r["n_tokens"], r["ids_crc32"]) for r in got) == want
    total = 0
    for row in manifest.collect():
        tokens, _ = t.open_tokens(path, row["part"])
        flat = []
        for k in range(tokens.num_rows):
            ids, mask = t.sequence(tokens, k)
            assert len(ids) == 64 and not ids.flags.owndata, "a view of the file"
            assert mask.buffers()[1].address == tokens.column(1).chunk(k // t.ROWS_PER_BATCH).values.buffers()[1].address
            flat.append(ids[mask.to_numpy(zero_copy_only=False)])
        assert sum(map(len, flat)) == row["n_tokens"]
        total += row["n_tokens"]
    assert total == start


def test_token_edges(spark):
    assert t.encode_to_files(empty(spark)).count() == 0


ITEMS = ["alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi", "short one", "", None, "the same words in every item of a set of many words that go on and on without an end in sight today"]


def bench(spark, items=ITEMS):
    return spark.createDataFrame([(i, x) for i, x in enumerate(items)], "item_id long, text string")


def test_leaks_are_found_and_clean_documents_left(spark):
    noise = " ".join(f"n{i}" for i in range(80))
    edited = ITEMS[4].replace("without", "WITHOUT,").replace("sight", "view")
    half = " ".join(ITEMS[0].split()[:8])
    rows = [(1, f"{noise} {ITEMS[0].upper()}! {noise}"), (2, f"{noise} {edited}"), (3, noise), (4, f"x {half} {noise}"), (5, f"a very short one here {noise}"), (6, ITEMS[4])]
    found = d.find_leaks(docs(spark, rows), bench(spark)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(1, 0), (2, 4), (5, 1), (6, 4)}
    assert all(r["similarity"] >= 0.8 for r in found)
    assert next(r["start_word"] for r in found if r["doc_id"] == 1) == 80
    kept = d.drop_leaks(docs(spark, rows), bench(spark))
    assert {r["doc_id"] for r in kept.collect()} == {3, 4} and kept.columns == docs(spark).columns


def test_leaks_in_blocks_of_the_benchmark(spark, monkeypatch):
    rows = [(i, f"pre {x} post") for i, x in enumerate(ITEMS)]
    whole = {tuple(r) for r in d.find_leaks(docs(spark, rows), bench(spark)).select("doc_id", "item_id").collect()}
    monkeypatch.setattr(d, "BLOCK_CHARS", 10)
    assert {tuple(r) for r in d.find_leaks(docs(spark, rows), bench(spark)).select("doc_id", "item_id").collect()} == whole
    assert {(0, 0), (1, 1), (4, 4)} <= whole


def test_blocks_find_all_within_the_radius():
    r = random.Random(1)
    index = d.BenchmarkIndex(list(range(30)), [" ".join(f"{k}x{i}" for i in range(20)) for k in range(30)])
    prints = np.array([int(p) ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 26))) for p in index.prints for _ in range(20)], np.uint64)
    win, item, apart = index.near_items(20, prints)
    got = {(int(a), int(b)): int(c) for a, b, c in zip(win, item, apart, strict=True)}
    all_ = np.bitwise_count(prints[:, None] ^ index.prints[None, :])
    assert got == {(int(a), int(b)): int(all_[a, b]) for a, b in zip(*np.nonzero(all_ <= d.RADIUS), strict=True)}


def test_leak_edges(spark):
    assert d.find_leaks(empty(spark), bench(spark)).count() == 0
    assert d.find_leaks(docs(spark), bench(spark, [])).count() == 0
    assert d.find_leaks(docs(spark), bench(spark, ["", None])).count() == 0
    assert d.drop_leaks(docs(spark), bench(spark)).count() == len(TEXTS)


def brute_leaks(rows, items, threshold=0.8):
    """All (row, item) with a window of the item's size that holds enough of its weight, whatever the fingerprints."""
    import math
    import re
    from collections import Counter

    split = lambda t: re.findall(r"[0-9a-z\u0080-\U0010ffff]+", pa.compute.utf8_lower(pa.scalar(t or "")).as_py())
    grams = lambda w: Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)])
    known = {k: grams(w) for k, t in items if (w := split(t))}
    df = Counter(g for c in known.values() for g in c)
    weight = lambda g: math.log1p(len(known) / df[g])
    sizes, totals = {k: len(split(t)) for k, t in items}, {k: sum(n * weight(g) for g, n in c.items()) for k, c in known.items()}
    found, whole = {}, {}
    for i, t in rows:
        words = split(t)
        whole[i] = grams(words) + Counter(tuple(words[j : j + m]) for m in range(1, 5) for j in range(len(words) - m + 1))
        for k, c in known.items():
            size, total = sizes[k], totals[k]
            if sum(min(n, whole[i][g]) * weight(g) for g, n in c.items()) < threshold * total:
                continue  # not even the whole document holds enough
            for at in range(max(1, len(words) - size + 1)):
                w = words[at : at + size]
                have = grams(w) if len(w) >= 5 or len(w) == size else Counter()
                sim = sum(min(n, have[g]) * weight(g) for g, n in c.items()) / total
                if sim >= threshold and sim > found.get((i, k), 0):
                    found[i, k] = sim
    return found


@pytest.mark.parametrize("chars", [10**9, 400, 1])
def test_leaks_are_those_of_brute_force_whatever_the_blocks(spark, monkeypatch, chars):
    r = random.Random(8)
    monkeypatch.setattr(d, "BLOCK_CHARS", chars)
    common = [" ".join(r.choices("the cat sat on a mat by an old door of our house".split(), k=9)) for _ in range(4)]
    items = [(k, f"{r.choice(common)} {' '.join(f'i{k}w{j}' for j in range(r.randint(3, 30)))} {r.choice(common)}") for k in range(25)]
    items += [(25, "ΟΔΟΣ ΜΕΓΑΛΗ ΚΑΙ ΣΚΟΤΕΙΝΗ ΣΤΗΝ ΠΟΛΗ ΤΗΣ ΘΕΣΣΑΛΟΝΙΚΗΣ"), (26, "İSTANBUL IŞIK İÇİN ÇOK BÜYÜK BİR ŞEHİR OLARAK BİLİNİR"), (27, items[3][1]), (28, "few words")]
    rows = [(0, items[25][1]), (1, f"pre {items[26][1]} post"), (2, None), (3, ""), (4, "Few, WORDS! and more of them than that")]
    for n in range(60):
        k, w = r.randrange(25), []
        for x in items[k][1].split():
            w += [] if r.random() < 0.02 else [x] if r.random() < 0.98 else ["other"]
        rows.append((10 + n, " ".join([*(f"b{n}x{j}" for j in range(r.randint(0, 20))), *w, "tail"])))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(x["doc_id"], x["item_id"]): x["similarity"] for x in d.find_leaks(df, spark.createDataFrame(items, "item_id long, text string").repartition(3)).collect()}
    want = brute_leaks(rows, items)
    assert got.keys() <= want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in got)
    assert len(got) >= 0.95 * len(want) and {(0, 25), (1, 26), (4, 28)} <= got.keys()
    kept = {x["doc_id"] for x in d.drop_leaks(df, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert kept == {i for i, _ in rows} - {i for i, _ in got}


@pytest.mark.parametrize("kind", ["int", "smallint", "string", "decimal(10,0)", "date"])
def test_item_ids_of_any_type(spark, kind):
    items = spark.range(2).selectExpr(f"cast({'date_add(date \'2020-01-01\', cast(id AS int))' if kind == 'date' else 'id'} AS {kind}) AS item_id", "concat('one passage of words that stands in a benchmark ', id) AS text")
    got = d.find_leaks(docs(spark, [(1, "one passage of words that stands in a benchmark 1")]), items)
    assert dict(got.dtypes)["item_id"] == kind and got.join(items, "item_id").count() == got.count() > 0


def test_items_of_thousands_of_words_take_bounded_memory():
    """An item of 20,000 words in a document that holds it twice and an edited third time."""
    import tracemalloc

    r = random.Random(3)
    item = [f"w{r.randrange(4000)}" for _ in range(20_000)]
    edited = [x if r.random() < 0.97 else "other" for x in item]
    index = d.BenchmarkIndex(["long"], [" ".join(item)])
    text = pa.array([" ".join([*item, *item, "between", *edited])])
    tracemalloc.start()
    found = index.search(text, 0.8)
    peak = tracemalloc.get_traced_memory()[1]
    assert found[0][:3] == (0, 0, 0) and found[0][5] == 1.0 and peak < 300e6
    assert index.search(pa.array([" ".join(["x", *edited])]), 0.8)[0][5] > 0.8
    assert index.search(pa.array([" ".join(item[:19_000])]), 0.999) == []


def test_prints_of_windows_are_those_of_each_window_alone(monkeypatch):
    monkeypatch.setattr(d, "STRETCH", 7)
    grams = np.random.default_rng(2).integers(0, 1 << 63, 60, dtype=np.uint64)
    starts = np.array([0, 1, 5, 6, 20, 21, 50])
    mixed = np.unpackbits(d.tk.mix(grams.copy()).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    want = [np.packbits(2 * mixed[s : s + 9].sum(0, dtype=int) > 9, bitorder="little").view("<u8")[0] for s in starts]
    assert d.prints(grams, starts, 9).tolist() == want
