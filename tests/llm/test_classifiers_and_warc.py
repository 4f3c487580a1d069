"""Operators 5, 7 and 9, and the pipeline."""

import base64
import gzip
import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import xxhash
from edge import TEXTS, docs, empty
from pyarrow import fs
from pyspark.sql import functions as F

from sievework.llm import linear as li
from sievework.llm import quality_classifier as q
from sievework.llm import textkernels as tk
from sievework.llm import toxicity as x
from sievework.llm import warc_derivatives as w
from sievework.llm.common import work_dir

DATA = "/root/testdata/sf0.01"


def auc(score, y):
    order = np.argsort(score)
    rank = np.empty(len(score))
    rank[order] = np.arange(len(score))
    p = y == 1
    return (rank[p].mean() - (p.sum() - 1) / 2) / (~p).sum()


def test_quality_on_held_out_labels(spark):
    got = q.op5_quality_classifier(spark, DATA).join(spark.read.parquet(f"{DATA}/labels.parquet"), "doc_id").toPandas()
    assert (got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0) == got.held_out).all()
    held = got[got.held_out]
    assert auc(held.score.values, held.quality.values) > 0.95
    assert (held[held.quality == 1].predicted == 1).all()


def test_toxicity_catches_and_leaves(spark):
    got = x.op9_toxicity(spark, DATA).withColumnRenamed("toxic", "found").join(spark.read.parquet(f"{DATA}/labels.parquet"), "doc_id").toPandas()
    assert auc(got.score.values, got.toxic.values) > 0.95
    assert got[got.toxic == 1].found.mean() > 0.8 and got[got.toxic == 0].found.mean() < 0.06


def test_scores_do_not_need_labels_or_texts(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    scored = q.score_quality(docs(spark), q.train_quality(docs(spark), labels))
    assert scored.count() == len(TEXTS) and {r["score"] for r in scored.collect()} == {0.5}
    models = x.train_chain(docs(spark), labels)
    assert x.score_chain(docs(spark), models).count() == len(TEXTS)
    some = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (5, 0, 1), (6, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    assert x.score_chain(empty(spark), x.train_chain(docs(spark), some)).count() == 0
    assert q.score_quality(empty(spark), q.train_quality(docs(spark), some)).count() == 0


def test_ftrl_separates_and_is_sparse():
    r = random.Random(0)
    rows, y = [], []
    for _ in range(400):
        label = r.random() < 0.5
        slots = np.unique([7 if label else 8, *[r.randrange(100, 5000) for _ in range(20)]])
        rows.append((np.append(slots, li.DIMS), np.ones(len(slots) + 1)))
        y.append(float(label))
    weights = li.Ftrl(alpha=0.3, l1=2.0).fit(rows, np.array(y), 5)
    assert weights[7] > 0.5 > -0.5 > weights[8] and np.count_nonzero(weights) < 1500


def test_sample_is_bounded(spark):
    labels = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    sample, shards = li.labelled_sample(labels.select("doc_id", F.lit("t").alias("text")), labels, {"quality": F.col("quality")}, 500)
    assert 350 < sample.count() < 650 and shards == 1


PAGES = [
    (1, "http://a.example/", '<html lang="en"><head><title>A &amp; B</title><script>x("</p>")</script><style>p{}</style></head><body><!-- no --><p>One<br>two &lt;b&gt;</p><a href="/x?a=1&amp;b=2">link</a></body></html>'),
    (2, None, None),
    (3, "http://b.example/é", ""),
    (3, "http://b.example/é", ""),
    (None, "http://c.example/", "plain é"),
]


def pages(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, headers string, block string")


def test_warc_records(spark):
    source = w.responses(pages(spark))
    got = w.derive(source).collect()
    assert len(got) == 2 * len(PAGES)
    parents = {r["record_id"]: r for r in source.collect()}
    for r in got:
        parent = parents[r["refers_to"]]
        sha = lambda s: "sha1:" + base64.b32encode(hashlib.sha1(s.encode()).digest()).decode()
        assert r["block_digest"] == sha(r["block"]) and r["source_digest"] == sha(parent["body"]) == parent["payload_digest"]
        head = dict(line.split(": ", 1) for line in r["headers"].split("\r\n")[1:-1])
        assert head["WARC-Refers-To"] == parent["record_id"] and head["WARC-Target-URI"] == parent["uri"]
        assert head["WARC-Block-Digest"] == r["block_digest"] and int(head["Content-Length"]) == len(r["block"].encode())
    first = {r["record_type"]: r for r in got if r["id"] == 1}
    assert first["conversion"]["block"] == "A & B\nOne\ntwo <b>\nlink"
    meta = first["metadata"]["block"]
    assert "title: A & B\r\n" in meta and "outlink: /x?a=1&b=2\r\n" in meta and "languages-html: en" in meta and "source-http: HTTP/1.1 200 OK" in meta
    assert first["conversion"]["record_id"] in first["metadata"]["headers"]
    assert w.derive(w.responses(pages(spark, []))).count() == 0


def test_warc_files_round_trip(spark):
    path = work_dir(spark, "warc")
    records = w.derive(w.responses(pages(spark)))
    files = [r for r in w.write_warc(records, path).collect() if r["n_records"]]
    store, _ = fs.FileSystem.from_uri(path)
    text = "".join(gzip.decompress(store.open_input_stream(f["file"], compression=None).read()).decode() for f in files)
    assert sorted(re.findall(r"WARC-Record-ID: (\S+)", text)) == sorted(r["record_id"] for r in records.collect())


def test_pipeline_stages(spark, tmp_path):
    sf = DATA
    every = spark.read.parquet(f"{sf}/documents.parquet")
    frames, frame = [every], every
    for name, stage in corpus_pipeline.STAGES:
        out = f"file://{tmp_path}/{name}"
        stage(spark, frame, sf).write.parquet(out)
        frame = spark.read.parquet(out)
        frames.append(frame)
    for f in frames[1:-1]:
        assert f.columns == every.columns
    _, good, single, clean, mixed, tokens = [[r["doc_id"] for r in f.select("doc_id").collect()] for f in frames]
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert not [i for i in good if labels.get(i) == 0]
    texts = {r["doc_id"]: r["text"] for r in every.collect()}
    assert len({texts[i] for i in single}) == len(single) and set(single) <= set(good)
    assert {texts[i] for i in good if texts[i] in {texts[j] for j in good if j < i}}.isdisjoint({texts[i] for i in single if any(texts[j] == texts[i] for j in good if j < i)})
    items = [" ".join(re.findall(r"\w+", r["text"].lower())) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    leaky = {i for i in single if any(k in " ".join(re.findall(r"\w+", texts[i].lower())) for k in items)}
    assert set(single) - set(clean) == leaky
    assert set(mixed) == set(clean) and sorted(tokens) == sorted(mixed)
    assert sorted(map(str, corpus_pipeline.run(spark, sf).collect())) == sorted(map(str, frames[-1].collect()))


def test_warc_files_are_read_back(spark):
    path = work_dir(spark, "responses")
    source = w.responses(pages(spark))
    w.write_warc(w.response_records(source), path).count()
    got = w.read_responses(spark, path)
    same = [c for c in source.columns if c != "id"]
    assert sorted(map(tuple, got.select(same).collect())) == sorted(map(tuple, source.select(same).collect()))
    parts = ["record_type", "record_id", "refers_to", "uri", "block_digest", "source_digest", "headers", "block"]
    assert sorted(map(tuple, w.derive(got).select(parts).collect())) == sorted(map(tuple, w.derive(source).select(parts).collect()))


def test_warc_files_of_others(spark, tmp_path):
    body = "<p>caf\u00e9 &#8217;&#x2019; &#xD800; &amp;#65; &#0; &#65</p>"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=iso-8859-1\r\nX-A: b\r\n\r\n" + body.encode("latin-1")
    head = f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:1>\r\nWARC-Target-URI: <http://a/>\r\nWARC-Date: 2020-01-01T00:00:00Z\r\nContent-Length: {len(http)}\r\n\r\n"
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 3\r\n\r\nx\r\n\r\n\r\n"
    (tmp_path / "a.warc").write_bytes(info + head.encode() + http + b"\r\n\r\n")
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(info) + gzip.compress(head.encode() + http + b"\r\n\r\n"))
    (tmp_path / "cut.warc.gz").write_bytes(gzip.compress(head.encode() + http)[:-20])
    got = w.read_responses(spark, f"file://{tmp_path}")
    rows = got.collect()
    assert len(rows) in (2, 3) and {r["body"] for r in rows[:2]} == {body} and {r["uri"] for r in rows} == {"http://a/"}
    assert {r["payload_digest"] for r in rows} == {"sha1:" + base64.b32encode(hashlib.sha1(body.encode("latin-1")).digest()).decode()}
    derived = {(r["record_type"]): r for r in w.derive(got).collect()}
    assert derived["conversion"]["block"] == "caf\u00e9 \u2019\u2019 &#xD800; &#65; &#0; &#65"
    assert "source-http: X-A: b" in derived["metadata"]["block"] and derived["metadata"]["refers_to"] == "<urn:uuid:1>"


def test_warc_of_a_very_long_page(spark):
    long = "<p>" + "word &amp; " * 200_000 + "</p>" + "<script>" + "x < y;" * 100_000 + "</script>"
    got = {r["record_type"]: r for r in w.derive(w.responses(pages(spark, [(1, "u", long)]))).collect()}
    assert got["conversion"]["block"] == ("word & " * 200_000).strip()


def test_training_does_not_depend_on_arrival(spark):
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    frame = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    again = frame.orderBy(F.desc("doc_id")).repartition(7)
    assert (q.train_quality(frame, labels) == q.train_quality(again.union(again.limit(50)), labels.repartition(5))).all()
    one, two = x.train_chain(frame, labels), x.train_chain(again, labels.repartition(5))
    assert one.keys() == two.keys() and all((one[k] == two[k]).all() for k in one)


def plain_ftrl(rows, y, passes, alpha, beta, l1, l2, seed=7):
    """Follow the regularised leader, one coordinate at a time."""
    z, n = {}, {}

    def weight(i):
        penalty = l1 if i < li.DIMS else 0.0
        zi = z.get(i, 0.0)
        return 0.0 if abs(zi) <= penalty else -np.sign(zi) * (abs(zi) - penalty) / ((beta + np.sqrt(n.get(i, 0.0))) / alpha + l2)

    rng = np.random.default_rng(seed)
    for _ in range(passes):
        for k in rng.permutation(len(rows)).tolist():
            w = {i: weight(i) for i in rows[k][0].tolist()}
            g0 = li.sigmoid(sum(w[i] * v for i, v in zip(*(a.tolist() for a in rows[k]), strict=True))) - y[k]
            for i, v in zip(*(a.tolist() for a in rows[k]), strict=True):
                g = g0 * v
                was = n.get(i, 0.0)
                z[i] = z.get(i, 0.0) + g - (np.sqrt(was + g * g) - np.sqrt(was)) / alpha * w[i]
                n[i] = was + g * g
    return {i: weight(i) for i in z}


def test_ftrl_is_the_plain_algorithm():
    r = np.random.default_rng(3)
    rows = [(np.append(np.unique(r.integers(0, 40, 8)), li.DIMS), None) for _ in range(60)]
    rows = [(i, np.append(r.random(len(i) - 1), 1.0)) for i, _ in rows]
    y = np.array([float(3 in i or 5 in i) for i, _ in rows])
    got = li.Ftrl(alpha=0.3, l1=0.2, l2=0.5).fit(rows, y, 4)
    want = plain_ftrl(rows, y, 4, 0.3, 1.0, 0.2, 0.5)
    assert np.allclose([got[i] for i in want], list(want.values())) and np.count_nonzero(got) == sum(v != 0 for v in want.values())


def test_toxicity_on_rows_it_never_saw(spark):
    large = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{large}/labels.parquet")
    frame = spark.read.parquet(f"{large}/documents.parquet").select("doc_id", "text")
    models = x.train_chain(frame, labels.where(~q.held_out()))
    got = x.score_chain(frame, models).join(labels.where(q.held_out()), "doc_id").toPandas()
    assert auc(got.p_toxic.values, got.toxic.values) > 0.9
    found = got.p_toxic >= models["threshold"][0]
    assert found[got.toxic == 1].mean() > 0.5 and found[got.toxic == 0].mean() < 0.05


def test_held_out_junk_is_told(spark):
    got = q.op5_quality_classifier(spark, DATA).join(spark.read.parquet(f"{DATA}/labels.parquet"), "doc_id").toPandas()
    held = got[got.held_out]
    assert (held[held.quality == 0].predicted == 0).mean() > 0.7


def test_repeated_rows_of_one_label_count_once(spark):
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    rows = spark.createDataFrame([(1, "b")] * 50 + [(1, "a"), (1, None)], "doc_id long, text string")
    sample, _ = li.labelled_sample(rows, labels, {"quality": F.col("quality")}, 100)
    assert [(r["id"], r["text"]) for r in sample.collect()] == [("1", "")]


def test_bad_warc_files_cost_no_other_record(spark, tmp_path):
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n"
    record = lambda k, length=None: b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: " + k + b"\r\nContent-Length: " + (str(len(http + k)).encode() if length is None else length) + b"\r\n\r\n" + http + k + b"\r\n\r\n"
    noise = lambda n: bytes(np.random.default_rng(n).integers(32, 127, n, dtype=np.uint8))
    packed = gzip.compress(record(b"damaged") + noise(500))
    files = {
        "word.warc": record(b"a1") + record(b"bad", b"abc") + record(b"a2"),
        "negative.warc": record(b"b1") + record(b"bad", b"-5") + record(b"b2"),
        "member.warc.gz": gzip.compress(record(b"c1")) + packed[:60] + b"\xff" * 40 + packed[100:] + gzip.compress(record(b"c2")),
        "trailing.warc.gz": gzip.compress(record(b"d1")) + b"\0" * 700 + b"rubbish" + gzip.compress(record(b"d2")) + b"more rubbish",
        "cut.warc.gz": gzip.compress(record(b"e1")) + gzip.compress(record(b"cut"))[:-20],
        "long.warc": record(b"f1") + record(b"x" * 5000) + record(b"f2"),
        "rubbish.warc": noise(200_000) + b"\n" + record(b"g1"),
        "empty.warc": b"",
        "good.warc": record(b"h1"),
    }
    for name, content in files.items():
        (tmp_path / name).write_bytes(content)
    got = w.read_responses(spark, f"file://{tmp_path}", longest=3000)
    want = ["a1", "a2", "b1", "b2", "c1", "c2", "d1", "d2", "e1", "f1", "f2", "g1", "h1"]
    assert sorted(r["id"] for r in got.collect()) == want
    assert w.derive(got).count() == 2 * len(want)
    skipped = {(r["file"].rsplit("/", 1)[1], r["reason"]) for r in w.read_skipped(spark, f"file://{tmp_path}", longest=3000).collect()}
    assert {f for f, _ in skipped} == {"word.warc", "negative.warc", "member.warc.gz", "cut.warc.gz", "long.warc", "rubbish.warc"}


def test_responses_of_pages_go_through_files(spark):
    """The pages of the tables written as WARC files and read back give the derivatives of the query."""
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    path = work_dir(spark, "pages-warc")
    w.write_warc(w.response_records(w.responses(pages)), path).count()
    columns = ["record_type", "record_id", "refers_to", "uri", "block_digest", "source_digest", "headers", "block"]
    got = sorted(tuple(r) for r in w.derive(w.read_responses(spark, path)).select(columns).collect())
    assert got == sorted(tuple(r) for r in w.op7_warc_derivatives(spark, "/root/testdata/sf0.001").select(columns).collect())


FULL = (1 << 64) - 1


def mixed(h):
    h ^= h >> 30
    h = h * 0xBF58476D1CE4E5B9 & FULL
    h ^= h >> 27
    h = h * 0x94D049BB133111EB & FULL
    return h ^ h >> 31


def hashed(word):
    return mixed(sum(int(tk.BYTES[b]) * pow(tk._BASE, j, 1 << 64) for j, b in enumerate(word)) & FULL)


def run_of(hashes):
    h = len(hashes)
    for k, one in enumerate(hashes):
        h = (h ^ one) * int(tk._GRAM[k]) & FULL
        h ^= h >> 29
    return h


def slot_of(h, salt):
    return mixed(h ^ salt * 0x9E3779B97F4A7C15 & FULL) >> 64 - li.BITS


def hash_of_two(i, word):
    """Spark's xxhash64 of an id as text and a word."""
    return int(np.uint64(xxhash.xxh64_intdigest(word, xxhash.xxh64_intdigest(str(i).encode(), 42))).astype(np.int64))


def plain_slots(text):
    """The feature numbers of a text for operator 9, one word at a time."""
    words = [w.lower() for w in re.findall(rb"[A-Za-z0-9\x80-\xff]+", (text or "").encode())]
    hashes = [hashed(w) for w in words]
    found = {slot_of(h, 11) for h in hashes} | {slot_of(run_of(two), 12) for two in zip(hashes, hashes[1:])}
    return sorted(found | {slot_of(hashed(w[:k]), 12 + k) for w in words for k in (4, 5, 6) if len(w) > k})


def plain_chain(rows, labels):
    """The whole chain of operator 9 without Spark: models, threshold and scores by id."""
    chain = [("junk", lambda q, t: q == 0), ("toxic", lambda q, t: t == 1), ("toxic_prose", lambda q, t: t == 1 and q == 1)]
    texts = dict(rows)
    order = {i: hash_of_two(i, b"order") for i, _, _ in labels}
    train = sorted(labels, key=lambda r: (order[r[0]], str(r[0])))
    slots = {i: plain_slots(t) for i, t in rows}
    given = {i: [] for i, _, _ in labels}

    def row(i, earlier):
        n = len(slots[i]) + 1
        return np.array([*slots[i], *range(li.DIMS, li.DIMS + 1 + len(earlier))]), np.array([1.0] * n + [2 * p - 1 for p in earlier])

    def fit(chosen, said):
        data = [row(i, given[i]) for i, _, _ in chosen]
        return plain_ftrl(data, [float(said(q_, t)) for _, q_, t in chosen], li.epochs(len(chosen)), 0.1, 1.0, 1.0, 1.0)

    def p(w, i, earlier):
        at, v = row(i, earlier)
        return li.sigmoid(sum(w.get(a, 0.0) * b for a, b in zip(at.tolist(), v.tolist(), strict=True)))

    models, threshold = [], 1.01
    for name, said in chain:
        models.append(fit(train, said))
        out = {}
        for fold in range(x.FOLDS):
            w = fit([r for r in train if order[r[0]] % x.FOLDS != fold], said)
            out |= {i: p(w, i, given[i]) for i, _, _ in train if order[i] % x.FOLDS == fold}
        if name == "toxic":
            y = np.array([float(said(q_, t)) for _, q_, t in train])
            threshold = x.best_threshold(np.array([out[i] for i, _, _ in train]), y)
        given = {i: [*given[i], out[i]] for i in given}
    scores = {}
    for i in texts:
        got = []
        for w in models:
            got.append(p(w, i, got))
        scores[i] = got
    return threshold, scores


def test_toxicity_is_the_plain_chain(spark):
    """Features, order, folds, chain, threshold and scores of 60 labelled and 20 other short texts."""
    r = random.Random(5)
    bad, junk, plain = ("Scum", "idiots", "wretched", "vermin"), ("xx##", "9912", "lorem"), ("river", "stone", "évening", "window", "carry", "under", "market")
    rows, labels = [(100, None), (101, "")], []
    for i in range(80):
        toxic, low = r.random() < 0.3, r.random() < 0.3
        rows.append((i, " ".join(r.choice(bad if toxic and r.random() < 0.4 else junk if low and r.random() < 0.5 else plain) for _ in range(r.randrange(1, 12)))))
        if i < 60:
            labels.append((i, int(not low), int(toxic)))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    models = x.train_chain(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    threshold, want = plain_chain(rows, labels)
    got = {g["doc_id"]: [g["p_junk"], g["p_toxic"], g["p_toxic_prose"]] for g in x.score_chain(frame, models).collect()}
    assert got.keys() == want.keys() and np.isclose(float(models["threshold"][0]), threshold)
    assert np.allclose([got[i] for i in want], list(want.values()), atol=1e-5)
    assert max(v[1] for v in want.values()) - min(v[1] for v in want.values()) > 0.3


def plain_quality(text):
    """The features of a text for operator 5: numbers and values, one word at a time."""
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    kind = lambda b: b"a" if b > 127 or 97 <= b < 123 else b"A" if 65 <= b < 91 else b"0" if 48 <= b < 58 else bytes([b])
    count = Counter()
    for salt, hashes in ((1, [hashed(w) for w in words]), (3, [hashed(b"".join(k for k, _ in itertools.groupby(map(kind, w)))) for w in words])):
        count.update(slot_of(h, salt) for h in hashes)
        count.update(slot_of(run_of(two), salt + 1) for two in zip(hashes, hashes[1:]))
    threes = Counter(zip(words, words[1:], words[2:]))
    for n in threes.values():
        count[slot_of(mixed(n.bit_length()), 5)] += n
    at = sorted(count)
    v = np.log1p([count[i] for i in at]) if at else np.zeros(0)
    return np.array([*at, li.DIMS]), np.append(v / max(np.sqrt(v @ v), 1e-9), 1.0)


def test_quality_is_the_plain_model(spark, monkeypatch):
    """Features, order, shards, averaged weights and scores of 60 labelled and 22 other short texts."""
    monkeypatch.setattr(li, "SHARD_ROWS", 20)
    r = random.Random(9)
    good, low = ("river", "Stone", "évening", "window", "carry.", "under"), ("BUY!!", "$$$", "click", "9912", "now")
    rows, labels = [(100, None), (101, " \n ")], []
    for i in range(80):
        junk = r.random() < 0.4
        rows.append((i, " ".join(r.choice(low if junk and r.random() < 0.6 else good) for _ in range(r.randrange(0, 14)))))
        if i < 60:
            labels.append((i, int(not junk)))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    weights = q.train_quality(frame, spark.createDataFrame(labels, "doc_id long, quality int"))
    data = {i: plain_quality(t) for i, t in rows}
    shards = [sorted((hash_of_two(i, b"order"), i, y) for i, y in labels if (hash_of_two(i, b"sample") >> 20) % 3 == k) for k in range(3)]
    mean = Counter()
    for part in shards:
        assert part
        for at, w in plain_ftrl([data[i] for _, i, _ in part], [float(y) for _, _, y in part], li.epochs(len(part), 72_000), 0.5, 1.0, 0.05, 0.1).items():
            mean[at] += w / 3
    assert np.allclose([weights[at] for at in mean], list(mean.values())) and np.count_nonzero(weights) <= len(mean)
    got = {g["doc_id"]: g["score"] for g in q.score_quality(frame, weights).collect()}
    want = {i: li.sigmoid(sum(mean[a] * b for a, b in zip(at.tolist(), v.tolist(), strict=True))) for i, (at, v) in data.items()}
    assert got.keys() == want.keys() and np.allclose([got[i] for i in want], list(want.values()), atol=1e-5)
    assert max(want.values()) - min(want.values()) > 0.5
