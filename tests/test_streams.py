"""Streams in several batches: late rows, evicted state, idle and very long sessions."""

import random
import time

import pytest
from pyspark.sql import functions as F

from sievework.streaming import streams as st

DAY = 86_400


@pytest.fixture
def rocksdb(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, st.STATE_PROVIDER)
    yield
    spark.conf.set(key, before)


def source(spark, path, schema, *batches):
    """A file stream with one file for each batch, in their order."""
    for k, rows in enumerate(batches):
        df = spark.createDataFrame(rows, schema).withColumn("ts", F.timestamp_seconds(F.col("ts") + 100 * DAY))
        df.coalesce(1).write.mode("append").parquet(f"{path}/{k}")
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{path}/*")


def ran(frame, tmp, mode="append"):
    got = []
    q = frame.writeStream.outputMode(mode).option("checkpointLocation", f"{tmp}/check").trigger(availableNow=True).foreachBatch(lambda b, i: got.extend((i, *r) for r in b.collect())).start()
    q.awaitTermination()
    return got, q.recentProgress


def test_keys_are_forgotten_behind_the_watermark_and_late_rows_kept(spark, tmp_path):
    batches = [[("a", 0, "one"), ("b", 0, "one"), ("a", 10, "one")], [("c", 10 * DAY, "two"), ("a", 10 * DAY, "still known")], [("d", 10 * DAY + 1, "three")]]
    batches += [[("b", 5, "late"), ("e", 9 * DAY + DAY // 2, "four"), ("c", 10 * DAY + 5, "known"), ("a", 10 * DAY + 2, "four")]]
    stream = lambda: source_of(spark, tmp_path)
    source(spark, f"{tmp_path}/in", "key string, ts long, note string", *batches)
    got, progress = ran(st.first_by_key(stream(), ["key"], "ts", "1 day").select("key", "note"), f"{tmp_path}/dedup")
    assert sorted((k, n) for _, k, n in got) == [("a", "four"), ("a", "one"), ("b", "one"), ("c", "two"), ("d", "three"), ("e", "four")]
    state = [p["stateOperators"][0] for p in progress]
    assert sum(s["numRowsDroppedByWatermark"] for s in state) == 1 and sum(s["numRowsRemoved"] for s in state) >= 2 and max(s["numRowsTotal"] for s in state) <= 4
    st.late_rows(stream(), "ts", "1 day", f"{tmp_path}/late", f"{tmp_path}/late-check").awaitTermination()
    late = spark.read.schema("key string, ts timestamp, note string, batch long").parquet(f"{tmp_path}/late").collect()
    assert [(r["key"], r["note"], r["batch"]) for r in late] == [("b", "late", 3)]


def source_of(spark, tmp):
    return spark.readStream.schema("key string, ts timestamp, note string").option("maxFilesPerTrigger", 1).parquet(f"{tmp}/in/*")


ACTION = "session_id long, turn long, action string, status string, added int, ts long"


def test_idle_sessions_end_and_begin_anew(spark, tmp_path, rocksdb):
    act = lambda s, turn, ts, status="error": (s, turn, "plan", status, 0, ts)
    batches = [[act(1, 1, 0), act(1, 2, 10), act(2, 1, 5)], [act(2, 2, 20 * DAY)], [act(2, 3, 40 * DAY)], [act(1, 3, 41 * DAY)]]
    stream = source(spark, f"{tmp_path}/in", ACTION, *batches)
    got, progress = ran(st.guardrails(stream, delay="1 hour", idle_ms=30 * DAY * 1000), tmp_path)
    rows = sorted(r[1:] for r in got)
    assert rows == sorted([(1, 1, 1, False, False), (1, 2, 2, False, False), (1, 2, 2, False, True), (1, 3, 1, False, False), (2, 1, 1, False, False), (2, 2, 2, False, False), (2, 3, 3, False, False)])


def test_a_session_larger_than_an_arrow_batch(spark, tmp_path, rocksdb):
    n = 25_000
    rows = [(7, k, "generate_data" if k % 3 else "plan", "error" if k % 5 else "success", 1, k) for k in range(n)]
    random.Random(1).shuffle(rows)
    got, _ = ran(st.guardrails(source(spark, f"{tmp_path}/in", ACTION, rows[:20_000], rows[20_000:]), delay="30 days"), tmp_path)
    first = sorted(r[1:] for r in got if r[0] == 0)
    turns = sorted(r[1] for r in rows[:20_000])
    assert [r[1] for r in first] == turns and len(got) == n
    failures, want = 0, []
    for k in turns:
        failures = failures + 1 if k % 5 else 0
        want.append(failures)
    assert [r[2] for r in first] == want


def test_state_goes_by_the_clock(spark, tmp_path, rocksdb):
    """With a time to live every trigger has a batch, so the query is stopped when both files are done."""
    frame = st.guardrails(source(spark, f"{tmp_path}/in", ACTION, [(1, 1, "plan", "error", 0, 0)], [(1, 2, "plan", "error", 0, 1)]), ttl_ms=3_600_000)
    got = []
    q = frame.writeStream.option("checkpointLocation", f"{tmp_path}/check").trigger(processingTime="1 second").foreachBatch(lambda b, i: got.extend(b.collect())).start()
    end = time.time() + 60
    while len(got) < 2 and time.time() < end:
        time.sleep(0.5)
    q.stop()
    assert sorted(tuple(r)[:3] for r in got) == [(1, 1, 1), (1, 2, 2)]
