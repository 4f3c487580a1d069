"""Structured Streaming forms (R01-R04): ingest, running counts, dedup by key, guardrails over an action log."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.query import StreamingQuery

from ..shipping import ship_package
from ..sources.io import EXAMPLE


def ingest_examples(spark: SparkSession, source: str, sink: str, checkpoint: str) -> StreamingQuery:
    """New JSON-lines files to Parquet, each line once; bad lines are left out. Runs until caught up."""
    rows = spark.readStream.schema(f"{EXAMPLE}, _corrupt_record string").option("columnNameOfCorruptRecord", "_corrupt_record").json(source)
    good = rows.where("_corrupt_record IS NULL").drop("_corrupt_record")
    return good.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def task_counts(stream: DataFrame) -> DataFrame:
    """Running counts by task (write in ``update`` or ``complete`` mode)."""
    return stream.groupBy("task_id").agg(F.count("*").alias("n"))


def first_by_key(stream: DataFrame, keys: list[str], ts: str = "ts", delay: str = "1 day") -> DataFrame:
    """The first row of each key; state older than the watermark goes, and so do rows behind it (``late_rows`` keeps them)."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def late_rows(stream: DataFrame, ts: str, delay: str, sink: str, checkpoint: str) -> StreamingQuery:
    """Writes the rows that a watermark of ``delay`` on ``ts`` leaves out of stateful operators, with their batch; runs until caught up.

    Operators let a row in unless it is behind the watermark of the batch before, which is the
    latest time of the batches before that one, less the delay.  Each batch
    keeps its own latest time beside the sink, under its number, so a batch that runs again
    finds the same watermark and replaces its own rows only.
    """
    marks = f"{sink.rstrip('/')}-marks"

    def batch(rows: DataFrame, number: int) -> None:
        spark = rows.sparkSession
        latest = rows.agg(F.max(ts).alias("latest"))
        latest.coalesce(1).write.mode("overwrite").parquet(f"{marks}/batch={number}")
        before = spark.read.schema("latest timestamp, batch long").parquet(marks).where(F.col("batch") < number - 1)
        mark = before.agg((F.max("latest") - F.expr(f"INTERVAL {delay}")).alias("_mark"))
        late = rows.join(F.broadcast(mark), F.col(ts) <= F.date_trunc("millisecond", "_mark"), "left_semi")  # one row
        late.write.mode("overwrite").parquet(f"{sink}/batch={number}")

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


GUARDRAILS = "session_id long, turn long, failures int, looping boolean, closed boolean"
#: State with timers and lists needs this provider: set it as ``spark.sql.streaming.stateStore.providerClass``.
STATE_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PIECE = 50_000


class _Guardrails(StatefulProcessor):
    """Keyed state of a session: errors in a row and the kinds of its last actions; a timer ends idle sessions."""

    def __init__(self, window: int, least: int, ts: str, idle_ms: int, ttl_ms: int | None):
        self.window, self.least, self.ts, self.idle_ms, self.ttl_ms = window, least, ts, idle_ms, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getValueState("counts", "failures int, turn long, last long", self.ttl_ms)
        self.recent = handle.getListState("recent", "kind string", self.ttl_ms)

    @staticmethod
    def _kinds(f: pd.DataFrame) -> np.ndarray:
        """0 other, 1 error, 2 success; plus 4 for a generation that added something and 8 for a training."""
        ok = f["status"] == "success"
        code = np.where(f["status"] == "error", 1, 0) + 2 * ok
        return (code + 4 * ((f["action"] == "generate_data") & ok & (f["added"] > 0)) + 8 * (f["action"] == "train")).to_numpy(np.uint8)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        failures, turn, last = self.counts.get() if self.counts.exists() else (0, 0, None)
        recent = "".join(k for (k,) in self.recent.get()) if self.recent.exists() else ""
        timer = last
        turns, kinds, times = zip(*((f["turn"].to_numpy(np.int64), self._kinds(f), f[self.ts].to_numpy("datetime64[ms]").astype(np.int64)) for f in rows), strict=True)
        every, kind, at_ms = np.concatenate(turns), np.concatenate(kinds), np.concatenate(times)
        order = np.argsort(every, kind="stable")
        for at in range(0, len(order), _PIECE):
            out = []
            for k in order[at : at + _PIECE].tolist():
                c, now = int(kind[k]), int(at_ms[k])
                if self.ttl_ms is None and last is not None and now > last + self.idle_ms:
                    out.append((key[0], turn, failures, False, True))
                    failures, recent = 0, ""
                last = now if last is None else max(last, now)
                turn = int(every[k])
                failures = failures + 1 if c & 1 else 0 if c & 2 else failures
                recent = (recent + ("g" if c & 4 else "t" if c & 8 else "."))[-self.window :]
                out.append((key[0], turn, failures, len(recent) >= self.window and recent.count("g") >= self.least and "t" not in recent, False))
            yield pd.DataFrame(out, columns=["session_id", "turn", "failures", "looping", "closed"])
        if self.ttl_ms is None and last != timer:
            if timer is not None:
                self.handle.deleteTimer(timer + self.idle_ms)
            self.handle.registerTimer(last + self.idle_ms)
        self.counts.update((failures, turn, last))
        self.recent.put([(k,) for k in recent])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        failures, turn, _ = self.counts.get()
        self.counts.clear()
        self.recent.clear()
        yield pd.DataFrame([(key[0], turn, failures, False, True)], columns=["session_id", "turn", "failures", "looping", "closed"])

    def close(self) -> None:
        pass


def guardrails(stream: DataFrame, window: int = 15, least: int = 8, ts: str = "ts", delay: str = "1 day", idle_ms: int = 7 * 86_400_000, ttl_ms: int | None = None) -> DataFrame:
    """(session_id, turn, failures, looping, closed) for each action of a log (session_id, turn, action, status, added, ts).

    Value state holds the errors in a row (blocked actions neither count nor reset), list
    state the kinds of the last ``window`` actions, so a session's state never grows with its log.
    When the watermark passes a session's last action by ``idle_ms``, or its next action comes
    that much later, a row with ``closed`` is put out, and later actions begin a new session.  Rows behind the watermark
    are left out (``late_rows`` keeps them).  With ``ttl_ms`` the state goes by the clock
    instead, without a closing row (such a query needs a trigger by time, as it is never caught up).  A session's actions of one micro-batch may come in any
    order: they are held as 17 bytes each until they are sorted, and put out in pieces;
    the source's ``maxFilesPerTrigger`` bounds a micro-batch.
    """
    ship_package(stream.sparkSession)
    rows = stream.where(F.col(ts).isNotNull()).select("session_id", "turn", "action", "status", "added", F.col(ts).alias("ts"))
    mode = "EventTime" if ttl_ms is None else "ProcessingTime"
    if ttl_ms is None:
        rows = rows.withWatermark("ts", delay)
    return rows.groupBy("session_id").transformWithStateInPandas(_Guardrails(window, least, "ts", idle_ms, ttl_ms), GUARDRAILS, "append", mode)
