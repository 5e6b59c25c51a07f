"""Event streams: tumbling and session windows under a watermark, replay of a folder, and a stateful circuit breaker."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def read_events(spark: SparkSession, folder: str, glob: str = "events*.parquet", files: int = 8) -> DataFrame:
    """The events of a folder's files as a stream; ts as an instant."""
    raw = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", files).option("pathGlobFilter", glob).parquet(folder)
    return raw.withColumn("ts", F.col("ts").cast("timestamp"))


def tumbling(events: DataFrame, width: str = "1 day", late: str = "1 day") -> DataFrame:
    """Counts and sums by window and type; a window is final once the watermark passes it."""
    return _sums(events.withWatermark("ts", late), F.window("ts", width))


def sliding(events: DataFrame, width: str, step: str, late: str = "1 day") -> DataFrame:
    return _sums(events.withWatermark("ts", late), F.window("ts", width, step))


def sessions(events: DataFrame, gap: str = "6 hours", late: str = "1 day") -> DataFrame:
    """For each user the sessions that a gap ends."""
    out = events.withWatermark("ts", late).groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("events"), F.sum("value").alias("value"))
    return out.select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "events", "value")


def _sums(events: DataFrame, window) -> DataFrame:
    out = events.groupBy(window.alias("w"), "event_type").agg(F.count("*").alias("events"), F.sum("value").alias("value"))
    return out.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "event_type", "events", "value")


def replay(stream: DataFrame, sink: str, checkpoint: str, mode: str = "append") -> None:
    """Runs a stream over all there is and stops; a second call continues after it."""
    stream.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start().awaitTermination()


def breaker(events: DataFrame, base: float = 60.0, most: float = 3600.0, limit: int = 3) -> DataFrame:
    """Per user a circuit breaker over the event log: `limit` errors in a row trip it for a cooldown that doubles with each
    trip; a success resets both. Rows user_id, trips, run, open_until (seconds) after each batch."""

    def step(key, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        run, trips, until = state.get if state.exists else (0, 0, 0.0)
        rows = pd.concat(list(parts)).sort_values(["ts", "event_id"])
        for ts, kind in zip(rows["ts"], rows["event_type"], strict=True):
            now = ts.timestamp()
            if kind != "error":
                run = trips = 0
                continue
            run += 1
            if run >= limit and now >= until:
                trips, run = trips + 1, 0
                until = now + min(most, base * 2 ** (trips - 1))
        state.update((run, trips, until))
        yield pd.DataFrame({"user_id": [key[0]], "trips": [trips], "run": [run], "open_until": [until]})

    return events.groupBy("user_id").applyInPandasWithState(
        step, "user_id long, trips int, run int, open_until double", "run int, trips int, until double", "update", GroupStateTimeout.NoTimeout
    )


class _KeyedBreaker(StatefulProcessor):
    """Events wait until the watermark has passed them and then count in order of time. A user's state is one value, since
    each call to the state store is a round trip: a user costs a few for each batch, however many events it has."""

    def __init__(self, base: float, most: float, limit: int):
        self.base, self.most, self.limit = base, most, limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("breaker", "run int, trips int, until double, events long, us array<long>, ids array<long>, errors array<boolean>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        new = [(r["us"], r["event_id"], r["error"]) for r in rows if r["us"] >= passed]  # what is late by more is dropped
        if new:
            run, trips, until, events, us, ids, errors = self.held.get() or (0, 0, 0.0, 0, [], [], [])
            at, n, bad = zip(*new, strict=True)
            self.held.update((run, trips, until, events, [*us, *at], [*ids, *n], [*errors, *bad]))
            self.handle.registerTimer(min(at) // 1000 + 1)  # once that one is passed, all that the watermark has passed count
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        run, trips, until, events, *waiting = self.held.get()
        held = sorted(zip(*waiting, strict=True))
        due = bisect_left(held, (passed,))
        if not due:
            return
        for us, _, error in held[:due]:
            at = us / 1e6
            run, trips = (run + 1, trips) if error else (0, 0)
            if run >= self.limit and at >= until:
                trips, run, until = trips + 1, 0, at + min(self.most, self.base * 2**trips)
        rest = [list(x) for x in zip(*held[due:], strict=True)] or [[], [], []]
        self.held.update((run, trips, until, events + due, *rest))
        if rest[0]:
            self.handle.registerTimer(rest[0][0] // 1000 + 1)
        yield Row(user_id=key[0], events=events + due, trips=trips, run=run, open_until=until)

    def close(self) -> None:
        pass


#: What transformWithState needs for its state.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Users in a part of the state.
USERS = 4000


def keyed_breaker(events: DataFrame, base: float = 60.0, most: float = 3600.0, limit: int = 3, late: str = "0 seconds") -> DataFrame:
    """The breaker in order of event time, however rows come: a user's events wait in the state until the watermark, `late`
    behind the newest event, has passed them, and then count. Rows later than the watermark are dropped. A row user_id,
    events (counted so far), trips, run, open_until each time that a user's events count; needs ROCKSDB as state store."""
    timed = events.withColumn("us", _micros()).withColumn("ts", F.timestamp_micros("us")).withWatermark("ts", late)
    rows = timed.select("user_id", "event_id", "us", (F.col("event_type") == "error").alias("error"))
    schema = "user_id long, events long, trips int, run int, open_until double"
    return rows.groupBy("user_id").transformWithState(_KeyedBreaker(base, most, limit), schema, "Append", "EventTime")


def _micros() -> Column:
    """The clock time of ts as microseconds, whatever the session's time zone."""
    return F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', cast(ts AS timestamp_ntz))")


def replayed_breaker(events: DataFrame, folder: str, triggers: int = 4, **options) -> DataFrame:
    """The breaker's last row of each user after a replay of an event log in as many micro-batches as triggers: written to
    folder in order of time, a file each, and read back as a stream. The newest event is not passed by any watermark."""
    spark = events.sparkSession
    cuts = events.select(_micros().alias("us")).approxQuantile("us", [k / triggers for k in range(1, triggers)], 0.01)
    ends = [None, *(int(c) for c in cuts), None]
    for low, high in zip(ends, ends[1:], strict=False):
        part = events if low is None else events.filter(_micros() >= low)
        (part if high is None else part.filter(_micros() < high)).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    # a part of the state costs a task and a store in each batch, so there are as many as the users need, and no more than set
    users = events.agg(F.approx_count_distinct("user_id")).first()[0]
    set_ = int(spark.conf.get("spark.sql.shuffle.partitions"))
    conf = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB, "spark.sql.shuffle.partitions": str(min(set_, max(spark.sparkContext.defaultParallelism, users // USERS)))}
    before = {name: spark.conf.get(name, None) for name in conf}
    for name, value in conf.items():
        spark.conf.set(name, value)
    try:
        replay(keyed_breaker(stream, **options), f"{folder}/out", f"{folder}/checkpoint")
    finally:
        for name, value in before.items():
            spark.conf.set(name, value) if value else spark.conf.unset(name)
    rows = spark.read.schema("user_id long, events long, trips int, run int, open_until double").parquet(f"{folder}/out")
    return rows.groupBy("user_id").agg(F.max(F.struct("events", "trips", "run", "open_until")).alias("r")).select("user_id", "r.*")
