"""K1 (extension): first-week session signals as a Structured Streaming job.

Sessions arrive through a file stream in the order of an event clock, are joined
to the static customer table and kept while they lie in the first
``early_days`` days after signup (or before it). A stateful processor
(``transformWithState``) holds a few numbers per customer whose week is open, in
RocksDB. When the watermark passes the end of a customer's week, its event-time
timer fires: the customer's row is emitted once (append mode) and its state is
dropped, so state is bounded by open weeks, and no micro-batch rewrites earlier
output.

A session is late if its week had ended by the watermark of its micro-batch. Late
sessions are in no sum, but none is lost: they leave the processor as rows of
their own with ``late_at`` (``late_sessions``), beside the weeks (``closed_weeks``).
The processor sees them as the event time itself ends before it: an old session
of a week that is still open counts.

With ``trigger(availableNow=True)`` the job drains the source and stops; the
rows then equal the batch aggregate (J6) of all closed weeks. The files of a
stored dataset come in any order of time, so ``replay`` plays them in several
micro-batches cut by their measured event time: no stored event is late.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.streaming.query import StreamingQuery

from aisle.functions.dates import day_boundaries
from aisle.operators import staging
from aisle.operators.early import as_records, first_orders, score_early
from aisle.operators.prefix import bucket_by, cut_points
from aisle.params import DEFAULT, Params
from aisle.session import shared_dir
from aisle.sources import tpch_adapter as adapter

WEEK = ("customer_id long, sessions_first_7d long, avg_cart_adds double, avg_products_viewed double, "
        "purchases_first_7d long, days_to_first_purchase int")
OUT = WEEK + ", late_at long"
STATE = "sessions long, adds long, views long, bought long, first_day int, closes long"


def _processor() -> StatefulProcessor:
    made = Row(*[column.split()[0] for column in OUT.split(", ")])

    class FirstWeek(StatefulProcessor):             # local, so that it travels to the workers by value
        def init(self, handle) -> None:
            self.handle = handle
            self.week = handle.getValueState("week", STATE)

        def handleInputRows(self, key, rows, timerValues):
            mark = timerValues.getCurrentWatermarkInMs()
            n, adds, views, bought, first, before = self.week.get() or (0, 0, 0, 0, None, 0)
            had, closes = n, before
            for row in rows:
                if row.closes <= mark:
                    yield made(key[0], None, None, None, None, None, row.at_us)
                    continue
                n, closes = n + 1, max(closes, row.closes)
                adds, views = adds + (row.num_cart_adds or 0), views + (row.num_products_viewed or 0)
                if row.purchased:
                    bought += 1
                    first = row.day if first is None else min(first, row.day)
            if n > had:
                if closes != before:
                    if before:
                        self.handle.deleteTimer(before)
                    self.handle.registerTimer(closes)
                self.week.update((n, adds, views, bought, first, closes))

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            n, adds, views, bought, first, _ = self.week.get()
            self.week.clear()
            yield made(key[0], n, adds / n, views / n, bought, first, None)

        def close(self) -> None:
            pass

    return FirstWeek()


def first_week_stream(sessions: DataFrame, customers: DataFrame, pace: float = 1.0, lateness: str = "1 hour",
                      p: Params = DEFAULT) -> DataFrame:
    """Rows of ``OUT`` from a stream of sessions with ``event_time`` (the clock of
    arrival). ``pace``: how much the event clock advances while session time
    advances by one."""
    c = customers.select("customer_id", "signed_up_at")
    days = day_boundaries(F.col("signed_up_at"), F.col("session_started_at"))
    left: Column = F.timestamp_diff("MICROSECOND", F.col("session_started_at"),
                                    F.date_add("signed_up_at", p.early_days + 1).cast("timestamp_ntz"))
    closes = F.unix_micros("event_time") + F.ceil(left * F.lit(pace))
    # without event_time among the columns the operator drops no row by itself
    timed = (sessions.withWatermark("event_time", lateness).join(c, "customer_id", "inner")
             .withColumn("day", days).filter(F.col("day") <= p.early_days)
             .select("customer_id", "num_cart_adds", "num_products_viewed", "purchased", "day",
                     F.unix_micros("event_time").alias("at_us"), F.ceil(closes / 1000).cast("long").alias("closes")))
    return timed.groupBy("customer_id").transformWithState(_processor(), OUT, "append", "EventTime")


def closed_weeks(out: DataFrame) -> DataFrame:
    """The weeks (``WEEK``) among rows of ``first_week_stream``."""
    return out.filter("late_at IS NULL").drop("late_at")


def late_sessions(out: DataFrame) -> DataFrame:
    """(customer_id, late_at): the late sessions, by the event clock."""
    return out.filter("late_at IS NOT NULL").select("customer_id", F.timestamp_micros("late_at").alias("late_at"))


def event_stream(spark: SparkSession, path: str, schema, files_per_batch: int | None = 1) -> DataFrame:
    """The events dataset as a stream, whether ``path`` is a file or a folder of
    part files (a pattern that matches just this name serves both). Files must
    then arrive in the order of time; ``None`` puts all present ones, in any
    order, into one micro-batch."""
    exact = f"{path[:-1]}[{path[-1]}]"
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(exact)


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@dataclass
class Replay:
    """The sink's weeks and its late sessions (none if scored), and per micro-batch
    with rows: rows read, entries (values and timers) held in state after it."""

    table: DataFrame
    late: DataFrame | None
    batches: list[tuple[int, int]]
    state_left: int


def started(frame: DataFrame, run: str) -> StreamingQuery:
    """The query on state in RocksDB: on the executors' disks, not in their heaps."""
    conf = frame.sparkSession.conf
    before = conf.get(PROVIDER)
    conf.set(PROVIDER, ROCKSDB)
    try:
        return (frame.writeStream.outputMode("append").format("parquet").option("path", f"{run}/table")
                .option("checkpointLocation", f"{run}/checkpoint").trigger(availableNow=True).start())
    finally:
        conf.set(PROVIDER, before)


def replay(spark: SparkSession, sf_dir: str, p: Params = DEFAULT, batches: int = 4, scored: bool = False) -> Replay:
    """Play the stored events of ``sf_dir`` to the stream in the order of their time.

    Cut points of the measured event time deal the events into ``batches`` parts. Each
    is put into the stream's source folder and drained by the same query (one
    checkpoint) before the next one comes: a part may be any number of files, as a
    restart is a micro-batch of all new ones. Weeks that a part's watermark closes are
    emitted and leave the state. With ``scored``, emitted customers meet their first
    orders (static) and the rule scorer (J11) inside the stream."""
    t = adapter.Tables(spark, sf_dir)
    customers = staging.stg_customers(adapter.raw_customers(t))
    run = shared_dir(spark, f"stream-first-week-{uuid.uuid4().hex}")
    source = f"{run}/events"
    clock = F.unix_micros(F.col("ts").cast("timestamp"))
    events = t["events"]
    cuts = cut_points(events.select(clock.alias("us")), "us", batches)
    progress: list = []
    for part in range(len(cuts) + 1):
        events.filter(bucket_by(clock, cuts) == part).write.mode("append").parquet(source)
        stream = spark.readStream.schema(events.schema).parquet(source)
        sessions = adapter.sessions_from_events(stream, clock=True).withColumnRenamed("session_start", "session_started_at")
        out = first_week_stream(sessions, customers, adapter.TIME_SQUEEZE, p=p)
        if scored:
            orders = staging.stg_orders(adapter.raw_orders(t))
            out = score_early(as_records(closed_weeks(out).join(first_orders(orders, p), "customer_id", "left")), p)
        schema, q = out.schema, started(out, run)
        q.awaitTermination()
        progress += q.recentProgress
    held = lambda x: x["stateOperators"][0]["numRowsTotal"]
    seen = [(x["numInputRows"], held(x)) for x in progress if x["numInputRows"]]
    sink, left = spark.read.schema(schema).parquet(f"{run}/table"), held(progress[-1]) if progress else 0
    if scored:
        return Replay(sink, None, seen, left)
    return Replay(closed_weeks(sink), late_sessions(sink), seen, left)


def run_first_week(spark: SparkSession, sf_dir: str, p: Params = DEFAULT) -> DataFrame:
    """Run the stream to completion over the events of ``sf_dir`` and return
    the sink table as a DataFrame."""
    return replay(spark, sf_dir, p).table
