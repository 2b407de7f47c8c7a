"""K1: the stream equals the batch aggregate, whatever the files."""

import uuid

from pyspark.sql import functions as F

from aisle.operators import staging
from aisle.plans.marts import Marts
from aisle.session import shared_dir
from aisle.sources import tpch_adapter as adapter
from aisle.streaming import first_week


def key(rs):
    return sorted(rs, key=str)


def test_single_file(spark, small_dir):
    assert key(rows(first_week.run_first_week(spark, small_dir))) == key(batch(Marts(spark, small_dir)))


def rows(df):
    return [tuple(r) for r in df.select("customer_id", "sessions_first_7d", "avg_cart_adds", "avg_products_viewed",
                                        "purchases_first_7d", "days_to_first_purchase").collect()]


def batch(m):
    return rows(m.early_signals.filter("sessions_first_7d > 0"))


def test_folder_of_three_files_in_three_batches(spark, small_dir, tmp_path):
    m = Marts(spark, small_dir)
    events, folder = m.t["events"], tmp_path / "events.parquet"
    (tmp_path / "events_old.parquet").mkdir()                      # a neighbour that must not be read
    events.coalesce(1).write.mode("overwrite").parquet(str(tmp_path / "events_old.parquet"))
    folder.mkdir()
    cuts = [F.lit("2024-01-01"), F.lit("2024-01-09"), F.lit("2024-01-20"), F.lit("2024-03-01")]
    for i in range(3):
        part = events.filter((F.col("ts") >= cuts[i].cast("timestamp_ntz")) & (F.col("ts") < cuts[i + 1].cast("timestamp_ntz")))
        part.coalesce(1).write.mode("append").parquet(str(folder))
    stream = first_week.event_stream(spark, str(folder), events.schema)
    sessions = adapter.sessions_from_events(stream, clock=True).withColumnRenamed("session_start", "session_started_at")
    customers = staging.stg_customers(adapter.raw_customers(m.t))
    out = shared_dir(spark, uuid.uuid4().hex)
    q = first_week.started(first_week.first_week_stream(sessions, customers, adapter.TIME_SQUEEZE), out)
    q.awaitTermination()
    assert len([p for p in q.recentProgress if p["numInputRows"]]) == 3
    assert q.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] == 0          # every week is closed
    assert key(rows(spark.read.parquet(out + "/table"))) == key(batch(m))


def test_replay_closes_weeks_batch_by_batch(spark, small_dir):
    run = first_week.replay(spark, small_dir, batches=4)
    assert len(run.batches) >= 3 and run.late.count() == 0 and run.state_left == 0
    held = [b[1] for b in run.batches]
    assert min(held[1:]) < max(held)                               # state shrinks between batches
    assert key(rows(run.table)) == key(batch(Marts(spark, small_dir)))
    assert run.table.groupBy("customer_id").count().filter("count > 1").count() == 0


def test_scores_in_the_stream_equal_the_batch(spark, small_dir):
    from aisle.operators.early import as_records, score_early
    m = Marts(spark, small_dir)
    want = score_early(as_records(m.early_signals.filter("sessions_first_7d > 0")), m.p)
    got = first_week.replay(spark, small_dir, scored=True).table
    assert key(tuple(r) for r in got.collect()) == key(tuple(r) for r in want.collect())


def test_folder_of_files_in_no_order_of_time(spark, small_dir, tmp_path):
    t = adapter.Tables(spark, small_dir)
    for name in ("customer", "nation"):
        t[name].write.parquet(str(tmp_path / f"{name}.parquet"))
    for i in range(4):
        (t["events"].filter(F.pmod(F.xxhash64("event_id"), F.lit(4)) == i).coalesce(1)
         .write.mode("append").parquet(str(tmp_path / "events.parquet")))
    got = rows(first_week.run_first_week(spark, str(tmp_path)))
    assert key(got) == key(batch(Marts(spark, small_dir)))


def test_late_sessions_go_to_the_side(spark, small_dir):
    m = Marts(spark, small_dir)
    events, customers = m.t["events"], staging.stg_customers(adapter.raw_customers(m.t))
    day = F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")
    out = shared_dir(spark, uuid.uuid4().hex)
    for part in (events.filter(~day), events.filter(day)):              # the second part comes after its time
        part.coalesce(1).write.mode("append").parquet(out + "/events")
        stream = spark.readStream.schema(events.schema).parquet(out + "/events")
        sessions = adapter.sessions_from_events(stream, clock=True).withColumnRenamed("session_start", "session_started_at")
        first_week.started(first_week.first_week_stream(sessions, customers, adapter.TIME_SQUEEZE), out).awaitTermination()
    sink = spark.read.parquet(out + "/table")
    late, weeks = first_week.late_sessions(sink), first_week.closed_weeks(sink)
    assert late.count() > 0 and weeks.count() > 0
    # every session of a first week is in a week or late, and only those of the second part are late
    all_of = sum(r[1] for r in batch(m))
    assert weeks.agg(F.sum("sessions_first_7d")).first()[0] + late.count() == all_of
    assert late.filter(F.col("late_at") >= F.lit("2024-01-15").cast("timestamp")).count() == 0
    assert weeks.groupBy("customer_id").count().filter("count > 1").count() == 0
