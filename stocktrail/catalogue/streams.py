"""Streams over the given tables, read and written as files."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stocktrail.catalogue.lineage_sql import EVENTS, RUNS
from stocktrail.catalogue.registry import at, on, query
from stocktrail.functions.scalars import day
from stocktrail.plans import standins as S
from stocktrail.plans.standins import Tables
from stocktrail.session import freed, scratch_path, slices
from stocktrail.sources import eventlog
from stocktrail.streaming import jobs as J


def _stream(t: Tables, name: str) -> DataFrame:
    # A pattern, because the file source takes a table of one file only so.
    return t.spark.readStream.schema(getattr(t, name).schema).parquet(f"{t.folder}/{name}.parquet*")


def _drain(t: Tables, df: DataFrame, name: str, end=None) -> DataFrame:
    return J.drain(df, scratch_path(t.spark, name), scratch_path(t.spark, f"{name}-checkpoint"), end=end)


def _ending_events(t: Tables, *types: str):
    """The events as a stream that can be ended, by an event of each of the types."""
    marks = [{"event_type": kind, "ts": J.END, "user_id": -1 - i} for i, kind in enumerate(types)]
    stream, end = J.with_end(_stream(t, "events"), scratch_path(t.spark, "end"), marks)
    return stream.withColumn("at", F.col("ts").cast("timestamp")), end


def _event_stream(t: Tables) -> DataFrame:
    """The events as a compressed log, sent in as many batches as jobs go in slices."""
    path = scratch_path(t.spark, "log")
    eventlog.write_events(S.run_events(t), path, "gzip", eventlog.PER_FILE)
    files = len(t.spark.read.text(path).inputFiles())
    batch = -(-files // slices(t.spark))
    return eventlog.read_events(t.spark, path, streaming=True, files_per_batch=max(1, batch))


@query(
    "ST1 IO8",
    f"""{EVENTS} SELECT {on('"eventTime"')} AS event_date, "eventType", count(*) AS n FROM event GROUP BY 1, 2""",
)
def ingested_log(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "ingested")
    checkpoint = scratch_path(t.spark, "ingested-checkpoint")
    with freed(t.spark):
        J.ingest(_event_stream(t), path, checkpoint, period="month").awaitTermination()
    log = t.spark.read.parquet(path)
    return log.groupBy(day("eventTime").alias("event_date"), "eventType").agg(
        F.count("*").alias("n")
    )


@query("ST2", f"SELECT event_id, user_id, {at('ts')} AS ts FROM events")
def stream_without_copies(t: Tables) -> DataFrame:
    """Every event is sent twice."""
    sent = _stream(t, "events").withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    once = J.dedupe_stream(sent.withColumn("at", F.col("ts").cast("timestamp")), ["event_id"], "at")
    return _drain(t, once.select("event_id", "user_id", "ts"), "once")


_PAIRS = """
WITH s AS (SELECT user_id, event_id, ts FROM events WHERE event_type = 'signup'),
p AS (SELECT user_id, event_id, ts FROM events WHERE event_type = 'purchase')"""


def _pairs(t: Tables) -> DataFrame:
    stream, end = _ending_events(t, "signup", "purchase")
    starts = stream.where(F.col("event_type") == "signup").select(
        "user_id", F.col("event_id").alias("start_id"), F.col("at").alias("start_time")
    )
    ends = stream.where(F.col("event_type") == "purchase").select(
        "user_id", F.col("event_id").alias("end_id"), F.col("at").alias("end_time")
    )
    return _drain(t, J.pair_stream(starts, ends, "user_id", "1 HOUR"), "pairs", end)


@query(
    "ST3",
    f"""{_PAIRS} SELECT s.user_id, s.event_id AS start_id, p.event_id AS end_id, {at('s.ts')} AS start_time
    FROM s JOIN p ON s.user_id = p.user_id AND p.ts BETWEEN s.ts AND s.ts + INTERVAL 1 HOUR""",
)
def starts_paired_with_ends(t: Tables) -> DataFrame:
    pairs = _pairs(t).where(F.col("end_id").isNotNull())
    return pairs.select("user_id", "start_id", "end_id", "start_time")


@query(
    "ST3",
    f"""{_PAIRS} SELECT s.user_id, s.event_id AS start_id, {at('s.ts')} AS start_time FROM s
    WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.user_id = s.user_id AND p.ts BETWEEN s.ts AND s.ts + INTERVAL 1 HOUR)""",
)
def starts_known_to_be_late(t: Tables) -> DataFrame:
    """Starts that no end followed in time."""
    return _pairs(t).where(F.col("end_id").isNull()).select("user_id", "start_id", "start_time")


@query(
    "ST4",
    f"""SELECT {at("date_trunc('day', ts)")} AS window_start, event_type, count(*) AS n_events FROM events GROUP BY 1, 2""",
)
def events_per_closed_day(t: Tables) -> DataFrame:
    stream, end = _ending_events(t, "end")
    return _drain(t, J.windowed_counts(stream, "at", ["event_type"]), "windows", end)


_PATTERN = {"event_type": ["signup", "purchase"], "detail": {"k": ["7", "11", "42"]}}
_PATTERN_SQL = f"""SELECT event_id, event_type, {at('ts')} AS ts FROM events
    WHERE event_type IN ('signup', 'purchase') AND json_extract_string(props, '$.k') IN ('7', '11', '42')"""


def _with_detail(events: DataFrame) -> DataFrame:
    return events.withColumn("detail", F.from_json("props", "k string"))


@query("ST5 D13", _PATTERN_SQL)
def events_of_a_pattern(t: Tables) -> DataFrame:
    found = J.match_pattern(_with_detail(t.events), _PATTERN)
    return found.select("event_id", "event_type", "ts")


@query("ST5 D13", _PATTERN_SQL)
def stream_of_a_pattern(t: Tables) -> DataFrame:
    found = J.match_pattern(_with_detail(_stream(t, "events")), _PATTERN)
    return _drain(t, found.select("event_id", "event_type", "ts"), "pattern")


@query(
    "ST6",
    f"""{RUNS} SELECT run_id, job, {at('started_at')} AS started_at, {at('ended_at')} AS ended_at,
      CASE WHEN ended_at IS NULL THEN 'START' ELSE 'COMPLETE' END AS state FROM run""",
)
def run_state_of_a_stream(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "run-state")
    checkpoint = scratch_path(t.spark, "run-state-checkpoint")
    with freed(t.spark):
        J.run_state_stream(_event_stream(t), path, checkpoint).awaitTermination()
    return J.run_state(t.spark, path)
