"""Queries on events; each also runs on a stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..streaming import events as ev
from . import query, table


def events(spark, d):
    return table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def seconds(column):
    return F.unix_seconds(column)


@query("SELECT epoch_us(time_bucket(INTERVAL 1 hour, ts, TIMESTAMP '2000-01-01')) // 1000000 AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
def tumbling_counts(spark, d):
    return ev.tumbling_counts(events(spark, d), "1 hour").withColumn("start", seconds(F.col("start")))


@query("SELECT s - o * 1800 AS start, count(*) AS n FROM (SELECT epoch_us(ts) // 1000000 // 1800 * 1800 AS s FROM events), range(0, 2) t(o) GROUP BY ALL")
def sliding_counts(spark, d):
    return ev.sliding_counts(events(spark, d), "1 hour", "30 minutes").withColumn("start", seconds(F.col("start")))


@query(
    """SELECT user_id, min(t) // 1000000 AS start, count(*) AS n FROM (SELECT *, sum(CASE WHEN p IS NULL OR t >= p + 7200000000 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY t ROWS UNBOUNDED PRECEDING) AS g FROM (
SELECT user_id, epoch_us(ts) AS t, lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) AS p FROM events)) GROUP BY user_id, g"""
)
def session_counts(spark, d):
    return ev.session_counts(events(spark, d), "2 hours").withColumn("start", seconds(F.col("start")))


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_dedupe(spark, d):
    return ev.dedupe(events(spark, d), ["user_id", "event_type"]).select("user_id", "event_type")


@query("SELECT user_id, event_type, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1")
def first_events(spark, d):
    """The event that stays of each user and kind."""
    return ev.dedupe(events(spark, d).select("ts", "event_id", "user_id", "event_type"), ["user_id", "event_type"]).select("user_id", "event_type", "event_id")


RATE = """WITH RECURSIVE e AS (SELECT event_id, user_id, epoch_us(ts) AS t, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
f AS (SELECT event_id, user_id, t, i, t AS start, CAST(1 AS BIGINT) AS n FROM e WHERE i = 1 UNION ALL
SELECT e.event_id, e.user_id, e.t, e.i, CASE WHEN e.t >= f.start + 86400000000 THEN e.t ELSE f.start END, CASE WHEN e.t >= f.start + 86400000000 THEN 1 ELSE f.n + 1 END FROM f JOIN e ON e.user_id = f.user_id AND e.i = f.i + 1)"""


@query(f"{RATE} SELECT event_id, user_id, n, n <= 3 AS allowed FROM f")
def rate_limit(spark, d):
    return ev.rate_limit(events(spark, d), 3, 86_400)


@query(f"{RATE} SELECT user_id, arg_max(n > 3, event_id) AS no_llm FROM f GROUP BY user_id")
def llm_gate(spark, d):
    return ev.gated(ev.rate_limit(events(spark, d), 3, 86_400))


@query("SELECT user_id, count(*) AS n FROM events WHERE event_type IN ('click', 'view') AND CAST(json_extract_string(props, '$.k') AS BIGINT) % 2 = 0 GROUP BY user_id")
def json_filter(spark, d):
    k = F.get_json_object("props", "$.k").cast("long")
    return events(spark, d).where(F.col("event_type").isin("click", "view") & (k % 2 == 0)).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
