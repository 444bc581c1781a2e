"""Response times and streams over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from civicloom.functions.text import clean_text
from civicloom.operators.response import (
    closing_day_series,
    daily_response_series,
    open_and_closed_times,
    response_time_by_group,
)
from civicloom.queries.registry import query
from civicloom.queries.scalars import clean_sql
from civicloom.session import fresh_path
from civicloom.sources.manifests import read_manifest
from civicloom.sources.snapshots import append_batch, read_snapshot, write_snapshot
from civicloom.streaming.jobs import (
    newest_counts,
    read_stream,
    stream_clean_ingest,
    stream_counts,
    stream_into_table,
)


def shipments(t):
    """Orders and shipments with times of day: both come from the tables."""
    clock = F.make_interval(hours=F.col("l_partkey") % 24, mins=F.col("l_suppkey") % 60)
    placed = F.make_interval(hours=F.col("o_custkey") % 24)
    return t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "o_orderpriority",
        (F.date_trunc("day", "o_orderdate") + placed).alias("placed"),
        (F.date_trunc("day", "l_shipdate") + clock).alias("shipped"),
    )


SHIPPED = """
    SELECT o_orderpriority, date_trunc('day', o_orderdate) + to_hours(o_custkey % 24) AS placed,
           date_trunc('day', l_shipdate) + to_hours(l_partkey % 24) + to_minutes(l_suppkey % 60) AS shipped
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey
"""

SHIPMENTS = """
    shipments AS (
        SELECT o_orderpriority, placed, epoch_us(shipped) < epoch_us(placed) AS negative,
               floor((epoch_us(shipped) - epoch_us(placed)) / 1000000.0)::BIGINT AS seconds
        FROM (SELECT o_orderpriority,
                     date_trunc('day', o_orderdate) + to_hours(o_custkey % 24) AS placed,
                     date_trunc('day', l_shipdate) + to_hours(l_partkey % 24)
                         + to_minutes(l_suppkey % 60) AS shipped
              FROM lineitem JOIN orders ON o_orderkey = l_orderkey))
"""


@query(
    "response_time_by_group",
    f"""WITH {SHIPMENTS} SELECT o_orderpriority, count(*) AS n_all,
          count(*) FILTER (negative) AS n_negative, count(*) FILTER (NOT negative) AS n,
          (sum(seconds) FILTER (NOT negative))::DOUBLE / count(*) FILTER (NOT negative) / 3600.0 AS mean_hours,
          quantile_cont(seconds, 0.5) FILTER (NOT negative) / 3600.0 AS median_hours,
          round(quantile_cont(seconds, 0.9) FILTER (NOT negative) / 3600.0, 6) AS p90_hours
        FROM shipments GROUP BY o_orderpriority""",
)
def _response_time_by_group(t):
    times = response_time_by_group(shipments(t), "o_orderpriority", "placed", "shipped")
    return times.withColumn("p90_hours", F.round("p90_hours", 6))


@query(
    "daily_response_series",
    f"""WITH {SHIPMENTS},
          daily AS (SELECT o_orderpriority, CAST(placed AS DATE) AS day, count(*) AS n,
                           sum(seconds) AS total FROM shipments WHERE NOT negative GROUP BY 1, 2)
        SELECT o_orderpriority, CAST(day AS VARCHAR) AS day, n, total::DOUBLE / n / 86400.0 AS mean_days,
               (sum(total) OVER week)::DOUBLE / sum(n) OVER week / 86400.0 AS trailing_mean_days
        FROM daily WINDOW week AS (PARTITION BY o_orderpriority ORDER BY day
                                       RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW)""",
)
def _daily_response_series(t):
    series = daily_response_series(shipments(t), "o_orderpriority", "placed", "shipped", unit="days")
    return series.withColumn("day", F.col("day").cast("string"))


@query(
    "open_and_closed_times",
    f"""WITH {SHIPMENTS},
          known AS (SELECT o_orderpriority, coalesce(shipped <= moment, false) AS closed,
                           floor((epoch_us(CASE WHEN shipped <= moment THEN shipped ELSE moment END)
                                  - epoch_us(placed)) / 1000000.0)::BIGINT AS seconds
                    FROM (SELECT *, (SELECT max(date_trunc('day', o_orderdate)) FROM orders) AS moment FROM cases)
                    WHERE placed <= moment AND shipped >= placed),
          counted AS (SELECT o_orderpriority, seconds, count(*) AS cases, count(*) FILTER (closed) AS ends
                      FROM known GROUP BY 1, 2),
          risk AS (SELECT *, sum(cases) OVER (PARTITION BY o_orderpriority ORDER BY seconds DESC) AS at_risk,
                          lag(seconds, 1, 0) OVER (PARTITION BY o_orderpriority ORDER BY seconds) AS since FROM counted),
          steps AS (SELECT *, sum(CASE WHEN ends = at_risk THEN -1e6 ELSE ln(1 - ends / at_risk) END)
                                OVER (PARTITION BY o_orderpriority ORDER BY seconds) AS total,
                           CASE WHEN ends = at_risk THEN -1e6 ELSE ln(1 - ends / at_risk) END AS factor FROM risk)
        SELECT o_orderpriority, sum(ends)::BIGINT AS n_closed, (sum(cases) - sum(ends))::BIGINT AS n_open,
               min(seconds) FILTER (exp(total) <= 0.5 + 1e-12) / 86400.0 AS median_days,
               min(seconds) FILTER (exp(total) <= 0.1 + 1e-12) / 86400.0 AS p90_days,
               round(sum((seconds - since) * exp(total - factor)) / 86400.0, 6) AS mean_to_longest_days,
               round(min(exp(total)), 9) AS still_open
        FROM steps GROUP BY o_orderpriority""".replace("FROM cases", f"FROM ({SHIPPED})"),
)
def _open_and_closed_times(t):
    """Shipments as known when the last order came: many are still under way."""
    moment = t.orders.agg(F.max(F.date_trunc("day", "o_orderdate"))).first()[0]
    rows = shipments(t).withColumn("moment", F.lit(moment))
    times = open_and_closed_times(rows, "o_orderpriority", "placed", "shipped", "moment", unit="days")
    return times.withColumns({
        "mean_to_longest_days": F.round("mean_to_longest_days", 6), "still_open": F.round("still_open", 9)})


@query(
    "closing_day_series",
    f"""WITH {SHIPMENTS},
          daily AS (SELECT o_orderpriority, CAST(shipped AS DATE) AS day, count(*) AS n, sum(seconds) AS total
                    FROM (SELECT *, floor((epoch_us(shipped) - epoch_us(placed)) / 1000000.0)::BIGINT AS seconds
                          FROM ({{SHIPPED}}) WHERE shipped >= placed) GROUP BY 1, 2)
        SELECT o_orderpriority, CAST(day AS VARCHAR) AS day, n, round(total::DOUBLE / n / 86400.0, 9) AS mean_days,
               round((sum(total) OVER week)::DOUBLE / sum(n) OVER week / 86400.0, 9) AS forecast_days,
               round(total::DOUBLE / n / 86400.0 - (sum(total) OVER week)::DOUBLE / sum(n) OVER week / 86400.0, 9) AS error_days
        FROM daily WINDOW week AS (PARTITION BY o_orderpriority ORDER BY day
                       RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND INTERVAL 1 DAY PRECEDING)""".replace("{SHIPPED}", SHIPPED),
)
def _closing_day_series(t):
    series = closing_day_series(shipments(t), "o_orderpriority", "placed", "shipped", unit="days")
    names = ("mean_days", "forecast_days", "error_days")
    return series.withColumns({"day": F.col("day").cast("string"), **{name: F.round(name, 9) for name in names}})


def _event_stream(t):
    return read_stream(t.spark, t.folder, t.events.schema, pathGlobFilter="events.parquet")


@query(
    "stream_clean_ingest",
    f"SELECT event_id, ts, event_type, {clean_sql('props')} AS props FROM events",
)
def _stream_clean_ingest(t):
    out, checkpoint = fresh_path(t.spark, "ingested"), fresh_path(t.spark, "stream")
    stream_clean_ingest(_event_stream(t), out, checkpoint, "props", "ts").awaitTermination()
    return t.spark.read.parquet(out).select("event_id", "ts", "event_type", "props")


@query(
    "stream_into_table",
    f"SELECT event_id, ts, event_type, {clean_sql('props')} AS props FROM events",
)
def _stream_into_table(t):
    """A load fills the table with some events and a stream with the others; the stream's batch
    is then added a second time, as after a failure, and counts once."""
    root, checkpoint, landed = (fresh_path(t.spark, name) for name in ("table", "stream", "landed"))
    loaded = t.events.where("event_id % 4 = 0").withColumn("props", clean_text(F.col("props")))
    write_snapshot(loaded, root)
    t.events.where("event_id % 4 <> 0").write.parquet(landed)
    stream = read_stream(t.spark, landed, t.events.schema)
    stream_into_table(stream, root, checkpoint, "events", "props", "ts").awaitTermination()
    for batch in range(read_manifest(t.spark, root).done["events"] + 1):
        append_batch(t.events, root, "events", batch)
    return read_snapshot(t.spark, root).select("event_id", "ts", "event_type", "props")


@query(
    "stream_counts",
    """SELECT date_trunc('hour', ts) AS window_start,
              date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
              event_type, count(*) AS n FROM events GROUP BY ALL""",
)
def _stream_counts(t):
    out, checkpoint = fresh_path(t.spark, "hourly"), fresh_path(t.spark, "stream")
    stream_counts(_event_stream(t), out, checkpoint, "ts", "event_type").awaitTermination()
    counts = newest_counts(t.spark, out, "event_type")
    return counts.select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        F.col("window_end").cast("timestamp_ntz").alias("window_end"),
        "event_type",
        "n",
    )
