"""Streaming extension plans (X1–X3): each drives a Structured Streaming
query over the events table to completion and returns its output table."""

from __future__ import annotations


from tillroll.functions.numeric import xsum_sql
from tillroll.plans.catalog import register
from tillroll.streaming import events as ev


def _all_windows(spark, sf_dir, name, size="1 day", slide=None):
    """What the stream emits, and the windows still open at the end of its input."""
    closed = ev.run_to_table(ev.windowed_totals(ev.event_stream(spark, sf_dir), size, slide), name)
    return closed.unionByName(ev.open_windows(ev.events_batch(spark, sf_dir), size, slide))


@register("stream_event_dedup", "X1 P4", "event_id bigint, event_type string, value double",
          sql="SELECT event_id, arg_min(event_type, ts) AS event_type, arg_min(value, ts) AS value FROM events GROUP BY event_id")
def stream_event_dedup(spark, sf_dir):
    out = ev.run_to_table(ev.dedupe_events(ev.event_stream(spark, sf_dir)), "dedup")
    return out.select("event_id", "event_type", "value")


@register("stream_daily_totals", "X2 A5", "window_start date, window_end date, event_type string, events bigint, "
          "total_value double", sql=f"""
WITH w AS (SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end,
                  event_type, value FROM events)
SELECT window_start, window_end, event_type, count(*) AS events, {xsum_sql('value')} AS total_value
FROM w GROUP BY 1, 2, 3""")
def stream_daily_totals(spark, sf_dir):
    return _all_windows(spark, sf_dir, "daily")


@register("stream_sliding_7d", "X2 W6", "window_start date, window_end date, event_type string, events bigint, "
          "total_value double", sql=f"""
WITH w AS (SELECT date_trunc('day', ts) - k * INTERVAL 1 DAY AS window_start,
                  date_trunc('day', ts) - k * INTERVAL 1 DAY + INTERVAL 7 DAY AS window_end, event_type, value
           FROM events, range(0, 7) t(k))
SELECT window_start, window_end, event_type, count(*) AS events, {xsum_sql('value')} AS total_value
FROM w GROUP BY 1, 2, 3""")
def stream_sliding_7d(spark, sf_dir):
    return _all_windows(spark, sf_dir, "sliding", "7 days", "1 day")


@register("stream_surge_alerts", "X3 E3", "event_type string, window_start date, total_value double, "
          "previous_total double, change_pct double, alert string", sql=f"""
WITH w AS (SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end,
                  event_type, value FROM events),
d AS (SELECT window_start, event_type, {xsum_sql('value')} AS total_value FROM w GROUP BY 1, 2),
l AS (SELECT *, lag(total_value) OVER (PARTITION BY event_type ORDER BY window_start) AS previous_total FROM d)
SELECT event_type, window_start, total_value, previous_total,
       CASE WHEN previous_total <> 0 THEN (total_value - previous_total) / previous_total * 100.0 END AS change_pct,
       CASE WHEN previous_total <> 0 AND (total_value - previous_total) / previous_total * 100.0 > 15 THEN 'surge'
            WHEN previous_total <> 0 AND (total_value - previous_total) / previous_total * 100.0 < -15 THEN 'drop' END AS alert
FROM l""")
def stream_surge_alerts(spark, sf_dir):
    return ev.run_surge_alerts(ev.windowed_totals(ev.event_stream(spark, sf_dir)), "surge",
                               ev.open_windows(ev.events_batch(spark, sf_dir)))
