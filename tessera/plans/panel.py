"""Panel feature queries over ``events`` (user x time)
and ``orders`` (customer x date)."""
from __future__ import annotations


from ..operators import aggregates as A
from .registry import register

PANEL_COLS = ("user_id:i n:i mean:f median:f min:f max:f range:f iqr:f std:f mad:f "
              "count_positive:i count_above_mean:i pct_above_mean:f last:f")


@register("a13_panel_summary", "A13 A1 A2 A3 A4 A8 A10 A11 A12 W17 S5 O1", PANEL_COLS, sql="""
WITH s AS (
  SELECT user_id, count(value) AS n,
         sum(CAST(value AS DECIMAL(38,6))) AS sdec,
         CAST(sum(CAST(value AS DECIMAL(38,6))) AS DOUBLE) / count(value) AS mean,
         median(value) AS median,
         quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3,
         min(value) AS min, max(value) AS max, stddev_samp(value) AS sd,
         arg_max(value, (ts, event_id)) AS last
  FROM events GROUP BY user_id),
d AS (
  SELECT e.user_id,
         CAST(sum(abs(CAST(e.value AS DECIMAL(38,6)) * s.n - s.sdec)) AS DOUBLE) / (s.n * s.n) AS mad,
         count(*) FILTER (WHERE e.value > 0) AS count_positive,
         count(*) FILTER (WHERE CAST(e.value AS DECIMAL(38,6)) * s.n > s.sdec) AS count_above_mean
  FROM events e JOIN s USING (user_id) GROUP BY e.user_id, s.n)
SELECT s.user_id, n, mean, median, min, max,
       CASE WHEN n = 1 THEN 0 ELSE max - min END AS range,
       CASE WHEN n = 1 THEN 0 ELSE q3 - q1 END AS iqr,
       CASE WHEN n = 1 THEN 0 ELSE sd END AS std,
       mad, count_positive, count_above_mean,
       CASE WHEN n = 1 THEN 0 ELSE count_above_mean / n END AS pct_above_mean,
       last
FROM s JOIN d USING (user_id)
""")
def a13_panel_summary(t):
    """Per-user summary of event values ordered by (ts, event_id)."""
    return A.panel_summary(t.events, "user_id", "value", ["ts", "event_id"])
