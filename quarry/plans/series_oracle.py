"""DuckDB SQL for the series queries that SQL can express."""

from __future__ import annotations

from quarry.plans import series_queries as Q
from quarry.sources.standins import EVENT_SLOTS

D = Q.DEC

SERIES = f"""
cells AS (
  SELECT 'u' || user_id AS station, event_type AS measurement, CAST(year(ts) AS INTEGER) AS year,
         CAST(hour(ts) // 3 AS INTEGER) AS slot, avg(value) AS v
  FROM events GROUP BY ALL),
keys AS (SELECT station, measurement, year, max(slot) + 1 AS len FROM cells GROUP BY ALL),
every_cell AS (
  SELECT k.station, k.measurement, k.year, k.len, CAST(g.slot AS INTEGER) AS slot, c.v
  FROM keys k JOIN range(0, {EVENT_SLOTS}) g(slot) ON g.slot < k.len
  LEFT JOIN cells c ON c.station = k.station AND c.measurement = k.measurement AND c.year = k.year AND c.slot = g.slot),
every_series AS (SELECT station, measurement, year, list(v ORDER BY slot) AS vals FROM every_cell GROUP BY ALL),
grid AS (SELECT * FROM every_cell WHERE len = {EVENT_SLOTS}),
series AS (SELECT station, measurement, year, list(v ORDER BY slot) AS vals FROM grid GROUP BY ALL),
vals AS (SELECT station, measurement, year, slot, v AS value FROM grid WHERE v IS NOT NULL AND NOT isnan(v)),
scal AS (
  SELECT measurement, avg(value) AS mean, stddev_pop(value) AS std,
         quantile_disc(value, 0.001) AS low1000, quantile_disc(value, 0.01) AS low100,
         quantile_disc(value, 0.99) AS high100, quantile_disc(value, 0.999) AS high1000
  FROM vals GROUP BY measurement)
"""


def _w(body: str) -> str:
    return "WITH " + SERIES.strip() + "\n" + body


ORACLE = {
    "scan_station_series": _w(f"SELECT station, measurement, year, list_transform(vals, lambda x: round(x, {D})) AS \"values\" FROM every_series"),
    "flatten_series": _w(f"SELECT station, measurement, year, list_transform(vals, lambda x: round(x, {D})) AS \"values\" FROM every_series"),
    "valid_length": _w(f"""SELECT measurement, CAST(sum(CASE WHEN len(vals) = {EVENT_SLOTS} THEN 1 ELSE 0 END) AS BIGINT) AS n_valid,
  CAST(sum(CASE WHEN len(vals) = {EVENT_SLOTS} THEN 0 ELSE 1 END) AS BIGINT) AS n_invalid FROM every_series GROUP BY measurement"""),
    "by_measurement": _w("SELECT measurement, count(*) AS n_series FROM series GROUP BY measurement"),
    "slot_counts": _w("SELECT measurement, slot, count(*) AS ne FROM vals GROUP BY measurement, slot"),
    "scan_series_stats": _w(f"""SELECT measurement, 'slot' AS kind, slot AS index,
  [CAST(count(*) AS DOUBLE), round(avg(value), {D}), round(var_pop(value), {D})] AS "values" FROM vals GROUP BY measurement, slot
UNION ALL SELECT measurement, 'scalar', NULL, [round(mean, {D}), round(std, {D}), round(low1000, {D}), round(low100, {D}), round(high100, {D}), round(high1000, {D})] FROM scal
UNION ALL SELECT measurement, 'basis', NULL, [{EVENT_SLOTS}.0, round(sum(var), {D}), 0.0] FROM (
  SELECT measurement, slot, var_pop(value) AS var FROM vals GROUP BY measurement, slot) GROUP BY measurement"""),
    "slot_mean_band": _w(f"""SELECT measurement, slot, round(avg(value), {D}) AS mean, round(sqrt(var_pop(value)), {D}) AS std,
  round(avg(value) - sqrt(var_pop(value)), {D}) AS lower, round(avg(value) + sqrt(var_pop(value)), {D}) AS upper
FROM vals GROUP BY measurement, slot"""),
    "scalar_quantiles": _w(f"""SELECT measurement, round(mean, {D}) AS mean, round(std, {D}) AS std, round(low1000, {D}) AS low1000,
  round(low100, {D}) AS low100, round(high100, {D}) AS high100, round(high1000, {D}) AS high1000 FROM scal"""),
    "value_histogram": _w("""SELECT v.measurement, CAST(CASE WHEN s.high100 - s.low100 > 0
    THEN least(floor((v.value - s.low100) / (s.high100 - s.low100) * 100), 99) ELSE 0 END AS INTEGER) AS bin, count(*) AS cnt
FROM vals v JOIN scal s USING (measurement) WHERE v.value BETWEEN s.low100 AND s.high100 GROUP BY ALL"""),
    "in_range_not_nan": _w("""SELECT v.measurement, count(*) AS n_in_range FROM vals v JOIN scal s USING (measurement)
WHERE v.value BETWEEN s.low100 AND s.high100 GROUP BY v.measurement"""),
    "uneven_stations": _w(f"""SELECT station, round(count_var, {D}) AS count_var FROM (
  SELECT station, (count(*) * sum(n * n) - sum(n) * sum(n)) / CAST(count(*) * count(*) AS DOUBLE) AS count_var FROM (
    SELECT station, slot, sum(CASE WHEN v IS NOT NULL THEN 1 ELSE 0 END) AS n FROM grid GROUP BY station, slot)
  GROUP BY station) WHERE count_var > {Q.UNEVEN_THRESHOLD}"""),
    "reconstruct_full": _w(f"""SELECT station, measurement, year, list(round(coalesce(v, mean) + {Q.OFF_TIE}, {D}) ORDER BY slot) AS rebuilt
FROM grid JOIN (SELECT measurement, slot, avg(value) AS mean FROM vals GROUP BY measurement, slot) USING (measurement, slot)
GROUP BY station, measurement, year"""),
    "drop_nan_error": _w(f"""SELECT measurement, count(*) AS n_kept FROM series
WHERE len(vals) = {EVENT_SLOTS} AND len(list_filter(vals, lambda x: x IS NULL OR isnan(x))) = 0 GROUP BY measurement"""),
    "series_covariance": _w(f"""SELECT a.measurement, a.slot AS i, b.slot AS j, count(*) AS n,
  round(sum(a.value * b.value) / count(*) - (sum(a.value) / count(*)) * (sum(b.value) / count(*)), {D}) AS cov
FROM vals a JOIN vals b ON a.station = b.station AND a.measurement = b.measurement AND a.year = b.year
GROUP BY a.measurement, a.slot, b.slot"""),
}
