"""DuckDB SQL of the time-series, history, ranking, owner and typed-ingest queries."""

from __future__ import annotations

from .params import CENSUS_DATES, STORM_MAX_LAG_HOURS
from .plans.weather import DRAG, SERIES
from .sources.adapters import OWNERS_SQL, READINGS_SQL

_CLEAN = f"""readings AS ({READINGS_SQL.replace("{events}", "events")}),
clean AS (
  SELECT series, time_tag, value, reading_id FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY series, time_tag ORDER BY reading_id) AS rn
    FROM (SELECT series, TRY_CAST(time_tag AS TIMESTAMP) AS time_tag,
                 TRY_CAST(value AS DOUBLE) AS value, reading_id FROM readings) t
    WHERE time_tag IS NOT NULL AND value IS NOT NULL AND isfinite(value)) r WHERE rn = 1),
hourly AS (
  SELECT series, date_trunc('hour', time_tag) AS hour,
         CAST(SUM(CAST(value AS DECIMAL(38,6))) AS DOUBLE) / COUNT(*) AS value, COUNT(*) AS n
  FROM clean GROUP BY 1, 2)"""


def _merge() -> str:
    names = ", ".join(f"'{s}'" for s in SERIES)
    columns = ",\n  ".join(
        f"MAX(value) FILTER (series = '{s}') AS {s}, "
        f"CAST(COALESCE(MAX(n) FILTER (series = '{s}'), 0) AS BIGINT) AS {s}_n, "
        f"MAX(filled) FILTER (series = '{s}') AS {s}_filled, "
        f"MAX(age) FILTER (series = '{s}') AS {s}_age_hours" for s in SERIES)
    return f"""WITH {_CLEAN},
wanted AS (SELECT * FROM hourly WHERE series IN ({names})),
slots AS (
  SELECT h.hour, s.series
  FROM (SELECT unnest(generate_series((SELECT MIN(hour) FROM wanted), (SELECT MAX(hour) FROM wanted),
                                      INTERVAL 1 HOUR)) AS hour) h,
       (SELECT unnest([{names}]) AS series) s),
filled AS (
  SELECT hour, series, value, n, LAST_VALUE(value IGNORE NULLS) OVER w AS filled,
         date_diff('hour', LAST_VALUE(CASE WHEN value IS NOT NULL THEN hour END IGNORE NULLS) OVER w,
                   hour) AS age
  FROM slots LEFT JOIN wanted USING (hour, series)
  WINDOW w AS (PARTITION BY series ORDER BY hour ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT hour, {columns} FROM filled GROUP BY hour"""


def queries(with_: "callable", decay: str, trend: str) -> dict[str, str]:
    """``with_`` gives the WITH clause of the feeds and objects, ``decay`` and ``trend``
    the SQL of the tables that some of these queries rank or rebuild."""
    q = {}
    q["clean_readings"] = f"WITH {_CLEAN} SELECT series, time_tag, value, reading_id FROM clean"
    q["clean_readings_stream"] = f"WITH {_CLEAN} SELECT series, time_tag, value FROM clean"
    q["solar_weather"] = _merge()
    q["storm_impact"] = f"""WITH {_CLEAN}
SELECT CAST(lag AS INTEGER) AS lag, COUNT(*) AS pairs, corr(x.value, y.value) AS correlation,
       regr_slope(y.value, x.value) AS slope
FROM (SELECT unnest(range(0, {STORM_MAX_LAG_HOURS + 1})) AS lag) l
JOIN hourly x ON x.series = 'kp'
JOIN hourly y ON y.series = '{DRAG}' AND y.hour = x.hour + lag * INTERVAL 1 HOUR
GROUP BY lag"""
    q["elements_as_of"] = with_() + """
, states AS (
  SELECT * FROM (
    SELECT TRY_CAST(NORAD_CAT_ID AS INTEGER) AS norad_cat_id,
           date_trunc('month', _ingestion_ts) AS collection, SATNAME AS object_name,
           TRY_CAST(APOGEE AS INTEGER) AS apogee_km, TRY_CAST(PERIGEE AS INTEGER) AS perigee_km,
           ROW_NUMBER() OVER (PARTITION BY TRY_CAST(NORAD_CAT_ID AS INTEGER),
                                           date_trunc('month', _ingestion_ts)
                              ORDER BY _ingestion_ts DESC, _seq DESC) AS k
    FROM satcat_like) x WHERE k = 1),
sets AS (
  SELECT * FROM (
    SELECT TRY_CAST(NORAD_CAT_ID AS INTEGER) AS norad_cat_id, TRY_CAST(EPOCH AS TIMESTAMP) AS epoch,
           TRY_CAST(MEAN_MOTION AS DOUBLE) AS mean_motion,
           TRY_CAST(INCLINATION AS DOUBLE) AS inclination, TRY_CAST(BSTAR AS DOUBLE) AS bstar,
           ROW_NUMBER() OVER (PARTITION BY TRY_CAST(NORAD_CAT_ID AS INTEGER), TRY_CAST(EPOCH AS TIMESTAMP)
                              ORDER BY _ingestion_ts DESC, _seq DESC) AS k
    FROM gp_like) x WHERE k = 1)
SELECT s.norad_cat_id, s.collection, s.object_name, s.apogee_km, s.perigee_km,
       g.epoch, g.mean_motion, g.inclination, g.bstar
FROM states s ASOF LEFT JOIN sets g
  ON s.norad_cat_id = g.norad_cat_id AND s.collection + INTERVAL 1 MONTH >= g.epoch"""
    dates = ", ".join(f"DATE '{d}'" for d in CENSUS_DATES)
    q["census_at_dates"] = with_() + f"""
, per_run AS (
  SELECT * FROM (
    SELECT TRY_CAST(NORAD_CAT_ID AS INTEGER) AS norad_cat_id,
           date_trunc('month', _ingestion_ts) AS collection, OBJECT_TYPE AS object_type,
           COUNTRY AS country, TRY_CAST(APOGEE AS INTEGER) AS a, TRY_CAST(PERIGEE AS INTEGER) AS p,
           ROW_NUMBER() OVER (PARTITION BY TRY_CAST(NORAD_CAT_ID AS INTEGER),
                                           date_trunc('month', _ingestion_ts)
                              ORDER BY _ingestion_ts DESC, _seq DESC) AS k
    FROM satcat_like) x WHERE k = 1),
standing AS (
  SELECT * FROM (
    SELECT r.*, d.census_date,
           ROW_NUMBER() OVER (PARTITION BY d.census_date, r.norad_cat_id ORDER BY r.collection DESC) AS last
    FROM per_run r JOIN (SELECT unnest([{dates}]) AS census_date) d ON r.collection <= d.census_date) x
  WHERE last = 1)
SELECT object_type, CASE WHEN a < 2000 THEN 'LEO' WHEN p >= 2000 AND a < 35000 THEN 'MEO'
                         WHEN p >= 35000 AND a <= 36500 THEN 'GEO' WHEN a >= 36500 THEN 'HEO'
                         ELSE 'UNKNOWN' END AS orbital_regime,
       country, census_date, COUNT(*) AS object_count
FROM standing GROUP BY ALL"""
    q["altitude_trend_history"] = trend
    ranked = f"""SELECT norad_cat_id, object_name, perigee_km, decay_risk,
       ROW_NUMBER() OVER (ORDER BY perigee_km NULLS LAST, norad_cat_id NULLS LAST) AS rank
FROM ({decay}) d"""
    q["decay_ranks"] = with_() + ranked
    q["decay_deep_page"] = with_(f"ranked AS ({ranked})") + """
SELECT * FROM ranked WHERE (rank - 1) // 20 = GREATEST((SELECT COUNT(*) FROM ranked) // 20 - 1, 0)"""
    owners = OWNERS_SQL.replace("{customer}", "customer").replace("{nation}", "nation")
    q["owner_enrichment"] = with_(f"""owners AS (
  SELECT * FROM (SELECT *, TRY_CAST(NORAD_CAT_ID AS INTEGER) AS id,
                        ROW_NUMBER() OVER (PARTITION BY NORAD_CAT_ID ORDER BY _seq DESC) AS k
                 FROM ({owners}) x) y WHERE k = 1)""") + """
SELECT o.norad_cat_id, o.object_name, o.object_category, o.country, w.operator, w.operator_country,
       w.purpose, TRY_CAST(w.launch_mass_kg AS DOUBLE) AS launch_mass_kg
FROM objects o LEFT JOIN owners w ON w.id = o.norad_cat_id WHERE o.norad_cat_id IS NOT NULL"""
    q["bronze_types"] = """SELECT * FROM (VALUES ('id', 'bigint'), ('mixed', 'variant'),
  ('nested', 'struct<tags:array<string>,urgent:boolean>'), ('price', 'double'),
  ('priority', 'string')) t(field, type) WHERE EXISTS (SELECT 1 FROM orders)"""
    q["bronze_typed"] = """SELECT o_orderkey AS id, o_totalprice AS price, o_orderpriority AS priority,
  CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_custkey AS VARCHAR)
       ELSE '"c' || o_custkey || '"' END AS mixed,
  o_orderkey % 5 = 0 AS urgent, 'o+' || o_orderstatus AS tags FROM orders"""
    return q
