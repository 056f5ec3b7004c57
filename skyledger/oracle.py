"""Independent SQL formulations of the registered queries (DuckDB dialect).

The driver runs these next to the Spark queries and compares results.  They
are written from the table definitions, not generated from the Spark code:
windows are ``ROW_NUMBER`` filters, ratios use integer arithmetic for the
HALF_UP rounding, averages of integers are ``sum / count``.
"""

from __future__ import annotations

from .params import (GLOBE_DIGITS, POSITION_STEP_SECONDS, POSITION_STEPS, POSITION_T0, SNAPSHOT_CUTOFF,
                     SNAPSHOT_DATE)

from .sources.adapters import GP_LIKE_SQL, SATCAT_LIKE_SQL

SATCAT_LIKE = SATCAT_LIKE_SQL.replace("{orders}", "orders")
GP_LIKE = GP_LIKE_SQL.replace("{orders}", "orders")

# Unified object table: typed, newest per id on both feeds, left join, classes.
_OBJECTS = r"""
satcat_like AS ({satcat}),
gp_like AS ({gp}),
sat_ranked AS (
  SELECT TRY_CAST(NORAD_CAT_ID AS INTEGER) AS norad_cat_id,
         SATNAME AS object_name, OBJECT_ID AS intl_designator,
         OBJECT_TYPE AS object_type, COUNTRY AS country,
         TRY_CAST(LAUNCH AS DATE) AS launch_date, TRY_CAST(DECAY AS DATE) AS decay_date,
         TRY_CAST(PERIOD AS DOUBLE) AS period_min,
         TRY_CAST(APOGEE AS INTEGER) AS apogee_km, TRY_CAST(PERIGEE AS INTEGER) AS perigee_km,
         RCS_SIZE AS rcs_size, CURRENT_FLAG AS is_current,
         ROW_NUMBER() OVER (PARTITION BY TRY_CAST(NORAD_CAT_ID AS INTEGER)
                            ORDER BY _ingestion_ts DESC NULLS LAST, _seq DESC NULLS LAST) AS rn
  FROM satcat_like),
gp_ranked AS (
  SELECT TRY_CAST(NORAD_CAT_ID AS INTEGER) AS norad_cat_id,
         TRY_CAST(EPOCH AS TIMESTAMP) AS epoch,
         TRY_CAST(MEAN_MOTION AS DOUBLE) AS mean_motion,
         TRY_CAST(ECCENTRICITY AS DOUBLE) AS eccentricity,
         TRY_CAST(INCLINATION AS DOUBLE) AS inclination,
         TRY_CAST(RA_OF_ASC_NODE AS DOUBLE) AS ra_of_asc_node,
         TRY_CAST(ARG_OF_PERICENTER AS DOUBLE) AS arg_of_pericenter,
         TRY_CAST(MEAN_ANOMALY AS DOUBLE) AS mean_anomaly,
         TRY_CAST(BSTAR AS DOUBLE) AS bstar,
         TRY_CAST(REV_AT_EPOCH AS INTEGER) AS rev_at_epoch,
         TLE_LINE1 AS tle_line1, TLE_LINE2 AS tle_line2,
         ROW_NUMBER() OVER (PARTITION BY TRY_CAST(NORAD_CAT_ID AS INTEGER)
                            ORDER BY TRY_CAST(EPOCH AS TIMESTAMP) DESC NULLS LAST,
                                     _ingestion_ts DESC NULLS LAST, _seq DESC NULLS LAST) AS rn
  FROM gp_like),
objects AS (
  SELECT s.norad_cat_id, s.object_name, s.intl_designator, s.object_type, s.country,
         s.launch_date, s.decay_date, s.period_min, s.apogee_km, s.perigee_km,
         s.rcs_size, s.is_current,
         g.epoch, g.mean_motion, g.eccentricity, g.inclination, g.ra_of_asc_node,
         g.arg_of_pericenter, g.mean_anomaly, g.bstar, g.rev_at_epoch,
         g.tle_line1, g.tle_line2,
         CASE WHEN s.apogee_km < 2000 THEN 'LEO'
              WHEN s.perigee_km >= 2000 AND s.apogee_km < 35000 THEN 'MEO'
              WHEN s.perigee_km >= 35000 AND s.apogee_km <= 36500 THEN 'GEO'
              WHEN s.apogee_km >= 36500 THEN 'HEO'
              ELSE 'UNKNOWN' END AS orbital_regime,
         CASE WHEN s.object_type = 'PAYLOAD' AND s.decay_date IS NULL THEN 'active_payload'
              WHEN s.object_type = 'PAYLOAD' AND s.decay_date IS NOT NULL THEN 'defunct_payload'
              WHEN s.object_type = 'ROCKET BODY' THEN 'rocket_body'
              WHEN s.object_type = 'DEBRIS' THEN 'debris'
              ELSE 'unknown' END AS object_category,
         s.object_type = 'DEBRIS' AS is_debris,
         (s.object_type = 'PAYLOAD') AND s.decay_date IS NULL AS is_active
  FROM sat_ranked s
  LEFT JOIN gp_ranked g ON g.norad_cat_id = s.norad_cat_id AND g.rn = 1
  WHERE s.rn = 1)
""".format(satcat=SATCAT_LIKE, gp=GP_LIKE)


def _with(*extra: str) -> str:
    parts = [_OBJECTS.strip()] + [e.strip() for e in extra]
    return "WITH " + ",\n".join(parts) + "\n"


def _ratio(n: str, d: str) -> str:
    """HALF_UP(n / d, 4) for non-negative counts, exact integer arithmetic."""
    return (f"CASE WHEN {d} <> 0 THEN CAST((2 * {n} * 10000 + {d}) // (2 * {d}) AS DOUBLE)"
            f" / 10000 END")


def _mean_int(c: str) -> str:
    return f"CAST(SUM({c}) AS DOUBLE) / COUNT({c})"


_COUNTIF = "CAST(SUM(CASE WHEN {p} THEN 1 ELSE 0 END) AS BIGINT)"


def _cif(p: str) -> str:
    return _COUNTIF.format(p=p)


CENSUS = f"""
  SELECT object_type, orbital_regime, country,
         COUNT(*) AS object_count,
         {_cif('is_active')} AS active_count,
         {_cif('is_debris')} AS debris_count,
         {_mean_int('apogee_km')} AS avg_apogee_km,
         {_mean_int('perigee_km')} AS avg_perigee_km,
         DATE '{SNAPSHOT_DATE}' AS snapshot_date
  FROM objects GROUP BY object_type, orbital_regime, country
"""

CONGESTION = f"""
  SELECT altitude_band_km, total_objects, debris_count, active_count,
         avg_eccentricity, avg_inclination,
         {_ratio('debris_count', 'total_objects')} AS debris_ratio,
         CASE WHEN total_objects >= 500 THEN 'critical'
              WHEN total_objects >= 200 THEN 'high'
              WHEN total_objects >= 50 THEN 'moderate' ELSE 'low' END AS congestion_level
  FROM (
    SELECT CAST(FLOOR(apogee_km / 50) * 50 AS INTEGER) AS altitude_band_km,
           COUNT(*) AS total_objects,
           {_cif('is_debris')} AS debris_count,
           {_cif('is_active')} AS active_count,
           CAST(SUM(CAST(eccentricity AS DECIMAL(38,12))) AS DOUBLE) / COUNT(eccentricity) AS avg_eccentricity,
           CAST(SUM(CAST(inclination AS DECIMAL(38,12))) AS DOUBLE) / COUNT(inclination) AS avg_inclination
    FROM objects WHERE apogee_km IS NOT NULL
    GROUP BY 1) b
"""

LEADERBOARD = f"""
  SELECT country, total_objects, payload_count, active_count, debris_count, rocket_body_count,
         {_ratio('debris_count', 'total_objects')} AS debris_ratio,
         {_ratio('active_count', 'total_objects')} AS active_ratio
  FROM (
    SELECT country, COUNT(*) AS total_objects,
           {_cif("object_type = 'PAYLOAD'")} AS payload_count,
           {_cif('is_active')} AS active_count,
           {_cif('is_debris')} AS debris_count,
           {_cif("object_type = 'ROCKET BODY'")} AS rocket_body_count
    FROM objects GROUP BY country) c
"""

CONSTELLATION = f"""
  SELECT constellation, COUNT(*) AS total_objects,
         {_cif('is_active')} AS active_count,
         {_cif('is_debris')} AS debris_count,
         {_mean_int('apogee_km')} AS avg_altitude_km,
         MIN(launch_date) AS first_launch, MAX(launch_date) AS latest_launch
  FROM (
    SELECT *, CASE WHEN upper(object_name) LIKE '%STARLINK%' THEN 'Starlink'
                   WHEN upper(object_name) LIKE '%ONEWEB%' THEN 'OneWeb'
                   WHEN upper(object_name) LIKE '%KUIPER%' THEN 'Kuiper'
                   WHEN upper(object_name) LIKE '%IRIDIUM%' THEN 'Iridium'
                   WHEN upper(object_name) LIKE '%GLOBALSTAR%' THEN 'Globalstar' END AS constellation
    FROM objects) x
  WHERE constellation IS NOT NULL
  GROUP BY constellation
"""

DECAY = """
  SELECT norad_cat_id, object_name, object_type, country, apogee_km, perigee_km,
         inclination, bstar, epoch, launch_date, orbital_regime,
         CASE WHEN perigee_km < 200 THEN 'imminent'
              WHEN perigee_km < 300 THEN 'high' ELSE 'moderate' END AS decay_risk
  FROM objects
  WHERE perigee_km < 400 AND decay_date IS NULL AND bstar IS NOT NULL
"""

GLOBE = """
  SELECT norad_cat_id, object_name, object_type, country, orbital_regime, tle_line1, tle_line2
  FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY orbital_regime ORDER BY norad_cat_id NULLS LAST) AS rn
    FROM objects
    WHERE tle_line1 IS NOT NULL AND tle_line2 IS NOT NULL
      AND orbital_regime IN ('LEO', 'MEO', 'GEO')) r
  WHERE rn <= CASE orbital_regime WHEN 'LEO' THEN 3750 WHEN 'MEO' THEN 650 ELSE 600 END
"""

FRAGMENTATION = r"""
WITH satcat_like AS ({satcat}),
latest AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY NORAD_CAT_ID
                               ORDER BY _ingestion_ts DESC NULLS LAST, _seq DESC NULLS LAST) AS rn
  FROM satcat_like),
debris AS (
  SELECT TRY_CAST(NORAD_CAT_ID AS INTEGER) AS norad_cat_id, SATNAME AS object_name,
         COUNTRY AS country, TRY_CAST(LAUNCH AS DATE) AS launch_date,
         regexp_extract(OBJECT_ID, '^(\d{{4}}-\d{{3}})', 1) AS launch_id
  FROM latest WHERE rn = 1 AND OBJECT_TYPE = 'DEBRIS')
SELECT launch_id, country, COUNT(*) AS debris_count, MIN(launch_date) AS event_date,
       arg_min(object_name, norad_cat_id) AS sample_object_name,
       CASE WHEN COUNT(*) >= 1000 THEN 'catastrophic' WHEN COUNT(*) >= 100 THEN 'major'
            WHEN COUNT(*) >= 10 THEN 'minor' ELSE 'insignificant' END AS severity
FROM debris
GROUP BY launch_id, country
HAVING COUNT(*) >= 10
""".format(satcat=SATCAT_LIKE)


def queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["space_objects"] = _with() + "SELECT * FROM objects"
    q["fragmentation_events"] = FRAGMENTATION
    q["orbital_census"] = _with() + CENSUS
    q["census_by_type"] = _with() + (
        f"SELECT object_type, COUNT(*) AS count, {_cif('is_active')} AS active_count "
        "FROM objects GROUP BY object_type")
    q["census_by_regime"] = _with() + (
        "SELECT orbital_regime, COUNT(*) AS count FROM objects GROUP BY orbital_regime")
    q["census_by_country"] = _with() + (
        "SELECT country, COUNT(*) AS count FROM objects GROUP BY country")
    q["census_grouping_sets"] = _with() + f"""
      SELECT object_type, orbital_regime, country, COUNT(*) AS object_count,
             {_cif('is_active')} AS active_count, {_cif('is_debris')} AS debris_count,
             CAST(GROUPING(object_type) AS INTEGER) AS g_type,
             CAST(GROUPING(orbital_regime) AS INTEGER) AS g_regime,
             CAST(GROUPING(country) AS INTEGER) AS g_country
      FROM objects
      GROUP BY GROUPING SETS ((object_type, orbital_regime, country), (object_type),
                              (orbital_regime), (country))"""
    q["congestion_metrics"] = _with() + CONGESTION
    q["country_leaderboard"] = _with() + LEADERBOARD
    q["constellation_growth"] = _with() + CONSTELLATION
    q["decay_tracker"] = _with() + DECAY
    q["globe_data"] = _with() + GLOBE
    q["quality_report"] = _with() + """
      SELECT COUNT(*) AS rows,
             CAST(SUM(CASE WHEN norad_cat_id IS NOT NULL THEN 0 ELSE 1 END) AS BIGINT) AS valid_norad_id,
             CAST(SUM(CASE WHEN object_name IS NOT NULL THEN 0 ELSE 1 END) AS BIGINT) AS valid_object_name
      FROM objects"""
    q.update(panel_queries())
    q["bronze_satcat"] = ("WITH satcat_like AS (" + SATCAT_LIKE + ") SELECT NORAD_CAT_ID, SATNAME, "
                          "OBJECT_ID, OBJECT_TYPE, COUNTRY, LAUNCH, DECAY, PERIOD, APOGEE, PERIGEE, "
                          "RCS_SIZE, CURRENT_FLAG FROM satcat_like")
    q["bronze_gp"] = ("WITH gp_like AS (" + GP_LIKE + ") SELECT NORAD_CAT_ID, EPOCH, MEAN_MOTION, "
                      "ECCENTRICITY, INCLINATION, RA_OF_ASC_NODE, ARG_OF_PERICENTER, MEAN_ANOMALY, "
                      "BSTAR, REV_AT_EPOCH, TLE_LINE1, TLE_LINE2 FROM gp_like")
    from . import oracle_positions as OP
    q["tle_fields"] = OP.tle_fields_sql()
    q["position_grid"] = OP.position_grid_sql(POSITION_T0, POSITION_STEPS, POSITION_STEP_SECONDS)
    q["tle_full_fields"] = OP.tle_full_fields_sql()
    q["globe_positions"] = OP.globe_positions_sql(POSITION_T0, POSITION_STEPS,
                                                  POSITION_STEP_SECONDS, GLOBE_DIGITS)
    q["space_objects_from_bronze"] = q["space_objects"]
    q["latest_satcat_stream"] = _with() + """
      SELECT norad_cat_id, object_name, intl_designator, object_type, country, launch_date,
             decay_date, period_min, apogee_km, perigee_km, rcs_size, is_current
      FROM sat_ranked WHERE rn = 1"""
    q["bronze_evolved"] = q["bronze_satcat"].replace(
        "RCS_SIZE, CURRENT_FLAG FROM",
        f"CASE WHEN _ingestion_ts >= TIMESTAMP '{SNAPSHOT_CUTOFF}' THEN RCS_SIZE END AS RCS_SIZE, "
        "CURRENT_FLAG FROM")
    month = "strftime(date_trunc('month', _ingestion_ts), '%Y-%m-%dT%H:%M:%SZ')"
    q["bronze_lineage"] = f"""
      WITH satcat_like AS ({SATCAT_LIKE})
      SELECT {month} AS collected_at, COUNT(*) AS records, 0 AS first_index,
             CAST(0 AS BIGINT) AS without_lineage
      FROM satcat_like GROUP BY 1"""
    q["file_inventory"] = f"""
      WITH satcat_like AS ({SATCAT_LIKE})
      SELECT COUNT(*) AS files, TRUE AS has_bytes FROM (
        SELECT DISTINCT {month}, _seq // 100000 FROM satcat_like) f"""
    q["raw_quality_report"] = f"""
      WITH satcat_like AS ({SATCAT_LIKE})
      SELECT COUNT(*) AS rows,
             COUNT(*) FILTER (WHERE OBJECT_ID IS NULL) AS valid_object_id,
             COUNT(*) FILTER (WHERE OBJECT_ID IS NULL OR OBJECT_ID NOT LIKE '____-%')
               AS valid_designator,
             COUNT(*) FILTER (WHERE DECAY IS NULL) AS decayed
      FROM satcat_like"""
    q["epoch_dates"] = _with() + """
      SELECT strftime(epoch, '%Y-%m-%d') AS epoch_date, COUNT(*) AS objects
      FROM objects WHERE epoch IS NOT NULL GROUP BY 1"""
    q["named_table"] = _with() + LEADERBOARD.replace(
        "SELECT country, total_objects,", "SELECT 'gold' AS layer, country, total_objects,", 1)
    for name, body in (("orbital_census", CENSUS), ("congestion_metrics", CONGESTION),
                       ("country_leaderboard", LEADERBOARD),
                       ("constellation_growth", CONSTELLATION), ("globe_data", GLOBE)):
        q[f"export_round_trip_{name}"] = _with() + body
    q.update(history_queries(SNAPSHOT_CUTOFF))
    q["export_round_trip"] = _with() + DECAY
    names = sorted(["orbital_census", "congestion_metrics", "country_leaderboard",
                    "constellation_growth", "decay_tracker", "globe_data"])
    endpoints = "{" + ",".join(f'"{n}":"{n}.json"' for n in names) + "}"
    q["export_manifest"] = _with(*_gold_ctes()[:6]) + f"""
      SELECT '{",".join(names)}' AS tables,
             '{endpoints}' AS endpoints,
             CAST((SELECT COUNT(*) FROM census) + (SELECT COUNT(*) FROM congestion)
                + (SELECT COUNT(*) FROM leaderboard) + (SELECT COUNT(*) FROM growth)
                + (SELECT COUNT(*) FROM decay) + (SELECT COUNT(*) FROM globe) AS BIGINT) AS total_rows"""
    ctes = {"orbital_census": "census", "congestion_metrics": "congestion",
            "country_leaderboard": "leaderboard", "constellation_growth": "growth",
            "decay_tracker": "decay", "globe_data": "globe"}
    q["export_rows"] = _with(*_gold_ctes()) + " UNION ALL ".join(
        f"SELECT '{n}' AS \"table\", COUNT(*) AS rows, TRUE AS agrees FROM {c}"
        for n, c in sorted(ctes.items()))
    return q


def _gold_ctes() -> list[str]:
    return [f"census AS ({CENSUS})", f"congestion AS ({CONGESTION})",
            f"leaderboard AS ({LEADERBOARD})", f"growth AS ({CONSTELLATION})",
            f"decay AS ({DECAY})", f"globe AS ({GLOBE})"]


def _g(body: str) -> str:
    return _with(*_gold_ctes()) + body


def _thousands(c: str) -> str:
    return f"format('{{:,}}', {c})"


def _percent(c: str) -> str:
    return f"printf('%.1f%%', ROUND(CAST({c} AS DECIMAL(30,10)) * 100, 1))"


def panel_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["rollup_by_type"] = _g(
        "SELECT object_type, CAST(SUM(object_count) AS BIGINT) AS object_count "
        "FROM census GROUP BY object_type")
    q["regime_breakdown"] = _g("""
      SELECT orbital_regime,
             CAST(SUM(CASE WHEN object_type = 'PAYLOAD' THEN object_count ELSE 0 END) AS BIGINT) AS payload,
             CAST(SUM(CASE WHEN object_type = 'DEBRIS' THEN object_count ELSE 0 END) AS BIGINT) AS debris,
             CAST(SUM(CASE WHEN object_type = 'PAYLOAD' OR object_type = 'DEBRIS' THEN 0
                           ELSE object_count END) AS BIGINT) AS rocket_body,
             CASE orbital_regime WHEN 'LEO' THEN 'Low Earth Orbit'
                  WHEN 'MEO' THEN 'Medium Earth Orbit' WHEN 'GEO' THEN 'Geostationary Orbit'
                  WHEN 'HEO' THEN 'Highly Elliptical Orbit' ELSE orbital_regime END AS regime_label
      FROM census GROUP BY orbital_regime""")
    q["total_objects"] = _g(
        "SELECT CAST(COALESCE(SUM(object_count), 0) AS BIGINT) AS total_objects FROM census")
    q["headline_counts"] = _g(f"""
      SELECT total_objects, payloads, debris, rocket_bodies,
             {_thousands('total_objects')} AS total_objects_text
      FROM (SELECT CAST(COALESCE(SUM(object_count), 0) AS BIGINT) AS total_objects,
                   CAST(COALESCE(SUM(CASE WHEN object_type = 'PAYLOAD' THEN object_count ELSE 0 END), 0) AS BIGINT) AS payloads,
                   CAST(COALESCE(SUM(CASE WHEN object_type = 'DEBRIS' THEN object_count ELSE 0 END), 0) AS BIGINT) AS debris,
                   CAST(COALESCE(SUM(CASE WHEN object_type = 'ROCKET BODY' THEN object_count ELSE 0 END), 0) AS BIGINT) AS rocket_bodies
            FROM census) t""")
    q["reband_congestion"] = _g("""
      SELECT CAST(FLOOR(altitude_band_km / 200) * 200 AS INTEGER) AS altitude_band_km,
             CAST(SUM(active_count) AS BIGINT) AS active_count,
             CAST(SUM(debris_count) AS BIGINT) AS debris_count
      FROM congestion GROUP BY 1""")
    q["type_share"] = _g("""
      SELECT object_type, object_count, share,
             CAST(ROUND(share * 100, 0) AS INTEGER) AS percent,
             CASE upper(object_type) WHEN 'PAYLOAD' THEN '#22c55e' WHEN 'DEBRIS' THEN '#ef4444'
                  WHEN 'ROCKET BODY' THEN '#eab308' ELSE '#94a3b8' END AS color
      FROM (SELECT object_type, object_count,
                   CASE WHEN SUM(object_count) OVER () <> 0
                        THEN object_count / SUM(object_count) OVER () END AS share
            FROM (SELECT object_type, CAST(SUM(object_count) AS BIGINT) AS object_count
                  FROM census GROUP BY object_type) b) s""")
    q["points_by_type"] = _g("""
      SELECT COALESCE(NULLIF(upper(object_type), ''), 'UNKNOWN') AS type_key, COUNT(*) AS points
      FROM globe GROUP BY 1""")
    q["point_colors"] = _g("""
      SELECT norad_cat_id,
             CAST(CASE upper(object_type) WHEN 'PAYLOAD' THEN 34.0 WHEN 'DEBRIS' THEN 239.0 WHEN 'ROCKET BODY' THEN 234.0 ELSE 148.0 END AS DOUBLE) AS r,
             CAST(CASE upper(object_type) WHEN 'PAYLOAD' THEN 197.0 WHEN 'DEBRIS' THEN 68.0 WHEN 'ROCKET BODY' THEN 179.0 ELSE 163.0 END AS DOUBLE) AS g,
             CAST(CASE upper(object_type) WHEN 'PAYLOAD' THEN 94.0 WHEN 'DEBRIS' THEN 68.0 WHEN 'ROCKET BODY' THEN 8.0 ELSE 184.0 END AS DOUBLE) AS b,
             CAST(CASE upper(object_type) WHEN 'PAYLOAD' THEN 200.0 WHEN 'DEBRIS' THEN 180.0 WHEN 'ROCKET BODY' THEN 200.0 ELSE 160.0 END AS DOUBLE) AS a
      FROM globe""")
    q["visible_objects"] = _g("""
      SELECT * FROM globe
      WHERE COALESCE(NULLIF(upper(object_type), ''), 'UNKNOWN') NOT IN ('DEBRIS', 'UNKNOWN')""")
    q["top_countries"] = _g(
        "SELECT * FROM leaderboard ORDER BY total_objects DESC, country NULLS LAST LIMIT 15")
    q["country_page"] = _g(f"""
      SELECT rank, country, total_objects, payload_count, debris_count, rocket_body_count,
             debris_ratio, {_thousands('total_objects')} AS total_text,
             {_percent('debris_ratio')} AS debris_pct,
             CASE WHEN debris_ratio > 0.6 THEN 'red' WHEN debris_ratio > 0.3 THEN 'yellow'
                  ELSE 'green' END AS debris_tier
      FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY total_objects DESC, country NULLS LAST) AS rank
            FROM leaderboard) r
      WHERE rank BETWEEN 1 AND 20""")
    q["country_page_count"] = _g(
        "SELECT COUNT(*) AS rows, CAST(CEIL(COUNT(*) / 20) AS BIGINT) AS pages FROM leaderboard")
    q["top_constellations"] = _g("""
      SELECT constellation, total_objects, active_count,
             format('{:,}', total_objects) AS total_text,
             CAST(ROUND(avg_altitude_km, 0) AS BIGINT) AS avg_altitude_km_rounded
      FROM growth ORDER BY total_objects DESC, constellation NULLS LAST LIMIT 3""")
    q["decay_page"] = _g("""
      SELECT rank, norad_cat_id, object_name, object_type, country, perigee_km, apogee_km,
             decay_risk, perigee_km < 300 AS low_perigee
      FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY perigee_km NULLS LAST,
                                                  norad_cat_id NULLS LAST) AS rank
            FROM decay) r
      WHERE rank BETWEEN 21 AND 40""")
    q["decay_page_count"] = _g(
        "SELECT COUNT(*) AS rows, CAST(CEIL(COUNT(*) / 20) AS BIGINT) AS pages FROM decay")
    return q


def _objects_as_of(prefix: str, cutoff: str) -> str:
    """The object CTE chain over feed rows ingested before ``cutoff``, renamed."""
    body = _OBJECTS
    for name in ("satcat_like", "gp_like", "sat_ranked", "gp_ranked", "objects"):
        body = body.replace(f"{name} AS (", f"{prefix}{name} AS (")
        body = body.replace(f"FROM {name}", f"FROM {prefix}{name}")
    body = body.replace(f"{prefix}satcat_like AS ({SATCAT_LIKE})",
                        f"{prefix}satcat_like AS (SELECT * FROM ({SATCAT_LIKE}) x "
                        f"WHERE _ingestion_ts < TIMESTAMP '{cutoff}')")
    body = body.replace(f"{prefix}gp_like AS ({GP_LIKE})",
                        f"{prefix}gp_like AS (SELECT * FROM ({GP_LIKE}) x "
                        f"WHERE _ingestion_ts < TIMESTAMP '{cutoff}')")
    body = body.replace("FROM sat_ranked s", f"FROM {prefix}sat_ranked s")
    body = body.replace("LEFT JOIN gp_ranked g", f"LEFT JOIN {prefix}gp_ranked g")
    return body.strip()


_TRACKED = ["object_name", "object_type", "country", "decay_date", "apogee_km", "perigee_km",
            "orbital_regime", "object_category"]


def history_queries(cutoff: str) -> dict[str, str]:
    two_pi_day = repr(2 * 3.141592653589793 / 86400.0)
    mu, re_ = "398600.4418", "6378.137"
    q: dict[str, str] = {}
    q["altitude_trend"] = f"""
      WITH gp_like AS ({GP_LIKE}),
      h AS (
        SELECT TRY_CAST(NORAD_CAT_ID AS INTEGER) AS norad_cat_id,
               TRY_CAST(EPOCH AS TIMESTAMP) AS epoch,
               epoch_us(TRY_CAST(EPOCH AS TIMESTAMP)) / 86400e6 AS d,
               pow({mu} / ((TRY_CAST(MEAN_MOTION AS DOUBLE) * {two_pi_day})
                           * (TRY_CAST(MEAN_MOTION AS DOUBLE) * {two_pi_day})), {repr(1.0 / 3.0)})
                 - {re_} AS alt
        FROM gp_like
        WHERE TRY_CAST(EPOCH AS TIMESTAMP) IS NOT NULL AND TRY_CAST(MEAN_MOTION AS DOUBLE) > 0)
      SELECT norad_cat_id, COUNT(*) AS epochs, MIN(epoch) AS first_epoch, MAX(epoch) AS last_epoch,
             arg_min(alt, {{'e': epoch, 'a': alt}}) AS first_alt_km,
             arg_max(alt, {{'e': epoch, 'a': alt}}) AS last_alt_km,
             regr_slope(alt, d) AS alt_slope_km_per_day
      FROM h GROUP BY norad_cat_id"""
    q["catalogue_upsert"] = _with() + """
      SELECT norad_cat_id, object_name, intl_designator, object_type, country, launch_date,
             decay_date, period_min, apogee_km, perigee_km, rcs_size, is_current
      FROM sat_ranked WHERE rn = 1"""
    past = _objects_as_of("p_", cutoff)
    diff = " OR ".join(f"o.{c} IS DISTINCT FROM n.{c}" for c in _TRACKED)
    cols_old = ", ".join(f"o.{c} AS old_{c}" for c in _TRACKED)
    cols_new = ", ".join(f"n.{c} AS new_{c}" for c in _TRACKED)
    q["change_feed"] = _with(past) + f"""
      SELECT COALESCE(o.norad_cat_id, n.norad_cat_id) AS norad_cat_id,
             CASE WHEN o.norad_cat_id IS NULL THEN 'insert'
                  WHEN n.norad_cat_id IS NULL THEN 'delete' ELSE 'update' END AS change,
             {cols_old}, {cols_new}
      FROM p_objects o FULL OUTER JOIN objects n ON o.norad_cat_id = n.norad_cat_id
      WHERE o.norad_cat_id IS NULL OR n.norad_cat_id IS NULL OR {diff}"""
    past_census = CENSUS.replace("FROM objects", "FROM p_objects")
    q["census_change"] = _with(past, f"pc AS ({past_census})", f"nc AS ({CENSUS})") + """
      SELECT COALESCE(pc.object_type, nc.object_type) AS object_type,
             COALESCE(pc.orbital_regime, nc.orbital_regime) AS orbital_regime,
             COALESCE(pc.country, nc.country) AS country,
             CAST(COALESCE(pc.object_count, 0) AS BIGINT) AS past_count,
             CAST(COALESCE(nc.object_count, 0) AS BIGINT) AS present_count,
             CAST(COALESCE(nc.object_count, 0) AS BIGINT) - CAST(COALESCE(pc.object_count, 0) AS BIGINT) AS delta
      FROM pc FULL OUTER JOIN nc
        ON pc.object_type IS NOT DISTINCT FROM nc.object_type
       AND pc.orbital_regime IS NOT DISTINCT FROM nc.orbital_regime
       AND pc.country IS NOT DISTINCT FROM nc.country"""
    vt = ["object_name", "object_type", "country", "decay_date", "apogee_km", "perigee_km"]
    changed = " OR ".join(f"{c} IS DISTINCT FROM LAG({c}) OVER w" for c in vt)
    q["object_versions"] = _with() + f"""
      , per_run AS (
        SELECT * FROM (
          SELECT TRY_CAST(NORAD_CAT_ID AS INTEGER) AS norad_cat_id,
                 date_trunc('month', _ingestion_ts) AS collection,
                 SATNAME AS object_name, OBJECT_TYPE AS object_type, COUNTRY AS country,
                 TRY_CAST(DECAY AS DATE) AS decay_date,
                 TRY_CAST(APOGEE AS INTEGER) AS apogee_km,
                 TRY_CAST(PERIGEE AS INTEGER) AS perigee_km,
                 ROW_NUMBER() OVER (PARTITION BY TRY_CAST(NORAD_CAT_ID AS INTEGER),
                                                 date_trunc('month', _ingestion_ts)
                                    ORDER BY _ingestion_ts DESC NULLS LAST,
                                             _seq DESC NULLS LAST) AS rn
          FROM satcat_like) x WHERE rn = 1),
      marked AS (
        SELECT *, (LAG(collection) OVER w IS NULL) OR {changed} AS is_change
        FROM per_run WINDOW w AS (PARTITION BY norad_cat_id ORDER BY collection))
      SELECT norad_cat_id, {", ".join(vt)}, collection AS valid_from,
             LEAD(collection) OVER (PARTITION BY norad_cat_id ORDER BY collection) AS valid_to,
             LEAD(collection) OVER (PARTITION BY norad_cat_id ORDER BY collection) IS NULL AS is_current
      FROM marked WHERE is_change"""
    q["growth_by_launch_year"] = _with() + f"""
      SELECT launch_year, launched, debris_launched,
             CAST(SUM(launched) OVER (ORDER BY launch_year ROWS BETWEEN UNBOUNDED PRECEDING
                                      AND CURRENT ROW) AS BIGINT) AS cumulative
      FROM (SELECT CAST(year(launch_date) AS INTEGER) AS launch_year, COUNT(*) AS launched,
                   {_cif('is_debris')} AS debris_launched
            FROM objects WHERE launch_date IS NOT NULL GROUP BY 1) y"""
    q["altitude_inclination_heatmap"] = _with() + f"""
      SELECT CAST(FLOOR(apogee_km / 500) * 500 AS INTEGER) AS altitude_band_km,
             CAST(FLOOR(inclination / 10) * 10 AS INTEGER) AS inclination_band_deg,
             COUNT(*) AS objects, {_cif('is_debris')} AS debris, {_cif('is_active')} AS active
      FROM objects WHERE apogee_km IS NOT NULL AND inclination IS NOT NULL
      GROUP BY 1, 2"""
    from . import oracle_series
    q.update(oracle_series.queries(_with, DECAY, q["altitude_trend"]))
    return q
