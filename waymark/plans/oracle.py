"""DuckDB SQL oracle for every query in ``waymark.plans.catalog``.

Each entry re-derives its inputs from the ``events`` view with the recipe in
``oracle_recipe`` and computes the result with plain relational SQL
(joins, GROUP BY, window functions) rather than the array expressions the
engine uses.  ``dround`` rounds like Spark (HALF_UP on the decimal value).
"""

from __future__ import annotations

from waymark.plans.oracle_recipe import (PING_COLS, bearing, gold_sql, hav, pings_sql,
                                         silver_sql, with_ctes, PINGS_CTES, SILVER_CTES,
                                         GOLD_CTES, VALID_CTE, DEDUP_CTE)
from waymark.plans.tables import oracle_copy

ORACLE: dict[str, str] = {}


def dround(expr: str, n: int) -> str:
    """Spark's round on a double: HALF_UP applied to the shortest decimal text."""
    return f"CAST(round(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,17)), {n}) AS DOUBLE)"


def _partition(key: str) -> str:
    return f"CAST((('0x'||substr(md5(coalesce({key},'')),1,8))::BIGINT) % 6 AS INTEGER)"


def _json_num(c: str) -> str:
    return f"CASE WHEN {c} IS NOT NULL THEN '\"{c}\":' || CAST({c} AS VARCHAR) END"


def _json_str(c: str) -> str:
    return f"CASE WHEN {c} IS NOT NULL THEN '\"{c}\":\"' || {c} || '\"' END"


_VALUE = ("'{' || concat_ws(',', " + ", ".join(
    [_json_str("shipment_id"), _json_str("vehicle_id"), _json_str("route_id")]
    + [_json_num(c) for c in ("lat", "lon", "speed_kmh", "heading", "dist_km", "total_km", "seq")]
    + ["'\"event_time\":\"' || strftime(event_time, '%Y-%m-%dT%H:%M:%S') || '+00:00\"'"]) + ") || '}'")

_ENV = ("env AS (SELECT shipment_id AS key, " + _VALUE + " AS value, "
        + _partition("shipment_id") + ' AS "partition", CAST(event_id*2+copy AS BIGINT) AS "offset", '
        'event_time AS "timestamp", pings.* FROM pings)')

# ------------------------------------------------------------------ bronze
ORACLE["bronze_parse"] = with_ctes(PINGS_CTES, _ENV, body=(
    "SELECT key AS kafka_key, " + PING_COLS + ', "partition" AS kafka_partition, '
    '"offset" AS kafka_offset, "timestamp" AS kafka_ts FROM env'))
ORACLE["keyed_envelope"] = with_ctes(PINGS_CTES, _ENV, body=(
    'SELECT key, value, "partition", "offset", "timestamp" FROM env'))
ORACLE["peek_messages"] = with_ctes(PINGS_CTES, _ENV, body=(
    'SELECT "partition" AS kafka_partition, "offset" AS kafka_offset, shipment_id, lat, lon, '
    'speed_kmh, event_time FROM env ORDER BY "partition", "offset" LIMIT 15'))
ORACLE["bronze_summary"] = pings_sql(
    "SELECT count(*) AS total_pings, count(DISTINCT shipment_id) AS shipments, "
    "count(DISTINCT route_id) AS routes, min(event_time) AS earliest_event, "
    "max(event_time) AS latest_event FROM pings")
ORACLE["bronze_quality"] = pings_sql(
    "SELECT count(*) AS rows, count(*) FILTER (WHERE shipment_id IS NULL AND vehicle_id IS NULL "
    "AND route_id IS NULL AND lat IS NULL AND lon IS NULL AND speed_kmh IS NULL AND dist_km IS NULL "
    "AND total_km IS NULL AND seq IS NULL) AS unparseable, "
    "count(*) FILTER (WHERE shipment_id IS NULL) AS missing_id, "
    "count(*) FILTER (WHERE lat IS NULL OR lon IS NULL) AS missing_coords, "
    "count(*) FILTER (WHERE NOT (lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180)) AS out_of_range, "
    "count(*) FILTER (WHERE event_time IS NULL) AS missing_event_time, "
    "count(*) FILTER (WHERE shipment_id IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL AND "
    "lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180) AS valid FROM pings")
ORACLE["pings_per_route"] = pings_sql(
    "SELECT route_id, count(*) AS pings FROM pings GROUP BY route_id ORDER BY route_id NULLS FIRST")
ORACLE["bronze_sample"] = with_ctes(PINGS_CTES, _ENV, body=(
    "SELECT shipment_id, route_id, lat, lon, speed_kmh, seq, event_time, "
    '"partition" AS kafka_partition, "offset" AS kafka_offset FROM env '
    'ORDER BY "partition", "offset" LIMIT 10'))

# ------------------------------------------------------------------ silver
ORACLE["silver_valid"] = with_ctes(PINGS_CTES, VALID_CTE, body="SELECT * FROM vv")
ORACLE["silver_dedup"] = with_ctes(PINGS_CTES, VALID_CTE, DEDUP_CTE, body="SELECT * FROM dd")
ORACLE["silver_enrich"] = silver_sql("SELECT * FROM silver")
ORACLE["silver_summary"] = silver_sql(
    "SELECT count(*) AS rows, count(DISTINCT shipment_id) AS shipments FROM silver")
ORACLE["silver_sample"] = silver_sql(
    "SELECT shipment_id, route_id, progress_pct, is_moving, dist_to_route_km, at_facility, "
    "event_time FROM silver ORDER BY event_time DESC, shipment_id, seq LIMIT 10")

ORACLE["dist_to_route"] = pings_sql(
    "SELECT p.event_id, p.copy, round(min(sqrt(pow(px-(ax+t*(bx-ax)),2)+pow(py-(ay+t*(yb-ay)),2))),3) "
    "AS dist_to_route_km FROM pings p LEFT JOIN (SELECT p2.event_id, p2.copy, g.ax, g.ay, g.bx, g.yb, "
    "radians(p2.lon)*0.9997224302180006e0*6371.0088e0 px, radians(p2.lat)*6371.0088e0 py, "
    "greatest(0e0,least(1e0,((radians(p2.lon)*0.9997224302180006e0*6371.0088e0-g.ax)*(g.bx-g.ax)"
    "+(radians(p2.lat)*6371.0088e0-g.ay)*(g.yb-g.ay))/((g.bx-g.ax)*(g.bx-g.ax)+(g.yb-g.ay)*(g.yb-g.ay)))) t "
    "FROM pings p2 JOIN seg g ON g.route_id=p2.route_id) z ON z.event_id=p.event_id AND z.copy=p.copy "
    "GROUP BY p.event_id, p.copy")

ORACLE["nearest_facility"] = pings_sql(
    "SELECT p.event_id, p.copy, f.name AS at_facility FROM pings p LEFT JOIN ("
    f"SELECT event_id, copy, name, d FROM (SELECT p2.event_id, p2.copy, fac.name, "
    f"{hav('p2.lat', 'p2.lon', 'flat', 'flon')} AS d, row_number() OVER (PARTITION BY p2.event_id, "
    f"p2.copy ORDER BY {hav('p2.lat', 'p2.lon', 'flat', 'flon')}, fac.ord) rn FROM pings p2 "
    "CROSS JOIN fac) z WHERE rn=1 AND d<=0.8e0) f ON f.event_id=p.event_id AND f.copy=p.copy")

ORACLE["expected_position"] = with_ctes(PINGS_CTES, VALID_CTE, DEDUP_CTE, body=(
    "SELECT dd.event_id, round(g.lat+(g.lat2-g.lat)*((c.d-g.cum)/g.len),6) AS exp_lat, "
    "round(g.lon+(g.lon2-g.lon)*((c.d-g.cum)/g.len),6) AS exp_lon, round(g.brg,1) AS seg_bearing "
    "FROM dd LEFT JOIN (SELECT dd2.event_id, dd2.route_id, least(greatest(dd2.dist_km,0e0),t.total) AS d "
    "FROM dd dd2 JOIN tot t ON t.route_id=dd2.route_id) c ON c.event_id=dd.event_id "
    "LEFT JOIN seg g ON g.route_id=c.route_id AND c.d>=g.cum AND (c.d<g.cum+g.len OR g.rn=1)"))

_ENDS = ("ends AS (SELECT route_id, arg_min(lat,i) o_lat, arg_min(lon,i) o_lon, arg_max(lat,i) d_lat, "
         "arg_max(lon,i) d_lon FROM wp GROUP BY route_id)")
ORACLE["haversine"] = with_ctes(PINGS_CTES, VALID_CTE, DEDUP_CTE, _ENDS, body=(
    f"SELECT dd.event_id, round({hav('o_lat', 'o_lon', 'dd.lat', 'dd.lon')},6) AS km_from_origin, "
    f"round({hav('dd.lat', 'dd.lon', 'd_lat', 'd_lon')},6) AS km_to_destination "
    "FROM dd LEFT JOIN ends e ON e.route_id=dd.route_id"))
ORACLE["bearing"] = with_ctes(PINGS_CTES, VALID_CTE, DEDUP_CTE, _ENDS, body=(
    f"SELECT dd.event_id, round({bearing('dd.lat', 'dd.lon', 'd_lat', 'd_lon')},1) AS "
    "bearing_to_destination FROM dd LEFT JOIN ends e ON e.route_id=dd.route_id"))
ORACLE["offset_point"] = with_ctes(PINGS_CTES, VALID_CTE, DEDUP_CTE, body=(
    "SELECT event_id, round(lat+(2e0*cos(radians(heading+90e0)))/110.574e0,6) AS off_lat, "
    "round(lon+(2e0*sin(radians(heading+90e0)))/(111.32e0*cos(radians(lat))),6) AS off_lon FROM dd"))

_LENGTHS = ("wl0 AS (SELECT route_id, i, coalesce("
            + hav("lag(lat) OVER (PARTITION BY route_id ORDER BY i)",
                  "lag(lon) OVER (PARTITION BY route_id ORDER BY i)", "lat", "lon")
            + ", 0e0) AS step FROM wp), "
            "wl1 AS (SELECT route_id, i, sum(step) OVER (PARTITION BY route_id ORDER BY i "
            "ROWS UNBOUNDED PRECEDING) AS cum FROM wl0), "
            "wl AS (SELECT route_id, count(*) AS n_waypoints, max(cum) AS route_km FROM wl1 "
            "GROUP BY route_id)")
ORACLE["route_lengths"] = silver_sql(
    "SELECT s.route_id, CAST(coalesce(wl.n_waypoints, 0) AS BIGINT) AS n_waypoints, "
    + dround("wl.route_km", 4) + " AS route_km, s.pings, s.max_dist_km, "
    + dround("s.max_dist_km/wl.route_km*100e0", 1) + " AS coverage_pct "
    "FROM (SELECT route_id, count(*) AS pings, max(dist_km) AS max_dist_km FROM silver "
    "GROUP BY route_id) s LEFT JOIN (" + "WITH " + _LENGTHS + " SELECT * FROM wl) wl "
    "ON wl.route_id=s.route_id")

# ------------------------------------------------------------------ gold
ORACLE["gold_status"] = gold_sql("SELECT * FROM gstatus")
ORACLE["gold_exceptions"] = gold_sql("SELECT * FROM gexc")
ORACLE["status_by_type"] = gold_sql(
    "SELECT event_type, count(*) AS events FROM gstatus GROUP BY event_type")
ORACLE["exceptions_by_type"] = gold_sql(
    "SELECT event_type, count(*) AS events FROM gexc GROUP BY event_type")
ORACLE["status_sample"] = gold_sql(
    "SELECT shipment_id, event_type, detail, lat, lon, event_time FROM gstatus "
    "ORDER BY event_time DESC, shipment_id, event_type LIMIT 10")
ORACLE["exceptions_sample"] = gold_sql(
    "SELECT shipment_id, event_type, window_start, window_end, moved_km, max_speed, at_facility "
    "FROM gexc ORDER BY window_start DESC, shipment_id LIMIT 10")

# ------------------------------------------------------------------ fleet state
_STATE_COLS = ["route_id", "lat", "lon", "speed_kmh", "progress_pct", "dist_to_route_km",
               "at_facility", "dist_km", "total_km", "event_time"]
_LATEST = ("latest AS (SELECT shipment_id, " + ", ".join(_STATE_COLS) + " FROM (SELECT *, "
           "row_number() OVER (PARTITION BY shipment_id ORDER BY event_time DESC, seq DESC) rn "
           "FROM silver) z WHERE rn=1)")
_NONNULL = ("nonnull AS (SELECT shipment_id, " + ", ".join(
    f"arg_max({c}, (event_time, seq)) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in _STATE_COLS)
    + " FROM silver GROUP BY shipment_id)")


def _status_cte(name: str, src: str) -> str:
    return (f"{name} AS (SELECT *, CASE status WHEN 'IN_TRANSIT' THEN '38,166,91' "
            "WHEN 'OFF_ROUTE' THEN '217,48,37' WHEN 'STOPPED' THEN '241,156,24' "
            "WHEN 'AT_FACILITY' THEN '41,98,255' END AS color FROM (SELECT *, "
            "CASE WHEN dist_to_route_km > 1.5e0 THEN 'OFF_ROUTE' "
            "WHEN at_facility IS NOT NULL AND at_facility <> '' THEN 'AT_FACILITY' "
            "WHEN speed_kmh < 3.0e0 THEN 'STOPPED' ELSE 'IN_TRANSIT' END AS status, "
            "CASE WHEN total_km - dist_km IS NULL THEN NULL ELSE "
            + dround("greatest(0e0, total_km - dist_km)", 2) + f" END AS dist_remaining_km "
            f"FROM {src}) z)")


_BOARD = ("board AS (SELECT shipment_id, route_id, status, progress_pct, dist_remaining_km, "
          "speed_kmh, " + dround("dist_remaining_km / (CASE WHEN speed_kmh > 5.0e0 THEN speed_kmh "
                                 "ELSE 25.0e0 END) * 60.0e0", 1) + " AS eta_min FROM st)")


def fleet_sql(body: str) -> str:
    return with_ctes(PINGS_CTES, SILVER_CTES, _LATEST, _NONNULL, _status_cte("st", "nonnull"),
                     _status_cte("stl", "latest"), _BOARD, body=body)


ORACLE["latest_state"] = fleet_sql("SELECT * FROM latest")
ORACLE["latest_nonnull"] = fleet_sql("SELECT * FROM nonnull")
ORACLE["shipment_status"] = fleet_sql("SELECT * FROM st")
ORACLE["shipment_status_latest"] = fleet_sql("SELECT * FROM stl")
ORACLE["shipment_board"] = fleet_sql(
    "SELECT * FROM board ORDER BY eta_min ASC NULLS LAST, shipment_id")
ORACLE["fleet_kpis"] = fleet_sql(
    "SELECT count(*) AS active_shipments, count(*) FILTER (WHERE status='OFF_ROUTE') AS off_route, "
    "count(*) FILTER (WHERE status='STOPPED') AS stopped, " + dround("avg(eta_min)", 1)
    + " AS avg_eta_min FROM board")
ORACLE["exception_feed"] = with_ctes(PINGS_CTES, SILVER_CTES, GOLD_CTES, body=(
    "SELECT * FROM (SELECT shipment_id, event_type, detail AS info, event_time AS ts FROM gstatus "
    "UNION ALL SELECT shipment_id, event_type, at_facility AS info, window_end AS ts FROM gexc) u "
    "ORDER BY ts DESC, shipment_id, event_type, info NULLS FIRST LIMIT 25"))

# ------------------------------------------------------------------ ETA
_REMAIN = "CASE WHEN total_km - dist_km IS NULL THEN NULL ELSE greatest(0e0, total_km - dist_km) END"
_HOUR = "CAST(hour({t}) AS INTEGER)"
_DOW = "CAST(isodow({t})-1 AS INTEGER)"


def _fallback(dist: str, avg: str) -> str:
    return dround(f"{dist} / (CASE WHEN {avg} > 5.0e0 THEN {avg} ELSE 25.0e0 END) * 60.0e0", 1)


def _md5_unit(text: str) -> str:
    return f"((('0x'||substr(md5({text}),1,8))::BIGINT) / 4294967296e0)"


_TRAIN = ",\n".join([
    "tra AS (SELECT * FROM (SELECT shipment_id, min(event_time) FILTER (WHERE dist_km >= total_km) "
    "AS arrival_time FROM silver GROUP BY shipment_id) z WHERE arrival_time IS NOT NULL)",
    "trw AS (SELECT s.*, avg(speed_kmh) OVER (PARTITION BY shipment_id ORDER BY event_time, seq "
    "ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS avg5 FROM silver s)",
    "training AS (SELECT t.shipment_id, t.seq, t.route_id, " + _HOUR.format(t="t.event_time")
    + " AS hour, " + _DOW.format(t="t.event_time") + " AS dow, "
    + dround(_REMAIN, 3) + " AS dist_remaining_km, progress_pct, speed_kmh, "
    + dround("avg5", 1) + " AS avg_speed_kmh, coalesce(dist_to_route_km, 0e0) AS dist_to_route_km, "
    "CAST(speed_kmh < 3.0e0 AS INTEGER) AS is_stopped, "
    + dround("(epoch(a.arrival_time) - epoch(t.event_time)) / 60.0e0", 2) + " AS minutes_to_arrival "
    "FROM trw t JOIN tra a ON a.shipment_id = t.shipment_id WHERE t.event_time <= a.arrival_time)",
    "feat AS (SELECT l.shipment_id, route_id, " + _HOUR.format(t="event_time") + " AS hour, "
    + _DOW.format(t="event_time") + " AS dow, " + _REMAIN + " AS dist_remaining_km, progress_pct, "
    "speed_kmh, av.avg5 AS avg_speed_kmh, coalesce(dist_to_route_km, 0e0) AS dist_to_route_km, "
    "CAST(speed_kmh < 3.0e0 AS INTEGER) AS is_stopped, event_time FROM (SELECT * FROM (SELECT *, "
    "row_number() OVER (PARTITION BY shipment_id ORDER BY event_time DESC, seq DESC) rn FROM silver) "
    "z WHERE rn = 1) l LEFT JOIN (SELECT shipment_id, avg5 FROM (SELECT shipment_id, avg5, "
    "row_number() OVER (PARTITION BY shipment_id ORDER BY event_time DESC, seq DESC) rn FROM trw) "
    "z WHERE rn = 1) av ON av.shipment_id = l.shipment_id)",
])


def _requests(name: str, shifted: bool) -> str:
    rid = "concat_ws('#', shipment_id, CAST(seq AS VARCHAR))"
    dist, speed = _REMAIN, "speed_kmh"
    if shifted:
        u_dist = _md5_unit("concat_ws('#', " + rid + ", 'dist')")
        u_speed = _md5_unit("concat_ws('#', " + rid + ", 'speed')")
        dist = f"({dist}) * (0.1e0 + 0.2e0 * {u_dist})"
        speed = f"speed_kmh * (0.3e0 + 0.2e0 * {u_speed})"
    rq = (f"{name}0 AS (SELECT {rid} AS request_id, route_id, {dround(dist, 2)} AS dist_remaining_km, "
          f"progress_pct, {dround(speed, 1)} AS speed_kmh, NULL::DOUBLE AS avg_speed_kmh, "
          f"0e0 AS dist_to_route_km, NULL::INTEGER AS hour, NULL::INTEGER AS dow, event_time AS as_of "
          "FROM silver)")
    rf = (f"{name} AS (SELECT request_id, route_id, coalesce(hour, {_HOUR.format(t='as_of')}) AS hour, "
          f"coalesce(dow, {_DOW.format(t='as_of')}) AS dow, dist_remaining_km, "
          "coalesce(progress_pct, 0e0) AS progress_pct, coalesce(speed_kmh, 0e0) AS speed_kmh, "
          "coalesce(avg_speed_kmh, coalesce(speed_kmh, 0e0)) AS avg_speed_kmh, "
          "coalesce(dist_to_route_km, 0e0) AS dist_to_route_km, "
          "CAST(coalesce(speed_kmh, 0e0) < 3.0e0 AS INTEGER) AS is_stopped, "
          + _fallback("dist_remaining_km", "coalesce(avg_speed_kmh, coalesce(speed_kmh, 0e0))")
          + f" AS predicted_eta_min, 'fallback' AS method FROM {name}0 WHERE route_id IS NOT NULL "
          "AND dist_remaining_km IS NOT NULL AND dist_remaining_km >= 0)")
    return rq + ",\n" + rf


def eta_sql(body: str) -> str:
    return with_ctes(PINGS_CTES, SILVER_CTES, _TRAIN, _requests("rq", False),
                     _requests("rqs", True), body=body)


ORACLE["training_set"] = eta_sql("SELECT * FROM training")
ORACLE["label_summary"] = eta_sql(
    "SELECT count(*) AS rows, count(DISTINCT route_id) AS routes, min(minutes_to_arrival) AS label_min, "
    + dround("avg(minutes_to_arrival)", 6) + " AS label_mean, max(minutes_to_arrival) AS label_max "
    "FROM training")
ORACLE["eta_features"] = eta_sql("SELECT * FROM feat")
ORACLE["eta_for_shipment"] = eta_sql(
    "SELECT shipment_id, " + _fallback("dist_remaining_km", "avg_speed_kmh")
    + " AS predicted_eta_min, 'fallback' AS method, progress_pct FROM feat")
ORACLE["fallback_eta"] = eta_sql(
    "SELECT shipment_id, seq, " + _fallback("dist_remaining_km", "avg_speed_kmh") + " AS eta_min "
    "FROM training")
ORACLE["score_requests"] = eta_sql(
    "SELECT request_id, route_id, hour, dow, dist_remaining_km, speed_kmh, avg_speed_kmh, "
    "is_stopped, predicted_eta_min, method FROM rq")
_DEFECTIVE = ("(SELECT request_id, CASE WHEN n <> 3 THEN route_id END AS route_id, "
              "CASE WHEN n = 5 THEN -1e0 - dist_remaining_km WHEN n <> 7 THEN dist_remaining_km END AS dist_remaining_km "
              "FROM (SELECT *, CAST(regexp_extract(request_id, '#([0-9]+)$', 1) AS BIGINT) % 20 AS n FROM rq0) z) d")
ORACLE["score_rejects"] = eta_sql(
    "SELECT request_id, route_id, dist_remaining_km, CASE WHEN route_id IS NULL THEN "
    "'route_id missing' WHEN dist_remaining_km IS NULL THEN 'dist_remaining_km missing' ELSE "
    f"'dist_remaining_km must be >= 0' END AS reason FROM {_DEFECTIVE} WHERE NOT coalesce(route_id IS NOT NULL "
    "AND dist_remaining_km IS NOT NULL AND dist_remaining_km >= 0, false)")


def _metrics(pred: str, src: str) -> str:
    err = f"({pred} - minutes_to_arrival)"
    return ("SELECT count(*) AS n, " + dround(f"avg(abs({err}))", 6) + " AS mae, "
            + dround(f"sqrt(avg({err}*{err}))", 6) + " AS rmse, "
            + dround(f"1.0e0 - avg({err}*{err}) / nullif(var_pop(minutes_to_arrival), 0e0)", 6)
            + f" AS r2 FROM {src} WHERE {pred} IS NOT NULL AND minutes_to_arrival IS NOT NULL")


ORACLE["regression_metrics"] = eta_sql(_metrics(
    "pred", "(SELECT *, " + _fallback("dist_remaining_km", "avg_speed_kmh") + " AS pred FROM training) z"))
ORACLE["regression_metrics_constant"] = eta_sql(
    "SELECT count(*) AS n, " + dround("avg(CAST(is_stopped AS DOUBLE))", 6) + " AS mae, "
    + dround("sqrt(avg(CAST(is_stopped AS DOUBLE)))", 6) + " AS rmse, CAST(NULL AS DOUBLE) AS r2 FROM training")
ORACLE["eta_feature_vector"] = eta_sql(
    "SELECT shipment_id, CAST(hour AS DOUBLE) AS hour, CAST(dow AS DOUBLE) AS dow, dist_remaining_km, progress_pct, "
    "speed_kmh, avg_speed_kmh, dist_to_route_km, CAST(is_stopped AS DOUBLE) AS is_stopped, " + ", ".join(
        f"CASE WHEN route_id = (SELECT r FROM (SELECT r, row_number() OVER (ORDER BY r) AS n FROM "
        f"(SELECT DISTINCT route_id AS r FROM training) q) z WHERE n = {i}) THEN 1e0 ELSE 0e0 END AS route_{i}"
        for i in range(1, 6)) + " FROM feat")
ORACLE["promotion_gate_fallback"] = eta_sql(
    "SELECT n_holdout, " + dround("champion_mae", 6) + " AS champion_mae, "
    + dround("challenger_mae", 6) + " AS challenger_mae, coalesce(champion_mae IS NULL OR "
    "challenger_mae < champion_mae * 0.99e0, false) AS promote FROM (SELECT count(*) AS n_holdout, "
    "avg(abs(champion - minutes_to_arrival)) AS champion_mae, "
    "avg(abs(challenger - minutes_to_arrival)) AS challenger_mae FROM (SELECT *, "
    + _fallback("dist_remaining_km", "avg_speed_kmh") + " AS champion, "
    + _fallback("dist_remaining_km", "speed_kmh") + " AS challenger FROM training "
    "WHERE (('0x'||substr(md5(shipment_id),1,8))::BIGINT % 100) < 20) h) g")

# ------------------------------------------------------------------ fitted models
# The node tables that the queries leave for this purpose, walked level by level.
_VERSION = ("(SELECT count(*) || '-' || coalesce(sum(event_id), 0) || '-' || coalesce(sum(user_id), 0) FROM events)")
_DEPTH = {"champion": 8, "challenger": 10}


def _walk(kind: str, rows: str) -> str:
    """CTE ``<kind>(rid, prediction)`` for the feature rows of ``rows``."""
    x = ("CASE e.feature " + " ".join(f"WHEN '{c}' THEN CAST(f.{c} AS DOUBLE)" for c in (
        "hour", "dow", "dist_remaining_km", "progress_pct", "speed_kmh", "avg_speed_kmh", "dist_to_route_km", "is_stopped"))
        + " ELSE CAST(f.route_id IS NOT DISTINCT FROM e.level AS INTEGER) END")
    ctes = [f"{kind}_n AS MATERIALIZED (SELECT tree, node, feature, level, threshold, \"left\" AS l, \"right\" AS r, value, weight "
            f"FROM read_parquet('{oracle_copy()}/*/*/*.parquet', hive_partitioning=true, hive_types_autocast=false) "
            f"WHERE kind = '{kind}' AND version = {_VERSION})",
            f"{kind}_0 AS (SELECT rid, tree, 0 AS node FROM {rows}, (SELECT DISTINCT tree FROM {kind}_n) t)"]
    for i in range(_DEPTH[kind]):
        ctes.append(f"{kind}_{i + 1} AS (SELECT w.rid, w.tree, CASE WHEN e.feature IS NULL THEN w.node WHEN {x} <= e.threshold "
                    f"THEN e.l ELSE e.r END AS node FROM {kind}_{i} w JOIN {kind}_n e ON e.tree = w.tree AND e.node = w.node "
                    f"JOIN {rows} f ON f.rid = w.rid)")
    ctes.append(f"{kind} AS MATERIALIZED (SELECT w.rid, fsum(e.weight * e.value) AS prediction FROM {kind}_{_DEPTH[kind]} w "
                f"JOIN {kind}_n e ON e.tree = w.tree AND e.node = w.node GROUP BY w.rid)")
    return ",\n".join(ctes)


def model_sql(rows: str, body: str, kinds=("champion",), more: tuple = ()) -> str:
    """``rows``: a query that gives the features and a distinct ``rid``."""
    return with_ctes(PINGS_CTES, SILVER_CTES, _TRAIN, _requests("rq", False), *more,
                     f"mrows AS MATERIALIZED ({rows})", *[_walk(k, "mrows") for k in kinds], body=body)


_HELD = "(('0x'||substr(md5(shipment_id),1,8))::BIGINT % 100) < 20"
_HELD_ROWS = f"SELECT *, shipment_id || '#' || seq AS rid FROM training WHERE {_HELD}"
ORACLE["score_requests_model"] = model_sql("SELECT *, request_id AS rid FROM rq", (
    "SELECT request_id, route_id, dist_remaining_km, speed_kmh, " + dround("prediction", 1)
    + " AS predicted_eta_min, 'model' AS method FROM mrows JOIN champion USING (rid)"))
ORACLE["eta_for_shipment_model"] = model_sql("SELECT *, shipment_id AS rid FROM feat", (
    "SELECT shipment_id, " + dround("prediction", 1) + " AS predicted_eta_min, 'model' AS method, progress_pct "
    "FROM mrows JOIN champion USING (rid)"))
ORACLE["shipment_board_model"] = model_sql(
    "SELECT shipment_id AS rid, route_id, " + _HOUR.format(t="event_time") + " AS hour, " + _DOW.format(t="event_time")
    + " AS dow, dist_remaining_km, coalesce(progress_pct, 0e0) AS progress_pct, coalesce(speed_kmh, 0e0) AS speed_kmh, "
    "coalesce(speed_kmh, 0e0) AS avg_speed_kmh, coalesce(dist_to_route_km, 0e0) AS dist_to_route_km, "
    "CAST(coalesce(speed_kmh, 0e0) < 3.0e0 AS INTEGER) AS is_stopped FROM st WHERE route_id IS NOT NULL "
    "AND dist_remaining_km >= 0", (
        "SELECT st.shipment_id, st.route_id, status, st.progress_pct, st.dist_remaining_km, st.speed_kmh, "
        + dround("prediction", 1) + " AS eta_min FROM st LEFT JOIN champion ON rid = shipment_id "
        "ORDER BY eta_min ASC NULLS LAST, shipment_id"), more=(_NONNULL, _status_cte("st", "nonnull")))
ORACLE["promotion_gate"] = model_sql(_HELD_ROWS, (
    "SELECT n_holdout, " + dround("champion_mae", 6) + " AS champion_mae, " + dround("challenger_mae", 6)
    + " AS challenger_mae, coalesce(challenger_mae < champion_mae * 0.99e0, false) AS promote FROM "
    "(SELECT count(*) AS n_holdout, avg(abs(a.prediction - minutes_to_arrival)) AS champion_mae, "
    "avg(abs(b.prediction - minutes_to_arrival)) AS challenger_mae FROM mrows JOIN champion a USING (rid) "
    "JOIN challenger b USING (rid)) g"), kinds=("champion", "challenger"))
ORACLE["eta_model_metrics"] = model_sql(_HELD_ROWS, (
    "SELECT m.*, (SELECT count(*) FROM training WHERE NOT " + _HELD + ") AS n_train FROM ("
    + _metrics("prediction", "(SELECT * FROM mrows JOIN champion USING (rid)) z") + ") m"))

# ------------------------------------------------------------------ drift
_PROBS = "[" + ", ".join(repr(i / 10) for i in range(11)) + "]"


def _long(src: str, name: str) -> str:
    return (f"{name} AS (SELECT * FROM (SELECT 'dist_remaining_km' AS feature, "
            f"CAST(dist_remaining_km AS DOUBLE) AS value FROM {src} UNION ALL SELECT 'speed_kmh', "
            f"CAST(speed_kmh AS DOUBLE) FROM {src}) z WHERE value IS NOT NULL AND NOT isnan(value))")


def _hist(name: str, live_long: str) -> str:
    binx = " + ".join(f"(CASE WHEN c.cuts[{i}] <= l.value THEN 1 ELSE 0 END)" for i in range(2, 11))
    cnt = ("SELECT l.feature, CAST(" + binx + " AS INTEGER) AS bin, count(*) AS n "
           "FROM {src} l JOIN cuts c ON c.feature = l.feature GROUP BY 1, 2")
    return (f"{name}0 AS (SELECT g.feature, g.bin, coalesce(r.n, 0) AS ref_count, "
            f"coalesce(v.n, 0) AS live_count FROM grid g LEFT JOIN ({cnt.format(src='reflong')}) r "
            f"ON r.feature = g.feature AND r.bin = g.bin LEFT JOIN ({cnt.format(src=live_long)}) v "
            f"ON v.feature = g.feature AND v.bin = g.bin), "
            f"{name} AS (SELECT feature, bin, ref_count, live_count, "
            f"greatest(ref_count / sum(ref_count) OVER (PARTITION BY feature), 1e-4) AS ref_share, "
            f"greatest(live_count / sum(live_count) OVER (PARTITION BY feature), 1e-4) AS live_share "
            f"FROM {name}0)")


_DRIFT = ",\n".join([
    _long("training", "reflong"), _long("rq", "livelong"), _long("rqs", "shiftlong"),
    "cuts AS (SELECT feature, list_concat(['-inf'::DOUBLE], q[2:10], ['inf'::DOUBLE]) AS cuts FROM "
    f"(SELECT feature, quantile_cont(value, {_PROBS}) AS q FROM reflong GROUP BY feature) z)",
    "grid AS (SELECT feature, CAST(unnest(range(0, 10)) AS INTEGER) AS bin FROM cuts)",
    _hist("hlive", "livelong"), _hist("hshift", "shiftlong"),
    "psis AS (SELECT 'live' AS traffic, feature, sum((live_share - ref_share) * ln(live_share / "
    "ref_share)) AS psi FROM hlive GROUP BY feature UNION ALL SELECT 'shifted', feature, "
    "sum((live_share - ref_share) * ln(live_share / ref_share)) FROM hshift GROUP BY feature)",
])


def drift_sql(body: str) -> str:
    return with_ctes(PINGS_CTES, SILVER_CTES, _TRAIN, _requests("rq", False),
                     _requests("rqs", True), _DRIFT, body=body)


_STATUS = ("CASE WHEN {p} > 0.2e0 THEN 'SIGNIFICANT DRIFT' WHEN {p} > 0.1e0 THEN 'moderate shift' "
           "ELSE 'stable' END")
ORACLE["psi_cuts"] = drift_sql(
    "SELECT feature, CAST(i - 1 AS INTEGER) AS cut, CASE WHEN isinf(cuts[i]) THEN cuts[i] ELSE "
    + dround("cuts[i]", 6) + " END AS value FROM cuts, range(1, 12) r(i)")
ORACLE["psi_histogram"] = drift_sql("SELECT * FROM hlive")
ORACLE["psi"] = drift_sql(
    "SELECT traffic, feature, " + dround("psi", 6) + " AS psi, " + _STATUS.format(p="psi")
    + " AS status FROM psis")
ORACLE["drift_report"] = drift_sql(
    "SELECT traffic, " + dround("max(psi)", 6) + " AS max_psi, bool_or(psi > 0.2e0) AS alert, "
    "count(*) AS features_checked, CASE WHEN bool_or(psi > 0.2e0) THEN "
    "'SIGNIFICANT DRIFT detected -> recommend retraining' ELSE "
    "'inputs stable vs training distribution -> no retrain needed' END AS recommendation "
    "FROM psis GROUP BY traffic")
ORACLE["psi_empty_live"] = drift_sql(
    "SELECT CAST(NULL AS DOUBLE) AS max_psi, false AS alert, CAST(0 AS BIGINT) AS features_checked, "
    "'no live traffic to compare' AS recommendation FROM (SELECT count(*) FROM cuts) z")
ORACLE["method_mix"] = eta_sql(
    "SELECT method, count(*) AS predictions FROM (SELECT method FROM rq UNION ALL "
    "SELECT 'model' FROM rq WHERE is_stopped = 0) z GROUP BY method")

# ------------------------------------------------------------------ streaming
ORACLE["stream_bronze"] = ORACLE["bronze_parse"]
ORACLE["stream_silver"] = ORACLE["silver_enrich"]
# Each batch's watermark is the running maximum of the valid event times before it, less a day.
_LATE_VALID = (
    "arrived AS (SELECT *, least(3, greatest(0, coalesce(CAST(floor((epoch(event_time) - 1704067200) / 691200e0) AS INTEGER), 0)) "
    "+ CASE WHEN event_id % 100 = 7 THEN 2 WHEN event_id % 10 = 3 THEN 1 ELSE 0 END "
    "+ CASE WHEN copy = 1 AND event_id % 2 = 0 THEN 1 ELSE 0 END) AS batch FROM pings), "
    "ok AS (SELECT * FROM arrived WHERE shipment_id IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL "
    "AND lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180), "
    "tops AS (SELECT batch, max(event_time) AS top FROM ok GROUP BY batch), "
    "marks AS (SELECT a.batch, max(b.top) - INTERVAL '1 day' AS mark FROM tops a LEFT JOIN tops b ON b.batch < a.batch "
    "GROUP BY a.batch), "
    "vv AS (SELECT event_id, copy, " + PING_COLS + " FROM ok JOIN marks USING (batch) WHERE mark IS NULL OR event_time > mark)")
ORACLE["stream_silver_late"] = with_ctes(PINGS_CTES, SILVER_CTES.replace(VALID_CTE, _LATE_VALID), body=(
    "SELECT " + PING_COLS + ", progress_pct, is_moving, dist_to_route_km, at_facility FROM silver"))
ORACLE["stream_current_state"] = ORACLE["latest_state"]
ORACLE["stream_status"] = ORACLE["gold_status"]
ORACLE["stream_exceptions"] = gold_sql(
    "SELECT * FROM gexc WHERE window_end <= (SELECT max(event_time) FROM silver) "
    "- INTERVAL '2 minutes'")
