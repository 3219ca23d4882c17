"""The ping recipe and the Silver/Gold reference forms in plain SQL (DuckDB).

These strings are the independent oracle: the Silver distance and facility
columns are computed here with join-and-aggregate SQL, unlike the engine's
array expressions.  Every fractional literal is a double.
"""

# The route network and facilities as SQL VALUES lists.
_WAYPOINTS = """
wp AS (SELECT * FROM (VALUES
 (0,'R-PORT-TUAS',0,1.2644e0,103.84e0),(0,'R-PORT-TUAS',1,1.28e0,103.8e0),
 (0,'R-PORT-TUAS',2,1.3e0,103.74e0),(0,'R-PORT-TUAS',3,1.32e0,103.68e0),
 (0,'R-PORT-TUAS',4,1.33e0,103.63e0),
 (1,'R-SIN-JHB',0,1.283e0,103.851e0),(1,'R-SIN-JHB',1,1.334e0,103.847e0),
 (1,'R-SIN-JHB',2,1.39e0,103.84e0),(1,'R-SIN-JHB',3,1.431e0,103.769e0),
 (1,'R-SIN-JHB',4,1.464e0,103.766e0),
 (2,'R-CHANGI-JURONG',0,1.356e0,103.988e0),(2,'R-CHANGI-JURONG',1,1.35e0,103.93e0),
 (2,'R-CHANGI-JURONG',2,1.338e0,103.85e0),(2,'R-CHANGI-JURONG',3,1.33e0,103.76e0),
 (2,'R-CHANGI-JURONG',4,1.329e0,103.718e0),
 (3,'R-WOODLANDS-SELETAR',0,1.436e0,103.786e0),(3,'R-WOODLANDS-SELETAR',1,1.42e0,103.82e0),
 (3,'R-WOODLANDS-SELETAR',2,1.41e0,103.85e0),(3,'R-WOODLANDS-SELETAR',3,1.405e0,103.868e0)
) t(rk,route_id,i,lat,lon))"""

_FACILITIES = """
fac AS (SELECT * FROM (VALUES
 (0,'PSA Port',1.2644e0,103.84e0),(1,'Tuas Megaport',1.33e0,103.63e0),
 (2,'Singapore CBD',1.283e0,103.851e0),(3,'JB Sentral',1.464e0,103.766e0),
 (4,'Changi Air Cargo',1.356e0,103.988e0),(5,'Jurong Industrial',1.329e0,103.718e0),
 (6,'Woodlands',1.436e0,103.786e0),(7,'Seletar Aerospace',1.405e0,103.868e0)
) t(ord,name,flat,flon))"""


def hav(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (f"(2e0*6371.0088e0*asin(sqrt(pow(sin((radians({lat2})-radians({lat1}))/2),2)"
            f"+cos(radians({lat1}))*cos(radians({lat2}))"
            f"*pow(sin((radians({lon2})-radians({lon1}))/2),2))))")


def bearing(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    dl = f"radians({lon2}-{lon1})"
    x = f"sin({dl})*cos(radians({lat2}))"
    y = (f"cos(radians({lat1}))*sin(radians({lat2}))"
         f"-sin(radians({lat1}))*cos(radians({lat2}))*cos({dl})")
    return f"((degrees(atan2({x},{y}))+360e0)%360e0)"


PX = "radians({p}.lon)*0.9997224302180006e0*6371.0088e0"
PY = "radians({p}.lat)*6371.0088e0"

PINGS_CTES = ",\n".join([
    _WAYPOINTS.strip(),
    _FACILITIES.strip(),
    "seg0 AS (SELECT rk,route_id,i,lat,lon,lead(lat) OVER (PARTITION BY rk ORDER BY i) lat2,"
    "lead(lon) OVER (PARTITION BY rk ORDER BY i) lon2 FROM wp)",
    f"seg1 AS (SELECT *, {hav('lat','lon','lat2','lon2')} AS len, "
    f"{bearing('lat','lon','lat2','lon2')} AS brg FROM seg0 WHERE lat2 IS NOT NULL)",
    "seg2 AS (SELECT *, sum(len) OVER (PARTITION BY rk ORDER BY i ROWS UNBOUNDED PRECEDING) AS run "
    "FROM seg1)",
    "seg AS (SELECT *, run-len AS cum, max(run) OVER (PARTITION BY rk) AS total, "
    "row_number() OVER (PARTITION BY rk ORDER BY i DESC) AS rn, "
    "radians(lon)*0.9997224302180006e0*6371.0088e0 AS ax, radians(lat)*6371.0088e0 AS ay, "
    "radians(lon2)*0.9997224302180006e0*6371.0088e0 AS bx, radians(lat2)*6371.0088e0 AS yb "
    "FROM seg2)",
    "tot AS (SELECT DISTINCT rk, route_id, total FROM seg)",
    "e0 AS (SELECT event_id, user_id, event_type, value, coalesce(user_id, 0) AS s, "
    "coalesce(TRY_CAST(nullif(regexp_extract(props, '\"k\": *([0-9]+)', 1), '') AS INTEGER), 0) AS k, "
    "date_trunc('second', ts) AS tsec FROM events)",
    "e1 AS (SELECT e0.*, tot.route_id, tot.total, tot.rk, "
    "(CAST(epoch(tsec) AS BIGINT) - 1704067200 + s % 7 * 86400) / 2073600e0 AS gone "
    "FROM e0 LEFT JOIN tot ON tot.rk = s % 4)",
    "e3 AS (SELECT *, total * least(1e0, gone) AS dist FROM e1)",
    "e4 AS (SELECT e3.*, g.brg, g.lat+(g.lat2-g.lat)*(dist-g.cum)/g.len AS plat, "
    "g.lon+(g.lon2-g.lon)*(dist-g.cum)/g.len AS plon, "
    "CASE WHEN event_type='click' AND k>=90 THEN 3e-2 ELSE 0e0 END AS detour FROM e3 LEFT JOIN seg g ON g.rk=e3.rk "
    "AND dist>=g.cum AND (dist<g.cum+g.len OR g.rn=1))",
    """p0 AS (SELECT event_id,
  CASE WHEN user_id IS NULL OR (event_type='error' AND k BETWEEN 20 AND 21) THEN NULL ELSE concat('SHP-',lpad(CAST(s+1 AS VARCHAR),5,'0')) END AS shipment_id,
  concat('VEH-',lpad(CAST((s+1)%12 AS VARCHAR),3,'0')) AS vehicle_id,
  CASE WHEN event_type='error' AND k BETWEEN 15 AND 19 THEN 'R-UNKNOWN' ELSE route_id END AS route_id,
  CASE WHEN event_type='error' AND k<10 THEN NULL WHEN event_type='error' AND k BETWEEN 10 AND 14 THEN 95e0 ELSE round(CAST(plat+detour+(k%13-6)*1e-4 AS DOUBLE),6) END AS lat,
  round(CAST(plon+detour AS DOUBLE),6) AS lon,
  CASE WHEN event_type='signup' THEN 0e0 ELSE round(CAST(value AS DOUBLE),1) END AS speed_kmh,
  round(brg,1) AS heading,
  round(CAST(dist AS DOUBLE),3) AS dist_km, round(CAST(total AS DOUBLE),3) AS total_km,
  CAST(event_id+1 AS BIGINT) AS seq, CAST(tsec AS TIMESTAMP) AS event_time, event_type='purchase' AND k%10=7 AS twice FROM e4)""",
    "pings AS (SELECT * EXCLUDE (twice), 0 AS copy FROM p0 UNION ALL "
    "SELECT * EXCLUDE (twice) REPLACE (round(CAST(speed_kmh+1e0 AS DOUBLE),1) AS speed_kmh), 1 AS copy FROM p0 WHERE twice)",
])

PING_COLS = ("shipment_id, vehicle_id, route_id, lat, lon, speed_kmh, heading, dist_km, "
             "total_km, seq, event_time")

# validate + dedup (of deliveries that share shipment and seq, the first stays)
VALID_CTE = ("vv AS (SELECT event_id, copy, " + PING_COLS + " FROM pings WHERE shipment_id IS NOT NULL "
             "AND lat IS NOT NULL AND lon IS NOT NULL AND lat BETWEEN -90 AND 90 "
             "AND lon BETWEEN -180 AND 180)")
DEDUP_CTE = ("dd AS (SELECT event_id, " + PING_COLS + " FROM (SELECT *, row_number() OVER (PARTITION BY "
             "shipment_id, seq ORDER BY event_id, copy) AS nth FROM vv) z WHERE nth = 1 OR seq IS NULL)")

SILVER_CTES = ",\n".join([
    VALID_CTE, DEDUP_CTE,
    "xy AS (SELECT dd.event_id, " + PX.format(p="dd") + " px, " + PY.format(p="dd") + " py, "
    "g.ax, g.ay, g.bx, g.yb FROM dd JOIN seg g ON g.route_id=dd.route_id)",
    "tt AS (SELECT *, greatest(0e0,least(1e0,((px-ax)*(bx-ax)+(py-ay)*(yb-ay))"
    "/((bx-ax)*(bx-ax)+(yb-ay)*(yb-ay)))) t FROM xy)",
    "dr AS (SELECT event_id, round(min(sqrt(pow(px-(ax+t*(bx-ax)),2)+pow(py-(ay+t*(yb-ay)),2))),3) "
    "AS dist_to_route_km FROM tt GROUP BY event_id)",
    f"fd AS (SELECT dd.event_id, fac.name, fac.ord, {hav('dd.lat','dd.lon','flat','flon')} AS d "
    "FROM dd CROSS JOIN fac)",
    "fr AS (SELECT event_id, name FROM (SELECT *, row_number() OVER (PARTITION BY event_id "
    "ORDER BY d, ord) rn FROM fd) z WHERE rn=1 AND d<=0.8e0)",
    "silver AS (SELECT dd.*, round(CAST(CASE WHEN total_km>0 THEN dist_km/total_km*100e0 "
    "ELSE 0e0 END AS DOUBLE),1) AS progress_pct, speed_kmh>=3.0e0 AS is_moving, "
    "dr.dist_to_route_km, fr.name AS at_facility FROM dd LEFT JOIN dr ON dr.event_id=dd.event_id "
    "LEFT JOIN fr ON fr.event_id=dd.event_id)",
])

GOLD_CTES = ",\n".join([
    "gstatus AS (SELECT shipment_id, route_id, lat, lon, speed_kmh, event_time, "
    "'OFF_ROUTE' AS event_type, CAST(dist_to_route_km AS VARCHAR) AS detail FROM silver "
    "WHERE dist_to_route_km > 1.5e0 UNION ALL SELECT shipment_id, route_id, lat, lon, speed_kmh, "
    "event_time, 'AT_FACILITY' AS event_type, at_facility AS detail FROM silver "
    "WHERE at_facility IS NOT NULL)",
    "gw AS (SELECT shipment_id, time_bucket(INTERVAL '30 seconds', event_time) AS window_start, "
    "arg_min(route_id, (event_time, seq)) AS route_id, max(speed_kmh) AS max_speed, "
    "max(dist_km)-min(dist_km) AS moved_km, max(at_facility) AS at_facility "
    "FROM silver GROUP BY 1, 2)",
    "gexc AS (SELECT shipment_id, route_id, window_start, "
    "window_start + INTERVAL '30 seconds' AS window_end, max_speed, moved_km, at_facility, "
    "CASE WHEN at_facility IS NOT NULL THEN 'DWELL' ELSE 'STOPPED' END AS event_type "
    "FROM gw WHERE moved_km < 0.08e0 AND max_speed < 5.0e0)",
])


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def pings_sql(body: str) -> str:
    return with_ctes(PINGS_CTES, body=body)


def silver_sql(body: str) -> str:
    return with_ctes(PINGS_CTES, SILVER_CTES, body=body)


def gold_sql(body: str) -> str:
    return with_ctes(PINGS_CTES, SILVER_CTES, GOLD_CTES, body=body)
