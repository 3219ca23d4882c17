"""Geometry as Spark Column expressions (JVM-side, no Python workers).

All functions take and return ``Column`` objects, so they compose inside
``select``/``where``/``transform`` and stay in whole-stage codegen where the
surrounding operator allows it.  The operation order mirrors the textbook
formulas so that a SQL engine evaluating the same formula gets the same bits.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from waymark.config import DEFAULT, Settings


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(x)


def haversine_km(lat1, lon1, lat2, lon2, settings: Settings = DEFAULT) -> Column:
    """Great-circle distance in km (mean earth radius)."""
    lat1, lon1, lat2, lon2 = map(_c, (lat1, lon1, lat2, lon2))
    h = (F.pow(F.sin((F.radians(lat2) - F.radians(lat1)) / 2), 2)
         + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2))
         * F.pow(F.sin((F.radians(lon2) - F.radians(lon1)) / 2), 2))
    return F.lit(2.0) * F.lit(settings.earth_km) * F.asin(F.sqrt(h))


def project_x(lon, settings: Settings = DEFAULT) -> Column:
    """Equirectangular x in km around the reference latitude."""
    return F.radians(_c(lon)) * F.lit(settings.cos_lat0) * F.lit(settings.earth_km)


def project_y(lat, settings: Settings = DEFAULT) -> Column:
    """Equirectangular y in km."""
    return F.radians(_c(lat)) * F.lit(settings.earth_km)


def point_segment_km(px, py, ax, ay, bx, by) -> Column:
    """Distance from point p to segment a-b, all in projected km.

    The projection parameter t is clamped to [0, 1]; a zero-length segment
    degenerates to the point distance.
    """
    px, py, ax, ay, bx, by = map(_c, (px, py, ax, ay, bx, by))
    len2 = (bx - ax) * (bx - ax) + (by - ay) * (by - ay)
    t = F.greatest(F.lit(0.0), F.least(
        F.lit(1.0), ((px - ax) * (bx - ax) + (py - ay) * (by - ay)) / len2))
    on_seg = F.sqrt(F.pow(px - (ax + t * (bx - ax)), 2) + F.pow(py - (ay + t * (by - ay)), 2))
    to_a = F.sqrt(F.pow(px - ax, 2) + F.pow(py - ay, 2))
    return F.when(len2 == 0, to_a).otherwise(on_seg)


def bearing_deg(lat1, lon1, lat2, lon2) -> Column:
    """Initial compass bearing from point 1 to point 2, degrees in [0, 360)."""
    lat1, lon1, lat2, lon2 = map(_c, (lat1, lon1, lat2, lon2))
    dlon = F.radians(lon2 - lon1)
    x = F.sin(dlon) * F.cos(F.radians(lat2))
    y = (F.cos(F.radians(lat1)) * F.sin(F.radians(lat2))
         - F.sin(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.cos(dlon))
    return (F.degrees(F.atan2(x, y)) + F.lit(360.0)) % F.lit(360.0)


def offset_lat(lat, dy_km) -> Column:
    """Latitude shifted by dy_km to the north."""
    return _c(lat) + _c(dy_km) / F.lit(110.574)


def offset_lon(lat, lon, dx_km) -> Column:
    """Longitude shifted by dx_km to the east (at the point's latitude)."""
    return _c(lon) + _c(dx_km) / (F.lit(111.320) * F.cos(F.radians(_c(lat))))


# SQL-text forms of the same formulas, used when an expression is unrolled
# over many constant points: one parsed expression instead of hundreds of
# Column calls through the Python/JVM bridge.  Same operation order as above.

def sql_num(x: float) -> str:
    return f"({float(x)!r}D)"


def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str,
                  settings: Settings = DEFAULT) -> str:
    h = (f"(pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) + "
         f"cos(radians({lat1})) * cos(radians({lat2})) * "
         f"pow(sin((radians({lon2}) - radians({lon1})) / 2), 2))")
    return f"({sql_num(2.0)} * {sql_num(settings.earth_km)} * asin(sqrt({h})))"


def point_segment_sql(px: str, py: str, seg: str) -> str:
    """``seg``: a struct of the segment's start ax, ay, extent dx, dy and squared length len2,
    which isn't 0."""
    ax, ay, dx, dy, len2 = (f"{seg}.{c}" for c in ("ax", "ay", "dx", "dy", "len2"))
    t = (f"greatest({sql_num(0.0)}, least({sql_num(1.0)}, "
         f"(({px} - {ax}) * {dx} + ({py} - {ay}) * {dy}) / {len2}))")
    return (f"sqrt(pow({px} - ({ax} + {t} * {dx}), 2) + "
            f"pow({py} - ({ay} + {t} * {dy}), 2))")
