"""Per-ping and per-shipment scalar rules as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from waymark.config import DEFAULT, Settings
from waymark.functions.geo import _c

# Status names and their map colours (R, G, B).
STATUS_COLORS = {
    "IN_TRANSIT": (38, 166, 91),
    "OFF_ROUTE": (217, 48, 37),
    "STOPPED": (241, 156, 24),
    "AT_FACILITY": (41, 98, 255),
}


def progress_pct(dist_km="dist_km", total_km="total_km") -> Column:
    """Share of the route covered, 1 dp; 0 when the total is missing or not positive."""
    dist_km, total_km = _c(dist_km), _c(total_km)
    return F.round(F.when(total_km > 0, dist_km / total_km * F.lit(100.0))
                   .otherwise(F.lit(0.0)), 1)


def is_moving(speed="speed_kmh", settings: Settings = DEFAULT) -> Column:
    return _c(speed) >= F.lit(settings.moving_speed_kmh)


def is_stopped(speed="speed_kmh", settings: Settings = DEFAULT) -> Column:
    """Serving rule: 1 when speed < 3 km/h (NULL speed -> NULL)."""
    return (_c(speed) < F.lit(settings.stopped_speed_kmh)).cast("int")


def dist_remaining_km(total_km="total_km", dist_km="dist_km") -> Column:
    """max(0, total - covered); NULL when either side is NULL."""
    diff = _c(total_km) - _c(dist_km)
    return F.when(diff.isNull(), F.lit(None).cast("double")).otherwise(
        F.greatest(F.lit(0.0), diff))


def hour_of(ts) -> Column:
    return F.hour(_c(ts)).cast("int")


def weekday_of(ts) -> Column:
    """Day of week with Monday = 0."""
    return F.weekday(_c(ts)).cast("int")


def zero_if_null(x) -> Column:
    return F.coalesce(_c(x), F.lit(0.0))


def fallback_eta_min(dist_remaining, avg_speed, settings: Settings = DEFAULT) -> Column:
    """Distance / speed estimate in minutes, 1 dp.

    The trailing average speed is trusted only above 5 km/h; otherwise an
    assumed 25 km/h is used.
    """
    speed = F.when(_c(avg_speed) > F.lit(settings.fallback_min_avg_kmh), _c(avg_speed)) \
        .otherwise(F.lit(settings.fallback_speed_kmh))
    return F.round(_c(dist_remaining) / speed * F.lit(60.0), 1)


def shipment_status(dist_to_route="dist_to_route_km", at_facility="at_facility",
                    speed="speed_kmh", settings: Settings = DEFAULT) -> Column:
    """First matching rule: OFF_ROUTE -> AT_FACILITY -> STOPPED -> IN_TRANSIT."""
    d, fac, sp = _c(dist_to_route), _c(at_facility), _c(speed)
    return (F.when(d > F.lit(settings.off_route_km), F.lit("OFF_ROUTE"))
            .when(fac.isNotNull() & (fac != F.lit("")), F.lit("AT_FACILITY"))
            .when(sp < F.lit(settings.stopped_speed_kmh), F.lit("STOPPED"))
            .otherwise(F.lit("IN_TRANSIT")))


def status_color(status="status") -> Column:
    """Map colour of a status as array<int> (R, G, B)."""
    pairs = []
    for name, rgb in STATUS_COLORS.items():
        pairs += [F.lit(name), F.array(*[F.lit(v) for v in rgb])]
    return F.create_map(*pairs)[_c(status)]
