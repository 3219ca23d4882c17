"""Tuning constants of the pipeline, in one frozen dataclass.

Every operator takes an optional ``settings`` argument; the defaults below
reproduce the thresholds of the system being re-built.
"""

from __future__ import annotations

import math
from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    # Stream and detection thresholds.
    watermark: str = "2 minutes"
    stop_window: str = "30 seconds"
    off_route_km: float = 1.5          # OFF_ROUTE when dist_to_route_km > this (strict)
    facility_radius_km: float = 0.8    # inside a geofence when distance <= this
    stop_moved_km: float = 0.08        # window counts as stopped when moved < this ...
    stop_max_speed: float = 5.0        # ... and max speed < this
    moving_speed_kmh: float = 3.0      # Silver is_moving: speed >= this
    stopped_speed_kmh: float = 3.0     # board status / serving is_stopped: speed < this

    # Serving and monitoring.
    psi_warn: float = 0.1
    psi_alert: float = 0.2
    fallback_speed_kmh: float = 25.0
    fallback_min_avg_kmh: float = 5.0  # use the trailing average only above this
    champion_margin: float = 0.01      # challenger must be 1 % better on MAE
    feed_limit: int = 25
    trailing_pings: int = 5
    psi_bins: int = 10
    psi_floor: float = 1e-4

    # Geometry.
    earth_km: float = 6371.0088
    lat0: float = 1.35                 # reference latitude of the local projection

    # Scale guards (not reference values).
    broadcast_max_rows: int = 50_000   # dimension tables above this are shuffle-joined
    broadcast_max_bytes: int = 64 << 20  # and by size
    facility_array_max: int = 256      # facility sets above this use the grid join
    unroll_max_segments: int = 64      # route networks up to this many segments are
                                       # compiled into one CASE/least expression
    unroll_max_facilities: int = 64    # same for the facility lookup
    segment_index_min: int = 2_000     # networks with more segments use the cell index
    segment_cell_km: float = 2.0       # cell size of that index's finest grid
    rolling_bucket_seconds: int = 3600 # time bucket of the skew-safe trailing window
    rolling_bucket_rows: int = 200_000 # a bucket with more rows is split by range

    @property
    def cos_lat0(self) -> float:
        return math.cos(math.radians(self.lat0))


DEFAULT = Settings()
