"""waymark — vehicle-telemetry analytics on Spark.

Pings -> Bronze (envelope decode) -> Silver (validate, de-duplicate, enrich)
-> Gold (status events, windowed stop/dwell exceptions) -> fleet state, ETA
training/scoring and input-drift monitoring.  Every transform is a
``DataFrame -> DataFrame`` function built from Spark SQL expressions, and the
same function serves batch and Structured Streaming inputs.
"""

from waymark.config import Settings, DEFAULT

__all__ = ["Settings", "DEFAULT"]
