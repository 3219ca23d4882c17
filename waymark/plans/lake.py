"""The lake tables of one input directory, derived lazily from ``events``.

``Lake`` wires the operators into the medallion chain (pings -> bronze ->
silver -> gold -> fleet state / ETA / drift).  Every property is a lazy
DataFrame; nothing is collected to the driver.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymark.config import DEFAULT, Settings
from waymark.operators import fleet, gold, silver as silver_ops
from waymark.plans import tables
from waymark.session import use_utc
from waymark.sources import envelope, network, recipe


def as_ntz(df: DataFrame) -> DataFrame:
    """Timestamps as TIMESTAMP_NTZ (UTC wall clock) for engine-neutral output."""
    cols = [F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
            for f in df.schema.fields]
    return df.select(*cols)


class Lake:
    """``materialized=True`` (default) keeps Bronze and Silver as written tables
    in the shared checkpoint folder, as the ingest and Silver jobs would; the
    ``*_plan`` properties give the same tables as plain lineage."""

    def __init__(self, spark: SparkSession, sf_dir: str, settings: Settings = DEFAULT,
                 materialized: bool = True):
        use_utc(spark)
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.settings = settings
        self.materialized = materialized

    def _key(self, name: str) -> tuple:
        src = f"{self.sf_dir}/events.parquet"
        return tables.table_key(self.spark, name, src, repr(self.settings))

    def _table(self, name: str, build) -> DataFrame:
        if not self.materialized:
            return build()
        return tables.materialize(self.spark, self._key(name), build,
                                  self._write_partitions(name))

    def table_path(self, name: str) -> str:
        """Folder of a materialised table ("bronze_pings" or "silver")."""
        {"bronze_pings": lambda: self.pings, "silver": lambda: self.silver,
         "training": lambda: self.training}[name]()
        path = tables.path_of(self._key(name))
        if path is None:
            raise RuntimeError(f"{name} is not materialised")
        return path

    def _write_partitions(self, name: str) -> int | None:
        if name != "bronze_pings":
            return None
        want = self.spark.sparkContext.defaultParallelism
        have = self.spark.read.parquet(f"{self.sf_dir}/events.parquet").rdd.getNumPartitions()
        return want if have < want else None

    # ------------------------------------------------------------ dimensions
    @cached_property
    def waypoints(self) -> DataFrame:
        return network.waypoints(self.spark)

    @cached_property
    def segments(self) -> DataFrame:
        return network.cached_dimension(network.segments(self.waypoints, self.settings))

    @cached_property
    def route_arrays(self) -> DataFrame:
        return network.cached_dimension(network.route_segment_arrays(self.segments))

    @cached_property
    def facilities(self) -> DataFrame:
        return network.facilities(self.spark)

    # ------------------------------------------------------------ bronze
    @cached_property
    def pings_plan(self) -> DataFrame:
        """Raw pings with re-deliveries (``copy`` = 1 for the second delivery)."""
        return recipe.pings(self.spark, self.sf_dir, self.settings, self.segments)

    @cached_property
    def pings(self) -> DataFrame:
        """The Bronze ping table (written once, then scanned)."""
        return self._table("bronze_pings", lambda: self.pings_plan)

    @cached_property
    def envelopes(self) -> DataFrame:
        return envelope.keyed_envelope(self.pings)

    @cached_property
    def bronze(self) -> DataFrame:
        return envelope.decode_envelope(self.envelopes)

    # ------------------------------------------------------------ silver
    @cached_property
    def ping_rows(self) -> DataFrame:
        return self.pings.select("event_id", "copy", *recipe.PING_COLUMNS)

    @cached_property
    def valid(self) -> DataFrame:
        return silver_ops.validate(self.ping_rows)

    @cached_property
    def deduped(self) -> DataFrame:
        return silver_ops.dedup(self.valid, arrival=("event_id", "copy")).drop("copy")

    @cached_property
    def silver_plan(self) -> DataFrame:
        """validate -> dedup -> enrich over the Bronze table (the Silver job)."""
        return silver_ops.enrich(self.deduped, self.route_arrays, self.facilities, self.settings)

    @cached_property
    def silver(self) -> DataFrame:
        """The Silver table (written once by the Silver job, then scanned)."""
        return self._table("silver", lambda: self.silver_plan)

    # ------------------------------------------------------------ gold
    @cached_property
    def status_events(self) -> DataFrame:
        return gold.status_events(self.silver, self.settings)

    @cached_property
    def exceptions(self) -> DataFrame:
        return gold.window_exceptions(self.silver, self.settings)

    # ------------------------------------------------------------ fleet state
    @cached_property
    def latest_state(self) -> DataFrame:
        return fleet.latest_state(self.silver)

    @cached_property
    def latest_nonnull(self) -> DataFrame:
        return fleet.latest_nonnull(self.silver)

    @cached_property
    def status(self) -> DataFrame:
        return fleet.with_status(self.latest_nonnull, self.settings)

    @cached_property
    def board(self) -> DataFrame:
        return fleet.board(self.status, self.settings)

    # ------------------------------------------------------------ ETA
    @cached_property
    def training_plan(self) -> DataFrame:
        from waymark.operators import eta
        return eta.training_set(self.silver, self.settings)

    @cached_property
    def training(self) -> DataFrame:
        """The training table (written once, like the training parquet file)."""
        return self._table("training", lambda: self.training_plan)

    def model(self, kind: str = "champion"):
        """A model fitted on the training trips, once for each version of the training
        table and set of parameters; every consumer reads that one.  Its node table is
        written next to it (``ensemble``)."""
        from waymark.operators import model as mdl
        params = mdl.PARAMS[kind]
        src = f"{self.sf_dir}/events.parquet"
        salt = repr(self.settings) + repr(sorted(params.items()))
        key = tables.table_key(self.spark, f"eta_{kind}", src, salt)
        path = tables.saved_model(self.spark, key, lambda: mdl.fit(mdl.split(self.training)[0], params))
        fitted = mdl.load(path)
        nodes = (key[0], f"eta_{kind}_nodes", key[2])
        if tables.path_of(nodes) is None:
            table = tables.materialize(self.spark, nodes, lambda: mdl.ensemble(fitted, path))
            if self.spark.sparkContext.master.startswith("local["):      # one machine, one process
                version = tables.data_version(self.spark.read.parquet(src))
                table.coalesce(1).write.mode("overwrite").parquet(
                    f"file://{tables.oracle_copy()}/kind={kind}/version={version}")
        return fitted

    def ensemble(self, kind: str = "champion") -> DataFrame:
        """The node table of ``model(kind)``."""
        from waymark.operators import model as mdl
        self.model(kind)
        salt = repr(self.settings) + repr(sorted(mdl.PARAMS[kind].items()))
        key = tables.table_key(self.spark, f"eta_{kind}_nodes", f"{self.sf_dir}/events.parquet", salt)
        return self.spark.read.parquet(tables.path_of(key))

    @cached_property
    def features(self) -> DataFrame:
        from waymark.operators import eta
        return eta.shipment_features(self.silver, self.settings)

    def requests(self, shifted: bool = False) -> DataFrame:
        from waymark.operators import eta
        return eta.requests_from_pings(self.silver, shifted)

    def scored_requests(self, shifted: bool = False, model=None) -> DataFrame:
        from waymark.operators import eta
        return eta.score(eta.request_features(self.requests(shifted), self.settings), model,
                         self.settings)

    def board_by(self, model) -> DataFrame:
        """The shipment board with the model's ETAs."""
        from waymark.operators import eta
        asked = eta.requests_from_board(self.status)
        by_model = eta.score(eta.request_features(asked, self.settings), model, self.settings)
        return fleet.board(self.status, self.settings, by_model.select(
            F.col("request_id").alias("shipment_id"), F.col("predicted_eta_min").alias("eta_min")))
