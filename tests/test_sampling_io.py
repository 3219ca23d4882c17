"""Sampling operators, single-shipment ETA and tolerant reads."""
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymark.operators import eta, fleet
from waymark.sources import tables


def test_thin_is_deterministic_and_about_half(lake01):
    t = lake01.training
    a, b = eta.thin(t), eta.thin(t.repartition(5))
    n, total = a.count(), t.count()
    assert 0.45 * total < n < 0.55 * total
    assert a.select("shipment_id", "seq").exceptAll(b.select("shipment_id", "seq")).count() == 0


def test_bootstrap_exact_n_with_replacement(lake01):
    s = eta.bootstrap_sample(lake01.training, 300)
    assert s.count() == 300
    assert set(s.columns) == set(lake01.training.columns)
    big = eta.bootstrap_sample(lake01.training.limit(50), 200)
    assert big.count() == 200
    assert big.groupBy("shipment_id", "seq").count().where("count > 1").count() > 0


def test_shipment_eta_one_and_unknown(lake01):
    one = eta.shipment_eta(lake01.silver, "SHP-00003").collect()
    assert len(one) == 1 and one[0].method == "fallback"
    all_ = {r.shipment_id: r.predicted_eta_min for r in
            eta.score(lake01.features.drop("event_time")).collect()}
    assert one[0].predicted_eta_min == all_["SHP-00003"]
    assert eta.shipment_eta(lake01.silver, "SHP-99999").count() == 0


def test_tolerant_reads(spark, tmp_path):
    schema = T.StructType([T.StructField("shipment_id", T.StringType()),
                           T.StructField("event_type", T.StringType())])
    missing = str(tmp_path / "nope")
    assert tables.read_table_or_empty(spark, missing, schema).count() == 0
    assert tables.read_table_or_none(spark, missing) is None
    assert fleet.exception_feed(None, None) is None
    assert tables.read_predictions(spark, missing).count() == 0
    # a table that exists without one of the columns is an error, not an empty table
    spark.createDataFrame([("a",)], "shipment_id string").write.parquet(str(tmp_path / "part"))
    with pytest.raises(AnalysisException):
        tables.read_table_or_empty(spark, str(tmp_path / "part"), schema)


def test_exception_feed_with_one_side_missing(lake001):
    feed = fleet.exception_feed(None, lake001.exceptions).collect()
    assert len(feed) == 25 and {r.event_type for r in feed} <= {"DWELL", "STOPPED"}
    ts = [r.ts for r in feed]
    assert ts == sorted(ts, reverse=True)
