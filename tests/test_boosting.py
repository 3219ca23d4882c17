"""Trees grown without a Spark job a level, against Spark ML's own."""
import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from waymark.operators import boosting, model as mdl
from waymark.operators.eta import NUMERIC, TARGET


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    n = 1500
    cols = {"hour": rng.integers(0, 24, n), "dow": rng.integers(0, 7, n), "dist_remaining_km": rng.gamma(2, 9, n).round(3),
            "progress_pct": rng.uniform(0, 100, n).round(1), "speed_kmh": rng.normal(40, 20, n).round(1),
            "avg_speed_kmh": rng.uniform(0, 80, n).round(1), "dist_to_route_km": np.maximum(0, rng.normal(0, 1, n)).round(3),
            "is_stopped": rng.integers(0, 2, n)}
    route = rng.integers(0, 4, n)
    label = cols["dist_remaining_km"] * (1 + route) + cols["hour"] + rng.normal(0, 3, n)
    table = [(f"S{i % 90}", i, f"R{route[i]}", *[float(cols[c][i]) for c in NUMERIC], float(round(label[i], 2))) for i in range(n)]
    return spark.createDataFrame(table, ["shipment_id", "seq", "route_id", *NUMERIC, TARGET]).coalesce(1).cache()


def trees(model):
    return model.stages[-1].toDebugString.split("\n")[1:]


@pytest.mark.parametrize("validation", [None, 20])
def test_trees_are_spark_mls(rows, monkeypatch, validation):
    params = dict(maxIter=12, maxDepth=6, stepSize=0.3)
    got = mdl.fit(rows, params, validation)
    monkeypatch.setattr(boosting.BoostedTrees, "_fit", GBTRegressor._fit)
    assert trees(got) == trees(mdl.fit(rows, params, validation))


def test_a_fit_is_a_few_jobs(spark, rows):
    spark.sparkContext.setJobGroup("boost", "fit")
    try:
        mdl.fit(rows, dict(maxIter=30, maxDepth=5))
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("boost")) < 40      # Spark ML: more than 300
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("validation", [None, 20])
def test_joint_and_spread_counts_give_the_same_model(rows, monkeypatch, validation):
    params = dict(maxIter=8, maxDepth=5, stepSize=0.3)
    want = mdl.fit(rows, params, validation)
    monkeypatch.setattr(boosting, "EXACT_ROWS", 0)
    joint = mdl.fit(rows, params, validation)
    monkeypatch.setattr(boosting, "ALONE_ROWS", 100)
    monkeypatch.setattr(boosting, "TASK_ROWS", 500)
    monkeypatch.setattr(boosting, "RECENT", 5)                # workers also catch up from the broadcast log
    spread = mdl.fit(rows, params, validation)
    base = mdl.evaluate(want, rows).first()
    for m in (joint, spread):
        assert trees(m)[1:2] == trees(want)[1:2]              # the first split
        if validation:                                        # equal gains may be broken otherwise, which held-out rows see
            assert 1 <= m.stages[-1].getNumTrees <= 8
            continue
        assert m.stages[-1].getNumTrees == 8
        assert abs(mdl.evaluate(m, rows).first().mae - base.mae) < 0.05 * base.mae


def test_predictions_are_the_models(rows, tmp_path):
    m = mdl.fit(rows, dict(maxIter=7, maxDepth=5))
    m.write().save(str(tmp_path / "m"))
    odd = rows.withColumn("route_id", F.when(F.col("seq") % 7 == 0, "R-NEW").otherwise(F.col("route_id"))) \
        .withColumn("speed_kmh", F.when(F.col("seq") % 11 == 0, F.lit(float("nan"))).when(F.col("seq") % 13 != 0, F.col("speed_kmh")))
    for model in (m, PipelineModel.load(str(tmp_path / "m"))):
        got = boosting.predicted(model, odd)
        assert got.columns == model.transform(odd).columns
        both = got.select("seq", F.col("prediction").alias("p")).join(model.transform(odd).select("seq", "prediction"), "seq")
        assert both.where(F.abs(F.col("p") - F.col("prediction")) < 1e-9).count() == odd.count()


def test_missing_features_are_refused(rows):
    with pytest.raises(Exception, match="NaN or Infinity"):
        mdl.fit(rows.withColumn("speed_kmh", F.lit(None).cast("double")), dict(maxIter=2, maxDepth=2))
