"""ETA data jobs: skew-safe trailing window vs brute force, training set,
request validation, scoring with a Spark ML model, gate and registry."""
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from waymark.config import Settings
from waymark.operators import eta, model as mdl, rolling


@pytest.mark.parametrize("bucket", [60, 3600])
def test_trailing_mean_matches_plain_window(lake01, bucket):
    s = lake01.silver.select("shipment_id", "seq", "event_time", "speed_kmh")
    got = rolling.trailing_mean(s, "shipment_id", "event_time", "seq", "speed_kmh", "m", 5,
                                Settings(rolling_bucket_seconds=bucket))
    w = Window.partitionBy("shipment_id").orderBy("event_time", "seq").rowsBetween(-4, 0)
    ref = s.withColumn("m", F.avg("speed_kmh").over(w))
    assert got.count() == ref.count()
    assert got.exceptAll(ref.select(*got.columns)).count() == 0


def test_latest_trailing_mean_matches_brute_force(lake01):
    s = lake01.silver.select("shipment_id", "seq", "event_time", "speed_kmh")
    got = rolling.latest_trailing_mean(s, "shipment_id", "event_time", "seq", "speed_kmh", "m", 5,
                                       Settings(rolling_bucket_seconds=60))
    w = Window.partitionBy("shipment_id").orderBy(F.desc("event_time"), F.desc("seq"))
    ref = (s.withColumn("rn", F.row_number().over(w)).where("rn <= 5")
            .groupBy("shipment_id").agg(F.avg("speed_kmh").alias("m")))
    near = lambda df: df.select("shipment_id", F.round("m", 9).alias("m"))    # sums in another order
    assert near(got).exceptAll(near(ref)).count() == 0 and got.count() == 150


def test_training_set_completed_trips(lake01):
    t = lake01.training
    done = eta.arrivals(lake01.silver).count()
    assert t.select("shipment_id").distinct().count() == done > 100
    assert t.count() == 6956
    assert t.where("minutes_to_arrival < 0 OR dist_remaining_km < 0").count() == 0
    # the arrival ping has label 0 and nothing left to drive
    assert t.where("minutes_to_arrival = 0").where("dist_remaining_km = 0").count() == done


def test_metrics_of_large_and_constant_labels(spark):
    df = spark.createDataFrame([(1e8 + i, 1e8 + i + (1.0 if i % 2 else -1.0)) for i in range(6)],
                               "minutes_to_arrival double, pred double")
    r = eta.regression_metrics(df, "pred").first()
    assert r.r2 == pytest.approx(1 - 6 / 17.5, abs=1e-6)       # SSE 6, SST 17.5
    same = spark.createDataFrame([(5.0, 4.0), (5.0, 6.0)], "minutes_to_arrival double, pred double")
    r = eta.regression_metrics(same, "pred").first()
    assert (r.mae, r.r2) == (1.0, None)


def test_nan_requests_count_as_missing(spark):
    from datetime import datetime
    nan = float("nan")
    req = spark.createDataFrame([("a", "R", 10.0, nan, nan, nan, nan, None, None, datetime(2024, 1, 1)),
                                 ("b", "R", nan, 1.0, 1.0, 1.0, 1.0, None, None, datetime(2024, 1, 1))], eta.REQUEST_SCHEMA)
    r = eta.score(eta.request_features(req)).collect()
    assert [(x.request_id, x.predicted_eta_min, x.avg_speed_kmh) for x in r] == [("a", 24.0, 0.0)]
    assert [x.reason for x in eta.reject_requests(req).collect()] == ["dist_remaining_km missing"]


def test_request_validation_and_defaults(spark):
    from datetime import datetime
    req = spark.createDataFrame(
        [("a", "R-SIN-JHB", 10.0, None, 30.0, None, None, None, None, datetime(2024, 1, 1, 8, 0)),
         ("b", "R-SIN-JHB", -1.0, None, 30.0, None, None, None, None, datetime(2024, 1, 1, 8, 0)),
         ("c", None, 1.0, None, 30.0, None, None, None, None, datetime(2024, 1, 1, 8, 0)),
         ("d", "R-X", 6.0, 50.0, 2.0, 4.0, 0.5, 23, 6, datetime(2024, 1, 1, 8, 0))],
        "request_id string, route_id string, dist_remaining_km double, progress_pct double, "
        "speed_kmh double, avg_speed_kmh double, dist_to_route_km double, hour int, dow int, as_of timestamp")
    rej = {r.request_id: r.reason for r in eta.reject_requests(req).collect()}
    assert rej == {"b": "dist_remaining_km must be >= 0", "c": "route_id missing"}
    f = {r.request_id: r for r in eta.score(eta.request_features(req)).collect()}
    assert set(f) == {"a", "d"}
    a, d = f["a"], f["d"]
    assert (a.hour, a.dow, a.avg_speed_kmh, a.is_stopped, a.progress_pct) == (8, 0, 30.0, 0, 0.0)
    assert a.predicted_eta_min == 20.0 and a.method == "fallback"
    assert (d.hour, d.dow, d.is_stopped) == (23, 6, 1)
    assert d.predicted_eta_min == round(6.0 / 25.0 * 60.0, 1)   # avg 4 <= 5 -> 25 km/h


def test_gbt_model_scores_and_unknown_route(spark, lake01):
    train, test = mdl.split(lake01.training)
    assert train.join(test, "shipment_id").count() == 0          # trips never straddle
    m = mdl.fit(train, dict(maxIter=10, maxDepth=4))
    metrics = mdl.evaluate(m, test).first()
    assert metrics.r2 > 0.5
    feats = eta.request_features(lake01.requests()).limit(50).withColumn("route_id", F.lit("R-NEW"))
    scored = eta.score(feats, m, model_version=3)
    assert scored.where("method = 'model' AND predicted_eta_min IS NOT NULL AND model_version = 3").count() == 50
    # an unseen route is the zero vector, a known one a single 1
    vec = lambda df: m.transform(df).first()["route_vec"]
    assert vec(feats).numNonzeros() == 0
    assert vec(feats.withColumn("route_id", F.lit("R-SIN-JHB"))).toArray().sum() == 1.0
    # a row with a missing feature is not the model's
    gap = eta.score(feats.withColumn("speed_kmh", F.lit(float("nan"))), m, model_version=3)
    assert gap.where("method = 'fallback' AND model_version IS NULL").count() == 50


def test_promotion_gate_rules(spark):
    df = spark.createDataFrame([(10.0, 11.0, 10.5), (20.0, 19.0, 19.6)],
                               "minutes_to_arrival double, champ double, chal double")
    r = eta.promotion_gate(df, "champ", "chal").first()
    assert (r.champion_mae, r.challenger_mae, r.promote) == (1.0, 0.45, True)
    r = eta.promotion_gate(df, "chal", "champ").first()
    assert r.promote is False
    assert eta.promotion_gate(df, None, "chal").first().promote is True


def test_registry_alias_resolution(spark, lake01, tmp_path):
    train, test = mdl.split(lake01.training)
    m = mdl.fit(train.limit(500), dict(maxIter=3, maxDepth=3))
    reg = str(tmp_path / "registry")
    v1 = mdl.register(spark, reg, m, "eta", 3.0)
    v2 = mdl.register(spark, reg, m, "eta", 2.0)
    assert (v1, v2) == (1, 2)
    assert mdl.resolve_alias(spark, reg, "eta") is None
    mdl.set_alias(spark, reg, "eta", "production", v2)
    assert mdl.resolve_version(spark, reg, "eta")[1] == v2
    # a registry that exists but can't be read raises, and a version is never overwritten
    from pyspark.errors import AnalysisException
    spark.createDataFrame([("eta",)], "model string").write.mode("overwrite").parquet(f"{reg}-bad/versions")
    with pytest.raises(AnalysisException):
        mdl.register(spark, f"{reg}-bad", m, "eta", 1.0)
    with pytest.raises(Exception, match="(?i)exists"):
        m.write().save(f"{reg}/models/eta/v1")


def test_racing_registrations_get_different_versions(spark, lake01, tmp_path):
    from concurrent.futures import ThreadPoolExecutor
    m = mdl.fit(mdl.split(lake01.training)[0].limit(300), dict(maxIter=2, maxDepth=2))
    reg = str(tmp_path / "registry")
    with ThreadPoolExecutor(4) as pool:
        got = list(pool.map(lambda i: mdl.register(spark, reg, m, "eta", float(i)), range(4)))
    assert sorted(got) == [1, 2, 3, 4]
    rows = spark.read.option("recursiveFileLookup", "true").parquet(f"{reg}/versions").collect()
    assert {(r.version, r.mae) for r in rows} == {(v, float(i)) for i, v in enumerate(got)}
    # a writer that claimed a number and failed: the number is not given again
    assert mdl.claim_version(spark, reg, "eta") == 5
    assert mdl.register(spark, reg, m, "eta", 9.0) == 6
    assert mdl.claim_version(spark, reg, "other") == 1


def test_permutation_importance_shape(spark, lake01):
    train, test = mdl.split(lake01.training)
    m = mdl.fit(train, dict(maxIter=5, maxDepth=4))
    imp = mdl.permutation_importance(m, test, repeats=2, rows_per_bucket=100).collect()
    assert len(imp) == 9
    top = imp[0]
    assert top.importance > 0


def test_gbt_early_stopping_on_validation_trips(lake01):
    train, test = mdl.split(lake01.training)
    m = mdl.fit(train, dict(maxIter=200, maxDepth=4, stepSize=0.3), validation_pct=10)
    gbt = m.stages[-1]
    assert gbt.getNumTrees < 200                     # stopped early
    assert mdl.evaluate(m, test).first().r2 > 0.5


def test_registered_keys_fit_the_operators_own_size(spark, lake001, monkeypatch, tmp_path):
    from waymark.plans import catalog, tables
    SF001 = lake001.sf_dir
    sizes, real = [], mdl.eta_pipeline

    def small(params=None):
        gbt = real(params).getStages()[-1]
        sizes.append((gbt.getMaxIter(), gbt.getMaxDepth(), gbt.getStepSize()))
        return real(dict(maxIter=2, maxDepth=2))

    monkeypatch.setattr(mdl, "eta_pipeline", small)
    monkeypatch.setattr(tables, "_TABLES", {})          # models of this test stay in it
    monkeypatch.setattr(tables, "oracle_copy", lambda: str(tmp_path))
    for key in ("eta_model_metrics", "feature_importance", "score_requests_model", "shipment_board_model",
                "eta_for_shipment_model", "method_mix"):
        assert catalog.QUERIES[key](spark, SF001).count() > 0
    assert sizes == [(400, 8, 0.08)]                    # one fit for all of them
    assert catalog.QUERIES["promotion_gate"](spark, SF001).count() == 1
    assert sizes == [(400, 8, 0.08), (600, 10, 0.06)]


def test_ensemble_table_is_the_model(spark, lake01, tmp_path):
    """The node table, walked row by row, gives the model's own predictions."""
    train, test = mdl.split(lake01.training)
    m = mdl.fit(train, dict(maxIter=6, maxDepth=5))
    m.write().save(str(tmp_path / "m"))
    nodes = {}
    weight = {}
    for r in mdl.ensemble(m, str(tmp_path / "m")).collect():
        nodes[r.tree, r.node] = r
        weight[r.tree] = r.weight
    assert len(weight) == 6 and weight[0] == 1.0
    assert any(r.feature == "route_id" for r in nodes.values())
    for row in m.transform(test.limit(300)).collect():
        total = 0.0
        for t in sorted(weight):
            r = nodes[t, 0]
            while r.feature is not None:
                x = float(row.route_id == r.level) if r.feature == "route_id" else float(row[r.feature])
                r = nodes[t, r.left if x <= r.threshold else r.right]
            total += weight[t] * r.value
        assert abs(total - row.prediction) < 1e-9


def test_boosting_starts_from_checkpointed_vectors(spark, lake01, monkeypatch):
    """Each level of each tree is a job whose tasks carry the lineage of the rows boosted on."""
    from pyspark.ml.regression import GBTRegressor
    seen, real = [], GBTRegressor.fit

    def fit(self, rows, *args):
        seen.append((rows.columns, rows._jdf.queryExecution().analyzed().toString(), self.getCacheNodeIds()))
        return real(self, rows, *args)

    monkeypatch.setattr(GBTRegressor, "fit", fit)
    train, test = mdl.split(lake01.training)
    m = mdl.fit(train, dict(maxIter=2, maxDepth=2))
    columns, plan, node_ids = seen[0]
    assert columns == ["features", mdl.TARGET] and plan.startswith("LogicalRDD") and "\n" not in plan.strip()
    assert node_ids is False
    whole = mdl.eta_pipeline(dict(maxIter=2, maxDepth=2)).fit(train)      # the same model as in one pipeline
    assert m.stages[-1].toDebugString.split("\n")[1:] == whole.stages[-1].toDebugString.split("\n")[1:]
    assert m.transform(test).columns == whole.transform(test).columns
