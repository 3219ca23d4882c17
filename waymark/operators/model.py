"""ETA regressor on Spark ML: feature pipeline, training, evaluation,
permutation importance and a model registry table.

The pipeline one-hot encodes ``route_id`` (alphabetical levels; an unseen
route becomes the all-zero vector) and assembles the eight numeric features
after it.  The fitted ``PipelineModel`` carries the feature order, so scoring
can never drift from training.
"""

from __future__ import annotations

import math
import uuid

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymark.operators.boosting import BoostedTrees, predicted
from waymark.operators.eta import NUMERIC, TARGET, holdout_flag, regression_metrics
from waymark.session import checkpoint_root

# Boosting rounds and depth of the champion and of the challenger.
DEFAULT_PARAMS = dict(maxIter=400, maxDepth=8, stepSize=0.08, seed=42)
CHALLENGER_PARAMS = dict(maxIter=600, maxDepth=10, stepSize=0.06, seed=7)
PARAMS = {"champion": DEFAULT_PARAMS, "challenger": CHALLENGER_PARAMS}
#: Rows of one partition of the checkpointed vectors: few rows in many tasks cost more than they save.
FIT_ROWS = 25_000
#: Rows of one scoring task, each of them scored with every feature exchanged.
SCORE_ROWS = 20_000


def feature_pipeline() -> Pipeline:
    """route_id and the numeric columns -> ``features``."""
    return Pipeline(stages=[
        StringIndexer(inputCol="route_id", outputCol="route_idx", handleInvalid="keep",
                      stringOrderType="alphabetAsc"),
        # The indexer puts unseen routes last, and the last level is the zero vector.
        OneHotEncoder(inputCols=["route_idx"], outputCols=["route_vec"], dropLast=True,
                      handleInvalid="error"),
        VectorAssembler(inputCols=NUMERIC + ["route_vec"], outputCol="features",
                        handleInvalid="keep"),
    ])


def eta_pipeline(params: dict | None = None) -> Pipeline:
    p = dict(DEFAULT_PARAMS, **(params or {}))
    return Pipeline(stages=[
        *feature_pipeline().getStages(),
        # Of use where the fit is left to Spark ML: walking a tree anew costs less than a zipped
        # and stored table of node ids a level.
        BoostedTrees(featuresCol="features", labelCol=TARGET, predictionCol="prediction",
                     cacheNodeIds=False, checkpointInterval=5, **p),
    ])


def split(training: DataFrame, holdout_pct: int = 20) -> tuple[DataFrame, DataFrame]:
    """Train / held-out split by trip (hash of shipment_id): stable under any
    partitioning, and no trip is on both sides."""
    flag = holdout_flag("shipment_id", holdout_pct)
    return training.where(~flag), training.where(flag)


def fit(train: DataFrame, params: dict | None = None,
        validation_pct: int | None = None) -> PipelineModel:
    """Fit the pipeline.  ``validation_pct`` holds that share of the training
    trips out as GBT's validation set (``validationIndicatorCol``), so boosting
    stops once the validation error stops improving (early stopping).

    The feature stages run once and their vectors are checkpointed: every level of every
    tree is a Spark job, and each task of it carries its input's whole lineage."""
    p = dict(params or {})
    if validation_pct:
        bucket = F.conv(F.substring(F.md5(F.concat_ws("#", F.col("shipment_id"), F.lit("val"))),
                                    1, 8), 16, 10).cast("bigint") % 100
        train = train.withColumn("_is_val", bucket < validation_pct)
        p["validationIndicatorCol"] = "_is_val"
    few = math.ceil(train.count() / FIT_ROWS)
    if few < train.rdd.getNumPartitions():
        train = train.coalesce(max(1, few))
    *stages, gbt = eta_pipeline(p).getStages()
    features = Pipeline(stages=stages).fit(train)
    used = ["features", TARGET, *(["_is_val"] if validation_pct else [])]
    checkpoint_root(train.sparkSession)
    rows = features.transform(train).select(*used).checkpoint()
    return PipelineModel(stages=[*features.stages, gbt.fit(rows)])


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def ensemble(model: PipelineModel, path: str) -> DataFrame:
    """The trees of a saved model as a table, one row a node: tree, node, feature, level,
    threshold, left, right, value, weight.

    A row goes to ``left`` where its feature is at most ``threshold``; a route is 1 where
    it is ``level``, else 0.  Leaves have no feature.  The prediction is the sum over trees of
    weight times the value of the leaf reached.  Read from the node table that Spark saves
    with the model (``path``), so no tree passes through the driver.
    """
    spark = SparkSession.getActiveSession()
    at = f"{path}/stages/{len(model.stages) - 1}_{model.stages[-1].uid}"
    names = [(i, c, None) for i, c in enumerate(NUMERIC)]
    names += [(len(NUMERIC) + i, "route_id", r) for i, r in enumerate(model.stages[0].labels)]
    named = spark.createDataFrame(names, "index int, feature string, level string")
    weights = spark.read.parquet(f"{at}/treesMetadata").toDF("tree", "meta", "weight").select("tree", "weight")
    node = spark.read.parquet(f"{at}/data").select(F.col("treeID").alias("tree"), "nodeData.*")
    split, first = F.col("split"), F.get(F.col("split.leftCategoriesOrThreshold"), F.lit(0))
    # A one-hot slot has the categories 0 and 1: its split is a threshold between them, with
    # the children exchanged where 1 goes left.
    yes_no = split.numCategories == 2
    bad = F.raise_error(F.lit("a split of more than two categories has no threshold"))
    swap = yes_no & ~F.array_contains("split.leftCategoriesOrThreshold", F.lit(0.0))
    inner = F.col("leftChild") >= 0
    rows = node.select(
        "tree", F.col("id").alias("node"), F.when(inner, split.featureIndex).alias("index"),
        F.when(inner, F.when(split.numCategories == -1, first).when(yes_no, F.lit(0.5)).otherwise(bad)).alias("threshold"),
        F.when(inner, F.when(swap, F.col("rightChild")).otherwise(F.col("leftChild"))).alias("left"),
        F.when(inner, F.when(swap, F.col("leftChild")).otherwise(F.col("rightChild"))).alias("right"),
        F.col("prediction").alias("value"))
    return rows.join(named, "index", "left").join(weights, "tree").select(
        "tree", "node", "feature", "level", "threshold", "left", "right", "value", "weight")


def evaluate(model: PipelineModel, test: DataFrame) -> DataFrame:
    return regression_metrics(predicted(model, test), "prediction", TARGET)


def metrics_of(model: PipelineModel, training: DataFrame) -> DataFrame:
    """Held-out metrics of a model that was fitted on the other trips, and their rows."""
    train, test = split(training)
    return evaluate(model, test).withColumn("n_train", F.lit(train.count()).cast("bigint"))


def train_and_evaluate(training: DataFrame, params: dict | None = None
                       ) -> tuple[PipelineModel, DataFrame]:
    model = fit(split(training)[0], params)
    return model, metrics_of(model, training)


def both_predictions(champion: PipelineModel | None, challenger: PipelineModel, rows: DataFrame) -> DataFrame:
    """``rows`` with the columns challenger and (if there is one) champion, in one pass."""
    out = predicted(challenger, rows).withColumnRenamed("prediction", "challenger") \
                    .drop("route_idx", "route_vec", "features")
    if champion is not None:
        out = predicted(champion, out).withColumnRenamed("prediction", "champion") \
                      .drop("route_idx", "route_vec", "features")
    return out


def permutation_importance(model: PipelineModel, test: DataFrame, repeats: int = 5,
                           seed: int = 42, rows_per_bucket: int = 10_000) -> DataFrame:
    """Mean drop in R2 when one feature's values are shuffled across rows.

    All (feature, repeat) variants are scored in ONE ``transform`` pass.  The
    shuffle is a random permutation inside random buckets of
    ``rows_per_bucket`` rows (row_number over (repeat, bucket)), then
    an equi-join brings each row its permutation partner, so no
    window or group ever holds the whole test set.
    """
    feats = NUMERIC + ["route_id"]
    n = test.count()
    buckets = max(1, math.ceil(n / rows_per_bucket))
    rid = F.concat_ws("#", F.col("shipment_id"), F.col("seq").cast("string"))
    # One permutation per repeat serves all features: each row meets one donor that
    # carries every value, and the variants are made after the join, without a shuffle.
    rep = test.select(*feats, TARGET, rid.alias("_rid"), F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("r"))
    rep = rep.withColumn("_b", F.pmod(F.xxhash64("_rid", "r", F.lit(seed)), F.lit(buckets)))
    part = Window.partitionBy("r", "_b")
    rep = (rep.withColumn("_pos", F.row_number().over(part.orderBy("_rid")))
              .withColumn("_src", F.row_number().over(
                  part.orderBy(F.xxhash64("_rid", "r", F.lit(seed + 1)), "_rid"))))
    donors = rep.select("r", "_b", F.col("_src").alias("_pos"), F.struct(*feats).alias("_donor"))
    j = rep.select("r", "_b", "_pos", TARGET, *feats).join(donors, ["r", "_b", "_pos"])
    variants = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), *[
        (F.col(f"_donor.{c}") if c == f else F.col(c)).alias(c) for c in feats]) for f in feats]))
    # Few bytes, but much work: as many tasks as the scoring needs.
    j = j.repartition(max(test.sparkSession.sparkContext.defaultParallelism, math.ceil(n * repeats / SCORE_ROWS)))
    permuted = j.select("r", TARGET, variants.alias("_v")).select("r", TARGET, "_v.*")
    scored = predicted(model, permuted)
    err = F.col("prediction") - F.col(TARGET)
    r2_perm = scored.groupBy("f", "r").agg(
        (F.lit(1.0) - F.try_divide(F.avg(err * err), F.var_pop(TARGET))).alias("r2"))
    base_r2 = evaluate(model, test).select("r2").scalar()
    return (r2_perm.groupBy(F.col("f").alias("feature"))
                   .agg(F.round(base_r2 - F.avg("r2"), 6).alias("importance"),
                        F.round(F.stddev("r2"), 6).alias("importance_std"))
                   .orderBy(F.col("importance").desc(), "feature"))


# ------------------------------------------------------------------ registry

REGISTRY_SCHEMA = T.StructType([
    T.StructField("model", T.StringType()),
    T.StructField("version", T.LongType()),
    T.StructField("path", T.StringType()),
    T.StructField("mae", T.DoubleType()),
    T.StructField("created", T.TimestampType()),
])
ALIAS_SCHEMA = T.StructType([
    T.StructField("model", T.StringType()),
    T.StructField("alias", T.StringType()),
    T.StructField("version", T.LongType()),
    T.StructField("set_at", T.TimestampType()),
])


def claim_version(spark: SparkSession, registry_dir: str, name: str) -> int:
    """The next version number of ``name``, owned by this caller alone: the first number after
    all rows and claims whose claim file this caller is the one to create."""
    from waymark.sources import commits
    from waymark.sources.tables import read_table_or_empty
    versions = read_table_or_empty(spark, f"{registry_dir}/versions", REGISTRY_SCHEMA, folders=True)
    latest = versions.where(F.col("model") == name).agg(F.max("version")).first()[0] or 0
    claims = f"{registry_dir}/claims/{name}"
    version = max([int(latest), *[int(n[1:]) for n in commits.names(spark, claims)]]) + 1
    while not commits.create_once(spark, f"{claims}/v{version}"):
        version += 1
    return version


def register(spark: SparkSession, registry_dir: str, model: PipelineModel, name: str,
             mae: float | None) -> int:
    """Save the model under the registry folder and append a version row.  Its number is
    claimed first (``claim_version``), so writers that race get different ones; a number whose
    writer failed before its row stays unused."""
    from waymark.sources.tables import write_table
    version = claim_version(spark, registry_dir, name)
    path = f"{registry_dir}/models/{name}/v{version}"
    model.write().save(path)          # a version that exists is never overwritten
    row = spark.createDataFrame([(name, version, path, mae)],
                                "model string, version bigint, path string, mae double")
    # A folder for each row: appends to one folder at once would remove each other's files.
    write_table(row.withColumn("created", F.current_timestamp()), f"{registry_dir}/versions/{name}-v{version}")
    return version


def set_alias(spark: SparkSession, registry_dir: str, name: str, alias: str, version: int) -> None:
    from waymark.sources.tables import write_table
    row = spark.createDataFrame([(name, alias, version)], "model string, alias string, version bigint")
    write_table(row.withColumn("set_at", F.current_timestamp()), f"{registry_dir}/aliases/{name}-{uuid.uuid4().hex[:12]}")


def resolve_alias(spark: SparkSession, registry_dir: str, name: str,
                  alias: str = "production") -> PipelineModel | None:
    """The model that ``resolve_version`` finds."""
    return resolve_version(spark, registry_dir, name, alias)[0]


def resolve_version(spark: SparkSession, registry_dir: str, name: str = "eta-predictor",
                    alias: str = "production") -> tuple[PipelineModel | None, int | None]:
    """The model version the alias points to now (the latest assignment wins) and its
    number; resolved per job, so a promotion takes effect without a restart."""
    from waymark.sources.tables import read_table_or_empty
    aliases = read_table_or_empty(spark, f"{registry_dir}/aliases", ALIAS_SCHEMA, folders=True)
    cur = (aliases.where((F.col("model") == name) & (F.col("alias") == alias))
                  .agg(F.max_by("version", "set_at")).first()[0])
    if cur is None:
        return None, None
    versions = read_table_or_empty(spark, f"{registry_dir}/versions", REGISTRY_SCHEMA, folders=True)
    path = versions.where((F.col("model") == name) & (F.col("version") == cur)) \
                   .select("path").first()
    return (PipelineModel.load(path[0]), int(cur)) if path else (None, None)


# ------------------------------------------------------------------ train / retrain flows

def train_and_register(spark: SparkSession, training: DataFrame, registry_dir: str,
                       name: str = "eta-predictor", params: dict | None = None,
                       importance: bool = True) -> dict:
    """Fit on the training trips, evaluate on the held-out trips, register the
    model and point the ``production`` alias at it (first training run)."""
    train, test = split(training)
    model = fit(train, params)
    m = evaluate(model, test).first()
    version = register(spark, registry_dir, model, name, float(m.mae) if m.mae is not None else None)
    set_alias(spark, registry_dir, name, "production", version)
    out = {"version": version, "n_test": m.n, "mae": m.mae, "rmse": m.rmse, "r2": m.r2}
    if importance:
        top = permutation_importance(model, test).limit(6).collect()
        out["top_features"] = [(r.feature, r.importance) for r in top]
    return out


def champion_challenger(spark: SparkSession, training: DataFrame, registry_dir: str,
                        name: str = "eta-predictor", params: dict | None = None,
                        margin: float = 0.01) -> DataFrame:
    """Fit a challenger, score it and the current champion on the SAME held-out
    trips in one pass, and promote the challenger when it wins by ``margin``.

    ``params`` overrides ``CHALLENGER_PARAMS``.  Returns the gate row (n_holdout,
    champion_mae, challenger_mae, promote).
    """
    from waymark.config import Settings
    from waymark.operators.eta import promotion_gate
    train, test = split(training)
    challenger = fit(train, dict(CHALLENGER_PARAMS, **(params or {})))
    champion = resolve_alias(spark, registry_dir, name)
    scored = both_predictions(champion, challenger, test)
    gate = promotion_gate(scored, "champion" if champion is not None else None, "challenger",
                          settings=Settings(champion_margin=margin)).cache()
    row = gate.first()
    version = register(spark, registry_dir, challenger, name, row.challenger_mae)
    if row.promote:
        set_alias(spark, registry_dir, name, "production", version)
    return gate.withColumn("challenger_version", F.lit(version).cast("bigint"))
