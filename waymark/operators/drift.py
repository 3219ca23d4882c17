"""Input drift: population stability index (PSI) between a reference sample
(the training set) and live scoring traffic.

Per feature: 10 bins from the reference deciles (outer edges -inf / +inf,
linear interpolation like numpy), left-closed bins so duplicate cuts leave
empty bins, shares floored at 1e-4 without renormalising, and
PSI = sum((live - ref) * ln(live / ref)).  NULL / NaN values are dropped on
both sides before counting.

Scale notes: features are stacked into (feature, value) rows so one
aggregation serves all features.  The reference is read once, into a written table of
value counts (``reference_counts``) that serves both the cut points and the bins.  Cut points
are exact (numpy's linear interpolation) by range partitions of that table
(``waymark.operators.quantiles``), so no task holds a feature's values, rounded or not.
``exact=False`` switches to ``percentile_approx``.  The only other join is against the
cut table, one row per feature.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.config import DEFAULT, Settings
from waymark.operators.quantiles import exact_quantiles
from waymark.session import scratch_path

FEATURES = ("dist_remaining_km", "speed_kmh")


#: Names of the samples that one tagged stream of traffic may hold.
TRAFFIC = ("live", "shifted")


def stacked(df: DataFrame, features=FEATURES, keep: str | None = None) -> DataFrame:
    """(feature, value) rows for the features present, NULL / NaN dropped, next to
    the column ``keep``."""
    present = [f for f in features if f in df.columns]
    pairs = ", ".join(f"'{f}', CAST({f} AS DOUBLE)" for f in present)
    s = df.selectExpr(*([keep] if keep else []), f"stack({len(present)}, {pairs}) AS (feature, value)")
    return s.where(F.col("value").isNotNull() & ~F.isnan("value"))


def recent(live: DataFrame, since=None, last_n: int | None = None,
           ts_col: str = "ts") -> DataFrame:
    """Restrict the live traffic to what was scored since ``since`` and/or to
    the latest ``last_n`` predictions (a top-k by time), so that old traffic
    does not dilute a recent shift.  Predictions of one batch share their time;
    a hash of the whole row, then the row itself, decides among them."""
    if since is not None:
        live = live.where(F.col(ts_col) >= F.lit(since).cast("timestamp"))
    if last_n is not None:
        live = live.orderBy(F.col(ts_col).desc(), F.xxhash64(*live.columns), *live.columns).limit(last_n)
    return live


def value_counts(df: DataFrame, features=FEATURES) -> DataFrame:
    """feature, value, n: one aggregate that serves both the cut points and the bins."""
    return stacked(df, features).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))


def reference_counts(reference: DataFrame, features=FEATURES) -> DataFrame:
    """``value_counts`` as a written table, for ``cut_points`` and ``histograms``."""
    spark = reference.sparkSession
    path = scratch_path(spark, "reference-counts")
    counts = value_counts(reference, features)
    counts.write.parquet(path)
    return spark.read.schema(counts.schema).parquet(path)


def cut_points(reference: DataFrame, features=FEATURES, settings: Settings = DEFAULT,
               exact: bool = True, counts: DataFrame | None = None) -> DataFrame:
    """feature -> cuts array<double> of bins+1 edges; the outer edges are +-inf.
    ``counts``: the reference's ``reference_counts``, where they are there already."""
    bins = settings.psi_bins
    probs = [i / bins for i in range(bins + 1)]
    inner = F.slice(F.col("_q"), 2, bins - 1)
    if exact:
        q = exact_quantiles(counts if counts is not None else value_counts(reference, features), probs) \
            .withColumnRenamed("q", "_q")
    else:
        q = stacked(reference, features).groupBy("feature").agg(F.percentile_approx("value", probs, 1_000_000).alias("_q"))
    return (q.select("feature", F.concat(F.array(F.lit(float("-inf"))), inner,
                                              F.array(F.lit(float("inf")))).alias("cuts")))


def histograms(reference: DataFrame, lives: dict[str, DataFrame] | DataFrame, features=FEATURES,
               settings: Settings = DEFAULT, cuts: DataFrame | None = None,
               counts: DataFrame | None = None) -> DataFrame:
    """traffic, feature, bin, ref_count, live_count, ref_share, live_share.

    ``lives``: samples by name, or one DataFrame whose ``traffic`` column names the
    sample ("live" or "shifted"), read in one scan.  The reference's value counts
    and the live values are stacked into one (source, feature, value, n) stream, binned
    against the broadcast cut table and counted in ONE aggregation (one shuffle of at
    most sources x features x bins partial rows per task).
    """
    bins, floor = settings.psi_bins, settings.psi_floor
    ref = counts if counts is not None else value_counts(reference, features)
    cuts = cuts if cuts is not None else cut_points(reference, features, settings, counts=ref)
    if isinstance(lives, dict):
        tagged = [live.select(F.lit(name).alias("traffic"), *[f for f in features if f in live.columns])
                  for name, live in lives.items()]
        names = {name: live.columns for name, live in lives.items()}
    else:
        tagged, names = [lives], {name: lives.columns for name in TRAFFIC}
    allv = ref.withColumn("src", F.lit("__ref__"))
    for t in tagged:
        allv = allv.unionByName(stacked(t, [f for f in features if f in t.columns], keep="traffic")
                                .select("feature", "value", F.lit(1).cast("bigint").alias("n"), F.col("traffic").alias("src")))
    j = allv.join(F.broadcast(cuts), "feature")          # one row per feature
    b = F.size(F.filter(F.slice(F.col("cuts"), 2, bins - 1), lambda c: c <= F.col("value")))
    binned = j.groupBy("feature", b.alias("bin")).pivot("src", ["__ref__", *names]).agg(F.sum("n"))
    known = [f for f in features if f in reference.columns]
    grid = reference.sparkSession.range(bins).select(
        F.explode(F.array(*[F.lit(f) for f in known])).alias("feature"), F.col("id").cast("int").alias("bin"))
    h = grid.join(binned, ["feature", "bin"], "left").fillna(0, ["__ref__", *names])
    from pyspark.sql import Window
    tot = Window.partitionBy("feature")

    def share(c: str) -> F.Column:
        """NULL on a side without rows."""
        return F.when(F.sum(f"`{c}`").over(tot) > 0, F.greatest(
            F.try_divide(F.col(f"`{c}`"), F.sum(f"`{c}`").over(tot)), F.lit(floor)))

    out = []
    for name, columns in names.items():
        present = [f for f in features if f in columns]
        out.append(h.where(F.col("feature").isin(present)).select(
            F.lit(name).alias("traffic"), "feature", "bin",
            F.col("__ref__").alias("ref_count"), F.col(f"`{name}`").alias("live_count"),
            share("__ref__").alias("ref_share"), share(name).alias("live_share")))
    res = out[0]
    for o in out[1:]:
        res = res.unionByName(o)
    return res


def histogram(reference: DataFrame, live: DataFrame, features=FEATURES,
              settings: Settings = DEFAULT, cuts: DataFrame | None = None, counts: DataFrame | None = None) -> DataFrame:
    """feature, bin, ref_count, live_count, ref_share, live_share (floored)."""
    return histograms(reference, {"live": live}, features, settings, cuts, counts).drop("traffic")


def psi(hist: DataFrame) -> DataFrame:
    """Per feature (and traffic, when present): sum of the PSI terms; NULL when the
    reference or the live side has no rows."""
    term = (F.col("live_share") - F.col("ref_share")) * F.log(F.col("live_share") / F.col("ref_share"))
    keys = [c for c in ("traffic", "feature") if c in hist.columns]
    return hist.groupBy(*keys).agg(F.sum(term).alias("psi"))


def classify(psi_col, settings: Settings = DEFAULT):
    return (F.when(psi_col.isNull(), F.lit("no live traffic"))
             .when(psi_col > F.lit(settings.psi_alert), F.lit("SIGNIFICANT DRIFT"))
             .when(psi_col > F.lit(settings.psi_warn), F.lit("moderate shift"))
             .otherwise(F.lit("stable")))


def report(psi_df: DataFrame, settings: Settings = DEFAULT, by=()) -> DataFrame:
    """Per feature status, and the verdict over all features of a group:
    retrain when any feature exceeds the alert level."""
    by = list(by)
    rows = psi_df.withColumn("status", classify(F.col("psi"), settings))
    verdict = rows.groupBy(*by).agg(
        F.max("psi").alias("max_psi"),
        F.coalesce(F.bool_or(F.col("psi") > F.lit(settings.psi_alert)), F.lit(False)).alias("alert"),
        F.count("psi").alias("features_checked"))
    return verdict.withColumn("recommendation", F.when(
        F.col("features_checked") == 0, F.lit("no live traffic to compare"))
        .when(
        F.col("alert"), F.lit("SIGNIFICANT DRIFT detected -> recommend retraining"))
        .otherwise(F.lit("inputs stable vs training distribution -> no retrain needed")))
