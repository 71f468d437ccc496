"""Features, splits, model fits, evaluation and run logs."""

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from wavelode.operators import features as feat
from wavelode.operators import models, runs
from wavelode.operators.distribution import histogram
from wavelode.operators.evaluation import (
    actual_vs_predicted, regression_metrics, residual_stats, residuals,
)
from wavelode.plans.queries.registry import file_or_folder, load, query
from wavelode.plans.queries.profiles import histogram_sql
from wavelode.plans.queries.testbed import FEATURES_CTE, line_silver, stored
from wavelode.plans.training import (
    TOP_FEATURES, save_training, split_tracks, train_models, training_runs,
)
from wavelode.schemas import DERIVED_FEATURES, FEATURE_COLUMNS, LABEL
from wavelode.session import work_dir
from wavelode.sources.files import table, table_stream
from wavelode.streaming.sinks import append_stream, run_stream


def _silver(spark, folder):
    """The Silver columns that features come from, as a table."""
    columns = [
        "track_id", "event_time", "artists", "track_name", "track_genre", LABEL,
        *[c for c in FEATURE_COLUMNS if c not in DERIVED_FEATURES],
    ]
    return stored(line_silver(spark, folder).select(*columns), "silver")


@query(
    "text_features",
    f"""WITH {FEATURES_CTE} SELECT track_id, event_time, artist_count,
      CAST(is_feat AS INT) AS is_feat FROM features""",
)
def text_features(spark, folder):
    return line_silver(spark, folder).select(
        "track_id", "event_time",
        feat.artist_count().alias("artist_count"), feat.is_featured().alias("is_feat"),
    )


@query(
    "product_features",
    f"""WITH {FEATURES_CTE} SELECT track_id, event_time,
      CAST(is_short_track AS INT) AS is_short_track,
      round(energy_dance_interaction, 6) AS energy_dance_interaction,
      round(mood_index, 6) AS mood_index FROM features""",
)
def product_features(spark, folder):
    rows = feat.track_features(line_silver(spark, folder))
    return rows.select(
        "track_id", "event_time", "is_short_track",
        F.round("energy_dance_interaction", 6).alias("energy_dance_interaction"),
        F.round("mood_index", 6).alias("mood_index"),
    )


@query(
    "label_index",
    """WITH c AS (SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand)
    SELECT p_partkey, CAST(i AS DOUBLE) AS p_brand_index FROM part JOIN (
      SELECT p_brand, row_number() OVER (ORDER BY n DESC, p_brand) - 1 AS i FROM c) USING (p_brand)
    """,
)
def label_index(spark, folder):
    parts = load(spark, folder, "part")
    indexed = feat.fit_label_index(parts, "p_brand").transform(parts)
    return indexed.select("p_partkey", "p_brand_index")


@query(
    "feature_table",
    f"WITH {FEATURES_CTE} SELECT track_id, popularity, " + ", ".join(
        f"round(CAST({c} AS DOUBLE), 6) AS {c}" for c in FEATURE_COLUMNS
    ) + " FROM features",
)
def feature_vectors(spark, folder):
    table = feat.feature_table(_silver(spark, folder))
    names = feat.feature_names(table)
    slots = table.select("track_id", "popularity", vector_to_array("features").alias("v"))
    return slots.select(
        "track_id", "popularity",
        *[F.round(F.col("v")[i], 6).alias(name) for i, name in enumerate(names)],
    )


@query(
    "hash_split_counts",
    """SELECT CASE WHEN CAST('0x' || substr(md5('42:' || CAST(user_id AS VARCHAR)), 1, 8) AS BIGINT)
        % 100 < 80 THEN 'train' ELSE 'test' END AS side,
      count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY 1""",
)
def hash_split_counts(spark, folder):
    events = load(spark, folder, "events").select("user_id")
    side = F.when(models.in_train("user_id", method="md5"), "train").otherwise("test")
    return events.withColumn("side", side).groupBy("side").agg(
        F.count("*").alias("n"), F.count_distinct("user_id").alias("users")
    )


def _priced(spark, folder):
    """Price predicted by a straight line over quantity."""
    return load(spark, folder, "lineitem").select(
        "l_extendedprice", (F.col("l_quantity") * 1500.0 + 1000.0).alias("prediction")
    )


_PRICED_SQL = """
p AS (SELECT l_extendedprice AS y, l_quantity * 1500.0::DOUBLE + 1000.0::DOUBLE AS f
  FROM lineitem),
e AS (SELECT y, f, y - f AS r FROM p)
"""


@query(
    "regression_metrics",
    f"""WITH {_PRICED_SQL} SELECT 'line' AS model, count(*) AS rows,
      round(sqrt(avg(r * r)), 4) AS rmse, round(avg(abs(r)), 4) AS mae,
      round(1 - sum(r * r) / (var_pop(y) * count(*)), 6) AS r2,
      round(avg(abs(r)), 4) AS residual_abs_mean FROM e""",
)
def line_metrics(spark, folder):
    metrics = regression_metrics(
        _priced(spark, folder), {"line": "prediction"}, "l_extendedprice"
    )
    return metrics.select(
        "model", "rows", F.round("rmse", 4).alias("rmse"), F.round("mae", 4).alias("mae"),
        F.round("r2", 6).alias("r2"),
        F.round("residual_abs_mean", 4).alias("residual_abs_mean"),
    )


@query(
    "residual_stats",
    f"""WITH {_PRICED_SQL} SELECT round(avg(r), 4) AS residual_mean,
      round(stddev_samp(r), 4) AS residual_std, round(avg(abs(r)), 4) AS residual_abs_mean
    FROM e""",
)
def line_residual_stats(spark, folder):
    stats = residual_stats(_priced(spark, folder), "l_extendedprice")
    return stats.select(*[F.round(c, 4).alias(c) for c in stats.columns])


@query(
    "residual_histogram",
    f"WITH {_PRICED_SQL} " + histogram_sql("r", 40, "e", "residual"),
)
def residual_histogram(spark, folder):
    rows = residuals(_priced(spark, folder), "l_extendedprice")
    return histogram(rows, "residual", 40).withColumns(
        {c: F.round(c, 6) for c in ("lo", "hi")}
    )


def _price_points(spark, folder):
    lines = load(spark, folder, "lineitem").select("l_quantity", "l_extendedprice")
    return VectorAssembler(inputCols=["l_extendedprice"], outputCol="features").transform(lines)


def _fitted_line(spark, folder, name):
    """Slope and intercept of one linear model with its usual settings."""
    estimator = models.regressors("l_quantity")[name]
    model = models.fit_all(_price_points(spark, folder), {name: estimator})[name]
    return spark.createDataFrame(
        [(round(float(model.coefficients[0]) * 1e6, 4), round(float(model.intercept), 4))],
        "slope_millionths DOUBLE, intercept DOUBLE",
    )


# With one standardised feature, a penalty p divides the plain slope by
# 1 + p / deviation of the label; the line still passes through the means.
_RIDGE = """
WITH s AS (SELECT regr_slope(l_quantity, l_extendedprice)
    / (1 + 0.1::DOUBLE / stddev_pop(l_quantity)) AS slope,
  avg(l_quantity) AS y, avg(l_extendedprice) AS x FROM lineitem)
SELECT round(slope * 1e6::DOUBLE, 4) AS slope_millionths, round(y - slope * x, 4) AS intercept
FROM s
"""


@query("linreg_fit", _RIDGE)
def linreg_fit(spark, folder):
    return _fitted_line(spark, folder, "Linear_Regression")


@query("glr_fit", _RIDGE)
def glr_fit(spark, folder):
    return _fitted_line(spark, folder, "Generalized_Linear_Regression")


_LINEAR = ["Linear_Regression", "Generalized_Linear_Regression"]
_LINEAR_SQL = """
WITH t AS (SELECT l_quantity AS q, l_extendedprice AS p,
    CAST('0x' || substr(md5('42:' || CAST(l_orderkey AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 80
      AS in_train FROM lineitem),
s AS (SELECT regr_slope(q, p) / (1 + 0.1::DOUBLE / stddev_pop(q)) AS slope,
    avg(q) AS y, avg(p) AS x FROM t WHERE in_train),
e AS (SELECT q, q - (y + slope * (p - x)) AS r FROM t, s WHERE NOT in_train)
SELECT unnest(['Linear_Regression', 'Generalized_Linear_Regression']) AS "Model",
  round(sqrt(avg(r * r)), 4) AS rmse, round(avg(abs(r)), 4) AS mae,
  round(1 - sum(r * r) / (var_pop(q) * count(*)), 4) AS r2,
  round(avg(abs(r)), 4) AS residual_abs_mean
FROM e
"""


def _linear(spark, folder):
    """Split, fit and score, with models that have a closed form."""
    lines = load(spark, folder, "lineitem").select(
        "l_orderkey", "l_quantity", "l_extendedprice"
    )
    train, test = models.hash_split(lines, "l_orderkey", method="md5")
    every = models.regressors("l_quantity")
    return train_models(
        train, test, "l_quantity", ["l_extendedprice"], nominal=None,
        estimators={name: every[name] for name in _LINEAR},
    )


@query("linear_comparison", _LINEAR_SQL)
def linear_comparison(spark, folder):
    return _linear(spark, folder).comparison()


@query(
    "summary_run",
    f"""SELECT 'Model_Comparison_Summary' AS run_name, "Model" || '_' || measure AS key, value
    FROM (UNPIVOT (SELECT "Model", rmse, mae, r2 FROM ({_LINEAR_SQL}))
      ON rmse, mae, r2 INTO NAME measure VALUE value)""",
)
def summary_run(spark, folder):
    logged, _ = training_runs(spark, _linear(spark, folder), "lines", label="l_quantity")
    return logged[-1].filter("kind = 'metric'").select(
        "run_name", "key", F.round(F.col("value").cast("double"), 4).alias("value")
    )


def _flag_points(spark, folder):
    lines = load(spark, folder, "lineitem").select(
        F.when(F.col("l_linestatus") == "O", 1.0).otherwise(0.0).alias("is_open"),
        "l_extendedprice",
    )
    return VectorAssembler(inputCols=["is_open"], outputCol="features").transform(lines)


_FLAG_MEANS = """
SELECT is_open, count(*) AS n, round(any_value(m), 4) AS prediction FROM (
  SELECT CASE l_linestatus WHEN 'O' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_open,
    avg(l_extendedprice) OVER (PARTITION BY l_linestatus = 'O') AS m FROM lineitem)
GROUP BY is_open
"""


def _flag_predictions(spark, folder, estimator):
    points = _flag_points(spark, folder)
    model = models.fit_all(points, {"m": estimator})["m"]
    return models.score(model, points).groupBy("is_open").agg(
        F.count("*").alias("n"), F.round(F.max("prediction"), 4).alias("prediction")
    )


# On one 0/1 feature a regression tree is the group mean.
@query("tree_fit", _FLAG_MEANS)
def tree_fit(spark, folder):
    return _flag_predictions(
        spark, folder, models.regressors("l_extendedprice")["Decision_Tree_Regressor"])


# A label that follows from the features, by products that one tree cannot follow, so
# that a fit must do better than the mean and boosting has work in every round.
_SIGNAL = (
    "20 + 30 * energy * danceability + 15 * explicit_int + 10 * valence * valence + tempo / 10"
)
_SIGNAL_SPLIT = f"""{FEATURES_CTE},
sides AS (SELECT track_id, event_time,
    CAST('0x' || substr(md5('42:' || track_id), 1, 8) AS BIGINT) % 100 < 80 AS in_train
  FROM features),
sizes AS (SELECT count(*) FILTER (in_train) AS train_rows,
    count(*) FILTER (NOT in_train) AS test_rows FROM sides)"""

_TRAININGS = {}


def _training(spark, folder):
    """All five models at their full settings over all tracks; one training serves every
    query of a session that reads it."""
    key = spark.sparkContext.applicationId, folder
    for old in [k for k in _TRAININGS if k[0] != key[0]]:  # of a session that has ended
        del _TRAININGS[old]
    if key not in _TRAININGS:
        silver = _silver(spark, folder).withColumn(
            "signal", F.expr(_SIGNAL).cast("double"))
        train, test = split_tracks(silver, method="md5")
        _TRAININGS[key] = train_models(train, test, "signal")
    return _TRAININGS[key]


def _fit_facts(spark, folder, name):
    """Facts about a fit that hold for whatever trees were found."""
    trained = _training(spark, folder)
    model = trained.fitted[name]
    scores = trained.metrics.filter(F.col("model") == name)
    spread = trained.predictions.agg(F.stddev_pop("signal")).first()[0]
    return scores.select(
        "model", F.col("rows").alias("test_rows"),
        F.lit(model.getNumTrees).cast("int").alias("trees"),
        F.lit(round(float(sum(model.featureImportances.toArray())), 6)).alias("importance_sum"),
        (F.col("rmse") < spread).alias("beats_mean"),
    )


def _fit_sql(name):
    return f"""WITH {_SIGNAL_SPLIT} SELECT '{name}' AS model, test_rows, 100 AS trees,
      1.0::DOUBLE AS importance_sum, true AS beats_mean FROM sizes"""


@query("forest_fit", _fit_sql("Random_Forest_Regressor"))
def forest_fit(spark, folder):
    return _fit_facts(spark, folder, "Random_Forest_Regressor")


@query("gbt_fit", f"SELECT *, 100 AS losses, 0 AS loss_rises FROM ({_fit_sql('GBT_Regressor')})")
def gbt_fit(spark, folder):
    trained = _training(spark, folder)
    seen = trained.preparation.transform(trained.train)
    losses = trained.fitted["GBT_Regressor"].evaluateEachIteration(seen, "squared")
    # Rounding of bins and means is left aside: a millionth of the first loss.
    rises = sum(b > a + 1e-6 * losses[0] for a, b in zip(losses, losses[1:]))
    return _fit_facts(spark, folder, "GBT_Regressor").withColumns(
        {"losses": F.lit(len(losses)), "loss_rises": F.lit(rises)})


@query(
    "importances",
    f"""WITH {_SIGNAL_SPLIT} SELECT CAST(i AS INT) AS place, true AS falls, true AS named
    FROM range(1, {TOP_FEATURES + 1}) t(i)""",
)
def best_importances(spark, folder):
    """The largest weights of the best model, in falling order, by feature name."""
    trained = _training(spark, folder)
    top = trained.importances(spark, trained.best(), TOP_FEATURES)
    by_weight = Window.orderBy(F.desc("importance"), "feature")
    return top.select(
        F.row_number().over(by_weight).alias("place"),
        (F.coalesce(F.lag("importance").over(by_weight), F.col("importance"))
         >= F.col("importance")).alias("falls"),
        F.col("feature").isin(FEATURE_COLUMNS).alias("named"),
    )


# With standardised features, a ridge solves (R + k) b = r, with the correlations R
# between the features and r with the label, and k = penalty / deviation of the label.
@query("coefficient_sizes", """
WITH s AS (SELECT corr(l_extendedprice, l_discount) AS c,
    corr(l_extendedprice, l_quantity) AS p, corr(l_discount, l_quantity) AS d,
    stddev_pop(l_quantity) AS y, stddev_pop(l_extendedprice) AS sp, stddev_pop(l_discount) AS sd,
    1 + 0.1::DOUBLE / stddev_pop(l_quantity) AS k FROM lineitem)
SELECT 'l_extendedprice' AS feature, 'abs_coefficients' AS method,
  round(abs((k * p - c * d) / (k * k - c * c) * y / sp) * 1e6::DOUBLE, 2) AS millionths FROM s
UNION ALL SELECT 'l_discount', 'abs_coefficients',
  round(abs((k * d - c * p) / (k * k - c * c) * y / sd) * 1e6::DOUBLE, 2) FROM s
""")
def coefficient_sizes(spark, folder):
    lines = load(spark, folder, "lineitem")
    name = "Linear_Regression"
    trained = train_models(
        lines, lines, "l_quantity", ["l_extendedprice", "l_discount"], nominal=None,
        estimators={name: models.regressors("l_quantity")[name]},
    )
    return trained.importances(spark, name).select(
        "feature", "method", F.round(F.col("importance") * 1e6, 2).alias("millionths"))


_SCORED = """
WITH s AS (SELECT regr_slope(l_quantity, l_extendedprice)
    / (1 + 0.1::DOUBLE / stddev_pop(l_quantity)) AS slope,
  avg(l_quantity) AS y, avg(l_extendedprice) AS x FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity,
  round(y + slope * (l_extendedprice - x), 4) AS prediction FROM lineitem, s
"""
_LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey"]


def _scorer(spark, folder):
    """Preparation and a linear model as one fitted pipeline."""
    lines = load(spark, folder, "lineitem")
    name = "Linear_Regression"
    trained = train_models(
        lines, lines, "l_quantity", ["l_extendedprice"], nominal=None,
        estimators={name: models.regressors("l_quantity")[name]},
    )
    return trained.scorer(name)


def _scored(scorer, lines):
    return models.score(scorer, lines).select(
        *_LINE_KEY, "l_quantity", F.round("prediction", 4).alias("prediction")
    )


@query("score_batch", _SCORED)
def score_batch(spark, folder):
    return _scored(_scorer(spark, folder), load(spark, folder, "lineitem"))


@query("score_stream", _SCORED)
def score_stream(spark, folder):
    schema = load(spark, folder, "lineitem").schema
    stream = table_stream(spark, file_or_folder(folder, "lineitem"), schema)
    target = work_dir(spark, "scored")
    run_stream(append_stream(
        _scored(_scorer(spark, folder), stream), target, f"{target}-checkpoint",
        "available_now",
    ))
    return table(spark, target)


@query(
    "score_sample",
    f"""SELECT * FROM ({_SCORED}) ORDER BY CAST('0x' || substr(md5('42:' || CAST(l_orderkey AS VARCHAR)
      || ':' || CAST(l_linenumber AS VARCHAR) || ':' || CAST(l_partkey AS VARCHAR)), 1, 8) AS BIGINT),
      l_orderkey, l_linenumber, l_partkey LIMIT 5000""",
)
def score_sample(spark, folder):
    scored = _scored(_scorer(spark, folder), load(spark, folder, "lineitem"))
    return actual_vs_predicted(scored, _LINE_KEY, label="l_quantity", method="md5")


_NAMES = [
    "Linear_Regression", "Decision_Tree_Regressor", "Random_Forest_Regressor",
    "GBT_Regressor", "Generalized_Linear_Regression",
]


@query(
    "model_comparison",
    f"""WITH {_SIGNAL_SPLIT} SELECT unnest({_NAMES}) AS "Model", test_rows, true AS in_order,
      true AS best_is_first FROM sizes""",
)
def model_comparison(spark, folder):
    trained = _training(spark, folder)
    rows = trained.metrics.select(F.col("model").alias("Model"), F.col("rows").alias("test_rows"))
    order = Window.orderBy("place")
    ranked = trained.comparison().coalesce(1).withColumn("place", F.monotonically_increasing_id())
    ranked = ranked.select(
        "Model",
        (F.coalesce(F.lag("rmse").over(order), F.col("rmse")) <= F.col("rmse")).alias("in_order"),
        (F.first("Model").over(order) == trained.best()).alias("best_is_first"),
    )
    return ranked.join(rows, "Model")


# Settings that a run must log, by model, as JSON text.
_SETTINGS = {
    "Linear_Regression": {"maxIter": "100", "regParam": "0.1", "elasticNetParam": "0.0"},
    "Decision_Tree_Regressor": {"maxDepth": "8", "minInstancesPerNode": "10"},
    "Random_Forest_Regressor": {"numTrees": "100", "maxDepth": "8", "seed": "42"},
    "GBT_Regressor": {"maxIter": "100", "maxDepth": "6", "stepSize": "0.1", "seed": "42"},
    "Generalized_Linear_Regression": {
        "family": '"gaussian"', "link": '"identity"', "maxIter": "100", "regParam": "0.1"},
}
_MEASURES = ["rmse", "mae", "r2", "residual_mean", "residual_std", "residual_abs_mean"]


def _runs_sql():
    """Rows (run_name, kind, key, value); values that depend on the fit are left out."""
    rows, sizes = [], []
    for name in _NAMES:
        linear = name in models.LINEAR_MODELS
        method = models.COEFFICIENT_METHOD if linear else models.SPLIT_METHOD
        kept = {**_SETTINGS[name], "target": "signal", "feature_importance_method": method,
                "model": {"Linear_Regression": "LinearRegression",
                          "Generalized_Linear_Regression": "GeneralizedLinearRegression",
                          }.get(name, name.replace("_", ""))}
        rows += [(name, "param", key, f"'{value}'") for key, value in kept.items()]
        rows += [(name, "metric", key, "NULL") for key in _MEASURES]
        rows += [(name, "model", key, "NULL") for key in ("model_class", "model_module", "uid")]
        rows += [(name, "artifact", key, "NULL") for key in ("model", "feature_importance")]
        sizes += [(name, "param", f"{side}_size", f"CAST({side}_rows AS VARCHAR)")
                  for side in ("train", "test")]
    summary = "Model_Comparison_Summary"
    rows += [(summary, "param", "target", "'signal'"), (summary, "param", "best_model", "NULL")]
    rows += [(summary, "metric", f"{n}_{m}", "NULL") for n in _NAMES for m in _MEASURES[:3]]
    rows += [(summary, "artifact", key, "NULL") for key in (
        "regression_results", "predictions", "residual_histograms", "prediction_sample")]
    parts = [f"SELECT '{r}' AS run_name, '{k}' AS kind, '{key}' AS key, {v} AS value FROM sizes"
             for r, k, key, v in rows + sizes]
    return f"WITH {_SIGNAL_SPLIT} " + " UNION ALL ".join(parts)


@query("runs_log", _runs_sql())
def runs_log(spark, folder):
    path = work_dir(spark, "training")
    save_training(
        spark, _training(spark, folder), path, "tracks", f"{folder}/lineitem.parquet",
        keys=["track_id", "event_time"], label="signal",
    )
    logged = runs.read_runs(spark, f"{path}/runs")
    wanted = {key for kept in _SETTINGS.values() for key in kept} | {
        "target", "feature_importance_method", "model", "train_size", "test_size"}
    settings = (F.col("kind") == "param") & F.col("key").isin(*wanted)
    # A setting of another model that also has it is not looked at.
    own = F.lit(False)
    for name, kept in _SETTINGS.items():
        others = wanted - set(kept) - {"target", "feature_importance_method", "model",
                                       "train_size", "test_size"}
        own = own | ((F.col("run_name") == name) & F.col("key").isin(*others))
    best = (F.col("kind") == "param") & (F.col("key") == "best_model")
    return logged.filter((settings & ~own) | (F.col("kind") != "param") | best).select(
        "run_name", "kind", "key", F.when(settings, F.col("value")).alias("value"))
