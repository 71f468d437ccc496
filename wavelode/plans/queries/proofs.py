"""Fits whose result follows from the table, and models that were saved and loaded."""

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from wavelode.operators import models, runs
from wavelode.plans.queries.modelling import _LINE_KEY, _LINEAR, _SCORED, _linear, _scored, _scorer
from wavelode.plans.queries.registry import load, query
from wavelode.plans.training import save_training, train_models
from wavelode.session import work_dir

# A label that three flags fix and that quantity has no part in. The first tree takes the
# flags by their weight and its leaves hold one value each, so boosting has nothing left.
_FLAGS = {
    "first": "CAST(l_orderkey % 2 AS DOUBLE)", "second": "CAST(l_partkey % 2 AS DOUBLE)",
    "third": "CAST(l_linenumber % 2 AS DOUBLE)",
}
_LABEL = "20 * first + 9 * second + 4 * third + 1"
_TREES = ["Decision_Tree_Regressor", "GBT_Regressor"]
_ROUNDS = 5


def _flag_lines(spark, folder):
    lines = load(spark, folder, "lineitem").select(
        "l_quantity", *[F.expr(e).alias(c) for c, e in _FLAGS.items()])
    return lines.withColumn("y", F.expr(_LABEL).cast("double"))


_FLAG_SQL = f"""flags AS (SELECT l_quantity, {', '.join(f'{e} AS {c}' for c, e in _FLAGS.items())}
  FROM lineitem),
p AS (SELECT *, ({_LABEL})::DOUBLE AS y FROM flags)"""


def _tree_training(spark, folder):
    lines = _flag_lines(spark, folder)
    every = models.regressors("y", rounds=_ROUNDS)
    return train_models(
        lines, lines, "y", [*_FLAGS, "l_quantity"], nominal=None,
        estimators={name: every[name] for name in _TREES})


@query(
    "exact_trees",
    f"""WITH {_FLAG_SQL}
    SELECT unnest({_TREES}) AS model, * FROM (
      SELECT first, second, third, count(*) AS n, round(avg(y), 6) AS low,
        round(avg(y), 6) AS high FROM p GROUP BY ALL)""",
)
def exact_trees(spark, folder):
    """A tree and a boosted one give each group of flags the mean of its label."""
    scored = _tree_training(spark, folder).predictions
    parts = []
    for name in _TREES:
        column = models.prediction_column(name)
        parts.append(scored.groupBy(*_FLAGS).agg(
            F.count("*").alias("n"), F.round(F.min(column), 6).alias("low"),
            F.round(F.max(column), 6).alias("high")).withColumn("model", F.lit(name)))
    return parts[0].unionByName(parts[1])


@query(
    "exact_forest",
    """SELECT l_linestatus, count(*) AS n, round(avg(l_extendedprice), 4) AS low,
      round(avg(l_extendedprice), 4) AS high FROM lineitem GROUP BY 1""",
)
def exact_forest(spark, folder):
    """Every tree of a forest, whatever lines it drew, finds a label that is the same for
    all lines of a status: the mean price of the status."""
    lines = load(spark, folder, "lineitem").select(
        "l_linestatus", "l_extendedprice",
        F.when(F.col("l_linestatus") == "O", 1.0).otherwise(0.0).alias("is_open"))
    means = lines.groupBy("l_linestatus").agg(F.avg("l_extendedprice").alias("y"))
    lines = lines.join(F.broadcast(means), "l_linestatus")  # as many rows as statuses
    name = "Random_Forest_Regressor"
    trained = train_models(
        lines, lines, "y", ["is_open"], nominal=None,
        estimators={name: models.regressors("y", trees=20)[name]})
    column = models.prediction_column(name)
    return trained.predictions.groupBy("l_linestatus").agg(
        F.count("*").alias("n"), F.round(F.min(column), 4).alias("low"),
        F.round(F.max(column), 4).alias("high"))


# A split weighs what it takes off the variance of the label: the first flag what it
# explains of all, the second what it explains within the first, the third the rest.
@query(
    "exact_importances",
    f"""WITH {_FLAG_SQL},
    whole AS (SELECT var_pop(y) AS v, count(*) AS n FROM p),
    one AS (SELECT sum(v * k) AS s FROM (
      SELECT var_pop(y) AS v, count(*) AS k FROM p GROUP BY first)),
    two AS (SELECT sum(v * k) AS s FROM (
      SELECT var_pop(y) AS v, count(*) AS k FROM p GROUP BY first, second)),
    shares AS (
      SELECT unnest(['first', 'second', 'third', 'l_quantity']) AS feature,
        unnest([1 - one.s / (v * n), (one.s - two.s) / (v * n), two.s / (v * n), 0]) AS share
      FROM whole, one, two)
    SELECT unnest({_TREES}) AS model, feature, 'tree_feature_importance' AS method,
      round(share, 6) AS importance FROM shares""",
)
def exact_importances(spark, folder):
    trained = _tree_training(spark, folder)
    parts = [
        trained.importances(spark, name).select(
            F.lit(name).alias("model"), "feature", "method",
            F.round("importance", 6).alias("importance"))
        for name in _TREES
    ]
    return parts[0].unionByName(parts[1])


@query(
    "top_importances",
    f"""WITH {_FLAG_SQL}, shares AS (
      SELECT 'first' AS feature, var_pop(20 * first) AS v FROM p
      UNION ALL SELECT 'second', var_pop(9 * second) FROM p
      UNION ALL SELECT 'third', var_pop(4 * third) FROM p)
    SELECT unnest({_TREES}) AS model, * FROM (
      SELECT feature, (row_number() OVER (ORDER BY v DESC))::INT AS place FROM shares)""",
)
def top_importances(spark, folder):
    """The three features that matter, in their order."""
    trained = _tree_training(spark, folder)
    parts = []
    for name in _TREES:
        top = trained.importances(spark, name, 3).collect()  # three rows, in their order
        parts += [(name, r["feature"], place) for place, r in enumerate(top, 1)]
    return spark.createDataFrame(parts, "model STRING, feature STRING, place INT")


@query("score_saved_model", _SCORED)
def score_saved_model(spark, folder):
    """Preparation and model, saved and loaded, score as they did."""
    path = work_dir(spark, "scorer")
    _scorer(spark, folder).write().overwrite().save(path)
    return _scored(PipelineModel.load(path), load(spark, folder, "lineitem").select(
        *_LINE_KEY, "l_quantity", "l_extendedprice"))


@query(
    "saved_runs",
    """WITH t AS (SELECT l_quantity AS q, l_extendedprice AS p,
      CAST('0x' || substr(md5('42:' || CAST(l_orderkey AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 80
        AS in_train FROM lineitem),
    s AS (SELECT regr_slope(q, p) / (1 + 0.1::DOUBLE / stddev_pop(q)) AS slope, avg(q) AS y,
      avg(p) AS x FROM t WHERE in_train)
    SELECT unnest(['Linear_Regression', 'Generalized_Linear_Regression']) AS run_name,
      unnest(['LinearRegressionModel', 'GeneralizedLinearRegressionModel']) AS model_class, *
    FROM (SELECT 'pyspark.ml.regression' AS model_module,
        (count(*) FILTER (in_train))::VARCHAR AS train_size,
        (count(*) FILTER (NOT in_train))::VARCHAR AS test_size, true AS same_model,
        count(*) AS scored, round(avg(y + slope * (p - x)), 6) AS mean_prediction
      FROM t, s)""",
)
def saved_runs(spark, folder):
    """What a run's record says of its model, and what the model that it names predicts."""
    path = work_dir(spark, "training")
    save_training(
        spark, _linear(spark, folder), path, "lines", keys=["l_orderkey"], label="l_quantity")
    logged = runs.read_runs(spark, f"{path}/runs")
    lines = load(spark, folder, "lineitem").select("l_extendedprice")
    parts = []
    for name in _LINEAR:
        record = {(r["kind"], r["key"]): r["value"] for r in logged.where(
            F.col("run_name") == name).collect()}  # one row for each thing a run logs
        model = PipelineModel.load(record["artifact", "model"])
        same = model.stages[-1].uid == record["model", "uid"]
        parts.append(models.score(model, lines).agg(
            F.count("*").alias("scored"), F.round(F.avg("prediction"), 6).alias("mean_prediction"),
        ).select(
            F.lit(name).alias("run_name"),
            F.lit(record["model", "model_class"]).alias("model_class"),
            F.lit(record["model", "model_module"]).alias("model_module"),
            F.lit(record["param", "train_size"]).alias("train_size"),
            F.lit(record["param", "test_size"]).alias("test_size"),
            F.lit(same).alias("same_model"), "scored", "mean_prediction"))
    return parts[0].unionByName(parts[1])
