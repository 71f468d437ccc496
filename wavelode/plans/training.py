"""Train, score, compare and log the five regressors."""

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavelode.operators import models, runs
from wavelode.operators.distribution import histogram
from wavelode.operators.evaluation import compare_models, regression_metrics, residuals
from wavelode.operators.features import feature_names, fit_features, track_features
from wavelode.operators.sampling import sample_n
from wavelode.operators.sinks import overwrite, write_result_csv
from wavelode.schemas import FEATURE_COLUMNS, LABEL
from wavelode.sources.files import table

TOP_FEATURES = 15
# Names of the summary run, its figures and its tables.
SUMMARY_RUN = "Model_Comparison_Summary"
RESIDUALS, RESIDUAL_BINS = "residual_histograms", 40
SAMPLE, SAMPLE_ROWS = "prediction_sample", 5000


@dataclass
class Trained:
    preparation: PipelineModel
    fitted: dict
    estimators: dict
    names: list
    predictions: DataFrame
    metrics: DataFrame
    sizes: tuple
    train: DataFrame

    def comparison(self):
        return compare_models(self.metrics)

    def scorer(self, name):
        """Preparation and one model as a single fitted pipeline."""
        return PipelineModel([self.preparation, self.fitted[name]])

    def importances(self, spark, name, top=None):
        return models.importances(spark, name, self.fitted[name], self.names, top)

    def best(self):
        """Name of the model with the least rmse."""
        return self.comparison().first()["Model"]

    def residual_histogram(self, name, label=LABEL, bins=RESIDUAL_BINS):
        column = models.prediction_column(name)
        return histogram(residuals(self.predictions, label, column), "residual", bins)


def train_models(train, test, label=LABEL, columns=FEATURE_COLUMNS,
                 nominal="track_genre", estimators=None, **settings):
    """Fit on the training side only, score every model in one pass over the test.

    ``train`` and ``test`` hold the plain feature columns.
    """
    train = train.filter(F.col(label).isNotNull())
    test = test.filter(F.col(label).isNotNull())
    preparation = fit_features(train, nominal, columns)
    vectors = preparation.transform(train)
    if estimators is None:
        estimators = models.regressors(label, models.tree_bins(vectors), **settings)
    with models.kept(models.training_view(vectors, estimators)) as (held, train_size):
        fitted = models.fit_each(held, estimators)
    predictions = models.score_all(fitted, preparation.transform(test))
    metrics = regression_metrics(
        predictions, {n: models.prediction_column(n) for n in fitted}, label
    )
    # One row per model, so later uses do not score the test side again.
    scores = metrics.collect()
    return Trained(
        preparation, fitted, estimators, feature_names(vectors), predictions,
        train.sparkSession.createDataFrame(scores, metrics.schema),
        (train_size, scores[0]["rows"]),
        train,
    )


def split_tracks(silver, key="track_id", **options):
    """Silver with derived features, split by track."""
    return models.hash_split(track_features(silver), key, **options)


def training_runs(spark, trained, experiment, features_path="", label=LABEL, path=None):
    """Rows for one run per model and one summary run; the best model's name.

    ``path`` is where the training was saved, if it was.
    """
    scores = {row["model"]: row.asDict() for row in trained.metrics.collect()}
    best = trained.best()
    common = {"target": label, "features_path": features_path}
    logged = []
    for name, model in trained.fitted.items():
        estimator = trained.estimators[name]
        params = {
            "model": type(estimator).__name__,
            "train_size": trained.sizes[0],
            "test_size": trained.sizes[1],
            **common,
            "feature_importance_method": trained.importances(spark, name).first()["method"],
            **runs.settings(estimator),
        }
        metrics = {k: v for k, v in scores[name].items() if k not in ("model", "rows")}
        artifacts = path and {
            "model": f"{path}/models/{name}",
            "feature_importance": f"{path}/feature_importance_{name}",
        }
        logged.append(runs.run_rows(
            spark, experiment, name, params, metrics, runs.model_record(model), artifacts
        ))
    summary = {
        f"{name}_{measure}": row[measure]
        for name, row in scores.items() for measure in ("rmse", "mae", "r2")
    }
    artifacts = path and {
        name: f"{path}/{name}"
        for name in ("regression_results", "predictions", RESIDUALS, SAMPLE)
    }
    logged.append(runs.run_rows(
        spark, experiment, SUMMARY_RUN, {"best_model": best, **common}, summary,
        artifacts=artifacts,
    ))
    return logged, best


def save_predictions(spark, trained, path, keys, label=LABEL):
    """Write the scored test side once, and the residual and scatter data from it."""
    columns = {name: models.prediction_column(name) for name in trained.fitted}
    overwrite(
        trained.predictions.select(*keys, label, *columns.values()), f"{path}/predictions"
    )
    scored = table(spark, f"{path}/predictions")
    errors = scored.select(
        *[(F.col(label) - F.col(column)).alias(name) for name, column in columns.items()]
    )
    overwrite(
        histogram(errors, list(columns), RESIDUAL_BINS).withColumnRenamed("column", "model"),
        f"{path}/{RESIDUALS}",
    )
    overwrite(sample_n(scored, keys, SAMPLE_ROWS), f"{path}/{SAMPLE}")


def save_training(spark, trained, path, experiment, features_path="", keys=("track_id",),
                  label=LABEL):
    """Write runs, comparison, importances, predictions and fitted pipelines."""
    write_result_csv(trained.comparison(), f"{path}/regression_results")
    for name in trained.fitted:
        write_result_csv(
            trained.importances(spark, name).select("feature", "importance"),
            f"{path}/feature_importance_{name}",
        )
        trained.scorer(name).write().overwrite().save(f"{path}/models/{name}")
    save_predictions(spark, trained, path, list(keys), label)
    logged, best = training_runs(spark, trained, experiment, features_path, label, path)
    runs.log_runs(f"{path}/runs", logged)
    return best
