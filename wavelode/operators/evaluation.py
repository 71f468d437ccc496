"""Prediction quality, for any number of models in one pass."""

from pyspark.sql import functions as F

from wavelode.operators.sampling import sample_n
from wavelode.schemas import LABEL


def regression_metrics(predictions, columns, label=LABEL):
    """Error measures per model; ``columns`` maps a model to its prediction."""
    y = F.col(label).cast("double")
    rows = []
    for name, column in columns.items():
        error = y - F.col(column)
        known = F.when(error.isNotNull(), y)  # all measures over the same rows
        rows.append(F.struct(
            F.lit(name).alias("model"),
            F.count(error).alias("rows"),
            F.sqrt(F.avg(error * error)).alias("rmse"),
            F.avg(F.abs(error)).alias("mae"),
            (
                1 - F.try_divide(F.sum(error * error), F.var_pop(known) * F.count(known))
            ).alias("r2"),
            F.coalesce(F.avg(error), F.lit(0.0)).alias("residual_mean"),
            F.coalesce(F.stddev_samp(error), F.lit(0.0)).alias("residual_std"),
            F.coalesce(F.avg(F.abs(error)), F.lit(0.0)).alias("residual_abs_mean"),
        ))
    return predictions.agg(F.array(*rows).alias("r")).select(F.inline("r"))


def residuals(predictions, label=LABEL, prediction="prediction"):
    """Label, prediction, residual and its size."""
    residual = F.col(label) - F.col(prediction)
    return predictions.select(
        F.col(label), F.col(prediction),
        residual.alias("residual"), F.abs(residual).alias("abs_residual"),
    )


def residual_stats(predictions, label=LABEL, prediction="prediction"):
    """Mean, sample deviation and mean size of the residuals, 0 when undefined."""
    return residuals(predictions, label, prediction).agg(
        F.coalesce(F.avg("residual"), F.lit(0.0)).alias("residual_mean"),
        F.coalesce(F.stddev_samp("residual"), F.lit(0.0)).alias("residual_std"),
        F.coalesce(F.avg("abs_residual"), F.lit(0.0)).alias("residual_abs_mean"),
    )


def compare_models(metrics, digits=4):
    """Rounded metrics per model, least rmse first; the first row is the best."""
    return metrics.select(
        F.col("model").alias("Model"),
        *[
            F.round(c, digits).alias(c)
            for c in ("rmse", "mae", "r2", "residual_abs_mean")
        ],
    ).orderBy("rmse", "Model")


def actual_vs_predicted(predictions, key, n=5000, label=LABEL, prediction="prediction",
                        **options):
    """A fixed-size sample of label and prediction pairs."""
    keys = [key] if isinstance(key, str) else list(key)
    wanted = predictions.select(*dict.fromkeys([*keys, label, prediction]))
    return sample_n(wanted, keys, n, **options)
