"""The five regressors, their training and scoring."""

from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    GeneralizedLinearRegression,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.sql import functions as F

from wavelode.functions.hashing import hash_bucket
from wavelode.operators.features import max_categories
from wavelode.schemas import LABEL
from wavelode.session import SHORT_TASKS, ensure_checkpoint_dir, session_conf


def in_train(key="track_id", train_pct=80, seed=42, method="xxhash64"):
    """Is a row on the training side? All rows of a key are on one side."""
    keys = [key] if isinstance(key, str) else list(key)
    return hash_bucket(keys, 100, seed, method) < train_pct


def hash_split(df, key="track_id", train_pct=80, seed=42, method="xxhash64"):
    """Train and test sides by key."""
    side = in_train(key, train_pct, seed, method)
    return df.filter(side), df.filter(~side)


def random_split(df, train_pct=80, seed=42):
    """Row-level split; repeatable only for the same partitioning."""
    return df.randomSplit([train_pct / 100, 1 - train_pct / 100], seed=seed)


def tree_bins(df, column="features"):
    """Enough bins for every category and the extra index of unseen ones."""
    return max(32, max_categories(df, column) + 1)


def regressors(label=LABEL, max_bins=32, trees=100, rounds=100, features="features"):
    """Estimators by model name."""
    columns = dict(featuresCol=features, labelCol=label, predictionCol="prediction")
    # The settings of each model.
    return {
        "Linear_Regression": LinearRegression(
            maxIter=100, regParam=0.1, elasticNetParam=0.0, **columns
        ),
        "Decision_Tree_Regressor": DecisionTreeRegressor(
            maxDepth=8, minInstancesPerNode=10, maxBins=max_bins, **columns
        ),
        "Random_Forest_Regressor": RandomForestRegressor(
            numTrees=trees, maxDepth=8, seed=42, maxBins=max_bins, **columns
        ),
        "GBT_Regressor": GBTRegressor(
            maxIter=rounds, maxDepth=6, stepSize=0.1, seed=42, maxBins=max_bins, **columns
        ),
        "Generalized_Linear_Regression": GeneralizedLinearRegression(
            family="gaussian", link="identity", maxIter=100, regParam=0.1, **columns
        ),
    }


@contextmanager
def kept(df):
    """Hold a table that several fits read, with its number of rows; lost parts are
    computed again. Fits take over its parts, so these are short."""
    df = df.persist()
    try:
        with session_conf(df.sparkSession, SHORT_TASKS):
            rows = df.count()
        yield df, rows
    finally:
        df.unpersist()


def training_view(vectors, estimators):
    """Only the columns the estimators read."""
    used = {e.getFeaturesCol() for e in estimators.values()}
    used |= {e.getLabelCol() for e in estimators.values()}
    return vectors.select(*sorted(used))


def in_leaf_order(train, tree):
    """The rows of each part by the leaf of a fitted tree that they fall in.

    A deep forest counts in more places than a processor's cache holds. Rows that are alike
    count in the same few of them, so it is faster over rows that lie in such an order.
    """
    leaf = "__leaf"
    placed = tree.copy({tree.leafCol: leaf}).transform(train)
    return placed.sortWithinPartitions(leaf).select(*train.columns)


def fit_at_once(train, estimators, at_once=4):
    inherit = inheritable_thread_target(train.sparkSession)
    with ThreadPoolExecutor(max(1, at_once)) as pool:
        fits = {
            name: pool.submit(inherit(estimator.fit), train)
            for name, estimator in estimators.items()
        }
        return {name: fit.result() for name, fit in fits.items()}


def fit_each(train, estimators, at_once=4):
    """Fit every estimator on a table that is already kept, several at once.

    A forest holds a number for each row and tree, so it is fitted while no other fit holds
    rows, and over rows in the order of a tree's leaves if a tree is among the estimators.
    Boosting is a long row of small jobs, between which there is room for the others. It
    grows its lineage with every round and cuts it at checkpoints.
    """
    ensure_checkpoint_dir(train.sparkSession)
    trees, forests = (
        {name: e for name, e in estimators.items() if isinstance(e, kind)}
        for kind in (DecisionTreeRegressor, RandomForestRegressor)
    )
    fitted = {}
    if forests:
        fitted = fit_at_once(train, trees, at_once)
        ordered = in_leaf_order(train, next(iter(fitted.values()))) if trees else train
        if trees:  # read three times by a fit; memory is left to what the fit holds
            ordered = ordered.persist(StorageLevel.DISK_ONLY)
        try:
            fitted |= fit_at_once(ordered, forests, 1)
        finally:
            if trees:
                ordered.unpersist()
    others = {name: e for name, e in estimators.items() if name not in fitted}
    fitted |= fit_at_once(train, others, at_once)
    return {name: fitted[name] for name in estimators}


def fit_all(vectors, estimators):
    """Fit each estimator on the same table, computed once."""
    with kept(training_view(vectors, estimators)) as (train, _):
        return fit_each(train, estimators)


def score(model, df):
    """Add the prediction of one fitted model or pipeline, batch or stream."""
    return model.transform(df)


def prediction_column(name):
    return f"prediction_{name}"


def score_all(models, df):
    """Add one prediction column per model, so the table is read once for all."""
    for name, model in models.items():
        df = model.copy({model.predictionCol: prediction_column(name)}).transform(df)
    return df


# Linear models weigh features by coefficients, all others by what their splits gain.
LINEAR_MODELS = ("Linear_Regression", "Generalized_Linear_Regression")
# What the weights of either kind are called.
COEFFICIENT_METHOD = "abs_coefficients"
SPLIT_METHOD = "tree_feature_importance"


def importances(spark, name, model, slots, top=None):
    """Weights of a fitted model's features: (feature, importance, method), largest first.

    ``name`` is a key of ``regressors`` and tells what kind of weights the model has;
    ``slots`` are the names of the vector slots.
    """
    linear = name in LINEAR_MODELS
    vector = model.coefficients if linear else model.featureImportances
    method = COEFFICIENT_METHOD if linear else SPLIT_METHOD
    weights = spark.createDataFrame(
        [(slot, float(weight), method) for slot, weight in zip(slots, vector.toArray(), strict=True)],
        "feature STRING, importance DOUBLE, method STRING",
    )
    ranked = weights.withColumn("importance", F.abs("importance")).orderBy(
        F.desc("importance"), "feature")
    return ranked.limit(top) if top else ranked
