import math

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from wavelode.operators import features as feat
from wavelode.operators import models, runs
from wavelode.operators.evaluation import (
    actual_vs_predicted, compare_models, regression_metrics, residual_stats, residuals,
)
from wavelode.plans.training import save_training, split_tracks, train_models, training_runs
from wavelode.schemas import FEATURE_COLUMNS
from wavelode.session import session_conf
from wavelode.sources.files import path_exists


def track_data(n=1500, genres=40, seed=3):
    rng = np.random.default_rng(seed)
    data = pd.DataFrame({
        "track_id": [f"t{i}" for i in range(n)],
        "artists": rng.choice(["a", "a;b", "a;b;"], n),
        "track_name": rng.choice(["X (feat. Y)", "FT. Z", "Left", "Featuring"], n),
        "track_genre": [f"g{i:02d}" for i in rng.integers(0, genres, n)],
        "duration_ms": rng.integers(100000, 300000, n),
        "explicit_int": rng.integers(0, 2, n),
    })
    for c in ["danceability", "energy", "speechiness", "acousticness",
              "instrumentalness", "liveness", "valence"]:
        data[c] = rng.random(n)
    data["loudness"] = -30 * rng.random(n)
    data["tempo"] = 60 + 120 * rng.random(n)
    data["popularity"] = (
        20 + 40 * data["energy"] + 15 * data["explicit_int"] + rng.normal(0, 1, n)
    )
    return data


@pytest.fixture(scope="module")
def tracks(spark):
    return spark.createDataFrame(track_data()).repartition(4).persist()


@pytest.fixture(scope="module")
def trained(tracks):
    train, test = split_tracks(tracks)
    return train_models(train, test, trees=5, rounds=5)


def test_derived_features(spark):
    rows = spark.createDataFrame(
        [("a", "X (feat. Y)", 149999), ("a;b", "FT. Z", 150000), ("a;b;", "Left", 1),
         ("", "Featuring", 1), (None, None, None)],
        "artists STRING, track_name STRING, duration_ms INT",
    ).withColumns({c: F.lit(0.5) for c in ("energy", "danceability", "valence")})
    found = feat.track_features(rows).collect()
    assert [r["artist_count"] for r in found] == [1, 2, 3, 1, None]
    assert [r["is_feat"] for r in found] == [1, 1, 0, 0, 0]
    assert [r["is_short_track"] for r in found] == [1, 0, 1, 1, 0]
    assert found[0]["mood_index"] == found[0]["energy_dance_interaction"] == 0.25


def test_label_index_equals_string_indexer(tracks):
    theirs = StringIndexer(
        inputCol="track_genre", outputCol="track_genre_index", handleInvalid="keep"
    ).fit(tracks)
    ours = feat.fit_label_index(tracks, "track_genre").table().orderBy("position").collect()
    assert [r["label"] for r in ours] == theirs.labels
    assert [r["position"] for r in ours] == list(range(40))


def test_index_of_many_labels_equals_row_number(spark, tmp_path):
    rows = spark.range(60_000).select(
        F.when(F.col("id") < 9000, F.lit("heavy")).when(F.col("id") < 9100, F.lit(None))
        .otherwise(F.concat(F.lit("g"), F.col("id") % 50_000)).alias("genre"),
        F.col("id"),
    )
    index = feat.fit_label_index(rows, "genre")
    assert index.getOrDefault(index.heavy) == ["heavy"]
    found = index.transform(rows)
    assert found.columns == ["genre", "id", "genre_index"] and found.count() == 60_000
    expected = rows.filter("genre IS NOT NULL").groupBy("genre").count().selectExpr(
        "genre", "row_number() OVER (ORDER BY count DESC, genre) - 1 AS place")
    labels = expected.count()
    assert labels > 40_000
    wrong = found.join(expected, "genre", "left").filter(
        f"genre_index <> coalesce(place, {labels})")
    assert wrong.isEmpty()
    PipelineModel([index]).write().overwrite().save(str(tmp_path / "index"))
    again = PipelineModel.load(str(tmp_path / "index")).transform(rows)
    assert again.exceptAll(found).isEmpty()
    slot = found.schema["genre_index"].metadata["ml_attr"]
    assert slot["num_vals"] == labels + 1


def test_unseen_and_missing_labels_share_an_index(spark, tracks):
    model = feat.fit_label_index(tracks, "track_genre")
    rows = spark.createDataFrame([("new",), (None,)], "track_genre STRING")
    assert {r["track_genre_index"] for r in model.transform(rows).collect()} == {40.0}


def test_feature_table(tracks, spark, tmp_path):
    gaps = tracks.withColumn("tempo", F.when(F.col("track_id") != "t1", F.col("tempo")))
    gaps = gaps.withColumn(
        "energy", F.when(F.col("track_id") == "t2", F.lit(math.nan)).otherwise(F.col("energy"))
    )
    table = feat.feature_table(gaps)
    assert len(table.columns) == 20
    assert table.count() == tracks.count() - 2
    assert feat.feature_names(table) == FEATURE_COLUMNS
    table.write.parquet(str(tmp_path / "features"))
    back = spark.read.parquet(str(tmp_path / "features"))
    assert feat.feature_names(back) == FEATURE_COLUMNS
    assert models.tree_bins(back) == feat.max_categories(back) + 1 > 40


def test_feature_names_without_metadata(spark):
    from pyspark.ml.linalg import Vectors

    bare = spark.createDataFrame([(Vectors.dense(1, 2),)], ["features"])
    assert feat.feature_names(bare) == ["feature_0", "feature_1"]
    assert feat.feature_names(bare, expected=["a", "b"]) == ["a", "b"]
    assert feat.feature_names(bare, expected=["a"]) == ["feature_0", "feature_1"]


def test_split_is_disjoint_complete_and_stable(spark):
    rows = spark.range(4000).withColumn("k", F.col("id") % 1000)
    train, test = models.hash_split(rows, "k")
    assert train.count() + test.count() == 4000
    assert train.select("k").intersect(test.select("k")).isEmpty()
    again, _ = models.hash_split(rows.repartition(7), "k")
    assert again.exceptAll(train).isEmpty()
    assert abs(train.select("k").distinct().count() - 800) < 60
    left, right = models.random_split(rows)
    assert left.count() + right.count() == 4000


def test_metrics_equal_evaluator(trained):
    metrics = {r["model"]: r for r in trained.metrics.collect()}
    for name in trained.fitted:
        column = models.prediction_column(name)
        for measure in ("rmse", "mae", "r2"):
            expected = RegressionEvaluator(
                labelCol="popularity", predictionCol=column, metricName=measure
            ).evaluate(trained.predictions)
            assert math.isclose(metrics[name][measure], expected, rel_tol=1e-9)
        row = metrics[name]
        assert math.isclose(row["mae"], row["residual_abs_mean"])
        stats = residual_stats(trained.predictions, prediction=column).first()
        assert math.isclose(stats["residual_std"], row["residual_std"], rel_tol=1e-9)
        n = row["rows"]
        population = row["residual_std"] ** 2 * (n - 1) / n
        assert math.isclose(row["rmse"] ** 2, row["residual_mean"] ** 2 + population, rel_tol=1e-9)


def test_residuals(spark):
    rows = spark.createDataFrame([(10, 12.0), (5, 4.0)], "popularity INT, prediction DOUBLE")
    found = [tuple(r) for r in residuals(rows).collect()]
    assert found == [(10, 12.0, -2.0, 2.0), (5, 4.0, 1.0, 1.0)]
    empty = residual_stats(rows.limit(0)).first()
    assert tuple(empty) == (0.0, 0.0, 0.0)
    gaps = spark.createDataFrame([(10, 12.0), (5, 4.0), (99, None)], "y INT, p DOUBLE")
    assert regression_metrics(gaps, {"m": "p"}, "y").first()["r2"] == 1 - 5 / 12.5
    perfect = regression_metrics(rows.withColumn("popularity", F.lit(1)), {"m": "prediction"})
    assert perfect.first()["r2"] is None


def test_linear_models_agree_and_recover_the_signal(trained):
    linear = trained.fitted["Linear_Regression"]
    general = trained.fitted["Generalized_Linear_Regression"]
    scores = {r["model"]: r for r in trained.metrics.collect()}
    assert math.isclose(
        scores["Linear_Regression"]["rmse"], scores["Generalized_Linear_Regression"]["rmse"],
        rel_tol=0.05,
    )
    for model in (linear, general):
        assert abs(model.coefficients[FEATURE_COLUMNS.index("explicit_int")] - 15) < 1.5
    assert scores["Linear_Regression"]["r2"] > 0.9


def test_settings():
    found = {n: runs.settings(e) for n, e in models.regressors(max_bins=41).items()}
    assert found["Linear_Regression"]["regParam"] == "0.1"
    assert found["Decision_Tree_Regressor"]["minInstancesPerNode"] == "10"
    assert found["Random_Forest_Regressor"]["numTrees"] == "100"
    assert found["GBT_Regressor"]["maxIter"] == "100" and found["GBT_Regressor"]["maxDepth"] == "6"
    assert found["Generalized_Linear_Regression"]["family"] == '"gaussian"'
    assert all(p["maxBins"] == "41" for p in found.values() if "maxBins" in p)


def test_importances(spark, trained):
    tree = trained.importances(spark, "GBT_Regressor").collect()
    assert math.isclose(sum(r["importance"] for r in tree), 1.0)
    assert tree[0]["feature"] == "energy" and tree[0]["method"] == "tree_feature_importance"
    linear = trained.importances(spark, "Linear_Regression", top=3).collect()
    assert len(linear) == 3 and linear[0]["method"] == "abs_coefficients"
    with pytest.raises(ValueError):
        models.importances(spark, "GBT_Regressor", trained.fitted["GBT_Regressor"], ["a"])


def test_comparison_order(trained):
    rows = trained.comparison().collect()
    assert [r["rmse"] for r in rows] == sorted(r["rmse"] for r in rows)
    assert set(rows[0].asDict()) == {"Model", "rmse", "mae", "r2", "residual_abs_mean"}
    assert len(rows) == 5


def test_comparison_breaks_ties_by_name(spark):
    metrics = spark.createDataFrame(
        [("b", 1.00001, 1.0, 0.5, 1.0), ("a", 1.00002, 1.0, 0.5, 1.0)],
        "model STRING, rmse DOUBLE, mae DOUBLE, r2 DOUBLE, residual_abs_mean DOUBLE",
    )
    assert [r["Model"] for r in compare_models(metrics).collect()] == ["a", "b"]


def test_samples_of_predictions(trained):
    column = models.prediction_column("Linear_Regression")
    rows = actual_vs_predicted(trained.predictions, "track_id", 50, prediction=column)
    assert rows.count() == 50
    histogram = trained.residual_histogram("Linear_Regression").collect()
    assert len(histogram) == 40 and sum(r["count"] for r in histogram) == trained.sizes[1]


def test_saved_training(spark, trained, tracks, tmp_path):
    path = str(tmp_path / "training")
    best = save_training(spark, trained, path, "experiment", "features")
    assert best == trained.comparison().first()["Model"]
    logged = runs.read_runs(spark, f"{path}/runs")
    assert logged.select("run_id").distinct().count() == 6
    params = {
        r["key"]: r["value"]
        for r in logged.filter("run_name = 'GBT_Regressor' AND kind = 'param'").collect()
    }
    assert params["maxDepth"] == "6" and params["train_size"] == str(trained.sizes[0])
    assert int(params["train_size"]) + int(params["test_size"]) == tracks.count()
    metrics = logged.filter("run_name = 'GBT_Regressor' AND kind = 'metric'")
    assert {r["key"] for r in metrics.collect()} == {
        "rmse", "mae", "r2", "residual_mean", "residual_std", "residual_abs_mean",
    }
    summary = logged.filter("run_name = 'Model_Comparison_Summary'").collect()
    assert {r["key"] for r in summary} >= {"best_model", "GBT_Regressor_rmse", "target"}
    kinds = logged.filter("kind = 'model' AND key = 'model_class'").collect()
    assert len(kinds) == 5

    predictions = spark.read.parquet(f"{path}/predictions")
    assert predictions.count() == trained.sizes[1] and len(predictions.columns) == 7
    spread = spark.read.parquet(f"{path}/residual_histograms").groupBy("model").agg(
        F.count("*").alias("bins"), F.sum("count").alias("n")
    )
    assert {(r["bins"], r["n"]) for r in spread.collect()} == {(40, trained.sizes[1])}
    assert spark.read.parquet(f"{path}/prediction_sample").count() == trained.sizes[1]
    places = [r["value"] for r in logged.filter("kind = 'artifact'").collect()]
    assert len(places) == 14 and all(path_exists(spark, p) for p in places)

    written = spark.read.option("header", True).csv(f"{path}/regression_results")
    assert written.columns[0] == "Model" and written.count() == 5
    importance = spark.read.option("header", True).csv(
        f"{path}/feature_importance_GBT_Regressor"
    )
    assert importance.columns == ["feature", "importance"] and importance.count() == 17

    scorer = PipelineModel.load(f"{path}/models/{best}")
    plain = feat.track_features(tracks).withColumn("track_genre", F.lit("unseen"))
    assert models.score(scorer, plain).filter("prediction IS NOT NULL").count() == tracks.count()


def test_scoring_a_stream(spark, trained, tracks, tmp_path):
    plain = feat.track_features(tracks)
    plain.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(plain.schema).parquet(str(tmp_path / "in"))
    scored = models.score(trained.scorer("Decision_Tree_Regressor"), stream)
    query = (
        scored.select("track_id", "prediction").writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True)
        .start(str(tmp_path / "out"))
    )
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == tracks.count()


def test_runs_append(spark, tmp_path):
    path = str(tmp_path / "runs")
    for i in range(2):
        _, = [runs.log_runs(path, [runs.run_rows(spark, "e", f"r{i}", {"a": 1}, {"m": 0.5})])]
    rows = runs.read_runs(spark, path)
    assert rows.count() == 4 and rows.select("run_id").distinct().count() == 2


def test_training_runs_name_the_best(spark, trained):
    logged, best = training_runs(spark, trained, "e")
    assert len(logged) == 6 and best in trained.fitted


def test_held_rows_lie_in_short_parts(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(4_000_000).coalesce(1).select(
        F.rand(1).alias("features"), F.rand(2).alias("y"), F.rand(3).alias("z"),
    ).write.option("parquet.block.size", str(4 << 20)).parquet(path)
    with session_conf(spark, {"spark.sql.files.minPartitionNum": "1"}):
        with models.kept(spark.read.parquet(path)) as (held, rows):
            assert rows == 4_000_000
            parts = held.groupBy(F.spark_partition_id()).count()
            assert parts.agg(F.max("count")).first()[0] < 2_000_000


def test_forest_is_fitted_alone_over_rows_in_leaf_order(tracks, monkeypatch):
    train = feat.fit_features(feat.track_features(tracks)).transform(feat.track_features(tracks))
    estimators = models.regressors(max_bins=models.tree_bins(train), trees=3, rounds=2)
    seen, trees, rows = [], [], {}

    def watch(kind):
        plain = kind.fit

        def fit(self, df, params=None):
            seen.append(kind)
            if kind is models.RandomForestRegressor:
                placed = trees[0].copy({trees[0].leafCol: "leaf"}).transform(df)
                for r in placed.select("*", F.spark_partition_id().alias("part")).collect():
                    rows.setdefault(r["part"], []).append(r)
            model = plain(self, df, params)
            if kind is models.DecisionTreeRegressor:
                trees.append(model)
            seen.append(kind)
            return model

        monkeypatch.setattr(kind, "fit", fit)

    for kind in {type(e) for e in estimators.values()}:
        watch(kind)
    fitted = models.fit_all(train, estimators)
    assert list(fitted) == list(estimators)
    place = seen.index(models.RandomForestRegressor)
    assert seen[place + 1] is models.RandomForestRegressor
    assert all(seen[:place].count(kind) in (0, 2) for kind in seen)
    assert len(rows) == 4
    for part in rows.values():
        leaves = [r["leaf"] for r in part]
        assert leaves == sorted(leaves) and len(set(leaves)) > 1
    found = sorted((r["popularity"], *r["features"]) for part in rows.values() for r in part)
    assert found == sorted((r["popularity"], *r["features"]) for r in train.collect())
