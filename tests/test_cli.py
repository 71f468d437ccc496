import csv

import pytest
from pyspark.ml import PipelineModel

from test_models import track_data
from wavelode.cli import main, parse
from wavelode.operators.runs import read_runs
from wavelode.sources.files import table
from wavelode.streaming.sinks import read_snapshot


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("lake")
    data = track_data(400, genres=6).rename(columns={"explicit_int": "explicit"})
    data["explicit"] = data["explicit"].map({0: "False", 1: "True"})
    data["popularity"] = data["popularity"].clip(0, 100)
    data["album_name"] = "album"
    data.to_csv(folder / "tracks.csv", index=False, quoting=csv.QUOTE_MINIMAL)
    main(["publish", "--csv", f"{folder}/tracks.csv", "--messages", f"{folder}/messages"], spark)
    places = ["--messages", f"{folder}/messages", "--root", f"{folder}/lake",
              "--trigger", "available_now"]
    for job in ("bronze", "silver", "gold"):
        main([job, *places], spark)
    return folder


def test_layers(spark, lake):
    assert table(spark, f"{lake}/lake/silver").count() == 400
    first = read_snapshot(spark, f"{lake}/lake/gold")
    assert first.groupBy().sum("track_count").first()[0] == 400
    # Publishing again makes new events of the same tracks.
    main(["publish", "--csv", f"{lake}/tracks.csv", "--messages", f"{lake}/messages"], spark)
    main(["layers", "--messages", f"{lake}/messages", "--root", f"{lake}/lake"], spark)
    assert table(spark, f"{lake}/lake/silver").count() == 800


def test_report_features_and_training(spark, lake):
    main(["report", "--root", f"{lake}/lake", "--out", f"{lake}/report"], spark)
    assert table(spark, f"{lake}/report/genres").count() == 6
    main(["features", "--root", f"{lake}/lake", "--latest"], spark)
    features = table(spark, f"{lake}/lake/features")
    assert "features" in features.columns and features.count() == 400
    main(["train", "--root", f"{lake}/lake", "--out", f"{lake}/out", "--trees", "3",
          "--rounds", "3"], spark)
    assert read_runs(spark, f"{lake}/out/runs").count() > 0
    PipelineModel.load(f"{lake}/out/models/GBT_Regressor")


def test_defaults():
    args = parse(["silver"])
    assert args.trigger == "10 seconds" and args.seconds == 0 and args.trees == 100
