"""Merged states, headers of many files and replaced tables."""

import gzip
import random

import pytest
from pyspark.sql import functions as F

from wavelode.operators import models
from wavelode.operators.correlation import corr_matrix
from wavelode.operators.profile import describe_numeric, null_profile, shape_stats
from wavelode.operators.sinks import read_replaced, replace_table
from wavelode.operators.states import (
    comoment_states, correlation_profile, distinct_error, distinct_profile, distinct_states,
    merge_moments, moment_profile, moment_states, quantile_profile, quantile_states, rank_error,
)
from wavelode.plans.training import train_models
from wavelode.sources.files import child_names, csv_headers, read_tracks_csv, table, table_stream
from wavelode.streaming.profiles import StoredProfile, profile_stream
from wavelode.streaming.sinks import append_stream, run_stream

COLUMNS = ["a", "b", "c", "flat"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(9)

    def value(x):
        return rng.choice([x] * 8 + [None, float("nan")])

    data = []
    for n in range(3000):
        a = rng.gauss(1e5, 3)
        data.append((n, n % 7, value(a), value(a * 2 + rng.gauss(0, 4)), value(rng.expovariate(1)),
                     4.25, rng.choice(["x", "y", None])))
    frame = spark.createDataFrame(
        data, "id INT, part INT, a DOUBLE, b DOUBLE, c DOUBLE, flat DOUBLE, name STRING")
    return frame.persist()


def clean(rows, columns=COLUMNS):
    return rows.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in columns})


def test_merged_moments_equal_a_full_scan(spark, rows):
    parts = [rows.where(F.col("part") == p) for p in range(7)] + [rows.where("id < 0")]
    states = None
    for part in parts:
        state = moment_states(part, COLUMNS)
        states = state if states is None else states.unionByName(state)
    found = {r["column"]: r for r in moment_profile(states).collect()}
    describe = {r["column"]: r for r in describe_numeric(clean(rows), COLUMNS).collect()}
    shape = {r["column"]: r for r in shape_stats(clean(rows), COLUMNS).collect()}
    missing = {r["column"]: r["null_count"] for r in null_profile(rows, COLUMNS).collect()}
    for c in COLUMNS:
        f, d = found[c], describe[c]
        assert (f["count"], f["min"], f["max"], f["missing"]) == (
            d["count"], d["min"], d["max"], missing[c])
        assert f["mean"] == pytest.approx(d["mean"], rel=1e-12)
        assert f["stddev"] == pytest.approx(d["stddev"], rel=1e-9)
    for c in ("a", "b", "c"):
        assert found[c]["skewness"] == pytest.approx(shape[c]["skewness"], rel=1e-9, abs=1e-9)
        assert found[c]["kurtosis"] == pytest.approx(shape[c]["kurtosis"], rel=1e-9, abs=1e-9)
    assert found["flat"]["skewness"] is None and found["flat"]["stddev"] == 0
    # Merging in steps gives the same as merging at once.
    half = merge_moments(states.where("n % 2 = 0")).unionByName(
        merge_moments(states.where("n % 2 = 1")))
    again = {r["column"]: r for r in moment_profile(half).collect()}
    for c in ("a", "b", "c"):
        assert again[c]["kurtosis"] == pytest.approx(found[c]["kurtosis"], rel=1e-9)


def test_merged_groups(spark, rows):
    states = moment_states(rows, ["a"], ["part", "name"])
    found = {r["part"]: r for r in moment_profile(states, ["part"]).collect()}
    assert len(found) == 7
    for r in clean(rows).groupBy("part").agg(
            F.count("a").alias("n"), F.stddev_samp("a").alias("s")).collect():
        assert found[r["part"]]["count"] == r["n"]
        assert found[r["part"]]["stddev"] == pytest.approx(r["s"], rel=1e-9)
    named = moment_profile(states, ["name"]).collect()
    assert {r["name"] for r in named} == {"x", "y", None}


def test_profiles_of_nothing(spark, rows):
    empty = rows.where("id < 0")
    found = moment_profile(moment_states(empty, ["a"])).first()
    assert found["count"] == 0 and found["mean"] is None and found["stddev"] is None
    assert correlation_profile(comoment_states(empty, ["a", "b"])).first()["r"] is None
    assert quantile_profile(quantile_states(empty, ["a"])).collect() == []
    assert distinct_profile(distinct_states(empty, ["name"])).first()["distinct_values"] == 0


def test_merged_correlations_equal_a_full_scan(spark, rows):
    states = None
    for p in range(7):
        state = comoment_states(rows.where(F.col("part") == p), COLUMNS)
        states = state if states is None else states.unionByName(state)
    found = {(r["column_a"], r["column_b"]): r["r"] for r in correlation_profile(states).collect()}
    assert len(found) == 6
    for r in corr_matrix(rows, COLUMNS).collect():
        pair = r["column_a"], r["column_b"]
        if pair in found:
            assert found[pair] == (None if r["r"] is None else pytest.approx(r["r"], abs=1e-9))
    assert found["a", "flat"] is None and found["a", "b"] > 0.5


def test_sketches_stay_within_their_bounds(spark):
    rows = spark.range(60000).selectExpr("id", "id % 13 AS part", "double(id * 7919 % 60000) AS v")
    quantiles = quantile_states(rows, ["v"], ["part"])
    distincts = distinct_states(rows, ["v"], ["part"])
    found = quantile_profile(quantiles, (0.1, 0.5, 0.99)).collect()
    for r in found:
        assert abs(r["value"] / 60000 - r["probability"]) <= 3 * rank_error()
    count = distinct_profile(distincts).first()["distinct_values"]
    assert abs(count / 60000 - 1) <= 3 * distinct_error()
    # Parts that share their values are united, not added.
    twice = distincts.unionByName(distincts)
    assert distinct_profile(twice).first()["distinct_values"] == count
    assert rank_error(200) == pytest.approx(0.0133, abs=1e-4)


def test_a_profile_reads_only_new_rows(spark, tmp_path):
    source, path = str(tmp_path / "in"), str(tmp_path / "profile")
    read = []
    for turn in range(3):
        spark.range(turn * 100, turn * 100 + 100).selectExpr(
            "id", "double(id) AS v", "timestampadd(DAY, int(id % 2), TIMESTAMP '2024-01-01') AS at"
        ).coalesce(1).write.mode("append").parquet(source)
        done = run_stream(profile_stream(
            table_stream(spark, source, "id BIGINT, v DOUBLE, at TIMESTAMP"), path,
            str(tmp_path / "cp"), ["v"], ["id"], "at", "available_now"))
        read.append(sum(p["numInputRows"] for p in done.recentProgress))
    assert read == [100, 100, 100]
    profile = StoredProfile(spark, path)
    whole = profile.moments().first()
    assert whole["count"] == 300 and whole["mean"] == 149.5
    days = {str(r["day"]): r["mean"] for r in profile.moments(["day"]).collect()}
    assert days == {"2024-01-01": 149.0, "2024-01-02": 150.0}
    assert abs(profile.distincts().first()["distinct_values"] - 300) < 10
    assert abs(profile.quantiles().first()["value"] - 149.5) < 10


def test_headers_are_read_by_tasks(spark, tmp_path):
    folder = tmp_path / "files"
    folder.mkdir()
    for n in range(5):
        names = "track_id,tempo" if n % 2 else "﻿tempo,track_id"
        rows = [f"t{n}-{i},{i}" if n % 2 else f"{i},t{n}-{i}" for i in range(20000)]
        (folder / f"part {n}%.csv").write_text("\n".join([names, *rows]) + "\n")
    (folder / "empty.csv").write_text("")
    with gzip.open(folder / "z.csv.gz", "wt") as file:
        file.write("tempo,track_id\n5,t9-5\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    found = csv_headers(spark, str(folder))
    assert {k: len(v) for k, v in found.items()} == {
        ("track_id", "tempo"): 2, ("tempo", "track_id"): 4}
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    rows = read_tracks_csv(spark, str(folder))
    assert rows.count() == 100001
    assert rows.where("track_id = concat(substring(track_id, 1, 2), '-', int(tempo))").count() == 100001


def test_one_header_needs_no_file_names(spark, tmp_path):
    for n in range(3):
        (tmp_path / f"{n}.csv").write_text(f"track_id,tempo\nt{n},{n}\n")
    rows = read_tracks_csv(spark, str(tmp_path))
    assert sorted(r.track_id for r in rows.collect()) == ["t0", "t1", "t2"]


def test_a_table_can_replace_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_table(spark.range(4), path)
    reader = read_replaced(spark, path)
    replace_table(reader.unionByName(reader), path)
    assert read_replaced(spark, path).count() == 8 and reader.count() == 4
    bad = read_replaced(spark, path).select(F.raise_error(F.lit("stop")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="stop"):
        replace_table(bad, path)
    assert read_replaced(spark, path).count() == 8
    replace_table(spark.range(1), path)
    replace_table(spark.range(2), path)
    assert read_replaced(spark, path).count() == 2
    names = [c for c in child_names(spark, path) if c.startswith("version=")]
    assert len(names) == 2
    with pytest.raises(FileNotFoundError):
        read_replaced(spark, str(tmp_path / "none"))


def test_stream_scores_of_unseen_labels_equal_batch_scores(spark, tmp_path):
    rng = random.Random(5)
    data = [(n, rng.choice("aabbc"), rng.random()) for n in range(200)]
    train = spark.createDataFrame(data, "id INT, kind STRING, y DOUBLE")
    name = "Linear_Regression"
    trained = train_models(
        train, train, "y", ["kind_index"], nominal="kind",
        estimators={name: models.regressors("y")[name]})
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    columns = ["id", "kind", "prediction"]
    for turn, kinds in enumerate(("abc", "adz", [None, "q"])):
        spark.createDataFrame(
            [(turn * 10 + n, k, 0.0) for n, k in enumerate(kinds)], train.schema
        ).coalesce(1).write.mode("append").parquet(source)
        stream = table_stream(spark, source, train.schema)
        scored = models.score(trained.scorer(name), stream).select(*columns)
        run_stream(append_stream(scored, out, str(tmp_path / "cp"), "available_now"))
    expected = models.score(trained.scorer(name), table(spark, source)).select(*columns)
    assert sorted(map(str, table(spark, out).collect())) == sorted(map(str, expected.collect()))
    unseen = {r.prediction for r in expected.collect() if r.kind not in ("a", "b", "c")}
    assert len(unseen) == 1
