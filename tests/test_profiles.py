import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wavelode.functions.buckets import DASHBOARD_TEMPO, SEGMENT_TEMPO
from wavelode.operators import distribution
from wavelode.operators.aggregates import (
    binned_summary, flag_share, label_rank, order_by_labels, segment_summary, value_counts,
)
from wavelode.operators.correlation import corr_matrix, corr_with
from wavelode.operators.distribution import box_stats, exact_quantiles, histogram
from wavelode.operators.profile import (
    describe_numeric, distinct_counts, mean_and_median, medians, null_profile, schema_profile,
)
from wavelode.operators.sampling import sample_n
from wavelode.plans.layers import bronze, silver
from wavelode.plans.report import report
from rows import event, messages

NAN = float("nan")


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(7)
    n = 5000
    data = pd.DataFrame({
        "id": np.arange(n),
        "u": rng.integers(0, 101, n) / 100,
        "e": rng.exponential(50, n),
        "heavy": np.where(rng.random(n) < 0.4, 3.0, rng.normal(10, 4, n)),
        "constant": 0.1,
    })
    data["gaps"] = data["e"].where(data["id"] % 7 != 0) + data["u"]
    return data


@pytest.fixture(scope="module")
def table(spark, frame):
    # pandas NaN arrives as NaN, which every statistic must treat as missing.
    return spark.createDataFrame(frame).repartition(8).persist()


@pytest.mark.parametrize("column", ["u", "e", "heavy", "gaps", "constant"])
@pytest.mark.parametrize("bins", [30, 50])
def test_histogram_equals_numpy(table, frame, column, bins):
    counts, edges = np.histogram(frame[column].dropna(), bins=bins)
    rows = histogram(table, column, bins).collect()
    assert [r["count"] for r in rows] == counts.tolist()
    assert np.allclose([r["lo"] for r in rows], edges[:-1])
    assert np.allclose([r["hi"] for r in rows], edges[1:])


def test_histograms_together(table, frame):
    rows = histogram(table, ["u", "gaps"], 20).groupBy("column").agg(
        F.sum("count").alias("n")
    ).collect()
    assert {r["column"]: r["n"] for r in rows} == frame[["u", "gaps"]].count().to_dict()


def test_histogram_of_nothing(spark):
    assert histogram(spark.createDataFrame([(None,)], "x DOUBLE"), "x", 5).count() == 0


@pytest.mark.parametrize("inline_rows, sample", [(100_000, 10**6), (50, 10**6), (50, 400)])
def test_exact_quantiles(table, frame, monkeypatch, inline_rows, sample):
    monkeypatch.setattr(distribution, "_SAMPLE", sample)
    columns, shares = ["u", "e", "heavy", "gaps"], [0.0, 0.01, 0.25, 0.5, 0.75, 1.0]
    rows = exact_quantiles(table, columns, shares, inline_rows=inline_rows).collect()
    expected = [frame[c].quantile(p) for c in columns for p in shares]
    assert np.allclose([r["value"] for r in rows], expected, rtol=1e-12)


class Scans:
    """Counts the passes over a table."""

    def __init__(self, df):
        self.df, self.count, self.sparkSession = df, 0, df.sparkSession

    def agg(self, *columns):
        self.count += 1
        return self.df.agg(*columns)

    def select(self, *columns):
        self.count += 1
        return self.df.select(*columns)


def test_quantiles_scan_the_input_four_times_at_most(table, frame):
    scans, shares = Scans(table), [0.25, 0.5, 0.75]
    rows = exact_quantiles(scans, ["u", "heavy"], shares, inline_rows=20).collect()
    assert scans.count <= 4
    expected = [frame[c].quantile(p) for c in ("u", "heavy") for p in shares]
    assert np.allclose([r["value"] for r in rows], expected, rtol=1e-12)


def test_quantiles_of_nothing(spark):
    rows = exact_quantiles(spark.createDataFrame([(None,)], "x DOUBLE"), "x", [0.5])
    assert rows.first()["value"] is None


def test_box_stats(table, frame):
    x = frame["e"]
    q1, q3 = x.quantile(0.25), x.quantile(0.75)
    low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    row = box_stats(table, "e").first()
    assert row["whisker_high"] == x[x <= high].max() and row["whisker_low"] == x[x >= low].min()
    assert row["outliers"] == int(((x < low) | (x > high)).sum())
    assert math.isclose(row["median"], x.median())


def test_correlation_is_pairwise_complete(table, frame):
    columns = ["u", "e", "heavy", "gaps", "constant"]
    expected = frame[columns].corr()
    rows = corr_matrix(table, columns).collect()
    assert len(rows) == 25
    for row in rows:
        value = expected.loc[row["column_a"], row["column_b"]]
        if math.isnan(value):
            assert row["r"] is None
        else:
            assert math.isclose(row["r"], value, abs_tol=1e-12)


def test_correlation_with_gaps(table, frame):
    columns = ["u", "e", "heavy", "gaps"]
    for row in corr_matrix(table, columns).collect():
        expected = frame[columns].corr().loc[row["column_a"], row["column_b"]]
        assert math.isclose(row["r"], expected, abs_tol=1e-12)


def test_correlation_without_values(spark):
    rows = spark.createDataFrame([(None, 1.0), (None, 2.0)], "a DOUBLE, b DOUBLE")
    found = {(r["column_a"], r["column_b"]): r["r"] for r in corr_matrix(rows, ["a", "b"]).collect()}
    assert found == {("a", "a"): None, ("a", "b"): None, ("b", "a"): None, ("b", "b"): 1.0}
    assert corr_matrix(rows.limit(0), ["b"]).first()["r"] is None


def test_correlation_with_large_offset(spark):
    rng = np.random.default_rng(1)
    data = pd.DataFrame({"a": 1e9 + rng.normal(size=500), "b": rng.normal(size=500)})
    data["b"] += data["a"] - 1e9
    r = corr_with(spark.createDataFrame(data), "b", ["a", "b"]).collect()
    assert [row["column"] for row in r] == ["a"]
    assert math.isclose(r[0]["r"], data.corr().loc["a", "b"], abs_tol=1e-6)


def test_strongest_first(table, frame):
    order = [r["column"] for r in corr_with(table, "gaps", ["u", "e", "heavy", "constant"]).collect()]
    assert order[0] == "e" and order[-1] == "constant"


def test_markers(table, frame):
    rows = {r["column"]: r for r in mean_and_median(table, ["e", "gaps"]).collect()}
    assert math.isclose(rows["gaps"]["mean"], frame["gaps"].mean())
    assert math.isclose(rows["gaps"]["median"], frame["gaps"].median())
    assert medians(table, ["u"]).first()["median"] in set(frame["u"])


def test_describe(table, frame):
    rows = describe_numeric(table, ["u", "e"]).collect()
    for row in rows:
        x = frame[row["column"]]
        assert row["count"] == len(x) and math.isclose(row["stddev"], x.std())
        assert (row["min"], row["max"]) == (x.min(), x.max())


def test_null_profile(spark):
    rows = spark.createDataFrame(
        [(1.0, "a"), (NAN, None), (None, None), (2.0, None)], "x DOUBLE, s STRING"
    )
    found = [tuple(r) for r in null_profile(rows).collect()]
    assert found == [("s", 3, 75.0), ("x", 2, 50.0)]
    empty = [tuple(r) for r in null_profile(rows.limit(0)).collect()]
    assert empty == [("s", 0, 0.0), ("x", 0, 0.0)]


def test_distinct_counts_group_by_one_value(spark):
    rows = spark.createDataFrame(
        [("a", 1, 0.0, [1]), ("a", None, -0.0, [1]), (None, 2, NAN, None), ("b", 2, NAN, [None])],
        "`s.x` STRING, n INT, x DOUBLE, l ARRAY<INT>",
    ).withColumn("t", F.col("`s.x`"))
    names = ["`s.x`", "n", "x", "l", "t"]
    expected = rows.select(*[F.count_distinct(c) for c in names]).first()
    counts = distinct_counts(rows, names)
    assert [tuple(r) for r in counts.collect()] == list(zip(names, expected))
    assert [tuple(r) for r in distinct_counts(rows.limit(0), names).collect()] == [
        (c, 0) for c in names]
    # One field for each type, not one for each column.
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan and "value_3" in plan and "value_4" not in plan


def test_distinct_and_schema(spark):
    rows = spark.createDataFrame([("a", 1), ("a", None), ("b", 2)], "s STRING, n INT")
    found = {r["column"]: r["distinct_values"] for r in distinct_counts(rows, ["s", "n"]).collect()}
    assert found == {"s": 2, "n": 2}
    approx = {r["column"]: r["distinct_values"] for r in distinct_counts(rows, ["s"], True).collect()}
    assert approx == {"s": 2}
    assert [tuple(r) for r in schema_profile(rows).collect()] == [
        (0, "s", "string", 3), (1, "n", "int", 3),
    ]


def test_sample_is_the_same_for_any_layout(table):
    picks = [
        [r["id"] for r in sample_n(df, "id", 40).select("id").collect()]
        for df in (table, table.repartition(3), table.coalesce(1))
    ]
    assert len(set(picks[0])) == 40 and picks[0] == picks[1] == picks[2]


def test_sample_takes_one_scan_and_no_job_before_it(spark, table):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("sample", "sample")
    picked = sample_n(table, "id", 40)
    assert not tracker.getJobIdsForGroup("sample")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert "WindowGroupLimit" in picked._jdf.queryExecution().executedPlan().toString()


def test_sample_with_repeated_key(spark):
    rows = spark.range(2000).withColumn("k", F.lit(1))
    assert sample_n(rows, "k", 10).count() == 10


def test_flag_share(spark):
    rows = spark.createDataFrame([(1, 10), (1, 20), (0, 5), (None, 1)], "f INT, m INT")
    found = [tuple(r) for r in flag_share(rows, "f", "m").collect()]
    assert found == [(None, 1, 1.0, 25.0), (0, 1, 5.0, 25.0), (1, 2, 15.0, 50.0)]


def test_value_counts_breaks_ties_by_value(spark):
    rows = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "s STRING")
    assert [tuple(r) for r in value_counts(rows, "s", 2).collect()] == [("c", 2), ("a", 1)]
    assert value_counts(rows, "s", keep_null=True).count() == 4


def test_segments_in_bucket_order(spark):
    rows = spark.createDataFrame([(200.0, 1), (10.0, 2), (130.0, 4)], "tempo DOUBLE, p INT")
    found = segment_summary(rows, "tempo", SEGMENT_TEMPO, "b", {"p": 2}).collect()
    assert [r["b"] for r in found] == ["Slow (<90)", "Upbeat (120-149)", "Fast (150+)"]
    ranks = order_by_labels(
        rows.withColumn("b", SEGMENT_TEMPO.of("tempo")), "b", SEGMENT_TEMPO.names
    ).select(label_rank("b", SEGMENT_TEMPO.names).alias("r"))
    assert [r["r"] for r in ranks.collect()] == [0, 2, 3]


def test_empty_bins_stay(spark):
    rows = spark.createDataFrame(
        [(0.0, "x", 1), (70.0, None, 3), (110.0, "y", 5)], "tempo DOUBLE, id STRING, p INT"
    )
    found = binned_summary(rows, "tempo", DASHBOARD_TEMPO, "b", "id", "p").collect()
    assert [(r["b"], r["track_count"], r["avg_p"]) for r in found] == [
        ("Very Slow", 0, 3.0), ("Slow", 0, None), ("Medium", 1, 5.0),
        ("Fast", 0, None), ("Very Fast", 0, None),
    ]


def test_report_has_all_sections(spark):
    values = [
        event(track_id=f"t{i}", popularity=i, tempo=60.0 + i, track_genre=f"g{i % 3}")
        for i in range(60)
    ]
    sections = report(silver(bronze(messages(spark, values))))
    assert len(sections) == 26
    for name, rows in sections.items():
        assert rows.collect(), name
    partial = report(spark.createDataFrame([("a", 1)], "track_id STRING, popularity INT"),
                     keys=["track_id"])
    assert "genres" not in partial and "label_box" in partial
