"""Physical plans: pushdown, pruning, early reduction, bounded joins."""

import re

import pytest
from pyspark.sql import functions as F

from rows import event, messages
from wavelode.operators.aggregates import flag_share, summarize, top_k, value_counts
from wavelode.operators.distribution import histogram
from wavelode.operators.profile import describe_numeric, null_profile, shape_stats
from wavelode.operators.sampling import sample_n
from wavelode.plans.layers import bronze, gold, silver
from wavelode.plans.report import report
from wavelode.schemas import NUMERIC_COLUMNS
from wavelode.sources.files import table


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("plans")
    values = [event(track_id=f"t{i}", popularity=i % 100) for i in range(200)]
    bronze(messages(spark, values)).write.parquet(f"{path}/bronze")
    silver(table(spark, f"{path}/bronze")).write.parquet(f"{path}/silver")
    return str(path)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def test_rules_reach_the_scan(spark, lake):
    text = formatted(silver(table(spark, f"{lake}/bronze")))
    pushed = re.search(r"PushedFilters: \[(.*)", text).group(1)
    for wanted in (
        "IsNotNull(track_id)", "GreaterThanOrEqual(popularity,0)",
        "LessThanOrEqual(energy,1.0)", "GreaterThan(tempo,0.0)",
    ):
        assert wanted in pushed


def test_gold_reads_five_columns(spark, lake):
    text = formatted(gold(table(spark, f"{lake}/silver")))
    schema = re.search(r"ReadSchema: struct<(.*)>", text).group(1)
    assert {field.split(":")[0] for field in schema.split(",")} == {
        "track_genre", "popularity", "energy", "danceability", "tempo",
    }


@pytest.mark.parametrize("make", [
    lambda t: gold(t),
    lambda t: summarize(t, ["artists"], {"popularity": 2}),
    lambda t: value_counts(t, "track_genre"),
    lambda t: flag_share(t, "explicit_int", "popularity"),
    lambda t: histogram(t, "popularity", 50),
])
def test_groups_are_reduced_before_the_shuffle(spark, lake, make):
    shuffled = plan(make(table(spark, f"{lake}/silver"))).split("Exchange hashpartitioning")[1]
    assert "partial_" in shuffled


@pytest.mark.parametrize("make", [describe_numeric, shape_stats])
def test_wide_profiles_use_generated_code(spark, lake, make):
    rows = make(table(spark, f"{lake}/silver"), NUMERIC_COLUMNS)
    rows.collect()
    text = plan(rows)
    # A star marks an operator inside generated code.
    assert re.search(r"\*\(\d+\) HashAggregate\(keys=\[\], functions=\[partial_", text)
    assert text.count("FileScan") == text.count("FileScan", text.find("Initial Plan")) * 2


def test_limits_are_top_n(spark, lake):
    rows = table(spark, f"{lake}/silver")
    assert "TakeOrderedAndProject" in plan(top_k(rows, [F.desc("popularity"), "track_id"], 20))
    assert "TakeOrderedAndProject" in plan(sample_n(rows, ["track_id"], 5))


def test_missing_values_take_one_scan(spark, lake):
    assert plan(null_profile(table(spark, f"{lake}/silver"))).count("FileScan") == 1


def test_report_has_no_cross_join_or_python(spark, lake):
    for name, rows in report(table(spark, f"{lake}/silver")).items():
        text = plan(rows)
        for node in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "MapInPandas"):
            assert node not in text, name
