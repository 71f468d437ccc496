import pytest
from pyspark.sql import functions as F

from rows import event, messages
from wavelode.functions.buckets import (
    DASHBOARD_TEMPO, GOLD_TEMPO, POPULARITY_SEGMENT, SEGMENT_TEMPO,
)
from wavelode.operators.quality import (
    SILVER_RULES, apply_rules, dedupe, drop_missing, latest_per_key, rule_counts,
)
from wavelode.plans.layers import bronze, gold, silver, silver_rejects, timed

NAN = float("nan")


def kept(spark, *values):
    return silver(bronze(messages(spark, list(values))))


@pytest.mark.parametrize("changes, passes", [
    ({}, True),
    ({"popularity": -1}, False), ({"popularity": 0}, True),
    ({"popularity": 100}, True), ({"popularity": 101}, False),
    ({"popularity": None}, False), ({"track_id": None}, False),
    ({"track_name": None}, False), ({"artists": None}, False), ({"artists": ""}, True),
    ({"track_genre": None}, True),
    ({"event_time": "garbage"}, False), ({"event_time": None}, False),
    ({"duration_ms": 0}, False), ({"duration_ms": 1}, True),
    ({"energy": 1.0}, True), ({"energy": 1.01}, False), ({"energy": NAN}, False),
    ({"danceability": -0.1}, False), ({"valence": None}, False),
    ({"tempo": 0.0}, False), ({"tempo": NAN}, True), ({"tempo": None}, False),
])
def test_silver_rules(spark, changes, passes):
    assert kept(spark, event(**changes)).count() == int(passes)


def test_silver_columns(spark):
    rows = kept(spark, event(), event(track_id="t2", explicit=None), "not json")
    assert len(rows.columns) == 31
    assert {r["track_id"]: r["explicit_int"] for r in rows.collect()} == {"t1": 1, "t2": 0}
    assert len(bronze(messages(spark, [event()])).columns) == 28


def test_duplicates(spark):
    later = "2024-03-02T00:00:00+00:00"
    rows = kept(spark, event(), event(popularity=9), event(event_time=later))
    assert rows.count() == 2
    assert latest_per_key(rows, ["track_id"], ["event_timestamp"]).first()["event_time"] == later


def test_dedupe_keeps_first_in_order(spark):
    rows = spark.createDataFrame([(1, 3), (1, 2), (2, 5)], "k INT, o INT")
    assert sorted(dedupe(rows, ["k"], order=["o"]).collect()) == [(1, 2), (2, 5)]
    assert dedupe(rows, ["k"]).count() == 2
    assert dedupe(rows.select("k"), ["k"]).count() == 2


def test_heavy_key_is_reduced_before_the_shuffle(spark):
    rows = spark.range(0, 10000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id"
    )
    unique = dedupe(rows, ["k"], order=["id"])
    plan = unique._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan.split("Exchange")[1]
    assert "WindowGroupLimit" in before_shuffle
    assert unique.count() == 6667


def test_rules_split_is_complete(spark):
    values = [event(track_id=f"t{i}", popularity=i * 10 - 20, energy=i / 10) for i in range(15)]
    rows = timed(bronze(messages(spark, values)))
    good, bad = apply_rules(rows, SILVER_RULES)
    assert good.count() + bad.count() == rows.count() == 15
    counts = {r["rule"]: r["rejected"] for r in rule_counts(rows, SILVER_RULES).collect()}
    named = {
        r["rule"]: r["n"]
        for r in bad.select(F.explode("failed_rules").alias("rule")).groupBy("rule")
        .agg(F.count("*").alias("n")).collect()
    }
    assert named == {rule: n for rule, n in counts.items() if n}
    assert silver_rejects(bronze(messages(spark, ["null"]))).first()["failed_rules"] == list(
        SILVER_RULES
    )


def test_gold(spark):
    values = [
        event(track_id="1", tempo=89.99), event(track_id="2", tempo=90.0),
        event(track_id="3", tempo=119.99), event(track_id="4", tempo=120.0),
        event(track_id="5", tempo=NAN), event(track_id="6", track_genre=None),
        event(track_id="7", tempo=90.0, popularity=51, energy=0.25),
    ]
    table = gold(kept(spark, *values))
    assert len(table.columns) == 7
    found = {r["tempo_bucket"]: (r["track_count"], r["avg_popularity"], r["avg_energy"])
             for r in table.collect()}
    assert found == {
        "slow": (1, 50.0, 0.5), "medium": (3, 50.33, 0.4167), "fast": (2, 50.0, 0.5),
    }


@pytest.mark.parametrize("buckets, cases", [
    (GOLD_TEMPO, {89.99: "slow", 90.0: "medium", 119.99: "medium", 120.0: "fast",
                  None: "fast", NAN: "fast"}),
    (SEGMENT_TEMPO, {89.99: "Slow (<90)", 90.0: "Midtempo (90-119)",
                     120.0: "Upbeat (120-149)", 150.0: "Fast (150+)", None: "Fast (150+)"}),
    (DASHBOARD_TEMPO, {0.0: None, 0.1: "Very Slow", 80.0: "Very Slow", 80.1: "Slow",
                       140.0: "Fast", 1000.0: "Very Fast", 1000.1: None, None: None,
                       NAN: None}),
    (POPULARITY_SEGMENT, {20.0: "Düşük (0-20)", 21.0: "Orta (21-50)",
                          75.0: "Yüksek (51-75)", 76.0: "Çok Yüksek (76-100)"}),
])
def test_bucket_edges(spark, buckets, cases):
    rows = spark.createDataFrame(list(enumerate(cases)), "i INT, v DOUBLE")
    found = rows.orderBy("i").select(buckets.of("v").alias("b")).collect()
    assert [r["b"] for r in found] == list(cases.values())


def test_drop_missing(spark):
    rows = spark.createDataFrame([(1.0, 1), (NAN, 1), (None, 1), (2.0, None)], "a DOUBLE, b INT")
    assert drop_missing(rows, ["a", "b"]).collect() == [(1.0, 1)]
