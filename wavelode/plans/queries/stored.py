"""Profiles merged from states of appended rows, replaced tables, scores of new labels."""

from pyspark.sql import functions as F

from wavelode.operators import models
from wavelode.operators.sinks import overwrite, read_replaced, replace_table
from wavelode.operators.states import distinct_error
from wavelode.plans.queries.registry import file_or_folder, load, query
from wavelode.plans.queries.streams import _messages
from wavelode.plans.queries.testbed import EVENT_TRACKS, SILVER_WHERE, state_partitions
from wavelode.plans.training import train_models
from wavelode.schemas import NUMERIC_COLUMNS
from wavelode.session import work_dir
from wavelode.sources.files import table, table_stream
from wavelode.streaming.jobs import (
    Layout, read_profile, start_bronze, start_profile, start_silver_outcomes,
)
from wavelode.streaming.profiles import StoredProfile, profile_stream
from wavelode.streaming.sinks import append_stream, run_stream

_NOW = "available_now"
_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_NAMES = ["l_orderkey", "l_partkey", "l_suppkey", "l_returnflag"]
_ARRIVALS = 3

# Lines of a sixth of the parts have no discount, and a seventh a price that is no number.
_GAPS = {
    "l_discount": "CASE WHEN l_partkey % 6 <> 0 THEN l_discount END",
    "l_extendedprice": "CASE WHEN l_partkey % 7 = 0 THEN {nan} ELSE l_extendedprice END",
}
_LINES = ", ".join(f"{e.format(nan='NULL')} AS {c}" for c, e in _GAPS.items())
_SOURCE = f"""lines AS (SELECT l_orderkey, l_partkey, l_suppkey, l_returnflag, l_quantity, l_tax,
  l_shipdate, {_LINES} FROM lineitem)"""


def _union(parts):
    return " UNION ALL ".join(parts)


def _profile(spark, folder):
    """Lines that arrive in three turns, each profiled by a run that reads it alone: the
    merged profile, and whether each run read its own rows only."""
    lines = load(spark, folder, "lineitem").withColumns({
        c: F.expr(e.format(nan="DOUBLE('NaN')")) for c, e in _GAPS.items()})
    path, target = work_dir(spark, "lines"), work_dir(spark, "profile")
    alone = True
    for turn in range(_ARRIVALS):
        rows = lines.where(F.pmod("l_orderkey", F.lit(_ARRIVALS)) == turn)
        overwrite(rows, f"{path}/{turn}")
        done = run_stream(profile_stream(
            table_stream(spark, f"{path}/*", lines.schema), target, f"{target}-checkpoint",
            _MEASURES, _NAMES, "l_shipdate", _NOW))
        read = sum(p["numInputRows"] for p in done.recentProgress)
        alone = alone and read == table(spark, f"{path}/{turn}").count()
    return StoredProfile(spark, target), alone


@query(
    "stored_moments",
    f"WITH {_SOURCE} " + _union(
        f"""SELECT '{c}' AS "column", count(*) - count({c}) AS missing, count({c}) AS count,
        round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS stddev, min({c}) AS min,
        max({c}) AS max,
        round(sum(power({c} - m, 3)) / count({c}) / power(var_pop({c}), 1.5), 6) AS skewness,
        round(sum(power({c} - m, 4)) / count({c}) / power(var_pop({c}), 2) - 3, 6) AS kurtosis,
        true AS read_new_rows_only
        FROM lines, (SELECT avg({c}) AS m FROM lines)""" for c in _MEASURES),
)
def stored_moments(spark, folder):
    profile, alone = _profile(spark, folder)
    digits = {c: F.round(c, 6) for c in ("mean", "stddev", "skewness", "kurtosis")}
    return profile.moments().withColumns(digits).withColumn("read_new_rows_only", F.lit(alone))


@query(
    "stored_daily_moments",
    f"""WITH {_SOURCE} SELECT strftime(l_shipdate, '%Y-%m-%d') AS day, count(l_quantity) AS count,
      round(avg(l_quantity), 6) AS mean, round(stddev_samp(l_quantity), 6) AS stddev
    FROM lines GROUP BY 1""",
)
def stored_daily_moments(spark, folder):
    """Days of one column; a day's lines come in several arrivals."""
    profile, _ = _profile(spark, folder)
    return profile.moments(["day"]).where("column = 'l_quantity'").select(
        F.date_format("day", "yyyy-MM-dd").alias("day"), "count",
        F.round("mean", 6).alias("mean"), F.round("stddev", 6).alias("stddev"))


@query(
    "stored_correlations",
    f"WITH {_SOURCE} " + _union(
        f"""SELECT '{a}' AS column_a, '{b}' AS column_b, regr_count({a}, {b})::BIGINT AS n,
        round(corr({a}, {b}), 9) AS r FROM lines"""
        for i, a in enumerate(_MEASURES) for b in _MEASURES[i + 1:]),
)
def stored_correlations(spark, folder):
    profile, _ = _profile(spark, folder)
    return profile.correlations().withColumn("r", F.round("r", 9))


_PROBABILITIES = (0.25, 0.5, 0.75)


@query(
    "stored_quantiles",
    f"WITH {_SOURCE} " + _union(
        f"""SELECT 'l_extendedprice' AS "column", {p}::DOUBLE AS probability,
        count(l_extendedprice) AS n,
        round(50 * count(*) FILTER (l_extendedprice <= q)::DOUBLE / count(l_extendedprice)) / 50
          AS rank FROM lines, (SELECT quantile_disc(l_extendedprice, {p}) AS q FROM lines)"""
        for p in _PROBABILITIES),
)
def stored_quantiles(spark, folder):
    """Quantiles out of merged sketches, with the share of rows up to them to a fiftieth:
    several times what a sketch of this size may be off."""
    profile, _ = _profile(spark, folder)
    found = profile.quantiles(_PROBABILITIES).where("column = 'l_extendedprice'").collect()
    lines = load(spark, folder, "lineitem").where("l_partkey % 7 <> 0")
    below = [F.struct(
        F.lit(q["column"]).alias("column"), F.lit(q["probability"]).alias("probability"),
        F.lit(q["n"]).cast("bigint").alias("n"),
        (F.round(50 * F.count_if(F.col("l_extendedprice") <= q["value"]) / q["n"]) / 50)
        .alias("rank")) for q in found]
    return lines.agg(F.array(*below).alias("r")).select(F.inline("r"))


@query(
    "stored_distincts",
    _union(f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS distinct_values FROM lineitem"""
           for c in _NAMES),
)
def stored_distincts(spark, folder):
    """Distinct counts out of united sketches; one within three standard errors of the
    exact count is shown as that."""
    profile, _ = _profile(spark, folder)
    lines = load(spark, folder, "lineitem")
    exact = lines.agg(F.array(*[F.struct(
        F.lit(c).alias("name"), F.count_distinct(c).alias("exact")) for c in _NAMES]).alias("r"))
    both = profile.distincts().join(
        F.broadcast(exact.select(F.inline("r"))), F.col("column") == F.col("name"))
    near = F.abs(F.col("distinct_values") - F.col("exact")) <= (
        3 * distinct_error() * F.col("exact"))
    return both.select("column", F.when(near, F.col("exact")).otherwise(
        F.col("distinct_values")).alias("distinct_values"))


_PROFILED = [c for c in NUMERIC_COLUMNS if c in ("popularity", "energy", "tempo", "loudness")]


@query(
    "silver_profile",
    f"WITH silver AS (SELECT * FROM ({EVENT_TRACKS}) WHERE {SILVER_WHERE}) " + _union(
        f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 6) AS mean,
        round(stddev_samp({c}), 6) AS stddev, min({c})::DOUBLE AS min, max({c})::DOUBLE AS max
        FROM silver""" for c in _PROFILED),
)
def silver_profile(spark, folder):
    """The profile that a job keeps beside Silver, every message delivered twice."""
    layout = Layout(work_dir(spark, "layers"))
    run_stream(start_bronze(_messages(spark, folder), layout, _NOW))
    sent = 2 * load(spark, folder, "events").count()
    run_stream(start_silver_outcomes(
        spark, layout, _NOW, state_partitions=state_partitions(sent)))
    for _ in range(2):  # the second run finds nothing new
        run_stream(start_profile(spark, layout, _NOW))
    return read_profile(spark, layout).moments().where(F.col("column").isin(_PROFILED)).select(
        "column", "count", F.round("mean", 6).alias("mean"), F.round("stddev", 6).alias("stddev"),
        "min", "max")


@query(
    "replaced_table",
    """SELECT o_orderpriority, count(*) AS orders, round(sum(o_totalprice), 2) AS total,
      true AS failed_write_left_it FROM orders GROUP BY 1""",
)
def replaced_table(spark, folder):
    """A table that is replaced by itself and more, with a write between that fails."""
    orders, path = load(spark, folder, "orders"), work_dir(spark, "orders")
    parts = [orders.where(F.pmod("o_orderkey", F.lit(3)) == n) for n in range(3)]
    replace_table(parts[0], path)
    replace_table(read_replaced(spark, path).unionByName(parts[1]), path)
    before = read_replaced(spark, path).count()
    bad = read_replaced(spark, path).withColumn(
        "o_custkey", F.when(F.col("o_custkey") > 0, F.raise_error(F.lit("stop")).cast("bigint")))
    try:
        replace_table(bad, path)
        failed = False
    except Exception as error:  # the write is meant to fail in a task
        failed = "stop" in str(error)
    left = failed and read_replaced(spark, path).count() == before
    replace_table(read_replaced(spark, path).unionByName(parts[2]), path)
    return read_replaced(spark, path).groupBy("o_orderpriority").agg(
        F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total")
    ).withColumn("failed_write_left_it", F.lit(left))


# The index of a label is its place by frequency; the model sees returned and accepted
# lines only, so all other flags share the number after them. On one feature a ridge of
# 0.1 has the slope cov / var / (1 + 0.1 / deviation of the label).
_NOMINAL = """
WITH labels AS (
  SELECT l_returnflag, row_number() OVER (ORDER BY count(*) DESC, l_returnflag) - 1 AS place
  FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1),
indexed AS (
  SELECT l.*, coalesce(place, (SELECT count(*) FROM labels))::DOUBLE AS x
  FROM lineitem l LEFT JOIN labels USING (l_returnflag)),
s AS (
  SELECT regr_slope(l_quantity, x) / (1 + 0.1::DOUBLE / stddev_pop(l_quantity)) AS slope,
    avg(l_quantity) AS y, avg(x) AS mx FROM indexed WHERE l_returnflag <> 'N')
SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, round(y + slope * (x - mx), 4) AS prediction
FROM indexed, s
"""


@query("score_stream_nominal", _NOMINAL)
def score_stream_nominal(spark, folder):
    """A stream scored by a model with a nominal feature; labels that the model has not
    seen arrive on the way."""
    lines = load(spark, folder, "lineitem")
    seen, name = lines.where("l_returnflag <> 'N'"), "Linear_Regression"
    trained = train_models(
        seen, seen, "l_quantity", ["l_returnflag_index"], nominal="l_returnflag",
        estimators={name: models.regressors("l_quantity")[name]})
    stream = table_stream(spark, file_or_folder(folder, "lineitem"), lines.schema)
    target = work_dir(spark, "scored")
    scored = models.score(trained.scorer(name), stream).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag",
        F.round("prediction", 4).alias("prediction"))
    run_stream(append_stream(scored, target, f"{target}-checkpoint", _NOW))
    return table(spark, target)
