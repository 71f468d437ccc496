"""Column profiles, distributions, correlations and samples."""

from itertools import combinations

from pyspark.sql import functions as F

from wavelode.operators.aggregates import top_k
from wavelode.operators.correlation import corr_matrix, corr_with
from wavelode.operators.distribution import box_stats, exact_quantiles, histogram
from wavelode.operators.profile import (
    describe_numeric, distinct_counts, mean_and_median, medians, null_profile,
    numeric_profile, schema_profile, shape_stats,
)
from wavelode.operators.sampling import sample_n
from wavelode.plans.queries.registry import load, query
from wavelode.plans.queries.testbed import (
    LINE_TRACKS, SILVER_CTE, line_silver, line_tracks, stored,
)
from wavelode.plans.report import scatter
from wavelode.schemas import CATEGORICAL_COLUMNS, NUMERIC_COLUMNS
from wavelode.session import SMALL_TASKS

_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _union(parts):
    return " UNION ALL ".join(parts)


def _rounded(df, columns, digits):
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _describe_sql(columns, source):
    return _union(
        f"SELECT CAST({i} AS INT) AS column_no, '{c}' AS \"column\", count({c}) AS count, "
        f"round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS stddev, "
        f"CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM {source}"
        for i, c in enumerate(columns)
    )


def _shape_sql(columns, source):
    return _union(
        f"SELECT CAST({i} AS INT) AS column_no, '{c}' AS \"column\", "
        f"round(avg(power({c} - mu, 3)) / power(any_value(sd), 3), 6) AS skewness, "
        f"round(avg(power({c} - mu, 4)) / power(any_value(sd), 4) - 3, 6) AS kurtosis "
        f"FROM {source}, (SELECT avg({c}) AS mu, stddev_pop({c}) AS sd FROM {source})"
        for i, c in enumerate(columns)
    )


@query("describe_numeric", _describe_sql(_MEASURES, "lineitem"))
def describe_lineitem(spark, folder):
    rows = describe_numeric(load(spark, folder, "lineitem"), _MEASURES)
    return _rounded(rows, ["mean", "stddev"], 4)


@query(
    "describe_tracks",
    f"WITH {SILVER_CTE} {_describe_sql(NUMERIC_COLUMNS, 'silver')}",
)
def describe_tracks(spark, folder):
    rows = describe_numeric(line_silver(spark, folder), NUMERIC_COLUMNS)
    return _rounded(rows, ["mean", "stddev"], 4)


@query("shape_stats", _shape_sql(_MEASURES, "lineitem"))
def lineitem_shape(spark, folder):
    rows = shape_stats(load(spark, folder, "lineitem"), _MEASURES)
    return _rounded(rows, ["skewness", "kurtosis"], 6)


@query(
    "medians",
    _union(
        f"""SELECT '{c}' AS "column", quantile_disc({c}, 0.5) AS median FROM lineitem"""
        for c in _MEASURES
    ),
)
def lineitem_medians(spark, folder):
    return medians(load(spark, folder, "lineitem"), _MEASURES)


@query(
    "numeric_profile",
    f"""WITH d AS ({_describe_sql(["l_quantity", "l_tax"], "lineitem")}),
      s AS ({_shape_sql(["l_quantity", "l_tax"], "lineitem")}),
      m AS (SELECT 'l_quantity' AS "column", quantile_disc(l_quantity, 0.5) AS median FROM lineitem
        UNION ALL SELECT 'l_tax', quantile_disc(l_tax, 0.5) FROM lineitem)
    SELECT d.*, m.median, s.skewness, s.kurtosis
    FROM d JOIN m USING ("column") JOIN s USING ("column")""",
)
def lineitem_profile(spark, folder):
    rows = numeric_profile(load(spark, folder, "lineitem"), ["l_quantity", "l_tax"])
    rows = _rounded(rows, ["mean", "stddev"], 4)
    return _rounded(rows, ["skewness", "kurtosis"], 6)


@query(
    "mean_and_median",
    _union(
        f"""SELECT '{c}' AS "column", round(avg({c}), 4) AS mean,
        round(quantile_cont({c}, 0.5), 4) AS median FROM lineitem""" for c in _MEASURES
    ),
)
def lineitem_markers(spark, folder):
    rows = mean_and_median(load(spark, folder, "lineitem"), _MEASURES)
    return _rounded(rows, ["mean", "median"], 4)


_NAMES = [*CATEGORICAL_COLUMNS, "user_id", "track_id"]


@query(
    "distinct_counts",
    f"WITH t AS ({LINE_TRACKS}) " + _union(
        f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS distinct_values FROM t"
        for c in _NAMES
    ),
)
def track_names(spark, folder):
    # Stored, as the size of tasks is set while it runs.
    counts = distinct_counts(line_tracks(load(spark, folder, "lineitem")), _NAMES)
    return stored(counts, "distinct", SMALL_TASKS)


_NULLABLE = ["artists", "track_genre", "explicit", "energy", "track_id"]


@query(
    "null_profile",
    f"WITH t AS ({LINE_TRACKS}) " + _union(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS null_count, "
        f"round(100.0::DOUBLE * count(*) FILTER (WHERE {c} IS NULL) / count(*), 2) AS null_pct "
        "FROM t" for c in _NULLABLE
    ),
)
def track_nulls(spark, folder):
    return null_profile(line_tracks(load(spark, folder, "lineitem")), _NULLABLE)


@query(
    "schema_profile",
    """SELECT t.*, (SELECT count(*) FROM events) AS rows FROM (VALUES
      (CAST(0 AS INT), 'event_id', 'bigint'), (1, 'ts', 'timestamp_ntz'),
      (2, 'user_id', 'bigint'), (3, 'event_type', 'string'), (4, 'value', 'double'),
      (5, 'props', 'string')) t(position, "column", type)""",
)
def events_schema(spark, folder):
    return schema_profile(load(spark, folder, "events"))


def _pairs_sql(pairs, source):
    return _union(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) AS r "
        f"FROM {source}" for a, b in pairs
    )


@query(
    "corr_matrix",
    _pairs_sql([(a, b) for a in _MEASURES for b in _MEASURES], "lineitem"),
)
def lineitem_correlations(spark, folder):
    return _rounded(corr_matrix(load(spark, folder, "lineitem"), _MEASURES), ["r"], 6)


# Columns with gaps in different rows.
_GAPS = {
    "price": "CASE WHEN l_linenumber % 5 = 0 THEN NULL ELSE l_extendedprice END",
    "quantity": "CASE WHEN l_linenumber % 7 = 3 THEN NULL ELSE l_quantity END",
    "discount": "CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE l_discount END",
    "tax": "l_tax",
}
_GAPS_SQL = ", ".join(f"{text} AS {name}" for name, text in _GAPS.items())


@query(
    "corr_gaps",
    f"WITH gaps AS (SELECT {_GAPS_SQL} FROM lineitem) "
    + _pairs_sql([(a, b) for a in _GAPS for b in _GAPS], "gaps"),
)
def gap_correlations(spark, folder):
    rows = load(spark, folder, "lineitem").selectExpr(
        *[f"{text} AS {name}" for name, text in _GAPS.items()])
    return _rounded(corr_matrix(rows, list(_GAPS)), ["r"], 6)


@query(
    "corr_tracks",
    f"WITH {SILVER_CTE} " + _pairs_sql(
        [p for a, b in combinations(NUMERIC_COLUMNS, 2) for p in ((a, b), (b, a))]
        + [(c, c) for c in NUMERIC_COLUMNS],
        "silver",
    ),
)
def track_correlations(spark, folder):
    rows = stored(line_silver(spark, folder).select(*NUMERIC_COLUMNS), "measures")
    return _rounded(corr_matrix(rows, NUMERIC_COLUMNS), ["r"], 6)


@query(
    "corr_with_target",
    f"WITH {SILVER_CTE} " + _union(
        f"SELECT '{c}' AS \"column\", round(corr({c}, popularity), 6) AS r FROM silver"
        for c in NUMERIC_COLUMNS if c != "popularity"
    ),
)
def target_correlations(spark, folder):
    rows = stored(line_silver(spark, folder).select(*NUMERIC_COLUMNS), "measures")
    return _rounded(corr_with(rows, "popularity", NUMERIC_COLUMNS), ["r"], 6)


def histogram_sql(column, bins, source, name=None):
    return f"""
    SELECT '{name or column}' AS "column", CAST(b AS INT) AS bin, round(b * step + lo, 6) AS lo,
      round(CASE WHEN b = {bins} - 1 THEN hi ELSE (b + 1) * step + lo END, 6) AS hi,
      count(x) AS count
    FROM (SELECT min({column})::DOUBLE AS lo, max({column})::DOUBLE AS hi,
        (max({column}) - min({column}))::DOUBLE / {bins} AS step FROM {source}) r
      CROSS JOIN range({bins}) g(b)
      LEFT JOIN (SELECT {column}::DOUBLE AS x FROM {source}) t
        ON x >= b * step + lo AND (x < (b + 1) * step + lo OR b = {bins} - 1)
    GROUP BY ALL"""


@query("histogram", histogram_sql("value", 50, "events"))
def value_histogram(spark, folder):
    return _rounded(histogram(load(spark, folder, "events"), "value", 50), ["lo", "hi"], 6)


@query(
    "histograms",
    _union(histogram_sql(c, 50, "lineitem") for c in _MEASURES),
)
def measure_histograms(spark, folder):
    rows = histogram(load(spark, folder, "lineitem"), _MEASURES, 50)
    return _rounded(rows, ["lo", "hi"], 6)


@query(
    "boxplot",
    """WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
        quantile_cont(value, 0.75) AS q3 FROM events),
      f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
    SELECT 'value' AS "column", count(value) AS count, round(any_value(q1), 6) AS q1,
      round(any_value(median), 6) AS median, round(any_value(q3), 6) AS q3,
      round(least(min(value) FILTER (WHERE value >= lo), any_value(q1)), 6) AS whisker_low,
      round(greatest(max(value) FILTER (WHERE value <= hi), any_value(q3)), 6) AS whisker_high,
      count(*) FILTER (WHERE value < lo OR value > hi) AS outliers
    FROM events, f""",
)
def value_box(spark, folder):
    columns = ["q1", "median", "q3", "whisker_low", "whisker_high"]
    return _rounded(box_stats(load(spark, folder, "events"), "value"), columns, 6)


@query(
    "exact_quantiles",
    _union(
        f"""SELECT '{c}' AS "column", CAST({p} AS DOUBLE) AS probability,
        round(quantile_cont({c}, {p}), 4) AS value FROM lineitem"""
        for c in _MEASURES for p in (0.25, 0.5, 0.75, 0.99)
    ),
)
def lineitem_quantiles(spark, folder):
    rows = exact_quantiles(
        load(spark, folder, "lineitem"), _MEASURES, [0.25, 0.5, 0.75, 0.99],
        inline_rows=1000,
    )
    return _rounded(rows, ["value"], 4)


def _md5_order(key, seed):
    return f"CAST('0x' || substr(md5('{seed}:' || CAST({key} AS VARCHAR)), 1, 8) AS BIGINT), {key}"


@query(
    "scatter_sample",
    f"""SELECT event_id, value, user_id FROM events
    ORDER BY {_md5_order('event_id', 42)} LIMIT 5000""",
)
def scatter_sample(spark, folder):
    rows = load(spark, folder, "events").select("event_id", "value", "user_id").dropna()
    return sample_n(rows, "event_id", 5000, method="md5")


@query(
    "exact_sample",
    f"SELECT event_id, ts::VARCHAR AS ts FROM events ORDER BY {_md5_order('event_id', 42)} LIMIT 50",
)
def exact_sample(spark, folder):
    # Fifty of many thousand rows, so the hash bound is used.
    rows = load(spark, folder, "events").select("event_id", "ts")
    return sample_n(rows, "event_id", 50, method="md5").select(
        "event_id", F.col("ts").cast("string").alias("ts")
    )


@query(
    "scatter_tracks",
    f"""WITH {SILVER_CTE} SELECT energy, danceability, popularity FROM silver
    ORDER BY CAST('0x' || substr(md5('42:' || track_id || ':' || event_time), 1, 8) AS BIGINT),
      track_id, event_time LIMIT 5000""",
)
def scatter_tracks(spark, folder):
    keys, points = ["track_id", "event_time"], ["energy", "danceability", "popularity"]
    rows = stored(line_silver(spark, folder).select(*keys, *points), "points")
    return scatter(rows, points, keys, method="md5")


@query("preview", "SELECT * FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 5")
def preview(spark, folder):
    return top_k(load(spark, folder, "customer"), [F.desc("c_acctbal"), "c_custkey"], 5)
