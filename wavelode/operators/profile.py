"""Column profiles. Each operator reads the table once."""

from functools import reduce
from operator import or_

from pyspark.sql import functions as F

from wavelode.functions.casts import nan_to_null
from wavelode.operators.distribution import exact_quantiles

# Generated code for an aggregate is given up beyond about 100 buffer fields,
# so wide profiles are computed in groups of columns.
_COLUMNS_PER_PASS = 11


def _long(df, rows):
    """One aggregate row holding an array of structs, unfolded to rows."""
    return df.agg(F.array(*rows).alias("r")).select(F.inline("r"))


def _in_passes(df, columns, row, per_pass=_COLUMNS_PER_PASS):
    parts = [
        _long(df, [row(i, c) for i, c in list(enumerate(columns))[start:start + per_pass]])
        for start in range(0, len(columns), per_pass)
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def describe_numeric(df, columns):
    """Count, mean, sample deviation, least and greatest value per column."""

    def row(i, c):
        x = F.col(c).cast("double")
        return F.struct(
            F.lit(i).alias("column_no"),
            F.lit(c).alias("column"),
            F.count(x).alias("count"),
            F.avg(x).alias("mean"),
            F.stddev_samp(x).alias("stddev"),
            F.min(x).alias("min"),
            F.max(x).alias("max"),
        )

    return _in_passes(df, columns, row)


def shape_stats(df, columns):
    """Skewness and excess kurtosis, as population moments."""

    def row(i, c):
        x = F.col(c).cast("double")
        return F.struct(
            F.lit(i).alias("column_no"),
            F.lit(c).alias("column"),
            F.skewness(x).alias("skewness"),
            F.kurtosis(x).alias("kurtosis"),
        )

    return _in_passes(df, columns, row)


def medians(df, columns):
    """Lower median per column: a value of the column, NaN counted as missing.

    Exact, unlike a percentile sketch, and cheaper on very many partitions,
    each of which would send its sketch to one task.
    """
    values = exact_quantiles(df, columns, [0.5], interpolate=False)
    return values.select("column", F.col("value").alias("median"))


def numeric_profile(df, columns):
    """describe_numeric, medians and shape_stats side by side."""
    return (
        describe_numeric(df, columns)
        .join(F.broadcast(medians(df, columns)), "column")
        .join(shape_stats(df, columns).drop("column_no"), "column")
        .orderBy("column_no")
    )


def _values(df, columns):
    """Rows (place, value) of all columns, with one value field for each type among them."""
    types = [kind for _, kind in df.select(*columns).dtypes]
    kinds = list(dict.fromkeys(types))
    entries = [
        F.struct(F.lit(i).alias("place"), *[
            (F.col(c) if types[i] == kind else F.lit(None).cast(kind)).alias(f"value_{k}")
            for k, kind in enumerate(kinds)
        ])
        for i, c in enumerate(columns)
    ]
    fields = [F.col(f"value_{k}").isNotNull() for k in range(len(kinds))]
    return df.select(F.inline(F.array(*entries))).filter(reduce(or_, fields))


def distinct_counts(df, columns, approx=False):
    """Distinct non-null values per column; ``approx`` uses a sketch.

    Exact counts group by a column's place and value, so a key is as wide as one value
    and not as all columns together.
    """
    if approx:
        return _long(df, [
            F.struct(F.lit(c).alias("column"), F.approx_count_distinct(c).alias("distinct_values"))
            for c in columns
        ])
    return _long(_values(df, columns).distinct(), [
        F.struct(F.lit(c).alias("column"),
                 F.count_if(F.col("place") == i).alias("distinct_values"))
        for i, c in enumerate(columns)
    ])


def null_profile(df, columns=None, digits=2):
    """Missing values per column, NaN included, most affected first."""
    types = dict(df.dtypes)

    def missing(c):
        test = F.col(f"`{c}`").isNull()
        if types[c] in ("double", "float"):
            test = test | F.isnan(f"`{c}`")
        return F.count_if(test)

    columns = columns or df.columns
    total = F.count("*")
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            missing(c).alias("null_count"),
            F.coalesce(
                F.round(F.try_divide(100.0 * missing(c), total), digits), F.lit(0.0)
            ).alias("null_pct"),
        )
        for c in columns
    ]
    return _long(df, rows).orderBy(F.desc("null_pct"), F.desc("null_count"), "column")


def schema_profile(df):
    """Position, name and type of every column, with the number of rows."""
    rows = [
        F.struct(
            F.lit(i).alias("position"), F.lit(name).alias("column"),
            F.lit(kind).alias("type"), F.count("*").alias("rows"),
        )
        for i, (name, kind) in enumerate(df.dtypes)
    ]
    return _long(df, rows)


def mean_and_median(df, columns, quantiles=None):
    """Mean and exact median per column, NaN counted as missing.

    ``quantiles`` are rows of ``exact_quantiles`` that are there already.
    """
    if quantiles is None:
        quantiles = exact_quantiles(df, columns, [0.5])
    markers = quantiles.filter("probability = 0.5").select(
        "column", F.col("value").alias("median")
    )

    def row(i, c):
        return F.struct(F.lit(c).alias("column"), F.avg(nan_to_null(c)).alias("mean"))

    return _in_passes(df, columns, row).join(F.broadcast(markers), "column")
