"""Profiles of a growing table: small states of its parts, merged to those of the whole.

A state is made from new rows alone. Moments and co-moments merge exactly, up to rounding;
sketches merge within their error bounds. ``group`` are columns, such as the day, that
states are kept apart by; merging over fewer of them gives coarser profiles.
"""

from itertools import combinations

from pyspark.sql import functions as F

from wavelode.functions.casts import nan_to_null

# Generated code for an aggregate is given up beyond about 100 buffer fields.
_COLUMNS_PER_PASS = 11
_PAIRS_PER_PASS = 8

# Sizes of the sketches.
KLL_K = 1024
HLL_LG_K = 14

# A variance this small against the mean square is rounding, not spread.
_CONSTANT = 1e-12


def rank_error(k=KLL_K):
    """How far the rank of a quantile from a sketch may be off, as a share of the rows,
    in 99 of 100 cases."""
    return 2.296 / k ** 0.9723


def distinct_error(lg_k=HLL_LG_K):
    """Standard error of a distinct count from a sketch, as a share of the count."""
    return 1.04 / 2 ** (lg_k / 2)


def _states(df, rows, group, per_pass):
    """States as rows, in as many passes as keep the generated code small; None for none."""
    result = None
    for start in range(0, len(rows), per_pass):
        part = df.groupBy(*group).agg(F.array(*rows[start:start + per_pass]).alias("__r"))
        part = part.select(*group, F.inline("__r"))
        result = part if result is None else result.unionByName(part)
    return result


def moment_states(df, columns, group=()):
    """Rows, values, mean, sums of the 2nd to 4th powers around it, least and greatest per
    column. NaN counts as missing."""

    def row(c):
        x = nan_to_null(c)
        n, m2 = F.count(x), F.coalesce(F.var_pop(x), F.lit(0.0)) * F.count(x)
        spread = m2 > 0
        return F.struct(
            F.lit(c).alias("column"), F.count("*").alias("rows"), n.alias("n"),
            F.avg(x).alias("mean"), m2.alias("m2"),
            F.when(spread, F.skewness(x) * F.pow(m2, F.lit(1.5)) / F.sqrt(n))
            .otherwise(0.0).alias("m3"),
            F.when(spread, (F.kurtosis(x) + 3) * m2 * m2 / n).otherwise(0.0).alias("m4"),
            F.min(x).alias("min"), F.max(x).alias("max"),
        )

    return _states(df, [row(c) for c in columns], group, _COLUMNS_PER_PASS)


def _with_shift(states, keys, means):
    """States with each mean's distance from the mean of all states of the key."""
    total = states.groupBy(*keys).agg(*[
        F.try_divide(F.sum(F.col("n") * F.coalesce(m, F.lit(0.0))), F.sum("n")).alias(f"__{m}")
        for m in means])
    whole = total.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
                         *[f"__{m}" for m in means])
    same = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
    joined = states.join(whole, same)
    return joined.withColumns(
        {f"d_{m}": F.coalesce(F.col(m) - F.col(f"__{m}"), F.lit(0.0)) for m in means})


def merge_moments(states, group=()):
    """Moment states of the groups out of those of their parts."""
    keys = [*group, "column"]
    d, n = F.col("d_mean"), F.col("n")
    return _with_shift(states, keys, ["mean"]).groupBy(*keys).agg(
        F.sum("rows").alias("rows"), F.sum("n").alias("n"), F.max("__mean").alias("mean"),
        F.sum(F.col("m2") + n * d * d).alias("m2"),
        F.sum(F.col("m3") + 3 * d * F.col("m2") + n * d * d * d).alias("m3"),
        F.sum(F.col("m4") + 4 * d * F.col("m3") + 6 * d * d * F.col("m2")
              + n * d * d * d * d).alias("m4"),
        F.min("min").alias("min"), F.max("max").alias("max"),
    )


def moment_profile(states, group=()):
    """Missing and present values, mean, sample deviation, least, greatest, skewness and
    excess kurtosis per group and column."""
    n, m2 = F.col("n"), F.col("m2")
    spread = m2 > _CONSTANT * (m2 + n * F.col("mean") * F.col("mean"))
    return merge_moments(states, group).select(
        *group, "column", (F.col("rows") - n).alias("missing"), n.alias("count"), "mean",
        F.when(n > 1, F.sqrt(m2 / (n - 1))).alias("stddev"), "min", "max",
        F.when(spread, F.sqrt(n) * F.col("m3") / F.pow(m2, F.lit(1.5))).alias("skewness"),
        F.when(spread, n * F.col("m4") / (m2 * m2) - 3).alias("kurtosis"),
    )


def comoment_states(df, columns, group=()):
    """Rows with both, means and sums of squares and products around them, for each pair
    of columns."""

    def row(a, b):
        y, x = nan_to_null(a), nan_to_null(b)
        return F.struct(
            F.lit(a).alias("column_a"), F.lit(b).alias("column_b"),
            F.regr_count(y, x).alias("n"), F.regr_avgy(y, x).alias("mean_a"),
            F.regr_avgx(y, x).alias("mean_b"), F.regr_syy(y, x).alias("m2_a"),
            F.regr_sxx(y, x).alias("m2_b"), F.regr_sxy(y, x).alias("c"),
        )

    return _states(df, [row(*pair) for pair in combinations(columns, 2)], group, _PAIRS_PER_PASS)


def correlation_profile(states, group=()):
    """Pearson correlation per group and pair; null where a side is constant."""
    keys = [*group, "column_a", "column_b"]
    a, b, n = F.col("d_mean_a"), F.col("d_mean_b"), F.col("n")
    sums = _with_shift(states, keys, ["mean_a", "mean_b"]).groupBy(*keys).agg(
        F.sum("n").alias("n"), F.max("__mean_a").alias("mean_a"),
        F.max("__mean_b").alias("mean_b"),
        F.sum(F.coalesce("m2_a", F.lit(0.0)) + n * a * a).alias("m2_a"),
        F.sum(F.coalesce("m2_b", F.lit(0.0)) + n * b * b).alias("m2_b"),
        F.sum(F.coalesce("c", F.lit(0.0)) + n * a * b).alias("c"),
    )

    def spread(side):
        m2, mean = F.col(f"m2_{side}"), F.col(f"mean_{side}")
        return m2 > _CONSTANT * (m2 + F.col("n") * mean * mean)

    r = F.col("c") / F.sqrt(F.col("m2_a") * F.col("m2_b"))
    return sums.select(*keys, "n", F.when(
        spread("a") & spread("b"), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r))).alias("r"))


def quantile_states(df, columns, group=(), k=KLL_K):
    """A sketch of the values per column, from which any quantile can be read."""
    rows = [F.struct(
        F.lit(c).alias("column"), F.count(nan_to_null(c)).alias("n"),
        F.kll_sketch_agg_double(nan_to_null(c), F.lit(k)).alias("sketch")) for c in columns]
    return _states(df, rows, group, _COLUMNS_PER_PASS)


def quantile_profile(states, probabilities=(0.5,), group=()):
    """Approximate quantiles per group and column, each within ``rank_error`` of its rank."""
    merged = states.where("n > 0").groupBy(*group, "column").agg(
        F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))
    rows = F.array(*[F.struct(
        F.lit(float(p)).alias("probability"),
        F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias("value"))
        for p in probabilities])
    return merged.select(*group, "column", "n", F.inline(rows))


def distinct_states(df, columns, group=(), lg_k=HLL_LG_K):
    """A sketch of the different values per column, null left out."""
    rows = [F.struct(
        F.lit(c).alias("column"),
        F.hll_sketch_agg(F.col(c).cast("string"), F.lit(lg_k)).alias("sketch")) for c in columns]
    return _states(df, rows, group, _COLUMNS_PER_PASS)


def distinct_profile(states, group=()):
    """Approximate numbers of different values; parts are united, not added."""
    return states.groupBy(*group, "column").agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_values"))
