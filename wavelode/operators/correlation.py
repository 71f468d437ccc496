"""Pearson correlation over the rows where both columns are present."""

import math
from itertools import combinations

from pyspark.sql import functions as F

from wavelode.functions.casts import nan_to_null

# A variance this small against the mean square is rounding, not spread.
_CONSTANT = 1e-12


def _pearson(n, a, b, aa, bb, ab):
    """Correlation from power sums; None when either side is constant."""
    if not n or n < 2:
        return None
    var_a, var_b = aa / n - (a / n) ** 2, bb / n - (b / n) ** 2
    if var_a <= _CONSTANT * aa / n or var_b <= _CONSTANT * bb / n:
        return None
    return max(-1.0, min(1.0, (ab / n - a / n * b / n) / math.sqrt(var_a * var_b)))


def _correlations(df, pairs):
    """{pair: r}, from sums around the column means.

    A sum is named by its factors and by the columns that must be present. A
    column without gaps needs no such mark, so pairs of complete columns share
    all their sums but one. Two scans, with or without gaps.
    """
    columns = list(dict.fromkeys(c for pair in pairs for c in pair))
    first = df.agg(
        F.count("*").alias("rows"),
        *[F.count(nan_to_null(c)).alias(f"n{i}") for i, c in enumerate(columns)],
        *[F.avg(nan_to_null(c)).alias(f"mean{i}") for i, c in enumerate(columns)],
        *[F.min(nan_to_null(c)).alias(f"lo{i}") for i, c in enumerate(columns)],
        *[F.max(nan_to_null(c)).alias(f"hi{i}") for i, c in enumerate(columns)],
    ).first()
    complete, centre = {}, {}
    for i, c in enumerate(columns):
        complete[c] = first[f"n{i}"] == first["rows"]
        # The mean of a constant can miss it by a rounding error.
        constant = first[f"lo{i}"] == first[f"hi{i}"]
        centre[c] = first[f"lo{i}"] if constant else first[f"mean{i}"]

    def sums(pair):
        a, b = sorted(pair)
        present = tuple(sorted(c for c in {a, b} if not complete[c]))
        return [(f, present) for f in ((), (a,), (b,), (a, a), (b, b), (a, b))]

    shifted = {c: F.col(f"x{i}") for i, c in enumerate(columns)}

    def total(factors, present):
        product = F.lit(1.0)
        for c in factors:
            product = product * shifted[c]
        for c in present:
            product = F.when(shifted[c].isNotNull(), product)
        return F.sum(product)

    names = {key: f"s{i}" for i, key in enumerate(sorted({k for p in pairs for k in sums(p)}))}
    row = df.select(*[
        (nan_to_null(c) - F.lit(centre[c])).alias(f"x{i}") for i, c in enumerate(columns)
    ]).agg(*[total(*key).alias(name) for key, name in names.items()]).first()
    return {pair: _pearson(*[row[names[key]] for key in sums(pair)]) for pair in pairs}


def corr_matrix(df, columns):
    """All ordered pairs, diagonal included, as (column_a, column_b, r)."""
    pairs = [*combinations(columns, 2), *[(c, c) for c in columns]]
    found = _correlations(df, pairs)
    rows = [
        (a, b, found[a, b] if (a, b) in found else found[b, a])
        for a in columns for b in columns
    ]
    return df.sparkSession.createDataFrame(
        rows, "column_a STRING, column_b STRING, r DOUBLE"
    )


def strongest_with(matrix, target):
    """A matrix's correlations of the other columns with the target, strongest first."""
    return matrix.filter((F.col("column_b") == target) & (F.col("column_a") != target)).select(
        F.col("column_a").alias("column"), "r"
    ).orderBy(F.abs("r").desc_nulls_last(), "column")


def corr_with(df, target, columns):
    """Correlation of each column with the target, strongest first."""
    others = [c for c in columns if c != target]
    found = _correlations(df, [(c, target) for c in others])
    rows = [(c, target, found[c, target]) for c in others]
    return strongest_with(df.sparkSession.createDataFrame(
        rows, "column_a STRING, column_b STRING, r DOUBLE"), target)
