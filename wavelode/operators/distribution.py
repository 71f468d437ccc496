"""Histograms, exact quantiles and box-plot statistics without moving columns."""

import math

from pyspark.sql import functions as F

from wavelode.functions.casts import nan_to_null
from wavelode.session import work_dir


def value_range(df, columns):
    """{column: (count, least, greatest)} of the values present, in one pass."""
    aggregates = []
    for i, c in enumerate(columns):
        x = nan_to_null(c)
        aggregates += [
            F.count(x).alias(f"n{i}"), F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}"),
        ]
    row = df.agg(*aggregates).first()
    return {
        c: (row[f"n{i}"], row[f"lo{i}"], row[f"hi{i}"]) for i, c in enumerate(columns)
    }


def _edges(low, high, bins):
    if low == high:
        low, high = low - 0.5, high + 0.5
    step = (high - low) / bins
    return low, high, step


def histogram(df, columns, bins):
    """Counts in equal-width bins over each column's range, empty bins kept.

    Two scans whatever the number of columns: one for the ranges, one that
    turns each value into its bin number and counts. Bins are closed on the
    left, the last one on both sides.
    """
    columns = [columns] if isinstance(columns, str) else list(columns)
    spark = df.sparkSession
    ranges = {c: r for c, r in value_range(df, columns).items() if r[0]}
    if not ranges:
        return spark.createDataFrame(
            [], "column STRING, bin INT, lo DOUBLE, hi DOUBLE, count BIGINT"
        )

    edges = [_edges(low, high, bins) for _, low, high in ranges.values()]
    low, high, step = (
        F.get(F.array(*[F.lit(e[k]) for e in edges]), F.col("c")) for k in range(3)
    )
    x, guess = F.col("x"), F.col("guess")
    # Division can land one bin off next to an edge; the edges decide.
    number = (
        F.when(x < guess * step + low, guess - 1)
        .when((guess < bins - 1) & (x >= (guess + 1) * step + low), guess + 1)
        .otherwise(guess)
    )
    counted = (
        df.select(F.posexplode(F.array(*[nan_to_null(c) for c in ranges])).alias("c", "x"))
        .filter(x.isNotNull())
        .select(
            "c", "x",
            F.least(
                F.floor((x - low) / (high - low) * F.lit(float(bins))), F.lit(bins - 1)
            ).alias("guess"),
        )
        .groupBy((F.col("c") * bins + number).alias("slot"))
        .agg(F.count("*").alias("count"))
    )
    slots = []
    for i, (c, (least, greatest, width)) in enumerate(zip(ranges, edges)):
        for b in range(bins):
            upper = greatest if b == bins - 1 else (b + 1) * width + least
            slots.append((i * bins + b, c, b, b * width + least, upper))
    frame = spark.createDataFrame(
        slots, "slot BIGINT, column STRING, bin INT, lo DOUBLE, hi DOUBLE"
    )
    return (
        frame.join(F.broadcast(counted), "slot", "left")
        .orderBy("slot")
        .select(
            "column", "bin", "lo", "hi",
            F.coalesce("count", F.lit(0).cast("bigint")).alias("count"),
        )
    )


class _Target:
    """An order statistic being searched for, and where it can still lie."""

    def __init__(self, column, rank, count):
        self.column, self.rank = column, rank
        self.wanted = column, rank
        self.low = self.high = None  # exclusive bounds
        self.below, self.inside = 0, count
        self.value = None

    def bounds(self):
        return self.column, self.low, self.high

    def offset(self):
        return self.rank - self.below

    def narrow(self, cut, less, equal):
        """Use the exact number of inside values below and equal to ``cut``."""
        if self.offset() < less:
            self.high, self.inside = cut, less
        elif self.offset() < less + equal:
            self.value = cut
        else:
            self.low = cut
            self.below += less + equal
            self.inside -= less + equal


def _inside(column, low, high):
    """The column's values between exclusive bounds, null elsewhere."""
    x = nan_to_null(column)
    if low is not None:
        x = F.when(x > F.lit(low), x)
    if high is not None:
        x = F.when(x < F.lit(high), x)
    return x


def _by_bounds(targets):
    groups = {}
    for t in targets:
        groups.setdefault(t.bounds(), []).append(t)
    return groups


# Rows drawn to choose where to cut, and how far a cut may be off for it.
_SAMPLE = 1_000_000
_MARGIN = 5 * math.sqrt(0.25 / _SAMPLE)


def _narrow_all(df, targets, round_no):
    """Bracket every target by two sampled values, then count its sides.

    The sample only decides where to cut; the counts are of all rows, so a poor
    cut costs another round and never a wrong value. Sampling keeps what map
    tasks send to the merging task small however many tasks there are.
    """
    groups = list(_by_bounds(targets).items())
    columns = sorted({t.column for t in targets})
    drawn = df.select(*columns, F.rand(round_no).alias("__draw"))
    sketches = []
    for i, (bounds, members) in enumerate(groups):
        inside = members[0].inside
        margin = _MARGIN if inside > _SAMPLE else 1e-4
        shares = [
            min(1.0, max(0.0, t.offset() / inside + side))
            for t in members for side in (-margin, margin)
        ]
        chosen = F.when(F.col("__draw") <= _SAMPLE / inside, _inside(*bounds))
        sketches.append(F.percentile_approx(chosen, shares, 10_000).alias(f"q{i}"))
    row = drawn.agg(*sketches).first()
    cuts = [sorted(set(row[f"q{i}"] or [])) for i in range(len(groups))]
    counts = [F.lit(0).alias("none")]
    for i, (bounds, _) in enumerate(groups):
        x = _inside(*bounds)
        for j, cut in enumerate(cuts[i]):
            counts += [
                F.count_if(x < F.lit(cut)).alias(f"less{i}_{j}"),
                F.count_if(x == F.lit(cut)).alias(f"equal{i}_{j}"),
            ]
    row = df.agg(*counts).first()
    for i, (_, members) in enumerate(groups):
        for t in members:
            start = t.below
            for j, cut in enumerate(cuts[i]):
                if t.value is None and (t.high is None or cut < t.high):
                    passed = t.below - start
                    t.narrow(cut, row[f"less{i}_{j}"] - passed, row[f"equal{i}_{j}"])


def _read_off(df, targets):
    """The values of targets with few candidates left."""
    groups = list(_by_bounds(targets).items())
    row = df.agg(*[
        F.array_sort(F.collect_list(_inside(*bounds))).alias(f"v{i}")
        for i, (bounds, _) in enumerate(groups)
    ]).select(*[
        F.array(*[F.get(f"v{i}", F.lit(t.offset())) for t in members]).alias(f"v{i}")
        for i, (_, members) in enumerate(groups)
    ]).first()
    for i, (_, members) in enumerate(groups):
        for t, value in zip(members, row[f"v{i}"]):
            t.value = value


def _survivors(df, targets):
    """Write the values that can still be a target, a column for each pair of bounds."""
    path = work_dir(df.sparkSession, "quantile-candidates")
    groups = list(_by_bounds(targets).items())
    columns = [_inside(*bounds).alias(f"g{i}") for i, (bounds, _) in enumerate(groups)]
    df.select(*columns).dropna("all").write.parquet(path)
    for i, (_, members) in enumerate(groups):
        for t in members:
            t.column = f"g{i}"
    return df.sparkSession.read.parquet(path)


def _order_statistics(df, wanted, counts, inline_rows):
    """Exact values at the wanted (column, rank) pairs.

    A round leaves a few thousandths of the rows as candidates, which are written;
    further rounds read these only. Once at most ``inline_rows`` are left over all
    targets they are read off, so no task ever holds more than that many values or a
    sketch. The whole input is scanned three times at most.
    """
    targets = [_Target(c, rank, counts[c]) for c, rank in wanted]
    round_no = 0
    while True:
        unsolved = [t for t in targets if t.value is None]
        share = inline_rows / max(1, len(_by_bounds(unsolved)))
        large = [t for t in unsolved if t.inside > share]
        if not large:
            break
        if round_no == 1:
            df = _survivors(df, unsolved)
        _narrow_all(df, large, round_no)
        round_no += 1
    if unsolved:
        _read_off(df, unsolved)
    return {t.wanted: t.value for t in targets}


def _rank(probability, count, interpolate):
    """Fractional position of a quantile among ``count`` sorted values."""
    if interpolate:
        return probability * (count - 1)
    return max(math.ceil(probability * count) - 1, 0)


def exact_quantiles(df, columns, probabilities, interpolate=True, inline_rows=100_000):
    """Exact quantiles: (column, probability, value).

    With ``interpolate`` a quantile may lie between two values, otherwise it is
    the least value with at least that share of the rows at or below it.
    """
    columns = [columns] if isinstance(columns, str) else list(columns)
    counts = {c: n for c, (n, _, _) in value_range(df, columns).items()}
    positions = {
        (c, p): _rank(p, counts[c], interpolate)
        for c in columns for p in probabilities if counts[c]
    }
    wanted = sorted({
        (c, rank)
        for (c, _), position in positions.items()
        for rank in (math.floor(position), math.ceil(position))
    })
    found = _order_statistics(df, wanted, counts, inline_rows) if wanted else {}
    rows = []
    for c in columns:
        for p in probabilities:
            value = None
            if (c, p) in positions:
                position = positions[c, p]
                low = found[c, math.floor(position)]
                high = found[c, math.ceil(position)]
                value = low + (high - low) * (position - math.floor(position))
            rows.append((c, float(p), value))
    return df.sparkSession.createDataFrame(
        rows, "column STRING, probability DOUBLE, value DOUBLE"
    )


QUARTILES = [0.25, 0.5, 0.75]


def box_stats(df, column, k=1.5, quartiles=None):
    """Quartiles, whisker ends within k box lengths of the box, and outliers.

    ``quartiles`` are rows of ``exact_quantiles`` that are there already.
    """
    if quartiles is None:
        quartiles = exact_quantiles(df, column, QUARTILES)
    found = {
        row["probability"]: row["value"]
        for row in quartiles.filter(F.col("column") == column).collect()
    }
    q1, median, q3 = [found[p] for p in QUARTILES]
    if q1 is None:
        low = high = None
        span = (F.lit(None).cast("double"),) * 2
    else:
        low, high = q1 - k * (q3 - q1), q3 + k * (q3 - q1)
        span = (F.lit(low), F.lit(high))
    x = nan_to_null(column)
    quartile = [F.lit(v).cast("double") for v in (q1, median, q3)]
    # A whisker never ends inside the box. Values outside the span are the
    # outliers: none can lie between the span and the whisker end.
    return df.agg(
        F.lit(column).alias("column"),
        F.count(x).alias("count"),
        quartile[0].alias("q1"),
        quartile[1].alias("median"),
        quartile[2].alias("q3"),
        F.least(F.min(F.when(x >= span[0], x)), quartile[0]).alias("whisker_low"),
        F.greatest(F.max(F.when(x <= span[1], x)), quartile[2]).alias("whisker_high"),
        F.count_if((x < span[0]) | (x > span[1])).alias("outliers"),
    )
