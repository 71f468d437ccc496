"""Quality rules, missing values and duplicates.

A rule set maps a name to a boolean column or SQL text; a row passes a rule when
the expression is true, so null counts as a failure.
"""

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from wavelode.functions.hashing import hash_bucket


def not_null(c):
    return f"`{c}` IS NOT NULL"


def within(c, low, high):
    return f"`{c}` BETWEEN {low} AND {high}"


def positive(c):
    return f"`{c}` > 0"


# What a valid event must satisfy.
SILVER_RULES = {
    "event_timestamp_present": not_null("event_timestamp"),
    "track_id_present": not_null("track_id"),
    "track_name_present": not_null("track_name"),
    "artists_present": not_null("artists"),
    "popularity_present": not_null("popularity"),
    "popularity_range": within("popularity", 0, 100),
    "duration_positive": positive("duration_ms"),
    "danceability_range": within("danceability", 0, 1),
    "energy_range": within("energy", 0, 1),
    "valence_range": within("valence", 0, 1),
    "tempo_positive": positive("tempo"),
}
GOLD_RULES = {
    "genre_present": not_null("track_genre"),
    "popularity_present": not_null("popularity"),
    "energy_present": not_null("energy"),
    "danceability_present": not_null("danceability"),
}


def _tests(rules):
    return {
        rule: F.expr(test) if isinstance(test, str) else test
        for rule, test in rules.items()
    }


def _failed(test):
    return ~F.coalesce(test, F.lit(False))


def passing(df, rules):
    """Rows that satisfy every rule, as one predicate the scan can push down."""
    return df.filter(reduce(lambda a, b: a & b, _tests(rules).values()))


def with_failures(df, rules, name="failed_rules"):
    """Add the names of the rules each row breaks, in rule order."""
    marks = [
        F.when(_failed(test), F.lit(rule)) for rule, test in _tests(rules).items()
    ]
    return df.withColumn(name, F.array_compact(F.array(*marks)))


def apply_rules(df, rules):
    """Split into passing rows and rejected rows with their failed rules."""
    rejects = with_failures(df, rules).filter(F.size("failed_rules") > 0)
    return passing(df, rules), rejects


def rule_counts(df, rules):
    """Rejected rows per rule, in one pass; a row counts under each rule it breaks."""
    rows = [
        F.struct(
            F.lit(i).alias("rule_no"),
            F.lit(rule).alias("rule"),
            F.count_if(_failed(test)).alias("rejected"),
        )
        for i, (rule, test) in enumerate(_tests(rules).items())
    ]
    return df.agg(F.array(*rows).alias("r")).select(F.inline("r"))


def drop_missing(df, columns):
    """The columns, without rows that hold a null or NaN in any of them."""
    return df.select(*columns).dropna()


def first_per_key(df, keys, order):
    """One row per key, the first in ``order``.

    Spark keeps only the leading row of each key within a map task before it
    shuffles, so a key with very many copies does not gather in one task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("__rank", F.row_number().over(window))
        .filter(F.col("__rank") == 1)
        .drop("__rank")
    )


def dedupe(df, keys, order=None, watermark=None, spread=None):
    """One row per key.

    Batch: the survivor is the first row in ``order``, otherwise any. Whole rows
    go through the same plan either way, as it moves them faster than an
    aggregate would.

    Stream: ``watermark`` is a (timestamp column, delay) pair which bounds the
    state. Rows that come later than the delay are dropped, the first of their key
    too; the query's progress counts them (``rows_dropped``). ``spread`` is a
    (columns, parts) pair: copies of a key are first reduced in ``parts``
    places, chosen by the hash of columns that differ between copies, so one
    heavy key does not load one task. It keeps a second entry per key.
    """
    if not df.isStreaming:
        if set(df.columns) == set(keys):
            return df.dropDuplicates(keys)
        return first_per_key(df, keys, order or keys[:1])
    if watermark is not None:
        df = df.withWatermark(*watermark)

    def distinct(rows, by):
        if watermark is not None:
            return rows.dropDuplicatesWithinWatermark(by)
        return rows.dropDuplicates(by)

    if spread is not None:
        columns, parts = spread
        marked = df.withColumn("__part", hash_bucket(columns, parts))
        df = distinct(marked, [*keys, "__part"]).drop("__part")
    return distinct(df, keys)


def latest_per_key(df, keys, order):
    """One row per key, the last by the order columns, nulls counting as oldest."""
    return first_per_key(df, keys, [F.col(c).desc_nulls_last() for c in order])
