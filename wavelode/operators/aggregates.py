"""Grouped summaries. All of them combine on the map side before shuffling."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from wavelode.operators.columns import with_event_timestamp


def summarize(df, keys, means, count_name="count"):
    """Row count and rounded means per group; ``means`` maps column to digits."""
    return df.groupBy(*keys).agg(
        F.count("*").alias(count_name),
        *[F.round(F.avg(c), digits).alias(f"avg_{c}") for c, digits in means.items()],
    )


def top_k(df, order, k):
    """Leading k rows; end ``order`` with a unique key to make ties definite."""
    return df.orderBy(*order).limit(k)


def value_counts(df, column, n=None, keep_null=False):
    """Rows per value, most frequent first, ties by value."""
    rows = df if keep_null else df.filter(F.col(column).isNotNull())
    counts = rows.groupBy(column).agg(F.count("*").alias("count"))
    order = [F.desc("count"), F.asc(column)]
    return counts.orderBy(*order) if n is None else top_k(counts, order, n)


def flag_share(df, flag, measure, digits=2):
    """Count, percent of all rows and mean of a measure per flag value."""
    counts = df.groupBy(flag).agg(
        F.count("*").alias("count"),
        F.round(F.avg(measure), digits).alias(f"avg_{measure}"),
    )
    # The window sees one row per flag value.
    total = F.sum("count").over(Window.partitionBy())
    return counts.withColumn(
        "share_pct", F.round(100.0 * F.col("count") / total, 1)
    ).orderBy(flag)


def daily_counts(df, ts=None):
    """Rows per calendar day."""
    rows = with_event_timestamp(df, "__ts", [ts]) if ts else with_event_timestamp(df, "__ts")
    return (
        rows.groupBy(F.date_format("__ts", "yyyy-MM-dd").alias("day"))
        .agg(F.count("*").alias("count"))
        .orderBy("day")
    )


def hourly_counts(df, ts=None):
    """Rows per hour of day."""
    rows = with_event_timestamp(df, "__ts", [ts]) if ts else with_event_timestamp(df, "__ts")
    return (
        rows.groupBy(F.hour("__ts").alias("hour"))
        .agg(F.count("*").alias("count"))
        .orderBy("hour")
    )


def label_table(spark, name, labels):
    """(label, position) rows for a fixed list of labels."""
    return spark.createDataFrame(
        list(enumerate(labels)), f"{name}_rank INT, {name} STRING"
    )


def label_rank(column, labels):
    """Position of a label in a list, null when it is not there."""
    rank = F.array_position(F.array(*[F.lit(x) for x in labels]), F.col(column))
    return F.when(rank > 0, (rank - 1).cast("int"))


def order_by_labels(df, column, labels):
    """Sort by a given label order instead of the alphabet."""
    return df.orderBy(label_rank(column, labels).asc_nulls_last(), column)


def segment_summary(df, column, buckets, name, means, count_name="count"):
    """Summary per bucket of a column, in bucket order, empty buckets absent."""
    grouped = summarize(
        df.withColumn(name, buckets.of(column)), [name], means, count_name
    )
    return order_by_labels(grouped, name, buckets.names)


def binned_summary(df, column, buckets, name, key, measure):
    """Count of non-null keys and mean of a measure per bucket, empty ones kept."""
    grouped = (
        df.groupBy(buckets.of(column).alias(name))
        .agg(
            F.count(key).alias("track_count"),
            F.avg(measure).alias(f"avg_{measure}"),
        )
    )
    labels = label_table(df.sparkSession, name, buckets.names)
    return (
        labels.join(F.broadcast(grouped.filter(F.col(name).isNotNull())), name, "left")
        .select(
            f"{name}_rank",
            name,
            F.coalesce("track_count", F.lit(0).cast("bigint")).alias("track_count"),
            f"avg_{measure}",
        )
        .orderBy(f"{name}_rank")
    )


def table_summary(df, distinct_column, mean_column, digits=2):
    """Rows, columns, distinct values of one column and mean of another."""
    return df.agg(
        F.count("*").alias("rows"),
        F.lit(len(df.columns)).alias("columns"),
        F.count_distinct(distinct_column).alias(f"distinct_{distinct_column}"),
        F.round(F.avg(mean_column), digits).alias(f"avg_{mean_column}"),
    )
