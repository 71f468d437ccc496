"""Event-time windows for streams and batches."""

from pyspark.sql import functions as F


def windowed_summary(df, time, width, delay=None, keys=(), means=None, count_name="count",
                     slide=None):
    """Row count and rounded means per window of event time and group.

    A window is [window_start, window_end); ``slide`` makes windows overlap. On a stream
    with a ``delay`` a window is closed when the watermark passes its end: it is given
    out once, in append mode, and its state goes. Rows later than that are dropped. A
    null time belongs to no window. A batch gives all windows.
    """
    rows = df.withWatermark(time, delay) if df.isStreaming and delay else df
    window = F.window(time, width, slide)
    grouped = rows.groupBy(window.alias("__window"), *keys).agg(
        F.count("*").alias(count_name),
        *[F.round(F.avg(c), digits).alias(f"avg_{c}") for c, digits in (means or {}).items()],
    )
    return grouped.select(
        F.col("__window.start").alias("window_start"), F.col("__window.end").alias("window_end"),
        *[c for c in grouped.columns if c != "__window"],
    )


def days_of(windows, count="count"):
    """Rows per calendar day out of windows that lie within days."""
    return (
        windows.groupBy(F.date_format("window_start", "yyyy-MM-dd").alias("day"))
        .agg(F.sum(count).alias("count")).orderBy("day")
    )


def hours_of(windows, count="count"):
    """Rows per hour of day out of windows that lie within hours."""
    return (
        windows.groupBy(F.hour("window_start").alias("hour"))
        .agg(F.sum(count).alias("count")).orderBy("hour")
    )
