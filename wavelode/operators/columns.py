"""Row-wise projections."""

from pyspark.sql import functions as F

from wavelode.schemas import EVENT_SCHEMA, TIMESTAMP_CANDIDATES


def parse_events(messages, schema=EVENT_SCHEMA):
    """Messages to lineage columns plus the fields of the JSON value.

    A value that is not JSON keeps its text and has every field null.
    """
    return (
        messages.select(
            F.col("value").cast("string").alias("raw_json"),
            F.col("timestamp").alias("kafka_timestamp"),
            "partition",
            "offset",
        )
        .withColumn("data", F.from_json("raw_json", schema))
        .select("raw_json", "kafka_timestamp", "partition", "offset", "data.*")
    )


def stamp(df, name, now=None):
    """Add a processing-time column; ``now`` replaces the clock."""
    return df.withColumn(name, F.current_timestamp() if now is None else now)


def existing(df, columns):
    """The wanted columns that the table has, in the wanted order."""
    return [c for c in columns if c in df.columns]


def with_event_timestamp(df, name="event_ts", candidates=TIMESTAMP_CANDIDATES):
    """Add a timestamp read from the first candidate column present.

    Rows whose value does not convert are dropped.
    """
    present = existing(df, candidates)
    if not present:
        raise ValueError(f"no timestamp column among {list(candidates)}")
    return df.withColumn(name, F.col(present[0]).try_cast("timestamp")).filter(
        F.col(name).isNotNull()
    )
