"""Track events: envelope, wire form and message streams."""

from pyspark.sql import functions as F

from wavelode.functions.hashing import hash_bucket
from wavelode.schemas import EVENT_SCHEMA, EVENT_TYPE, MESSAGE_SCHEMA


def to_events(tracks, key="track_id", seed=42, users=5000, now=None, method="xxhash64"):
    """Wrap track rows in the event envelope, columns in wire order.

    The user is a hash of the key, so a recomputed task emits the same event.
    ``now`` replaces the clock with a column or text.
    """
    if now is None:
        # The time zone is spelled out, as the text must read as UTC anywhere.
        now = F.date_format(
            F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()),
            "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'",
        )
    elif isinstance(now, str):
        now = F.lit(now)
    user = F.concat(
        F.lit("user_"), (hash_bucket([key], users, seed, method) + 1).cast("string")
    )
    envelope = {"event_time": now, "event_type": F.lit(EVENT_TYPE), "user_id": user}
    return tracks.select(*[
        envelope.get(f.name, F.col(f"`{f.name}`")).cast(f.dataType).alias(f.name)
        for f in EVENT_SCHEMA
    ])


def event_json(*names):
    """The named columns as one JSON object, null fields written out."""
    return F.to_json(F.struct(*[f"`{c}`" for c in names]), {"ignoreNullFields": "false"})


def events_to_json(events, alias="value"):
    return events.select(event_json(*events.columns).alias(alias))


def event_stream(spark, fmt, path=None, servers=None, topic=None, **options):
    """A stream with columns value, timestamp, partition and offset.

    ``kafka`` subscribes to a topic from its first offset. ``parquet`` replays
    files that hold the four columns. ``text`` takes one message per line, with
    the file's time as timestamp and a hash of its place as offset.
    """
    if fmt == "kafka":
        settings = {
            "kafka.bootstrap.servers": servers,
            "subscribe": topic,
            "startingOffsets": "earliest",
            **options,
        }
        return spark.readStream.format("kafka").options(**settings).load()
    if fmt == "text":
        lines = spark.readStream.format("text").options(**options).load(path)
        return lines.select(
            F.col("value").cast("binary").alias("value"),
            F.col("_metadata.file_modification_time").alias("timestamp"),
            # A place of its own for every line, so that copies of an event are spread.
            F.spark_partition_id().alias("partition"),
            F.xxhash64("_metadata.file_path", F.rand()).alias("offset"),
        )
    return (
        spark.readStream.format(fmt).schema(MESSAGE_SCHEMA).options(**options).load(path)
    )
