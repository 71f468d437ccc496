"""The layer tables as functions of the layer below, for batch and streams."""

from pyspark.sql import functions as F

from wavelode.functions.buckets import GOLD_TEMPO
from wavelode.functions.casts import event_timestamp, flag_int
from wavelode.operators.aggregates import summarize
from wavelode.operators.columns import parse_events, stamp
from wavelode.operators.quality import (
    GOLD_RULES, SILVER_RULES, dedupe, passing, with_failures,
)

EVENT_KEY = ["track_id", "event_time"]

# Copies of one event differ in their place in the message source.
COPY_SPREAD = (["partition", "offset"], 16)

# The measures of the Gold summary and their digits.
GOLD_MEANS = {"popularity": 2, "energy": 4, "danceability": 4}


def bronze(messages, now=None):
    """Every message with its lineage, its text and the fields found in it."""
    return stamp(parse_events(messages), "ingestion_time", now)


def timed(bronze_rows):
    return bronze_rows.withColumn("event_timestamp", event_timestamp("event_time"))


def silver(bronze_rows, now=None, order=None, watermark=None, spread=COPY_SPREAD):
    """Valid events, one per track and event time."""
    valid = passing(timed(bronze_rows), SILVER_RULES)
    unique = dedupe(valid, EVENT_KEY, order, watermark, spread)
    return stamp(
        unique.withColumn("explicit_int", flag_int("explicit")),
        "silver_ingestion_time", now,
    )


def silver_seen(bronze_rows):
    """All events that Silver looks at, with the rules they break."""
    return with_failures(timed(bronze_rows), SILVER_RULES)


def silver_rejects(bronze_rows):
    """Events that Silver leaves out as invalid, with the rules they break."""
    return silver_seen(bronze_rows).filter(F.size("failed_rules") > 0)


def gold(silver_rows, now=None):
    """Track counts and means per genre and tempo bucket."""
    rows = passing(silver_rows, GOLD_RULES).withColumn(
        "tempo_bucket", GOLD_TEMPO.of("tempo")
    )
    return stamp(
        summarize(rows, ["track_genre", "tempo_bucket"], GOLD_MEANS, "track_count"),
        "gold_ingestion_time", now,
    )
