"""The three layer jobs as independent streams linked by their tables."""

from dataclasses import dataclass

from wavelode.operators.quality import SILVER_RULES
from wavelode.plans.layers import COPY_SPREAD, bronze, gold, silver, silver_seen
from wavelode.schemas import MESSAGE_SCHEMA
from wavelode.session import CLOSED_STATE_CONF, STATE_STORE_CONF, session_conf
from wavelode.sources.files import make_folder, table_stream
from wavelode.streaming.batches import (
    KEPT, LATE, OUTCOMES, REJECTED, RULE_COUNTS, outcome_stream, read_batches,
)
from wavelode.streaming.keyed import PARTS, keyed_stream, latest_rows, read_keyed
from wavelode.streaming.profiles import StoredProfile, profile_stream, silver_profile_columns
from wavelode.streaming.sinks import (
    DEFAULT_TRIGGER, append_stream, read_snapshot, run_stream, snapshot_stream,
)
from wavelode.streaming.windows import windowed_summary

# Gold tables that stay for readers that have started.
KEEP = 3
GOLD_KEY = ["track_genre", "tempo_bucket"]


@dataclass(frozen=True)
class Layout:
    """Where the tables and checkpoints live."""

    root: str
    fmt: str = "parquet"
    checkpoints: str = "checkpoints"

    def path(self, layer):
        return f"{self.root}/{layer}"

    def checkpoint(self, layer):
        return f"{self.root}/{self.checkpoints}/{layer}"


def state_conf(state_partitions=None, trigger=DEFAULT_TRIGGER, limits=None):
    """Settings under which a query with state starts; ``limits`` are the source's options
    that bound what a trigger takes, if there are any."""
    # The number of state partitions is fixed when a query first starts.
    conf = dict(STATE_STORE_CONF)
    if trigger == "available_now" and not limits:
        conf.update(CLOSED_STATE_CONF)
    if state_partitions:
        conf["spark.sql.shuffle.partitions"] = str(state_partitions)
    return conf


def layer_schema(spark, layer):
    """Columns of a layer's table, whether or not it has rows yet."""
    rows = bronze(spark.createDataFrame([], MESSAGE_SCHEMA))
    if layer == "bronze":
        return rows.schema
    rows = silver(rows)
    return rows.schema if layer == "silver" else gold(rows).schema


def _layer_stream(spark, layout, layer, **options):
    if layout.fmt == "delta":
        return table_stream(spark, layout.path(layer), None, layout.fmt, **options)
    make_folder(spark, layout.path(layer))  # a layer may start before the one below
    return table_stream(
        spark, layout.path(layer), layer_schema(spark, layer), layout.fmt, **options)


def start_bronze(messages, layout, trigger=DEFAULT_TRIGGER, now=None):
    return append_stream(
        bronze(messages, now), layout.path("bronze"), layout.checkpoint("bronze"),
        trigger, layout.fmt,
    )


def start_silver(spark, layout, trigger=DEFAULT_TRIGGER, now=None, watermark=None,
                 spread=COPY_SPREAD, state_partitions=None, **options):
    rows = silver(
        _layer_stream(spark, layout, "bronze", **options), now,
        watermark=watermark, spread=spread,
    )
    with session_conf(spark, state_conf(state_partitions, trigger, options)):
        return append_stream(
            rows, layout.path("silver"), layout.checkpoint("silver"), trigger, layout.fmt
        )


def outcome_paths(layout):
    """Folders of the tables that Silver with outcomes writes."""
    return {
        KEPT: layout.path("silver"), REJECTED: layout.path("silver_rejected"),
        LATE: layout.path("silver_late"), "outcomes": layout.path("silver_outcomes"),
        "rules": layout.path("silver_rules"),
    }


def start_silver_outcomes(spark, layout, trigger=DEFAULT_TRIGGER, now=None, watermark=None,
                          spread=COPY_SPREAD, state_partitions=None, **options):
    """Silver that also writes what it leaves out: invalid events with the rules they
    break, late events, and counts of both, each micro-batch once.

    A Silver table belongs to this job or to ``start_silver``, not to both: here it is a
    folder for each batch.
    """
    rows = _layer_stream(spark, layout, "bronze", **options)
    kept = silver(rows, now, watermark=watermark, spread=spread)
    with session_conf(spark, state_conf(state_partitions, trigger, options)):
        return outcome_stream(
            kept, silver_seen(rows), outcome_paths(layout), SILVER_RULES,
            layout.checkpoint("silver"), watermark, trigger,
        )


def read_outcomes(spark, layout, table):
    """One of the tables of ``outcome_paths``, with or without rows."""
    lower = bronze(spark.createDataFrame([], MESSAGE_SCHEMA))
    seen = silver_seen(lower)
    schemas = {
        KEPT: silver(lower).schema, REJECTED: seen.schema,
        LATE: seen.drop("failed_rules").schema,
        "outcomes": spark.createDataFrame([], OUTCOMES).schema,
        "rules": spark.createDataFrame([], RULE_COUNTS).schema,
    }
    return read_batches(spark, outcome_paths(layout)[table], schemas[table])


def start_gold(spark, layout, trigger=DEFAULT_TRIGGER, now=None, state_partitions=None,
               keep=KEEP, **options):
    rows = gold(_layer_stream(spark, layout, "silver", **options), now)
    with session_conf(spark, state_conf(state_partitions, trigger, options)):
        return snapshot_stream(
            rows, layout.path("gold"), layout.checkpoint("gold"), trigger, layout.fmt, keep
        )


def start_gold_updates(spark, layout, trigger=DEFAULT_TRIGGER, now=None,
                       state_partitions=None, parts=PARTS, keep=KEEP, **options):
    """Gold of which a trigger rewrites only the parts whose groups changed."""
    rows = gold(_layer_stream(spark, layout, "silver", **options), now)
    with session_conf(spark, state_conf(state_partitions, trigger, options)):
        return keyed_stream(
            rows, layout.path("gold_parts"), layout.checkpoint("gold_parts"), GOLD_KEY,
            trigger, parts, keep,
        )


def read_gold_updates(spark, layout):
    return read_keyed(spark, layout.path("gold_parts"), layer_schema(spark, "gold"))


def start_latest(spark, layout, trigger=DEFAULT_TRIGGER, keys=("track_id",),
                 order=("event_timestamp",), state_partitions=None, parts=PARTS, keep=KEEP,
                 **options):
    """The newest Silver row of each key, whatever order the rows come in."""
    keys = list(keys)
    rows = latest_rows(_layer_stream(spark, layout, "silver", **options), keys, order)
    with session_conf(spark, state_conf(state_partitions, trigger, options)):
        return keyed_stream(
            rows, layout.path("latest"), layout.checkpoint("latest"), keys, trigger, parts, keep
        )


def read_latest(spark, layout):
    return read_keyed(spark, layout.path("latest"), layer_schema(spark, "silver"))


def start_windows(spark, layout, name, width, delay, trigger=DEFAULT_TRIGGER, keys=(),
                  means=None, slide=None, state_partitions=None, **options):
    """A table of closed windows over Silver's event time, appended as they close."""
    rows = windowed_summary(
        _layer_stream(spark, layout, "silver", **options), "event_timestamp", width, delay,
        keys, means, slide=slide,
    )
    with session_conf(spark, state_conf(state_partitions, trigger, options)):
        return append_stream(
            rows, layout.path(name), layout.checkpoint(name), trigger, layout.fmt
        )


def start_profile(spark, layout, trigger=DEFAULT_TRIGGER, **options):
    """States of Silver's columns by day, from which profiles of any span are merged."""
    rows = _layer_stream(spark, layout, "silver", **options)
    return profile_stream(
        rows, layout.path("profile"), layout.checkpoint("profile"),
        *silver_profile_columns(rows), "event_timestamp", trigger,
    )


def read_profile(spark, layout):
    return StoredProfile(spark, layout.path("profile"))


def read_gold(spark, layout):
    """The newest Gold table; without rows before its first trigger with data."""
    try:
        return read_snapshot(spark, layout.path("gold"), layout.fmt)
    except FileNotFoundError:
        return spark.createDataFrame([], layer_schema(spark, "gold"))


def run_layers(spark, messages, layout, now=None, watermark=None, state_partitions=None,
               keep=KEEP, **options):
    """Bring all layers up to date with what the source holds now."""
    trigger = "available_now"
    run_stream(start_bronze(messages, layout, trigger, now))
    run_stream(start_silver(
        spark, layout, trigger, now, watermark, state_partitions=state_partitions, **options
    ))
    run_stream(start_gold(
        spark, layout, trigger, now, state_partitions=state_partitions, keep=keep, **options
    ))
    return read_gold(spark, layout)

