"""The layer streams over the event table, every message delivered twice."""

from pyspark.sql import functions as F

from wavelode.operators.sinks import overwrite
from wavelode.plans.layers import bronze
from wavelode.plans.queries.registry import file_or_folder, load, query
from wavelode.plans.queries.testbed import (
    EVENT_TRACKS, SILVER_WHERE, as_messages, event_tracks, state_partitions,
)
from wavelode.session import work_dir
from wavelode.sources.events import event_stream
from wavelode.sources.files import table, table_stream
from wavelode.streaming.jobs import (
    Layout, read_gold, run_layers, start_bronze, start_gold, start_silver,
)
from wavelode.streaming.sinks import append_stream, run_stream

_NOW = "available_now"
_VALID = f"(SELECT * FROM ({EVENT_TRACKS}) WHERE {SILVER_WHERE})"
_GOLD = f"""
SELECT track_genre, CASE WHEN tempo < 90 THEN 'slow' WHEN tempo < 120 THEN 'medium'
    ELSE 'fast' END AS tempo_bucket, count(*) AS track_count,
  round(avg(popularity), 2) AS avg_popularity, round(avg(energy), 4) AS avg_energy,
  round(avg(danceability), 4) AS avg_danceability
FROM {_VALID} GROUP BY ALL
"""


def _messages(spark, folder):
    schema = load(spark, folder, "events").schema
    events = table_stream(spark, file_or_folder(folder, "events"), schema)
    twice = events.withColumn("copy_no", F.explode(F.array(F.lit(1), F.lit(2))))
    return as_messages(event_tracks(twice.drop("copy_no")), "sent")


def _state_partitions(spark):
    return spark.sparkContext.defaultParallelism


def _layout(spark):
    return Layout(work_dir(spark, "layers"))


@query(
    "stream_bronze",
    f"""SELECT track_id, event_time, "partition", "offset", popularity, tempo, count(*) AS copies
    FROM (SELECT * FROM ({EVENT_TRACKS}) UNION ALL SELECT * FROM ({EVENT_TRACKS}))
    GROUP BY ALL""",
)
def stream_bronze(spark, folder):
    layout = _layout(spark)
    run_stream(start_bronze(_messages(spark, folder), layout, _NOW))
    columns = ["track_id", "event_time", "partition", "offset", "popularity", "tempo"]
    return table(spark, layout.path("bronze")).groupBy(*columns).agg(
        F.count("*").alias("copies")
    )


_SILVER_FIELDS = ["track_id", "event_time", "track_genre", "popularity", "tempo", "explicit_int"]
_STREAM_SILVER = f"""SELECT track_id, event_time, track_genre, popularity, tempo,
  CASE WHEN explicit THEN 1 ELSE 0 END AS explicit_int FROM {_VALID}"""


@query("stream_silver", _STREAM_SILVER)
def stream_silver(spark, folder):
    layout = _layout(spark)
    run_stream(start_bronze(_messages(spark, folder), layout, _NOW))
    run_stream(start_silver(
        spark, layout, _NOW, state_partitions=_state_partitions(spark)
    ))
    return table(spark, layout.path("silver")).select(*_SILVER_FIELDS)


@query("stream_silver_watermark", _STREAM_SILVER)
def stream_silver_watermark(spark, folder):
    layout = _layout(spark)
    run_stream(start_bronze(_messages(spark, folder), layout, _NOW))
    run_stream(start_silver(
        spark, layout, _NOW, watermark=("event_timestamp", "30 days"),
        state_partitions=_state_partitions(spark),
    ))
    return table(spark, layout.path("silver")).select(*_SILVER_FIELDS)


@query("stream_gold", _GOLD)
def stream_gold(spark, folder):
    rows = run_layers(
        spark, _messages(spark, folder), _layout(spark),
        state_partitions=_state_partitions(spark),
    )
    return rows.drop("gold_ingestion_time")


@query(
    "stream_resume",
    f"""SELECT 'bronze' AS layer, 2 * count(*) AS n FROM events
    UNION ALL SELECT 'silver', count(*) FROM {_VALID}
    UNION ALL SELECT 'gold', count(*) FROM ({_GOLD})""",
)
def stream_resume(spark, folder):
    """A second run from the same checkpoints must add nothing."""
    layout = _layout(spark)
    for _ in range(2):
        run_layers(
            spark, _messages(spark, folder), layout,
            state_partitions=_state_partitions(spark),
        )
    layers = {
        "bronze": table(spark, layout.path("bronze")),
        "silver": table(spark, layout.path("silver")),
        "gold": read_gold(spark, layout),
    }
    parts = [
        rows.agg(F.count("*").alias("n")).select(F.lit(name).alias("layer"), "n")
        for name, rows in layers.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "stream_message_files",
    f"""SELECT track_id, "partition", "offset", popularity FROM ({EVENT_TRACKS})""",
)
def stream_message_files(spark, folder):
    path = work_dir(spark, "messages")
    overwrite(as_messages(event_tracks(load(spark, folder, "events")), "sent"), path)
    layout = _layout(spark)
    run_stream(start_bronze(event_stream(spark, "parquet", path), layout, _NOW))
    return table(spark, layout.path("bronze")).select(
        "track_id", "partition", "offset", "popularity"
    )


@query("stream_text_lines", f"SELECT track_id, popularity, explicit FROM ({EVENT_TRACKS})")
def stream_text_lines(spark, folder):
    path = work_dir(spark, "lines")
    messages = as_messages(event_tracks(load(spark, folder, "events")), "sent")
    messages.select(F.col("value").cast("string").alias("value")).write.text(path)
    target = work_dir(spark, "lines-bronze")
    lines = bronze(event_stream(spark, "text", path))
    run_stream(append_stream(lines, target, f"{target}-checkpoint", _NOW))
    return table(spark, target).select("track_id", "popularity", "explicit")


@query("gold_from_small_files", _GOLD)
def gold_from_small_files(spark, folder):
    """Gold state carried over several micro-batches, one file each."""
    layout = _layout(spark)
    run_stream(start_bronze(_messages(spark, folder), layout, _NOW))
    state = state_partitions(load(spark, folder, "events").count())
    run_stream(start_silver(spark, layout, _NOW, state_partitions=state))
    run_stream(start_gold(spark, layout, _NOW, state_partitions=2, maxFilesPerTrigger=1))
    return read_gold(spark, layout).drop("gold_ingestion_time")


@query("gold_after_new_checkpoint", _GOLD)
def gold_after_new_checkpoint(spark, folder):
    """Gold from a new checkpoint over more input than the old one had seen."""
    path = work_dir(spark, "messages")
    sent = as_messages(event_tracks(load(spark, folder, "events")), "sent")
    first = F.col("partition") < 4
    overwrite(sent.filter(first), f"{path}/1")
    layout = _layout(spark)
    run_layers(spark, event_stream(spark, "parquet", f"{path}/*"), layout,
               state_partitions=_state_partitions(spark))
    overwrite(sent.filter(~first), f"{path}/2")
    run_stream(start_bronze(event_stream(spark, "parquet", f"{path}/*"), layout, _NOW))
    run_stream(start_silver(spark, layout, _NOW, state_partitions=_state_partitions(spark)))
    again = Layout(layout.root, checkpoints="new-checkpoints")
    run_stream(start_gold(spark, again, _NOW, state_partitions=_state_partitions(spark)))
    return read_gold(spark, again).drop("gold_ingestion_time")


@query(
    "rated_backlog",
    f"""SELECT (SELECT count(*) FROM events) AS messages, true AS one_file_each,
      count(*) AS valid FROM {_VALID}""",
)
def rated_backlog(spark, folder):
    """A backlog of several files, one for each trigger."""
    path = work_dir(spark, "messages")
    events = load(spark, folder, "events")
    sent = as_messages(event_tracks(events), "sent")
    sent.repartition(3).write.parquet(path)
    layout = _layout(spark)
    messages = event_stream(spark, "parquet", path, maxFilesPerTrigger=1)
    done = run_stream(start_bronze(messages, layout, _NOW))
    # Bronze has a file for each task that wrote it; a trigger takes one for each core.
    run_stream(start_silver(
        spark, layout, _NOW, state_partitions=state_partitions(events.count()),
        maxFilesPerTrigger=max(2, spark.sparkContext.defaultParallelism)))
    batches = sum(p["numInputRows"] > 0 for p in done.recentProgress)
    counts = table(spark, layout.path("bronze")).agg(F.count("*").alias("messages"))
    valid = table(spark, layout.path("silver")).count()
    return counts.select(
        "messages", F.lit(batches == 3).alias("one_file_each"),
        F.lit(valid).cast("bigint").alias("valid"))
