"""Streaming writes and the life of a query."""

import re
from functools import partial

from wavelode.sources.files import (
    child_names, path_exists, read_text, remove_path, write_text,
)

DEFAULT_TRIGGER = "10 seconds"


def with_trigger(writer, trigger):
    if trigger == "available_now":
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def append_stream(df, path, checkpoint, trigger=DEFAULT_TRIGGER, fmt="parquet",
                  partition_by=()):
    """Append each micro-batch to a table, resumable from the checkpoint."""
    writer = (
        df.writeStream.format(fmt).outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return with_trigger(writer, trigger).start(path)


def numbered_children(spark, path, kind):
    """(generation, batch) of the children <kind>=<generation>-<batch>, newest first."""
    found = []
    for name in child_names(spark, path) if path_exists(spark, path) else ():
        place = re.fullmatch(rf"{kind}=(?:(\d+)-)?(\d+)", name)
        if place:
            found.append((int(place[1] or 0), int(place[2])))
    return sorted(found, reverse=True)


def _snapshots(spark, path):
    return numbered_children(spark, path, "snapshot")


def _snapshot_path(path, generation, batch):
    return f"{path}/snapshot={generation}-{batch}"


def generation_of(spark, path, checkpoint, kind="snapshot"):
    """Number of a checkpoint among all that wrote to the folder.

    Batch numbers start again with a new checkpoint, so it gets a number above those in
    the folder. The number is kept in the checkpoint: a restart goes on with the same
    one and a repeated batch rewrites its own snapshot.
    """
    place = f"{checkpoint}/generation"
    if path_exists(spark, place):
        return int(read_text(spark, place))
    number = 1 + max((g for g, _ in numbered_children(spark, path, kind)), default=0)
    write_text(spark, place, str(number))
    return number


def _write_snapshot(path, generation, keep, batch, batch_id):
    batch.write.mode("overwrite").parquet(_snapshot_path(path, generation, batch_id))
    if keep is None:
        return
    spark, written = batch.sparkSession, (generation, batch_id)
    older = [s for s in _snapshots(spark, path) if s < written]
    for old in older[max(0, keep - 1):]:
        remove_path(spark, _snapshot_path(path, *old))
        if old[0] == 0:  # written before snapshots had generations
            remove_path(spark, f"{path}/snapshot={old[1]}")


def snapshot_stream(df, path, checkpoint, trigger=DEFAULT_TRIGGER, fmt="parquet", keep=None):
    """Replace an aggregate table on every trigger.

    Plain files cannot be replaced under a reader, so each trigger writes a new
    snapshot folder named by the checkpoint's generation and the batch. All snapshots
    stay, unless ``keep`` gives the number that may: then older ones than that are
    removed after a write, never the one just written.
    """
    writer = df.writeStream.outputMode("complete").option("checkpointLocation", checkpoint)
    if fmt == "delta":
        return with_trigger(writer.format(fmt), trigger).start(path)
    generation = generation_of(df.sparkSession, path, checkpoint)
    return with_trigger(
        writer.foreachBatch(partial(_write_snapshot, path, generation, keep)), trigger
    ).start()


def read_snapshot(spark, path, fmt="parquet"):
    """The newest complete snapshot."""
    if fmt == "delta":
        return spark.read.format(fmt).load(path)
    for generation, batch in _snapshots(spark, path):
        places = [_snapshot_path(path, generation, batch)]
        if generation == 0:
            places.append(f"{path}/snapshot={batch}")
        for place in places:
            if path_exists(spark, f"{place}/_SUCCESS"):
                return spark.read.parquet(place)
    raise FileNotFoundError(f"no complete snapshot under {path}")


def run_stream(query, seconds=0):
    """Wait for a query and stop it; 0 waits until it ends by itself."""
    try:
        if seconds > 0:
            query.awaitTermination(seconds)
        else:
            query.awaitTermination()
    finally:
        query.stop()
    return query


def rows_dropped(query):
    """Rows that a query left out as later than its watermark, over its last batches."""
    return sum(
        state.get("numRowsDroppedByWatermark", 0)
        for progress in query.recentProgress for state in progress["stateOperators"]
    )
