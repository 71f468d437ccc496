"""Keyed tables that a stream keeps up to date.

A table is split by the hash of its keys. A batch reads and rewrites only the parts that
its keys fall in; a manifest names the folder that holds each part now. Readers take the
newest manifest, which appears when all its folders are complete.
"""

import json
from functools import partial

from pyspark.sql import functions as F

from wavelode.functions.hashing import hash_bucket
from wavelode.sources.files import path_exists, read_text, remove_path, write_text
from wavelode.streaming.sinks import (
    DEFAULT_TRIGGER, generation_of, numbered_children, with_trigger,
)

PARTS = 64
KEEP = 3


def latest_rows(df, keys, order):
    """One row per key, the last by the order columns, nulls counting as oldest, for a
    batch or as state of a stream (update or complete mode).

    Ties go to the larger hash of the row. A task sends one row of each key it saw, so a
    key with very many rows does not gather. A stream holds one row per key for good.
    """
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*[F.col(c) for c in order], F.xxhash64(*rest))
    row = F.max_by(F.struct(*rest), rank).alias("__row")
    return df.groupBy(*keys).agg(row).select(
        *[F.col(f"__row.{c}").alias(c) if c in rest else F.col(c) for c in df.columns])


def _manifest_path(path, place):
    return f"{path}/manifest={place[0]}-{place[1]}"


def _manifest(spark, path, place):
    return json.loads(read_text(spark, _manifest_path(path, place)))


def _folders(spark, path, place):
    return set(_manifest(spark, path, place)["folders"].values())


def _prune(spark, path, keep):
    """Remove all but the newest manifests, and the folders that only removed ones name."""
    places = numbered_children(spark, path, "manifest")
    held = set().union(*[_folders(spark, path, place) for place in places[:keep]])
    for place in places[keep:]:
        for folder in _folders(spark, path, place) - held:
            remove_path(spark, f"{path}/{folder}")
        remove_path(spark, _manifest_path(path, place))


def merge_rows(changed, path, keys, place, parts=PARTS, keep=KEEP):
    """Put changed rows, one for each key, into a keyed table in place of those with the
    same keys. ``place`` is the (generation, batch) of the change; one that is in the
    table already changes nothing. Null keys equal each other."""
    spark = changed.sparkSession
    if path_exists(spark, _manifest_path(path, place)):
        return
    older = [p for p in numbered_children(spark, path, "manifest") if p < place]
    manifest = _manifest(spark, path, older[0]) if older else {"parts": parts, "folders": {}}
    parts, current = manifest["parts"], manifest["folders"]
    rows = changed.withColumn("part", hash_bucket(keys, parts))
    # As many rows as there are parts.
    touched = [str(r["part"]) for r in rows.select("part").distinct().collect()]
    if not touched:
        return
    held = [f"{path}/{current[p]}" for p in touched if p in current]
    if held:
        before = spark.read.schema(changed.schema).parquet(*held)
        names = [f"__key{i}" for i in range(len(keys))]
        gone = changed.select(*[F.col(c).alias(n) for c, n in zip(keys, names)])
        same = [F.col(c).eqNullSafe(F.col(n)) for c, n in zip(keys, names)]
        staying = before.join(gone, same, "left_anti")
        rows = rows.unionByName(staying.withColumn("part", hash_bucket(keys, parts)))
    folder = f"data/{place[0]}-{place[1]}"
    rows.repartition("part").write.mode("overwrite").partitionBy("part").parquet(
        f"{path}/{folder}")
    current.update({p: f"{folder}/part={p}" for p in touched})
    write_text(spark, _manifest_path(path, place), json.dumps(manifest))
    if keep is not None:
        _prune(spark, path, keep)


def _merge_batch(path, generation, keys, parts, keep, batch, batch_id):
    # Dealt anew, as rows that come sorted out of an aggregate cannot be held.
    rows = batch.repartition(*keys).persist()
    try:
        rows.write.format("noop").mode("overwrite").save()  # carries the state on
        merge_rows(rows, path, keys, (generation, batch_id), parts, keep)
    finally:
        rows.unpersist()


def keyed_stream(df, path, checkpoint, keys, trigger=DEFAULT_TRIGGER, parts=PARTS, keep=KEEP):
    """Keep a table of the newest row of each key of a query in update mode.

    What a trigger writes follows the groups that changed: their parts, not the table.
    ``keep`` manifests stay for readers that have started. The table keeps the number of
    parts of its first batch; a part should fit a task.
    """
    generation = generation_of(df.sparkSession, path, checkpoint, "manifest")
    writer = df.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    return with_trigger(
        writer.foreachBatch(partial(_merge_batch, path, generation, keys, parts, keep)), trigger
    ).start()


def read_keyed(spark, path, schema=None):
    """All rows of a keyed table; without a manifest none, in the columns of the schema."""
    places = numbered_children(spark, path, "manifest")
    if not places:
        if schema is None:
            raise FileNotFoundError(f"no manifest under {path}")
        return spark.createDataFrame([], schema)
    folders = sorted(_folders(spark, path, places[0]))
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*[f"{path}/{folder}" for folder in folders])
