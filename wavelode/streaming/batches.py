"""Several tables out of one query, each micro-batch written once.

A batch of a query goes to every table as a folder batch=<generation>-<batch>, which is
renamed into place when it is complete. Where the folder is there already the batch is a
repeat after a failure, and its rows are left as they are.
"""

import json
from functools import partial

from pyspark import StorageLevel
from pyspark.sql import functions as F

from wavelode.sources.files import path_exists, read_text, remove_path, rename_path
from wavelode.streaming.sinks import DEFAULT_TRIGGER, generation_of, with_trigger


def write_once(df, path, name):
    """Write a batch's rows to a table unless they are there; True if they were written."""
    spark, target = df.sparkSession, f"{path}/batch={name}"
    if path_exists(spark, target):
        return False
    staged = f"{path}/_staged/batch={name}"
    remove_path(spark, staged)
    df.write.parquet(staged)
    rename_path(spark, staged, target)
    return True


def read_batches(spark, path, schema):
    """All rows of a table of batches, in the columns of the schema."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def late_bound(spark, checkpoint, batch_id):
    """Event time in milliseconds at and below which a batch's rows were dropped as late.

    A batch drops by the watermark of the batch before it, which the query has written
    to its checkpoint before that batch ran. 0 while there is none.
    """
    if batch_id == 0:
        return 0
    # The lines are a version, the facts of the batch, and the sources' places.
    _, facts, *_ = read_text(spark, f"{checkpoint}/offsets/{batch_id - 1}").splitlines()
    return json.loads(facts)["batchWatermarkMs"]


def is_late(time, bound_ms):
    """Is a row at or below the bound that ``late_bound`` gives?"""
    if not bound_ms:
        return F.lit(False)
    return F.unix_micros(time) <= F.lit(bound_ms * 1000)


def each_batch(df, path, checkpoint, write, trigger=DEFAULT_TRIGGER, mode="append",
               prepare=None):
    """Call ``write(rows, name, batch_id)`` for every micro-batch, or for what
    ``prepare(rows, batch_id)`` makes of it, row by row.

    The rows are held while they are written, as each table would run the batch again
    otherwise, and they are computed even where nothing is left to write: state is only
    carried on by a batch that ran. They are held on disk: they are whole rows, read a few
    times in turn, and memory is left to the state.
    """
    spark = df.sparkSession
    generation = generation_of(spark, path, checkpoint, "batch")

    def run(batch, batch_id):
        rows = batch if prepare is None else prepare(batch, batch_id)
        rows = rows.persist(StorageLevel.DISK_ONLY)
        try:
            rows.write.format("noop").mode("overwrite").save()
            write(rows, f"{generation}-{batch_id}", batch_id)
        finally:
            rows.unpersist()

    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    return with_trigger(writer.foreachBatch(run), trigger).start()


# What becomes of a row.
KEPT, REJECTED, LATE, COPY = "kept", "rejected", "late", "copy"
OUTCOMES = "outcome STRING, rows BIGINT"
RULE_COUNTS = "rule_no INT, rule STRING, rejected BIGINT"


def with_sides(kept, seen, side="__side"):
    """Rows that a layer keeps and all rows that it saw, told apart by a column."""
    return kept.withColumn(side, F.lit(KEPT)).unionByName(
        seen.withColumn(side, F.lit(None).cast("string")), allowMissingColumns=True)


def _mark_outcomes(checkpoint, watermark, rows, batch_id):
    """Add each row's outcome. A row without one goes to no table: it only counts as seen,
    so its other columns are emptied before the batch is held."""
    late = F.lit(False)
    if watermark is not None:
        late = is_late(watermark[0], late_bound(rows.sparkSession, checkpoint, batch_id))
    broken = F.size("failed_rules") > 0
    outcome = (
        F.when(F.col("__side") == KEPT, KEPT).when(broken, REJECTED).when(late, LATE)
    )
    marked, written = rows.withColumn("__outcome", outcome), F.col("__outcome").isNotNull()
    own = ("__side", "__outcome", "failed_rules")
    return marked.select(*[
        c if c in own else F.when(written, F.col(f"`{c}`")).alias(c) for c in marked.columns])


def _write_outcomes(paths, columns, rules, marked, name, batch_id):
    """Split a batch by outcome; every table gets its part once."""
    spark = marked.sparkSession
    counts = marked.agg(
        F.count_if(F.col("__side").isNull()).alias("seen"),
        *[F.count_if(F.col("__outcome") == o).alias(o) for o in (KEPT, REJECTED, LATE)],
        *[F.count_if(F.array_contains("failed_rules", r)).alias(f"rule{i}")
          for i, r in enumerate(rules)],
    ).first()
    if not counts["seen"] and not counts[KEPT]:
        return  # a batch that only drops state
    for kind in (KEPT, REJECTED, LATE):
        if counts[kind]:
            part = marked.where(F.col("__outcome") == kind)
            write_once(part.select(*columns[kind]), paths[kind], name)
    copies = counts["seen"] - counts[KEPT] - counts[REJECTED] - counts[LATE]
    facts = [(o, counts[o]) for o in (KEPT, REJECTED, LATE)] + [(COPY, copies)]
    write_once(spark.createDataFrame(facts, OUTCOMES).coalesce(1), paths["outcomes"], name)
    broken_rules = [(i, r, counts[f"rule{i}"]) for i, r in enumerate(rules)]
    write_once(
        spark.createDataFrame(broken_rules, RULE_COUNTS).coalesce(1), paths["rules"], name)


def outcome_stream(kept, seen, paths, rules, checkpoint, watermark=None,
                   trigger=DEFAULT_TRIGGER):
    """Write what a layer keeps, and beside it its rejected and late rows and counts.

    ``seen`` are all rows with their failed_rules, from the same source as ``kept``, so
    both have the same batches. Late are rows that break no rule and lie under the
    watermark by which the batch dropped rows. ``paths`` has a folder for each of kept,
    rejected, late, outcomes and rules. Of every batch, rows seen = kept + rejected +
    late + copies.
    """
    whole = [c for c in seen.columns if c != "failed_rules"]
    columns = {KEPT: kept.columns, REJECTED: seen.columns, LATE: whole}
    write = partial(_write_outcomes, paths, columns, list(rules))
    return each_batch(
        with_sides(kept, seen), paths["outcomes"], checkpoint, write, trigger,
        prepare=partial(_mark_outcomes, checkpoint, watermark))
