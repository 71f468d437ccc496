"""Batch writes."""

from pyspark.sql import functions as F

from wavelode.sources.events import event_json
from wavelode.sources.files import child_names, path_exists, read_text, remove_path, write_text


def overwrite(df, path, fmt="parquet", partition_by=()):
    df.write.format(fmt).mode("overwrite").partitionBy(*partition_by).save(path)


_POINTER = "_current"


def _versions(spark, path):
    names = child_names(spark, path) if path_exists(spark, path) else ()
    numbers = [n.removeprefix("version=") for n in names if n.startswith("version=")]
    return sorted((int(n) for n in numbers if n.isdigit()), reverse=True)


def replace_table(df, path, keep=1, fmt="parquet", partition_by=()):
    """Replace a table as a whole, or leave it as it is if the write fails.

    The rows go to a folder of their own; a small pointer file then names it and is
    replaced at once. The rows may come from the table itself. ``keep`` older versions
    stay for readers that have started. One writer at a time.
    """
    spark = df.sparkSession
    older = _versions(spark, path)
    version = 1 + max(older, default=0)
    df.write.format(fmt).partitionBy(*partition_by).save(f"{path}/version={version}")
    write_text(spark, f"{path}/{_POINTER}", str(version))
    # Folders of writes that failed go with the older ones.
    for old in older[keep:]:
        remove_path(spark, f"{path}/version={old}")


def read_replaced(spark, path, fmt="parquet"):
    """The table that the last finished ``replace_table`` wrote."""
    if not path_exists(spark, f"{path}/{_POINTER}"):
        raise FileNotFoundError(f"no table under {path}")
    version = read_text(spark, f"{path}/{_POINTER}").strip()
    return spark.read.format(fmt).load(f"{path}/version={version}")


def write_result_csv(df, path):
    """A small result table as one CSV file with a header.

    Only the finished rows move to one task; the work above stays spread out.
    """
    df.repartition(1).write.mode("overwrite").option("header", True).csv(path)


def publish(events, fmt, path=None, servers=None, topic=None):
    """Send events to a topic, or append them as message files.

    Files carry the four columns that a message stream reads; offsets are
    unique within a write and partitions are those of the table.
    """
    value = event_json(*events.columns)
    if fmt == "kafka":
        (
            events.select(value.alias("value")).write.format("kafka")
            .option("kafka.bootstrap.servers", servers).option("topic", topic).save()
        )
        return
    events.select(
        value.cast("binary").alias("value"),
        F.current_timestamp().alias("timestamp"),
        F.spark_partition_id().alias("partition"),
        F.monotonically_increasing_id().alias("offset"),
    ).write.format(fmt).mode("append").save(path)
