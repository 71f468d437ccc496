"""Batch and streaming table reads, and path lookup."""

import csv
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import functions as F

from wavelode.functions.casts import lenient_bool, lenient_double, lenient_int
from wavelode.schemas import EVENT_SCHEMA, TRACK_COLUMNS
from wavelode.session import session_conf


def table(spark, path, fmt="parquet"):
    return spark.read.format(fmt).load(path)


def table_stream(spark, path, schema=None, fmt="parquet", **options):
    """Incremental read of an append-only table.

    Parquet needs the schema up front; a table format that records its own
    schema does not.
    """
    reader = spark.readStream.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def _file_system(spark, path):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return hadoop_path.getFileSystem(conf), hadoop_path


def path_exists(spark, path):
    fs, hadoop_path = _file_system(spark, path)
    return fs.exists(hadoop_path)


def first_existing(spark, paths):
    """First path that exists on whatever store it names."""
    for path in paths:
        if path_exists(spark, path):
            return path
    raise FileNotFoundError(f"none of these paths exists: {list(paths)}")


def child_names(spark, path):
    fs, hadoop_path = _file_system(spark, path)
    return [status.getPath().getName() for status in fs.listStatus(hadoop_path)]


def remove_path(spark, path):
    fs, hadoop_path = _file_system(spark, path)
    return fs.delete(hadoop_path, True)


def make_folder(spark, path):
    fs, hadoop_path = _file_system(spark, path)
    fs.mkdirs(hadoop_path)


def rename_path(spark, path, target):
    """Give a finished folder its name; the target must not be there."""
    fs, hadoop_path = _file_system(spark, path)
    _, hadoop_target = _file_system(spark, target)
    fs.mkdirs(hadoop_target.getParent())
    if not fs.rename(hadoop_path, hadoop_target):
        raise OSError(f"cannot rename {path} to {target}")


def folder_bytes(spark, path):
    """Bytes of all files under a folder."""
    fs, hadoop_path = _file_system(spark, path)
    return fs.getContentSummary(hadoop_path).getLength()


def read_text(spark, path):
    """A small file as text."""
    fs, hadoop_path = _file_system(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark, path, text):
    """Write a small file that appears whole or not at all, in place of an older one."""
    fs, hadoop_path = _file_system(spark, path)
    _, started = _file_system(spark, f"{path}.new")
    stream = fs.create(started, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    jvm = spark.sparkContext._jvm
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration()
    ).rename(started, hadoop_path, options)


def _first_rows(batches):
    """The first row of a partition; the rest of it is not read."""
    for batch in batches:
        if batch.num_rows:
            yield batch.slice(0, 1)
            return


# One partition for each file, so that a task reads the first lines of one file.
_WHOLE_FILES = {
    "spark.sql.files.maxPartitionBytes": str(1 << 60),
    "spark.sql.files.openCostInBytes": str(1 << 60),
}


def csv_headers(spark, path):
    """{column names: files that have them} of CSV files, compressed or not.

    The first lines are read by tasks. A file without lines has no header.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    firsts = lines.mapInArrow(_first_rows, "value STRING, file STRING").groupBy("value").agg(
        F.collect_list("file").alias("files"))
    found = {}
    with session_conf(spark, _WHOLE_FILES):
        for line, files in firsts.collect():
            names = tuple(next(csv.reader([line.removeprefix("\ufeff")]), ()))
            if names:
                found.setdefault(names, []).extend(unquote(f) for f in files)
    return found


def read_tracks_csv(spark, path, multi_line=False):
    """Header CSV of text cells to typed track rows, read by column name.

    Files may differ in the order of their columns and in which they have: the files of
    each header are read with their own names. ``multi_line`` allows line breaks inside
    quoted cells, at the price of one task per file.
    """
    layouts = csv_headers(spark, path)
    if len(layouts) == 1:  # no need to name the files
        layouts = dict.fromkeys(layouts, path)
    reader = spark.read.options(
        header=True, escape='"', multiLine=multi_line, enforceSchema=False)
    parts = [
        typed_tracks(reader.schema(", ".join(f"`{name}` STRING" for name in names)).csv(files))
        for names, files in sorted(layouts.items())
    ]
    if not parts:
        return typed_tracks(spark.createDataFrame([], "track_id STRING"))
    return reduce(lambda a, b: a.unionByName(b), parts)


def _text(name):
    # The reader gives null for an empty cell.
    return F.coalesce(F.col(f"`{name}`"), F.lit(""))


def typed_tracks(text):
    """Convert text columns to the track types; absent columns become null."""
    convert = {
        "int": lenient_int,
        "double": lenient_double,
        "boolean": lenient_bool,
        "string": _text,
    }
    kinds = {f.name: f.dataType.simpleString() for f in EVENT_SCHEMA}
    return text.select(*[
        (
            convert[kinds[name]](name) if name in text.columns
            else F.lit(None).cast(kinds[name])
        ).alias(name)
        for name in TRACK_COLUMNS
    ])


def read_result_csv(spark, path):
    """A result table with lower-case column names."""
    result = spark.read.option("header", True).option("inferSchema", True).csv(path)
    return result.toDF(*[name.lower() for name in result.columns])


def name_and_value_columns(df, name, value):
    """The named columns, or the first and last when they are absent."""
    return (
        name if name in df.columns else df.columns[0],
        value if value in df.columns else df.columns[-1],
    )
