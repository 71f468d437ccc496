"""Helpers shared by the document operators."""

from pyspark.sql import functions as F

from wavelode.session import session_conf, work_dir
from wavelode.sources.files import remove_path

# A word is a run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


# A query's shuffle files go when it ends instead of when the driver collects its garbage.
_TIDY = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def tidy(spark):
    """Shuffle files of the queries in a block go when each of them ends."""
    return session_conf(spark, _TIDY)


def stored(frame, label):
    """Write the rows under the shared folder and read them back.

    Cuts the lineage: a lost executor costs a reread, not a recomputation, and
    values that depend on the scan order (row tags) are fixed from here on.
    """
    path = work_dir(frame.sparkSession, label)
    with tidy(frame.sparkSession):
        frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def discard(*frames):
    """Remove stored rows that no later step reads."""
    for frame in frames:
        for folder in {file.rpartition("/")[0] for file in frame.inputFiles()}:
            remove_path(frame.sparkSession, folder)


def named(name):
    """A column by its whole name, dots and backquotes included."""
    return F.col("`" + name.replace("`", "``") + "`")


def whole_row(docs):
    """All columns of a row as a struct, whatever their names."""
    return F.struct(*[named(c) for c in docs.columns])


def numbered(docs):
    """The rows with columns c0, c1, ... instead of names that an operator could use too."""
    return docs.toDF(*[f"c{n}" for n in range(len(docs.columns))])


def plain_text(column="text"):
    """A null text counts as empty."""
    return F.coalesce(named(column).cast("string"), F.lit(""))


def row_key(number, text):
    """128 bits that equal those of another row only where id and text are the same; a
    null id differs from every other."""
    number = number.cast("string")
    return F.unhex(F.md5(F.concat(
        F.coalesce(F.length(number).cast("string"), F.lit("-")), F.lit(":"),
        F.coalesce(number, F.lit("")), F.lit(":"), text)))


def pieces(batches, text=1, chars=1_000_000):
    """Cut Arrow batches so that a piece holds about `chars` bytes of text or one row.

    Bounds what a Python worker holds at once, however long the texts are; what Arrow
    keeps for reuse goes back after each batch.
    """
    import pyarrow as pa
    import pyarrow.compute as pc

    for batch in batches:
        ends = pc.cumulative_sum(
            pc.fill_null(pc.binary_length(batch.column(text)), 0).cast("int64")
        ).to_numpy(zero_copy_only=False)
        start = 0
        while start < batch.num_rows:
            done = int(ends[start - 1]) if start else 0
            stop = max(start + 1, int(ends.searchsorted(done + chars, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
        pa.default_memory_pool().release_unused()
