"""Networks that learn from all rows of a table.

Rows are dealt to shards. In each round every shard trains on its own from the same
weights, and the means of what the shards found are the weights of the next round. Each
weight's mean is over the shards that had rows for it, so that rare words learn as fast as
common ones. Weights travel as rows of COLUMNS numbers; the driver holds one model.
"""

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wavelode.llm.common import tidy

COLUMNS = 8
# A shard with more characters than these trains in several parts.
SHARD_CHARS = 1 << 26


def dealt(rows, shards, order):
    """`rows` with their shard, so many at most, each shard together and in order."""
    shard = F.pmod(F.xxhash64(F.lit(1), *order), F.lit(shards)).cast("int")
    return rows.withColumn("shard", shard).repartitionById(
        shards, "shard").sortWithinPartitions("shard", *order)


def parts(pieces, text):
    """Lists of rows of one shard from Arrow batches that hold shard after shard."""
    held, chars = [], 0
    for piece in pieces:
        for row in piece.to_pylist():
            if held and (row["shard"] != held[0]["shard"] or chars >= SHARD_CHARS):
                yield held
                held, chars = [], 0
            held.append(row)
            chars += len(row[text])
    if held:
        yield held


def flat(weights):
    """All weights as one table of COLUMNS numbers, by name, each name from a new row."""
    found = []
    for value in weights.values():
        value = value.ravel()
        found.append(np.pad(value, (0, -len(value) % COLUMNS)).reshape(-1, COLUMNS))
    return np.concatenate(found)


def unflat(table, like):
    """Weights by name, shaped as in `like`."""
    found, at = {}, 0
    for name, value in like.items():
        size = -(-value.size // COLUMNS)
        found[name] = table[at:at + size].ravel()[:value.size].reshape(value.shape).astype(
            value.dtype)
        at += size
    return found


_NUMBERS = [f"{kind}{n}" for kind in "vs" for n in range(COLUMNS)]
_SCHEMA = T.StructType([T.StructField("row", T.IntegerType())] + [
    T.StructField(name, T.FloatType()) for name in _NUMBERS])


def train_round(rows, model, state, fit, read):
    """Weights and their training state after one round over all `rows`.

    `read` makes parts from Arrow batches; `fit` trains (model, state) on a part in place
    and returns the rows of the flat weights that it may have changed, or None if it
    has nothing to train on.
    """
    shared = rows.sparkSession.sparkContext.broadcast((model, state))

    def run(batches):
        import pyarrow as pa

        for part in read(batches):
            own = [{k: v.copy() for k, v in weights.items()} for weights in shared.value]
            touched = fit(*own, part)
            if touched is not None:
                numbers = np.hstack([flat(weights)[touched] for weights in own])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(touched, pa.int32())]
                    + [pa.array(column, pa.float32()) for column in numbers.T],
                    names=_SCHEMA.names)

    with tidy(rows.sparkSession):
        means = rows.mapInArrow(run, _SCHEMA).groupBy("row").agg(
            *[F.avg(name).alias(name) for name in _NUMBERS]).toArrow()
    shared.destroy()
    numbers = np.stack([means.column(name).to_numpy() for name in _NUMBERS], axis=1)
    found, at = [], means.column("row").to_numpy()
    for weights, columns in ((model, numbers[:, :COLUMNS]), (state, numbers[:, COLUMNS:])):
        table = flat(weights)
        table[at] = columns
        found.append(unflat(table, weights))
    return found
