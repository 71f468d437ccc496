"""Clustering around centroids by a tournament of bisectors.

For centroids a and b the points with 2(b - a)x > |b|^2 - |a|^2 are nearer to b. These
normals and thresholds are integers and are worked out once for each pair. A vector
starts with centroid 0 and meets the others in turn: the sign of one linear test says who
stays, zero favours the smaller number, so k - 1 tests find the nearest centroid and only
its distance is ever computed. All arithmetic is exact.

Vectors stay where the scan puts them. A round shuffles sums only, one row for each
cluster, component and task.
"""

import hashlib
from decimal import Decimal

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wavelode.llm.common import named

DIMENSIONS = 64
SCALE = 64
CLUSTERS = 16
ROUNDS = 3
SEED = 1

_ROWS = 2048  # vectors that meet a centroid at once
_SAFE = 1 << 26  # sums of products of up to 64 smaller components fit 64 bits
_LIMB = 40  # sums travel as two numbers, of their low 40 bits and of the rest
_LARGEST = 1 << 63


def whole_numbers(vectors, scale=SCALE):
    """floor(scale * x) of every component; as Python integers where 64 bits would not
    hold their products."""
    scaled = np.floor(vectors * scale)
    if not len(scaled) or np.abs(scaled).max() < _SAFE:
        return scaled.astype(np.int64)
    return np.array([[int(x) for x in row] for row in scaled.tolist()], dtype=object)


class Bisectors:
    """Normals and thresholds of all pairs of centroids."""

    def __init__(self, centroids):
        small = max(abs(x) for c in centroids for x in c) < _SAFE
        self.centroids = np.array(centroids, dtype=np.int64 if small else object)
        norms = (self.centroids * self.centroids).sum(axis=1)
        self.normals = 2 * (self.centroids[None] - self.centroids[:, None])
        self.thresholds = norms[None] - norms[:, None]

    def nearest(self, vectors):
        """(number of the nearest centroid, squared distance) of each vector."""
        best = np.zeros(len(vectors), np.int64)
        for rival in range(1, len(self.centroids)):
            side = (vectors * self.normals[best, rival]).sum(axis=1)
            best[(side > self.thresholds[best, rival]).astype(bool)] = rival
        apart = vectors - self.centroids[best]
        return best, (apart * apart).sum(axis=1)


def _batches(batches, dimensions, scale):
    """(ids, whole numbers) of a bounded number of vectors each."""
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            part = batch.slice(at, _ROWS)
            flat = part.column(1).flatten().to_numpy(zero_copy_only=False)
            yield part.column(0), whole_numbers(flat.reshape(-1, dimensions), scale)


def _kept(vectors, id_col, vector_col, dimensions, scale):
    """(id, vector) of the rows with `dimensions` finite components; a scaled component of
    2^150 or more, which no float has, counts as infinite."""
    vector = named(vector_col).cast("array<double>")
    good = F.forall(vector, lambda x: F.coalesce(F.abs(x * scale) < 2.0 ** 150, F.lit(False)))
    rows = vectors.select(named(id_col).alias("id"), vector.alias("vector"))
    # NaN is above every number, so the comparison drops it too.
    return rows.where((F.size(vector) == dimensions) & good)


def first_centroids(rows, clusters=CLUSTERS, seed=SEED, scale=SCALE):
    """Whole numbers of the vectors with the smallest hashes of their ids."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    found = rows.select(F.sha2(text, 256).alias("hash"), "vector").orderBy(
        "hash", "vector").limit(clusters).collect()
    return [[int(x) for x in np.floor(np.array(r.vector) * scale).tolist()] for r in found]


def _totals(rows, centroids, dimensions, scale):
    """{(cluster, component): (vectors, sum)}; the distances are summed as a last component."""
    rivals = Bisectors(centroids)
    amount = T.DecimalType(38, 0)
    schema = T.StructType([
        T.StructField("cluster", T.IntegerType()), T.StructField("component", T.IntegerType()),
        T.StructField("n", T.LongType()), T.StructField("low", amount),
        T.StructField("high", amount)])

    def run(batches):
        import pyarrow as pa

        from pyspark.sql.pandas.types import to_arrow_schema

        sums = {}
        for _, vectors in _batches(batches, dimensions, scale):
            best, apart = rivals.nearest(vectors)
            for cluster in np.unique(best).tolist():
                mine = best == cluster
                count, total = sums.get(cluster, (0, [0] * (dimensions + 1)))
                found = [*vectors[mine].sum(axis=0).tolist(), sum(apart[mine].tolist())]
                sums[cluster] = (count + int(mine.sum()), [a + b for a, b in zip(total, found)])
        for _, total in sums.values():  # a sum of distances beyond 64 bits stays beyond
            total[-1] = min(total[-1], _LARGEST)
        low = (1 << _LIMB) - 1
        out = [(cluster, c, count, Decimal(x & low), Decimal(x >> _LIMB))
               for cluster, (count, total) in sums.items() for c, x in enumerate(total)]
        target = to_arrow_schema(schema)
        columns = list(zip(*out)) or [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, target)], schema=target)

    found = rows.select("id", "vector").mapInArrow(run, schema).groupBy(
        "cluster", "component").agg(F.sum("n"), F.sum("low"), F.sum("high"))
    return {(r[0], r[1]): (r[2], (int(r[4]) << _LIMB) + int(r[3])) for r in found.collect()}


def cluster_vectors(vectors, id_col="vec_id", vector_col="embedding", clusters=CLUSTERS,
                    rounds=ROUNDS, seed=SEED, dimensions=DIMENSIONS, scale=SCALE):
    """`id_col`, cluster, distance (squared, to its centroid), cluster_inertia and inertia
    (distances summed over the cluster and over all) and centroid_sha256 (of the centroid's
    components, joined by commas) for each vector that is kept.

    Kept are vectors of `dimensions` components, none null, NaN or infinite; components
    become floor(scale * x). The first centroids are the kept vectors with the smallest
    sha256 of `seed:id`, equal ids by their components; a null id counts as empty text.
    In each round every centroid that has vectors becomes the floor of their mean. With
    fewer vectors than clusters each of them is a first centroid. Rows may repeat and
    other columns are not read. An empty table, or one without kept vectors, gives no
    rows. A distance or sum that does not fit 64 bits is null.

    The driver holds sums for each cluster and component; normals grow with the square of
    the number of clusters.
    """
    rows = _kept(vectors, id_col, vector_col, dimensions, scale)
    schema = T.StructType([
        vectors.schema[id_col], T.StructField("cluster", T.IntegerType()),
        T.StructField("distance", T.LongType()), T.StructField("cluster_inertia", T.LongType()),
        T.StructField("inertia", T.LongType()), T.StructField("centroid_sha256", T.StringType())])
    centroids = first_centroids(rows, clusters, seed, scale)
    if not centroids:
        return vectors.sparkSession.createDataFrame([], schema)
    for _ in range(rounds):
        totals = _totals(rows, centroids, dimensions, scale)
        centroids = [
            [totals[j, c][1] // totals[j, c][0] for c in range(dimensions)]
            if (j, 0) in totals else centroid for j, centroid in enumerate(centroids)]
    totals = _totals(rows, centroids, dimensions, scale)
    sums = {j: total for (j, c), (_, total) in totals.items() if c == dimensions}

    def fits(number):
        return number if number < _LARGEST else None

    inertia = fits(sum(sums.values()))
    within = [fits(sums.get(j, 0)) for j in range(len(centroids))]
    hashes = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    rivals = Bisectors(centroids)

    def run(batches):
        import pyarrow as pa

        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)
        for ids, found in _batches(batches, dimensions, scale):
            best, apart = rivals.nearest(found)
            columns = [best, [fits(d) for d in apart.tolist()], [within[j] for j in best],
                       [inertia] * len(best), [hashes[j] for j in best]]
            yield pa.RecordBatch.from_arrays(
                [ids.cast(target.field(0).type),
                 *[pa.array(c, f.type) for c, f in zip(columns, list(target)[1:])]],
                schema=target)

    return rows.select("id", "vector").mapInArrow(run, schema)
