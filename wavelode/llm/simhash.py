"""Near-duplicates by SimHash fingerprints and BK-trees.

A BK-tree holds fingerprints; the children of a node are keyed by their Hamming
distance to it, and a search within a radius follows only the edges whose key lies
within the radius of the distance to the node.

The trees are sharded: fingerprints of 64 bits in BLOCKS blocks that differ in at most
`distance` bits agree on BLOCKS - distance blocks at least, so every fingerprint goes to
one shard for each choice of that many blocks, and every link is found in a shard that
both ends share. A shard's tree is built and searched where the shuffle puts the shard.
It is not broadcast, as all trees together grow with the input. A shard with more
members than SHARD_ROWS is split into parts, and each pair of parts is searched on its
own. A shard reports a star for each connected group in it, not all its links.
"""

from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wavelode.llm.common import named, pieces, plain_text, stored, whole_row
from wavelode.llm.components import connected_components

SHINGLE = 3
DISTANCE = 3
SEED = 42
BITS = 64
# With five blocks and distance 3 a shard is named by two blocks, 25 or 26 bits.
BLOCKS = 5
SHARD_ROWS = 4096


def shingle_hashes(text, shingle=SHINGLE):
    """XXH64 of each run of words; of the whole sequence where words are fewer."""
    # Bytes are lowered and split as ASCII, whatever the locale.
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return []
    digest = xxhash.xxh64_intdigest
    joined = b" ".join(words)
    if len(words) < shingle:
        return [digest(joined, SEED)]
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths)
    starts = ends - lengths
    count = len(words) - shingle + 1
    return [digest(joined[a:b], SEED)
            for a, b in zip(starts[:count].tolist(), (ends[shingle - 1:] - 1).tolist())]


def fingerprints(texts, shingle=SHINGLE):
    """The SimHash of each text as a signed 64-bit integer; zero for no words."""
    hashes = [shingle_hashes(t, shingle) for t in texts]
    out = np.zeros(len(texts), np.uint64)
    filled = [n for n, h in enumerate(hashes) if h]
    if filled:
        lengths = np.array([len(hashes[n]) for n in filled])
        flat = np.array([h for n in filled for h in hashes[n]], "<u8")
        bits = np.unpackbits(flat.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        ones = np.add.reduceat(bits, starts, axis=0, dtype=np.int64)
        major = np.packbits(ones * 2 > lengths[:, None], axis=1, bitorder="little")
        out[filled] = major.view("<u8")[:, 0]
    return out.astype(np.int64)


class Tree:
    """A BK-tree over integers: nodes as [value, {distance: node}]."""

    def __init__(self):
        self.root = None

    def insert(self, value):
        if self.root is None:
            self.root = [value, {}]
            return
        node = self.root
        while True:
            distance = (node[0] ^ value).bit_count()
            if not distance:
                return
            child = node[1].get(distance)
            if child is None:
                node[1][distance] = [value, {}]
                return
            node = child

    def near(self, value, radius):
        """All members within the radius."""
        found, open_nodes = [], [self.root] if self.root else []
        while open_nodes:
            member, children = open_nodes.pop()
            distance = (member ^ value).bit_count()
            if distance <= radius:
                found.append(member)
            if children:
                if len(children) <= 2 * radius:
                    open_nodes.extend(
                        c for d, c in children.items() if -radius <= d - distance <= radius)
                else:
                    open_nodes.extend(
                        children[d] for d in range(distance - radius, distance + radius + 1)
                        if d in children)
        return found


def shard_links(members, queries, radius):
    """Links from every value to the smallest one that it is connected with, where values
    within the radius are connected: all members, if queries is None, else queries with
    members only."""
    parent = {}

    def top(value):
        while parent.setdefault(value, value) != value:
            parent[value] = parent[parent[value]]
            value = parent[value]
        return value

    def join(value, found):
        for other in found:
            a, b = sorted((top(value), top(other)))
            parent[b] = a

    tree = Tree()
    for value in members:
        if queries is None:
            join(value, tree.near(value, radius))
        tree.insert(value)
    for value in queries or ():
        join(value, tree.near(value, radius))
    return [(value, top(value)) for value in parent if top(value) != value]


def block_masks(blocks=BLOCKS, distance=DISTANCE):
    """Masks of the bits that name a shard, for each choice of blocks."""
    edges = [round(n * BITS / blocks) for n in range(blocks + 1)]
    parts = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    masks = [sum(chosen) for chosen in combinations(parts, blocks - distance)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def _search(distance):
    """Search shards that come sorted by (choice, name, a, b, side); a shard that spans
    batches is carried over."""

    def run(batches):
        import pyarrow as pa

        shard, sides = None, ([], [])
        links = []

        def close():
            if shard is not None and sum(map(len, sides)) > 1:
                a, b = shard[2:]
                links.extend(shard_links(sides[0], sides[1] if a != b else None, distance))

        for batch in batches:
            choice, name, a, b, side, prints = (
                c.to_numpy(zero_copy_only=False) for c in batch.columns)
            new = np.ones(len(name), bool)
            for column in (choice, name, a, b):
                new[1:] &= column[1:] == column[:-1]
            new[1:] = ~new[1:]
            starts = np.flatnonzero(new).tolist()
            values = prints.astype(np.int64).view(np.uint64).tolist()
            for start, stop in zip(starts, [*starts[1:], len(name)]):
                key = choice[start], name[start], a[start], b[start]
                if key != shard:
                    close()
                    shard, sides = key, ([], [])
                for which, value in zip(side[start:stop].tolist(), values[start:stop]):
                    sides[which].append(value)
            if len(links) > 50_000:
                yield _links(pa, links)
                links.clear()
        close()
        yield _links(pa, links)

    return run


def _links(pa, links):
    ends = np.array(links, np.uint64).reshape(-1, 2).astype(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], names=["u", "v"])


def fingerprint_links(prints, distance=DISTANCE, blocks=BLOCKS, shard_rows=SHARD_ROWS):
    """Links (u, v) between distinct fingerprints in column `print` that connect exactly
    what steps within the distance connect."""
    masks = F.array(*[F.lit(m) for m in block_masks(blocks, distance)])
    rows = prints.select("print", F.posexplode(masks).alias("choice", "mask")).select(
        "choice", F.col("print").bitwiseAND(F.col("mask")).alias("name"), "print")
    rows = stored(rows, "shard-rows")
    sizes = stored(
        rows.groupBy("choice", "name").agg(F.count(F.lit(1)).alias("n")).where("n > 1"),
        "shard-sizes",
    )
    rows = rows.join(sizes, ["choice", "name"])
    # Part p of a split shard meets every part from p on as members and every part up
    # to p as queries.
    parts = F.ceil(F.col("n") / shard_rows).cast("int")
    rows = rows.withColumn("parts", parts).withColumn(
        "part", F.pmod(F.xxhash64("print"), F.col("parts")).cast("int"))
    pairs = F.expr("""
        concat(
            transform(sequence(part, parts - 1), p -> named_struct('side', 0, 'a', part, 'b', p)),
            if(part > 0, transform(sequence(0, part - 1),
                                   p -> named_struct('side', 1, 'a', p, 'b', part)),
               cast(array() as array<struct<side: int, a: int, b: int>>)))""")
    units = rows.select("choice", "name", F.explode(pairs).alias("pair"), "print").select(
        "choice", "name", "pair.side", "pair.a", "pair.b", "print")
    placed = units.repartition("choice", "name", "a", "b").sortWithinPartitions(
        "choice", "name", "a", "b", "side", "print")
    return placed.mapInArrow(_search(distance), "u bigint, v bigint")


def near_duplicates(docs, id_col="doc_id", text_col="text", shingle=SHINGLE, distance=DISTANCE):
    """`id_col`, fingerprint (16 hexadecimal digits) and component_id for every row.

    Rows whose fingerprints differ in at most `distance` bits are linked; component_id
    is the smallest id reachable over links, the row's own included. Ids may be of any
    type with an order; null ids are passed over by the minimum, so component_id is null
    only where no linked row has an id.

    A null or empty text, or one without words, has fingerprint zero and links like any
    other. Rows may repeat. Other columns are not read. An empty table gives no rows.
    """
    schema = T.StructType([docs.schema[id_col], T.StructField("print", T.LongType())])

    def run(batches):
        import pyarrow as pa

        for piece in pieces(batches):
            found = fingerprints(piece.column(1).to_pylist(), shingle)
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(found)],
                                             names=schema.names)

    texts = docs.select(id_col, plain_text(text_col).alias("_text"))
    rows = stored(
        texts.mapInArrow(run, schema).select(F.col(id_col).alias("id"), "print"), "simhash")
    prints = stored(rows.groupBy("print").agg(F.min("id").alias("least")), "prints")
    nodes = connected_components(fingerprint_links(prints.select("print"), distance))
    # Of linked fingerprints the smallest id of the component, of others their own.
    linked = stored(
        nodes.join(prints, nodes["node"] == prints["print"])
        .select("print", "least", "component"),
        "linked",
    )
    named = stored(linked.groupBy("component").agg(F.min("least").alias("component_id")), "named")
    by_print = stored(
        linked.join(named, "component").select("print", "component_id").unionByName(
            prints.join(linked.select("print"), "print", "left_anti")
            .select("print", F.col("least").alias("component_id"))),
        "by-print",
    )
    return rows.join(by_print, "print").select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs, id_col="doc_id", text_col="text", shingle=SHINGLE, distance=DISTANCE):
    """One row of each group of linked rows, with all its columns: the one with the
    smallest id (null first), then the smallest hash of its text. Rows that repeat both
    stay once."""
    key = F.struct(named(id_col).alias("id"), F.md5(plain_text(text_col)).alias("hash"))
    rows = docs.select(whole_row(docs).alias("row"), key.alias("key"),
                       plain_text(text_col).alias("text"))
    found = near_duplicates(rows, "key", "text", shingle, distance)
    stay = stored(
        found.where(F.col("key").eqNullSafe(F.col("component_id"))).select("key").distinct(),
        "stay",
    )
    same = F.col("id").eqNullSafe(F.col("stay_id")) & (F.col("hash") == F.col("stay_hash"))
    stay = stay.select(F.col("key.id").alias("stay_id"), F.col("key.hash").alias("stay_hash"))
    rows = rows.select("row", "key.id", "key.hash")
    # Each (id, hash) has few rows: those that repeat the whole id and text.
    kept = rows.join(stay, same, "left_semi").groupBy("id", "hash").agg(F.first("row").alias("row"))
    return kept.select("row.*")
