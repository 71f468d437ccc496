"""Sharding by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a table with a prime
number of slots: it starts at an offset and goes on by a skip, both from the MD5 of
its name. Shards take turns; at its turn a shard claims the first slot of its order
that is still free. Every shard ends with the same number of slots, give or take
one, and adding or removing a shard moves few keys between the others. A key is
placed by one hash and one lookup in the table, which has a fixed size and is
broadcast.
"""

import hashlib

from pyspark.sql import functions as F

from wavelode.llm.common import named

# Production parameters of the registered query.
SHARDS = 32
SLOTS = 4093

def _is_prime(number):
    return number > 1 and all(number % d for d in range(2, int(number**0.5) + 1))


def _number(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16)


def filled_slots(shards=SHARDS, slots=SLOTS):
    """The shard of each slot. It follows from the two numbers alone, and the turns take
    about slots * log(slots) steps."""
    if not _is_prime(slots):
        raise ValueError(f"the number of slots must be prime: {slots}")
    if not 0 < shards <= min(slots, 65536):
        raise ValueError(f"from 1 to {min(slots, 65536)} shards fit {slots} slots: {shards}")
    at = [_number(f"shard-{i}:offset") % slots for i in range(shards)]
    skips = [_number(f"shard-{i}:skip") % (slots - 1) + 1 for i in range(shards)]
    table = [-1] * slots
    for turn in range(slots):
        shard = turn % shards
        slot, skip = at[shard], skips[shard]
        while table[slot] >= 0:  # the skip meets every slot before it comes back
            slot = (slot + skip) % slots
        table[slot] = shard
        at[shard] = (slot + skip) % slots
    return table


def lookup_table(spark, shards=SHARDS, slots=SLOTS):
    """The filled table as rows (slot, shard): two bytes for each slot in the plan."""
    filled = b"".join(shard.to_bytes(2, "big") for shard in filled_slots(shards, slots))
    read = f"""
        transform(sequence(0, {slots - 1}),
            j -> cast(conv(hex(substring(filled, 2 * j + 1, 2)), 16, 10) as int))"""
    return (
        spark.range(1).select(F.lit(bytearray(filled)).alias("filled"))
        .select(F.posexplode(F.expr(read)).alias("slot", "shard"))
    )


def slot_of(key, slots=SLOTS):
    """The slot of a key column; a null key takes the slot of the empty text."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    number = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return (number % slots).cast("int")


def place(frame, key, shards=SHARDS, slots=SLOTS):
    """Add `slot` and `shard` to every row; equal keys share a shard.

    Null keys go where the empty text goes. Columns already called slot or shard
    are replaced. An empty table stays empty.
    """
    table = F.broadcast(lookup_table(frame.sparkSession, shards, slots))
    rows = frame.withColumn("slot", slot_of(named(key), slots)).drop("shard")
    return rows.join(table, "slot")


def write_shards(frame, key, path, shards=SHARDS, slots=SLOTS, files_per_shard=16):
    """Write one folder per shard.

    A shard's rows are dealt over `files_per_shard` tasks by the hash of the row, so that
    no shard has to pass through one task; equal rows go to one file. Null keys go where
    the empty text goes, other columns may be null, and an empty table writes no folder.
    """
    placed = place(frame, key, shards, slots)
    salt = F.pmod(F.xxhash64(*[named(c) for c in frame.columns]), F.lit(files_per_shard))
    placed.withColumn("_salt", salt).repartition(
        shards * files_per_shard, "shard", "_salt"
    ).drop("_salt", "slot").write.partitionBy("shard").parquet(path)
