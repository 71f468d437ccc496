"""Exact duplicates by progressive refinement: length, prefix hash, full hash.

Each step groups on something cheaper than the next one and hands on a sieve, a
bitmap of the groups that still hold two rows or more. The sieve has a fixed number
of bits, so it can be broadcast at any input size, and texts never leave their scan:
only lengths, prefix hashes and full hashes are shuffled. A crowded sieve lets unique
texts through to the next step, which costs time and never changes the result: the
SHA-256 of the whole text decides.
"""

from pyspark.sql import functions as F

from wavelode.llm.common import plain_text, stored

PREFIX_CHARS = 64
# Fixed size of a sieve: 2^23 bits are 256 rows of 4 KiB, 1 MiB broadcast.
SIEVE_BITS = 1 << 23
_ROW_BITS = 32768  # bits of one row that bitmap_construct_agg makes


def _slot(key, bits):
    return F.pmod(F.xxhash64(*key), F.lit(bits)) + 1


def build_sieve(groups, key, bits):
    """Bitmap rows of the given groups' slots: at most bits / 32768 rows."""
    slot = groups.select(_slot(key, bits).alias("slot"))
    return slot.groupBy(F.bitmap_bucket_number("slot").alias("sieve_row")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("sieve_bits")
    )


def sift(rows, sieve, key, bits, flag):
    """Add a boolean column: may the row's group hold another row?"""
    marked = rows.withColumn("_slot", _slot(key, bits))
    marked = marked.withColumn("sieve_row", F.bitmap_bucket_number("_slot"))
    place = F.bitmap_bit_position("_slot")
    byte = F.expr("substring(sieve_bits, cast(_place div 8 as int) + 1, 1)")
    bit = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (F.col("_place") % 8).cast("int"))
    return (
        marked.withColumn("_place", place)
        .join(F.broadcast(sieve), "sieve_row", "left")
        .withColumn(flag, F.coalesce(bit == 1, F.lit(False)))
        .drop("_slot", "_place", "sieve_row", "sieve_bits")
    )


def _repeated(rows, key):
    return rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")


def exact_duplicates(docs, id_col="doc_id", text_col="text", prefix_chars=PREFIX_CHARS,
                     sieve_bits=SIEVE_BITS, digest_all=False):
    """Group equal texts; of each group the row with the largest id stays.

    One row per input row: `id_col`, keep_id (id of the row that stays), group_size,
    kept, text_sha256. The hash is null for a text shown to be unique before the
    last step, unless `digest_all` asks for it.

    A null text counts as empty, and empty texts equal one another. A null id is
    smaller than any other. Rows that repeat both id and text are one group and
    exactly one of them is kept. Only the two named columns are read, so further
    columns may have any names. An empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("_id"), plain_text(text_col).alias("_text"))
    rows = rows.withColumn("_length", F.length("_text"))

    by_length = _repeated(rows.select("_length"), ["_length"])
    length_sieve = stored(build_sieve(by_length, ["_length"], sieve_bits), "length-sieve")

    rows = sift(rows, length_sieve, ["_length"], sieve_bits, "_same_length")
    prefix_key = ["_length", "_prefix"]
    rows = rows.withColumn(
        "_prefix", F.when(F.col("_same_length"), F.xxhash64(F.substring("_text", 1, prefix_chars)))
    )
    by_prefix = _repeated(rows.where("_same_length").select(*prefix_key), prefix_key)
    prefix_sieve = stored(build_sieve(by_prefix, prefix_key, sieve_bits), "prefix-sieve")

    rows = sift(rows, prefix_sieve, prefix_key, sieve_bits, "_same_prefix")
    wanted = F.col("_same_length") & F.col("_same_prefix")
    digest = F.unhex(F.sha2("_text", 256))
    # The tag tells rows apart that repeat both id and text; writing the rows fixes it.
    hashed = stored(
        rows.select(
            "_id", wanted.alias("_open"),
            (digest if digest_all else F.when(wanted, digest)).alias("_hash"),
            F.monotonically_increasing_id().alias("_tag"),
        ),
        "text-hashes",
    )

    rest = hashed.where("_open")
    groups = stored(
        rest.groupBy("_hash").agg(
            F.count(F.lit(1)).alias("group_size"),
            F.max(F.struct("_id", "_tag")).alias("_keep"),
        ),
        "text-groups",
    )
    # Row by row against its group: no window, so a huge group is never in one task.
    # Both sides are scans, which lets the adaptive join split the rows of a hot hash.
    found = rest.join(groups, "_hash").select(
        "_id", F.col("_keep._id").alias("keep_id"), "group_size",
        (F.col("_tag") == F.col("_keep._tag")).alias("kept"), "_hash",
    )
    alone = hashed.where(~F.col("_open")).select(
        "_id", F.col("_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"),
        F.lit(True).alias("kept"), "_hash",
    )
    return found.unionByName(alone).select(
        F.col("_id").alias(id_col), "keep_id", "group_size", "kept",
        F.lower(F.hex("_hash")).alias("text_sha256"),
    )
