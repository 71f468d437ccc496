"""Key hashes that do not depend on how rows are partitioned."""

from pyspark.sql import functions as F


def hash_value(keys, seed=0, method="xxhash64"):
    """Non-negative hash of the key columns.

    ``md5`` gives the same number in any engine with that function;
    ``xxhash64`` is several times cheaper and the default.
    """
    columns = [F.col(k) if isinstance(k, str) else k for k in keys]
    if method == "xxhash64":
        return F.shiftrightunsigned(F.xxhash64(*columns, F.lit(seed)), 1)
    if method == "md5":
        text = F.concat_ws(":", F.lit(str(seed)), *[c.cast("string") for c in columns])
        return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    raise ValueError(f"unknown hash method: {method}")


def hash_bucket(keys, buckets, seed=0, method="xxhash64"):
    return F.pmod(hash_value(keys, seed, method), F.lit(buckets)).cast("int")
