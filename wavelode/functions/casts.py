"""Lenient text conversions: a bad value becomes null, never an error."""

from pyspark.sql import functions as F

# Decimal or scientific notation, or one of the spelled-out specials. Rejects
# the type suffixes ("1.5d") that a plain cast would accept.
_NUMBER = (
    r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf(inity)?))\s*$"
    r"|^\s*(?i:nan)\s*$"
)


def _column(c):
    return F.col(c) if isinstance(c, str) else c


def lenient_double(c):
    c = _column(c)
    return F.when(c.rlike(_NUMBER), c.try_cast("double"))


def lenient_int(c):
    """Truncates toward zero; NaN and out-of-range values become null."""
    return lenient_double(c).try_cast("int")


def lenient_bool(c):
    """True for the word "true" in any case, false for everything else."""
    return F.coalesce(F.lower(_column(c)) == "true", F.lit(False))


def flag_int(c):
    """Boolean to 0/1 with null as 0."""
    return F.when(_column(c), 1).otherwise(0)


def event_timestamp(c):
    return F.try_to_timestamp(_column(c))


def nan_to_null(c):
    """Statistics treat NaN as missing."""
    c = _column(c).cast("double")
    return F.when(~F.isnan(c), c)
