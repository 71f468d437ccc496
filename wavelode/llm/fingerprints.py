"""Document fingerprints by winnowing.

Every k characters of a text have a rolling hash; of each window of w neighbouring
hashes the smallest is kept, the rightmost where several are equal, with its position.
Two texts that share k + w - 1 characters in a row share a kept hash, and nothing
shorter than k characters can match.

Texts are hashed many at a time in numpy. A polynomial hash of 2n characters is made
from two of n, so k is a power of two; window minima are made by doubling as well.
"""

import hashlib
from bisect import bisect_right

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wavelode.llm.common import pieces, plain_text

GRAM = 8
WINDOW = 8
HASH_BITS = 40  # of a kept hash; ten hexadecimal digits
# Positions that are handled as one array; longer texts go in overlapping parts.
PART = 1 << 22

_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xD6E8FEB86659FD93)
_LOW = 64 - HASH_BITS


def code_points(text):
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def gram_hashes(points, gram):
    """Hash of each run of `gram` code points, in HASH_BITS bits."""
    values = (points.astype(np.uint64) + np.uint64(1)) * _MIX
    values ^= values >> np.uint64(29)
    width, base = 1, _BASE
    while width < gram:
        values = values[:-width] * np.uint64(base) + values[width:]
        base = base * base % 2**64
        width *= 2
    values ^= values >> np.uint64(32)
    values *= _MIX
    return values >> np.uint64(_LOW)


def window_minima(values, window):
    """Positions of the minima of all windows, the rightmost of equal ones, in order."""
    count = len(values)
    position = np.arange(count, dtype=np.uint64)
    keys = (values << np.uint64(_LOW)) | (np.uint64((1 << _LOW) - 1) - position)
    width, least = 1, keys
    window = min(window, count)
    while width * 2 <= window:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < window:
        least = np.minimum(least[:width - window], least[window - width:])
    return least


def _kept(least):
    """Positions out of window minima: neighbouring windows mostly share theirs."""
    change = np.empty(len(least), bool)
    change[:1] = True
    np.not_equal(least[1:], least[:-1], out=change[1:])
    return np.uint64((1 << _LOW) - 1) - (least[change] & np.uint64((1 << _LOW) - 1))


def winnow(points, gram=GRAM, window=WINDOW):
    """(hashes, positions) of one text. A text shorter than k is one gram of its own;
    one with fewer than w grams is one window; an empty text has no fingerprint."""
    if not len(points):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    if len(points) < gram:
        padded = np.concatenate((points, np.zeros(gram - len(points), points.dtype)))
        return gram_hashes(padded, gram), np.zeros(1, np.int64)
    found = []
    step = PART - (window + gram - 2)
    for start in range(0, max(1, len(points) - (window + gram - 2)), step):
        values = gram_hashes(points[start:start + PART], gram)
        at = _kept(window_minima(values, window)).astype(np.int64)
        found.append((values[at], at + start))
    positions, first = np.unique(np.concatenate([p for _, p in found]), return_index=True)
    return np.concatenate([h for h, _ in found])[first], positions


def winnow_many(texts, gram=GRAM, window=WINDOW):
    """(hashes, positions) of each text; texts of usual length share their arrays."""
    out = [None] * len(texts)
    short = gram + window - 1
    batch, size = [], 0

    def flush():
        nonlocal batch, size
        if not batch:
            return
        points = code_points("".join(texts[n] for n in batch))
        lengths = np.array([len(texts[n]) for n in batch])
        starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        values = gram_hashes(points, gram)
        least = window_minima(values, window)
        low = np.uint64((1 << _LOW) - 1)
        for n, start, length in zip(batch, starts.tolist(), lengths.tolist()):
            at = _kept(least[start:start + length - short + 1]).astype(np.int64)
            out[n] = (values[at], at - start)
        batch, size = [], 0

    for n, text in enumerate(texts):
        if len(text) < short or len(text) >= PART // 4:
            out[n] = winnow(code_points(text), gram, window)
            continue
        if size + len(text) >= PART // 4:
            flush()
        batch.append(n)
        size += len(text)
    flush()
    return out


def hash_text(hashes):
    """Hashes as text: ten hexadecimal digits each, joined by commas."""
    if not len(hashes):
        return ""
    digits = HASH_BITS // 8
    return hashes.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - digits:].tobytes().hex(",", digits)


def likeness(one, other):
    """Jaccard measure of two sets of hashes; two empty ones are alike."""
    if not one and not other:
        return 1.0
    shared = len(one & other)
    return shared / (len(one) + len(other) - shared)


def fingerprint_documents(docs, id_col="doc_id", text_col="text", gram=GRAM, window=WINDOW):
    """`id_col`, fingerprint (hashes joined by commas, in text order) and positions.

    A null or empty text has an empty fingerprint. One row per input row; ids may be
    null or repeat; other columns are not read.
    """
    schema = T.StructType([
        docs.schema[id_col], T.StructField("fingerprint", T.StringType()),
        T.StructField("positions", T.ArrayType(T.LongType())),
    ])

    def run(batches):
        import pyarrow as pa

        for piece in pieces(batches):
            found = winnow_many(piece.column(1).to_pylist(), gram, window)
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), pa.array([hash_text(h) for h, _ in found]),
                 pa.array([p for _, p in found], pa.list_(pa.int64()))],
                names=schema.names)

    return docs.select(id_col, plain_text(text_col).alias("_text")).mapInArrow(run, schema)


def edited_text(text, following):
    """The last quarter replaced by as many characters from the next text's start."""
    tail = len(text) // 4
    return text[:len(text) - tail] + following[:tail]


_COMPARED = [
    T.StructField("n_chars", T.LongType()), T.StructField("edited_sha256", T.StringType()),
    T.StructField("fingerprint", T.StringType()),
    T.StructField("edited_fingerprint", T.StringType()),
    T.StructField("near_edited", T.DoubleType()), T.StructField("near_next", T.DoubleType()),
    T.StructField("positions", T.ArrayType(T.LongType())),
]


def _compare(texts, pairs, gram, window):
    """Columns of _COMPARED for pairs (number of a text, number of the next one)."""
    prints = winnow_many(texts, gram, window)
    sets = [set(h.tolist()) for h, _ in prints]
    edited = [edited_text(texts[a], texts[b]) for a, b in pairs]
    changed = winnow_many(edited, gram, window)
    return [
        [len(texts[a]) for a, _ in pairs],
        [hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest() for e in edited],
        [hash_text(prints[a][0]) for a, _ in pairs], [hash_text(h) for h, _ in changed],
        [likeness(sets[a], set(h.tolist())) for (a, _), (h, _) in zip(pairs, changed)],
        [likeness(sets[a], sets[b]) for a, b in pairs],
        [prints[a][1] for a, _ in pairs],
    ]


def _sort_key(number, order):
    return number is not None, 0 if number is None else number, order


def range_starts(rows, id_col):
    """First (id, hash) of each of several ranges with about as many rows, in order:
    spark.sql.shuffle.partitions of them, or fewer if there are too few rows. Only ids
    and hashes are sorted here."""
    count = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(id_col).asc_nulls_first(), F.col("_order")]

    def firsts(batches):
        for batch in batches:
            if batch.num_rows:
                yield batch.slice(0, 1)
                break
        for _ in batches:  # read to the end
            pass

    keys = rows.select(id_col, "_order")
    found = keys.repartitionByRange(count, *order).sortWithinPartitions(*order).mapInArrow(
        firsts, keys.schema)
    return sorted({_sort_key(*row) for row in found.collect()})


def compare_with_next(docs, id_col="doc_id", text_col="text", gram=GRAM, window=WINDOW):
    """Fingerprint each text and its edited text, and compare both and the next text.

    The next document is that with the next larger id, after the last the first; null
    ids come first, equal ids go by their text's hash. `edited_text` says what the
    edit is. One row per input row: `id_col` and the columns of _COMPARED. Null texts
    count as empty; rows may repeat; an only document is its own next one; an empty
    table gives no rows. Other columns are not read.

    Neighbours meet in ranges of (id, hash), so that an id that very many rows share is
    spread too. The first document of a range also goes to the end of the range before,
    and that of the first range to the end of the last.
    """
    schema = T.StructType([docs.schema[id_col], *_COMPARED])
    rows = docs.select(id_col, plain_text(text_col).alias("_text")).withColumn(
        "_order", F.xxhash64("_text"))
    starts = range_starts(rows, id_col)
    if not starts:
        return docs.sparkSession.createDataFrame([], schema)

    @F.arrow_udf("array<struct<part: int, extra: boolean>>")
    def places(ids, orders):
        import pyarrow as pa

        out = []
        for key in map(_sort_key, ids.to_pylist(), orders.to_pylist()):
            part = max(0, bisect_right(starts, key) - 1)
            out.append([{"part": part, "extra": False}])
            if starts[part] == key:
                out[-1].append({"part": (part - 1) % len(starts), "extra": True})
        return pa.array(out, pa.list_(pa.struct([("part", pa.int32()), ("extra", pa.bool_())])))

    placed = rows.withColumn("_places", places(id_col, "_order")).select(
        id_col, "_text", "_order", F.explode("_places").alias("_place")
    ).select(F.col("_place.part").alias("_part"), F.col("_place.extra").alias("_extra"), id_col,
             "_order", "_text")
    ordered = placed.repartitionById(len(starts), "_part").sortWithinPartitions(
        "_part", "_extra", F.col(id_col).asc_nulls_first(), "_order", "_text")

    def neighbours(batches):
        import pyarrow as pa

        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)
        last = ([], [], [], [])
        for piece in pieces(batches, text=4):
            parts, extras, ids, texts = (
                [*carried, *piece.column(n).to_pylist()]
                for carried, n in zip(last, (0, 1, 2, 4)))
            pairs = [(n, n + 1) for n in range(len(ids) - 1)
                     if not extras[n] and parts[n] == parts[n + 1]]
            columns = [[ids[n] for n, _ in pairs], *_compare(texts, pairs, gram, window)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, target)], schema=target)
            last = parts[-1:], extras[-1:], ids[-1:], texts[-1:]

    return ordered.mapInArrow(neighbours, schema)
