"""Line dedup by winnowing over line hashes.

A run of consecutive lines, of at least `min_words` words in all, that occurs earlier
(by document id, then by place) is deleted; its first occurrence stays. With one word,
which is the default, every line that is not blank is a run: nothing is too short. Blank
lines inside a run neither count nor differ, and lines are compared without the white
space around them.

1. A window is a shortest run of lines that reaches `min_words` words, read forwards from
   a line or backwards from one. Its fingerprint is the smallest line hash in it, the
   rightmost of equal ones. Equal windows choose equal lines, so every repeated run of
   that many words shares a fingerprint: that is the guarantee of winnowing.
2. Fingerprints at two positions or more are joined to the windows around them.
3. Matches are extended both ways by the overlapping windows that start or end further
   on, each matched by a hash of all its lines. The forward and backward windows of a
   run cover it to its last line, so a match reaches as far as the texts agree.
4. All windows but the first occurrence of each are deleted.

Positions are matched with the first occurrence only, never pair by pair, and counts and
first places are combined before they are shuffled.
"""

import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wavelode.llm.common import (
    discard, named, numbered, pieces, plain_text, row_key, stored,
)

MIN_WORDS = 1


def line_windows(text, min_words=MIN_WORDS):
    """Windows of a text as (first line, last line, fingerprint, new, hash): `new` at the
    first window that chooses a position."""
    lines = [(n, s) for n, line in enumerate(text.split("\n")) if (s := line.strip())]
    if not lines:
        return []
    words = [len(s.split()) for _, s in lines]
    spans, total, stop = {}, 0, 0
    for start in range(len(lines)):  # forwards: the shortest run from `start`
        while stop < len(lines) and total < min_words:
            total += words[stop]
            stop += 1
        if total < min_words:
            break
        spans[start, stop] = None
        total -= words[start]
    total, start = 0, len(lines)
    for stop in range(len(lines), 0, -1):  # backwards: the shortest run up to `stop`
        while start > 0 and total < min_words:
            start -= 1
            total += words[start]
        if total < min_words:
            break
        spans[start, stop] = None
        total -= words[stop - 1]
    if not spans:
        return []
    encoded = [s.encode("utf-8", "surrogatepass") for _, s in lines]
    hashes = [xxhash.xxh64_intdigest(s) - (1 << 63) for s in encoded]
    out, chosen = [], set()
    for start, stop in sorted(spans):
        least = min(range(start, stop), key=lambda n: (hashes[n], -n))
        whole = xxhash.xxh3_128_digest(b"\n".join(encoded[start:stop]))
        out.append((lines[start][0], lines[stop - 1][0], hashes[least], least not in chosen, whole))
        chosen.add(least)
    return out


def merged(spans):
    """Sorted, disjoint (start, end) out of overlapping or touching ones."""
    out = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def without_lines(text, spans):
    lines = text.split("\n")
    kept, at = [], 0
    for start, end in spans:
        kept.extend(lines[at:start])
        at = end + 1
    kept.extend(lines[at:])
    return "\n".join(kept)


_WINDOWS = T.StructType([
    T.StructField("key", T.BinaryType()), T.StructField("start", T.LongType()),
    T.StructField("end", T.LongType()), T.StructField("print", T.LongType()),
    T.StructField("new", T.BooleanType()), T.StructField("whole", T.BinaryType()),
])


def repeated_spans(rows, min_words=MIN_WORDS):
    """Rows (key, spans) of the line spans to delete, from rows (id, key, text): key is a
    binary name of the row that equals only that of a row with the same id and text."""
    schema = T.StructType([rows.schema["id"], *_WINDOWS])

    def run(batches):
        import pyarrow as pa

        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)
        for piece in pieces(batches, text=2):
            owner, found = [], []
            for n, text in enumerate(piece.column(2).to_pylist()):
                windows = line_windows(text, min_words)
                owner.extend([n] * len(windows))
                found.extend(windows)
            take = pa.array(owner, pa.int64())
            columns = list(zip(*found)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [piece.column(0).take(take).cast(target.field(0).type),
                 piece.column(1).take(take).cast(target.field(1).type),
                 *[pa.array(c, f.type) for c, f in zip(columns, list(target)[2:])]],
                schema=target)

    windows = stored(rows.select("id", "key", "text").mapInArrow(run, schema), "line-windows")
    shared = stored(
        windows.where("new").groupBy("print").agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1").select("print"),
        "line-prints",
    )
    matched = stored(windows.join(shared, "print").drop("print", "new"), "line-matches")
    place = F.struct("id", "key", "start")
    firsts = stored(
        matched.groupBy("whole").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1").drop("n"),
        "line-firsts",
    )
    later = matched.join(firsts, "whole").where(~place.eqNullSafe(F.col("first")))
    # At most the windows of one document.
    spans = stored(
        later.groupBy("key").agg(F.collect_set(F.struct("start", "end")).alias("spans")),
        "line-spans",
    )
    discard(windows, shared, matched, firsts)
    return spans


def dedup_lines(docs, id_col="doc_id", text_col="text", min_words=MIN_WORDS, removed="removed"):
    """All columns of the rows, the text without the runs of lines that occur earlier,
    and column `removed`, an array of (start, end) line numbers from 0 (a column that
    already has this name is replaced).

    Documents come in the order of their ids, null ids first and equal ids by a hash of
    their text; rows that repeat both id and text count as one document and keep the same
    lines. A null text stays null. Lines that occur earlier in the same text count, too.
    Texts of fewer words than `min_words` are never changed. Other columns pass through,
    whatever their names, and an empty table gives no rows.
    """
    names = [c for c in docs.columns if c != removed]
    inner = [f"c{n}" for n in range(len(names))]
    text_at = names.index(text_col)
    rows = numbered(docs.select(*[named(c) for c in names]))
    number, text = F.col(inner[names.index(id_col)]), plain_text(inner[text_at])
    key = row_key(number, text)
    spans = repeated_spans(rows.select(
        number.alias("id"), key.alias("key"), text.alias("text")), min_words)
    rows = rows.withColumn("key", key).join(spans, "key", "left").select(*inner, "spans")
    span = T.ArrayType(T.StructType([
        T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    schema = T.StructType([
        *[T.StructField(i, docs.schema[c].dataType) for c, i in zip(names, inner)],
        T.StructField("removed", span),
    ])

    def rewrite(batches):
        import pyarrow as pa

        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)
        for piece in pieces(batches, text=text_at):
            columns = [c.cast(f.type) for c, f in zip(piece.columns, target)][:-1]
            spans = [merged((s["start"], s["end"]) for s in found or ())
                     for found in piece.column(len(names)).to_pylist()]
            if any(spans):
                texts = columns[text_at].to_pylist()
                columns[text_at] = pa.array(
                    [without_lines(t, s) if s else t for t, s in zip(texts, spans)],
                    target.field(text_at).type)
            gone = [[{"start": a, "end": b} for a, b in found] for found in spans]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(gone, target.field(len(names)).type)], schema=target)

    return rows.mapInArrow(rewrite, schema).toDF(*names, removed)
