"""Removal of passages that an earlier document has, by compressed FM-indexes.

A passage is a run of at least `least` words. Documents are streamed against an index of
the texts that could hold their passages, shard by shard:

1. Some runs of `gram` words are marked: those whose smallest hash of `part` words comes
   first or last in them (closed syncmers). Content alone decides, and every window of
   `least` words has marked runs in it. A window with one that no other document has
   cannot occur elsewhere.
2. Each window left belongs to its rarest marked run, so equal windows belong together and
   a run that very many documents share gets only the windows made of such runs alone.
   Neighbouring windows of one run form a segment; equal segments are counted once, with
   their smallest document.
3. Segments are shuffled by their run. A task cuts its runs into shards of bounded size,
   builds an FM-index of each (fm_index.py) and computes matching statistics of its
   segments against those of documents with smaller ids. A run with very many different
   segments is indexed in several shards that all of its segments are streamed to.
4. Intervals above the threshold go back to the documents, and their words are cut out.

Texts are only shuffled to join them with what was found about them. Counts and smallest
documents are combined before they are shuffled.
"""

import hashlib
import re

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wavelode.llm.common import discard, named, numbered, pieces, plain_text, row_key, stored
from wavelode.llm.fm_index import FMIndex
from wavelode.llm.lines import merged

LEAST = 50
SHARD_WORDS = 1 << 18  # of an index, but for the last run that is added
KEY_SEGMENTS = 2048  # different segments of one run in an index

_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xD6E8FEB86659FD93)
_LONGEST = 32  # bytes of a word; longer ones stand as their hash
_WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def widths(least):
    """(words of a run, words whose hash marks it): every window of `least` words holds
    gram - part runs at least, of which one is marked."""
    gram = max(1, 2 * least // 5)
    return gram, max(1, gram // 5)


def _byte_tables():
    numbers = np.arange(1, 257, dtype=np.uint64) * _MIX
    numbers ^= numbers >> np.uint64(31)
    space = np.zeros(256, bool)
    space[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
    return space, numbers * np.uint64(_BASE)


_SPACE, _BYTES = _byte_tables()
_BLOCK = 1 << 18  # bytes whose hashes are worked out at once


def _word_hashes(points, starts, ends):
    """64-bit hashes of the words of a byte array, out of one running sum over its bytes."""
    base = np.uint64(_BASE)
    powers = np.cumprod(np.full(_BLOCK, base))
    inverses = np.cumprod(np.full(_BLOCK, np.uint64(pow(_BASE, -1, 1 << 64))))
    found, at = np.empty(len(starts), np.uint64), 0
    while at < len(starts):
        first = int(starts[at])
        stop = int(np.searchsorted(ends, first + _BLOCK, side="right"))
        if stop == at:  # longer than a block
            word = points[first:int(ends[at])].tobytes()
            digest = hashlib.blake2b(word, digest_size=8).digest()
            found[at] = int.from_bytes(digest, "little")
            at += 1
            continue
        part = points[first:int(ends[stop - 1])]
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTES[part] * powers[:len(part)], out=total[1:])
        a, b = starts[at:stop] - first, ends[at:stop] - first
        found[at:stop] = (total[b] - total[a]) * inverses[a]
        at = stop
    found ^= found >> np.uint64(32)
    found *= _MIX
    return found ^ (found >> np.uint64(29))


class Words:
    """The words of some texts in bytes: where they start and end in the texts put one
    after another, their hashes, and how many each text has."""

    def __init__(self, texts):
        self.buffer = b"\n".join(texts)
        points = np.frombuffer(self.buffer, np.uint8)
        space = np.ones(len(points) + 2, bool)
        space[1:-1] = _SPACE[points]
        self.starts = np.flatnonzero(space[:-2] & ~space[1:-1])
        self.ends = np.flatnonzero(~space[1:-1] & space[2:]) + 1
        self.hashes = _word_hashes(points, self.starts, self.ends)
        offsets = np.cumsum([0] + [len(t) + 1 for t in texts])
        self.sizes = np.diff(np.searchsorted(self.starts, offsets))

    def joined(self, first, stop):
        """Words [first, stop) with one space between; long ones stand as their hash."""
        text = self.buffer[self.starts[first]:self.ends[stop - 1]]
        return b" ".join(map(_token, text.split()))


def _polynomials(values, width, base):
    """Sums over all runs of `width` values, made from those of half as many."""
    if width == 1:
        return values
    half = _polynomials(values, width // 2, base)
    reach = width // 2
    total = half[:-reach] * np.uint64(pow(base, reach, 1 << 64)) + half[reach:]
    if width % 2:
        total = total[:-1] * np.uint64(base) + values[width - 1:]
    return total


def _rolling(values, width):
    total = _polynomials(values, width, _BASE).copy()
    total ^= total >> np.uint64(29)
    total *= _MIX
    return total ^ (total >> np.uint64(32))


def _sliding_min(values, width):
    """Minima of all runs of `width` values."""
    reach, least = 1, values
    while reach * 2 <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if reach < width:
        least = np.minimum(least[:reach - width], least[width - reach:])
    return least


def marked_runs(words, least):
    """(starts, hashes) of the marked runs, by their first words."""
    gram, part = widths(least)
    total = len(words.hashes)
    if total < gram:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    ends = np.repeat(np.cumsum(words.sizes), words.sizes)
    runs = _rolling(words.hashes, gram)
    reach = gram - part
    inner = _rolling(words.hashes, part)
    if reach:
        lowest = _sliding_min(inner, reach)[:len(runs)]
        first, last = inner[:len(runs)], inner[reach:reach + len(runs)]
        chosen = ((first == lowest) & (first <= last)) | (last < lowest)
    else:
        chosen = np.ones(len(runs), bool)
    starts = np.flatnonzero(chosen)
    starts = starts[starts + gram <= ends[starts]]
    return starts, runs[starts].view(np.int64)


def _scanned(batches, text, chars=1_000_000):
    """Bounded pieces of Arrow batches with the words of their texts."""
    for piece in pieces(batches, text=text, chars=chars):
        yield piece, Words([t or b"" for t in piece.column(text).to_pylist()])


def _marks(rows, least):
    """(key, id, starts, runs) of the marked runs of each text."""
    schema = T.StructType([
        rows.schema["key"], rows.schema["id"], T.StructField("starts", T.ArrayType(T.IntegerType())),
        T.StructField("runs", T.ArrayType(T.LongType()))])

    def run(batches):
        import pyarrow as pa

        for piece, words in _scanned(batches, 2):
            starts, runs = marked_runs(words, least)
            base = np.cumsum(words.sizes) - words.sizes
            cuts = np.searchsorted(starts, [*base, len(words.hashes)])
            inside = starts - np.repeat(base, np.diff(cuts))
            offsets = pa.array(cuts, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), piece.column(1),
                 pa.ListArray.from_arrays(offsets, pa.array(inside, pa.int32())),
                 pa.ListArray.from_arrays(offsets, pa.array(runs, pa.int64()))],
                names=schema.names)

    return rows.select("key", "id", F.col("text").cast("binary")).mapInArrow(run, schema)


def segments(words, shared, least):
    """(document, first word, end, run) of the segments of some documents; `shared` gives
    for each document how many places have the marked run that starts at a word of it."""
    gram, _ = widths(least)
    starts, runs = marked_runs(words, least)
    sizes, total = words.sizes, len(words.hashes)
    if total < least or not len(starts):
        return []
    base = np.cumsum(sizes) - sizes
    counts = np.zeros(total, np.int64)
    for at, found in zip(base.tolist(), shared):
        for start, n in found:
            counts[at + start] = n
    # Rarer runs are smaller, equal ones equal; the leftmost of equal ones decides.
    n = counts[starts]
    order = np.lexsort((runs, n))
    change = np.ones(len(order), bool)
    change[1:] = (n[order][1:] != n[order][:-1]) | (runs[order][1:] != runs[order][:-1])
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(change)
    worth = np.full(total, np.iinfo(np.int64).max)
    worth[starts] = np.where(n == 0, -1, (place << 32) | starts)
    rarest = _sliding_min(worth[:total - gram + 1], least - gram + 1)
    window = np.flatnonzero(rarest >= 0)
    ends = np.repeat(np.cumsum(sizes), sizes)
    window = window[window + least <= ends[window]]
    if not len(window):
        return []
    chosen = rarest[window] & 0xFFFFFFFF
    new = np.ones(len(window), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (window[1:] != window[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(window)) - 1
    run_at = dict(zip(starts.tolist(), runs.tolist()))
    owner = np.searchsorted(np.cumsum(sizes), window[first], side="right")
    return [
        (d, s, e, run_at[c]) for d, s, e, c in zip(
            owner.tolist(), window[first].tolist(), (window[last] + least).tolist(),
            chosen[first].tolist())]


def _token(word):
    return word if len(word) <= _LONGEST else b"\x01" + hashlib.md5(word).hexdigest().encode()


def _segments(rows, least):
    """(key, id, starts, size, run, words) of the segments of texts with `shared` places;
    equal segments of a text are one row."""
    schema = T.StructType([
        rows.schema["key"], rows.schema["id"], T.StructField("starts", T.ArrayType(T.IntegerType())),
        T.StructField("size", T.IntegerType()), T.StructField("run", T.LongType()),
        T.StructField("words", T.BinaryType())])

    def run(batches):
        import pyarrow as pa

        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)
        for piece, words in _scanned(batches, 2):
            shared = [[(p["start"], p["n"]) for p in found]
                      for found in piece.column(3).to_pylist()]
            base = (np.cumsum(words.sizes) - words.sizes).tolist()
            found = {}
            for d, s, e, run_ in segments(words, shared, least):
                found.setdefault((d, e - s, run_, words.joined(s, e)), []).append(s - base[d])
            take = pa.array([d for d, *_ in found], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [piece.column(0).take(take).cast(target.field(0).type),
                 piece.column(1).take(take).cast(target.field(1).type),
                 pa.array(list(found.values()), pa.list_(pa.int32())),
                 pa.array([n for _, n, _, _ in found], pa.int32()),
                 pa.array([r for _, _, r, _ in found], pa.int64()),
                 pa.array([w for *_, w in found], pa.binary())],
                schema=target)

    return rows.select("key", "id", F.col("text").cast("binary"), "shared").mapInArrow(run, schema)


def search_shard(owned, queries, least):
    """(number of the query, intervals) out of (owner, words) pairs: runs of words that
    owned texts of smaller owners have. Owners may be of any type with an order."""
    place = {o: n for n, o in enumerate(sorted({o for o, _ in [*owned, *queries]}))}
    index = FMIndex([w for _, w in owned], [place[o] for o, _ in owned])
    spans = {}
    for q, start, end in index.matches(
            [w for _, w in queries], [place[o] for o, _ in queries], least):
        spans.setdefault(q, []).append((start, end - 1))
    return {q: [(a, b + 1) for a, b in merged(found)] for q, found in spans.items()}


def _search(least, shard_words):
    """Intervals of the segments of a partition, which come run by run. A run that has one
    segment only is passed over: no other text has a window of it."""

    def run(batches):
        import pyarrow as pa

        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(_INTERVALS)
        rows, size, last, since = [], 0, None, 0

        def alone():
            return len(rows) == since + 1

        def flush():
            owned = [(first, words.split()) for own, _, first, words in rows if own]
            queries = [(first, words.split()) for _, _, first, words in rows]
            found = search_shard(owned, queries, least) if owned else {}
            rows_out = [(rows[q][1], [{"start": a, "end": b} for a, b in spans])
                        for q, spans in found.items()]
            columns = list(zip(*rows_out)) or [[], []]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, target)], schema=target)

        for batch in batches:
            for run_, part, own, name, first, words in zip(
                    *(c.to_pylist() for c in batch.columns)):
                if (run_, part) != last:
                    if alone():
                        size -= rows.pop()[3].count(b" ") + 1
                    if size > shard_words:
                        yield flush()
                        rows, size = [], 0
                    last, since = (run_, part), len(rows)
                rows.append((own, name, first, words))
                size += words.count(b" ") + 1
        if alone():
            rows.pop()
        if rows:
            yield flush()

    return run


_SPANS = T.ArrayType(T.StructType([
    T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
_INTERVALS = T.StructType([
    T.StructField("name", T.BinaryType()), T.StructField("spans", _SPANS)])


def repeated_passages(rows, least=LEAST, shard_words=SHARD_WORDS, key_segments=KEY_SEGMENTS):
    """(key, spans) of the word spans (start, end) of texts that lie in windows of `least`
    words which a text with a smaller id has, from rows (id, key, text). Rows without an
    id take no part; rows with one key must be copies."""
    rows = rows.where("id IS NOT NULL").select("key", "id", "text")
    marks = stored(_marks(rows, least).dropDuplicates(["key"]), "passage-marks")
    places = marks.select(
        "key", "id", F.explode(F.arrays_zip("starts", "runs")).alias("m")
    ).select("key", "id", F.col("m.starts").alias("start"), F.col("m.runs").alias("run"))
    shared = stored(
        places.groupBy("run").agg(
            F.min("id").alias("low"), F.max("id").alias("high"), F.count(F.lit(1)).alias("n"))
        .where("low < high").select("run", "n"),
        "passage-runs",
    )
    of_text = stored(
        places.join(shared, "run").groupBy("key").agg(
            F.collect_list(F.struct("start", "n")).alias("shared")),
        "passage-places",
    )
    found = stored(
        _segments(rows.join(of_text, "key"), least).withColumn(
            "name", F.unhex(F.md5("words"))),
        "passage-segments",
    )
    different = stored(
        found.groupBy("run", "name").agg(
            F.min("id").alias("first"), F.first("words").alias("words")),
        "passage-different",
    )
    crowded = stored(
        different.groupBy("run").agg(F.count(F.lit(1)).alias("segments"))
        .where(F.col("segments") > key_segments), "passage-crowded",
    )
    count = F.ceil(F.coalesce("segments", F.lit(1)) / key_segments).cast("int")
    units = different.join(crowded, "run", "left").select(
        "run", "name", "first", "words", F.pmod(F.xxhash64("name"), count).alias("home"),
        F.explode(F.sequence(F.lit(0), count - 1)).alias("part"),
    ).select("run", "part", (F.col("part") == F.col("home")).alias("own"), "name", "first", "words")
    placed = units.repartition("run", "part").sortWithinPartitions("run", "part")
    new = stored(
        placed.mapInArrow(_search(least, shard_words), _INTERVALS)
        .groupBy("name").agg(F.flatten(F.collect_list("spans")).alias("spans")),
        "passage-intervals",
    )
    # A later copy of a segment goes as a whole, the first one by its intervals.
    names = stored(
        different.select("name", "first").join(new, "name", "left"), "passage-names")
    whole = F.array(F.struct(F.lit(0).alias("start"), F.col("size").alias("end")))
    lost = found.select("key", "id", "starts", "size", "name").join(names, "name").select(
        "key", "starts", F.when(F.col("id") > F.col("first"), whole)
        .otherwise(F.col("spans")).alias("spans")
    ).where("spans IS NOT NULL").select("key", F.expr("""flatten(transform(starts, s ->
        transform(spans, x -> named_struct('start', s + x.start, 'end', s + x.end))))"""
    ).alias("spans"))
    spans = stored(
        lost.select("key", F.explode("spans").alias("span")).groupBy("key").agg(
            F.collect_set("span").alias("spans")),
        "passage-spans",
    )
    discard(marks, shared, of_text, found, different, crowded, new, names)
    return spans


def without_words(text, spans):
    """A text in bytes without words [start, end), each cut up to the word that follows."""
    at = [m.start() for m in _WORDS.finditer(text)]
    out, passed = [], 0
    for start, end in spans:
        out.append(text[passed:at[start]])
        passed = at[end] if end < len(at) else len(text)
    out.append(text[passed:])
    return b"".join(out)


def dedup_passages(docs, id_col="doc_id", text_col="text", least=LEAST, removed="removed",
                   shard_words=SHARD_WORDS, key_segments=KEY_SEGMENTS):
    """All columns of the rows, the text without the passages that a document with a
    smaller id has, and column `removed`, an array of (start, end) numbers of words (a
    column that already has this name is replaced).

    A word goes if a window of `least` words over it, within its document as it came,
    also occurs in a document with a smaller id. Rows without an id remove nothing and
    stay as they are; rows with the same id do not count as earlier. A null text stays
    null; texts of fewer words than `least` never change. White space between words that
    stay is kept. Other columns pass through whatever their names; rows may repeat; an
    empty table gives no rows.
    """
    if least < 1:
        raise ValueError("a passage has at least one word")
    names = [c for c in docs.columns if c != removed]
    text_at, width = names.index(text_col), len(names)
    rows = numbered(docs.select(*[named(c) for c in names]))
    number, text = F.col(f"c{names.index(id_col)}"), plain_text(f"c{text_at}")
    key = row_key(number, text)
    spans = repeated_passages(
        rows.select(number.alias("id"), key.alias("key"), text.alias("text")),
        least, shard_words, key_segments)
    kinds = [T.StructField(f"c{n}", docs.schema[c].dataType) for n, c in enumerate(names)]
    schema = T.StructType([*kinds, T.StructField("removed", _SPANS)])
    joined = rows.withColumn("key", key).join(spans, "key", "left").select(*rows.columns, "spans")

    def rewrite(batches):
        import pyarrow as pa

        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)
        for piece in pieces(batches, text=text_at):
            columns = [c.cast(f.type) for c, f in zip(piece.columns, target)][:width]
            lost = [[(a, b + 1) for a, b in merged((s["start"], s["end"] - 1) for s in found or ())]
                    for found in piece.column(width).to_pylist()]
            if any(lost):
                texts = columns[text_at].cast(pa.binary()).to_pylist()
                columns[text_at] = pa.array(
                    [without_words(t, s) if s else t for t, s in zip(texts, lost)], pa.binary()
                ).cast(target.field(text_at).type, safe=False)
            gone = [[{"start": a, "end": b} for a, b in found] for found in lost]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(gone, target.field(width).type)], schema=target)

    return joined.mapInArrow(rewrite, schema).toDF(*names, removed)
