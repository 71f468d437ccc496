"""Fill-in-middle over piece tables.

A document is a list of descriptors (buffer, start, length) over two buffers that never
change: its text and the sentinels. Cutting it into prefix, middle and suffix splits
descriptors, an arrangement permutes the three sections and puts a sentinel before each,
and the inverse permutation restores the order. Hashes read the buffers descriptor by
descriptor; text is only put together where the output column asks for it.

Offsets are bytes of UTF-8, in which a line feed and the sentinels are never part of
another character.
"""

import hashlib

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wavelode.llm.common import named, numbered, pieces

SEED = 7
RATE = 100  # of a hundred documents that are rearranged
SPM_RATE = 50  # of a hundred rearranged ones that have their suffix first
SENTINELS = ("<P>", "<M>", "<S>")  # of prefix, middle and suffix

TEXT, MARKS = 0, 1  # the buffers
# Sections 0, 1, 2 are prefix, middle and suffix, in the order of the output.
ORDERS = {"psm": (0, 2, 1), "spm": (2, 0, 1)}


def draws(number, seed=SEED):
    """Four 32-bit numbers that a document's id fixes; a null id counts as empty."""
    digest = hashlib.sha256(f"{seed}:{'' if number is None else number}".encode()).digest()
    return np.frombuffer(digest, ">u4", 4).tolist()


def line_ends(text):
    """Byte offsets at which lines end, their line feeds included."""
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1
    if len(text) and (not len(ends) or ends[-1] != len(text)):
        ends = np.append(ends, len(text))
    return ends


def split(table, offset):
    """The descriptors before and after an offset; one that spans it becomes two."""
    before, after = [], []
    for buffer, start, length in table:
        cut = min(max(offset, 0), length)
        if cut:
            before.append((buffer, start, cut))
        if cut < length:
            after.append((buffer, start + cut, length - cut))
        offset -= length
    return before, after


def arrange(sections, form, marks):
    """Descriptors of the output: each section behind its sentinel, in the form's order."""
    sizes = [len(m) for m in marks]
    table = []
    for n in ORDERS[form]:
        table.append((MARKS, sum(sizes[:n]), sizes[n]))
        table.extend(sections[n])
    return table


def stream(table, buffers):
    """The bytes of the descriptors, one by one and without copies."""
    views = [memoryview(b) for b in buffers]
    for buffer, start, length in table:
        yield views[buffer][start:start + length]


def digest(table, buffers):
    sha = hashlib.sha256()
    for part in stream(table, buffers):
        sha.update(part)
    return sha.hexdigest()


def characters(table, buffers):
    """Code points of the descriptors: bytes that do not continue another one."""
    return sum(
        int(np.count_nonzero((np.frombuffer(part, np.uint8) & 0xC0) != 0x80))
        for part in stream(table, buffers))


def transform(number, text, marks, seed=SEED, rate=RATE, spm_rate=SPM_RATE):
    """(lines, form, sections or None, descriptors of the output) of a text in bytes."""
    table = [(TEXT, 0, len(text))] if text else []
    ends = line_ends(text)
    n = len(ends)
    one, two, chance, way = draws(number, seed)
    if not text or any(m in text for m in marks) or chance % 100 >= rate:
        return n, "plain", None, table
    form = "spm" if way % 100 < spm_rate else "psm"
    low, high = sorted((one % (n + 1), two % (n + 1)))
    offsets = [0, *ends.tolist()]
    prefix, rest = split(table, offsets[low])
    middle, suffix = split(rest, offsets[high] - offsets[low])
    sections = prefix, middle, suffix
    return n, form, sections, arrange(sections, form, marks)


def restored(output, form, marks):
    """Descriptors over an output in bytes that give the text back."""
    table = [(TEXT, 0, len(output))] if output else []
    if form == "plain":
        return table
    order, sections, passed = ORDERS[form], [], 0
    for at, n in enumerate(order):
        # A text with sentinels stays plain, so each is found where it was put.
        _, table = split(table, len(marks[n]))
        passed += len(marks[n])
        stop = len(output) if at == 2 else output.index(marks[order[at + 1]], passed)
        section, table = split(table, stop - passed)
        sections.append(section)
        passed = stop
    inverse = sorted(range(3), key=order.__getitem__)
    return [descriptor for at in inverse for descriptor in sections[at]]


_TABLE = T.ArrayType(T.StructType([
    T.StructField("buffer", T.IntegerType()), T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType())]))
_FOUND = T.StructType([
    T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
    T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()),
    T.StructField("pieces", _TABLE), T.StructField("output", T.StringType()),
    T.StructField("output_sha256", T.StringType())])
_RESTORED = T.StructType([
    T.StructField("text", T.StringType()), T.StructField("sha256", T.StringType())])


def _with_column(docs, into, inputs, kind, make):
    """All columns and a struct `into` (which replaces one of that name) whose rows `make`
    gives for the columns `inputs`, text as bytes."""
    names = [c for c in docs.columns if c != into]
    at = {c: n for n, c in enumerate(names)}
    rows = numbered(docs.select(
        *[named(c) for c in names],
        *[named(c).cast("binary") if docs.schema[c].dataType == T.StringType() else named(c)
          for c in inputs]))
    size = len(names)
    schema = T.StructType([
        *[T.StructField(f"c{at[c]}", docs.schema[c].dataType) for c in names],
        T.StructField("found", kind)])

    def run(batches):
        import pyarrow as pa

        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)
        for piece in pieces(batches, text=size):
            given = [piece.column(size + n).to_pylist() for n in range(len(inputs))]
            columns = list(zip(*map(make, *given))) or [[]] * len(kind)
            fields = list(target.field(size).type)
            struct = pa.StructArray.from_arrays([
                # Bytes become text as they are, valid or not.
                pa.array(c, pa.binary()).cast(f.type, safe=False)
                if c and isinstance(c[0], bytes) else pa.array(c, f.type)
                for c, f in zip(columns, fields)], fields=fields)
            kept = [c.cast(f.type) for c, f in zip(piece.columns[:size], target)]
            yield pa.RecordBatch.from_arrays([*kept, struct], schema=target)

    return rows.mapInArrow(run, schema).toDF(*names, into)


def fill_in_middle(docs, id_col="doc_id", text_col="text", seed=SEED, rate=RATE,
                   spm_rate=SPM_RATE, sentinels=SENTINELS, into="fim"):
    """All columns of the rows and a struct `into`: n (lines), form (plain, psm or spm),
    prefix_chars and middle_chars (null if plain), pieces (the descriptors, offsets in
    bytes; buffer 1 holds the sentinels of prefix, middle and suffix one after another),
    output and output_sha256. A column that already has this name is replaced.

    The cuts lie between lines and follow from the id alone, so that equal ids with equal
    texts get equal outputs; a null id counts as empty text. A null text counts as empty
    and is plain, like a text that contains a sentinel. A text without line feeds is one
    line. Rows may repeat, other columns pass through whatever their names, and an empty
    table gives no rows.
    """
    marks = [m.encode() for m in sentinels]
    if len(marks) != 3 or len(set(marks)) != 3 or not all(marks):
        raise ValueError("three different sentinels are needed")
    if any(a[i:] and b.startswith(a[i:]) for a in marks for b in marks
           for i in range(1, len(a))) or any(a in b for a in marks for b in marks if a != b):
        raise ValueError("sentinels must not overlap")
    buffer = b"".join(marks)

    def make(text, number):
        text = text or b""
        n, form, sections, table = transform(number, text, marks, seed, rate, spm_rate)
        buffers = text, buffer
        chars = [None, None] if sections is None else [
            characters(s, buffers) for s in sections[:2]]
        rows = [{"buffer": b, "start": s, "length": z} for b, s, z in table]
        return (n, form, *chars, rows, b"".join(stream(table, buffers)), digest(table, buffers))

    return _with_column(docs, into, [text_col, id_col], _FOUND, make)


def restore(docs, output_col="output", form_col="form", sentinels=SENTINELS, into="restored"):
    """All columns and a struct `into` with the text that an output was made from, and its
    sha256. A null output counts as empty; a null form as plain."""
    marks = [m.encode() for m in sentinels]

    def make(output, form):
        output = output or b""
        table = restored(output, (form or b"plain").decode(), marks)
        return b"".join(stream(table, [output])), digest(table, [output])

    return _with_column(docs, into, [output_col, form_col], _RESTORED, make)


def digests(found, id_col="doc_id"):
    """One row for each document: its form and the hashes of output and restored text."""
    rows = found.select(named(id_col).alias("doc_id"), F.col("fim.*"))
    return restore(rows.drop("pieces")).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256",
        F.col("restored.sha256").alias("restored_sha256"))
