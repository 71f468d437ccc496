"""BPE encoding and decoding with merges in batched numpy rounds.

The symbols of many words lie in one flat array. A round looks up every neighbouring
pair by binary search in the sorted pair keys, finds the lowest rank of each word, and
merges all its places at once, leftmost first where they overlap. Words without a
known pair leave the array. A long word has rounds of its own, which look only at the
places that hold the lowest rank and at the pairs that a merge makes, so that its time
follows its length. Texts are cut into chunks at white space; a chunk's ids are kept in
a table of bounded size, so the rounds see each new chunk of a worker once.

The vocabulary is a file of the tokenizers library, read on the driver and broadcast;
its size is fixed by the file. Supported is the kind described by the functions below:
NFC, white space dropped, lower case, words split by a pattern, bytes written as
printable characters, a suffix at the end of words, tokens joined by blanks when
decoding.
"""

import heapq
import json
import unicodedata

import numpy as np
import regex
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wavelode.llm.common import pieces, plain_text

# Bytes of the chunks and ids that a worker keeps, and what each adds besides.
KEPT_BYTES = 64_000_000
KEPT_EACH = 200
# Symbols that go through the merge rounds together.
ROUND_SYMBOLS = 500_000
# Symbols from which a word has rounds of its own.
LONG_WORD = 256

# Unicode white space; Python's split() also takes the separators 1C to 1F.
_SPACE = regex.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
_SEPARATORS = regex.compile(r"[\x1c-\x1f]")


def byte_characters():
    """The printable character that stands for each byte value."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    table = {b: chr(b) for b in plain}
    table.update({b: chr(256 + n) for n, b in enumerate(other)})
    return table


def read_vocabulary(path):
    """What the workers need of a tokenizer file, as plain arrays."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, added = spec["model"], spec["added_tokens"]
    vocabulary = model["vocab"]
    suffix = model["end_of_word_suffix"]
    tokens = [""] * (max([*vocabulary.values(), *(a["id"] for a in added)]) + 1)
    for token, number in vocabulary.items():
        tokens[number] = token
    for token in added:
        tokens[token["id"]] = token["content"]
    size = len(tokens)
    pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
    keys = np.array([vocabulary[a] * size + vocabulary[b] for a, b in pairs], np.int64)
    made = np.array([vocabulary[a + b] for a, b in pairs], np.int64)
    order = np.argsort(keys, kind="stable")
    characters = byte_characters()
    split = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"]
                 if p["type"] == "Split")
    return {
        "tokens": tokens, "size": size, "split": split,
        "keys": keys[order], "ranks": order.astype(np.int64), "made": made[order],
        "place": np.argsort(order).astype(np.int64),
        "inner": np.array([vocabulary[characters[b]] for b in range(256)], np.int64),
        "last": np.array([vocabulary[characters[b] + suffix] for b in range(256)], np.int64),
        "special": {a["content"]: a["id"] for a in added},
    }


def merge_words(words, model):
    """The token ids of each word, given as non-empty bytes, as uint32 arrays."""
    lengths = np.array([len(w) for w in words], np.int64)
    values = np.frombuffer(b"".join(words), np.uint8)
    symbols = model["inner"][values]
    ends = np.cumsum(lengths)
    symbols[ends - 1] = model["last"][values[ends - 1]]
    owner = np.repeat(np.arange(len(words)), lengths)
    out = [None] * len(words)
    none = len(model["keys"])
    while len(symbols):
        same = owner[:-1] == owner[1:]
        pair = symbols[:-1] * model["size"] + symbols[1:]
        place = np.minimum(np.searchsorted(model["keys"], pair), none - 1)
        known = same & (model["keys"][place] == pair)
        rank = np.full(len(symbols), none, np.int64)
        rank[:-1][known] = model["ranks"][place[known]]
        starts = np.flatnonzero(np.concatenate(([True], ~same)))
        lowest = np.minimum.reduceat(rank, starts)
        lengths = np.diff(np.append(starts, len(symbols)))
        least = np.repeat(lowest, lengths)
        # Words that are done leave.
        for word in np.flatnonzero(lowest == none):
            at = starts[word]
            out[owner[at]] = symbols[at:at + lengths[word]].astype("<u4")
        chosen = (rank == least) & (rank < none)
        # Of places in a row (a a a) every other one merges, from the left.
        at = np.flatnonzero(chosen)
        first = np.concatenate(([True], np.diff(at) > 1)) if len(at) else at.astype(bool)
        run_start = at[np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))]
        at = at[(at - run_start) % 2 == 0]
        symbols[at] = model["made"][place[at]]
        keep = least < none
        keep[at + 1] = False
        symbols, owner = symbols[keep], owner[keep]
    return out


def merge_long(word, model):
    """The token ids of one word of any length, given as bytes."""
    values = np.frombuffer(word, np.uint8)
    symbols = model["inner"][values]
    symbols[-1] = model["last"][values[-1]]
    size, keys = len(symbols), model["keys"]
    following, before = np.arange(1, size + 1), np.arange(-1, size - 1)
    alive = np.ones(size, bool)
    waiting, ranks = {}, []  # places by the rank of the pair that begins there

    def add(at):
        pair = symbols[at] * model["size"] + symbols[following[at]]
        place = np.minimum(np.searchsorted(keys, pair), len(keys) - 1)
        known = keys[place] == pair
        at, rank = at[known], model["ranks"][place[known]]
        order = np.argsort(rank, kind="stable")
        at, rank = at[order], rank[order]
        cuts = np.flatnonzero(np.diff(rank)) + 1
        for part, r in zip(np.split(at, cuts), rank[np.append(0, cuts)].tolist() if len(at) else ()):
            if r not in waiting:
                waiting[r] = []
                heapq.heappush(ranks, r)
            waiting[r].append(part)

    add(np.arange(size - 1))
    while ranks:
        rank = heapq.heappop(ranks)
        place = model["place"][rank]
        at = np.unique(np.concatenate(waiting.pop(rank)))
        at = at[alive[at] & (following[at] < size)]
        at = at[symbols[at] * model["size"] + symbols[following[at]] == keys[place]]
        if not len(at):
            continue
        # Of places in a row (a a a) every other one merges, from the left.
        first = np.concatenate(([True], following[at[:-1]] != at[1:]))
        run_start = np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
        at = at[(np.arange(len(at)) - run_start) % 2 == 0]
        gone = following[at]
        symbols[at] = model["made"][place]
        alive[gone] = False
        after = following[gone]
        following[at] = after
        inside = after < size
        before[after[inside]] = at[inside]
        left = before[at]
        add(np.unique(np.concatenate((at[inside], left[left >= 0]))))
    return symbols[alive].astype("<u4")


class Encoder:
    """Ids of whole texts, for one worker."""

    def __init__(self, model):
        self.model = model
        self.split = regex.compile(model["split"])
        self.special = regex.compile(
            "(" + "|".join(map(regex.escape, model["special"])) + ")") if model["special"] else None
        self.kept, self.size = {}, 0

    def words(self, chunk):
        """The words of a chunk without white space, as bytes."""
        text = unicodedata.normalize("NFC", chunk)
        # Characters are lowered one by one: a final sigma is no special case.
        text = text.replace("Σ", "σ").lower()
        return [w.encode("utf-8") for w in self.split.findall(text)]

    def chunks(self, text):
        if _SEPARATORS.search(text):
            return [c for c in _SPACE.split(text) if c]
        return text.split()

    def _learn(self, chunks):
        """Put the ids of new chunks into the table."""
        words = {c: self.words(c) for c in chunks}
        new = list(dict.fromkeys(w for ws in words.values() for w in ws))
        ids, start, symbols = {}, 0, 0
        for word in new:
            if len(word) >= LONG_WORD:
                ids[word] = merge_long(word, self.model)
        new = [w for w in new if len(w) < LONG_WORD]
        for stop, word in enumerate(new, 1):
            symbols += len(word)
            if symbols >= ROUND_SYMBOLS or stop == len(new):
                part = new[start:stop]
                ids.update(zip(part, merge_words(part, self.model)))
                start, symbols = stop, 0
        for chunk, ws in words.items():
            found = b"".join(ids[w].tobytes() for w in ws)
            self.kept[chunk] = found
            self.size += KEPT_EACH + 4 * len(chunk) + len(found)

    def encode(self, texts):
        """The ids of each text as little-endian unsigned 32-bit integers."""
        parts = []
        for text in texts:
            if self.special is not None and "<" in text:
                split = self.special.split(text)
            else:
                split = [text]
            parts.append([
                [np.array([self.model["special"][p]], "<u4").tobytes()] if n % 2 else self.chunks(p)
                for n, p in enumerate(split)
            ])
        if self.size > KEPT_BYTES:
            self.kept, self.size = {}, 0
        kept = self.kept
        new = {c for text in parts for part in text for c in part
               if type(c) is str and c not in kept}
        self._learn(new)
        out = []
        for text in parts:
            joined = []
            for n, part in enumerate(text):
                joined.extend(part if n % 2 else map(kept.__getitem__, part))
            out.append(b"".join(joined))
        return out


def decode_ids(ids, tokens):
    """The text of little-endian 32-bit ids: their tokens, joined by blanks."""
    return " ".join([tokens[i] for i in np.frombuffer(ids, "<u4").tolist()])


def _mapped(frame, id_col, value, outputs, work):
    schema = T.StructType([frame.schema[id_col], *outputs])
    rows = frame.select(id_col, value.alias("_value"))

    def run(batches):
        import pyarrow as pa

        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)
        state = {}
        for piece in pieces(batches):
            columns = work(state, piece.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [piece.column(0).cast(target.field(0).type),
                 *[pa.array(c, f.type) for c, f in zip(columns, list(target)[1:])]],
                schema=target)

    return rows.mapInArrow(run, schema)


def encode(docs, path, id_col="doc_id", text_col="text", decoded=False):
    """`id_col` and token_ids: the ids of the whole text as binary, four bytes each,
    little-endian; with `decoded` also the text that these ids decode to.

    A null or empty text has no ids and decodes to empty text. Strings of special
    tokens in a text become these tokens, as the library does. One row per input row,
    in no order; ids may be null or repeat. Other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))
    outputs = [T.StructField("token_ids", T.BinaryType())]
    if decoded:
        outputs.append(T.StructField("decoded", T.StringType()))

    def work(state, texts):
        model = shared.value
        if "encoder" not in state:
            state["encoder"] = Encoder(model)
        ids = state["encoder"].encode(texts)
        if not decoded:
            return [ids]
        return [ids, [decode_ids(i, model["tokens"]) for i in ids]]

    return _mapped(docs, id_col, plain_text(text_col), outputs, work)


def decode(encoded, path, id_col="doc_id", ids_col="token_ids"):
    """`id_col` and decoded: the text of each row's token ids; null ids give empty text."""
    shared = encoded.sparkSession.sparkContext.broadcast(read_vocabulary(path))
    value = F.coalesce(F.col(ids_col), F.lit(bytearray()))
    outputs = [T.StructField("decoded", T.StringType())]

    def work(state, ids):
        return [[decode_ids(i, shared.value["tokens"]) for i in ids]]

    return _mapped(encoded, id_col, value, outputs, work)
