"""Language identification by cross-parsing.

Labelled text of each language gives a suffix automaton, which knows every substring of
it. A text is parsed from left to right into longest matches with each automaton; the
language that needs the fewest phrases, normalised to bits a symbol, wins.

Symbols are the UTF-8 bytes of letters in lower case, so the alphabet is the same for all
scripts and no letter shares its symbol with another.

The automata are tables of transitions, with columns for the bytes that the language has
and one for all others. A transition that does not exist holds where the next phrase
begins and how many phrases have ended, so a step is two lookups, made for thousands of
text segments and all languages at a time in numpy.
"""

from itertools import groupby

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wavelode.llm.common import discard, named, pieces, plain_text, stored, whole_row

# Bound of the labelled sample: so many texts a language, so many characters of each.
SAMPLE_TEXTS = 100
SAMPLE_CHARS = 160
# Parts in which a language's texts are ranked before they meet.
RANK_PARTS = 32
# Symbols of a segment; longer texts are parsed in several.
SEGMENT = 512
# Transitions that a worker holds at once; further languages are parsed in further passes.
MODEL_TRANSITIONS = 1 << 25
UNKNOWN = "und"

# All that is no letter; what ends a segment is no byte.
_BLANK, _END = 32, 256
_COUNT_SHIFT = 28
_MASK = (1 << _COUNT_SHIFT) - 1


def held_out(id_col):
    """Is the row kept from learning? Null ids count as empty text."""
    return F.crc32(F.coalesce(named(id_col).cast("string"), F.lit(""))) % 3 == 1


def sampled_pieces(docs, id_col="doc_id", text_col="text", lang_col="lang",
                   texts=SAMPLE_TEXTS, chars=SAMPLE_CHARS, held=False):
    """A table (lang, hash, piece) of labelled rows: not held out, or only held out ones.

    Of each language the distinct texts with the smallest hashes, and of each a piece
    from a place given by its hash, so copies do not crowd the sample.
    """
    side = held_out(id_col) if held else ~held_out(id_col)
    rows = docs.where(side & named(lang_col).isNotNull() & named(text_col).isNotNull())
    rows = rows.select(named(lang_col).cast("string").alias("lang"),
                       named(text_col).cast("string").alias("text"))
    rows = rows.withColumn("hash", F.xxhash64("text"))
    # First within RANK_PARTS parts of a language, then among the few rows that are left.
    chosen = rows.select("lang", "hash", F.pmod("hash", F.lit(RANK_PARTS)).alias("part")).distinct()
    for keys in (["lang", "part"], ["lang"]):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy("hash"))
        chosen = chosen.withColumn("rank", rank).where(F.col("rank") <= texts).drop("rank")
    # At most `texts` rows a language. Spark broadcasts them where they are few.
    chosen = stored(chosen.select("lang", "hash"), "language-texts")
    start = F.pmod("hash", F.greatest(F.length("text") - chars + 1, F.lit(1))) + 1
    piece = F.substring(F.col("text"), start.cast("int"), F.lit(chars))
    found = stored(
        rows.join(chosen, ["lang", "hash"]).select("lang", "hash", piece.alias("piece"))
        .groupBy("lang", "hash").agg(F.min("piece").alias("piece")), "language-pieces")
    discard(chosen)
    return found


def labelled_sample(docs, id_col="doc_id", text_col="text", lang_col="lang",
                    texts=SAMPLE_TEXTS, chars=SAMPLE_CHARS):
    """{language: [piece of text]} of the sample, on the driver."""
    table = sampled_pieces(docs, id_col, text_col, lang_col, texts, chars)
    return dict(languages_of(table))


def languages_of(table):
    """(language, pieces) one after another; the driver holds a part of the table at a time."""
    rows = table.orderBy("lang", "hash").toLocalIterator()
    for language, found in groupby(rows, key=lambda r: r["lang"]):
        yield language, [r["piece"] for r in found]


def letter_table():
    """The lower case of every code point that is a letter, a blank for all others."""
    table = np.full(0x110000, _BLANK, np.uint32)
    for point in range(0x110000):
        character = chr(point)
        if character.isalpha():
            table[point] = ord(character.lower()[:1])
    return table


def symbols(text, table):
    """The text's symbols, runs of blanks as one."""
    found = table[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")]
    keep = found != _BLANK
    keep[1:] |= found[:-1] != _BLANK
    # Surrogates are no letters, so what is left is valid text.
    letters = found[keep].astype("<u4").tobytes().decode("utf-32-le")
    return np.frombuffer(letters.encode(), np.uint8)


def suffix_automaton(sequence):
    """Transitions of the smallest automaton that knows all substrings."""
    following, length, link = [{}], [0], [-1]
    last = 0
    for symbol in sequence:
        current = len(following)
        following.append({})
        length.append(length[last] + 1)
        link.append(0)
        state = last
        while state >= 0 and symbol not in following[state]:
            following[state][symbol] = current
            state = link[state]
        if state >= 0:
            target = following[state][symbol]
            if length[target] == length[state] + 1:
                link[current] = target
            else:
                copy = len(following)
                following.append(dict(following[target]))
                length.append(length[state] + 1)
                link.append(link[target])
                while state >= 0 and following[state].get(symbol) == target:
                    following[state][symbol] = copy
                    state = link[state]
                link[target] = link[current] = copy
        last = current
    return following


def transition_table(following, offset):
    """Flat table of (phrases ended << 28 | place of the next state), and the column of
    every byte and of the end of a segment.

    The first column is for bytes that the language never has, the last for the end.
    Places start at `offset`.
    """
    root = following[0]  # has all symbols of the language
    known = sorted(root)
    columns = len(known) + 2
    column = np.zeros(_END + 1, np.int32)
    column[known] = np.arange(1, len(known) + 1)
    column[_END] = columns - 1
    place = {symbol: n for n, symbol in enumerate(known, 1)}
    table = np.empty((len(following), columns), np.int64)
    start = np.empty(columns, np.int64)
    start[0] = offset | 1 << _COUNT_SHIFT  # a phrase of its own
    for symbol, target in root.items():  # a phrase begins here
        start[place[symbol]] = target * columns + offset
    start[-1] = offset
    table[0] = start
    table[1:] = start + (1 << _COUNT_SHIFT)
    for state, edges in enumerate(following):
        for symbol, target in edges.items():
            table[state, place[symbol]] = target * columns + offset
    return table.astype(np.int32).ravel(), column


def models(languages, most=MODEL_TRANSITIONS):
    """What scoring needs, from (language, pieces) pairs: models of several languages each,
    of `most` transitions or one language."""
    letters, parts, offset = letter_table(), [], 0

    def packed():
        names, tables, columns, starts, scales = zip(*parts)
        return {
            "languages": list(names), "symbols": letters, "columns": np.stack(columns),
            "next": np.concatenate(tables), "starts": np.array(starts, np.int32),
            "scales": np.array(scales),
        }

    for language, found in languages:
        sequence = symbols("\n".join(found), letters)
        automaton = suffix_automaton(sequence.tolist())
        size = len(automaton) * (len(automaton[0]) + 2)
        if parts and offset + size > most:
            yield packed()
            parts, offset = [], 0
        flat, column = transition_table(automaton, offset)
        parts.append((language, flat, column, offset, np.log2(max(2, len(sequence)))))
        offset += len(flat)
    if parts:
        yield packed()


def learn(sample):
    """One model of all languages in {language: [piece]}; None without any language."""
    return next(models(sorted(sample.items()), _MASK), None)


def phrases(sequences, model, segment=SEGMENT):
    """Numbers of phrases, by language and text, for lists of symbols."""
    out = np.zeros((len(model["languages"]), len(sequences)), np.int64)
    cuts = [(n, s[at:at + segment]) for n, s in enumerate(sequences)
            for at in range(0, len(s), segment)]
    if not cuts:
        return out
    # Longest first, so that the segments still running are always the first ones.
    cuts.sort(key=lambda cut: -len(cut[1]))
    lengths = np.array([len(c) for _, c in cuts])
    steps = np.full((int(lengths[0]) + 1, len(cuts)), _END, np.uint16)
    for column, (_, cut) in enumerate(cuts):
        steps[:len(cut), column] = cut
    state = np.repeat(model["starts"][:, None], len(cuts), axis=1)
    ended = np.zeros(state.shape, np.int32)
    following, columns = model["next"], model["columns"]
    for step in range(len(steps)):
        running = int(np.searchsorted(-lengths, -step, side="right"))
        place = columns.take(steps[step, :running], axis=1)
        place += state[:, :running]
        found = following.take(place)
        ended[:, :running] += found >> _COUNT_SHIFT
        np.bitwise_and(found, _MASK, out=state[:, :running])
    owners = np.array([n for n, _ in cuts])
    for language in range(len(out)):
        out[language] = np.bincount(owners, ended[language], len(sequences)).astype(np.int64)
    return out


def fits(texts, model):
    """(language, bits a symbol, sum of weights, phrases a symbol, symbols) of the best
    language of each text, None for texts without a letter. The weights are those of all
    languages against the best one, which has weight 1."""
    sequences = [symbols(t, model["symbols"]) for t in texts]
    lengths = np.array([max(1, len(s)) for s in sequences])
    counts = phrases(sequences, model)
    bits = counts * model["scales"][:, None] / lengths
    best = bits.argmin(axis=0)
    least = bits.min(axis=0)
    weights = np.exp(-4 * (bits - least)).sum(axis=0)
    rates = counts[best, np.arange(len(texts))] / lengths
    return [
        (model["languages"][b], *values) if bool((s != _BLANK).any()) else None
        for s, b, *values in zip(sequences, best.tolist(), least.tolist(), weights.tolist(),
                                 rates.tolist(), lengths.tolist())
    ]


def better(one, other):
    """The fit of two groups of languages, out of the fits of each; the first wins ties."""
    if one is None or other is None:
        return one or other
    if other[1] < one[1]:
        one, other = other, one
    return (one[0], one[1], one[2] + other[2] * float(np.exp(-4 * (other[1] - one[1]))), *one[3:])


def classify(texts, model):
    """(language, score) of each text."""
    return [(f[0], 1 / f[2]) if f else (UNKNOWN, 0.0) for f in fits(texts, model)]


_FIT = T.StructType([
    T.StructField("lang", T.StringType()), T.StructField("bits", T.DoubleType()),
    T.StructField("weights", T.DoubleType()), T.StructField("rate", T.DoubleType()),
    T.StructField("symbols", T.LongType())])


def _fitted(rows, model, text_at):
    """The rows with column fit, or with what it becomes after a further model."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    before = "fit" in rows.columns
    kept = [f for f in rows.schema if f.name != "fit"]
    schema = T.StructType([*kept, T.StructField("fit", _FIT)])

    def run(batches):
        import pyarrow as pa

        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)
        for piece in pieces(batches, text=text_at):
            found = fits(piece.column(text_at).to_pylist(), shared.value)
            if before:
                old = [f and tuple(f.values()) for f in piece.column(len(kept)).to_pylist()]
                found = [better(a, b) for a, b in zip(old, found)]
            fit = [f and dict(zip(_FIT.names, f)) for f in found]
            yield pa.RecordBatch.from_arrays(
                [*[c.cast(f.type) for c, f in zip(piece.columns[:len(kept)], target)],
                 pa.array(fit, target.field(len(kept)).type)], schema=target)

    return rows.mapInArrow(run, schema)


def fit_languages(rows, languages, text_at, most=MODEL_TRANSITIONS):
    """The rows with column fit: null, or what `fits` says of the text in column number
    `text_at` and all (language, pieces) pairs.

    A pass parses by as many languages as fit `most` transitions; between passes the rows
    are stored, so that workers hold one model at a time.
    """
    found, last = rows, None
    for model in models(languages, most):
        if last is not None:
            found = stored(_fitted(found, last, text_at), "language-fits")
        last = model
    if last is None:
        return rows.withColumn("fit", F.lit(None).cast(_FIT))
    return _fitted(found, last, text_at)


def identify_languages(docs, sample, text_col="text", columns=("doc_id",),
                       most=MODEL_TRANSITIONS):
    """The given columns of every row with lang_pred and score, from a labelled sample
    {language: pieces} or (language, pieces) pairs in the order of the names.

    lang_pred is `und`, with score 0, if the text is null or has no letter, or if the
    sample is empty; equal measures go to the first language by name. Score is 1 for a
    clear winner and 1 / n if n languages fit alike. Whole texts count. Values of the
    columns may be null or repeat; a column already called lang_pred or score is replaced.
    An empty table gives no rows. Any number of languages will do: see `fit_languages`.
    """
    columns = [c for c in columns if c not in ("lang_pred", "score")]
    inner = [f"c{n}" for n in range(len(columns))]
    rows = docs.select(*[named(c).alias(i) for c, i in zip(columns, inner)],
                       plain_text(text_col).alias("text"))
    languages = sorted(sample.items()) if isinstance(sample, dict) else sample
    found = fit_languages(rows, languages, len(inner), most)
    return found.select(
        *inner, F.coalesce("fit.lang", F.lit(UNKNOWN)).alias("lang_pred"),
        F.coalesce(1 / F.col("fit.weights"), F.lit(0.0)).alias("score"),
    ).toDF(*columns, "lang_pred", "score")


def predict_languages(docs, id_col="doc_id", text_col="text", lang_col="lang"):
    """Learn from the rows that are not held out and identify every row's language:
    `id_col`, held_out, lang_pred and score."""
    table = sampled_pieces(docs, id_col, text_col, lang_col)
    found = identify_languages(docs, languages_of(table), text_col, [id_col])
    return found.select(named(id_col), held_out(id_col).alias("held_out"), "lang_pred", "score")


# Symbols that a text needs before its phrases can say that its language is unknown, and
# how many times more phrases than the worst labelled text it must need.
LEAST_SYMBOLS = 40
MARGIN = 2.0


def foreign_rate(docs, languages, id_col="doc_id", text_col="text", lang_col="lang",
                 most=MODEL_TRANSITIONS):
    """Phrases a symbol above which a text is in none of the languages: MARGIN times what
    the worst of all labelled texts needs that were held out from learning and are found
    to be in the language of their label. Null without such texts.

    Text of a language splits into matches of several letters; in another language, and
    more so in another script, they are shorter.
    """
    rows = docs.where(held_out(id_col) & named(lang_col).isNotNull()).select(
        named(lang_col).cast("string").alias("label"), plain_text(text_col).alias("text"))
    found = fit_languages(rows, languages, 1, most)
    long = found.where(
        (F.col("fit.symbols") >= LEAST_SYMBOLS) & (F.col("fit.lang") == F.col("label")))
    return long.agg(F.max("fit.rate") * MARGIN).first()[0]


def keep_identified(docs, id_col="doc_id", text_col="text", lang_col="lang"):
    """The rows whose language is among the learned ones, with all their columns.

    Rejected are null texts, texts without a letter, all texts if no row has a label, and
    texts of LEAST_SYMBOLS symbols and more that need more phrases a symbol than
    `foreign_rate` allows.
    """
    names = id_col, text_col, lang_col
    table = sampled_pieces(docs, *names)
    limit = foreign_rate(docs, languages_of(table), *names)
    rows = docs.select(whole_row(docs).alias("row"), plain_text(text_col).alias("text"))
    found = fit_languages(rows, languages_of(table), 1)
    known = F.col("fit").isNotNull()
    if limit is not None:
        known &= (F.col("fit.rate") <= limit) | (F.col("fit.symbols") < LEAST_SYMBOLS)
    return found.where(known).select("row.*")
