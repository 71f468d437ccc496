"""Toxicity by a convolutional text classifier, trained and run in numpy.

A word is the sum of hashed embeddings of itself and of its first and last letters.
Filters of several widths run over the words of the whole text; each keeps its largest
value, and a linear layer makes a logit of these. Every language has its own threshold,
calibrated on rows that the filters were not fitted to. The language of a text is guessed
from its words alone, by word frequencies learned with the labels.

All labelled rows are learned from: shards of rows train apart and meet in the mean after
each epoch, and the thresholds come from counts of the logits of all calibration rows.
"""

import copy
import re
import zlib

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wavelode.llm.averaging import dealt, flat, parts, train_round
from wavelode.llm.common import discard, pieces, plain_text, stored, tidy
from wavelode.llm.langid import held_out

# Bounds of a sample of labelled rows for `learn`, for each label.
SAMPLE_POSITIVE = 1500
SAMPLE_NEGATIVE = 3000
# Rows that train together, about, where all labelled rows are learned from.
SHARD_ROWS = 4500
# Every so many labelled rows calibrate and do not train.
CALIBRATE = 4

BUCKETS = 1 << 18
DIMENSIONS = 8
WIDTHS = (1, 2, 3)
FILTERS = 8
EPOCHS = 3
BATCH = 32
PENALTY = 1e-4  # on the squares of the output layer
SEED = 7
# What the rows of other languages weigh in a language's threshold.
PRIOR_ROWS = 10
# The score at a language's threshold; scores from here on predict label 1.
CUT = 0.7

KEPT_WORDS = 100_000
CHUNK = 16_384  # words that go through the filters together
# In training: words that go through the filters together, and words of one step.
STRETCH, MOST_WORDS = 1 << 16, 1 << 20
# Calibration counts logits in steps of this size.
GRID = 2.0 ** -12

_WORDS = re.compile(r"[^\W_]+")
_PARTS = 5


def words_of(text):
    return _WORDS.findall(text.lower())


def word_features(word):
    """Buckets of the word, its beginnings and its ending. Bucket 0 is left empty."""
    parts = (word, "<" + word[:3], "<" + word[:4], "<" + word[:5], word[-4:] + ">")
    return [1 + zlib.crc32(p.encode("utf-8", "surrogatepass")) % (BUCKETS - 1) for p in parts]


class Words:
    """Rows of feature buckets for words, in order of first sight; row 0 is no word."""

    def __init__(self):
        self.rows, self.features = {}, [[0] * _PARTS]

    def numbers(self, words):
        rows = self.rows
        for word in set(words).difference(rows):
            rows[word] = len(self.features)
            self.features.append(word_features(word))
        return np.fromiter(map(rows.__getitem__, words), np.int64, len(words))


def bucket_counts(documents, labels, features):
    """Documents of either label by bucket; bucket 0 counts all."""
    seen = np.zeros((2, BUCKETS))
    for numbers, label in zip(documents, labels):
        seen[int(label), np.unique(features[np.unique(numbers)])] += 1
    seen[:, 0] = np.bincount(np.asarray(labels, np.int64), minlength=2)
    return seen


def separation(seen):
    """How far the shares of documents with a bucket differ between the labels, in
    standard errors: near zero for what is rare or common to both."""
    rows = seen[:, :1].clip(1)
    both = (seen.sum(axis=0) + 0.5) / (rows.sum() + 1)
    error = np.sqrt(both * (1 - both).clip(1e-9) * (1 / rows).sum())
    apart = (seen[1] / rows[1] - seen[0] / rows[0]) / error
    apart[0] = 0
    return apart


def _initial(rng, apart):
    """Small random weights; the first dimension and a filter on it start from what
    separates the labels, the rest is left to training."""
    embedding = rng.normal(0, 0.02, (BUCKETS, DIMENSIONS)).astype(np.float32)
    embedding[:, 0] += np.clip(apart / 20, -1, 1)
    embedding[0] = 0
    model = {"embedding": embedding, "offset": np.full(1, -1, np.float32)}
    for width in WIDTHS:
        kernel = rng.normal(0, 0.1, (width * DIMENSIONS, FILTERS)).astype(np.float32)
        kernel[0, 0] = 1
        model[f"filter{width}"] = kernel
        model[f"bias{width}"] = np.zeros(FILTERS, np.float32)
    out = rng.normal(0, 0.05, FILTERS * len(WIDTHS)).astype(np.float32)
    out[::FILTERS] = 1
    return {**model, "out": out}


def _forward(model, documents, features):
    """Pooled values, the places they come from and the inputs there, for training."""
    gap = max(WIDTHS) - 1
    numbers = np.concatenate([np.concatenate((d, np.zeros(gap, np.int64))) for d in documents])
    lengths = np.array([max(1, len(d)) for d in documents])
    sizes = np.array([len(d) + gap for d in documents])
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    vectors = np.concatenate([
        model["embedding"][features[numbers[at:at + STRETCH]]].sum(axis=1)
        for at in range(0, len(numbers), STRETCH)])
    pooled, places = [], []
    for width in WIDTHS:
        count = len(numbers) - width + 1
        values = np.concatenate([
            np.hstack([vectors[at + n:min(at + STRETCH, count) + n] for n in range(width)])
            @ model[f"filter{width}"] + model[f"bias{width}"]
            for at in range(0, count, STRETCH)])
        at = np.array([
            start + values[start:start + length].argmax(axis=0) for start, length in zip(starts, lengths)
        ])
        pooled.append(np.take_along_axis(values, at, axis=0))
        places.append(at)
    return numbers, vectors, np.concatenate(pooled, axis=1), places


def gradients(model, documents, labels, weights, features):
    """Slopes of the mean weighted log loss plus PENALTY / 2 times the squares of the output
    layer, by name of the weights; those of the embedding as (buckets, slopes)."""
    numbers, vectors, pooled, places = _forward(model, documents, features)
    active = np.maximum(pooled, 0)
    logits = active @ model["out"] + model["offset"]
    error = (1 / (1 + np.exp(-np.clip(logits, -30, 30))) - labels) * weights
    error = (error / len(documents)).astype(np.float32)
    into = error[:, None] * model["out"] * (pooled > 0)
    found, touched, amounts = {}, [], []
    for n, width in enumerate(WIDTHS):
        part = into[:, n * FILTERS:(n + 1) * FILTERS]
        kernel = model[f"filter{width}"]
        at = places[n]
        inputs = np.concatenate([vectors[at + shift] for shift in range(width)], axis=2)
        back = part[:, :, None] * kernel.T[None]
        for shift in range(width):
            touched.append(numbers[at + shift].ravel())
            amounts.append(back[:, :, shift * DIMENSIONS:(shift + 1) * DIMENSIONS]
                           .reshape(-1, DIMENSIONS))
        found[f"filter{width}"] = np.einsum("nf,nfk->kf", part, inputs)
        found[f"bias{width}"] = part.sum(axis=0)
    found["out"] = active.T @ error + PENALTY * model["out"]
    found["offset"] = error.sum(keepdims=True)
    # Sum the slopes by word, then by bucket.
    words, place = np.unique(np.concatenate(touched), return_inverse=True)
    by_word = np.zeros((len(words), DIMENSIONS), np.float32)
    np.add.at(by_word, place, np.concatenate(amounts))
    keep = words > 0
    buckets, place = np.unique(features[words[keep]].ravel(), return_inverse=True)
    by_bucket = np.zeros((len(buckets), DIMENSIONS), np.float32)
    np.add.at(by_bucket, place, np.repeat(by_word[keep], _PARTS, axis=0))
    found["embedding"] = buckets, by_bucket
    return found


def start(seen, seed=SEED):
    """First weights, their Adagrad state and the generator that orders the rows."""
    rng = np.random.default_rng(seed)
    model = _initial(rng, separation(seen))
    return model, {k: np.full_like(v, 1e-2) for k, v in model.items()}, rng


def label_weights(seen):
    """What a row of either label weighs: rare labels weigh more."""
    share = min(max(float(seen[1, 0] / seen[:, 0].sum()), 0.02), 0.98)
    return np.array([0.5 / (1 - share), 0.5 / share], np.float32)


def _batches(order, sizes):
    """Rows of one step: about BATCH, fewer where their words are very many."""
    for chosen in np.array_split(order, max(1, len(order) // BATCH)):
        turn = np.cumsum(sizes[chosen]) // MOST_WORDS
        yield from np.split(chosen, np.flatnonzero(np.diff(turn)) + 1)


def train_epoch(model, state, documents, labels, weights, features, order):
    """One pass over documents given as word numbers, in place. Adagrad."""
    labels = np.asarray(labels, np.float32)
    rate = 0.03

    def step(name, gradient, rows=None):
        if rows is None:
            state[name] += gradient * gradient
            model[name] -= rate * gradient / np.sqrt(state[name])
        else:
            state[name][rows] += gradient * gradient
            model[name][rows] -= rate * gradient / np.sqrt(state[name][rows])

    for chosen in _batches(order, np.array([len(d) for d in documents])):
        found = gradients(model, [documents[n] for n in chosen], labels[chosen],
                          weights[labels[chosen].astype(int)], features)
        buckets, amounts = found.pop("embedding")
        for name, gradient in found.items():
            step(name, gradient)
        step("embedding", amounts, buckets)


def language_counts(documents, languages, features):
    """Words of each known language by bucket."""
    table = {}
    for numbers, language in zip(documents, languages):
        if language is not None:
            np.add.at(table.setdefault(language, np.zeros(BUCKETS)), features[numbers, 0], 1)
    return table


def learn_languages(counts):
    """Log frequencies of hashed words by language; None where no language is known."""
    if not counts:
        return None
    table = np.stack([counts[language] for language in sorted(counts)]) + 0.5
    table = np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32)
    table[:, 0] = 0  # no word
    return table.T.copy()


class Scorer:
    """Logits and language numbers of whole texts, for one worker."""

    def __init__(self, model, languages):
        self.model, self.languages = model, languages
        self.kernel = np.hstack([
            model[f"filter{w}"][s * DIMENSIONS:(s + 1) * DIMENSIONS]
            for w in WIDTHS for s in range(w)])
        self._fresh()

    def _fresh(self):
        self.words = Words()
        groups = 1 if self.languages is None else self.languages.shape[1]
        self.vectors = np.zeros((1, DIMENSIONS), np.float32)
        self.likely = np.zeros((1, groups), np.float32)

    def _extend(self):
        new = np.array(self.words.features[len(self.vectors):], np.int64).reshape(-1, _PARTS)
        if len(new):
            added = self.model["embedding"][new].sum(axis=1)
            self.vectors = np.concatenate((self.vectors, added))
            likely = (np.zeros((len(new), 1), np.float32) if self.languages is None
                      else self.languages[new[:, 0]])
            self.likely = np.concatenate((self.likely, likely))

    def _pool(self, numbers, owners, count):
        """The largest value of each filter by document, over all its words."""
        gap = max(WIDTHS) - 1
        pooled = np.full((count, FILTERS * len(WIDTHS)), -np.inf, np.float32)
        for start in range(0, len(numbers) - gap, CHUNK):
            part = self.vectors[numbers[start:start + CHUNK + gap]] @ self.kernel
            size = min(CHUNK, len(numbers) - gap - start)
            owner = owners[start:start + size]
            firsts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            column, which = 0, owner[firsts]
            for n, width in enumerate(WIDTHS):
                values = part[:size, column:column + FILTERS].copy()
                for shift in range(1, width):
                    at = column + shift * FILTERS
                    values += part[shift:shift + size, at:at + FILTERS]
                column += width * FILTERS
                found = np.maximum.reduceat(values, firsts, axis=0)
                into = pooled[which, n * FILTERS:(n + 1) * FILTERS]
                pooled[which, n * FILTERS:(n + 1) * FILTERS] = np.maximum(into, found)
        bias = np.concatenate([self.model[f"bias{w}"] for w in WIDTHS])
        return np.maximum(pooled + bias, 0)

    def score(self, texts):
        if len(self.words.features) > KEPT_WORDS:
            self._fresh()
        documents = [self.words.numbers(words_of(t)) for t in texts]
        return self.score_numbers(documents)

    def score_numbers(self, documents):
        self._extend()
        gap = max(WIDTHS) - 1
        pad = np.zeros(gap, np.int64)
        # A text without words is one empty place.
        padded = [np.concatenate((d if len(d) else pad[:1], pad)) for d in documents]
        numbers = np.concatenate([*padded, pad])
        owners = np.repeat(np.arange(len(documents)), [len(d) for d in padded])
        # Filters start at words only, as in training; gaps just end them.
        owners = np.concatenate((owners, np.full(gap, len(documents))))
        valid = np.concatenate([np.arange(len(p)) < len(p) - gap for p in padded] + [pad > 0])
        pooled = self._pool(numbers, np.where(valid, owners, len(documents)), len(documents) + 1)
        logits = pooled[:-1] @ self.model["out"] + self.model["offset"]
        likely = np.array([self.likely[d].sum(axis=0) for d in documents])
        return logits.astype(np.float64), likely.argmax(axis=1)


def thresholds(logits, groups, labels, count, rows=None):
    """The logit that parts the labels best, for each language.

    Best is the largest sum of the share of labels 1 found and twice the share of labels
    0 left alone; of equal cuts the middle of the widest gap. The rows of the other
    languages count as much as PRIOR_ROWS rows, which settles languages with few labels.
    Without labels of both kinds the cut is 0. An entry stands for one row, or as many
    as `rows` tells.
    """
    wanted = np.asarray(labels) > 0
    if wanted.all() or not wanted.any():
        return np.zeros(count)
    rows = np.ones(len(logits)) if rows is None else np.asarray(rows, np.float64)
    order = np.argsort(logits, kind="stable")
    values, wanted, groups, rows = logits[order], wanted[order], groups[order], rows[order]
    edges = np.concatenate(([values[0] - 1], values, [values[-1] + 1]))
    gaps = np.diff(edges)
    cuts = []
    for group in range(count):
        own = groups == group
        weight = rows * np.where(own, 1.0, PRIOR_ROWS / max(1, rows[~own].sum()))
        ones, zeros = weight * wanted, weight * ~wanted
        # Cut before each place: labels 0 before and labels 1 from there on.
        right = (2 * np.concatenate(([0], np.cumsum(zeros))) / zeros.sum()
                 + 1 - np.concatenate(([0], np.cumsum(ones))) / ones.sum())
        right[gaps <= 0] = -1
        best = np.flatnonzero(right >= right.max() - 1e-3)
        place = best[gaps[best].argmax()]
        cuts.append((edges[place] + edges[place + 1]) / 2)
    return np.array(cuts)


def calibrated(logits, cuts):
    """Scores from 0 to 1 that reach CUT where the logit reaches its language's cut."""
    return 1 / (1 + np.exp(-np.clip(logits - cuts + np.log(CUT / (1 - CUT)), -30, 30)))


class Part:
    """Labelled rows as word numbers, every fourth to calibrate."""

    def __init__(self, documents, features, labels, languages, everything=False):
        self.documents, self.features = documents, features
        self.labels, self.languages = labels, languages
        turn = np.arange(len(documents)) % CALIBRATE
        self.fitted = np.flatnonzero((turn > 0) | everything)
        self.rest = np.flatnonzero((turn == 0) | everything)

    @classmethod
    def of_texts(cls, rows, everything=False):
        """From rows (text, label, language)."""
        words = Words()
        documents = [words.numbers(words_of(text)) for text, _, _ in rows]
        return cls(documents, np.array(words.features), np.array([r[1] for r in rows], np.int64),
                   [r[2] for r in rows], everything)

    def packed(self):
        """Columns of one row that `unpacked` reads."""
        return [np.array([len(d) for d in self.documents], np.int32).tobytes(),
                np.concatenate(self.documents).astype(np.int32).tobytes(),
                self.features.astype(np.int32).tobytes(), self.labels.astype(np.int8).tobytes(),
                self.languages]

    @classmethod
    def unpacked(cls, sizes, numbers, features, labels, languages, everything=False):
        ends = np.cumsum(np.frombuffer(sizes, np.int32))
        numbers = np.frombuffer(numbers, np.int32).astype(np.int64)
        return cls(np.split(numbers, ends[:-1]),
                   np.frombuffer(features, np.int32).reshape(-1, _PARTS).astype(np.int64),
                   np.frombuffer(labels, np.int8).astype(np.int64), languages, everything)

    def _of(self, chosen):
        return [self.documents[n] for n in chosen], self.labels[chosen]

    def counts(self):
        """Of the fitted rows by label and bucket, and of all words by language."""
        return (bucket_counts(*self._of(self.fitted), self.features),
                language_counts(self.documents, self.languages, self.features))

    def fit(self, model, state, weights, rng, epoch):
        """Train in place; the buckets that the rows have, None without rows."""
        if not len(self.fitted):
            return None
        documents, labels = self._of(self.fitted)
        rng = copy.deepcopy(rng)
        for _ in range(epoch + 1):
            order = rng.permutation(len(documents))
        train_epoch(model, state, documents, labels, weights, self.features, order)
        seen = [np.unique(d) for d in documents]
        return np.unique(self.features[np.concatenate(seen)])

    def calibration(self, model, languages):
        """Logits on the grid, guessed languages and labels of the other rows."""
        scorer = Scorer(model, languages)
        scorer.words.features = self.features
        documents, labels = self._of(self.rest)
        logits, groups = [np.zeros(0)], [np.zeros(0, np.int64)]
        for start in range(0, len(documents), 256):
            a, b = scorer.score_numbers(documents[start:start + 256])
            logits.append(np.round(a / GRID) * GRID)
            groups.append(b)
        return np.concatenate(logits), np.concatenate(groups), labels


def learn(rows):
    """A model from rows (text, label, language) at hand; None without rows of both labels."""
    if len({label for _, label, _ in rows}) < 2:
        return None
    for everything in (False, True):
        part = Part.of_texts(rows, everything)
        seen, languages = part.counts()
        if seen[:, 0].all():
            break
    model, state, rng = start(seen)
    for epoch in range(EPOCHS):
        part.fit(model, state, label_weights(seen), rng, epoch)
    languages = learn_languages(languages)
    count = 1 if languages is None else languages.shape[1]
    cuts = thresholds(*part.calibration(model, languages), count)
    return {"model": model, "languages": languages, "cuts": cuts}


_PACKED = "sizes binary, numbers binary, features binary, labels binary, languages array<string>"


def packed_parts(rows, shards):
    """`labelled_rows` by shard, one row for each part, so that words are found once."""
    def run(batches):
        import pyarrow as pa

        for found in parts(pieces(batches, text=0), "_text"):
            part = Part.of_texts([(r["_text"], r["label"], r["_lang"]) for r in found])
            types = [pa.binary()] * 4 + [pa.list_(pa.string())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([value], kind) for value, kind in zip(part.packed(), types)],
                names=["sizes", "numbers", "features", "labels", "languages"])

    return dealt(rows, shards, ["order", "_id"]).mapInArrow(run, _PACKED)


def _read(everything=False):
    """Parts from Arrow batches of `packed_parts`."""
    def read(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                yield Part.unpacked(*[c[row].as_py() for c in batch.columns], everything)
    return read


def _all_counts(rows, read):
    """`Part.counts` of all rows, summed by Spark."""
    schema = "label int, lang string, bucket int, n double"

    def run(batches):
        import pyarrow as pa

        for part in read(batches):
            seen, languages = part.counts()
            found = [(label, None, seen[label]) for label in (0, 1)]
            found += [(None, language, counts) for language, counts in languages.items()]
            for label, language, counts in found:
                at = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([label] * len(at), pa.int32()),
                     pa.array([language] * len(at), pa.string()),
                     pa.array(at, pa.int32()), pa.array(counts[at])],
                    names=["label", "lang", "bucket", "n"])

    with tidy(rows.sparkSession):
        sums = rows.mapInArrow(run, schema).groupBy("label", "lang", "bucket").agg(
            F.sum("n").alias("n")).toArrow()
    buckets, n = sums.column("bucket").to_numpy(), sums.column("n").to_numpy()
    labels = sums.column("label").to_pandas().fillna(-1).to_numpy(np.int64)
    names = np.array(sums.column("lang").to_pylist(), object)
    seen, languages = np.zeros((2, BUCKETS)), {}
    for label in (0, 1):
        at = labels == label
        seen[label, buckets[at]] = n[at]
    for language in {x for x in names.tolist() if x is not None}:
        at = names == language
        languages[language] = np.zeros(BUCKETS)
        languages[language][buckets[at]] = n[at]
    return seen, languages


def _all_cuts(rows, read, model, languages):
    """Thresholds from the calibration rows of all parts, counted by logit."""
    shared = rows.sparkSession.sparkContext.broadcast((model, languages))

    def run(batches):
        import pyarrow as pa

        for part in read(batches):
            logits, groups, labels = part.calibration(*shared.value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(logits), pa.array(groups, pa.int32()), pa.array(labels, pa.int32())],
                names=["logit", "group", "label"])

    found = rows.mapInArrow(run, "logit double, group int, label int").groupBy(
        "logit", "group", "label").count().toArrow()
    columns = [found.column(c).to_numpy() for c in ("logit", "group", "label")]
    count = 1 if languages is None else languages.shape[1]
    return thresholds(*columns, count, found.column("count").to_numpy())


def learn_all(rows):
    """A model from all `labelled_rows`; None without rows of both labels. Shards of about
    SHARD_ROWS rows train apart in each epoch; with one shard it is what `learn` finds."""
    with tidy(rows.sparkSession):
        size = rows.count()
    rows = stored(packed_parts(rows, max(1, -(-size // SHARD_ROWS))), "toxicity-parts")
    for everything in (False, True):
        read = _read(everything)
        seen, languages = _all_counts(rows, read)
        if seen[:, 0].all():
            break
    else:
        discard(rows)
        return None
    languages = learn_languages(languages)
    model, state, rng = start(seen)
    weights = label_weights(seen)
    small = np.arange(BUCKETS, len(flat(model)))
    for epoch in range(EPOCHS):
        def fit(model, state, part, epoch=epoch):
            touched = part.fit(model, state, weights, rng, epoch)
            return None if touched is None else np.concatenate((touched, small))

        model, state = train_round(rows, model, state, fit, read)
    cuts = _all_cuts(rows, read, model, languages)
    discard(rows)
    return {"model": model, "languages": languages, "cuts": cuts}


def labelled_rows(docs, labels, label, id_col="doc_id", text_col="text", lang_col="lang"):
    """All documents that have a label and a text and are not held out: _text, label,
    _lang, order and _id; of rows that share an id the one with the smallest hash of its
    text."""
    known = labels.where(F.col(label).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(
        (F.max(F.col(label).cast("int")) > 0).cast("int").alias("label"))
    known = known.where(~held_out("_id") & F.col("_id").isNotNull())
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"),
                        F.col(lang_col).alias("_lang"))
    found = texts.where(F.col("_text").isNotNull() & ~held_out("_id")).join(known, "_id")
    # One text of each id.
    one = F.min_by(F.struct("_text", "_lang"), F.struct(
        F.xxhash64("_text"), F.col("_text"), F.col("_lang"))).alias("one")
    found = found.groupBy("_id").agg(one, F.first("label").alias("label"))
    return found.select("one._text", "label", "one._lang",
                        F.xxhash64(F.lit(SEED), "_id").alias("order"), "_id")


def labelled_sample(docs, labels, label, id_col="doc_id", text_col="text", lang_col="lang",
                    positive=SAMPLE_POSITIVE, negative=SAMPLE_NEGATIVE):
    """Rows (text, label, language) for `learn`: of each label those `labelled_rows` with
    the smallest hashes of their ids."""
    rows = labelled_rows(docs, labels, label, id_col, text_col, lang_col)
    ones = rows.where("label > 0").orderBy("order").limit(positive)
    zeros = rows.where("label = 0").orderBy("order").limit(negative)
    found = ones.unionByName(zeros).collect()
    found.sort(key=lambda row: (row["order"], str(row["_id"])))
    return [(row["_text"], row["label"], row["_lang"]) for row in found]


def score_documents(docs, learned, id_col="doc_id", text_col="text"):
    """`id_col`, score and predicted for every row, by what `learn` or `learn_all` found.

    The whole text counts. Null and empty texts, and texts without words, score as one
    empty place. Without rows of both labels nothing can be learned: all score 0. Ids may
    be null or repeat; only the two named columns are read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(learned)
    schema = T.StructType([docs.schema[id_col], T.StructField("score", T.DoubleType())])

    def run(batches):
        import pyarrow as pa

        learned = shared.value
        scorer = learned and Scorer(learned["model"], learned["languages"])
        for piece in pieces(batches):
            if scorer is None:
                scores = np.zeros(piece.num_rows)
            else:
                logits, groups = scorer.score(piece.column(1).to_pylist())
                scores = calibrated(logits, learned["cuts"][groups])
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(scores)],
                                             names=schema.names)

    found = docs.select(id_col, plain_text(text_col).alias("_text")).mapInArrow(run, schema)
    return found.withColumn("predicted", (F.col("score") >= CUT).cast("int"))


def score_toxicity(docs, labels, id_col="doc_id", text_col="text", label="toxic"):
    """Learn from all labelled rows that are not held out and score every row; adds
    held_out to the columns of `score_documents`."""
    learned = learn_all(labelled_rows(docs, labels, label, id_col, text_col))
    found = score_documents(docs, learned, id_col, text_col)
    return found.select(id_col, held_out(id_col).alias("held_out"), "score", "predicted")
