"""Secrets in texts: fixed patterns, and a character convolutional network.

The patterns give the base spans, which always stay. Every candidate is scored with the
characters around it by a small convolutional network in numpy; candidates beside base
spans whose probability reaches the threshold are added. A candidate is what is assigned
to a name that credentials have, whatever it looks like, and every run of eight key-like
characters or more that is not just words and numbers: a word is up to 20 letters in
lower case, in capitals or with one capital first.

The network learns from labelled findings: all base spans and ordinary runs of the
corpus, in shards that train apart and meet in the mean after each epoch, and generated
ones in well-known formats. A run is
ordinary if it is made of words and numbers and no credential's name stands before it;
all other candidates may be secrets that no pattern knows, and have no label. A part that
the network is not fitted to calibrates its probabilities and sets the threshold, as high
as the wanted recall of findings allows. Base findings are only fitted to: they stay
whatever their probability, so the threshold must not count on them.
"""

import copy
import random
import re
import string

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wavelode.llm.averaging import dealt, flat, parts, train_round
from wavelode.llm.common import discard, pieces, plain_text, stored

# The kinds of base spans in their order, their patterns and least lengths.
KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
_NAMES = ("password", "passwd", "secret", "token", "api_key", "apikey")
# Kind of the spans that the network adds.
MODEL = "model"

# Candidates besides the base spans.
_RUN = re.compile(r"[A-Za-z0-9+/_=.-]{8,}")
_PLAIN = re.compile(
    r"[+/_=.-]*(?:(?:[A-Za-z]?[a-z]{0,19}|[A-Z]{1,20}|[0-9]+)(?:[+/_=.-]+|$))*")
_CREDENTIAL = re.compile(
    r"""(?:pwd|passphrase|credentials?|key|bearer|auth|signature|sig|pass|pin)"""
    r"""["']?\x20*[:=]\x20*["']?([^\s"']{8,})""",
    re.IGNORECASE | re.ASCII)
_CREDENTIAL_NAMES = (
    "pwd", "passphrase", "credential", "key", "bearer", "auth", "sig", "pass", "pin")
# What ordinary runs are made of: words, perhaps with a short number, and numbers. Tokens
# mix letters and digits, or letters of both cases, in another way.
_PART = r"(?:(?:(?:[A-Z]?[a-z]{2,}){1,4}|[A-Z]{2,12}|[A-Za-z])?[0-9]{0,4}|[0-9]{5,14}|[0-9]{1,2}T[0-9]{1,2})"
_UUID = r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"
_ORDINARY = re.compile(rf"{_UUID}|{_PART}(?:[+/_=.-]+{_PART})*")
_LONGEST_WORD = re.compile("[A-Za-z]{41}")
# Beginnings that tokens of well-known kinds have.
_TOKEN = re.compile(r"AKIA|gh[a-z]_|xox[a-z]-|[sr]k_(?:live|test)_|AIza|eyJ|glpat-|npm_|pypi-")
_NAMED = re.compile(
    r"(?:key|auth|bearer|token|secret|passw\w*|passphrase|pwd|credentials?|signature)\W{0,6}$",
    re.IGNORECASE | re.ASCII)

# Characters of a window before, of and after a candidate; a longer candidate has
# several windows and takes the largest score.
BEFORE, INSIDE, AFTER = 24, 64, 8
WINDOW = BEFORE + INSIDE + AFTER

# Findings of the corpus that train together, about.
SHARD_FINDINGS = 3000
GENERATED = 2500  # of each label
CALIBRATE = 4
# Share of calibration findings that the threshold must let through.
RECALL = 0.98
SEED = 11

DIMENSIONS, WIDTHS, FILTERS, EPOCHS, BATCH = 8, (3, 5), 16, 8, 64
STEPS = 900  # batches that training takes at least
# Calibration counts logits in steps of this size.
GRID = 2.0 ** -12
_SYMBOLS = 98  # padding, other, and the printable ASCII characters


def base_spans(text):
    """(kind number, start, end) by start, then kind."""
    found = []
    low = text.lower()
    if any(name in low for name in _NAMES):
        found += [(0, m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(1, m.start(), m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [(2, m.start(), m.end()) for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], s[0]))


def candidates(text, base):
    """(start, end, is a base finding) of everything the network looks at."""
    found = [(s, e, True) for _, s, e in base]
    taken = sorted((s, e) for _, s, e in base)
    more = [m.span() for m in _RUN.finditer(text) if not _PLAIN.fullmatch(m[0])]
    low = text.lower()
    if any(name in low for name in _CREDENTIAL_NAMES):
        more += [m.span(1) for m in _CREDENTIAL.finditer(text)]
    at, last = 0, -1
    for start, end in sorted(more):
        while at < len(taken) and taken[at][1] <= start:
            at += 1
        if start < last or at < len(taken) and taken[at][0] < end:
            continue  # overlaps a base span or the candidate before
        found.append((start, end, False))
        last = end
    return found


def ordinary(around, before, length):
    """Can the candidate be no secret? Words and numbers that no credential's name precedes."""
    run = around[before:before + length]
    return (_ORDINARY.fullmatch(run) is not None and not _LONGEST_WORD.search(run)
            and not _TOKEN.match(run) and not _NAMED.search(around[:before]))


def context(text, start, end):
    """The candidate with its surroundings, and how many characters come before it."""
    before = min(BEFORE, start)
    return text[start - before:end + AFTER], before


def _symbols(text):
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    return np.where((points >= 32) & (points < 127), points - 30, 1)


def windows(around, before, length):
    """Rows of WINDOW symbols; symbols of the candidate itself are a set of their own."""
    found = _symbols(around)
    found[before:before + length] += _SYMBOLS
    padded = np.concatenate((np.zeros(BEFORE - before, np.int64), found,
                             np.zeros(INSIDE + AFTER, np.int64)))
    starts = range(0, max(1, length), INSIDE)
    return np.stack([padded[s:s + WINDOW] for s in starts])


def _initial(rng):
    model = {"embedding": rng.normal(0, 0.3, (2 * _SYMBOLS, DIMENSIONS)).astype(np.float32)}
    for width in WIDTHS:
        scale = 1 / np.sqrt(width * DIMENSIONS)
        model[f"filter{width}"] = rng.normal(0, scale, (width * DIMENSIONS, FILTERS)).astype(np.float32)
        model[f"bias{width}"] = np.zeros(FILTERS, np.float32)
    model["out"] = rng.normal(0, 0.1, 2 * FILTERS * len(WIDTHS)).astype(np.float32)
    model["offset"] = np.zeros(1, np.float32)
    return model


def _forward(model, rows):
    """Logits, and what the backward pass needs."""
    vectors = model["embedding"][rows]
    pooled, kept = [], []
    for width in WIDTHS:
        count = WINDOW - width + 1
        stacked = np.concatenate([vectors[:, s:s + count] for s in range(width)], axis=2)
        values = np.maximum(stacked @ model[f"filter{width}"] + model[f"bias{width}"], 0)
        kept.append((stacked, values))
        pooled += [values.max(axis=1), values.mean(axis=1)]
    pooled = np.concatenate(pooled, axis=1)
    return pooled @ model["out"] + model["offset"], pooled, kept


def logits(model, rows):
    return np.concatenate([
        _forward(model, rows[at:at + 512])[0] for at in range(0, len(rows), 512)
    ]) if len(rows) else np.zeros(0, np.float32)


def start(seed=SEED):
    """First weights, their Adagrad state and the generator of the training."""
    rng = np.random.default_rng(seed)
    model = _initial(rng)
    return model, {k: np.full_like(v, 1e-3) for k, v in model.items()}, rng


def epochs_for(count):
    """How often training goes over so many rows."""
    return max(EPOCHS, -(-STEPS * BATCH // max(1, count)))


def _turns(rng, count):
    """The rows of each batch of an epoch, and which of them may be blanked."""
    for chosen in np.array_split(rng.permutation(count), max(1, count // BATCH)):
        yield chosen, rng.random(len(chosen)) < 0.5


def train_epoch(model, state, rows, labels, bare, rng):
    """One pass over windows, in place. Half of the time the surroundings are blanked, so
    that a finding is known by its own look too, but only for rows that are `bare`: a name
    before the others may be all that tells. Adagrad, with both labels weighing alike."""
    labels = np.asarray(labels, np.float32)
    share = float(np.clip(labels.mean(), 0.02, 0.98))
    weights = np.where(labels > 0, 0.5 / share, 0.5 / (1 - share))

    def step(name, gradient):
        state[name] += gradient * gradient
        model[name] -= 0.05 * gradient / np.sqrt(state[name])

    for chosen, blanked in _turns(rng, len(rows)):
        batch = rows[chosen]
        blank = (bare[chosen] & blanked)[:, None] & (batch < _SYMBOLS)
        batch = np.where(blank, 0, batch)
        found, pooled, kept = _forward(model, batch)
        error = (1 / (1 + np.exp(-np.clip(found, -30, 30))) - labels[chosen]) * weights[chosen]
        error = (error / len(chosen)).astype(np.float32)
        back = np.zeros((*batch.shape, DIMENSIONS), np.float32)
        into = error[:, None] * model["out"]
        step("out", pooled.T @ error)
        step("offset", error.sum(keepdims=True))
        for n, width in enumerate(WIDTHS):
            stacked, values = kept[n]
            at = 2 * n * FILTERS
            count = values.shape[1]
            slope = np.repeat(into[:, None, at + FILTERS:at + 2 * FILTERS] / count, count, axis=1)
            top = values.argmax(axis=1)
            np.put_along_axis(
                slope, top[:, None],
                np.take_along_axis(slope, top[:, None], 1) + into[:, None, at:at + FILTERS], 1)
            slope = slope * (values > 0)
            flat = slope.reshape(-1, FILTERS)
            inner = flat @ model[f"filter{width}"].T
            step(f"filter{width}", stacked.reshape(-1, width * DIMENSIONS).T @ flat)
            step(f"bias{width}", flat.sum(axis=0))
            inner = inner.reshape(len(batch), count, width, DIMENSIONS)
            for shift in range(width):
                back[:, shift:shift + count] += inner[:, :, shift]
        gradient = np.zeros_like(model["embedding"])
        np.add.at(gradient, batch.ravel(), back.reshape(-1, DIMENSIONS))
        step("embedding", gradient)


def generated(count=GENERATED, seed=SEED):
    """Labelled findings (context, before, length, label) in well-known formats."""
    rng = random.Random(seed)
    lower, upper, digits = string.ascii_lowercase, string.ascii_uppercase, string.digits
    alphanumeric, hexadecimal = lower + upper + digits, digits + "abcdef"

    def some(alphabet, least, most=None):
        return "".join(rng.choice(alphabet) for _ in range(rng.randint(least, most or least)))

    def word():
        if rng.random() < 0.3:
            return some(lower, 2, 9)
        return "".join(some("bcdfghklmnprstvwz", 1) + some("aeiou", 1) + rng.choice(["", "n", "r", "s"])
                       for _ in range(rng.randint(1, 3)))

    secrets = [
        lambda: some(hexadecimal, 32, 64),
        lambda: "AKIA" + some(upper + digits, 16),
        lambda: "ghp_" + some(alphanumeric, 36),
        lambda: "xoxb-" + some(digits, 12) + "-" + some(alphanumeric, 24),
        lambda: "sk_live_" + some(alphanumeric, 24),
        lambda: "AIza" + some(alphanumeric + "_-", 35),
        lambda: "eyJ" + some(alphanumeric, 20, 40) + "." + some(alphanumeric + "_-", 30, 60),
        lambda: some(alphanumeric + "+/", 40),
        lambda: some(alphanumeric, 20, 48),
        lambda: some(alphanumeric + "+/", 30, 60) + "=",
        lambda: "glpat-" + some(alphanumeric + "_-", 20),
        lambda: "npm_" + some(alphanumeric, 36),
        lambda: some(alphanumeric, 16, 20),
    ]
    # Short ones and plain letters are secrets by the name before them alone.
    named = [
        lambda: some(alphanumeric, 10, 15), lambda: some(lower, 16, 32),
        lambda: some(alphanumeric + "!#$%&*@", 10, 24), lambda: some(upper + digits, 12, 24),
    ]
    others = [
        lambda: f"{word()}{rng.randint(0, 99)}.example.com",
        lambda: f"www.{word()}{rng.randint(1, 9)}.org/{word()}/{word()}",
        lambda: f"{rng.randint(1990, 2030)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}T10.{rng.randint(10, 59)}",
        lambda: f"{word()}-{word()}-{rng.randint(1, 99)}.{word()[:3]}",
        lambda: f"/{word()}/{word()}/{word()}{rng.randint(0, 9)}.txt",
        lambda: f"{word()}_{word()}_{word()}_{rng.randint(1, 999)}",
        lambda: f"v{rng.randint(0, 20)}.{rng.randint(0, 20)}.{rng.randint(0, 99)}-{word()}{word()}",
        lambda: word().title() + word().title() + word().title() + str(rng.randint(0, 9)),
        lambda: "=" * rng.randint(8, 30) + word() + str(rng.randint(0, 9)),
        lambda: "-".join(word() for _ in range(4)) + f"-{rng.randint(1, 2030)}",
        lambda: f"{some(digits, 8, 14)}.{some(digits, 2)}{word()[:2]}",
        lambda: "".join(word() for _ in range(4)) + str(rng.randint(0, 99)),
        lambda: "-".join(some(hexadecimal, n) for n in (8, 4, 4, 4, 12)),
        lambda: "-".join(some(digits + "ABCDEF", n) for n in (8, 4, 4, 4, 12)),
        lambda: f"{word()}-{word()}-{version()}{rng.choice(['', '-SNAPSHOT', '-RC1', '.Final'])}.jar",
        lambda: f"{word()}-{version()}.tar.gz",
        lambda: f"{word()}{rng.choice(['', '_'])}{word()}-v{rng.randint(0, 9)}.{rng.randint(0, 20)}",
        lambda: f"{rng.randint(1990, 2030)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}"
                f"T{rng.randint(10, 23)}.{rng.randint(10, 59)}.{rng.randint(10, 59)}Z",
        lambda: ".".join(str(rng.randint(1, 255)) for _ in range(4)) + "/" + str(rng.randint(8, 32)),
        lambda: f"{some(upper, 2, 4)}-{some(digits, 3, 6)}",
        lambda: f"{word()}.{word()}{rng.randint(1, 9)}.{word().title()}{word().title()}",
        lambda: word() + "".join(word().title() for _ in range(rng.randint(1, 4))),
        lambda: "".join(word().title() for _ in range(rng.randint(2, 5))),
        lambda: word() + word().title() + rng.choice(["Id", "ID", "URL", "Test", "V2", "Impl"]),
        lambda: some(upper, 2, 4) + some(digits, 4, 10),
        lambda: f"{some(digits, 1, 4)}{rng.choice(['px', 'km', 'GB', 'mg', 'th'])}-{word()}",
        lambda: f"{word()}/{word()}_{rng.randint(1, 99)}/{word()}.{rng.choice(['py', 'md', 'html'])}",
    ]

    def version():
        return ".".join(str(rng.randint(0, 30)) for _ in range(rng.randint(2, 4)))

    names = ["key", "auth", "Authorization: Bearer", "pwd", "credential", "access_key", "signature",
             "passphrase", "private_key", "PWD", "Key"]
    out = []
    for n in range(2 * count):
        secret = n % 2 == 0
        by_name = secret and rng.random() < 0.3
        value = rng.choice(named if by_name else secrets if secret else others)()
        lead = " ".join(word() for _ in range(3)) + " "
        if by_name or rng.random() < (0.5 if secret else 0.05):
            lead = lead + rng.choice(names) + rng.choice([" = ", ": ", "=", '="'])
        lead = lead[-BEFORE:]
        out.append((lead + value + (" " + word())[:AFTER], len(lead), len(value), secret))
    return out


def prepared(findings):
    """Windows, labels and bare of findings (context, before, length, label), and which of
    them are fitted to: of each label every fourth calibrates, but for base findings."""
    rows, labels, based, bare = [], [], [], []
    for around, before, length, label in findings:
        bare.append(_NAMED.search(around[:before]) is None)
        rows.append(windows(around, before, length)[0])
        labels.append(bool(label))
        based.append(any(s < before + length and e > before for _, s, e in base_spans(around)))
    rows, labels, based, bare = (
        np.stack(rows), np.array(labels), np.array(based), np.array(bare))
    turn = np.zeros(len(rows), np.int64)
    for label in (True, False):
        of = (labels == label) & ~based
        turn[of] = np.arange(of.sum()) + 1
    return rows, labels, bare, (turn % CALIBRATE > 0) | based


def calibrated(model, values, truth, counts, recall=RECALL):
    """What is learned, from logits of findings that the model was not fitted to: so many
    (counts) of each logit and label.

    threshold is the highest that keeps the recall of those of label 1, however low it
    is; recall is what it reaches there.
    """
    # Probability = logistic(slope * logit + shift), fitted by Newton steps with a ridge.
    inputs = np.stack([values, np.ones(len(values))], axis=1)
    weights = np.array([1.0, 0.0])
    for _ in range(25):
        chance = 1 / (1 + np.exp(-np.clip(inputs @ weights, -30, 30)))
        slope = inputs.T @ (counts * (chance - truth)) + 1e-2 * (weights - [1, 0])
        curve = (inputs * (counts * chance * (1 - chance))[:, None]).T @ inputs + 1e-2 * np.eye(2)
        weights = weights - np.linalg.solve(curve, slope)
    chance = 1 / (1 + np.exp(-np.clip(inputs @ weights, -30, 30)))
    found = np.sort(np.repeat(chance[truth], counts[truth]))
    bar = float(found[int(np.floor(len(found) * (1 - recall)))]) if len(found) else 1.0
    reached = float((found >= bar).mean()) if len(found) else 1.0
    return {"model": model, "weights": weights, "threshold": bar, "recall": reached}


def learn(findings):
    """A calibrated model from labelled findings (context, before, length, label) at hand.

    The threshold counts on findings that are no base findings only.
    """
    rows, labels, bare, fitted = prepared(findings)
    model, state, rng = start()
    for _ in range(epochs_for(fitted.sum())):
        train_epoch(model, state, rows[fitted], labels[fitted], bare[fitted], rng)
    values, truth = logits(model, rows[~fitted]).astype(np.float64), labels[~fitted]
    return calibrated(model, values, truth, np.ones(len(values), np.int64))


def learn_all(findings):
    """A calibrated model from all of `labelled_findings` and the generated ones.

    Shards of about SHARD_FINDINGS train apart in each epoch, each with the generated
    findings beside its own. Those of the generated findings that calibrate do so for all.
    """
    made = prepared(generated())
    fixed = made[-1]
    columns = ["around", "before", "length"]
    of = {row["base"]: row["count"] for row in findings.groupBy("base").count().collect()}
    size = sum(of.values())
    if not size:
        return learn(generated())
    shards = -(-size // SHARD_FINDINGS)
    rows = stored(dealt(findings, shards, columns), "secret-findings")

    def read(batches):
        for part in parts(pieces(batches, text=0), "around"):
            yield prepared([(r["around"], r["before"], r["length"], r["base"]) for r in part])

    model, state, rng = start()
    every = np.arange(len(flat(model)))
    ordinary_rows = of.get(False, 0)
    count = fixed.sum() + (size - ordinary_rows // CALIBRATE) // shards
    for epoch in range(epochs_for(count)):
        def fit(model, state, part, epoch=epoch):
            *own, fitted = part
            windows, labels, bare = (np.concatenate((new[fitted], old[fixed]))
                                     for new, old in zip(own, made))
            turns = copy.deepcopy(rng)
            for _ in range(epoch):  # what the epochs before drew
                for _ in _turns(turns, len(windows)):
                    pass
            train_epoch(model, state, windows, labels, bare, turns)
            return every

        model, state = train_round(rows, model, state, fit, read)
    values, counts = _all_logits(rows, read, model)
    discard(rows)
    own = logits(model, made[0][~fixed]).astype(np.float64)
    return calibrated(
        model, np.concatenate((own, values)),
        np.concatenate((made[1][~fixed], np.zeros(len(values), bool))),
        np.concatenate((np.ones(len(own), np.int64), counts)))


def _all_logits(rows, read, model):
    """Logits of the findings that calibrate, on a grid, and how many have each."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa

        for found, _, _, fitted in read(batches):
            values = np.round(logits(shared.value, found[~fitted]).astype(np.float64) / GRID) * GRID
            yield pa.RecordBatch.from_arrays([pa.array(values)], names=["logit"])

    found = rows.mapInArrow(run, "logit double").groupBy("logit").count().toArrow()
    return found.column("logit").to_numpy(), found.column("count").to_numpy()


def chances(learned, contexts):
    """Probability of each (context, before, length): the largest of its windows."""
    if not contexts:
        return []
    rows = [windows(*c) for c in contexts]
    found = logits(learned["model"], np.concatenate(rows))
    starts = np.concatenate(([0], np.cumsum([len(r) for r in rows])[:-1]))
    slope, shift = learned["weights"]
    best = np.maximum.reduceat(found, starts) if slope >= 0 else np.minimum.reduceat(found, starts)
    return (1 / (1 + np.exp(-np.clip(slope * best + shift, -30, 30)))).tolist()


_SPAN = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
    T.StructField("end", T.LongType()),
])
_CANDIDATE = T.StructType([
    T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
    T.StructField("base", T.BooleanType()), T.StructField("ordinary", T.BooleanType()),
    T.StructField("before", T.LongType()),
    T.StructField("around", T.StringType()),
])


def find_candidates(docs, id_col="doc_id", text_col="text"):
    """`id_col`, base (array of kind, start, end) and candidates of every row."""
    schema = T.StructType([
        docs.schema[id_col], T.StructField("base", T.ArrayType(_SPAN)),
        T.StructField("candidates", T.ArrayType(_CANDIDATE)),
    ])

    def run(batches):
        import pyarrow as pa

        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)
        for piece in pieces(batches):
            spans, found = [], []
            for text in piece.column(1).to_pylist():
                base = base_spans(text)
                spans.append([{"kind": KINDS[k], "start": s, "end": e} for k, s, e in base])
                rows = []
                for start, end, is_base in candidates(text, base):
                    around, before = context(text, start, end)
                    plain = not is_base and ordinary(around, before, end - start)
                    rows.append({"start": start, "end": end, "base": is_base,
                                 "ordinary": plain, "before": before, "around": around})
                found.append(rows)
            yield pa.RecordBatch.from_arrays(
                [piece.column(0).cast(target.field(0).type),
                 pa.array(spans, target.field(1).type), pa.array(found, target.field(2).type)],
                schema=target)

    return docs.select(id_col, plain_text(text_col).alias("_text")).mapInArrow(run, schema)


def labelled_findings(found):
    """All distinct findings of the corpus that have a label: around, before, length, base.

    Label 1 are base findings, label 0 ordinary runs; other candidates have no label.
    """
    rows = found.select(F.explode("candidates").alias("c")).where("c.base or c.ordinary").select(
        "c.around", "c.before", (F.col("c.end") - F.col("c.start")).alias("length"), "c.base")
    # Training sees one window of a finding.
    return rows.select(
        F.substring("around", 1, WINDOW).alias("around"), "before",
        F.least("length", F.lit(INSIDE)).alias("length"), "base",
    ).distinct()


def scan_secrets(docs, id_col="doc_id", text_col="text"):
    """`id_col`, base and spans for every row: base is an array of (kind, start, end) of
    the patterns' findings by start, then kind; spans has these and the spans that the
    network adds, of kind `model`, with the probability of each.

    Places are code points, ends exclusive. A null text counts as empty and has no spans.
    Whole texts are searched. Ids may be null or repeat; other columns are not read.
    """
    found = stored(find_candidates(docs, id_col, text_col), "secret-candidates")
    learned = docs.sparkSession.sparkContext.broadcast(learn_all(labelled_findings(found)))
    scored = T.StructType([*_SPAN, T.StructField("chance", T.DoubleType())])
    schema = T.StructType([
        docs.schema[id_col], T.StructField("base", T.ArrayType(_SPAN)),
        T.StructField("spans", T.ArrayType(scored)),
    ])
    order = {kind: n for n, kind in enumerate((*KINDS, MODEL))}

    def run(batches):
        import pyarrow as pa

        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)
        for piece in pieces(batches, text=3):
            rows = piece.column(2).to_pylist()
            chance = iter(chances(learned.value, [
                (c["around"], c["before"], c["end"] - c["start"]) for row in rows for c in row]))
            out = []
            for base, row in zip(piece.column(1).to_pylist(), rows):
                of = {(c["start"], c["end"], c["base"]): next(chance) for c in row}
                spans = [{**s, "chance": of[s["start"], s["end"], True]} for s in base]
                spans += [{"kind": MODEL, "start": s, "end": e, "chance": p}
                          for (s, e, known), p in of.items()
                          if not known and p >= learned.value["threshold"]]
                out.append(sorted(spans, key=lambda s: (s["start"], order[s["kind"]])))
            yield pa.RecordBatch.from_arrays(
                [piece.column(0).cast(target.field(0).type), piece.column(1),
                 pa.array(out, target.field(2).type)], schema=target)

    # The last column tells how much a row holds, for cutting batches.
    size = F.array_join(F.col("candidates.around"), "").alias("_size")
    return found.select(id_col, "base", "candidates", size).mapInArrow(run, schema)
