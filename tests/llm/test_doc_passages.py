"""Fill-in-middle, passage removal and clustering against plain versions."""

import hashlib
import math
import random

import pytest

from samples import LONG, clashing, frame, near_copies, odd_rows, row, words

from wavelode.llm.clustering import Bisectors, cluster_vectors
from wavelode.llm.fim import digest, fill_in_middle, restore, restored, split, transform
from wavelode.llm.fm_index import FMIndex, WaveletTree, suffix_order
from wavelode.llm.substrings import (
    Words, dedup_passages, marked_runs, search_shard, widths, without_words,
)

MARKS = [b"<P>", b"<M>", b"<S>"]


def sha(text):
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def plain_fim(number, text):
    """The contract, over lists of lines."""
    lines = text.split("\n")
    lines = [s + "\n" for s in lines[:-1]] + lines[-1:] * bool(lines[-1])
    n = len(lines)
    name = hashlib.sha256(f"7:{'' if number is None else number}".encode()).hexdigest()
    h = [int(name[i:i + 8], 16) for i in (0, 8, 16, 24)]
    if not text or any(m.decode() in text for m in MARKS):
        return n, "plain", None, None, text
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = ("".join(lines[a:b]) for a, b in ((0, low), (low, high), (high, n)))
    if h[3] % 100 < 50:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def line_rows():
    rng = random.Random(4)
    pool = ["", "a", "é<P", ">", "<S", "M>", "<", "\U0001f600 x", "b c", "\r"]
    rows = [row(n, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 9))))
            for n in range(300)]
    return [*rows, row(900, "<P>"), row(901, "a\n<M>b"), row(902, "\n"), row(903, "x\n\n")]


def test_outputs_follow_the_contract_and_give_the_text_back(spark):
    rows = odd_rows() + line_rows()
    docs = clashing(frame(spark, rows)).withColumnRenamed("text", "a.text")
    found = fill_in_middle(docs, text_col="a.text", into="key")
    assert found.columns == [c for c in docs.columns if c != "key"] + ["key"]
    found = found.select("*", "key.output", "key.form")
    assert found.columns.count("output") == 1
    found = restore(found).collect()
    assert len(found) == len(rows)
    forms = set()
    for f in found:
        text = f["a.text"] or ""
        n, form, prefix, middle, output = plain_fim(f.doc_id, text)
        assert (f.key.n, f.key.form, f.key.prefix_chars, f.key.middle_chars) == (
            n, form, prefix, middle)
        assert f.key.output == output and f.key.output_sha256 == sha(output)
        assert f.restored.text == text and f.restored.sha256 == sha(text)
        buffers = text.encode(), b"".join(MARKS)
        pieces = b"".join(buffers[p.buffer][p.start:p.start + p.length] for p in f.key.pieces)
        assert pieces.decode() == output
        forms.add(form)
    assert forms == {"plain", "psm", "spm"}
    assert fill_in_middle(frame(spark, [])).collect() == []


def test_rates_and_sentinels(spark):
    rows = [row(n, f"line {n}\nand more\nto come") for n in range(200)]
    docs = frame(spark, rows)
    assert {r.fim.form for r in fill_in_middle(docs, rate=0).collect()} == {"plain"}
    assert {r.fim.form for r in fill_in_middle(docs, spm_rate=100).collect()} == {"spm"}
    names = ("[pre]", "[mid]", "[suf]")
    some = fill_in_middle(docs, rate=50, sentinels=names).select("text", "fim.*")
    back = restore(some, sentinels=names).collect()
    plain = sum(r.form == "plain" for r in back)
    assert 60 < plain < 140 and all(r.restored.text == r.text for r in back)
    for bad in (("<P>", "<P>", "<S>"), ("<P>", "", "<S>"), ("aba", "x", "y"), ("ab", "a", "y")):
        with pytest.raises(ValueError):
            fill_in_middle(docs, sentinels=bad)


def test_splitting_keeps_every_byte():
    table = [(0, 3, 4), (1, 0, 2), (0, 10, 5)]
    whole = [(b, s + i) for b, s, n in table for i in range(n)]
    for offset in range(12):
        before, after = split(table, offset)
        flat = [[(b, s + i) for b, s, n in part for i in range(n)] for part in (before, after)]
        assert flat == [whole[:offset], whole[offset:]]
    text = LONG.encode()
    _, form, _, pieces = transform(1, text, MARKS)
    output = b"".join((text, b"".join(MARKS))[b][s:s + n] for b, s, n in pieces)
    assert digest(restored(output, form, MARKS), [output]) == hashlib.sha256(text).hexdigest()


def plain_passages(rows, least):
    """Words to remove of each (id, text): every window is compared with all others."""
    split_ = [(r[0], (r[1] or "").encode().split()) for r in rows]
    first = {}
    for number, found in split_:
        if number is not None:
            for n in range(len(found) - least + 1):
                key = tuple(found[n:n + least])
                first[key] = min(first.get(key, number), number)
    out = []
    for number, found in split_:
        gone = set()
        for n in range(len(found) - least + 1):
            if number is not None and first[tuple(found[n:n + least])] < number:
                gone.update(range(n, n + least))
        out.append(gone)
    return out


def passage_rows(least):
    rng = random.Random(least)
    common = words(rng, least + 5, least + 9).split()
    hot = words(rng, least - 2, least - 2).split()
    rows = []
    for number in range(120):
        text = words(rng, 0, 2 * least, "abcdefgh").split()
        kind = rng.random()
        if kind < 0.3:
            text[len(text) // 2:len(text) // 2] = common
        elif kind < 0.6:  # a run that many texts share, with different words beside it
            text += [*hot, rng.choice("xyz"), rng.choice("xyz")]
        elif kind < 0.8 and rows:
            other = (rng.choice(rows)[1] or "").split()
            at = rng.randint(0, len(other))
            text += other[at:at + 2 * least]
        elif kind < 0.85:
            text = ["x"] * rng.randint(0, 3 * least)
        rows.append(row(rng.randint(0, 90), rng.choice([" ", "\n", " \t "]).join(text)))
    return rows


@pytest.mark.parametrize("least, shard_words, key_segments", [
    (10, 1 << 18, 2048), (10, 1, 2), (4, 60, 3), (1, 1 << 18, 2048)])
def test_passages_of_earlier_documents_go(spark, least, shard_words, key_segments):
    rows = passage_rows(max(least, 4)) + [r for r in odd_rows() if r[1] != LONG]
    lost = plain_passages(rows, least)
    docs = clashing(frame(spark, rows)).withColumnRenamed("source", "a.b")
    found = dedup_passages(
        docs, least=least, removed="gone", shard_words=shard_words, key_segments=key_segments)
    assert found.columns == [*docs.columns, "gone"]
    wanted, seen = [], []
    for r, gone in zip(rows, lost):
        tokens = (r[1] or "").encode().split()
        kept = b" ".join(w for n, w in enumerate(tokens) if n not in gone).decode()
        wanted.append((str(r[0]), kept, r[1] if not gone else None, len(gone)))
    for f in found.collect():
        kept = b" ".join((f.text or "").encode().split()).decode()
        size = sum(s.end - s.start for s in f.gone)
        seen.append((str(f.doc_id), kept, f.text if not f.gone else None, size))
    assert sorted(map(str, seen)) == sorted(map(str, wanted))
    assert any(lost)


def test_long_copies_and_odd_rows(spark):
    rows = odd_rows()
    found = {f.doc_id: f for f in dedup_passages(frame(spark, rows)).collect()}
    size = len(LONG.split())
    assert found[10].text == LONG and found[11].text == ""
    assert [(s.start, s.end) for s in found[11].removed] == [(0, size)]
    assert found[7].text is None and found[5].text == "The same text in two rows."
    assert dedup_passages(frame(spark, [])).collect() == []
    nothing = frame(spark, [row(None, LONG), row(None, LONG), row(3, LONG)])
    assert all(not f.removed for f in dedup_passages(nothing).collect())
    long_words = frame(spark, [row(1, "y" * 5000 + " z " * 60), row(2, "y" * 5000 + " z " * 60)])
    assert {f.text for f in dedup_passages(long_words).collect()} == {
        "y" * 5000 + " z " * 60, ""}


def test_text_ids_are_compared_as_text(spark):
    docs = spark.createDataFrame(
        [("b", "one two three four"), ("a", "one two three four"), ("1:", "x"), ("1", ":x")],
        "doc_id string, text string")
    found = {f.doc_id: f.text for f in dedup_passages(docs, least=3).collect()}
    assert found == {"a": "one two three four", "b": "", "1:": "x", "1": ":x"}


def test_every_window_holds_a_marked_run():
    rng = random.Random(6)
    for least in (1, 2, 4, 7, 10, 50):
        gram, _ = widths(least)
        for letters in ("a", "ab", "abcdefghij"):
            text = [rng.choice(letters).encode() for _ in range(400)]
            starts, _ = marked_runs(Words([b" ".join(text)]), least)
            marked = set(starts.tolist())
            for n in range(len(text) - least + 1):
                assert marked & set(range(n, n + least - gram + 1))


def test_words_of_bytes_and_their_hashes():
    texts = [b"", b" a  bc\n", "é\x85x \u2003".encode(), b"\x0b\x0c", b"y" * 300_000 + b" a",
             b" ".join(b"w%d" % (n % 5000) for n in range(90_000))]
    words = Words(texts)
    tokens = [w for t in texts for w in t.split()]
    assert words.sizes.tolist() == [len(t.split()) for t in texts]
    spans = zip(words.starts.tolist(), words.ends.tolist())
    assert [words.buffer[a:b] for a, b in spans] == tokens
    by_hash = {}
    for token, value in zip(tokens, words.hashes.tolist()):
        assert by_hash.setdefault(value, token) == token
    assert len(by_hash) == len(set(tokens))
    assert words.joined(0, 2) == b"a bc" and len(Words([]).hashes) == 0


def test_wavelet_tree_counts_symbols():
    import numpy as np

    rng = random.Random(5)
    symbols = np.array([min(int(rng.expovariate(0.4)), 20) for _ in range(700)])
    tree = WaveletTree(symbols, 23)
    for symbol in range(21):
        places = np.arange(701)
        wanted = np.concatenate(([0], np.cumsum(symbols == symbol)))
        assert (tree.rank(np.full(701, symbol), places) == wanted)[
            :701 if (symbols == symbol).any() else 0].all()


def test_suffixes_come_in_order():
    import numpy as np

    rng = random.Random(7)
    symbols = [rng.randint(1, 3) for _ in range(200)] + [0]
    places, shared = suffix_order(np.array(symbols))
    assert places.tolist() == sorted(range(201), key=lambda n: symbols[n:])
    for n in range(1, 201):
        a, b = symbols[places[n - 1]:], symbols[places[n]:]
        same = next(i for i, (x, y) in enumerate(zip(a, b)) if x != y)
        assert shared[n] == same


def test_matches_are_those_of_smaller_owners():
    rng = random.Random(3)
    for _ in range(60):
        texts = [[rng.choice("abc") for _ in range(rng.randint(1, 25))]
                 for _ in range(rng.randint(1, 10))]
        owners = [rng.randint(0, 6) for _ in texts]
        least = rng.randint(1, 6)
        found = search_shard(list(zip(owners, texts)), list(zip(owners, texts)), least)
        for q, text in enumerate(texts):
            wanted = set()
            for s in range(len(text) - least + 1):
                window = text[s:s + least]
                if any(o < owners[q] and any(t[j:j + least] == window for j in range(len(t)))
                       for o, t in zip(owners, texts)):
                    wanted.update(range(s, s + least))
            got = {n for a, b in found.get(q, []) for n in range(a, b)}
            assert got == wanted
    assert FMIndex([["a"]], [0]).matches([["b"], []], [1, 1], 1) == []


def test_cutting_words():
    assert without_words(b" a  b\nc d ", [(1, 3)]) == b" a  d "
    assert without_words(b"a b", [(0, 2)]) == b""


def plain_clusters(rows, clusters=16, rounds=3):
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    named = sorted((hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest(), v)
                   for i, v in kept)
    centroids = [v for _, v in named[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        centroids = [[sum(x) // len(groups[j]) for x in zip(*groups[j])] if j in groups else c
                     for j, c in enumerate(centroids)]
    out = [(i, *nearest(v)) for i, v in kept]
    total = sum(d for _, d, _ in out)
    within = {}
    for _, d, j in out:
        within[j] = within.get(j, 0) + d

    def fits(n):
        return n if n < 2**63 else None

    return [(i, j, fits(d), fits(within[j]), fits(total),
             hashlib.sha256(",".join(map(str, centroids[j])).encode()).hexdigest())
            for i, d, j in out]


def vector_rows(seed, count, scale=1.0):
    rng = random.Random(seed)
    middles = [[rng.gauss(0, scale) for _ in range(64)] for _ in range(9)]
    return [(n, [float(x) + rng.gauss(0, scale / 3) for x in rng.choice(middles)])
            for n in range(count)]


BAD = [(700, None), (701, []), (702, [1.0] * 63), (703, [1.0] * 65),
       (704, [float("nan")] + [0.0] * 63), (705, [float("inf")] + [0.0] * 63),
       (706, [None] + [0.0] * 63), (None, None)]


@pytest.mark.parametrize("case", ["usual", "few", "equal", "large", "none"])
def test_clusters_are_those_of_plain_distances(spark, case):
    rows = {
        "usual": vector_rows(1, 400) + [(5, [0.25] * 64), (5, [0.25] * 64), (None, [-0.1] * 64)],
        "few": vector_rows(2, 5),
        "equal": [(n, [1.0] * 64) for n in range(40)],
        "large": vector_rows(3, 60, 1e7) + vector_rows(4, 60, 1e30) + [(99, [-3e38] * 64)],
        "none": [],
    }[case]
    table = spark.createDataFrame(
        rows + BAD, "vec_id bigint, embedding array<double>"
    ).selectExpr("vec_id as `vec.id`", "embedding as vector", "1 as cluster", "2 as id")
    found = cluster_vectors(table, "vec.id", "vector").collect()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, plain_clusters(rows)))


def test_floats_count_as_doubles(spark):
    rows = [(n, [0.1 * n] * 64) for n in range(30)]
    table = spark.createDataFrame(rows, "vec_id int, embedding array<float>")
    exact = [(r.vec_id, list(r.embedding)) for r in table.collect()]
    found = cluster_vectors(table, clusters=4, rounds=1).collect()
    assert sorted(map(str, map(tuple, found))) == sorted(
        map(str, plain_clusters(exact, 4, 1)))
    empty = spark.createDataFrame([], "vec_id int, embedding array<float>")
    assert cluster_vectors(empty).collect() == []


def test_ties_go_to_the_smaller_number():
    import numpy as np

    rivals = Bisectors([[0, 0], [2, 0], [0, 0], [0, 2], [-5, 1]])
    points = np.array([[1, 0], [0, 1], [1, 1], [2, 2], [-5, 1], [0, 0]])
    best, apart = rivals.nearest(points)
    assert best.tolist() == [0, 0, 0, 1, 4, 0] and apart.tolist() == [1, 1, 2, 4, 0, 0]


def test_near_copies_lose_what_they_share(spark):
    rows = near_copies()
    lost = plain_passages(rows, 50)
    sizes = {r[0]: len(gone) for r, gone in zip(rows, lost)}
    found = dedup_passages(frame(spark, rows)).collect()
    assert {f.doc_id: sum(s.end - s.start for s in f.removed) for f in found} == sizes
    assert sum(sizes.values()) > 1000
