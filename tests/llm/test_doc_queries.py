"""Registered queries and pipeline stages as wholes against plain versions."""

import hashlib

import numpy as np
import pytest

from oracle import connect
from samples import TESTDATA, documents_of, frame, near_copies, odd_rows
from test_doc_dedup import components_of, lines_without_repeats
from test_doc_texts import PATH, longest_matches, tokenizers, winnowed

from wavelode.llm import fingerprints as prints
from wavelode.llm import langid
from wavelode.llm.queries import QUERIES, SQL
from wavelode.llm.simhash import shingle_hashes

FOLDER = f"{TESTDATA}/sf0.001"


def sha(data):
    return hashlib.sha256(data).hexdigest()


def majority(text):
    hashes = shingle_hashes(text)
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_op8_as_a_whole(spark):
    rows = documents_of()
    print_of = {r[0]: majority(r[1]) for r in rows}
    least = {}
    for component in components_of(sorted(print_of.values()), 3):
        least |= dict.fromkeys(component, min(i for i, p in print_of.items() if p in component))
    wanted = {(i, format(p, "016x"), least[p]) for i, p in print_of.items()}
    found = QUERIES["op8_simhash_near_dedup"](spark, FOLDER).collect()
    assert {(f.doc_id, f.fingerprint, f.component_id) for f in found} == wanted
    assert len(found) == len(rows)


def test_op9_as_a_whole(spark):
    library = tokenizers.Tokenizer.from_file(PATH)
    library.no_truncation()
    library.no_padding()
    wanted = set()
    for number, text, *_ in documents_of():
        ids = library.encode(text, add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        wanted.add((number, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(decoded.encode())))
    found = QUERIES["op9_bpe"](spark, FOLDER).collect()
    assert {(f.doc_id, f.n_tokens, f.ids_sha256, f.decoded_sha256) for f in found} == wanted


def test_op7_as_a_whole(spark):
    rows = sorted(documents_of())

    def print_of(text):
        return winnowed(text, prints.GRAM, prints.WINDOW)[0]

    def alike(one, other):
        one, other = set(one), set(other)
        return len(one & other) / len(one | other) if one | other else 1.0

    found = {f.doc_id: f for f in QUERIES["op7_fingerprints"](spark, FOLDER).collect()}
    assert len(found) == len(rows)
    for n, (number, text, *_) in enumerate(rows):
        if not prints.GRAM <= len(text) <= 6000:
            continue  # plain windows over longer texts take minutes
        following, f = rows[(n + 1) % len(rows)][1], found[number]
        tail = len(text) // 4
        edited = text[:len(text) - tail] + following[:tail]
        assert (f.n_chars, f.edited_sha256) == (len(text), sha(edited.encode()))
        assert f.fingerprint.split(",") == [format(h, "010x") for h in print_of(text)]
        assert f.near_edited == pytest.approx(alike(print_of(text), print_of(edited)))
        if len(following) <= 6000:
            assert f.near_next == pytest.approx(alike(print_of(text), print_of(following)))


def plain_fit(text, samples, letters):
    """(language, phrases a symbol, symbols) by plain search, None without a letter."""
    sequence = langid.symbols(text, letters)
    if not (sequence != langid._BLANK).any():
        return None
    found = []
    for language, known in sorted(samples.items()):
        count = sum(longest_matches(sequence[at:at + langid.SEGMENT].tobytes(), known)
                    for at in range(0, len(sequence), langid.SEGMENT))
        found.append((count * np.log2(max(2, len(known))), language, count / len(sequence)))
    _, language, rate = min(found, key=lambda f: f[0])
    return language, rate, len(sequence)


def plain_samples(spark, docs):
    letters = langid.letter_table()
    return letters, {
        language: langid.symbols("\n".join(found), letters).tobytes()
        for language, found in langid.labelled_sample(docs).items()}


def test_op4_as_a_whole(spark):
    letters, samples = plain_samples(spark, spark.read.parquet(f"{FOLDER}/documents.parquet"))
    found = {f.doc_id: f.lang_pred for f in QUERIES["op4_language_id"](spark, FOLDER).collect()}
    rows = documents_of()
    assert len(found) == len(rows)
    for number, text, *_ in rows:
        if len(text) <= 3000:  # plain search takes long
            assert found[number] == plain_fit(text, samples, letters)[0]


def test_pipeline_stages_as_wholes(spark, tmp_path):
    """Each stage against a plain version over what the stage before it left."""
    import corpus_pipeline

    docs = frame(spark, near_copies() + odd_rows())
    stages = dict(corpus_pipeline.STAGES)

    def run(name, docs):
        path = str(tmp_path / name)
        stages[name](spark, docs, FOLDER).write.parquet(path)
        return spark.read.parquet(path)

    def rows_of(docs):
        return [tuple(r) for r in docs.collect()]

    letters, samples = plain_samples(spark, docs)
    held = langid.sampled_pieces(docs, held=True).collect()
    rates = [f[1] for f in (plain_fit(r.piece, samples, letters) for r in held)
             if f and f[2] >= langid.LEAST_SYMBOLS]
    limit = langid.MARGIN * max(rates)

    def known(text):
        if text is not None and len(text) > 100_000:
            return True  # plain search takes long; there are two such texts, of labelled words
        fit = plain_fit(text or "", samples, letters)
        return fit is not None and (fit[1] <= limit or fit[2] < langid.LEAST_SYMBOLS)

    identified = run("language_id", docs)
    wanted = [r for r in rows_of(docs) if known(r[1])]
    assert sorted(map(str, rows_of(identified))) == sorted(map(str, wanted))

    lines = run("line_dedup", identified)
    texts = lines_without_repeats(rows_of(identified), 1)
    wanted = []
    for number, text, lang, source, _ in rows_of(identified):
        left = texts[number, text]
        if left == text or left.strip():
            wanted.append((number, left, lang, source, len(left)))
    assert sorted(map(str, rows_of(lines))) == sorted(map(str, wanted))

    single = run("simhash_near_dedup", lines)
    rows = rows_of(lines)
    groups = components_of([majority(r[1]) for r in rows], 3)
    of = {p: n for n, group in enumerate(groups) for p in group}
    least = {}
    for r in rows:
        key = (r[0] is not None, r[0] or 0, hashlib.md5(r[1].encode()).hexdigest())
        least[of[majority(r[1])]] = min(least.get(of[majority(r[1])], key), key)
    kept = [(r[0] is not None, r[0] or 0, hashlib.md5(r[1].encode()).hexdigest())
            for r in rows_of(single)]
    assert sorted(kept) == sorted(least.values())

    mixed = run("mixing", single)
    single.write.parquet(str(tmp_path / "tables" / "documents.parquet"))
    con = connect(str(tmp_path / "tables"))
    con.execute(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM "
                f"'{tmp_path}/tables/documents.parquet/*.parquet'")
    taken = {r[0]: r[1] for r in con.execute(
        f"SELECT doc_id, taken FROM ({SQL['op3_mixing']}) WHERE taken > 0").fetchall()}
    sizes = {}
    for number, text, *_ in rows_of(mixed):
        sizes[number] = sizes.get(number, 0) + len(text.encode().split())
    assert sizes == taken

    library = tokenizers.Tokenizer.from_file(PATH)
    encoded = run("bpe", mixed)
    wanted = []
    for number, text, *_ in rows_of(mixed):
        ids = library.encode(text, add_special_tokens=False).ids
        wanted.append((number, len(ids), sha(np.array(ids, "<u4").tobytes())))
    found = [(r.doc_id, r.n_tokens, r.ids_sha256) for r in encoded.collect()]
    assert sorted(map(str, found)) == sorted(map(str, wanted))
