"""Fingerprints, BPE, languages, toxicity and secrets against brute force and held-out rows."""

import hashlib
import random
import re
import string
import time
import uuid
import zlib

import numpy as np
import pytest

from samples import LONG, clashing, documents_of, frame, odd_rows, row, words

from wavelode.llm import fingerprints as prints
from wavelode.llm import bpe, langid, secret_scan, toxicity
from wavelode.llm.bpe import (
    decode, decode_ids, encode, merge_long, merge_words, read_vocabulary,
)

tokenizers = pytest.importorskip("tokenizers")
vocabularies = pytest.importorskip("public_tokenizers")

PATH = vocabularies.path("word_bpe_49k.json")


def winnowed(text, gram, window):
    points = prints.code_points(text)
    hashes = [int(prints.gram_hashes(points[n:n + gram], gram)[0])
              for n in range(len(points) - gram + 1)]
    chosen = set()
    for start in range(max(1, len(hashes) - window + 1)):
        part = hashes[start:start + window]
        chosen.add(start + max(n for n, h in enumerate(part) if h == min(part)))
    return [hashes[n] for n in sorted(chosen)], sorted(chosen)


def test_winnowing_takes_rightmost_minima():
    rng = random.Random(0)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randint(4, 70))) for _ in range(150)]
    for text, (hashes, places) in zip(texts, prints.winnow_many(texts, 4, 7)):
        assert (hashes.tolist(), places.tolist()) == winnowed(text, 4, 7)


def test_long_texts_go_in_parts(monkeypatch):
    text = words(random.Random(4), 300, 300)
    whole = prints.winnow(prints.code_points(text))
    monkeypatch.setattr(prints, "PART", 300)
    parts = prints.winnow(prints.code_points(text))
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all()


def test_shared_passage_shares_a_hash():
    rng = random.Random(5)
    passage = words(rng, 40, 40)[:prints.GRAM + prints.WINDOW - 1]
    for _ in range(20):
        one, other = (words(rng, 5, 60) + passage + words(rng, 5, 60) for _ in range(2))
        a, b = (set(h.tolist()) for h, _ in prints.winnow_many([one, other]))
        assert a & b


def test_every_document_meets_the_next(spark):
    rows = odd_rows() + [row(100 + n, words(random.Random(n), 5, 120)) for n in range(60)]
    found = prints.compare_with_next(clashing(frame(spark, rows)).repartition(7)).collect()
    assert len(found) == len(rows)
    import xxhash

    def signed(text):
        value = xxhash.xxh64_intdigest(text.encode(), 42)
        return value - 2**64 if value >= 2**63 else value

    order = sorted(((r[0] is not None, r[0] or 0, signed(r[1] or ""), r[1] or "") for r in rows))
    wanted = []
    for n, (known, number, _, text) in enumerate(order):
        following = order[(n + 1) % len(order)][3]
        edited = prints.edited_text(text, following)
        own, changed, after = (set(prints.winnow_many([t])[0][0].tolist())
                               for t in (text, edited, following))
        wanted.append((number if known else None, len(text),
                       hashlib.sha256(edited.encode()).hexdigest(),
                       prints.hash_text(prints.winnow_many([text])[0][0]),
                       prints.likeness(own, changed), prints.likeness(own, after)))
    ours = [(f.doc_id, f.n_chars, f.edited_sha256, f.fingerprint, f.near_edited, f.near_next)
            for f in found]
    assert sorted(map(str, ours)) == sorted(map(str, wanted))
    assert prints.compare_with_next(frame(spark, [])).collect() == []


def test_edit_takes_what_the_next_text_has():
    assert prints.edited_text("abcdefgh", "XYZ") == "abcdefXY"
    assert prints.edited_text("abcdefgh", "X") == "abcdefX"
    assert prints.edited_text("abc", "XYZ") == "abc"


def test_short_texts_are_near_their_edits():
    rng = random.Random(15)
    for least, most in ((20, 78), (79, 319), (320, 2000)):
        texts = [words(rng, 400, 400)[:rng.randint(least, most)] for _ in range(200)]
        following = texts[1:] + texts[:1]
        own, changed = (
            [set(h.tolist()) for h, _ in prints.winnow_many(some)]
            for some in (texts, list(map(prints.edited_text, texts, following))))
        edited = [prints.likeness(a, b) for a, b in zip(own, changed)]
        after = [prints.likeness(a, b) for a, b in zip(own, own[1:] + own[:1])]
        # Three quarters of 20 characters are as many as the guarantee needs.
        assert min(edited) > 0 and np.mean(edited) > 0.45 and np.mean(after) < 0.02


def odd_texts():
    rng = random.Random(6)
    pool = "aaaaabcdeehhlloΣσςİıÉñß'’s t\t\n  \x85\x1c\x1f  ½²Ⅷ漢字かな한글é̈ÅÅ😀_-–.,!?<|>019"
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    return texts + ["", "a" * 3000, "<|startoftext|>hello<|endoftext|> x <|endoftext|", "'S it'LL"]


def test_bpe_equals_the_library(spark):
    library = tokenizers.Tokenizer.from_file(PATH)
    texts = odd_texts() + [r[1] for r in documents_of()] + [r[1] or "" for r in odd_rows()]
    docs = clashing(frame(spark, [row(n, t) for n, t in enumerate(texts)]))
    found = {r.doc_id: r for r in encode(docs, PATH, decoded=True).collect()}
    for n, wanted in enumerate(library.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(found[n].token_ids, "<u4").tolist() == wanted.ids
        assert found[n].decoded == library.decode(wanted.ids, skip_special_tokens=False)


def test_bpe_decodes_what_it_encoded(spark):
    rows = odd_rows()
    coded = encode(frame(spark, rows), PATH)
    assert coded.count() == len(rows)
    assert encode(frame(spark, []), PATH).collect() == []
    found = decode(coded, PATH).where("doc_id = 14").first()
    assert found.decoded == "a</w>"


def test_merge_rounds_equal_one_merge_at_a_time():
    model = read_vocabulary(PATH)
    ranks = {int(k): (int(r), int(m)) for k, r, m in zip(model["keys"], model["ranks"], model["made"])}

    def one_by_one(word):
        ids = [int(model["inner"][b]) for b in word[:-1]] + [int(model["last"][word[-1]])]
        while True:
            pairs = [(ranks[a * model["size"] + b][0], n) for n, (a, b) in enumerate(zip(ids, ids[1:]))
                     if a * model["size"] + b in ranks]
            if not pairs:
                return ids
            _, n = min(pairs)
            ids[n:n + 2] = [ranks[ids[n] * model["size"] + ids[n + 1]][1]]

    rng = random.Random(7)
    some = [words(rng, 1, 1, "aeinorst").encode() * rng.randint(1, 3) for _ in range(300)]
    some += [b"a" * n for n in range(1, 30)]
    for word, ids in zip(some, merge_words(some, model)):
        assert ids.tolist() == one_by_one(word)
    assert decode_ids(b"", model["tokens"]) == ""


def test_long_words_equal_short_ones_and_the_library():
    model, library = read_vocabulary(PATH), tokenizers.Tokenizer.from_file(PATH)
    rng = random.Random(12)
    for letters in ("ab", "a", "aeinrst", string.ascii_lowercase, "aéßж中"):
        for _ in range(12):
            word = "".join(rng.choice(letters) for _ in range(rng.randint(2, 900)))
            long = merge_long(word.encode(), model).tolist()
            assert long == merge_words([word.encode()], model)[0].tolist()
            if letters.isascii():
                assert long == library.encode(word, add_special_tokens=False).ids
    word = "".join(rng.choice(string.ascii_lowercase) for _ in range(160_000))
    start = time.perf_counter()
    ids = merge_long(word.encode(), model).tolist()
    assert time.perf_counter() - start < 5  # rounds over the whole word take minutes
    assert ids == library.encode(word, add_special_tokens=False).ids


def test_kept_chunks_are_bounded_by_bytes(monkeypatch):
    """Text without spaces: few chunks, but large ones."""
    monkeypatch.setattr(bpe, "KEPT_BYTES", 100_000)
    encoder, rng = bpe.Encoder(read_vocabulary(PATH)), random.Random(13)
    for _ in range(60):
        encoder.encode(["".join(rng.choice("abcdefgh") for _ in range(5000))])
        held = sum(4 * len(c) + len(ids) + bpe.KEPT_EACH for c, ids in encoder.kept.items())
        assert held == encoder.size <= 100_000 + 50_000


def longest_matches(sequence, sample):
    """Phrases by plain search, within one segment."""
    count, at = 0, 0
    while at < len(sequence):
        size = 1
        while at + size < len(sequence) and sequence[at:at + size + 1] in sample:
            size += 1
        count, at = count + 1, at + size
    return count


def test_phrases_equal_plain_search():
    rng = random.Random(9)
    sample = {"x": [words(rng, 40, 40, "abcd")], "y": [words(rng, 40, 40, "cdef")]}
    model = langid.learn(sample)
    texts = [words(rng, 1, 60, "abcdefg") for _ in range(40)] + ["", "zzzz", "a"]
    sequences = [langid.symbols(t, model["symbols"]) for t in texts]
    found = langid.phrases(sequences, model)
    for language, counts in zip(model["languages"], found):
        known = langid.symbols("\n".join(sample[language]), model["symbols"]).tobytes()
        for sequence, count in zip(sequences, counts):
            text = sequence.tobytes()
            wanted = sum(longest_matches(text[n:n + langid.SEGMENT], known)
                         for n in range(0, len(text), langid.SEGMENT))
            assert count == wanted


def test_languages_of_rarer_scripts():
    """Two languages of one script beside larger ones of others, with many letters each."""
    rng = random.Random(19)
    large = ["abcdefghijklmnopqrstuvwxyz", "абвгдежзийклмнопрстуфхцчшщъыьэюя"]
    rare = ["αβγδεζηθικλμ", "νξοπρστυφχψω",
            "".join(map(chr, range(0xAC00, 0xB000))), "".join(map(chr, range(0xB000, 0xB400)))]
    sample = {f"l{n}": [words(rng, 60, 60, letters) for _ in range(20)]
              for n, letters in enumerate(large)}
    sample |= {f"r{n}": [words(rng, 20, 20, letters) for _ in range(20)]
               for n, letters in enumerate(rare)}
    model = langid.learn(sample)
    texts = [(f"r{n}", words(rng, 15, 15, letters)) for n, letters in enumerate(rare)
             for _ in range(30)]
    found = langid.classify([t for _, t in texts], model)
    assert np.mean([lang == known for (known, _), (lang, _) in zip(texts, found)]) > 0.95


def test_languages_of_held_out_rows(spark):
    rows = [r for r in documents_of("sf0.01")]
    docs = clashing(frame(spark, rows + [row(9999, None), row(9998, "12 34!"), row(None, "")]))
    found = langid.predict_languages(docs).collect()
    assert len(found) == len(rows) + 3
    truth = {r[0]: r[2] for r in rows}
    held = [f for f in found if f.held_out and f.doc_id in truth]
    assert np.mean([f.lang_pred == truth[f.doc_id] for f in held]) > 0.98
    for f in found:
        assert 0 <= f.score <= 1
        assert (f.lang_pred == "und") == (f.doc_id not in truth)
        import zlib

        number = "" if f.doc_id is None else str(f.doc_id)
        assert f.held_out == (zlib.crc32(number.encode()) % 3 == 1)


def test_languages_in_several_passes(spark):
    """As many models as languages give the same as one model of all."""
    rows = [r for r in documents_of("sf0.001")] + [row(None, None), row(7, "1 2"), row(8, "")]
    docs = clashing(frame(spark, rows))
    sample = langid.labelled_sample(docs)
    assert len(sample) > 2
    one, many = (
        {(r.doc_id, r.text): (r.lang_pred, round(r.score, 9)) for r in langid.identify_languages(
            docs, sample, "text", ["doc_id", "text"], most).collect()} for most in (1 << 25, 1))
    assert one == many and one[None, None] == ("und", 0.0)
    assert langid.better(None, None) is None


def test_very_many_languages(spark):
    """A column of 2,000 values: nothing is too large, and each pass holds a part of them."""
    rows = [row(n, f"{chr(97 + n % 26) * 3} {chr(97 + n // 80)}", f"l{n}") for n in range(2000)]
    sizes = []
    table = langid.sampled_pieces(frame(spark, rows))
    for model in langid.models(langid.languages_of(table), 5_000):
        sizes.append(len(model["languages"]))
        assert len(model["next"]) <= 5_000
    learned = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 != 1]
    assert sum(sizes) == len(learned) and len(sizes) > 3


def test_texts_in_no_learned_language_go(spark):
    rows = documents_of("sf0.01")
    foreign = [
        "Привет, как дела? Сегодня хорошая погода и мы идём гулять в парк с друзьями.",
        "今天天气很好,我们去公园散步吧,然后一起吃晚饭,聊聊最近的工作和生活,周末再去看一场电影,好吗?",
        "xkq zzvw qpx jjkw vvbn qqwx zxcv plkm qwrt zzxx kkjh qpow xzvb mnbq"]
    docs = clashing(frame(spark, rows + [row(90_000 + n, t, None) for n, t in enumerate(foreign)]))
    kept = {r.doc_id for r in langid.keep_identified(docs).collect()}
    assert kept == {r[0] for r in rows}


def test_languages_without_labels(spark):
    rows = [row(n, "some text", None) for n in range(5)]
    assert {f.lang_pred for f in langid.predict_languages(frame(spark, rows)).collect()} == {"und"}
    assert langid.predict_languages(frame(spark, [])).collect() == []
    kept = langid.keep_identified(clashing(frame(spark, [row(1, "hello there"), row(3, None)])))
    assert [r.doc_id for r in kept.collect()] == [1] and "removed" in kept.columns


def labelled(count=900, seed=12):
    """Two made-up languages, each with beginnings of words that mark label 1."""
    rng = random.Random(seed)
    rows, labels = [], []
    for number in range(count):
        language, letters, mark = rng.choice([("x", "abcdefgh", "vek"), ("y", "klmnopqr", "zuz")])
        text = words(rng, 20, 120, letters).split()
        label = rng.random() < 0.2
        if label:
            for _ in range(rng.randint(2, 6)):
                text[rng.randrange(len(text))] = mark + words(rng, 1, 1, letters)
        rows.append(row(number, " ".join(text), language))
        labels.append((number, int(label)))
    return rows, labels


def test_toxicity_of_held_out_rows(spark):
    rows, labels = labelled()
    marks = spark.createDataFrame(labels + [(None, 1), (3, None), (10**9, 1)],
                                  "doc_id bigint, toxic int")
    docs = clashing(frame(spark, rows + odd_rows()[4:]))
    found = toxicity.score_toxicity(docs, marks).collect()
    assert len(found) == len(rows) + len(odd_rows()) - 4
    truth = dict(labels)
    held = [(f.predicted, truth[f.doc_id]) for f in found if f.held_out and f.doc_id and f.doc_id >= 100]
    wrong = sum(p != t for p, t in held)
    assert wrong <= 0.03 * len(held)
    assert all(0 <= f.score <= 1 and f.predicted == (f.score >= 0.7) for f in found)


def test_toxicity_sees_the_end_of_a_long_text(spark):
    rows, labels = labelled()
    learned = toxicity.learn([(r[1], label, r[2]) for r, (_, label) in zip(rows, labels)])
    scorer = toxicity.Scorer(learned["model"], learned["languages"])
    clean = " ".join(r[1] for r, (_, label) in zip(rows, labels) if not label and r[2] == "x")
    texts = [clean, clean + " vekabc vekdef", "vekabc", ""]
    logits, groups = scorer.score(texts)
    scores = toxicity.calibrated(logits, learned["cuts"][groups])
    assert scores[1] > scores[0] and scores[2] >= 0.7
    alone = [float(scorer.score([t])[0][0]) for t in texts]
    assert np.allclose(alone, logits, atol=1e-4)


def test_toxicity_without_labels(spark):
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    found = toxicity.score_toxicity(frame(spark, odd_rows()), none).collect()
    assert {(f.score, f.predicted) for f in found} == {(0.0, 0)}
    assert toxicity.score_toxicity(frame(spark, []), none).collect() == []


def test_toxicity_sample_has_one_text_of_an_id(spark):
    known = [n for n in range(60) if zlib.crc32(str(n).encode()) % 3 != 1][:20]
    rows = [row(n, f"text {n} {copy}") for n in known for copy in range(1 + 40 * (n == known[0]))]
    marks = spark.createDataFrame([(n, n % 2) for n in known], "doc_id bigint, toxic int")
    docs = clashing(frame(spark, rows))
    found = toxicity.labelled_sample(docs, marks, "toxic")
    assert len(found) == len(known)
    assert sorted(found) == sorted(toxicity.labelled_sample(docs.repartition(5), marks, "toxic"))


def test_toxicity_learns_from_all_labelled_rows(spark, monkeypatch):
    rows, labels = labelled()
    rows.append(row(10**6, LONG))
    labels.append((10**6, 0))
    marks = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    docs, truth = frame(spark, rows), dict(labels)
    held = {n for n in truth if zlib.crc32(str(n).encode()) % 3 == 1}
    known = toxicity.labelled_rows(docs, marks, "toxic")
    assert {r["_id"] for r in known.collect()} == set(truth) - held
    for size in (10**6, 150):  # one shard, several
        monkeypatch.setattr(toxicity, "SHARD_ROWS", size)
        learned = toxicity.learn_all(known)
        found = toxicity.score_documents(docs, learned).collect()
        wrong = sum(f.predicted != truth[f.doc_id] for f in found if f.doc_id in held)
        assert wrong <= 0.03 * len(held)
        if size == 10**6:
            alone = toxicity.learn(toxicity.labelled_sample(docs, marks, "toxic"))
            for name, value in alone["model"].items():
                assert np.allclose(value, learned["model"][name], atol=1e-5), name
            assert np.allclose(alone["cuts"], learned["cuts"], atol=1e-3)


def test_counts_of_all_rows_do_not_depend_on_shards(spark, monkeypatch):
    rows, labels = labelled()
    known = toxicity.labelled_rows(
        frame(spark, rows), spark.createDataFrame(labels, "doc_id bigint, toxic int"), "toxic")
    found = []
    for shards in (1, 7):
        parts = toxicity.packed_parts(known, shards)
        found.append(toxicity._all_counts(parts, toxicity._read(everything=True)))
    assert (found[0][0] == found[1][0]).all() and found[0][0][:, 0].sum() == known.count()
    assert found[0][1].keys() == found[1][1].keys() == {"x", "y"}
    assert all((found[0][1][name] == found[1][1][name]).all() for name in found[0][1])


def test_thresholds_part_the_labels():
    cuts = toxicity.thresholds(
        np.array([0.0, 1.0, 4.0, 5.0, 10.0, 11.0, 14.0, 15.0] * 30),
        np.array([0, 0, 0, 0, 1, 1, 1, 1] * 30), [0, 0, 1, 1, 0, 0, 1, 1] * 30, 2)
    assert 1 < cuts[0] < 4 and 11 < cuts[1] < 14


ASSIGN = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"""
                    r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?"""
                    r"""([A-Za-z0-9+/_.=-]+)""")


def plain_spans(text):
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text)
              if len(m[0]) >= 16]
    found += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    kinds = ["assign", "access", "hex"]
    return sorted(found, key=lambda s: (s[1], kinds.index(s[0])))


def toxic_network(seed=3):
    """Random weights, some texts as word numbers, and the words' buckets."""
    rng = random.Random(seed)
    known = toxicity.Words()
    documents = [known.numbers(toxicity.words_of(words(rng, 0, 12, "abcde"))) for _ in range(9)]
    features = np.array(known.features)
    apart = np.random.default_rng(seed).normal(0, 8, toxicity.BUCKETS)
    model = toxicity._initial(np.random.default_rng(seed), apart)
    for name in model:  # far from zero, so that every part matters
        if name.startswith(("filter", "out")):
            model[name] = model[name] + np.random.default_rng(len(name)).normal(
                0, 0.4, model[name].shape).astype(np.float32)
    return model, documents, features


def plain_logits(model, documents, features):
    out = []
    for numbers in documents:
        vectors = [sum(model["embedding"][b].astype(float) for b in features[n]) for n in numbers]
        pooled = []
        for width in toxicity.WIDTHS:
            kernel, bias = model[f"filter{width}"].astype(float), model[f"bias{width}"]
            best = np.full(toxicity.FILTERS, -np.inf)
            for at in range(max(1, len(vectors))):
                part = vectors[at:at + width]
                part = part + [np.zeros(toxicity.DIMENSIONS)] * (width - len(part))
                best = np.maximum(best, np.concatenate(part) @ kernel + bias)
            pooled.append(np.maximum(best, 0))
        out.append(np.concatenate(pooled) @ model["out"].astype(float) + float(model["offset"][0]))
    return np.array(out)


def test_network_forward_pass_equals_plain_loops():
    model, documents, features = toxic_network()
    wanted = plain_logits(model, documents, features)
    pooled = toxicity._forward(model, documents, features)[2]
    trained = np.maximum(pooled, 0) @ model["out"] + model["offset"]
    scorer = toxicity.Scorer(model, None)
    scorer.words.features = features.tolist()
    scored, _ = scorer.score_numbers(documents)
    assert np.allclose(trained, wanted, atol=1e-4) and np.allclose(scored, wanted, atol=1e-4)
    assert np.ptp(wanted) > 0.5


def test_network_slopes_equal_differences():
    model, documents, features = toxic_network()
    labels = np.array([1, 0, 0, 1, 0, 1, 0, 0, 1], np.float32)
    weights = np.linspace(0.5, 2, 9).astype(np.float32)

    def loss(changed):
        logits = plain_logits(changed, documents, features)
        each = np.logaddexp(0, logits) - labels * logits
        out = changed["out"].astype(float)
        return (each * weights).mean() + toxicity.PENALTY / 2 * (out * out).sum()

    found = toxicity.gradients(model, documents, labels, weights, features)
    buckets, amounts = found.pop("embedding")
    whole = {**found, "embedding": np.zeros_like(model["embedding"])}
    whole["embedding"][buckets] = amounts
    rng = np.random.default_rng(5)
    for name, slope in whole.items():
        direction = rng.normal(0, 1, slope.shape)
        if name == "embedding":
            used = np.unique(features[features > 0])
            direction[np.setdiff1d(np.arange(len(direction)), used)] = 0
        step, ends = 1e-4, []
        for sign in (1, -1):
            ends.append(loss({**model, name: model[name].astype(float) + sign * step * direction}))
        assert (ends[0] - ends[1]) / (2 * step) == pytest.approx(
            float((slope * direction).sum()), rel=2e-2, abs=2e-4), name


def secret_texts():
    rng = random.Random(13)
    parts = ['token = "', "API_KEY:", "apikey= '", "Passwd :", "AKIA", "ABCDEF0123456789", "deadbeef" * 4,
             "0123456789abcdef" * 3, " ", "é", "\n", "x9Yz8Q7w6E5r4T3y2U1", "mail7.example.com", "'", '"',
             "secret", "=", "pwd: ", "Key", "ſecret=abcdefghij"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(400)]


def test_base_spans_equal_the_patterns(spark):
    texts = secret_texts() + ["deadbeef" * 20_000, None, ""]
    docs = clashing(frame(spark, [row(n, t) for n, t in enumerate(texts)]))
    found = secret_scan.scan_secrets(docs).collect()
    assert len(found) == len(texts)
    for f in found:
        wanted = plain_spans(texts[f.doc_id] or "")
        assert [(s.kind, s.start, s.end) for s in f.base] == wanted
        kept = [(s.kind, s.start, s.end) for s in f.spans if s.kind != secret_scan.MODEL]
        assert kept == wanted
        assert [s.start for s in f.spans] == sorted(s.start for s in f.spans)
        for s in f.spans:
            if s.kind == secret_scan.MODEL:
                assert all(s.end <= a or s.start >= b for _, a, b in wanted)
    assert secret_scan.scan_secrets(frame(spark, [])).collect() == []


def test_network_finds_secrets_that_it_has_not_seen():
    learned = secret_scan.learn(secret_scan.generated(600, seed=1))
    fresh = secret_scan.generated(200, seed=2)
    chances = secret_scan.chances(learned, [f[:3] for f in fresh])
    bar = learned["threshold"]
    caught = np.mean([c >= bar for c, f in zip(chances, fresh) if f[3]])
    false = np.mean([c >= bar for c, f in zip(chances, fresh) if not f[3]])
    assert caught > 0.9 and false < 0.05
    right = sum(c >= bar for c, f in zip(chances, fresh) if f[3])
    assert right / sum(c >= bar for c in chances) > 0.95  # precision
    long = "A8f" * 400
    assert secret_scan.windows(long, 0, len(long)).shape == (19, secret_scan.WINDOW)
    assert LONG  # whole texts take part in the Spark tests above


def test_candidates_are_all_but_words_and_numbers():
    def found(text):
        return [text[s:e] for s, e, _ in secret_scan.candidates(text, secret_scan.base_spans(text))]

    letters = "qwkjzmxncbvlaksjdhfgqpwo"
    assert found(f"key = {letters}") == [letters] and found(f"see {letters}") == [letters]
    assert found("the aB3dE5gH7jK9 one") == ["aB3dE5gH7jK9"] and found("pwd: 12345678") == ["12345678"]
    assert found("a signature: correct-horse") == ["correct-horse"]
    for plain in ("communication", "Well-known words/paths.txt", "1234567890123456", "1999-12-31",
                  "UPPERCASE WORDS", "short", "", "= = ======== ---------- ..........",
                  "mail.example.com/path/to/file.html"):
        assert found(plain) == []
    assert found("x " + "=" * 200_000 + " y") == []  # in time that follows the length
    assert len(found("a1B" * 100_000)) == 1


def test_harmless_runs_are_left_alone():
    """Formats that the network has learned, of words that it has not."""
    learned, rng = secret_scan.learn(secret_scan.generated()), random.Random(21)

    def word():
        return "".join(rng.choice(["ba", "ne", "tor", "mi", "lu", "gan", "shi", "ver"])
                       for _ in range(rng.randint(1, 4)))

    def rate(lead, make):
        runs = [make() for _ in range(200)]
        scored = secret_scan.chances(learned, [
            (lead + r + " and"[:secret_scan.AFTER], len(lead), len(r)) for r in runs])
        return np.mean([c >= learned["threshold"] for c in scored])

    harmless = [
        lambda: str(uuid.UUID(int=rng.getrandbits(128))),
        lambda: f"{word()}-{word()}-1.{rng.randint(0, 30)}.0-SNAPSHOT.jar",
        lambda: f"{word()}_{word()}{rng.randint(0, 99)}.txt",
        lambda: f"mail{rng.randint(1, 999)}.example.com",
        lambda: f"2024-10-{rng.randint(10, 28)}T10.{rng.randint(10, 59)}.11Z",
        lambda: word() + word().title() + word().title(),
    ]
    for make in harmless:
        assert rate("see the file ", make) < 0.1
    every = string.ascii_letters + string.digits
    for size, lead in ((40, "see the file "), (28, "see the file "), (24, "the key = "), (14, "my pwd: ")):
        assert rate(lead, lambda: "".join(rng.choice(every) for _ in range(size))) > 0.8


def random_tokens(rng, count):
    """(lead, token) of several formats that no base pattern finds."""
    every = string.ascii_letters + string.digits

    def some(least, most=None, letters=every):
        return "".join(rng.choice(letters) for _ in range(rng.randint(least, most or least)))

    formats = [
        lambda: ("", "ghp_" + some(36)), lambda: ("", "sk_live_" + some(24)),
        lambda: ("", "eyJ" + some(30) + "." + some(50) + "." + some(43)),
        lambda: ("", "glpat-" + some(20)), lambda: ("", some(40)),
        lambda: ("pwd: ", some(20, 28)),
    ]
    return [rng.choice(formats)() for _ in range(count)]


def ordinary_run(rng):
    return rng.choice([
        lambda: f"mail{rng.randint(1, 999)}.example.com",
        lambda: "-".join(words(rng, 1, 1) for _ in range(5)) + f"-{rng.randint(1, 2030)}",
        lambda: "/".join(words(rng, 1, 1) for _ in range(5)) + f"{rng.randint(0, 9)}.txt",
    ])()


def test_unlabelled_tokens_are_not_learned_as_ordinary(spark):
    rng = random.Random(16)
    rows, secret, plain = [], {}, {}
    for number, (lead, token) in enumerate(random_tokens(rng, 900)):
        text = words(rng, 3, 6) + " " + lead + token + " " + words(rng, 3, 6) + " "
        secret[number] = (len(text.partition(token)[0]), len(text.partition(token)[0]) + len(token))
        run = ordinary_run(rng)
        plain[number] = (len(text), len(text) + len(run))
        rows.append(row(number, text + run + " " + words(rng, 3, 6)))
    found = secret_scan.scan_secrets(frame(spark, rows)).collect()
    places = {f.doc_id: {(s.start, s.end) for s in f.spans} for f in found}
    # glpat- is no format that the network is taught.
    for least, taught in ((0.9, True), (0.5, False)):
        of = [n for n in secret if ("glpat-" not in rows[n][1]) == taught]
        assert np.mean([secret[n] in places[n] for n in of]) > least
    assert np.mean([plain[n] in places[n] for n in plain]) < 0.05


def test_only_words_and_numbers_are_ordinary():
    rng = random.Random(17)
    tokens = random_tokens(rng, 2000)
    wrong = [t for lead, t in tokens if secret_scan.ordinary(lead + t, len(lead), len(t))]
    assert len(wrong) <= 2
    runs = [ordinary_run(rng) for _ in range(500)] + [
        "2024-10-12T10.30", "v1.20.3-someRelease", "www.site3.org/page/more"]
    assert all(secret_scan.ordinary("see " + r, 4, len(r)) for r in runs)
    assert not secret_scan.ordinary("pwd: correct-horse-battery-1", 5, 23)


def test_threshold_keeps_the_recall_of_findings_beside_base():
    """Many base findings, and others that look like what is no secret two times of three."""
    rng = random.Random(18)

    def hexadecimal():
        return "".join(rng.choice("0123456789abcdef") for _ in range(40))

    def alike(count, label):
        runs = [words(rng, 1, 1) + "-" + words(rng, 4, 4).replace(" ", "-") + "7"
                for _ in range(count)]
        return [("see " + r, 4, len(r), label) for r in runs]

    base = [("see " + h, 4, len(h), True) for h in (hexadecimal() for _ in range(1500))]
    findings = base + alike(500, True) + alike(1000, False)
    rng.shuffle(findings)
    learned = secret_scan.learn(findings)
    fresh = secret_scan.chances(learned, [f[:3] for f in alike(400, True)])
    assert np.mean([c >= learned["threshold"] for c in fresh]) > 0.9
    assert learned["recall"] >= secret_scan.RECALL
    assert secret_scan.learn(secret_scan.generated())["recall"] >= secret_scan.RECALL


def test_worst_of_all_held_out_texts_sets_the_limit(spark):
    """A text that is harder than the others counts however many others there are."""
    rng = random.Random(5)
    rows = [row(n, words(rng, 30, 40, "abcd"), "x") for n in range(400)]
    docs = frame(spark, rows)
    languages = langid.labelled_sample(docs)
    model = langid.learn(languages)
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 == 1]
    rates = [f[3] for f in langid.fits([r[1] for r in held], model)]
    assert len(held) > langid.SAMPLE_TEXTS
    limit = langid.foreign_rate(docs, sorted(languages.items()))
    assert limit == pytest.approx(langid.MARGIN * max(rates))


def test_network_learns_from_all_findings(spark, monkeypatch):
    rng = random.Random(31)
    texts = [f"{words(rng, 3, 5)} token={words(rng, 1, 1)}{n:08d} and mail{n}.{words(rng, 1, 1)}.com"
             for n in range(400)]
    docs = frame(spark, [row(n, text) for n, text in enumerate(texts)])
    findings = secret_scan.labelled_findings(secret_scan.find_candidates(docs))
    kinds = {r["base"]: r["count"] for r in findings.groupBy("base").count().collect()}
    assert kinds[True] == len(texts) and kinds[False] > 300
    # Each finding is dealt to one shard, and what calibrates is not fitted to.
    seen = []
    monkeypatch.setattr(secret_scan, "SHARD_FINDINGS", 300)
    plain = secret_scan.dealt

    def dealt(rows, shards, order):
        seen.append((shards, plain(rows, shards, order)))
        return seen[-1][1]

    monkeypatch.setattr(secret_scan, "dealt", dealt)
    learned = secret_scan.learn_all(findings)
    shards, rows = seen[0]
    assert shards == -(-sum(kinds.values()) // 300) and rows.count() == sum(kinds.values())
    assert learned["recall"] >= secret_scan.RECALL
    fresh = secret_scan.generated(200, seed=2)
    chances = np.array(secret_scan.chances(learned, [f[:3] for f in fresh]))
    truth = np.array([f[3] for f in fresh])
    assert ((chances >= learned["threshold"]) & truth).sum() >= 0.9 * truth.sum()
    ordinary = [(r["around"], r["before"], r["length"]) for r in rows.where("not base").collect()]
    assert np.mean(np.array(secret_scan.chances(learned, ordinary)) < learned["threshold"]) > 0.97
