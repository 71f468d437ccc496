"""Exact dedup, line dedup and SimHash against brute force."""

import hashlib
import random

import pytest

from samples import LONG, clashing, frame, near_copies, odd_rows, row, words

from wavelode.llm.components import connected_components
from wavelode.llm.exact_dedup import exact_duplicates
from wavelode.llm.lines import dedup_lines, merged, without_lines
from wavelode.llm.simhash import (
    Tree, block_masks, fingerprint_links, fingerprints, keep_one, near_duplicates, shard_links,
    shingle_hashes,
)


@pytest.mark.parametrize("bits", [32768, 1 << 23])
def test_exact_duplicates_keep_the_largest_id(spark, bits):
    rows = odd_rows() + [row(100 + n, f"text number {n % 40}") for n in range(120)]
    docs = clashing(frame(spark, rows))
    found = exact_duplicates(docs, sieve_bits=bits, digest_all=True).collect()
    assert len(found) == len(rows)
    groups = {}
    for r in rows:
        groups.setdefault(hashlib.sha256((r[1] or "").encode()).hexdigest(), []).append(r[0])
    kept = {}
    for f in found:
        ids = groups[f.text_sha256]
        largest = max((i for i in ids if i is not None), default=None)
        assert (f.keep_id, f.group_size) == (largest, len(ids))
        if f.kept:
            assert f.text_sha256 not in kept and f.doc_id == largest
            kept[f.text_sha256] = f.doc_id
    assert set(kept) == set(groups)


def test_exact_duplicates_of_nothing(spark):
    assert exact_duplicates(frame(spark, [])).collect() == []


def lines_without_repeats(rows, least):
    """Every run of lines is compared with all earlier ones."""
    def key(number, text):
        name = "-:" if number is None else f"{len(str(number))}:{number}"
        return hashlib.md5(f"{name}:{text}".encode()).digest()

    order = sorted({(r[0] is not None, r[0] or 0, key(r[0], r[1] or ""), r[1] or "")
                    for r in rows})
    seen, out = set(), {}
    for known, number, _, text in order:
        lines = [(n, s.strip()) for n, s in enumerate(text.split("\n")) if s.strip()]
        gone = set()
        for start in range(len(lines)):
            total = 0
            for stop in range(start, len(lines)):
                total += len(lines[stop][1].split())
                if total < least:
                    continue
                run = tuple(s for _, s in lines[start:stop + 1])
                if run in seen:
                    gone.update(range(lines[start][0], lines[stop][0] + 1))
                seen.add(run)
        kept = [s for n, s in enumerate(text.split("\n")) if n not in gone]
        out[number if known else None, text] = "\n".join(kept)
    return out


def line_documents():
    rng = random.Random(8)
    pool = [words(rng, 1, 18) for _ in range(30)] + ["", "  ", words(rng, 60, 70)]
    rows = []
    for number in range(60):
        lines = [rng.choice(pool) if rng.random() < 0.5 else words(rng, 1, 15)
                 for _ in range(rng.randint(0, 12))]
        if rows and rng.random() < 0.4:
            other = rng.choice(rows)[1].split("\n")
            at = rng.randint(0, len(other))
            lines[1:1] = [f" {s}\t" for s in other[at:at + rng.randint(1, 6)]]
        if rng.random() < 0.1:
            lines = ["x y z w"] * 12
        rows.append(row(rng.randint(0, 45), "\n".join(lines)))
    return rows


@pytest.mark.parametrize("least", [1, 12, 25])
def test_later_runs_of_lines_go(spark, least):
    rows = line_documents()
    expected = lines_without_repeats(rows, least)
    found = dedup_lines(clashing(frame(spark, rows)), min_words=least, removed="gone").collect()
    assert len(found) == len(rows)
    texts = {}
    for f in found:
        texts.setdefault(f.doc_id, []).append(f.text)
        assert f.removed == "removed" and f.row == "row"
    for number in texts:
        wanted = sorted(expected[r[0], r[1]] for r in rows if r[0] == number)
        assert sorted(texts[number]) == wanted


def test_lines_of_odd_rows(spark):
    rows = odd_rows()
    found = dedup_lines(frame(spark, rows)).collect()
    assert len(found) == len(rows)
    by_id = {f.doc_id: f for f in found}
    assert by_id[10].text == LONG and by_id[11].text == "" and by_id[7].text is None
    # The row without an id comes first.
    assert by_id[5].text == by_id[6].text == "" and by_id[9].text == "   \n\t\n "
    kept = {f.doc_id: f.text for f in dedup_lines(frame(spark, rows), min_words=50).collect()}
    assert kept[5] == "The same text in two rows." and kept[11] == ""
    assert dedup_lines(frame(spark, [])).collect() == []


def test_spans():
    assert merged([(5, 6), (0, 1), (2, 3), (5, 9)]) == [[0, 3], [5, 9]]
    assert without_lines("a\nb\nc\nd", [[1, 2]]) == "a\nd"


def test_shingles():
    import xxhash

    digest = [xxhash.xxh64_intdigest(s, 42) for s in (b"a b c", b"b c d")]
    assert shingle_hashes("A\tb  c\nD") == digest
    assert shingle_hashes("É B") == [xxhash.xxh64_intdigest("É b".encode(), 42)]
    assert shingle_hashes(" ") == [xxhash.xxh64_intdigest(" ".encode(), 42)]
    assert shingle_hashes(" ") == []


def test_spark_makes_the_same_hash(spark):
    from pyspark.sql import functions as F

    value = spark.range(1).select(F.xxhash64(F.lit("b c d"))).first()[0]
    assert value % 2**64 == shingle_hashes("b c d")[0]


def test_fingerprint_is_the_majority_of_bits():
    for text in ("one two three four five", "x", "", " ".join("abcdefghij" * 30)):
        hashes = shingle_hashes(text)
        wanted = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
        assert int(fingerprints([text])[0]) % 2**64 == wanted


def test_tree_finds_all_members_in_the_radius():
    rng = random.Random(1)
    values = list({rng.getrandbits(16) for _ in range(600)})
    tree = Tree()
    for v in values:
        tree.insert(v)
    for v in values[:60]:
        assert sorted(tree.near(v, 3)) == sorted(w for w in values if (v ^ w).bit_count() <= 3)


def components_of(prints, radius):
    top = {p: p for p in prints}

    def find(p):
        while top[p] != p:
            p = top[p]
        return p

    prints = list(top)
    for n, a in enumerate(prints):
        for b in prints[:n]:
            if ((a ^ b) % 2**64).bit_count() <= radius:
                top[find(a)] = find(b)
    out = {}
    for p in prints:
        out.setdefault(find(p), set()).add(p)
    return sorted(map(sorted, out.values()))


@pytest.mark.parametrize("shard_rows", [4096, 7])
def test_links_connect_what_is_near(spark, shard_rows):
    rng = random.Random(2)
    prints = set()
    for _ in range(40):
        value = rng.getrandbits(64)
        for _ in range(rng.choice([1, 3, 30])):
            prints.add(value - 2**64 if value >= 2**63 else value)
            for bit in rng.sample(range(64), rng.randint(1, 5)):
                value ^= 1 << bit
    frame_ = spark.createDataFrame([(p,) for p in prints], "print bigint")
    links = fingerprint_links(frame_, shard_rows=shard_rows)
    found = {}
    for r in connected_components(links).collect():
        found.setdefault(r.component, set()).add(r.node)
    assert all(c == min(nodes) for c, nodes in found.items())
    linked = sorted(map(sorted, found.values()))
    assert linked == [c for c in components_of(prints, 3) if len(c) > 1]


def test_masks_leave_out_as_many_blocks_as_bits_may_differ():
    masks = block_masks(5, 3)
    assert len(masks) == 10
    for bits in ((0, 20, 40), (1, 2, 3), (12, 13, 63)):
        changed = sum(1 << b for b in bits)
        assert any(m % 2**64 & changed == 0 for m in masks)


def test_shard_links_are_stars():
    assert shard_links(list(range(64)), None, 3) == [(n, 0) for n in range(1, 64)]
    assert shard_links([7, 1 << 40], [6, 15, 1 << 41 | 1 << 50], 1) == [(7, 6), (15, 6)]


def test_long_chain_of_links(spark):
    edges = spark.range(300).selectExpr("id as u", "id + 1 as v")
    found = connected_components(edges).collect()
    assert {r.component for r in found} == {0} and len(found) == 301
    assert connected_components(edges.where("u < 0")).collect() == []


def test_near_duplicates(spark):
    rows = near_copies() + odd_rows()
    docs = clashing(frame(spark, rows))
    found = near_duplicates(docs).collect()
    assert len(found) == len(rows)
    prints = {}
    for r, p in zip(rows, fingerprints([r[1] or "" for r in rows])):
        prints.setdefault(int(p), []).append(r[0])
    least = {}
    for component in components_of(prints, 3):
        ids = [i for p in component for i in prints[p] if i is not None]
        for p in component:
            least[format(p % 2**64, "016x")] = min(ids, default=None)
    assert len({v for v in least.values()}) < len(least)  # some are linked
    for f in found:
        assert f.component_id == least[f.fingerprint]
    assert near_duplicates(frame(spark, [])).collect() == []

    kept = keep_one(docs)
    assert kept.columns == docs.columns
    kept = kept.collect()
    assert len(kept) == len(components_of(prints, 3))
