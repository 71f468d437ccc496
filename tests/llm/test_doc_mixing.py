"""Mixing, sharding, the pipeline and the registered queries."""

import re
import statistics

import pytest

from oracle import connect, differences
from samples import TESTDATA, clashing, documents_of, frame, near_copies, odd_rows, row

from wavelode.llm.mixing import (
    SEED, _hypergeometric, mix_sources, mixed_documents, source_targets, split_quotas,
)
from wavelode.llm.queries import QUERIES, SQL
from wavelode.llm.sharding import lookup_table, place, slot_of, write_shards

FOLDER = f"{TESTDATA}/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def reshared(sizes):
    """Targets by sharing the excess again and again."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: n % 3 + 1 for n, s in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in capped]
        left = total - sum(capped.values())
        share = {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest}
        over = {s: 3 * sizes[s] for s in rest if share[s] > 3 * sizes[s]}
        if not over:
            return {**capped, **share}
        capped.update(over)


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 1000, "c": 5, None: 700}, {"a": 0, "b": 9}, {"x": 7}, {"a": 0, None: 0},
    {"é": 3, "z": 40, "Z": 500, "": 2, "zz": 1},
])
def test_targets_equal_sharing_again(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    wanted = reshared(sizes)
    for r in source_targets(rows).collect():
        assert r.target == pytest.approx(wanted[r.source])


def test_mix_meets_its_targets(spark):
    rows = near_copies() + odd_rows() + [row(10**6 + n, "one two three", "en", None) for n in range(9)]
    docs = clashing(frame(spark, rows))
    mix = mix_sources(docs, shards=5, carry=["source", "text"])
    found = mix.collect()
    assert len(found) == len(rows)
    by_source = {}
    for f in found:
        assert f.size == len(WORD.findall(f.text or "")) and 0 <= f.taken <= 3 * f.size
        assert sum(d.words for d in f.draws) == f.taken
        assert len({d["pass"] for d in f.draws}) == len(f.draws)
        by_source.setdefault(f.source, []).append(f)
    wanted = reshared({s: sum(f.size for f in fs) for s, fs in by_source.items()})
    for source, fs in by_source.items():
        assert all(f.target == pytest.approx(wanted[source]) for f in fs)
        assert {f.source_size for f in fs} == {sum(f.size for f in fs)}
        assert sum(f.taken for f in fs) == round(wanted[source])
    again = mix_sources(docs.repartition(5), shards=5).select("doc_id", "size", "taken")
    same = mix.select("doc_id", "size", "taken")
    assert sorted(map(str, again.collect())) == sorted(map(str, same.collect()))


def test_mixed_documents_hold_the_taken_words(spark):
    docs = clashing(frame(spark, near_copies() + odd_rows()))
    mixed = mixed_documents(docs)
    assert mixed.columns == docs.columns
    words = sum(len(WORD.findall(r.text)) for r in mixed.collect())
    assert words == sum(r.taken for r in mix_sources(docs).collect())
    assert mixed_documents(frame(spark, [])).collect() == []
    assert mix_sources(frame(spark, [row(1, None), row(2, "")])).select("taken").collect() == [(0,), (0,)]


@pytest.mark.parametrize("shards", [3, 16])
def test_mixed_documents_come_by_shard_in_their_order(spark, shards):
    from pyspark.sql import functions as F

    docs = frame(spark, [r for r in near_copies() if r[1]])
    draws = mix_sources(docs, shards=shards).collect()
    wanted = sorted((d.shard, d.place, f.doc_id) for f in draws for d in f.draws)
    mixed = mixed_documents(docs, shards=shards).withColumn("part", F.spark_partition_id())
    found = mixed.select("doc_id", "part").collect()
    assert [f.doc_id for f in found] == [number for *_, number in wanted]
    each = -(-8 // shards)  # of 8 shuffle partitions
    assert [f.part // each for f in found] == [shard for shard, *_ in wanted]


@pytest.mark.parametrize("shards", [1, 2, 7, 16])
def test_quotas_split_without_loss(spark, shards):
    quotas = {1: 50, 2: 3, 3: 400, 9: 1}
    rows = spark.createDataFrame(list(quotas.items()), "place int, blocks bigint")
    found = split_quotas(rows, shards).collect()
    sums, loads = {}, [0] * shards
    for r in found:
        sums[r.place] = sums.get(r.place, 0) + r.blocks
        loads[r.shard] += r.blocks
    assert sums == quotas and max(loads) - min(loads) <= len(bin(shards))


def test_sources_in_parts_are_split_without_loss(spark):
    quotas = {n: 1 + n * 7 % 30 for n in range(1, 40)}
    rows = spark.createDataFrame(list(quotas.items()), "place int, blocks bigint")
    found = split_quotas(rows, 8, part_sources=8).collect()
    sums, loads = {}, [0] * 8
    for r in found:
        sums[r.place] = sums.get(r.place, 0) + r.blocks
        loads[r.shard] += r.blocks
    assert sums == quotas and max(loads) - min(loads) <= 4
    # A source is spread over the shards as if drawn from all at once.
    one = sum(r.blocks for r in found if r.place > 20 and r.shard < 4)
    assert 0.35 < one / sum(b for n, b in quotas.items() if n > 20) < 0.65


def test_very_many_sources(spark):
    """More sources than a row of the tree holds, one document each."""
    docs = spark.range(3000).selectExpr(
        "id AS doc_id", "'one two three' AS text", "concat('s', id) AS source")
    mix = mix_sources(docs, shards=4)
    total = mix.selectExpr("count(*) AS n", "max(abs(taken - target)) AS apart").first()
    assert total.n == 3000 and total.apart <= 0.5  # whole words


def test_hypergeometric_draws(spark):
    """Mean and variance of many draws, and the ends of the support."""
    from pyspark.sql import functions as F

    draw = _hypergeometric("100L", "30L", "40L", "u")
    rows = spark.range(4000).select(
        F.expr("shiftrightunsigned(xxhash64(id, 3), 11) * pow(2D, -53D)").alias("u"))
    values = [r[0] for r in rows.select(F.expr(draw)).collect()]
    variance = 40 * 0.3 * 0.7 * 60 / 99
    assert statistics.mean(values) == pytest.approx(12, abs=0.15)
    assert statistics.pvariance(values) == pytest.approx(variance, rel=0.1)
    for total, marked, drawn in ((5, 5, 3), (5, 0, 3), (5, 2, 0), (5, 2, 5), (1, 1, 1), (0, 0, 0)):
        sure = _hypergeometric(f"{total}L", f"{marked}L", f"{drawn}L", "0.999D")
        assert spark.range(1).select(F.expr(sure)).first()[0] == min(marked, drawn)


def filled(shards, slots):
    """Turn by turn in plain Python."""
    import hashlib

    def number(text):
        return int(hashlib.md5(text.encode()).hexdigest()[:8], 16)

    wish = [[(number(f"shard-{s}:offset") % slots + j * (number(f"shard-{s}:skip") % (slots - 1) + 1))
             % slots for j in range(slots)] for s in range(shards)]
    table, places, turn = {}, [0] * shards, 0
    while len(table) < slots:
        shard = turn % shards
        while wish[shard][places[shard]] in table:
            places[shard] += 1
        table[wish[shard][places[shard]]] = shard
        turn += 1
    return table


@pytest.mark.parametrize("shards,slots", [(1, 2), (3, 7), (10, 211), (32, 1009)])
def test_table_is_filled_in_turns(spark, shards, slots):
    table = {r.slot: r.shard for r in lookup_table(spark, shards, slots).collect()}
    assert table == filled(shards, slots)


def test_large_tables_are_filled(spark):
    counts = lookup_table(spark, 128, 65537).groupBy("shard").count().collect()
    assert len(counts) == 128 and {r["count"] for r in counts} == {512, 513}


def test_a_new_shard_moves_few_keys(spark):
    before, after = filled(10, 1009), filled(11, 1009)
    moved = sum(before[s] != after[s] and after[s] != 10 for s in before)
    assert moved < 0.15 * 1009


def test_placing(spark, tmp_path):
    rows = odd_rows()
    docs = clashing(frame(spark, rows))
    found = place(docs, "doc_id", 4, 101).collect()
    assert len(found) == len(rows)
    shard_of = {}
    for f in found:
        assert shard_of.setdefault(f.doc_id, f.shard) == f.shard and 0 <= f.shard < 4
    assert place(frame(spark, []), "doc_id", 4, 101).collect() == []
    write_shards(frame(spark, rows), "doc_id", str(tmp_path / "out"), 4, 101, 3)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == len(rows)
    assert all(shard_of[r.doc_id] == r.shard for r in back.collect())
    with pytest.raises(ValueError):
        lookup_table(spark, 4, 100)
    with pytest.raises(ValueError):
        lookup_table(spark, 102, 101)
    assert slot_of is not None and SEED


# Queries of DataFrame and SQL functions alone.
NATIVE = {"op3_mixing", "op6_exact_dedup", "op10_sharding"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, name):
    found = QUERIES[name](spark, FOLDER)
    assert differences(connect(FOLDER), found, SQL[name]) is None
    if name not in NATIVE:
        return
    plan = found._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "NestedLoopJoin", "Python", "InPandas", "InArrow"):
        assert node not in plan


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_covers_every_document(spark, name):
    assert QUERIES[name](spark, FOLDER).count() == len(documents_of())


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    docs = clashing(frame(spark, near_copies() + odd_rows()))
    docs = docs.drop("lang_pred")  # one name less, to see that columns stay as they are
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / name)
        before = docs
        stage(spark, docs, FOLDER).write.parquet(path)
        docs = spark.read.parquet(path)
        if number < 4:
            assert docs.columns == before.columns, name
        if name == "language_id":
            gone = {r.doc_id for r in before.collect()} - {r.doc_id for r in docs.collect()}
            assert gone == {7, 8, 9, 12}
        if name == "simhash_near_dedup":
            assert 0 < docs.count() < before.count()
    assert {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"} == set(docs.columns)


def test_pipeline_of_an_empty_table(spark, tmp_path):
    import corpus_pipeline

    frame(spark, []).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_pipeline_over_the_smallest_tables(spark):
    import corpus_pipeline

    assert corpus_pipeline.run(spark, FOLDER).count() > 0
