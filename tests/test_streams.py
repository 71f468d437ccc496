import json
import time

import pytest
from pyspark.sql import functions as F

from rows import event, messages
from wavelode.operators.aggregates import daily_counts
from wavelode.plans.layers import bronze, gold, silver, timed
from wavelode.sources.events import event_stream
from wavelode.sources.files import child_names, table, table_stream
from wavelode.streaming.jobs import (
    Layout, read_gold, run_layers, start_bronze, start_gold, start_silver,
)
from wavelode.streaming.sinks import (
    _write_snapshot, append_stream, read_snapshot, rows_dropped, run_stream, snapshot_stream,
)

STAMPS = ["ingestion_time", "silver_ingestion_time", "gold_ingestion_time", "event_timestamp"]


def values(start, stop):
    good = [
        event(track_id=f"t{i}", popularity=i % 120, tempo=60.0 + i, track_genre=f"g{i % 4}")
        for i in range(start, stop)
    ]
    return good + good[:5] + ["not json"]


def write(spark, path, texts):
    messages(spark, texts).withColumn("partition", F.lit(1)).coalesce(1).write.mode(
        "append"
    ).parquet(path)


def same(left, right):
    columns = [c for c in left.columns if c not in STAMPS and c not in ("offset",)]
    a, b = left.select(*columns), right.select(*columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.fixture
def source(spark, tmp_path):
    path = str(tmp_path / "messages")
    write(spark, path, values(0, 50))
    write(spark, path, values(30, 90))
    return path


def batch_layers(spark, path):
    lower = bronze(table(spark, path))
    upper = silver(lower)
    return lower, upper, gold(upper)


def test_stream_equals_batch(spark, tmp_path, source):
    layout = Layout(str(tmp_path / "layers"))
    messages_in = event_stream(spark, "parquet", source, maxFilesPerTrigger=1)
    top = run_layers(spark, messages_in, layout, maxFilesPerTrigger=1)
    expected = batch_layers(spark, source)
    assert same(table(spark, layout.path("bronze")), expected[0])
    assert same(table(spark, layout.path("silver")), expected[1])
    assert same(top, expected[2])


def test_restart_adds_only_new_rows(spark, tmp_path, source):
    layout = Layout(str(tmp_path / "layers"))

    def sizes():
        top = run_layers(spark, event_stream(spark, "parquet", source), layout)
        return [table(spark, layout.path(x)).count() for x in ("bronze", "silver")], top

    first, _ = sizes()
    again, _ = sizes()
    assert first == again
    write(spark, source, values(80, 100))
    more, top = sizes()
    assert more[0] == first[0] + 26
    # Ten tracks are new; the other ten came with the earlier files.
    assert more[1] == first[1] + 10
    assert same(top, batch_layers(spark, source)[2])


@pytest.mark.parametrize("options", [
    {"spread": None}, {"watermark": ("event_timestamp", "1 day")},
    {"watermark": ("event_timestamp", "1 day"), "spread": None},
])
def test_silver_variants(spark, tmp_path, source, options):
    layout = Layout(str(tmp_path / "layers"))
    run_stream(start_bronze(event_stream(spark, "parquet", source), layout, "available_now"))
    run_stream(start_silver(spark, layout, "available_now", **options))
    assert same(table(spark, layout.path("silver")), batch_layers(spark, source)[1])


def test_heavy_copies_meet_in_many_tasks(spark, tmp_path):
    path = str(tmp_path / "messages")
    write(spark, path, [event()] * 300 + values(0, 20))
    layout = Layout(str(tmp_path / "layers"))
    run_stream(start_bronze(event_stream(spark, "parquet", path), layout, "available_now"))
    query = start_silver(spark, layout, "available_now", state_partitions=8)
    run_stream(query)
    kept = [op["numRowsTotal"] for op in query.lastProgress["stateOperators"]]
    assert table(spark, layout.path("silver")).filter("track_id = 't1'").count() == 1
    # The second operator holds one entry per event, the first up to 16 for the heavy one.
    assert min(kept) == 20 and 20 < max(kept) <= 20 + 20 + 16


def test_snapshots_are_replaced_and_pruned(spark, tmp_path):
    source, path = str(tmp_path / "in"), str(tmp_path / "out")
    for i in range(4):
        spark.range(i * 10, i * 10 + 10).selectExpr("id", "id % 2 AS k").coalesce(1).write.mode(
            "append"
        ).parquet(source)
    stream = table_stream(spark, source, "id BIGINT, k BIGINT", maxFilesPerTrigger=1)
    counts = stream.groupBy("k").count()
    run_stream(snapshot_stream(counts, path, str(tmp_path / "cp"), "available_now", keep=2))
    assert sorted(c for c in child_names(spark, path)) == ["snapshot=1-2", "snapshot=1-3"]
    assert sorted(map(tuple, read_snapshot(spark, path).collect())) == [(0, 20), (1, 20)]
    with pytest.raises(Exception):
        read_snapshot(spark, str(tmp_path / "nothing"))


def test_new_checkpoint_goes_on_after_the_old_one(spark, tmp_path):
    source, path = str(tmp_path / "in"), str(tmp_path / "out")

    def add(rows):
        spark.range(rows).selectExpr("id", "id % 2 AS k").coalesce(1).write.mode(
            "append").parquet(source)

    def run(checkpoint, keep=None):
        stream = table_stream(spark, source, "id BIGINT, k BIGINT", maxFilesPerTrigger=1)
        run_stream(snapshot_stream(
            stream.groupBy("k").count(), path, str(tmp_path / checkpoint), "available_now",
            keep=keep))

    for _ in range(3):
        add(10)
    run("first")
    older = read_snapshot(spark, path)
    add(20)
    run("second")
    assert sorted(map(tuple, read_snapshot(spark, path).collect())) == [(0, 25), (1, 25)]
    assert older.count() == 2  # a reader of the older snapshot is not disturbed
    assert (tmp_path / "second" / "generation").read_text() == "2"
    # A repeated batch rewrites its own snapshot, and pruning never takes the newest.
    before = sorted(child_names(spark, path))
    _write_snapshot(path, 2, 1, older, 3)
    assert before[-1] == "snapshot=2-3" and child_names(spark, path) == ["snapshot=2-3"]
    add(1)
    run("second", keep=1)
    assert child_names(spark, path) == ["snapshot=2-4"]


def test_unfinished_snapshot_is_not_read(spark, tmp_path):
    path = tmp_path / "out"
    spark.range(3).write.parquet(str(path / "snapshot=4"))
    (path / "snapshot=5").mkdir()
    assert read_snapshot(spark, str(path)).count() == 3
    spark.range(5).write.parquet(str(path / "snapshot=1-0"))
    (path / "snapshot=1-1").mkdir()
    assert read_snapshot(spark, str(path)).count() == 5


def test_bounded_run_stops(spark, tmp_path, source):
    query = append_stream(
        bronze(event_stream(spark, "parquet", source)), str(tmp_path / "out"),
        str(tmp_path / "cp"), trigger="1 second",
    )
    start = time.time()
    run_stream(query, seconds=4)
    assert not query.isActive and 3 < time.time() - start < 30
    assert table(spark, str(tmp_path / "out")).count() == table(spark, source).count()


def test_partitioned_append(spark, tmp_path, source):
    rows = bronze(event_stream(spark, "parquet", source))
    out = str(tmp_path / "out")
    run_stream(append_stream(
        rows, out, str(tmp_path / "cp"), "available_now", partition_by=["track_genre"]
    ))
    assert "track_genre=g1" in child_names(spark, out)


def test_text_messages(spark, tmp_path):
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "a.txt").write_text("\n".join([event(), event(track_id="t2")]) + "\n")
    rows = bronze(event_stream(spark, "text", str(tmp_path / "lines")))
    run_stream(append_stream(rows, str(tmp_path / "out"), str(tmp_path / "cp"), "available_now"))
    found = table(spark, str(tmp_path / "out")).orderBy("track_id").collect()
    assert [r["track_id"] for r in found] == ["t1", "t2"]
    assert json.loads(found[0]["raw_json"])["track_id"] == "t1"
    assert found[0]["kafka_timestamp"] is not None


def test_kafka_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        event_stream(spark, "kafka", servers="localhost:9092", topic="tracks")


def test_daily_counts_of_a_stream(spark, tmp_path, source):
    rows = timed(bronze(event_stream(spark, "parquet", source, maxFilesPerTrigger=1)))
    out = str(tmp_path / "daily")
    run_stream(snapshot_stream(daily_counts(rows), out, str(tmp_path / "cp"), "available_now"))
    batch = daily_counts(timed(bronze(table(spark, source))))
    assert read_snapshot(spark, out).collect() == batch.collect()


def test_gold_state_partitions(spark, tmp_path, source):
    layout = Layout(str(tmp_path / "layers"))
    run_stream(start_bronze(event_stream(spark, "parquet", source), layout, "available_now"))
    run_stream(start_silver(spark, layout, "available_now"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    query = start_gold(spark, layout, "available_now", state_partitions=3)
    run_stream(query)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert query.lastProgress["stateOperators"][0]["numShufflePartitions"] == 3
    assert same(read_gold(spark, layout), batch_layers(spark, source)[2])


def test_layers_of_an_empty_source(spark, tmp_path):
    layout = Layout(str(tmp_path / "layers"))
    (tmp_path / "in").mkdir()
    top = run_layers(spark, event_stream(spark, "parquet", str(tmp_path / "in")), layout)
    assert top.collect() == [] and "track_count" in top.columns
    write(spark, str(tmp_path / "in"), values(0, 20))
    top = run_layers(spark, event_stream(spark, "parquet", str(tmp_path / "in")), layout)
    assert same(top, batch_layers(spark, str(tmp_path / "in"))[2])


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    path, dropped = str(tmp_path / "in"), 0
    layout = Layout(str(tmp_path / "layers"))
    for number, day in enumerate(["2024-03-01", "2024-03-20", "2024-03-02", "2024-03-21"]):
        write(spark, path, [event(track_id=f"t{number}", event_time=f"{day}T10:00:00+00:00")])
        run_stream(start_bronze(event_stream(spark, "parquet", path), layout, "available_now"))
        query = start_silver(spark, layout, "available_now", state_partitions=2,
                             watermark=("event_timestamp", "1 day"), spread=None)
        dropped += rows_dropped(run_stream(query))
    kept = {r["track_id"] for r in table(spark, layout.path("silver")).collect()}
    assert kept == {"t0", "t1", "t3"} and dropped == 1


def test_copies_in_text_lines_have_places_of_their_own(spark, tmp_path):
    (tmp_path / "lines").mkdir()
    for name in "ab":
        (tmp_path / "lines" / f"{name}.txt").write_text((event() + "\n") * 5)
    rows = bronze(event_stream(spark, "text", str(tmp_path / "lines")))
    run_stream(append_stream(rows, str(tmp_path / "out"), str(tmp_path / "cp"), "available_now"))
    assert table(spark, str(tmp_path / "out")).select("partition", "offset").distinct().count() == 10
