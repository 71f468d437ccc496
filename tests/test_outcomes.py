"""Side tables of the running layers, windows and keyed tables."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from rows import event, messages
from wavelode.operators.quality import latest_per_key
from wavelode.plans.layers import bronze, silver_seen
from wavelode.plans.queries import outcomes
from wavelode.plans.queries.testbed import state_partitions
from wavelode.session import CLOSED_STATE_CONF
from wavelode.sources.events import event_stream
from wavelode.sources.files import (
    child_names, folder_bytes, remove_path, table, table_stream, write_text,
)
from wavelode.streaming import batches, jobs
from wavelode.streaming.batches import each_batch, late_bound, read_batches, write_once
from wavelode.streaming.jobs import (
    Layout, read_gold, read_gold_updates, read_latest, read_outcomes, run_layers, start_bronze,
    start_gold, start_gold_updates, start_latest, start_silver_outcomes,
)
from wavelode.streaming.keyed import keyed_stream, latest_rows, merge_rows, read_keyed
from wavelode.streaming.sinks import append_stream, rows_dropped, run_stream
from wavelode.streaming.windows import windowed_summary

NOW = "available_now"
# The third comes too late; the last does not move the watermark on.
DAYS = ["2024-03-01", "2024-03-20", "2024-03-02", "2024-03-21", "2024-03-21"]


def send(spark, path, texts):
    messages(spark, texts).coalesce(1).write.mode("append").parquet(path)


def arrival(number, day):
    good = [event(track_id=f"t{number}-{i}", event_time=f"{day}T10:00:00+00:00")
            for i in range(3)]
    bad = ["not json", event(track_id=f"r{number}", popularity=500, tempo=-1.0)]
    return good + good[:1] + bad


def silver_job(spark, layout, **options):
    return run_stream(start_silver_outcomes(
        spark, layout, NOW, watermark=("event_timestamp", "1 day"), state_partitions=2, **options))


def run_arrivals(spark, tmp_path):
    path, layout, dropped = str(tmp_path / "in"), Layout(str(tmp_path / "layers")), 0
    for number, day in enumerate(DAYS):
        send(spark, path, arrival(number, day))
        run_stream(start_bronze(event_stream(spark, "parquet", path), layout, NOW))
        dropped += rows_dropped(silver_job(spark, layout))
    return path, layout, dropped


def outcome_counts(spark, layout):
    rows = read_outcomes(spark, layout, "outcomes").groupBy("outcome").sum("rows").collect()
    return {r[0]: r[1] for r in rows}


def test_every_row_has_one_outcome(spark, tmp_path):
    path, layout, dropped = run_arrivals(spark, tmp_path)
    # Spark dropped the third arrival, copy and all.
    assert dropped == 4
    assert outcome_counts(spark, layout) == {"kept": 12, "rejected": 10, "late": 4, "copy": 4}
    late = {r.track_id for r in read_outcomes(spark, layout, "late").collect()}
    assert late == {"t2-0", "t2-1", "t2-2"}
    kept = {r.track_id for r in read_outcomes(spark, layout, "kept").collect()}
    assert kept == {f"t{n}-{i}" for n in (0, 1, 3, 4) for i in range(3)}
    rejected = read_outcomes(spark, layout, "rejected")
    expected = silver_seen(bronze(table(spark, path))).where(F.size("failed_rules") > 0)
    columns = ["track_id", "offset", "failed_rules"]
    assert sorted(map(str, rejected.select(columns).collect())) == sorted(
        map(str, expected.select(columns).collect()))
    rules = read_outcomes(spark, layout, "rules").groupBy("rule").sum("rejected").collect()
    counts = {r[0]: r[1] for r in rules}
    assert counts["popularity_range"] == 10 and counts["track_id_present"] == 5


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    _, layout, _ = run_arrivals(spark, tmp_path)
    before = {t: read_outcomes(spark, layout, t).count() for t in ("kept", "rejected", "late")}
    counts, files = outcome_counts(spark, layout), child_names(spark, layout.path("silver"))
    commits = f"{layout.checkpoint('silver')}/commits"
    last = max(int(n) for n in child_names(spark, commits) if n.isdigit())
    remove_path(spark, f"{commits}/{last}")
    done = silver_job(spark, layout)
    assert done.recentProgress[0]["batchId"] == last and done.recentProgress[0]["numInputRows"]
    assert {t: read_outcomes(spark, layout, t).count() for t in before} == before
    assert outcome_counts(spark, layout) == counts
    assert sorted(child_names(spark, layout.path("silver"))) == sorted(files)


def test_a_batch_that_failed_half_way_is_finished(spark, tmp_path, monkeypatch):
    path, layout = str(tmp_path / "in"), Layout(str(tmp_path / "layers"))
    send(spark, path, arrival(0, DAYS[0]))
    run_stream(start_bronze(event_stream(spark, "parquet", path), layout, NOW))
    whole = write_once

    def broken(df, target, name):
        if target.endswith("silver_outcomes"):
            raise RuntimeError("lost")
        return whole(df, target, name)

    monkeypatch.setattr(batches, "write_once", broken)
    with pytest.raises(Exception, match="lost"):
        silver_job(spark, layout)
    monkeypatch.setattr(batches, "write_once", whole)
    assert table(spark, layout.path("silver")).count() == 3
    silver_job(spark, layout)
    assert table(spark, layout.path("silver")).count() == 3
    assert outcome_counts(spark, layout) == {"kept": 3, "rejected": 2, "late": 0, "copy": 1}


def test_outcomes_without_a_watermark_or_rows(spark, tmp_path):
    path, layout = str(tmp_path / "in"), Layout(str(tmp_path / "layers"))
    (tmp_path / "in").mkdir()
    run_stream(start_bronze(event_stream(spark, "parquet", path), layout, NOW))
    run_stream(start_silver_outcomes(spark, layout, NOW, state_partitions=2))
    for name in ("kept", "rejected", "late", "outcomes", "rules"):
        assert read_outcomes(spark, layout, name).count() == 0
    send(spark, path, arrival(0, DAYS[0]) + arrival(1, DAYS[2]))
    run_stream(start_bronze(event_stream(spark, "parquet", path), layout, NOW))
    run_stream(start_silver_outcomes(spark, layout, NOW, state_partitions=2))
    assert outcome_counts(spark, layout) == {"kept": 6, "rejected": 4, "late": 0, "copy": 2}


def test_batches_are_written_once(spark, tmp_path):
    path, rows = str(tmp_path / "t"), spark.range(5)
    assert write_once(rows, path, "1-0") and not write_once(spark.range(9), path, "1-0")
    assert write_once(spark.range(2), path, "1-1")
    assert read_batches(spark, path, rows.schema).count() == 7
    # What a failed write left does not count, and does not stop the next one.
    spark.range(100).write.parquet(f"{path}/_staged/batch=1-2")
    assert read_batches(spark, path, rows.schema).count() == 7
    assert write_once(spark.range(1), path, "1-2")
    assert read_batches(spark, path, rows.schema).count() == 8


def test_generations_keep_batches_apart(spark, tmp_path):
    source, path = str(tmp_path / "in"), str(tmp_path / "out")
    seen = []

    def write(rows, name, batch_id):
        seen.append(name)
        write_once(rows, path, name)

    for checkpoint in ("one", "two"):
        spark.range(4).coalesce(1).write.mode("append").parquet(source)
        run_stream(each_batch(
            table_stream(spark, source, "id BIGINT"), path, str(tmp_path / checkpoint), write, NOW))
    assert seen == ["1-0", "2-0"]
    assert read_batches(spark, path, spark.range(1).schema).count() == 12


def test_rows_that_only_count_are_held_without_their_columns(spark, tmp_path):
    seen = silver_seen(bronze(messages(spark, [event(), event(track_id="t2", popularity=500)])))
    sides = batches.with_sides(seen.limit(0).drop("failed_rules"), seen)
    rows = batches._mark_outcomes(str(tmp_path), None, sides, 0).collect()
    assert {(r["__outcome"], r["track_id"], r["track_name"] is None) for r in rows} == {
        (None, None, True), ("rejected", "t2", False)}


def test_state_partitions_follow_the_messages():
    assert state_partitions(0) == state_partitions(100_000) == 4
    assert [state_partitions(n) for n in (6_000_000, 36_000_000)] == [12, 72]


def test_a_batch_is_held_on_disk(spark, tmp_path):
    send(spark, str(tmp_path / "in"), arrival(0, DAYS[0]))
    levels = []
    rows = event_stream(spark, "parquet", str(tmp_path / "in"))
    run_stream(each_batch(
        rows, str(tmp_path / "out"), str(tmp_path / "checkpoint"),
        lambda batch, name, batch_id: levels.append(batch.storageLevel), NOW))
    assert [(level.useDisk, level.useMemory) for level in levels] == [(True, False)]


@pytest.mark.parametrize("closed", [True, False])
def test_a_run_that_ends_closes_its_state(spark, tmp_path, monkeypatch, closed):
    if not closed:  # else the store stays until Spark's next look for old ones
        monkeypatch.setattr(jobs, "CLOSED_STATE_CONF", {})
    path, layout = str(tmp_path / "in"), Layout(str(tmp_path / "layers"))
    send(spark, path, arrival(0, DAYS[0]))
    run_stream(start_bronze(event_stream(spark, "parquet", path), layout, NOW))
    done = silver_job(spark, layout)
    state = spark._jvm.org.apache.spark.sql.execution.streaming.state
    run = spark._jvm.java.util.UUID.fromString(str(done.runId))
    loaded = [
        state.StateStore.isLoaded(state.StateStoreProviderId(
            state.StateStoreId(f"file:{layout.checkpoint('silver')}/state", op, part, "default"),
            run))
        for op in (0, 1) for part in (0, 1)
    ]
    assert loaded == [not closed] * 4


@pytest.mark.parametrize("start", [(2, "10 seconds"), (2, NOW, {"maxFilesPerTrigger": 1})])
def test_a_run_of_many_triggers_keeps_its_state(start):
    assert not set(CLOSED_STATE_CONF) & set(jobs.state_conf(*start))


def test_state_of_the_newest_lines_follows_the_lines(spark, tmp_path, monkeypatch):
    spark.createDataFrame(
        [(i % 3, 1, i, float(i), datetime(2024, 1 + i % 12, 2, 12)) for i in range(24)],
        "l_orderkey BIGINT, l_linenumber INT, l_partkey BIGINT, l_extendedprice DOUBLE, "
        "l_shipdate TIMESTAMP").write.parquet(str(tmp_path / "lineitem.parquet"))
    started = []

    def start(*args):
        started.append(keyed_stream(*args))
        return started[-1]

    monkeypatch.setattr(outcomes, "keyed_stream", start)
    monkeypatch.setattr(outcomes, "state_partitions", lambda rows: 11)
    rows = outcomes.stream_latest(spark, str(tmp_path)).collect()
    assert sorted((r.l_orderkey, r.l_partkey, r.shipped) for r in rows) == [
        (0, 21, "2024-10-02"), (1, 22, "2024-11-02"), (2, 23, "2024-12-02")]
    for query in started:
        state = query.lastProgress["stateOperators"][0]
        assert state["numShufflePartitions"] == 11
        assert "rocksdbGetCount" in state["customMetrics"]


def test_late_bound_reads_the_batch_before(spark, tmp_path):
    (tmp_path / "offsets").mkdir()
    write_text(spark, str(tmp_path / "offsets" / "0"), 'v1\n{"batchWatermarkMs":0}\n{}')
    write_text(spark, str(tmp_path / "offsets" / "1"), 'v1\n{"batchWatermarkMs":77}\n{}')
    assert [late_bound(spark, str(tmp_path), n) for n in range(3)] == [0, 0, 77]


def test_write_text_replaces(spark, tmp_path):
    path = str(tmp_path / "pointer")
    write_text(spark, path, "one")
    write_text(spark, path, "two")
    assert (tmp_path / "pointer").read_text() == "two"
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["pointer"]


KEYS = ["a", "b"]


def random_rows(seed, count):
    rng = random.Random(seed)
    return [(rng.choice(["x", "y", None]), rng.randint(0, 5), rng.choice([None, 1.5, 2.5, 9.0]),
             rng.randint(0, 3), n) for n in range(count)]


def test_latest_rows_of_a_stream_are_those_of_a_batch(spark, tmp_path):
    source, path = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "a STRING, b INT, t DOUBLE, u INT, n INT"
    rows = spark.createDataFrame(random_rows(1, 300), schema)
    # Every order value is at one row only, so that the newest row of a key is one.
    rows = rows.dropDuplicates(["a", "b", "t", "u"]).persist()
    for number, (low, high) in enumerate(((200, 300), (0, 100), (100, 200))):
        part = rows.where(f"n >= {low} AND n < {high}")
        if number:
            part = part.unionByName(rows.where("n >= 280"))  # a replay
        part.coalesce(1).write.mode("append").parquet(source)
        newest = latest_rows(table_stream(spark, source, rows.schema), KEYS, ["t", "u"])
        run_stream(keyed_stream(newest, path, str(tmp_path / "cp"), KEYS, NOW, parts=5))
    found = read_keyed(spark, path)
    expected = latest_per_key(rows, KEYS, ["t", "u"])
    assert found.columns == rows.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))
    again = latest_rows(rows, KEYS, ["t", "u"])
    assert sorted(map(str, again.collect())) == sorted(map(str, expected.collect()))
    rows.unpersist()


def test_merged_parts_follow_the_changed_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.range(2000).selectExpr("id AS k", "sha2(string(id), 256) AS v")
    merge_rows(first, path, ["k"], (1, 0), parts=16)
    change = spark.createDataFrame([(7, "seven"), (5000, "new")], first.schema)
    merge_rows(change, path, ["k"], (1, 1), parts=3)  # the table's own number counts
    rows = {r.k: r.v for r in read_keyed(spark, path).collect()}
    assert len(rows) == 2001 and rows[7] == "seven" and rows[5000] == "new"
    whole, part = (folder_bytes(spark, f"{path}/data/1-{n}") for n in (0, 1))
    assert part < whole / 5
    # A repeat of a batch changes nothing; one that was lost is made again from its base.
    merge_rows(spark.createDataFrame([(7, "other")], first.schema), path, ["k"], (1, 1))
    assert {r.v for r in read_keyed(spark, path).where("k = 7").collect()} == {"seven"}
    (tmp_path / "t" / "manifest=1-1").unlink()
    assert read_keyed(spark, path).count() == 2000
    merge_rows(change, path, ["k"], (1, 1))
    assert read_keyed(spark, path).count() == 2001
    merge_rows(change.where("k < 0"), path, ["k"], (1, 2))
    assert child_names(spark, path).count("manifest=1-2") == 0


def test_old_parts_are_removed(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(100).selectExpr("id AS k", "id AS v")
    for batch in range(6):
        merge_rows(rows, path, ["k"], (1, batch), parts=4, keep=2)
    assert sorted(c for c in child_names(spark, path) if c.startswith("manifest")) == [
        "manifest=1-4", "manifest=1-5"]
    left = {c for b in range(6) for c in child_names(spark, f"{path}/data/1-{b}")
            if c.startswith("part=") and b < 4}
    assert not left and read_keyed(spark, path).count() == 100
    assert read_keyed(spark, str(tmp_path / "none"), rows.schema).collect() == []
    with pytest.raises(FileNotFoundError):
        read_keyed(spark, str(tmp_path / "none"))


def test_gold_updates_equal_snapshots(spark, tmp_path):
    path, layout = str(tmp_path / "in"), Layout(str(tmp_path / "layers"))
    for number in range(3):
        send(spark, path, [
            event(track_id=f"t{number}-{i}", track_genre=f"g{(number + i) % 5}", tempo=60.0 + 9 * i)
            for i in range(8)])
        run_stream(start_bronze(event_stream(spark, "parquet", path), layout, NOW))
        run_stream(start_silver_outcomes(spark, layout, NOW, state_partitions=2))
        run_stream(start_gold_updates(spark, layout, NOW, state_partitions=2, parts=3))
        run_stream(start_latest(spark, layout, NOW, state_partitions=2, parts=3))
    run_stream(start_gold(spark, layout, NOW, state_partitions=2))
    left, right = (g.drop("gold_ingestion_time").collect() for g in (
        read_gold_updates(spark, layout), read_gold(spark, layout)))
    assert sorted(map(str, left)) == sorted(map(str, right)) and len(left) > 5
    assert read_latest(spark, layout).count() == 24
    assert read_gold_updates(spark, Layout(str(tmp_path / "other"))).collect() == []


def test_gold_keeps_few_snapshots(spark, tmp_path):
    path, layout = str(tmp_path / "in"), Layout(str(tmp_path / "layers"))
    for number in range(5):
        send(spark, path, [event(track_id=f"t{number}")])
        run_layers(spark, event_stream(spark, "parquet", path), layout, state_partitions=2,
                   keep=2 if number == 4 else 3)
        names = [c for c in child_names(spark, layout.path("gold")) if c.startswith("snapshot=")]
        assert len(names) == (2 if number == 4 else min(number + 1, 3))


def test_windows_close_once_the_watermark_has_passed(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    found = []
    for hours in ([1, 2, 2, 30], [55], [3, 60], [200, None]):
        rows = [(h, "g") for h in hours]
        spark.createDataFrame(rows, "h INT, k STRING").selectExpr(
            "timestampadd(HOUR, h, TIMESTAMP '2024-01-01 00:00:00') AS at", "k"
        ).coalesce(1).write.mode("append").parquet(source)
        stream = table_stream(spark, source, "at TIMESTAMP, k STRING")
        done = run_stream(append_stream(
            windowed_summary(stream, "at", "1 day", "6 hours", keys=["k"]), out,
            str(tmp_path / "cp"), NOW))
        found.append(sorted((r.window_start.day, r["count"]) for r in table(spark, out).collect()))
    # Hour 3 comes when its day is closed; hours 55 and 60 share a day.
    assert found == [[(1, 3)], [(1, 3), (2, 1)], [(1, 3), (2, 1)], [(1, 3), (2, 1), (3, 2)]]
    assert done.lastProgress["stateOperators"][0]["numRowsTotal"] == 1


def test_sliding_windows_of_a_batch(spark):
    rows = spark.createDataFrame([(1, 4.0), (3, 6.0), (None, 1.0)], "h INT, v DOUBLE").selectExpr(
        "timestampadd(HOUR, h, TIMESTAMP '2024-01-01 00:00:00') AS at", "v")
    found = windowed_summary(rows, "at", "4 hours", slide="2 hours", means={"v": 1}).collect()
    assert sorted((r.window_start.hour, r["count"], r.avg_v) for r in found) == [
        (0, 2, 5.0), (2, 1, 6.0), (22, 1, 4.0)]
