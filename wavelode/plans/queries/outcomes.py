"""Streams with side tables, event-time windows and keyed state over the event table."""

from pyspark.sql import functions as F

from wavelode.operators.quality import SILVER_RULES
from wavelode.operators.sinks import overwrite
from wavelode.plans.queries.registry import load, query
from wavelode.plans.queries.streams import _GOLD
from wavelode.plans.queries.testbed import (
    EVENT_TRACKS, SILVER_WHERE, as_messages, event_tracks, state_partitions,
)
from wavelode.session import UNCOUNTED_STATE_CONF, session_conf, work_dir
from wavelode.sources.events import event_stream
from wavelode.sources.files import child_names, remove_path, table, table_stream
from wavelode.streaming.jobs import (
    Layout, read_gold, read_gold_updates, read_latest, read_outcomes, start_bronze, start_gold,
    start_gold_updates, start_latest, start_silver_outcomes, start_windows, state_conf,
)
from wavelode.streaming.keyed import keyed_stream, latest_rows, read_keyed
from wavelode.streaming.sinks import append_stream, numbered_children, run_stream
from wavelode.streaming.windows import days_of, hours_of, windowed_summary

_NOW = "available_now"
_STATE = 4  # for aggregates, whose state is a few groups

# How the events arrive: every tenth stays behind until all others are there, the first
# half of the others comes before the second, and the second half comes twice.
_HALF = "TIMESTAMP '2024-01-16 00:00:00'"
_ARRIVALS = [
    f"event_id % 10 <> 0 AND ts < {_HALF}", f"event_id % 10 <> 0 AND ts >= {_HALF}",
    "event_id % 10 = 0",
]
_DELAY_MS = 24 * 3600 * 1000
# A broken rule counts where its test is not true; the rules stand as SQL already.
_RULES = {rule: test.replace("`", '"') for rule, test in SILVER_RULES.items()}
_TIMED = f"(SELECT *, sent AS event_timestamp FROM ({EVENT_TRACKS}))"
_BROKEN = "concat_ws(',', " + ", ".join(
    f"CASE WHEN ({test}) IS NOT TRUE THEN '{rule}' END" for rule, test in _RULES.items()) + ")"
_SEEN = f"""seen AS (
  SELECT *, {_BROKEN} AS broken, "offset" % 10 = 0 AS behind FROM {_TIMED}
  UNION ALL
  SELECT *, {_BROKEN}, false FROM {_TIMED} WHERE "offset" % 10 <> 0 AND sent >= {_HALF}),
-- The watermark is kept in milliseconds; rows at it are late.
told AS (
  SELECT *, CASE WHEN broken <> '' THEN 'rejected'
    WHEN behind AND epoch_us(sent) <= 1000 * (
      (SELECT epoch_ms(max(sent)) FROM seen WHERE broken = '' AND NOT behind) - {_DELAY_MS})
    THEN 'late' ELSE 'kept' END AS outcome FROM seen)"""


def _sent(spark, folder, copies=True):
    """Messages of each arrival."""
    events = load(spark, folder, "events")

    def messages(number):
        rows = events.where(_ARRIVALS[number])
        if copies and number == 1:
            rows = rows.unionByName(rows)
        return as_messages(event_tracks(rows), "sent")

    return messages


def _forget_last_commit(spark, checkpoint):
    """Make the last batch look as if the query had failed right after writing it."""
    last = max(int(n) for n in child_names(spark, f"{checkpoint}/commits") if n.isdigit())
    remove_path(spark, f"{checkpoint}/commits/{last}")


def _silver_in_arrivals(spark, folder, copies=True, after=None, repeat=True):
    """Layers that run after each arrival; Silver's last batch runs twice."""
    path, layout = work_dir(spark, "arrivals"), Layout(work_dir(spark, "layers"))
    sent = _sent(spark, folder, copies)
    events = load(spark, folder, "events").count()

    def silver():
        return run_stream(start_silver_outcomes(
            spark, layout, _NOW, watermark=("event_timestamp", "1 day"),
            state_partitions=state_partitions(events)))

    for number in range(len(_ARRIVALS)):
        overwrite(sent(number), f"{path}/{number}")
        run_stream(start_bronze(event_stream(spark, "parquet", f"{path}/*"), layout, _NOW))
        silver()
        if after is not None:
            after(layout, number)
    if repeat:
        _forget_last_commit(spark, layout.checkpoint("silver"))
        silver()
    return layout


@query(
    "stream_outcomes",
    f"""WITH {_SEEN},
    events_of AS (SELECT DISTINCT track_id, event_time, outcome FROM told)
    SELECT 'kept' AS name, count(*)::BIGINT AS rows FROM events_of WHERE outcome = 'kept'
    UNION ALL SELECT 'rejected', count(*) FROM told WHERE outcome = 'rejected'
    UNION ALL SELECT 'late', count(*) FROM told WHERE outcome = 'late'
    UNION ALL SELECT 'copy', (SELECT count(*) FROM told WHERE outcome = 'kept')
      - (SELECT count(*) FROM events_of WHERE outcome = 'kept')
    UNION ALL SELECT 'seen', count(*) FROM told
    """ + "".join(
        f"UNION ALL SELECT '{rule}', count(*) FILTER (({test}) IS NOT TRUE) FROM seen "
        for rule, test in _RULES.items()),
)
def stream_outcomes(spark, folder):
    """What became of every row, and rows that broke each rule, after a repeated batch."""
    layout = _silver_in_arrivals(spark, folder)
    outcomes = read_outcomes(spark, layout, "outcomes").groupBy(
        F.col("outcome").alias("name")).agg(F.sum("rows").alias("rows"))
    seen = table(spark, layout.path("bronze")).agg(F.count("*").alias("rows")).select(
        F.lit("seen").alias("name"), "rows")
    rules = read_outcomes(spark, layout, "rules").groupBy(
        F.col("rule").alias("name")).agg(F.sum("rejected").alias("rows"))
    return outcomes.unionByName(seen).unionByName(rules)


@query(
    "stream_rejects",
    f"""WITH {_SEEN}
    SELECT track_id, event_time, popularity, tempo, broken AS failed_rules FROM told
    WHERE outcome = 'rejected'""",
)
def stream_rejects(spark, folder):
    """Invalid events with the rules they break, as the running job wrote them."""
    layout = _silver_in_arrivals(spark, folder)
    return read_outcomes(spark, layout, "rejected").select(
        "track_id", "event_time", "popularity", "tempo",
        F.concat_ws(",", "failed_rules").alias("failed_rules"))


@query(
    "stream_late_rows",
    f"""WITH {_SEEN}
    SELECT track_id, event_time, outcome FROM told WHERE outcome = 'late'
    UNION ALL SELECT DISTINCT track_id, event_time, outcome FROM told WHERE outcome = 'kept'""",
)
def stream_late_rows(spark, folder):
    """Valid events: those that Silver kept and those that came too late for it."""
    layout = _silver_in_arrivals(spark, folder)
    parts = [
        read_outcomes(spark, layout, outcome).select(
            "track_id", "event_time", F.lit(outcome).alias("outcome"))
        for outcome in ("kept", "late")
    ]
    return parts[0].unionByName(parts[1])


# Windows that the watermark of the last batch has passed. Arrivals come in order of time,
# so none is late.
_IN_ORDER = [
    "ts < TIMESTAMP '2024-01-11 00:00:00'",
    "ts >= TIMESTAMP '2024-01-11 00:00:00' AND ts < TIMESTAMP '2024-01-21 00:00:00'",
    "ts >= TIMESTAMP '2024-01-21 00:00:00'",
]


def _closed_sql(unit):
    return f"""closed AS (
      SELECT date_trunc('{unit}', ts) AS start, count(*) AS n FROM events
      WHERE epoch_us(date_trunc('{unit}', ts) + INTERVAL 1 {unit})
        <= 1000 * ((SELECT epoch_ms(max(ts)) FROM events) - 2 * {_DELAY_MS})
      GROUP BY 1)"""


def _closed_windows(spark, folder, width):
    """Windows closed by the end of a stream of three arrivals, and whether the rows of
    state fell on the way."""
    path, target = work_dir(spark, "events"), work_dir(spark, "windows")
    events = load(spark, folder, "events").withColumn("at", F.col("ts").cast("timestamp"))
    fell = False
    for number, test in enumerate(_IN_ORDER):
        overwrite(events.where(test), f"{path}/{number}")
        rows = table_stream(spark, f"{path}/*", events.schema)
        windows = windowed_summary(rows, "at", width, "2 days")
        done = run_stream(append_stream(windows, target, f"{target}-checkpoint", _NOW))
        held = [s["numRowsTotal"] for p in done.recentProgress for s in p["stateOperators"]]
        fell = fell or any(b < a for a, b in zip(held, held[1:]))
    return table(spark, target), fell


@query(
    "stream_daily_windows",
    f"""WITH {_closed_sql('day')}
    SELECT strftime(start, '%Y-%m-%d') AS day, n AS count, true AS state_fell FROM closed""",
)
def stream_daily_windows(spark, folder):
    windows, fell = _closed_windows(spark, folder, "1 day")
    return days_of(windows).withColumn("state_fell", F.lit(fell))


@query(
    "stream_hourly_windows",
    f"""WITH {_closed_sql('hour')}
    SELECT hour(start)::INT AS hour, sum(n)::BIGINT AS count FROM closed GROUP BY 1""",
)
def stream_hourly_windows(spark, folder):
    """Rows per hour of day, out of closed windows of an hour."""
    windows, _ = _closed_windows(spark, folder, "1 hour")
    return hours_of(windows)


@query(
    "silver_day_windows",
    f"""WITH silver AS (SELECT * FROM ({EVENT_TRACKS}) WHERE {SILVER_WHERE})
    SELECT strftime(date_trunc('day', sent), '%Y-%m-%d') AS day, track_genre,
      count(*) AS count, round(avg(popularity), 2) AS avg_popularity FROM silver
    WHERE epoch_us(date_trunc('day', sent) + INTERVAL 1 day)
      <= 1000 * ((SELECT epoch_ms(max(sent)) FROM silver) - {_DELAY_MS})
    GROUP BY ALL""",
)
def silver_day_windows(spark, folder):
    """Days and genres of Silver, closed by the watermark. All of Silver comes at once, so
    none of it is late; days that end within one day of the newest event stay open."""
    path, layout = work_dir(spark, "messages"), Layout(work_dir(spark, "layers"))
    events = load(spark, folder, "events")
    overwrite(as_messages(event_tracks(events), "sent"), path)
    run_stream(start_bronze(event_stream(spark, "parquet", path), layout, _NOW))
    run_stream(start_silver_outcomes(
        spark, layout, _NOW, state_partitions=state_partitions(events.count())))
    run_stream(start_windows(
        spark, layout, "days", "1 day", "1 day", _NOW, keys=["track_genre"],
        means={"popularity": 2}, state_partitions=_STATE))
    return table(spark, layout.path("days")).select(
        F.date_format("window_start", "yyyy-MM-dd").alias("day"), "track_genre", "count",
        "avg_popularity")


@query(
    "stream_latest",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice,
      strftime(l_shipdate, '%Y-%m-%d') AS shipped FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC, l_extendedprice DESC) AS n FROM lineitem) WHERE n = 1""",
)
def stream_latest(spark, folder):
    """The newest line of each key, from arrivals out of order and with replays."""
    lines = load(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_shipdate")
    path, target = work_dir(spark, "lines"), work_dir(spark, "latest")
    keys = ["l_orderkey", "l_linenumber"]
    parts = max(8, state_partitions(lines.count()))
    for number, turn in enumerate((2, 0, 1)):
        rows = lines.where(F.pmod(F.month("l_shipdate"), F.lit(3)) == turn)
        if number == 2:  # what the first arrival had comes again
            rows = rows.unionByName(table(spark, f"{path}/0"))
        overwrite(rows, f"{path}/{number}")
        newest = latest_rows(
            table_stream(spark, f"{path}/*", lines.schema), keys,
            ["l_shipdate", "l_extendedprice"])
        with session_conf(spark, {**state_conf(parts, _NOW), **UNCOUNTED_STATE_CONF}):
            run_stream(keyed_stream(newest, target, f"{target}-checkpoint", keys, _NOW, parts))
    return read_keyed(spark, target).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice",
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("shipped"))


@query(
    "gold_updates",
    f"""SELECT *, true AS same_as_whole, true AS parts_follow_changes
    FROM ({_GOLD})""",
)
def gold_updates(spark, folder):
    """Gold that rewrites the parts of changed groups only. The second arrival has events
    of one type, so it may rewrite no more parts than that type has groups."""
    events = load(spark, folder, "events")
    last = events.agg(F.max("event_type")).first()[0]
    path, layout = work_dir(spark, "messages"), Layout(work_dir(spark, "layers"))
    behind = (F.col("event_type") == last) & (F.col("event_id") % 2 == 0)
    state = state_partitions(events.count())
    for number, rows in enumerate((events.where(~behind), events.where(behind))):
        overwrite(as_messages(event_tracks(rows), "sent"), f"{path}/{number}")
        run_stream(start_bronze(event_stream(spark, "parquet", f"{path}/*"), layout, _NOW))
        run_stream(start_silver_outcomes(spark, layout, _NOW, state_partitions=state))
        run_stream(start_gold_updates(spark, layout, _NOW, state_partitions=_STATE, parts=16))
    run_stream(start_gold(spark, layout, _NOW, state_partitions=_STATE))
    gold = read_gold_updates(spark, layout).drop("gold_ingestion_time")
    whole = read_gold(spark, layout).drop("gold_ingestion_time")
    same = gold.exceptAll(whole).isEmpty() and whole.exceptAll(gold).isEmpty()
    place = numbered_children(spark, layout.path("gold_parts"), "manifest")[0]
    written = child_names(spark, f"{layout.path('gold_parts')}/data/{place[0]}-{place[1]}")
    rewritten = sum(name.startswith("part=") for name in written)
    groups = gold.where(F.col("track_genre") == last).count()
    return gold.withColumns({
        "same_as_whole": F.lit(same),
        "parts_follow_changes": F.lit(0 < rewritten <= groups),
    })


@query(
    "silver_latest",
    f"""SELECT track_id, event_time, popularity FROM (
      SELECT *, row_number() OVER (PARTITION BY track_genre
        ORDER BY sent DESC, track_id DESC) AS n
      FROM ({EVENT_TRACKS}) WHERE {SILVER_WHERE}) WHERE n = 1""",
)
def silver_latest(spark, folder):
    """The newest Silver event of each genre, kept by a job of its own."""
    def follow(layout, _):
        run_stream(start_latest(
            spark, layout, _NOW, ["track_genre"], ["event_timestamp", "track_id"], _STATE,
            parts=4))

    layout = _silver_in_arrivals(spark, folder, copies=False, after=follow, repeat=False)
    return read_latest(spark, layout).select("track_id", "event_time", "popularity")
