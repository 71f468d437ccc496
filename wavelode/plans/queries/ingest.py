"""Sources, parsing and typing over the given tables."""

from pyspark.sql import functions as F

from wavelode.functions.casts import (
    event_timestamp, lenient_bool, lenient_double, lenient_int,
)
from wavelode.operators.aggregates import summarize
from wavelode.operators.columns import existing, parse_events, with_event_timestamp
from wavelode.operators.sinks import overwrite, write_result_csv
from wavelode.plans.queries.registry import load, query
from wavelode.plans.queries.testbed import (
    EVENT_TRACKS, LINE_TRACKS, as_messages, event_tracks, line_tracks,
)
from wavelode.schemas import EVENT_SCHEMA, TRACK_COLUMNS
from wavelode.session import work_dir
from wavelode.sources.events import event_json, to_events
from wavelode.sources.files import (
    first_existing, name_and_value_columns, read_result_csv, read_tracks_csv, table,
)

_TRACK_LIST = ", ".join(f'"{c}"' for c in TRACK_COLUMNS)
_TRACKS = [f"`{c}`" for c in TRACK_COLUMNS]


@query(
    "json_parse_flatten",
    """SELECT event_id, props AS raw_json, CAST(props->>'k' AS INT) AS k FROM events""",
)
def json_parse_flatten(spark, folder):
    messages = load(spark, folder, "events").select(
        F.col("props").cast("binary").alias("value"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
    )
    return parse_events(messages, "k INT").select(
        F.col("offset").alias("event_id"), "raw_json", "k"
    )


@query(
    "event_json_roundtrip",
    f"""SELECT "partition", "offset", event_time, event_type, user_id, {_TRACK_LIST}
    FROM ({EVENT_TRACKS})""",
)
def event_json_roundtrip(spark, folder):
    messages = as_messages(event_tracks(load(spark, folder, "events")), "sent")
    return parse_events(messages).select(
        "partition", "offset", *[f"`{f.name}`" for f in EVENT_SCHEMA]
    )


@query(
    "lenient_cast",
    """
    WITH t AS (
      SELECT event_id, CASE event_id % 9
        WHEN 0 THEN CAST(value AS VARCHAR) WHEN 1 THEN event_type
        WHEN 2 THEN CAST(event_id AS VARCHAR) WHEN 3 THEN ''
        WHEN 4 THEN '-' || CAST(value AS VARCHAR) WHEN 5 THEN CAST(event_id AS VARCHAR) || 'd'
        WHEN 6 THEN 'True' WHEN 7 THEN '1e20' ELSE 'yes' END AS txt
      FROM events),
    n AS (SELECT *, TRY_CAST(txt AS DOUBLE) AS x FROM t)
    SELECT event_id, x AS as_double, TRY_CAST(trunc(x) AS INT) AS as_int,
      coalesce(lower(txt) = 'true', FALSE) AS as_bool
    FROM n
    """,
)
def lenient_cast(spark, folder):
    kind = F.col("event_id") % 9
    value, key = F.col("value").cast("string"), F.col("event_id").cast("string")
    text = (
        F.when(kind == 0, value).when(kind == 1, F.col("event_type"))
        .when(kind == 2, key).when(kind == 3, "").when(kind == 4, F.concat(F.lit("-"), value))
        .when(kind == 5, F.concat(key, F.lit("d"))).when(kind == 6, "True")
        .when(kind == 7, "1e20").otherwise("yes")
    )
    return load(spark, folder, "events").select("event_id", text.alias("txt")).select(
        "event_id",
        lenient_double("txt").alias("as_double"),
        lenient_int("txt").alias("as_int"),
        lenient_bool("txt").alias("as_bool"),
    )


@query(
    "event_envelope_json",
    f"""
    WITH t AS (SELECT {_TRACK_LIST} FROM ({LINE_TRACKS}))
    SELECT track_id, '2024-01-01T00:00:00+00:00' AS event_time,
      'track_stream_event' AS event_type,
      'user_' || CAST(CAST('0x' || substr(md5('42:' || track_id), 1, 8) AS BIGINT) % 5000 + 1
        AS VARCHAR) AS user_id,
      popularity, explicit, energy, "key"
    FROM t
    """,
)
def event_envelope_json(spark, folder):
    tracks = line_tracks(load(spark, folder, "lineitem")).select(*_TRACKS)
    events = to_events(tracks, now="2024-01-01T00:00:00+00:00", method="md5")
    text = events.select(event_json(*events.columns).alias("value"))
    return text.select(F.from_json("value", EVENT_SCHEMA).alias("e")).select(
        "e.track_id", "e.event_time", "e.event_type", "e.user_id",
        "e.popularity", "e.explicit", "e.energy", "e.`key`",
    )


@query(
    "event_time_parse",
    """SELECT event_id,
      CASE WHEN event_id % 10 = 0 THEN NULL ELSE epoch_us(ts) END AS event_us
    FROM events""",
)
def event_time_parse(spark, folder):
    text = F.when(F.col("event_id") % 10 == 0, "not a time").otherwise(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    )
    return load(spark, folder, "events").select(
        "event_id", F.unix_micros(event_timestamp(text)).alias("event_us")
    )


@query(
    "first_time_column",
    "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS event_ts FROM events",
)
def first_time_column(spark, folder):
    events = load(spark, folder, "events")
    timed = with_event_timestamp(events, candidates=["event_timestamp", "ts", "user_id"])
    return timed.select(
        *existing(timed, ["no_such_column", "event_id"]),
        F.date_format("event_ts", "yyyy-MM-dd HH:mm:ss").alias("event_ts"),
    )


@query("tracks_csv", f"SELECT {_TRACK_LIST} FROM ({EVENT_TRACKS})")
def tracks_csv(spark, folder):
    path = work_dir(spark, "tracks-csv")
    tracks = event_tracks(load(spark, folder, "events")).select(*_TRACKS)
    tracks.write.option("header", True).csv(path)
    return read_tracks_csv(spark, path)


@query(
    "result_csv",
    """SELECT event_type AS model, round(avg(value), 2) AS rmse FROM events
    GROUP BY event_type""",
)
def result_csv(spark, folder):
    path = work_dir(spark, "result-csv")
    means = summarize(load(spark, folder, "events"), ["event_type"], {"value": 2})
    write_result_csv(
        means.select(F.col("event_type").alias("Model"), F.col("avg_value").alias("RMSE")),
        path,
    )
    result = read_result_csv(spark, path)
    return result.select(*name_and_value_columns(result, "model", "rmse"))


@query(
    "first_existing_table",
    "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier",
)
def first_existing_table(spark, folder):
    found = first_existing(
        spark, [f"{folder}/no_such_table.parquet", f"{folder}/supplier.parquet"]
    )
    return table(spark, found)


@query(
    "overwrite_table",
    """SELECT o_orderpriority, count(*) AS orders, round(avg(o_totalprice), 2) AS avg_o_totalprice
    FROM orders GROUP BY o_orderpriority""",
)
def overwrite_table(spark, folder):
    path = work_dir(spark, "overwrite")
    orders = load(spark, folder, "orders")
    overwrite(orders.select("o_orderpriority"), path)
    overwrite(
        summarize(orders, ["o_orderpriority"], {"o_totalprice": 2}, "orders"), path
    )
    return table(spark, path)
