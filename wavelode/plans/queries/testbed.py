"""Track events derived row by row from the given tables, in Spark and in SQL."""

from pyspark.sql import functions as F

from wavelode.operators.columns import stamp
from wavelode.operators.sinks import overwrite
from wavelode.plans.layers import silver
from wavelode.plans.queries.registry import load
from wavelode.schemas import EVENT_SCHEMA
from wavelode.session import SHORT_TASKS, session_conf, work_dir
from wavelode.sources.events import event_json
from wavelode.sources.files import table

_FIELDS = [f.name for f in EVENT_SCHEMA]

# Same expressions run in both engines, so each side reads the same values.
_LINE = {
    "event_type": "'track_stream_event'",
    "user_id": "concat('user_', CAST(l_suppkey AS {string}))",
    "track_id": "concat(CAST(l_orderkey AS {string}), '-', CAST(l_linenumber AS {string}))",
    "artists": (
        "CASE WHEN l_partkey % 97 = 0 THEN NULL WHEN l_linenumber >= 6 THEN "
        "concat('supplier ', CAST(l_suppkey AS {string}), ';part ', CAST(l_partkey % 50 AS {string})) "
        "ELSE concat('supplier ', CAST(l_suppkey AS {string})) END"
    ),
    "album_name": "concat('order ', CAST(l_orderkey AS {string}))",
    "track_name": (
        "concat('part ', CAST(l_partkey AS {string}), CASE l_linenumber "
        "WHEN 7 THEN ' (feat. guest)' WHEN 6 THEN ' FT. other' "
        "WHEN 5 THEN ' Left' ELSE '' END)"
    ),
    "track_genre": (
        "CASE WHEN l_partkey % 89 = 0 THEN NULL "
        "ELSE concat('genre ', CAST(l_suppkey % 40 AS {string})) END"
    ),
    "popularity": "CAST(l_partkey % 104 - 1 AS INT)",
    "duration_ms": "CAST(floor(l_extendedprice * 4) - 4000 AS INT)",
    "explicit": "CASE l_returnflag WHEN 'R' THEN TRUE WHEN 'A' THEN FALSE ELSE NULL END",
    "danceability": "l_discount * CAST(10.23457 AS DOUBLE)",
    "energy": "l_tax * CAST(12.34567 AS DOUBLE)",
    "key": "l_linenumber",
    "loudness": "-l_quantity",
    "mode": "CASE l_linestatus WHEN 'O' THEN 1 ELSE 0 END",
    "speechiness": "l_discount * l_tax",
    "acousticness": "l_quantity / CAST(50 AS DOUBLE)",
    "instrumentalness": "l_tax * CAST(10 AS DOUBLE)",
    "liveness": "l_discount * CAST(5 AS DOUBLE)",
    "valence": "CAST(l_orderkey % 101 AS DOUBLE) / CAST(100 AS DOUBLE)",
    "tempo": "l_quantity * CAST(2.5 AS DOUBLE) + CAST(60 AS DOUBLE)",
    "time_signature": "CAST(3 + l_linenumber % 3 AS INT)",
}
_EVENT = {
    "event_type": "'track_stream_event'",
    "user_id": "concat('user_', CAST(user_id AS {string}))",
    "track_id": "concat('track ', CAST(event_id AS {string}))",
    "artists": "concat('user ', CAST(user_id AS {string}))",
    "album_name": "concat('album ', CAST(event_id % 100 AS {string}))",
    "track_name": "concat('song ', CAST(event_id AS {string}))",
    "track_genre": "event_type",
    "popularity": "{k}",
    "duration_ms": "CAST(event_id % 400000 AS INT)",
    "explicit": "event_id % 2 = 1",
    "danceability": "CAST({k} % 10 AS DOUBLE) / CAST(10 AS DOUBLE)",
    "energy": "CAST(user_id % 11 AS DOUBLE) / CAST(10 AS DOUBLE)",
    "key": "CAST(event_id % 12 AS INT)",
    "loudness": "-value",
    "mode": "CAST(event_id % 2 AS INT)",
    "speechiness": "CAST({k} % 7 AS DOUBLE) / CAST(10 AS DOUBLE)",
    "acousticness": "CAST({k} % 9 AS DOUBLE) / CAST(10 AS DOUBLE)",
    "instrumentalness": "CAST({k} % 5 AS DOUBLE) / CAST(10 AS DOUBLE)",
    "liveness": "CAST({k} % 3 AS DOUBLE) / CAST(10 AS DOUBLE)",
    "valence": "CAST({k} AS DOUBLE) / CAST(100 AS DOUBLE)",
    "tempo": "value",
    "time_signature": "4",
}


def _spark_columns(mapping, **names):
    return {
        name: F.expr(text.format(string="STRING", **names))
        for name, text in mapping.items()
    }


def line_tracks(lineitem):
    """Events from order lines; several lines share a track and a month."""
    columns = _spark_columns(_LINE)
    columns["event_time"] = F.date_format(
        F.date_trunc("month", "l_shipdate"), "yyyy-MM-dd'T'HH:mm:ss'+00:00'"
    )
    return lineitem.select(
        *[columns[f.name].cast(f.dataType).alias(f.name) for f in EVENT_SCHEMA],
        F.pmod("l_orderkey", F.lit(8)).cast("int").alias("partition"),
        (F.col("l_partkey") * 1000000 + F.col("l_suppkey")).alias("offset"),
    )


def event_tracks(events):
    """Events from the event table, one track each."""
    columns = _spark_columns(_EVENT, k="CAST(get_json_object(props, '$.k') AS INT)")
    columns["event_time"] = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    return events.select(
        *[columns[f.name].cast(f.dataType).alias(f.name) for f in EVENT_SCHEMA],
        F.pmod("event_id", F.lit(8)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("sent"),
    )


def _sql(mapping, event_time, lineage, source, **names):
    fields = [f"{event_time} AS event_time"] + [
        f'{mapping[name].format(string="VARCHAR", **names)} AS "{name}"'
        for name in _FIELDS if name != "event_time"
    ]
    return f"SELECT {', '.join(fields)}, {lineage} FROM {source}"


LINE_TRACKS = _sql(
    _LINE,
    "strftime(date_trunc('month', l_shipdate), '%Y-%m-%dT%H:%M:%S') || '+00:00'",
    'CAST(l_orderkey % 8 AS INT) AS "partition", '
    'l_partkey * 1000000 + l_suppkey AS "offset"',
    "lineitem",
)
EVENT_TRACKS = _sql(
    _EVENT,
    "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00'",
    'CAST(event_id % 8 AS INT) AS "partition", event_id AS "offset", ts AS sent',
    "events",
    k="CAST(props->>'k' AS INT)",
)

SILVER_WHERE = """
event_time IS NOT NULL AND track_id IS NOT NULL AND track_name IS NOT NULL
AND artists IS NOT NULL AND popularity BETWEEN 0 AND 100 AND duration_ms > 0
AND danceability BETWEEN 0 AND 1 AND energy BETWEEN 0 AND 1
AND valence BETWEEN 0 AND 1 AND tempo > 0
"""
SILVER_CTE = f"""
tracks AS ({LINE_TRACKS}),
silver AS (
  SELECT *, CASE WHEN explicit THEN 1 ELSE 0 END AS explicit_int FROM (
    SELECT *, row_number() OVER (
      PARTITION BY track_id, event_time ORDER BY "partition", "offset") AS copy_no
    FROM tracks WHERE {SILVER_WHERE}) WHERE copy_no = 1)
"""
FEATURES_CTE = f"""{SILVER_CTE},
genres AS (
  SELECT track_genre, row_number() OVER (ORDER BY count(*) DESC, track_genre) - 1 AS genre_index
  FROM silver WHERE track_genre IS NOT NULL GROUP BY track_genre),
features AS (
  SELECT s.*,
    CAST(coalesce(g.genre_index, (SELECT count(*) FROM genres)) AS DOUBLE) AS track_genre_index,
    CAST(len(string_split(artists, ';')) AS INT) AS artist_count,
    CASE WHEN duration_ms < 150000 THEN 1 ELSE 0 END AS is_short_track,
    energy * danceability AS energy_dance_interaction,
    valence * energy AS mood_index,
    CASE WHEN regexp_matches(track_name, '(?i)\\b(feat|ft)\\b') THEN 1 ELSE 0 END AS is_feat
  FROM silver s LEFT JOIN genres g USING (track_genre))
"""


def line_silver(spark, folder):
    """Silver over all order lines, the lowest message first among copies."""
    rows = stamp(
        line_tracks(load(spark, folder, "lineitem")), "ingestion_time",
        F.lit(None).cast("timestamp"),
    )
    return silver(
        rows, now=F.lit(None).cast("timestamp"), order=["partition", "offset"]
    )


def stored(df, label, tasks=SHORT_TASKS):
    """Write a table that several passes read, so it is computed once."""
    path = work_dir(df.sparkSession, label)
    with session_conf(df.sparkSession, tasks):
        overwrite(df, path)
    return table(df.sparkSession, path)


# Messages for each state partition, and how many partitions there are at least.
STATE_ROWS, STATE_LEAST = 500_000, 4


def state_partitions(rows):
    """State partitions for so many messages: what one of them reads and holds is bounded.

    A query keeps the number that it started with, so it follows what it is going to see.
    """
    return max(STATE_LEAST, -(-rows // STATE_ROWS))


def as_messages(tracks, sent):
    """Track events in wire form with the lineage a message source gives."""
    return tracks.select(
        event_json(*_FIELDS).cast("binary").alias("value"),
        F.col(sent).alias("timestamp"), "partition", "offset",
    )
