"""Column names and types shared by the layers."""

from pyspark.sql import types as T

# The event fields, in wire order, with their types.
EVENT_FIELDS = [
    ("event_time", T.StringType()),
    ("event_type", T.StringType()),
    ("user_id", T.StringType()),
    ("track_id", T.StringType()),
    ("artists", T.StringType()),
    ("album_name", T.StringType()),
    ("track_name", T.StringType()),
    ("track_genre", T.StringType()),
    ("popularity", T.IntegerType()),
    ("duration_ms", T.IntegerType()),
    ("explicit", T.BooleanType()),
    ("danceability", T.DoubleType()),
    ("energy", T.DoubleType()),
    ("key", T.IntegerType()),
    ("loudness", T.DoubleType()),
    ("mode", T.IntegerType()),
    ("speechiness", T.DoubleType()),
    ("acousticness", T.DoubleType()),
    ("instrumentalness", T.DoubleType()),
    ("liveness", T.DoubleType()),
    ("valence", T.DoubleType()),
    ("tempo", T.DoubleType()),
    ("time_signature", T.IntegerType()),
]
EVENT_SCHEMA = T.StructType([T.StructField(name, kind) for name, kind in EVENT_FIELDS])
EVENT_TYPE = "track_stream_event"

ENVELOPE = ["event_time", "event_type", "user_id"]
TRACK_COLUMNS = [f.name for f in EVENT_SCHEMA if f.name not in ENVELOPE]

# Columns a message source must provide.
MESSAGE_SCHEMA = T.StructType([
    T.StructField("value", T.BinaryType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
])

# Measures profiled, in report order.
NUMERIC_COLUMNS = [
    "popularity", "duration_ms", "danceability", "energy", "loudness",
    "speechiness", "acousticness", "instrumentalness", "liveness", "valence",
    "tempo",
]
CATEGORICAL_COLUMNS = ["track_genre", "artists", "album_name", "track_name"]
# Time columns, in the order in which they are tried.
TIMESTAMP_CANDIDATES = [
    "event_timestamp", "kafka_timestamp", "ingestion_time", "event_time",
]

# Model inputs, in vector order.
LABEL = "popularity"
FEATURE_COLUMNS = [
    "duration_ms", "danceability", "energy", "loudness", "speechiness",
    "acousticness", "instrumentalness", "liveness", "valence", "tempo",
    "explicit_int", "track_genre_index", "artist_count", "is_short_track",
    "energy_dance_interaction", "mood_index", "is_feat",
]
DERIVED_FEATURES = [
    "track_genre_index", "artist_count", "is_short_track",
    "energy_dance_interaction", "mood_index", "is_feat",
]
