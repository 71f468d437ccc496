"""Hand-made track events."""

import json

VALID = {
    "event_time": "2024-03-01T10:20:30.123456+00:00", "event_type": "track_stream_event",
    "user_id": "user_1", "track_id": "t1", "artists": "a;b", "album_name": "al",
    "track_name": "song", "track_genre": "rock", "popularity": 50, "duration_ms": 200000,
    "explicit": True, "danceability": 0.5, "energy": 0.5, "key": 1, "loudness": -5.5,
    "mode": 1, "speechiness": 0.1, "acousticness": 0.2, "instrumentalness": 0.0,
    "liveness": 0.3, "valence": 0.4, "tempo": 100.0, "time_signature": 4,
}


def event(**changes):
    return json.dumps({**VALID, **changes})


def messages(spark, values):
    rows = [(v.encode(), i) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "value BINARY, offset BIGINT").selectExpr(
        "value", "TIMESTAMP '2024-03-01 00:00:00' AS timestamp", "0 AS partition", "offset"
    )
