"""Grouped summaries, segments and top lists."""

from pyspark.sql import functions as F

from wavelode.functions.buckets import DASHBOARD_TEMPO, POPULARITY_SEGMENT, SEGMENT_TEMPO
from wavelode.operators.aggregates import (
    binned_summary, daily_counts, flag_share, hourly_counts, label_rank,
    segment_summary, summarize, table_summary, top_k, value_counts,
)
from wavelode.plans.queries.registry import load, query
from wavelode.plans.queries.testbed import SILVER_CTE, line_silver


def _events_with_k(spark, folder):
    return load(spark, folder, "events").withColumn(
        "k", F.from_json("props", "k INT")["k"]
    )


@query(
    "type_summary",
    """SELECT event_type, count(*) AS count, round(avg(CAST(props->>'k' AS INT)), 2) AS avg_k,
      round(avg(value), 2) AS avg_value FROM events GROUP BY event_type""",
)
def type_summary(spark, folder):
    rows = summarize(_events_with_k(spark, folder), ["event_type"], {"k": 2, "value": 2})
    return rows.orderBy(F.desc("count"), "event_type")


@query(
    "genre_summary",
    f"""WITH {SILVER_CTE}
    SELECT track_genre, count(*) AS count, round(avg(popularity), 2) AS avg_popularity,
      round(avg(energy), 2) AS avg_energy, round(avg(danceability), 2) AS avg_danceability
    FROM silver GROUP BY track_genre""",
)
def genre_summary(spark, folder):
    means = {"popularity": 2, "energy": 2, "danceability": 2}
    return summarize(line_silver(spark, folder), ["track_genre"], means).orderBy(
        F.desc("count"), "track_genre"
    )


@query("type_counts", "SELECT event_type, count(*) AS count FROM events GROUP BY event_type")
def type_counts(spark, folder):
    return value_counts(load(spark, folder, "events"), "event_type", keep_null=True)


@query(
    "value_counts_topk",
    """SELECT source, count(*) AS count FROM documents WHERE source IS NOT NULL
    GROUP BY source ORDER BY count DESC, source LIMIT 15""",
)
def value_counts_topk(spark, folder):
    return value_counts(load(spark, folder, "documents"), "source", 15)


@query(
    "flag_share",
    """WITH j AS (SELECT toxic, n_chars FROM documents LEFT JOIN labels USING (doc_id))
    SELECT toxic, count(*) AS count, round(avg(n_chars), 2) AS avg_n_chars,
      round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM j), 1) AS share_pct
    FROM j GROUP BY toxic""",
)
def toxic_share(spark, folder):
    documents = load(spark, folder, "documents").select("doc_id", "n_chars")
    joined = documents.join(load(spark, folder, "labels"), "doc_id", "left")
    return flag_share(joined, "toxic", "n_chars")


@query(
    "explicit_share",
    f"""WITH {SILVER_CTE}
    SELECT explicit_int, count(*) AS count, round(avg(popularity), 2) AS avg_popularity,
      round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM silver), 1) AS share_pct
    FROM silver GROUP BY explicit_int""",
)
def explicit_share(spark, folder):
    return flag_share(line_silver(spark, folder), "explicit_int", "popularity")


@query(
    "value_segments",
    """WITH t AS (SELECT *, CAST(props->>'k' AS INT) AS k, CASE
        WHEN value < 90 THEN 'Slow (<90)' WHEN value < 120 THEN 'Midtempo (90-119)'
        WHEN value < 150 THEN 'Upbeat (120-149)' ELSE 'Fast (150+)' END AS segment
      FROM events)
    SELECT segment, count(*) AS count, round(avg(k), 2) AS avg_k FROM t GROUP BY segment""",
)
def value_segments(spark, folder):
    return segment_summary(
        _events_with_k(spark, folder), "value", SEGMENT_TEMPO, "segment", {"k": 2}
    )


@query(
    "score_segments",
    f"""WITH {SILVER_CTE}, t AS (SELECT *, CASE
        WHEN popularity <= 20 THEN 'Düşük (0-20)' WHEN popularity <= 50 THEN 'Orta (21-50)'
        WHEN popularity <= 75 THEN 'Yüksek (51-75)' ELSE 'Çok Yüksek (76-100)' END AS pop_segment
      FROM silver)
    SELECT pop_segment, count(*) AS count, round(avg(energy), 3) AS avg_energy,
      round(avg(danceability), 3) AS avg_danceability, round(avg(valence), 3) AS avg_valence,
      round(avg(acousticness), 3) AS avg_acousticness
    FROM t GROUP BY pop_segment""",
)
def score_segments(spark, folder):
    means = {"energy": 3, "danceability": 3, "valence": 3, "acousticness": 3}
    return segment_summary(
        line_silver(spark, folder), "popularity", POPULARITY_SEGMENT, "pop_segment", means
    )


@query(
    "binned_keep_empty",
    """WITH b(tempo_bucket_rank, tempo_bucket, lo, hi) AS (VALUES
        (0, 'Very Slow', 0, 80), (1, 'Slow', 80, 100), (2, 'Medium', 100, 120),
        (3, 'Fast', 120, 140), (4, 'Very Fast', 140, 1000)),
      t AS (SELECT l_orderkey, l_quantity, l_quantity * 1.5 AS x FROM lineitem)
    SELECT CAST(tempo_bucket_rank AS INT) AS tempo_bucket_rank, tempo_bucket,
      count(l_orderkey) AS track_count, round(avg(l_quantity), 6) AS avg_l_quantity
    FROM b LEFT JOIN t ON x > lo AND x <= hi GROUP BY ALL""",
)
def binned_keep_empty(spark, folder):
    lines = load(spark, folder, "lineitem").select(
        "l_orderkey", "l_quantity", (F.col("l_quantity") * 1.5).alias("x")
    )
    binned = binned_summary(
        lines, "x", DASHBOARD_TEMPO, "tempo_bucket", "l_orderkey", "l_quantity"
    )
    return binned.withColumn("avg_l_quantity", F.round("avg_l_quantity", 6))


@query(
    "bucket_ranks",
    """SELECT event_id, CAST(CASE WHEN value < 90 THEN 0 WHEN value < 120 THEN 1
      WHEN value < 150 THEN 2 ELSE 3 END AS INT) AS segment_rank FROM events""",
)
def bucket_ranks(spark, folder):
    rows = load(spark, folder, "events").withColumn("segment", SEGMENT_TEMPO.of("value"))
    return rows.select(
        "event_id", label_rank("segment", SEGMENT_TEMPO.names).alias("segment_rank")
    )


@query(
    "top_users",
    """SELECT user_id, count(*) AS track_count, round(avg(value), 2) AS avg_value
    FROM events GROUP BY user_id ORDER BY track_count DESC, user_id LIMIT 20""",
)
def top_users(spark, folder):
    users = summarize(
        load(spark, folder, "events"), ["user_id"], {"value": 2}, "track_count"
    )
    return top_k(users, [F.desc("track_count"), "user_id"], 20)


@query(
    "top_artists",
    f"""WITH {SILVER_CTE}
    SELECT artists, count(*) AS track_count, round(avg(popularity), 2) AS avg_popularity
    FROM silver GROUP BY artists ORDER BY track_count DESC, artists LIMIT 20""",
)
def top_artists(spark, folder):
    artists = summarize(
        line_silver(spark, folder), ["artists"], {"popularity": 2}, "track_count"
    )
    return top_k(artists, [F.desc("track_count"), "artists"], 20)


@query(
    "top_customers",
    """SELECT o_custkey, count(*) AS orders, round(avg(o_totalprice), 2) AS avg_o_totalprice
    FROM orders GROUP BY o_custkey ORDER BY orders DESC, o_custkey LIMIT 10""",
)
def top_customers(spark, folder):
    customers = summarize(
        load(spark, folder, "orders"), ["o_custkey"], {"o_totalprice": 2}, "orders"
    )
    return top_k(customers, [F.desc("orders"), "o_custkey"], 10)


@query(
    "daily_counts",
    "SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS count FROM events GROUP BY day",
)
def per_day(spark, folder):
    return daily_counts(load(spark, folder, "events"), "ts")


@query(
    "daily_orders",
    """SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, count(*) AS count
    FROM orders GROUP BY day""",
)
def orders_per_day(spark, folder):
    return daily_counts(load(spark, folder, "orders"), "o_orderdate")


@query(
    "hourly_counts",
    "SELECT CAST(hour(ts) AS INT) AS hour, count(*) AS count FROM events GROUP BY 1",
)
def per_hour(spark, folder):
    return hourly_counts(load(spark, folder, "events"), "ts")


@query(
    "table_summary",
    """SELECT count(*) AS rows, CAST(11 AS INT) AS columns,
      count(DISTINCT l_suppkey) AS distinct_l_suppkey,
      round(avg(l_quantity), 2) AS avg_l_quantity FROM lineitem""",
)
def lineitem_summary(spark, folder):
    return table_summary(load(spark, folder, "lineitem"), "l_suppkey", "l_quantity")
