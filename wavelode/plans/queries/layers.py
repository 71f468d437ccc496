"""The layer plans, quality rules and duplicate handling."""

from pyspark.sql import functions as F

from wavelode.functions.buckets import GOLD_TEMPO
from wavelode.functions.casts import flag_int
from wavelode.operators.aggregates import summarize
from wavelode.operators.quality import (
    SILVER_RULES, apply_rules, dedupe, drop_missing, latest_per_key, not_null, passing,
    positive, rule_counts, within,
)
from wavelode.plans.layers import bronze, gold, silver_rejects, timed
from wavelode.plans.queries.registry import load, query
from wavelode.plans.queries.testbed import (
    EVENT_TRACKS, LINE_TRACKS, SILVER_CTE, as_messages, event_tracks, line_silver,
    line_tracks,
)

_BUCKET = "CASE WHEN {0} < 90 THEN 'slow' WHEN {0} < 120 THEN 'medium' ELSE 'fast' END"


@query(
    "gold_by_type_bucket",
    f"""SELECT event_type, {_BUCKET.format('value')} AS value_bucket,
      count(*) AS track_count, round(avg(CAST(props->>'k' AS INT)), 2) AS avg_k
    FROM events GROUP BY ALL""",
)
def gold_by_type_bucket(spark, folder):
    rows = (
        load(spark, folder, "events")
        .withColumn("k", F.from_json("props", "k INT")["k"])
        .withColumn("value_bucket", GOLD_TEMPO.of("value"))
    )
    rows = passing(rows, {"type": not_null("event_type"), "k": not_null("k")})
    return summarize(rows, ["event_type", "value_bucket"], {"k": 2}, "track_count")


@query(
    "bronze_batch",
    f"""SELECT "partition", "offset", epoch_us(sent) AS sent_us, track_id, popularity,
      tempo, explicit, event_time
    FROM ({EVENT_TRACKS})""",
)
def bronze_batch(spark, folder):
    messages = as_messages(event_tracks(load(spark, folder, "events")), "sent")
    rows = bronze(messages)
    return rows.filter(F.col("ingestion_time").isNotNull()).select(
        "partition", "offset", F.unix_micros("kafka_timestamp").alias("sent_us"),
        "track_id", "popularity", "tempo", "explicit", "event_time",
    )


_SILVER_COLUMNS = (
    'track_id, event_time, "partition", "offset", artists, track_genre, popularity, '
    "duration_ms, energy, tempo, explicit_int"
)


@query("silver_valid", f"WITH {SILVER_CTE} SELECT {_SILVER_COLUMNS} FROM silver")
def silver_valid(spark, folder):
    return line_silver(spark, folder).select(
        *[c.strip(' "') for c in _SILVER_COLUMNS.split(",")]
    )


_RULE_SQL = {
    "event_timestamp_present": "event_time IS NOT NULL",
    "track_id_present": "track_id IS NOT NULL",
    "track_name_present": "track_name IS NOT NULL",
    "artists_present": "artists IS NOT NULL",
    "popularity_present": "popularity IS NOT NULL",
    "popularity_range": "popularity BETWEEN 0 AND 100",
    "duration_positive": "duration_ms > 0",
    "danceability_range": "danceability BETWEEN 0 AND 1",
    "energy_range": "energy BETWEEN 0 AND 1",
    "valence_range": "valence BETWEEN 0 AND 1",
    "tempo_positive": "tempo > 0",
}
_FAILED_SQL = "concat_ws(',', {})".format(", ".join(
    f"CASE WHEN coalesce({test}, FALSE) THEN NULL ELSE '{rule}' END"
    for rule, test in _RULE_SQL.items()
))


@query(
    "silver_rejects",
    f"""WITH t AS (SELECT *, {_FAILED_SQL} AS failed_rules FROM ({LINE_TRACKS}))
    SELECT track_id, event_time, "offset", failed_rules FROM t WHERE failed_rules <> ''""",
)
def rejects(spark, folder):
    rows = silver_rejects(line_tracks(load(spark, folder, "lineitem")))
    return rows.select(
        "track_id", "event_time", "offset",
        F.concat_ws(",", "failed_rules").alias("failed_rules"),
    )


@query(
    "rule_counts",
    " UNION ALL ".join(
        f"SELECT CAST({i} AS INT) AS rule_no, '{rule}' AS rule, "
        f"count(*) FILTER (WHERE NOT coalesce({test}, FALSE)) AS rejected FROM ({LINE_TRACKS})"
        for i, (rule, test) in enumerate(_RULE_SQL.items())
    ),
)
def rules_broken(spark, folder):
    return rule_counts(timed(line_tracks(load(spark, folder, "lineitem"))), SILVER_RULES)


@query(
    "rules_split",
    """SELECT CASE WHEN value > 100 AND user_id BETWEEN 10 AND 90 THEN 'good' ELSE 'reject' END
      AS side, count(*) AS n, sum(event_id)::BIGINT AS ids
    FROM events GROUP BY ALL""",
)
def rules_split(spark, folder):
    rules = {
        "large": F.col("value") > 100,
        "user": within("user_id", 10, 90),
        "type": not_null("event_type"),
        "positive": positive("value"),
    }
    good, bad = apply_rules(load(spark, folder, "events"), rules)
    both = good.select("event_id", F.lit("good").alias("side")).unionByName(
        bad.select("event_id", F.lit("reject").alias("side"))
    )
    return both.groupBy("side").agg(
        F.count("*").alias("n"), F.sum("event_id").alias("ids")
    )


@query(
    "drop_missing_rows",
    """SELECT d.doc_id, l.quality, l.toxic FROM documents d
    JOIN labels l USING (doc_id) WHERE l.quality IS NOT NULL AND l.toxic IS NOT NULL""",
)
def drop_missing_rows(spark, folder):
    documents = load(spark, folder, "documents").select("doc_id")
    joined = documents.join(load(spark, folder, "labels"), "doc_id", "left")
    return drop_missing(joined, ["doc_id", "quality", "toxic"])


@query(
    "gold_batch",
    f"""WITH {SILVER_CTE}
    SELECT track_genre, {_BUCKET.format('tempo')} AS tempo_bucket, count(*) AS track_count,
      round(avg(popularity), 2) AS avg_popularity, round(avg(energy), 4) AS avg_energy,
      round(avg(danceability), 4) AS avg_danceability
    FROM silver WHERE track_genre IS NOT NULL GROUP BY ALL""",
)
def gold_batch(spark, folder):
    return gold(line_silver(spark, folder)).drop("gold_ingestion_time")


@query(
    "dedupe_first",
    """SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, event_id, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id, strftime(ts, '%Y-%m-%d')
        ORDER BY event_id) AS n FROM events) WHERE n = 1""",
)
def dedupe_first(spark, folder):
    rows = load(spark, folder, "events").select(
        "user_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_id", "value"
    )
    return dedupe(rows, ["user_id", "day"], order=["event_id"])


@query(
    "dedupe_any",
    "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem",
)
def dedupe_any(spark, folder):
    lines = load(spark, folder, "lineitem")
    return dedupe(lines, ["l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber")


@query(
    "latest_per_key",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice,
      strftime(l_shipdate, '%Y-%m-%d') AS shipped FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC, l_extendedprice DESC) AS n FROM lineitem) WHERE n = 1""",
)
def latest(spark, folder):
    rows = load(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_shipdate"
    )
    newest = latest_per_key(
        rows, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_extendedprice"]
    )
    return newest.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice",
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("shipped"),
    )


@query(
    "explicit_flag",
    f"""SELECT track_id, "offset", CASE WHEN explicit THEN 1 ELSE 0 END AS explicit_int
    FROM ({LINE_TRACKS})""",
)
def explicit_flag(spark, folder):
    return line_tracks(load(spark, folder, "lineitem")).select(
        "track_id", "offset", flag_int("explicit").alias("explicit_int")
    )
