"""The exploratory report over Silver: every table behind its figures."""

from pyspark.sql import functions as F

from wavelode.functions.buckets import (
    DASHBOARD_TEMPO, POPULARITY_SEGMENT, SEGMENT_TEMPO,
)
from wavelode.operators import aggregates as agg
from wavelode.operators import profile
from wavelode.operators.columns import existing
from wavelode.operators.correlation import corr_matrix, strongest_with
from wavelode.operators.distribution import (
    QUARTILES, box_stats, exact_quantiles, histogram,
)
from wavelode.operators.quality import drop_missing
from wavelode.operators.sampling import sample_n
from wavelode.schemas import CATEGORICAL_COLUMNS, LABEL, NUMERIC_COLUMNS, TIMESTAMP_CANDIDATES

SCATTER_ROWS = 5000


def scatter(df, columns, keys, n=SCATTER_ROWS, **options):
    """Sampled points without missing values, keys left out."""
    rows = drop_missing(df, [*dict.fromkeys([*keys, *columns])])
    return sample_n(rows, keys, n, **options).select(*columns)


def report(silver, keys=("track_id", "event_time"), label=LABEL, approx_distinct=False):
    """{section: DataFrame}; a section whose columns are absent is left out.

    Quantiles, bin ranges and correlations are computed while it is built.
    """
    keys = list(keys)
    numeric = existing(silver, NUMERIC_COLUMNS)
    names = existing(silver, [*CATEGORICAL_COLUMNS, "user_id", "track_id"])
    has = set(silver.columns).issuperset
    sections = {
        "schema": profile.schema_profile(silver),
        "describe": profile.describe_numeric(silver, numeric),
        "shape": profile.shape_stats(silver, numeric),
        "medians": profile.medians(silver, numeric),
        "distinct": profile.distinct_counts(silver, names, approx_distinct),
        "missing": profile.null_profile(silver),
        "histograms": histogram(silver, numeric, 50),
        "correlations": corr_matrix(silver, numeric),
    }
    if has(["event_type"]):
        sections["event_types"] = agg.value_counts(silver, "event_type", keep_null=True)
    if existing(silver, TIMESTAMP_CANDIDATES):
        sections["daily"] = agg.daily_counts(silver)
        sections["hourly"] = agg.hourly_counts(silver)
    if has([label]):
        quartiles = exact_quantiles(silver, label, QUARTILES)
        sections["label_markers"] = profile.mean_and_median(silver, [label], quartiles)
        sections["label_box"] = box_stats(silver, label, quartiles=quartiles)
        sections["label_histogram"] = histogram(silver, label, 30)
        sections["label_correlations"] = strongest_with(sections["correlations"], label)
    if has(["track_genre", label, "energy", "danceability"]):
        sections["genres"] = agg.summarize(
            silver, ["track_genre"], {label: 2, "energy": 2, "danceability": 2}
        ).orderBy(F.desc("count"), "track_genre")
        sections["top_genres"] = agg.value_counts(silver, "track_genre", 15)
    if has(["explicit_int", label]):
        sections["explicit"] = agg.flag_share(silver, "explicit_int", label)
    if has(["explicit"]):
        sections["explicit_values"] = agg.value_counts(silver, "explicit")
    if has(["tempo", label]):
        sections["tempo_segments"] = agg.segment_summary(
            silver, "tempo", SEGMENT_TEMPO, "tempo_bucket", {label: 2}
        )
        sections["tempo_bins"] = agg.binned_summary(
            silver, "tempo", DASHBOARD_TEMPO, "tempo_bucket", "track_id", label
        )
    if has([label, "energy", "danceability", "valence", "acousticness"]):
        sections["label_segments"] = agg.segment_summary(
            silver, label, POPULARITY_SEGMENT, "pop_segment",
            {"energy": 3, "danceability": 3, "valence": 3, "acousticness": 3},
        )
    if has(["artists", label]):
        sections["top_artists"] = agg.top_k(
            agg.summarize(silver, ["artists"], {label: 2}, "track_count"),
            [F.desc("track_count"), "artists"], 20,
        )
    if has([*keys, "energy", "danceability", label]):
        sections["energy_scatter"] = scatter(
            silver, ["energy", "danceability", label], keys
        )
    if has([*keys, "valence", label]):
        columns = existing(silver, ["valence", label, "energy"])
        sections["mood_scatter"] = scatter(silver, columns, keys)
    if has(["track_genre", label]):
        sections["summary"] = agg.table_summary(silver, "track_genre", label)
    return sections
