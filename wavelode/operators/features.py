"""Model inputs from valid track events."""

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from wavelode.operators.labels import fit_label_index

from wavelode.schemas import FEATURE_COLUMNS, LABEL

# The featured-artist pattern and the short-track limit.
FEATURED_PATTERN = r"(?i)\b(feat|ft)\b"
SHORT_TRACK_MS = 150000


def artist_count(artists="artists"):
    return F.size(F.split(F.col(artists), ";"))


def is_short(duration="duration_ms", limit=SHORT_TRACK_MS):
    return F.when(F.col(duration) < limit, 1).otherwise(0)


def is_featured(name="track_name"):
    return F.when(F.col(name).rlike(FEATURED_PATTERN), 1).otherwise(0)


def product(a, b):
    return F.col(a) * F.col(b)


def track_features(df):
    """Add the five derived features."""
    return df.withColumns({
        "artist_count": artist_count(),
        "is_short_track": is_short(),
        "energy_dance_interaction": product("energy", "danceability"),
        "mood_index": product("valence", "energy"),
        "is_feat": is_featured(),
    })


def assembler(columns=FEATURE_COLUMNS, output="features"):
    """Columns to one vector; rows with a null or NaN among them are left out."""
    return VectorAssembler(
        inputCols=list(columns), outputCol=output, handleInvalid="skip"
    )


def fit_features(train, nominal="track_genre", columns=FEATURE_COLUMNS):
    """Label index and assembler, fitted on the training side."""
    stages = [fit_label_index(train, nominal)] if nominal else []
    return PipelineModel([*stages, assembler(columns)])


def feature_table(df, key="track_id", label=LABEL, columns=FEATURE_COLUMNS,
                  nominal="track_genre"):
    """Key, label, features and their vector, from valid events."""
    derived = track_features(df)
    vectors = fit_features(derived, nominal, columns).transform(derived)
    return vectors.select(key, label, *columns, "features")


def _slots(df, column):
    attributes = df.schema[column].metadata.get("ml_attr", {})
    groups = attributes.get("attrs", {})
    return sorted(
        (slot for kind in groups.values() for slot in kind), key=lambda s: s["idx"]
    ), attributes.get("num_attrs")


def feature_names(df, column="features", expected=None):
    """Name of each vector slot, ``feature_i`` where nothing fits."""
    slots, size = _slots(df, column)
    if slots and all("name" in slot for slot in slots):
        return [slot["name"] for slot in slots]
    if size is None:
        first = df.select(column).first()
        size = len(first[0]) if first else 0
    if expected is not None and len(expected) == size:
        return list(expected)
    return [f"feature_{i}" for i in range(size)]


def max_categories(df, column="features"):
    """Most values any nominal slot can take."""
    slots, _ = _slots(df, column)
    return max([len(s["vals"]) if "vals" in s else s.get("num_vals", 0) for s in slots],
               default=0)
