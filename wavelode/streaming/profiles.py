"""A profile of Silver that follows the table: each micro-batch leaves its states."""

from pyspark.sql import functions as F

from wavelode.operators.states import (
    comoment_states, correlation_profile, distinct_profile, distinct_states, moment_profile,
    moment_states, quantile_profile, quantile_states,
)
from wavelode.schemas import CATEGORICAL_COLUMNS, NUMERIC_COLUMNS
from wavelode.sources.files import table
from wavelode.streaming.batches import each_batch, write_once
from wavelode.streaming.sinks import DEFAULT_TRIGGER

DAY = "day"


def profile_stream(df, path, checkpoint, numeric, names, time=None, trigger=DEFAULT_TRIGGER):
    """Write the states of every micro-batch once: moments, quantiles and distincts by day
    of ``time`` (or as a whole), co-moments as a whole.

    Only new rows are read. A repeated batch changes nothing. Without two measures there
    are no co-moments, without names no distincts.
    """
    group = [DAY] if time else []
    if time:
        df = df.withColumn(DAY, F.to_date(time))
    # A batch is held while its states are made, so it has no other columns.
    df = df.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*group, *numeric, *names])])

    def write(rows, name, batch_id):
        states = {
            "moments": moment_states(rows, numeric, group),
            "quantiles": quantile_states(rows, numeric, group),
            "distincts": distinct_states(rows, names, group),
            "comoments": comoment_states(rows, numeric),
        }
        for kind, state in states.items():
            if state is not None:  # a few rows for each day and column
                write_once(state.coalesce(1), f"{path}/{kind}", name)

    return each_batch(df, path, checkpoint, write, trigger)


class StoredProfile:
    """Profiles merged from what the stream has written; none of them reads the table."""

    def __init__(self, spark, path):
        self.spark, self.path = spark, path

    def states(self, kind):
        return table(self.spark, f"{self.path}/{kind}").drop("batch")

    def moments(self, group=()):
        return moment_profile(self.states("moments"), group)

    def quantiles(self, probabilities=(0.5,), group=()):
        return quantile_profile(self.states("quantiles"), probabilities, group)

    def distincts(self, group=()):
        return distinct_profile(self.states("distincts"), group)

    def correlations(self):
        return correlation_profile(self.states("comoments"))


def silver_profile_columns(rows):
    """Measures and names of Silver, as the report profiles them."""
    have = set(rows.columns)
    return ([c for c in NUMERIC_COLUMNS if c in have],
            [c for c in [*CATEGORICAL_COLUMNS, "user_id", "track_id"] if c in have])
