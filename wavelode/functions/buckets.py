"""Range buckets over a numeric column."""

from dataclasses import dataclass

from pyspark.sql import functions as F


def bucketize(c, edges, labels, closed="left", otherwise=None, lower=None):
    """Label each value by the first upper edge it lies under.

    ``closed="left"`` puts a value equal to an edge in the next bucket,
    ``"right"`` keeps it in this one. ``lower`` is an exclusive bound below
    which, as for null, NaN and values past the last edge, the result is
    ``otherwise``.
    """
    c = F.col(c) if isinstance(c, str) else c
    branches = None
    for edge, label in zip(edges, labels):
        test = c < edge if closed == "left" else c <= edge
        if lower is not None:
            test = test & (c > lower)
        branches = (
            F.when(test, label) if branches is None else branches.when(test, label)
        )
    return branches.otherwise(F.lit(otherwise).cast("string"))


@dataclass(frozen=True)
class Buckets:
    edges: tuple
    labels: tuple
    closed: str = "left"
    otherwise: str | None = None
    lower: float | None = None

    @property
    def names(self):
        """All labels in bucket order."""
        extra = () if self.otherwise is None else (self.otherwise,)
        return [*self.labels, *extra]

    def of(self, c):
        return bucketize(
            c, self.edges, self.labels, self.closed, self.otherwise, self.lower
        )


# Bucket edges and labels.
GOLD_TEMPO = Buckets((90, 120), ("slow", "medium"), otherwise="fast")
SEGMENT_TEMPO = Buckets(
    (90, 120, 150),
    ("Slow (<90)", "Midtempo (90-119)", "Upbeat (120-149)"),
    otherwise="Fast (150+)",
)
DASHBOARD_TEMPO = Buckets(
    (80, 100, 120, 140, 1000),
    ("Very Slow", "Slow", "Medium", "Fast", "Very Fast"),
    closed="right",
    lower=0,
)
POPULARITY_SEGMENT = Buckets(
    (20, 50, 75),
    ("Düşük (0-20)", "Orta (21-50)", "Yüksek (51-75)"),
    closed="right",
    otherwise="Çok Yüksek (76-100)",
)
