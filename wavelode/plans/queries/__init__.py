from wavelode.plans.queries import (  # noqa: F401
    ingest, layers, marts, modelling, outcomes, profiles, proofs, stored,
    streams,
)
from wavelode.plans.queries.registry import QUERIES, SQL  # noqa: F401
