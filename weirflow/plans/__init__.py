"""One query per operator on the given tables, each with the SQL it must agree with."""

from weirflow.plans import (  # noqa: F401
    aggregates,
    connectors,
    enrichment,
    event_time,
    keyed_state,
    maintenance,
    merges,
    reshaping,
    row_keys,
    scalars,
    views,
    windows,
)
from weirflow.plans.registry import ORACLES, QUERIES  # noqa: F401
