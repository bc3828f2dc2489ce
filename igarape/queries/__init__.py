"""Every operator run on the shared tables, with the SQL that states the expected result."""

from igarape.queries import (  # noqa: F401  (importing registers the queries)
    aggregates,
    flagship,
    keys,
    layers,
    modelling,
    panel,
    plans,
    roundtrips,
    scans,
    texts,
)
from igarape.queries.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
