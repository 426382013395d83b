"""All catalog queries by name, each with its SQL oracle where SQL can express it."""

from __future__ import annotations

from lodestack.plans import acquisition, aggregates, compiled, guides, history, joins, publishing, ranking, records, scalars

QUERIES: dict = {}
ORACLES: dict = {}
for _registry in (aggregates.R, joins.R, ranking.R, records.R, history.R, scalars.R, guides.R, compiled.R, publishing.R):
    QUERIES |= _registry.queries
    ORACLES |= _registry.oracles
for _module in (acquisition,):
    QUERIES |= _module.QUERIES
    ORACLES |= _module.ORACLES
