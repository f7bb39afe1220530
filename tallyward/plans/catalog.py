"""All registered queries, collected from the topic modules."""

from __future__ import annotations

from tallyward.plans import (
    catalog_causal,
    catalog_cohort,
    catalog_drift,
    catalog_evaluate,
    catalog_files,
    catalog_models,
    catalog_profile,
)

_TOPICS = [catalog_cohort, catalog_profile, catalog_evaluate, catalog_drift, catalog_causal, catalog_models, catalog_files]

QUERIES = {}
ORACLES = {}
for _topic in _TOPICS:
    for _name in _topic.catalog.queries:
        if _name in QUERIES:
            raise ValueError(f"query {_name} is registered twice")
    QUERIES.update(_topic.catalog.queries)
    ORACLES.update(_topic.catalog.oracles)
