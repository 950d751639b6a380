"""All registered queries."""

from __future__ import annotations

from opinara.plans import profiles, reports, scalars, storage, streams, text_models, training_data
from opinara.plans.registry import Query

MODULES = (storage, scalars, reports, profiles, training_data, text_models, streams)

CATALOG: dict[str, Query] = {}
for module in MODULES:
    for name, query in module.QUERIES.items():
        if name in CATALOG:
            raise ValueError(f"query {name} is registered twice")
        CATALOG[name] = query
