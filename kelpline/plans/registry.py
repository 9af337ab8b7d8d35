"""All queries outside the subpackage ``llm``, and their SQL."""

from __future__ import annotations

from kelpline.plans import catalog, corpus, logs, robots

_PLANS = (logs, catalog, robots, corpus)
QUERIES = {k: v for p in _PLANS for k, v in p.QUERIES.items()}
ORACLE = {k: v for p in _PLANS for k, v in p.ORACLE.items()}
