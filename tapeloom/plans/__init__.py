"""Named plans and their registry."""

from tapeloom.plans import checks, dashboard, enriched, features, legs, live, market, marts, registered, renewed, research, staged, strategies, streams, text, wide
from tapeloom.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "checks", "dashboard", "enriched", "features", "legs", "live", "market", "marts", "registered", "renewed", "research", "staged", "strategies", "streams", "text", "wide"]
