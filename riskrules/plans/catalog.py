"""All registered queries."""

from riskrules.plans import feature_queries, file_queries, join_queries, mining_queries, model_queries, panel_queries, rollup_queries, rule_queries  # noqa: F401
from riskrules.plans.registry import REGISTRY

__all__ = ["REGISTRY"]
