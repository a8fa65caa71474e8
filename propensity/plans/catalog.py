"""Imports every query module, which registers its queries."""

from importlib import import_module

from propensity.plans.registry import QUERIES, SQL

for _name in ("column_queries", "join_queries", "order_queries", "metric_queries", "feature_queries", "model_queries", "ensemble_queries", "inspection_queries", "tuning_queries",
              "scorecard_queries", "stream_queries"):
    import_module(f"propensity.plans.{_name}")

__all__ = ["QUERIES", "SQL"]
