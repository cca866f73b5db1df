"""Registered queries: each operator on the driver's tables, next to its SQL."""

from importlib import import_module

from tabloom.queries.registry import REGISTRY, Query, Tables

for _name in (
    "sources_q", "shape_q", "filters_q", "repair_q", "missing_q", "profile_q", "aggregate_q", "joins_q",
    "ranking_q", "sets_q", "functions_q", "stats_q", "models_q", "markup_q", "streaming_q", "studies_q",
):
    try:
        import_module(f"tabloom.queries.{_name}")
    except ModuleNotFoundError as e:
        if _name not in str(e):
            raise

__all__ = ["REGISTRY", "Query", "Tables"]
