"""Registered queries with their SQL counterparts."""
from importlib import import_module

MODULES = ("q_expressions", "q_indicators", "q_series", "q_tables", "q_linkage", "q_stats", "q_forecast", "q_alerts", "q_text")


def load():
    from . import registry

    for m in MODULES:
        import_module(f"{__name__}.{m}")
    return registry.QUERIES, registry.ORACLES
