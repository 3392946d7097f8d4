"""Imports every module that registers queries."""

from importlib import import_module

MODULES = ["q_sources", "q_projection", "q_joins", "q_aggregates", "q_windows", "q_sets", "q_functions",
           "q_streaming", "q_learning"]


def load() -> None:
    for name in MODULES:
        import_module(f"gridpulse.plans.{name}")
