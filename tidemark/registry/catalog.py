"""All registered queries."""

import importlib

from tidemark.registry.core import ORACLE, QUERIES

MODULES = ("cleaning", "joins", "aggregates", "formulas", "signals", "particles", "reading", "jobs")

for _name in MODULES:
    importlib.import_module(f"tidemark.registry.{_name}")

__all__ = ["ORACLE", "QUERIES"]
