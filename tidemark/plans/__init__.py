"""Registered queries, grouped as the operator inventory is."""

from importlib import import_module

from tidemark.plans.registry import REGISTRY, run

for _module in ("p01_windows", "p02_segments", "p03_grouping", "p04_documents", "p05_joins", "p06_health", "p07_business", "p08_cost", "p09_checks", "p10_warehouse", "p11_quality", "p12_catalog", "p13_pages", "p14_streams", "p15_incidents"):
    import_module(f"tidemark.plans.{_module}")

__all__ = ["REGISTRY", "run"]
