"""Registered queries, one module per group of operators."""

import importlib

MODULES = ["ingest", "aggregates", "windows", "joins", "filters", "ordering", "rules", "modelling", "increments"]


def load():
    from riskspark.plans import registry

    for m in MODULES:
        try:
            importlib.import_module(f"riskspark.plans.{m}")
        except ModuleNotFoundError as e:
            if e.name != f"riskspark.plans.{m}":
                raise
    return registry.QUERIES, registry.CHECKS
