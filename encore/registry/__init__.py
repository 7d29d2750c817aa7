"""Registered queries and their check SQL, gathered from the modules of this package."""

from __future__ import annotations

import importlib

MODULES = (
    "warehouse", "analysis", "quality", "cleaning", "models", "recommend", "training", "records", "streams", "inputs",
    "expressions", "written",
)


def gather(attribute: str) -> dict:
    found: dict = {}
    for name in MODULES:
        entries = getattr(importlib.import_module(f"encore.registry.{name}"), attribute)
        clash = found.keys() & entries.keys()
        if clash:
            raise ValueError(f"registered twice: {sorted(clash)}")
        found.update(entries)
    return found
