"""All registered queries."""

from __future__ import annotations

import importlib

from matchlake.plans.checks import CHECK_SQL, QUERIES

for _module in ["analytics", "maintain", "normalise", "resolve", "shaping", "enrich"]:
    importlib.import_module(f"matchlake.plans.check_{_module}")

__all__ = ["CHECK_SQL", "QUERIES"]
