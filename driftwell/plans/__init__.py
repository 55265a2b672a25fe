"""Every registered query with its oracle SQL."""

from __future__ import annotations

import importlib

FAMILIES = ["query_plans", "mutation_plans", "source_plans", "typing_plans", "nesting_plans", "profile_plans", "inference_plans", "oplog_plans", "sink_plans", "stream_plans"]


def all_plans() -> dict:
    plans: dict = {}
    for family in FAMILIES:
        plans.update(importlib.import_module(f"driftwell.plans.{family}").PLANS)
    return plans
