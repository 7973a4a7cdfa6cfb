"""Registered queries: every operator of the inventory as a (spark, sf_dir) callable."""

from __future__ import annotations

import importlib

from haven.plans.registry import ORACLE, QUERIES

_MODULES = ["star", "kpis", "quality", "care", "history", "layout", "streams"]


def load() -> None:
    for m in _MODULES:
        importlib.import_module(f"haven.plans.{m}")


def all_queries():
    load()
    return dict(QUERIES)


def all_oracle():
    load()
    return dict(ORACLE)
