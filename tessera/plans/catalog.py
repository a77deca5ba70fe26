"""Import every plan module so that all queries and oracles are registered."""

from __future__ import annotations

import importlib

from tessera.plans.registry import ORACLES, QUERIES

PLAN_MODULES = [
    "tessera.plans.typed",
    "tessera.plans.statements",
    "tessera.plans.documents",
    "tessera.plans.pages",
    "tessera.plans.markup",
    "tessera.plans.search",
    "tessera.plans.crawl",
]


def load_all() -> None:
    for m in PLAN_MODULES:
        importlib.import_module(m)


def all_queries():
    load_all()
    return dict(QUERIES)


def all_oracles():
    load_all()
    return dict(ORACLES)
