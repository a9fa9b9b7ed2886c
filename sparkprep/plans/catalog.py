"""All registered queries (importing the modules registers them)."""

from __future__ import annotations

import importlib

from sparkprep.plans.registry import ORACLE, QUERIES

_MODULES = [
    "sparkprep.plans.cleaning_queries",
    "sparkprep.plans.text_queries",
    "sparkprep.plans.split_queries",
    "sparkprep.plans.eda_queries",
    "sparkprep.plans.prep_queries",
    "sparkprep.plans.model_queries",
    "sparkprep.plans.sparse_queries",
]
for _m in _MODULES:
    importlib.import_module(_m)


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLE)
