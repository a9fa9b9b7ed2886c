"""Query registry: each entry is a Spark plan over the data directory plus,
where SQL can express it, an independent DuckDB oracle statement."""

from __future__ import annotations

from collections.abc import Callable

from sparkprep.functions.rules import _is_plain

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_match(lowered: str, pattern) -> str:
    pats = pattern if isinstance(pattern, (list, tuple)) else [pattern]
    parts = []
    for p in pats:
        parts.append(f"contains({lowered}, {q(p.lower())})" if _is_plain(p)
                     else f"regexp_matches({lowered}, {q(p)}, 'i')")
    return "(" + " AND ".join(parts) + ")"


def sql_first_match(expr: str, rules, default: str | None) -> str:
    lowered = f"lower({expr})"
    whens = " ".join(f"WHEN {sql_match(lowered, p)} THEN {q(label)}" for p, label in rules)
    tail = f" ELSE {q(default)}" if default is not None else ""
    return f"CASE {whens}{tail} END"


def sql_keywords(expr: str, keywords, default: str = "other") -> str:
    return sql_first_match(expr, [(k, k) for k in keywords], default)


def sql_list(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"
