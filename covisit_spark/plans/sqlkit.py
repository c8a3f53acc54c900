"""Assemble ANSI SQL (DuckDB dialect) oracle queries from named CTEs.

Each CTE is registered once with its dependencies; ``build(body, *names)``
emits ``WITH`` clauses in dependency order followed by the final ``SELECT``.
The oracle reads the same Parquet tables (as views) and must return the same
rows as the Spark query of the same name.
"""

from __future__ import annotations

import re

_CTES: dict[str, str] = {}
_NAME = re.compile(r"\b([a-z_][a-z0-9_]*)\b")


def cte(name: str, sql: str) -> str:
    _CTES[name] = sql.strip()
    return name


def _deps(sql: str) -> list[str]:
    return [tok for tok in dict.fromkeys(_NAME.findall(sql)) if tok in _CTES]


def build(body: str, *roots: str) -> str:
    order: list[str] = []
    seen: set[str] = set()

    def visit(n: str) -> None:
        if n in seen:
            return
        seen.add(n)
        for d in _deps(_CTES[n]):
            if d != n:
                visit(d)
        order.append(n)

    for r in list(roots) + _deps(body):
        visit(r)
    if not order:
        return body.strip()
    withs = ",\n".join(f"{n} AS (\n{_CTES[n]}\n)" for n in order)
    return f"WITH {withs}\n{body.strip()}"
