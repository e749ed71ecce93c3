"""Assemble one SELECT from named parts: only the parts a query needs, in dependency order."""

from __future__ import annotations

import re


def rnd(expr: str, digits: int = 0) -> str:
    """Half-up rounding of a double, done on a decimal so that both engines agree."""
    return f"CAST(round(CAST(({expr}) AS DECIMAL(30, 8)), {digits}) AS DOUBLE)"


def dbl(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


def big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def div(top: str, bottom: str) -> str:
    """Double quotient, NULL over zero."""
    return f"(CAST({top} AS DOUBLE) / nullif(CAST({bottom} AS DOUBLE), 0))"


def needed(parts: dict[str, str], text: str, seen: list[str]) -> list[str]:
    for word in dict.fromkeys(re.findall(r"[a-z_][a-z0-9_]*", text)):
        if word in parts and word not in seen:
            needed(parts, parts[word], seen)
            if word not in seen:
                seen.append(word)
    return seen


def with_parts(parts: dict[str, str], query: str) -> str:
    names = needed(parts, query, [])
    if not names:
        return query
    body = ",\n".join(f"{n} AS MATERIALIZED ({parts[n].strip()})" for n in names)
    query = query.strip()
    if query.startswith("WITH "):
        return f"WITH {body},\n{query.removeprefix('WITH ')}"
    return f"WITH {body}\n{query}"
