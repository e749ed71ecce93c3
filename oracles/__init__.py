"""DuckDB SQL that states each registered query a second time, for checking values."""

from oracles import base, feeds, inputs, insights, tables
from oracles.build import with_parts

PARTS = {**inputs.PARTS, **base.PARTS, **tables.PARTS, **feeds.PARTS, **insights.PARTS}
QUERIES = {**base.QUERIES, **tables.QUERIES, **feeds.QUERIES, **insights.QUERIES}


def all_sql() -> dict[str, str]:
    return {name: with_parts(PARTS, sql) for name, sql in QUERIES.items()}
