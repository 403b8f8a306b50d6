"""Named queries over the given tables, each with an equivalent SQL text where one exists."""

from oreflow.queries import fraud, governance, ingest, models, quality, sales, scalars, versions

_AREAS = (sales, fraud, quality, scalars, ingest, versions, governance, models)


def all_queries() -> dict:
    return {name: run for area in _AREAS for name, run in area.QUERIES.items()}


def all_sql() -> dict:
    return {name: text for area in _AREAS for name, text in area.SQL.items()}
