"""Operators applied to the given test tables, with the equivalent SQL of each query."""

from layerkit.plans.queries import cleanse, observe, profiles, quality, retail, star, validation

_MODULES = (cleanse, star, quality, validation, profiles, observe, retail)


def all_queries() -> dict:
    return {name: q for m in _MODULES for name, q in m.QUERIES.items()}


def all_sql() -> dict:
    return {name: sql for m in _MODULES for name, sql in m.SQL.items()}
