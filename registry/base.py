"""A small decorator that keeps a query and its SQL together."""

from __future__ import annotations


def new_registry():
    """The two tables of a module, and the decorator that fills them by function name."""
    queries, oracles = {}, {}

    def query(sql: str | None = None):
        def register(build):
            queries[build.__name__] = build
            if sql:
                oracles[build.__name__] = sql
            return build
        return register

    return queries, oracles, query
