"""Operators: plain functions from DataFrame to DataFrame."""

from tidehouse.operators import (  # noqa: F401
    cdc,
    cells,
    changelog,
    config,
    dim,
    keywords,
    learn,
    logs,
    parse,
    trade,
    traffic,
    user,
    window_sums,
)
