"""Map columns: the whitelist used by the routing rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MODES = ("exact", "substring")


def whitelist(data: Column | str, names: Column | str, mode: str = "exact") -> Column:
    """Keep the entries of a map whose key is listed in the comma list ``names``.

    ``exact`` asks for a member of the list; ``substring`` only asks that the key occurs somewhere in the list text,
    so that the list ``order_id`` also admits the key ``id``.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    data = F.col(data) if isinstance(data, str) else data
    names = F.col(names) if isinstance(names, str) else names
    if mode == "exact":
        # Pad both with the separator: one search in the list, nothing to split for every row.
        padded = F.concat(F.lit(","), F.regexp_replace(F.trim(names), r"\s*,\s*", ","), F.lit(","))
        return F.map_filter(data, lambda key, _: F.contains(padded, F.concat(F.lit(","), key, F.lit(","))) & ~(
            F.contains(key, F.lit(","))))
    return F.map_filter(data, lambda key, _: F.contains(names, key))
