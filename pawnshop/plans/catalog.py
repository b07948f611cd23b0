"""All registered queries and their SQL oracles."""

from __future__ import annotations


def _modules():
    from pawnshop.plans import (catalog_board, catalog_learn, catalog_moves, catalog_profile,
                                catalog_sources)
    mods = [catalog_profile, catalog_board, catalog_moves, catalog_sources, catalog_learn]
    return mods


def all_queries() -> dict:
    out = {}
    for m in _modules():
        out.update(m.Q)
    return out


def all_sql() -> dict:
    out = {}
    for m in _modules():
        out.update(m.SQL)
    return out
