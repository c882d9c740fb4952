"""All registered jobs and their oracle SQL."""
from __future__ import annotations

from . import (analysis, collect, features, model, oracle_analysis, oracle_collect,
               oracle_features, oracle_model, oracle_stored, stored)


def queries() -> dict:
    out = {}
    out.update(analysis.QUERIES)
    out.update(features.QUERIES)
    out.update(model.QUERIES)
    out.update(collect.QUERIES)
    out.update(stored.QUERIES)
    return out


def oracle_sql() -> dict:
    out = {}
    out.update(oracle_analysis.SQL)
    out.update(oracle_features.SQL)
    out.update(oracle_model.SQL)
    out.update(oracle_collect.SQL)
    out.update(oracle_stored.SQL)
    names = queries()
    return {k: v for k, v in out.items() if k in names}
