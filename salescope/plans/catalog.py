"""All registered queries."""

from __future__ import annotations

from salescope.plans import baskets, clusters, demand, features, learners, linear, models, outlook, profiles, totals  # noqa: F401
from salescope.plans.registry import QUERIES, SQL


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(SQL)
