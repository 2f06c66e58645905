"""Registered queries: name -> (Spark query, SQL check or None)."""

from __future__ import annotations

from dossierlake.plans.queries import jobs, profiles, projections

CATALOG = {**projections.QUERIES, **profiles.QUERIES, **jobs.QUERIES}
