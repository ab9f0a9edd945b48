"""Registered queries, grouped by SURVEY §2 section. Importing this package registers them all."""

from hourloom.plans.catalog import (  # noqa: F401
    aggregates, geo, history, models, quality, relational, scoring, text)
