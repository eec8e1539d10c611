"""Runnable queries over the provided tables, each with its SQL twin."""


def registry():
    """name -> Job, for every query of this package."""
    from goldspan.jobs import (  # noqa: F401  importing registers the jobs
        aggregations, controls, filters, lakes, masters, models, nested, rules, schemas, sinks, sql, streams,
    )
    from goldspan.jobs.base import JOBS
    return JOBS
