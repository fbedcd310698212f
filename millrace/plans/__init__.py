"""All registered queries, one module per family."""

from millrace.plans import (  # noqa: F401
    aggregates,
    charts,
    filters,
    graphs,
    joins,
    keyed,
    learning,
    ordering,
    sources,
    statistics,
    streams,
    words,
)
from millrace.plans.registry import PLANS, Plan, Tables, plan  # noqa: F401
