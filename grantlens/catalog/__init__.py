"""All registered queries, imported for their side effect of registering."""

from .registry import CHECKS, LIST_CHECKS, LISTS, QUERIES  # noqa: F401
from . import inputs, projects, filters, strings, windows, joins, aggregates, scoring, pivots, texts, reports, complete, lists  # noqa: F401
