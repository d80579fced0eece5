"""Queries over the test tables, one or more per operator, with the SQL they must equal."""

from . import event_queries, governance_queries, rule_queries, store_queries, ticket_queries  # noqa: F401
from .core import ORACLES, QUERIES  # noqa: F401
