"""Registered queries, one or more per operator of the blueprint."""

from tidemark.catalogue import (
    column_queries,
    kpi_queries,
    relation_queries,
    rule_queries,
    source_queries,
)
from tidemark.catalogue.registry import REGISTRY

__all__ = [
    "REGISTRY",
    "column_queries",
    "kpi_queries",
    "relation_queries",
    "rule_queries",
    "source_queries",
]
