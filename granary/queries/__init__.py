"""Queries over the driver tables, one or more for each operator."""

from granary.queries import grouping, joining, layouts, reading, shaping  # noqa: F401
from granary.queries.registry import REGISTRY, Query, Tables  # noqa: F401
