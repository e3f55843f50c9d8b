"""Registered queries over the driver tables (one module per SURVEY area).

Importing this package fills ``registry.REGISTRY``.
"""
from . import registry  # noqa: F401
from . import panel, aggregates, windows, relational, text, features, evaluation, neighbors, modeling, io  # noqa: F401

REGISTRY = registry.REGISTRY
