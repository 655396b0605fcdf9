"""Queries over the test tables, each with the SQL that must give the same rows.

Importing the modules below fills the registry.
"""

from shelfscope.checks import closure, extraction, files, images, incremental, jobs, manifests, quality, runs, scalars, sources, streams, work  # noqa: F401
from shelfscope.checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
