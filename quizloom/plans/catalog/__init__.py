"""Queries over the test tables, each with the SQL that gives the same rows."""

from quizloom.plans.catalog import (  # noqa: F401
    assembly,
    links,
    metadata,
    outputs,
    rawtext,
    reports,
    runs,
)
from quizloom.plans.catalog.registry import ORACLES, QUERIES  # noqa: F401
