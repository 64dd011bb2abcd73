"""Registered queries (one per operator of the survey) and their DuckDB oracles."""

import sys

from pyspark import cloudpickle

from reportflow.suite import (files, ledger_queries, pipeline_queries, relational, run_queries,  # noqa: F401
                              scalars, table_queries)
from reportflow.suite.base import DOCS, ORACLES, QUERIES

# Tasks get the functions of this package by value, as those of the sources.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["QUERIES", "ORACLES", "DOCS"]
