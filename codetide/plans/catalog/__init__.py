"""Named queries: each operator run on ordinary tables, with equivalent SQL.

A query takes a session and a folder of parquet tables.  Where plain SQL can say
the same thing, the SQL stands next to the query.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from codetide.plans.catalog import code, constructs, delta, discovery, flow, folds, messages, runs, streams

MODULES = (messages, discovery, flow, delta, folds, streams, code, constructs, runs)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
for _module in MODULES:
    QUERIES.update(_module.QUERIES)
    ORACLES.update(_module.ORACLES)
