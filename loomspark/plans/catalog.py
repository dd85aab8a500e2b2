"""The queries of the library's own operators, each with the SQL it is compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loomspark.plans import quality, structuring, training

FLAGSHIP = "q_quality_tiers"
_MODULES = (quality, training, structuring)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: f for m in _MODULES for k, f in m.QUERIES.items()}
ORACLE_SQL: dict[str, str] = {k: s for m in _MODULES for k, s in m.ORACLE_SQL.items()}
