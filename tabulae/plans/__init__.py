"""Bindings of the operators to the driver's test tables.

Importing this package registers every bound query in
``tabulae.plans.registry.QUERIES`` (and its oracle SQL in ``ORACLE``).
"""
from tabulae.plans import explore_queries, ingest_queries, model_queries, quality_queries, segment_queries, statistics_queries, store_queries  # noqa: F401
from tabulae.plans.registry import HEADLINE, ORACLE, QUERIES  # noqa: F401
