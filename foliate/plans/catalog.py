"""The registered queries and the SQL that each must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from foliate.plans import detect_queries, evidence_queries, family_queries, gate_queries, line_queries, package_queries, patch_queries, replay_queries, section_queries, sheet_queries, span_queries, status_queries

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {**line_queries.QUERIES, **package_queries.QUERIES, **evidence_queries.QUERIES, **detect_queries.QUERIES, **gate_queries.QUERIES, **section_queries.QUERIES, **status_queries.QUERIES, **family_queries.QUERIES, **span_queries.QUERIES, **sheet_queries.QUERIES, **replay_queries.QUERIES, **patch_queries.QUERIES}
ORACLES: dict[str, str] = {**line_queries.ORACLES, **package_queries.ORACLES, **evidence_queries.ORACLES, **detect_queries.ORACLES, **gate_queries.ORACLES, **section_queries.ORACLES, **status_queries.ORACLES, **family_queries.ORACLES, **span_queries.ORACLES, **sheet_queries.ORACLES, **replay_queries.ORACLES, **patch_queries.ORACLES}
FLAGSHIP = "line_classification"
