"""Queries of the core operators and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import curate, health, pipelines, review, sampling, validate, verifiable

_PARTS = (health, sampling, curate, review, validate, verifiable, pipelines)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: v for p in _PARTS for k, v in p.QUERIES.items()}
SQL: dict[str, str] = {k: v for p in _PARTS for k, v in p.SQL.items()}
