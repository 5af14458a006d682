"""All registered queries and their SQL counterparts."""

from __future__ import annotations

from . import batch, forecasts, oracle, streams

QUERIES = {**batch.QUERIES, **streams.QUERIES, **forecasts.QUERIES}
ORACLE = {**oracle.ORACLE}
