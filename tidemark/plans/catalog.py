"""All queries of the core."""

from __future__ import annotations

from tidemark.plans import ingest_queries, metric_queries, model_queries, pipeline_queries, relation_queries, text_queries, window_queries

_REGISTRIES = [m.REGISTRY for m in (pipeline_queries, window_queries, metric_queries, ingest_queries, text_queries, relation_queries, model_queries)]
QUERIES = {k: q for r in _REGISTRIES for k, q in r.queries.items()}
ORACLE = {k: q for r in _REGISTRIES for k, q in r.oracle.items()}
