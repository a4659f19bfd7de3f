"""The registered queries: every operator over the test tables, with SQL giving the same rows."""

from threadloom.catalog import ingest, models, retrieval, streams, text
from threadloom.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "ingest", "models", "retrieval", "streams", "text"]
