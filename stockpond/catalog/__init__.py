"""All named queries; importing the modules registers them."""

from stockpond.catalog import changes, core, ingest, learning, serving, text
from stockpond.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "changes", "core", "ingest", "learning", "serving", "text"]
