"""Every operator as a query over the given tables, with the same result in plain SQL."""

from tidemark.queries import changes, control, deltas, gold, grain, profile, signals, silver, streaming
from tidemark.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "changes", "control", "deltas", "gold", "grain", "profile", "signals",
           "silver", "streaming"]
