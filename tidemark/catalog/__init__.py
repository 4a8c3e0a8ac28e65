"""Every operator run over the benchmark tables, each with its SQL counterpart."""

from . import aggregates, cleaning, governance, joins, loads, marts, projections, scalars, scans, sinks, streams, tables, windows
from .base import ORACLES, QUERIES, Tables

__all__ = ["ORACLES", "QUERIES", "Tables"]
