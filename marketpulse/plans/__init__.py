"""Named queries (what the driver and the benchmarks run) and their oracles."""

from marketpulse.plans.catalog import ORACLES, QUERIES, load_all, register

__all__ = ["ORACLES", "QUERIES", "load_all", "register"]
