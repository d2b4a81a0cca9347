"""Continuous monitoring of running streams.

``ProgressCollector`` is a ``StreamingQueryListener`` that adds up, per query,
the input rows, watermark-dropped rows and observed metrics of its
micro-batches; ``summary`` gives the health figures the batch monitor queries
give for tables (rows consumed, errors, late rows).
"""

from __future__ import annotations

import threading

from pyspark.sql.streaming import StreamingQueryListener


class ProgressCollector(StreamingQueryListener):
    """Totals by query id: a fixed number of figures however long it runs."""

    def __init__(self) -> None:
        self._lock = threading.Lock()
        self._totals: dict[str, dict] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        late = sum(int(op.numRowsDroppedByWatermark or 0) for op in (p.stateOperators or []))
        observed = {k: v.asDict() for k, v in (p.observedMetrics or {}).items()}
        with self._lock:
            t = self._totals.setdefault(str(p.id), {"name": p.name, "batches": 0, "input_rows": 0,
                                                    "late_dropped": 0, "observed": {}})
            t["batches"] += 1
            t["input_rows"] += int(p.numInputRows or 0)
            t["late_dropped"] += late
            t["rows_per_second"] = float(p.processedRowsPerSecond or 0.0)  # of the last batch
            for name, metrics in observed.items():
                own = t["observed"].setdefault(name, {})
                for k, v in metrics.items():
                    own[k] = own.get(k, 0) + int(v or 0)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def summary(self, query_id: str | None = None) -> dict:
        """Totals over all queries, or of one."""
        out = {"batches": 0, "input_rows": 0, "late_dropped": 0, "observed": {}}
        with self._lock:
            for i, t in self._totals.items():
                if query_id in (None, i):
                    for k in ("batches", "input_rows", "late_dropped"):
                        out[k] += t[k]
                    for name, metrics in t["observed"].items():
                        own = out["observed"].setdefault(name, {})
                        for k, v in metrics.items():
                            own[k] = own.get(k, 0) + v
        return out
