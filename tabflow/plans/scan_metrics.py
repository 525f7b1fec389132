"""What the scans of a finished query have read, from the metrics of its own plan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class ScanReads:
    files: int
    bytes: int
    rows: int


def _scans(node) -> list:
    """The scans below a node of an executed plan, through adaptive plans and finished stages."""
    name = node.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        return _scans(node.executedPlan())
    if name.endswith("QueryStageExec"):
        return _scans(node.plan())
    children = node.children()
    found = [scan for i in range(children.length()) for scan in _scans(children.apply(i))]
    return found + ([node] if node.metrics().contains("numFiles") else [])


def scan_reads(finished: DataFrame) -> ScanReads:
    """Files opened, their bytes, and rows that left the scans of a frame on which ``collect`` has run.

    The rows are those of the pages that statistics, dictionaries and bloom filters couldn't rule out.
    """
    total = {"numFiles": 0, "filesSize": 0, "numOutputRows": 0}
    for scan in _scans(finished._jdf.queryExecution().executedPlan()):
        for name in total:
            metric = scan.metrics().get(name)
            total[name] += metric.get().value() if metric.isDefined() else 0
    return ScanReads(total["numFiles"], total["filesSize"], total["numOutputRows"])
