"""The report as a set of tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from gridpulse.operators import cells, findings
from gridpulse.plans.run import Run
from gridpulse.schema import present
from gridpulse.workspace import store


@dataclass(frozen=True)
class ReportCells:
    """What a report needs of a run's tables, each of them read once; the stored cells are a few hundred rows."""

    metrics: DataFrame
    issues: DataFrame
    hits: DataFrame
    columns: list[str]

    @classmethod
    def scan(cls, metrics: DataFrame, bottlenecks: DataFrame, anomalies: DataFrame) -> ReportCells:
        return cls(
            metrics=store(cells.metric_cells(metrics), "metric_cells"),
            issues=store(cells.issue_cells(bottlenecks), "issue_cells"),
            hits=store(cells.hit_cells(anomalies), "hit_cells"),
            columns=present(metrics),
        )

    def table(self, name: str) -> DataFrame:
        """One of the report's tables that do not need correlations."""
        return self._sections()[name]()

    def tables(self) -> dict[str, DataFrame]:
        return {name: build() for name, build in self._sections().items()}

    def _sections(self) -> dict[str, Callable[[], DataFrame]]:
        m, i, h, columns = self.metrics, self.issues, self.hits, self.columns
        return {
            "header": lambda: cells.report_header(m, i, h),
            "kpi": lambda: cells.kpi_row(m, i, h, columns),
            "metric_summary": lambda: cells.metric_summary(m, columns),
            "hourly_averages": lambda: cells.hourly_averages(m, columns),
            "power_by_workload": lambda: cells.power_by_workload(m),
            "workload_distribution": lambda: cells.workload_distribution(m),
            "gauges": lambda: cells.health_gauges(m, columns),
            "bottlenecks": lambda: cells.issue_levels(i),
            "bottleneck_summary": lambda: cells.bottleneck_summary(i),
            "anomaly_totals": lambda: cells.anomaly_totals(h),
            "anomalies": lambda: cells.anomalies_by_metric(h),
            "anomaly_summary": lambda: cells.anomaly_summary(h),
            "inputs": lambda: cells.finding_inputs(m, i, h),
        }


def report_tables(run: Run) -> dict[str, DataFrame]:
    """Everything a report shows, one small table per section."""
    tables = ReportCells.scan(run.metrics.rows, run.bottlenecks, run.anomalies).tables()
    inputs = tables.pop("inputs")
    return tables | {
        "findings": findings.key_findings(inputs, run.correlations),
        "correlations": run.correlations,
        "strategies": findings.mitigation_strategies(inputs),
    }


def write_report(run: Run, folder: str) -> str:
    """Write each section as JSON; every section is a handful of rows."""
    for name, table in report_tables(run).items():
        table.write.mode("overwrite").json(f"{folder}/{name}")
    return folder
